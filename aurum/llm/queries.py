"""Named queries of the corpus operators over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.llm import (byte_bpe, conversation_repair, exact_dedup, hard_negatives, html_extract, mixing, ngram_join, packing, pivot_top_k, token_store,
                       toxicity, url_filter, warc_archive)
from aurum.session import shared_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
STORE_END_ID = 2
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/"))
PACK_END_ID = 0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_components(_table(spark, sf_dir, "documents"))


def op2_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_top_k.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archive.archived(_table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.verdicts(_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.verdicts(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "llm", "token_store")
    token_store.write(_table(spark, sf_dir, "documents"), path, TOKENIZER, STORE_END_ID)
    return token_store.read(spark, path, with_ids=False)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER, PACK_END_ID)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, noisy)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.verdicts(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return conversation_repair.verdicts(conversations, conversation_repair.damaged(conversations))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_pivot_top_k": op2_pivot_top_k,
    "op3_warc_archive": op3_warc_archive,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_html_extract": op6_html_extract,
    "op7_source_mix": op7_source_mix,
    "op8_toxicity": op8_toxicity,
    "op9_token_store": op9_token_store,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT doc_id, unnest(CASE
                WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3),
                                                                   lambda i: array_to_string(w[i:i + 4], ' ')))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * c >= 75 * (p.n + q.n - c)),
        edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach AS (
            SELECT doc_id, doc_id AS r FROM documents
            UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON edges.x = reach.r)
        SELECT reach.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
        FROM reach LEFT JOIN sizes ON sizes.doc_id = reach.doc_id GROUP BY reach.doc_id
    """,
    "op2_pivot_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op3_warc_archive": """
        WITH hashed AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last_id
            FROM pages)
        SELECT page_id, payload_bytes,
               list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)),
                   'string_agg', '') AS payload_digest,
               CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last_id THEN last_id END AS refers_to
        FROM hashed
    """,
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
        positives AS (
            SELECT * FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        ranked AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
                   n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
            FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
    """,
    "op13_conversation_repair": r"""
        WITH RECURSIVE kinds AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k,
                   xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(k) + 1), lambda i: ascii(k[i])::BIGINT)),
                       lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                           lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END)),
                       4294967295::BIGINT) % 20 AS kind
            FROM conversations),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM kinds WHERE kind <> 0),
        placed AS (
            SELECT *, left(role, 1) AS initial, row_number() OVER conv AS i, lag(left(role, 1)) OVER conv AS before,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
            FROM damaged WINDOW conv AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
        faulty AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                           WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
            FROM placed),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faulty GROUP BY conv_id),
        -- cheapest (cost, audit) so far that ends at the start, behind a system row, a user row or an assistant row
        parse AS (
            SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': ''} AS z, {'c': 1000000000::BIGINT, 'a': ''} AS s,
                   {'c': 1000000000::BIGINT, 'a': ''} AS u, {'c': 1000000000::BIGINT, 'a': ''} AS t FROM counts
            UNION ALL
            SELECT conv_id, i,
                   {'c': z.c + 4, 'a': z.a || 'D'},
                   list_min([{'c': s.c + 4, 'a': s.a || 'D'},
                             {'c': CASE WHEN stays AND initial = 's' THEN z.c + more ELSE 1000000000 END, 'a': z.a || 'K'}]),
                   list_min([{'c': u.c + 4, 'a': u.a || 'D'}]
                       || list_transform([z, s, t], lambda p: {'c': CASE WHEN stays AND initial = 'u' THEN p.c + more ELSE 1000000000 END, 'a': p.a || 'K'})
                       || list_transform([z, s, t], lambda p: {'c': CASE WHEN stays THEN p.c + 3 + more ELSE 1000000000 END, 'a': p.a || 'R'})),
                   list_min([{'c': t.c + 4, 'a': t.a || 'D'},
                             {'c': CASE WHEN stays AND initial = 'a' THEN u.c + more ELSE 1000000000 END, 'a': u.a || 'K'},
                             {'c': CASE WHEN stays THEN u.c + 3 + more ELSE 1000000000 END, 'a': u.a || 'R'}])
            FROM (SELECT p.conv_id, f.i, f.initial, f.fault NOT IN ('blank', 'duplicate') AS stays,
                         CASE WHEN f.fault = 'truncated' THEN 3 ELSE 0 END AS more, p.z, p.s,
                         list_min([p.u] || list_transform([p.z, p.s, p.t], lambda q: {'c': q.c + 3, 'a': q.a || 'I'})) AS u,
                         list_min([p.t, {'c': p.u.c + 3, 'a': p.u.a || 'I'}]
                             || list_transform([p.z, p.s], lambda q: {'c': q.c + 6, 'a': q.a || 'II'})) AS t
                  FROM parse p JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1)),
        best AS (
            SELECT conv_id, list_min([z, t, {'c': u.c + 3, 'a': u.a || 'I'}, {'c': s.c + 6, 'a': s.a || 'II'}]) AS b
            FROM parse QUALIFY i = max(i) OVER (PARTITION BY conv_id)),
        replay AS (
            SELECT conv_id, b.a AS audit, 0::BIGINT AS j, 0::BIGINT AS i, '' AS last, '' AS done FROM best
            UNION ALL
            SELECT r.conv_id, audit, j + 1, CASE WHEN edit = 'I' THEN r.i ELSE r.i + 1 END,
                   CASE WHEN edit = 'D' THEN last ELSE left(new_role, 1) END,
                   CASE WHEN edit = 'D' THEN done ELSE
                       done || CASE WHEN last = '' THEN '' ELSE chr(10) END || new_role || ':' ||
                       CASE WHEN edit = 'I' THEN '' ELSE f.text END END
            FROM (SELECT *, audit[j + 1] AS edit, CASE WHEN last = 'u' THEN 'assistant' ELSE 'user' END AS other
                  FROM replay WHERE j < len(audit)) r
            LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1,
            LATERAL (SELECT CASE WHEN edit = 'K' THEN f.role ELSE other END AS new_role)),
        repaired AS (SELECT conv_id, sha256(done) AS h FROM replay WHERE j = len(audit))
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
               coalesce(b.a, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN best x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN repaired y ON y.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
}
