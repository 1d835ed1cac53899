import base64
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aurum.llm import pivot_top_k, warc_archive
from aurum.session import shared_path

VECTORS = "vec_id long, embedding array<float>, annulus int, rank int"


def brute_top_k(rows, k, scale=1024):
    usable = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(scale * float(np.float32(c))) for c in v]
        usable[i] = max(usable.get(i, x), x, key=lambda z: np.array(z, "<i4").tobytes())
    out = []
    for q, a in usable.items():
        if q % 100 == 0:
            scored = sorted((-sum(s * t for s, t in zip(a, b)), i) for i, b in usable.items() if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_top_k_is_that_of_all_pairs(spark, monkeypatch):
    for name, value in (("BLOCK", 32), ("QUERY_BLOCK", 2), ("FIRST_SCAN", 12), ("PIVOTS", 6), ("ANNULI", 4)):
        monkeypatch.setattr(pivot_top_k, name, value)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] * (1 + i % 3) + rng.normal(size=8) * 0.2).astype("f4").tolist()) for i in range(500)]
    rows += [(600 + i, rows[100][1]) for i in range(30)]                   # ties
    rows += [(700, None), (701, []), (800, [1.0, None]), (801, [float("nan")] * 8), (802, [float("inf")] * 8),
             (None, [1.0] * 8), (900, [0.5] * 3), (500, rows[7][1]), (500, rows[7][1])]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], VECTORS).repartition(4)
    got = pivot_top_k.top_k(df, F.col("vec_id") % 100 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute_top_k(rows, 10)


def test_top_k_of_few_or_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0], 0, 0), (5, [2.0, 0.5], 0, 0)], VECTORS)
    assert [tuple(r) for r in pivot_top_k.top_k(few, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 5, 3 << 20)]
    assert pivot_top_k.top_k(few.limit(0), F.col("vec_id") == 0).count() == 0


def test_components_out_of_range_are_an_error(spark):
    far = spark.createDataFrame([(0, [3e9], 0, 0), (1, [1.0], 0, 0)], VECTORS)
    with pytest.raises(Exception, match="out of range"):
        pivot_top_k.top_k(far, F.col("vec_id") == 0).collect()


PAGES = "page_id long, url string, html string, address string, once boolean"
ROWS = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (9, "http://a\r\nX: y/9", "same"), (4, None, None),
        (5, "http://b", ""), (6, "http://c", "é" * 50_000), (7, "http://d", "short"), (8, "http://e", "short"),
        (7, "http://d", "short"), (None, "http://f", "no id")]


def want_records(rows, min_bytes):
    last = {}
    for i, _, h in rows:
        last[h or ""] = max((x for x in (i, last.get(h or "")) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = i != last[h or ""] and len(data) >= min_bytes
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", last[h or ""] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archive_round_trip(spark, min_bytes):
    df = spark.createDataFrame([(*r, "x", True) for r in ROWS], PAGES).repartition(3)
    got = warc_archive.archived(df, min_bytes).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) \
        == want_records(ROWS, min_bytes)


def test_records_are_whole_and_payloads_stored_once(spark):
    df = spark.createDataFrame([(*r, "x", True) for r in ROWS], PAGES)
    path = shared_path(spark, "tests", "warc")
    warc_archive.write(df, path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({r[2] or "" for r in ROWS})
    for r in warc_archive.reconstruct(spark, path).collect():
        head, record, payload = bytes(r.header), bytes(r.record), bytes(r.payload)
        warc, _, http = head.partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in warc.split(b"\r\n")[1:])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert int(fields[b"Content-Length"]) == len(record) - len(warc) - 4 - 4
        assert record == head + (payload if r.record_type == "response" else b"") + b"\r\n\r\n"
        assert int(dict(x.split(b": ", 1) for x in http.strip().split(b"\r\n")[1:])[b"Content-Length"]) == len(payload)


def test_a_changed_payload_is_found(spark):
    path = shared_path(spark, "tests", "warc")
    warc_archive.write(spark.createDataFrame([(*ROWS[0], "x", True)], PAGES), path)
    broken = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"othe"))
    other = shared_path(spark, "tests", "warc")
    broken.write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{other}/headers")
    with pytest.raises(Exception, match="differs from its address"):
        warc_archive.reconstruct(spark, other).collect()


def test_archive_of_nothing(spark):
    assert warc_archive.archived(spark.createDataFrame([], PAGES)).count() == 0
