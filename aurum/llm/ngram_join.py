"""Jaccard self-join on word shingles with signature trees, and the connected components of its links.

Two documents link when their sets of distinct shingles have a Jaccard similarity of at least 3/4.

1. One scan makes of each text its set's size, 128-bit fingerprint, bitmap and ``KEYS`` smallest shingle hashes.
   Equal sets are one class from here on, however many copies there are.
2. Classes that share a key meet.  Of the union's smallest ``KEYS`` hashes a linked pair shares three quarters on
   average, and at most three eighths with a probability below 1e-13.  So a key that more than ``NODE`` classes have is
   only needed for classes of which more than three eighths of the keys are so frequent ("heavy"), and for those the
   ``HEAVY_KEYS`` smallest hashes do (a pair shares none of them with a probability below 2e-11).  These are the only
   chances of a miss, at a similarity of just 3/4, and fall fast above it.  A passage that many documents share thus
   costs nothing for documents that have enough text of their own.
3. The classes of a key are a node, frequent keys being split by size and hash into nodes of about ``HEAVY_NODE``
   members.  A signature tree over each node is traversed against itself; bitmaps and size ranges prune the pairs, and pairs that
   other candidate pairs connect already are left out.  What remains, a forest, is verified on the exact sets.
4. Components of the verified links.  Then the second traversal, which makes the result complete: every pair of
   members of a node, and every pair of nodes of one frequent key (but for nodes inside the key's largest component),
   is traversed again for pairs in different components, the nodes' roots pruning whole pairs of nodes first.  These
   candidates are verified too, and the components of all links are the result.

A pair that shares several frequent keys is a candidate of the least of them only.  Verification ships one set for
each candidate to the other's place, with the places of sets that have many candidates split.  Bitmaps are about a
byte for each shingle, keys a bounded number for each document; texts are read three times, and shuffled only if the
ids needed for verification cannot be broadcast (by their counted rows).

Defined results: texts without words link with nothing and are components of their own.  Rows that share an id are one
document with the links of them all; rows without an id take no part and have no component.  An empty table gives an
empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm import signature_tree as tree
from aurum.llm.common import bounded, staged, unused
from aurum.llm.components import components
from aurum.llm.shingles import WIDTH, shingle_sets

KEYS = 96
NODE = 64
HEAVY_SHARE = 0.375
HEAVY_KEYS = 18
HEAVY_NODE = 256
#: The same in the second traversal, where every pair of nodes of a key meets.
MEETING_NODE = 2048
#: Sets that are compared with one set in one place.
PLACE = 256
#: Rows of a broadcast table of the sets to ship.
ORDERS = 300_000

_SETS = "doc_id long, n long, c1 long, c2 long, bits binary, keys array<long>"
_PAIR = "a long, b long"
_ACROSS = ["side", "component", "key", "keys"]


def sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n, c1, c2, bits, keys`` of every row: size, fingerprint, bitmap and smallest hashes; staged."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shingle_sets(batch.column(1), width)
            prints = [divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 1 << 64) for s in found]
            keys = [s[:KEYS].view(np.int64) for s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in found], pa.int64()),
                 *(pa.array(np.array([p[i] for p in prints], np.uint64).view(np.int64)) for i in (0, 1)),
                 pa.array([tree.bitmap(s) if len(s) else None for s in found], pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "n", "c1", "c2", "bits", "keys"])

    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                  .mapInArrow(scan, _SETS), "ngram_sets")


def _members(classes: DataFrame) -> DataFrame:
    """``key, rep, n, c, part``: the classes that must meet at a key and the node of the key they are in; staged."""
    entries = classes.select(F.col("doc_id").alias("rep"), "n", F.posexplode("keys").alias("rank", "key"))
    counts = staged(classes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("c"))
                    .where("c > 1"), "ngram_keys")
    shared = staged(entries.join(counts, "key"), "ngram_shared")
    hot = shared.where(F.col("c") > NODE)
    heavy = staged(hot.groupBy("rep").agg(F.count(F.lit(1)).alias("h"), F.min("n").alias("n"))
                   .where(F.col("h") > HEAVY_SHARE * F.least("n", F.lit(KEYS))).select("rep"), "ngram_heavy")
    chosen = staged(hot.where(F.col("rank") < HEAVY_KEYS).join(bounded(heavy), "rep", "left_semi")
                    .select("key", "rep", "n"), "ngram_hot")
    n = chosen.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    split = chosen.join(bounded(staged(n, "ngram_hot_keys")), "key") \
        .select("key", "rep", "n", "c", _part("c", HEAVY_NODE).alias("part"))
    return staged(shared.where(F.col("c") <= NODE).select("key", "rep", "n", "c", F.lit(-1).cast("long").alias("part"))
                  .unionByName(split), "ngram_members")


def _size_class():
    """Sets of linked documents are in the same or in neighbouring classes of size."""
    return F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3)) + 1e-9)


def _part(count: str, node: int):
    """A node of a frequent key: by size, then by hash into nodes of about ``node``."""
    parts = F.ceil(F.col(count) / F.lit(node))
    return _size_class() * F.lit(1 << 32) + F.pmod(F.xxhash64("rep", "key"), parts)


def _in_nodes(nodes: DataFrame, bits: DataFrame, emit, extra: list[str]) -> DataFrame:
    """``emit`` over the leaves of each node: ``nodes`` has ``node, rep`` and the columns ``extra``."""
    rows = nodes.join(bits, "rep").select("node", *extra, "rep", "n", "bits") \
        .repartition("node").sortWithinPartitions("node", *extra, "rep")

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple[int, int]] = []
        node, rows = None, {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                row = tuple(tuple(x) if isinstance(x, list) else x for x in row)
                if row[0] != node:
                    pairs += emit(list(rows.values()))
                    node, rows = row[0], {}
                rows[row[1:]] = row[1:]
            if len(pairs) > 10_000:
                yield _pairs(pairs)
                pairs = []
        pairs += emit(list(rows.values()))
        yield _pairs(pairs)

    return rows.mapInArrow(traverse, _PAIR)


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _forest(rows: list[tuple]) -> list[tuple[int, int]]:
    """Candidate pairs of one node that connect all that candidate pairs can connect; rows ``(rep, n, bits)``."""
    if len(rows) < 2:
        return []
    parent: dict[int, int] = {r[0]: r[0] for r in rows}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    top = tree.build([tree.leaf(*r) for r in rows])
    for x, y in tree.candidates(top, top, lambda p, q: root(p.id) == root(q.id)):
        a, b = sorted((x.id, y.id))
        parent[max(root(a), root(b))] = min(root(a), root(b))
        out.append((a, b))
    return out


def _across(rows: list[tuple]) -> list[tuple[int, int]]:
    """All candidate pairs of different components; rows ``(side, component, key, keys, rep, n, bits)``.

    Rows of side 0 meet those of side 1, rows of side 2 meet one another.  Of pairs that share several ``keys`` only
    those whose least is ``key`` count (all, if there are no keys).
    """
    out = set()
    sides: dict[int, list[tree.Node]] = {}
    keys_of: dict[int, frozenset[int]] = {}
    for side, component, _, keys, rep, n, bits in rows:
        sides.setdefault(side, []).append(tree.leaf(rep, n, bits, component))
        keys_of[rep] = frozenset(keys)
    key = rows[0][2] if rows else None
    tops = {side: tree.build(leaves) for side, leaves in sides.items()}
    for x, y in ((0, 1), (2, 2)):
        if x in tops and y in tops:
            for p, q in tree.candidates(tops[x], tops[y], lambda p, q: p.part == q.part):
                shared = keys_of[p.id] & keys_of[q.id]
                if not shared or min(shared) == key:
                    out.add((min(p.id, q.id), max(p.id, q.id)))
    return sorted(out)


def verified(docs: DataFrame, pairs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Those of ``pairs`` (``a < b``) whose sets link, by the exact sets; staged."""
    degree = staged(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(PLACE)).alias("places")), "ngram_places")
    to_b = pairs.join(degree, "a").select(
        F.col("b").alias("doc_id"), "a", F.pmod(F.xxhash64("b"), F.col("places")).alias("place"), F.lit(1).alias("other"))
    to_a = degree.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("places") - 1)).alias("place"), F.lit(0).alias("other"))
    orders = staged(to_b.unionByName(to_a), "ngram_orders")

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            texts = batch.column(3).dictionary_encode()  # a text that goes to several places is hashed once
            found = [s.tobytes() for s in shingle_sets(texts.dictionary, width)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], batch.column(4),
                 pa.array([None if i is None else found[i] for i in texts.indices.to_pylist()], pa.binary())],
                names=["a", "place", "other", "doc_id", "tokens"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own = None, []
        for batch in batches:
            pairs = []
            for a, place, other, b, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, place) != here:
                    here, own = (a, place), []
                s = np.frombuffer(tokens or b"", np.uint64)
                if not other:
                    own.append(s)
                elif any(_links(s, o) for o in own):
                    pairs.append((a, b))
            yield _pairs(pairs)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shipped = texts.join(bounded(orders, ORDERS), "doc_id").select("a", "place", "other", "text", "doc_id") \
        .mapInArrow(ship, "a long, place long, other int, doc_id long, tokens binary")
    return staged(shipped.repartition("a", "place").sortWithinPartitions("a", "place", "other")
                  .mapInArrow(compare, _PAIR).distinct(), "ngram_links")


def _links(x: np.ndarray, y: np.ndarray) -> bool:
    if 4 * len(x) < 3 * len(y) or 4 * len(y) < 3 * len(x) or not len(x):
        return False
    common = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * common >= 75 * (len(x) + len(y) - common)


def _roots(nodes: DataFrame, bits: DataFrame) -> DataFrame:
    """``key, part, dom, low, high, excess, bits``: the root of every node; staged."""
    rows = nodes.join(bits, "rep").select("key", "part", "dom", "rep", "n", "bits") \
        .repartition("key", "part", "dom").sortWithinPartitions("key", "part", "dom")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, leaves = None, []

        def root() -> pa.RecordBatch:
            top = tree.combine(leaves)
            return pa.RecordBatch.from_pydict({
                "key": [here[0]], "part": [here[1]], "dom": [here[2]], "low": [top.low], "high": [top.high],
                "excess": [top.excess], "bits": [top.bits.to_bytes(top.width // 8, "little")]})

        for batch in batches:
            for key, part, dom, rep, n, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, part, dom) != here:
                    if leaves:
                        yield root()
                    here, leaves = (key, part, dom), []
                leaves.append(tree.leaf(rep, n, packed))
        if leaves:
            yield root()

    return staged(rows.mapInArrow(
        combine, "key long, part long, dom boolean, low long, high long, excess long, bits binary"), "ngram_roots")


def _frequent_pairs(hot: DataFrame, bits: DataFrame) -> DataFrame:
    """Candidates between (and, but for the largest component, inside) the nodes of frequent keys.

    ``hot`` has ``key, rep, n, c, component``.
    """
    keys = staged(hot.groupBy("rep").agg(F.sort_array(F.collect_set("key")).alias("keys")), "ngram_hot_keys_of")
    by_component = hot.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
    largest = by_component.groupBy("key").agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("total")) \
        .where("total > top.m").select("key", F.col("top.component").alias("largest"), F.col("top.m").alias("m"), "total")
    marked = hot.join(bounded(staged(largest, "ngram_largest")), "key") \
        .withColumn("dom", F.col("component") == F.col("largest")) \
        .withColumn("c", F.when(F.col("dom"), F.col("m")).otherwise(F.col("total") - F.col("m")))
    nodes = staged(marked.select("key", _part("c", MEETING_NODE).alias("part"), "dom", "rep", "component"), "ngram_hot_nodes")
    roots = _roots(nodes, bits)
    left, right = roots.select([F.col(c).alias(f"l_{c}") for c in roots.columns]), roots
    near = F.abs(F.shiftright("l_part", 32) - F.shiftright("part", 32)) <= 1
    met = left.join(right, (F.col("l_key") == F.col("key")) & near & ~(F.col("l_dom") & F.col("dom"))
                    & (F.struct("l_part", "l_dom") <= F.struct("part", "dom")))

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for r in batch.to_pylist():
                x, y = (tree.Node(int.from_bytes(r[p + "bits"], "little"), 8 * len(r[p + "bits"]), r[p + "low"],
                                  r[p + "high"], r[p + "excess"], [], []) for p in ("l_", ""))
                keep.append(tree.may_link(x, y))
            yield batch.select(["key", "l_part", "l_dom", "part", "dom"]).filter(pa.array(keep, pa.bool_()))

    kept = staged(met.mapInArrow(prune, "key long, l_part long, l_dom boolean, part long, dom boolean")
                  .withColumn("node", F.xxhash64("key", "l_part", "l_dom", "part", "dom")), "ngram_node_pairs")
    same = (F.col("l_part") == F.col("part")) & (F.col("l_dom") == F.col("dom"))
    first = kept.select("node", "key", F.col("l_part").alias("part"), F.col("l_dom").alias("dom"),
                        F.when(same, 2).otherwise(0).cast("long").alias("side"))
    second = kept.where(~same).select("node", "key", "part", "dom", F.lit(1).cast("long").alias("side"))
    rows = first.unionByName(second).join(nodes, ["key", "part", "dom"]).join(keys, "rep") \
        .select("node", "side", "component", "key", "keys", "rep")
    return _in_nodes(rows, bits, _across, _ACROSS)


def linked_components(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the smallest id that links reach)."""
    found = sets(docs, width)
    own = found.where("n > 0 and doc_id is not null")
    classes = staged(own.groupBy("c1", "c2").agg(F.min(F.struct("doc_id", "n", "keys")).alias("s"))
                     .select("c1", "c2", "s.*"), "ngram_classes")
    bits = staged(own.select(F.col("doc_id").alias("rep"), "n", "bits", "c1", "c2")
                  .join(classes.select(F.col("doc_id").alias("rep"), "c1", "c2"), ["rep", "c1", "c2"], "left_semi")
                  .select("rep", "n", "bits").distinct(), "ngram_bits")
    members = _members(classes)

    # the distinct nodes of all keys, then a forest of candidates in each and one candidate between a key's nodes
    nodes = members.groupBy("key", "part").agg(F.sort_array(F.collect_set("rep")).alias("reps")) \
        .where(F.size("reps") > 1).select("reps").distinct()
    nodes = staged(nodes.select(F.xxhash64("reps").alias("node"), F.explode("reps").alias("rep")), "ngram_nodes")
    hot = members.where("part >= 0").withColumn("size_class", _size_class())
    leaders = hot.groupBy("key", "size_class", "part").agg(F.min("rep").alias("b"))
    leaders = leaders.join(hot.groupBy("key", "size_class").agg(F.min("rep").alias("a")), ["key", "size_class"])
    forest = staged(_in_nodes(nodes, bits, _forest, []).unionByName(leaders.where("a < b").select("a", "b")).distinct(),
                    "ngram_forest")
    links = verified(docs, forest, width)

    # rows that share an id are one document
    with_class = own.select("doc_id", "c1", "c2").join(
        classes.select(F.col("doc_id").alias("rep"), "c1", "c2"), ["c1", "c2"]).select("doc_id", "rep")
    with_class = staged(with_class.distinct(), "ngram_documents")
    several = with_class.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("doc_id")
    by_id = staged(with_class.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")),
                   "ngram_shared_ids")
    links = links.unionByName(by_id)

    # second traversal: what the first components leave apart
    named = components(links).select(F.col("node").alias("rep"), "component")
    placed = members.join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    apart = nodes.join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = staged(apart.groupBy("node").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                   .where("x <> y").select("node"), "ngram_mixed")
    inside = apart.join(mixed, "node", "left_semi").select(
        "node", F.lit(2).cast("long").alias("side"), "component", F.lit(0).cast("long").alias("key"),
        F.array().cast("array<long>").alias("keys"), "rep")
    frequent = _frequent_pairs(placed.where("part >= 0").select("key", "rep", "n", "c", "component"), bits)
    more = staged(_in_nodes(inside, bits, _across, _ACROSS).unionByName(frequent).distinct()
                  .join(forest, ["a", "b"], "left_anti"), "ngram_candidates")
    everything = components(links.unionByName(verified(docs, more, width)))

    component = everything.select(F.col("node").alias("rep"), "component")
    by_class = classes.select("c1", "c2", F.col("doc_id").alias("rep")).join(component, "rep", "left") \
        .select("c1", "c2", F.coalesce("component", "rep").alias("component_id"))
    by_class = staged(by_class, "ngram_components")
    return found.join(by_class, ["c1", "c2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"))


def deduplicate(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the document of smallest id of each component (and rows without an id); its columns only."""
    found = linked_components(docs, width).where("doc_id <> component_id")
    gone = staged(found.select(F.col("doc_id").alias("gone_id")).distinct(), "ngram_gone")
    key = unused(docs, "gone_id")
    gone = bounded(gone.withColumnRenamed("gone_id", key))
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(key), "left_anti")
