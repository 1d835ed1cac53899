"""Conversation structure repair: faults of the rows, and the cheapest edits that make the roles a sentence of a grammar.

A row's first fault counts: blank (no word character), duplicate (role and text seen earlier in its conversation),
truncated (its last character other than white space ends no sentence).  Blank and duplicate rows must be deleted (4);
other rows are kept (0), given another role (3) or deleted (4); a truncated row that stays adds 3; rows without text
are inserted (3).  ``role_parser`` finds the least (cost, audit) by a generalised LR parse on a graph-structured stack.

No task needs a whole conversation.  Equal rows of a turn are counted, not carried; a row's first appearance comes from
an aggregate and a join by content.  The slim rows (digests, no texts) are dealt into ranges of (conversation, turn), so
a conversation with a third of all rows covers many partitions.  Each range is read in order, one row at a time; a
conversation's part in it is a run.  A run that may continue an earlier one is parsed from every top that rows can
leave, of which a role grammar has few, and is a small table ``start, top, cost, audit``.  The runs of a conversation
are then joined (there are at most as many as ranges), and the edits meet their rows, and these their texts, in
joins on whole keys.  Only a digest of a whole conversation, as the query asks for, must by its nature read the
conversation in one task, which it does row by row.

Rows are taken by turn, nulls first, then by role and content (``role`` and a SHA-256 of role and text).

Defined results: a null role or text counts as empty; null conversation ids are one conversation.  Roles whose initial
is no terminal can be given another one or deleted.  A conversation without rows, or whose rows all go, is empty.
Several rows of a turn are no fault; gaps count the missing turns between least and largest.  Texts are whole, of any
length.  An empty table gives none, and other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import staged
from aurum.llm.role_parser import Repairer, Run, joined

#: Names of the roles that rows may be given, by initial.
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
SPACE = " \t\n\x0b\f\r"
ENDS = ".!?"

_FOUND = ("conv_key string, run long, at long, turn long, content binary, rows long, blank long, duplicate long, truncated long,"
          " illegal long, first string, last string, least long, most long, turns long,"
          " ends array<struct<start: int, top: int, cost: long, audit: string, made: string>>")
_ENDS = "cost: long, parts: array<struct<audit: string, made: string>>"


def _keyed(rows: DataFrame) -> DataFrame:
    """``conv_key, turn, role, text, content``: keys without nulls but ``turn``; content is a digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_key"),
                       F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       content.alias("content"))


def _slim(keyed: DataFrame) -> DataFrame:
    """One row for each turn and content of a conversation: ``copies``, the fault of its first copy, whether it is the first."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(trimmed == "", "blank").when(~F.substring(trimmed, -1, 1).isin(list(ENDS)), "truncated").otherwise("")
    counted = keyed.select("conv_key", "turn", "role", "content", fault.alias("fault")) \
        .groupBy("conv_key", "turn", "role", "content", "fault").agg(F.count(F.lit(1)).alias("copies"))
    counted = staged(counted, "repair_slim")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = counted.groupBy("conv_key", "content").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    again = first.where("n > 1").select("conv_key", "content", "first")
    return counted.join(again, ["conv_key", "content"], "left") \
        .withColumn("seen", F.col("first").isNotNull() & (F.col("first") != order)).drop("first")


def _runs(slim: DataFrame) -> DataFrame:
    """Rows with their run and place, and one summary for each run (``rows`` is not null); staged."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer, run, first = _repairer(), TaskContext.get().partitionId(), True
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in (
            "conv_key", "turn", "role", "content", "copies", "fault", "seen")), strict=True))
        out: list[dict] = []
        for conv, own in groupby(rows, key=lambda r: r[0]):
            for record in _run(repairer, conv, run, own, repairer.tops if first else repairer.tops[:1]):
                out.append(record)
                if len(out) == 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            first = False
        yield pa.RecordBatch.from_pylist(out, schema)

    schema = _arrow_schema()
    dealt = slim.repartitionByRange("conv_key", F.col("turn").asc_nulls_first(), "role", "content") \
        .sortWithinPartitions("conv_key", F.col("turn").asc_nulls_first(), "role", "content")
    return staged(dealt.mapInArrow(parsed, _FOUND), "repair_runs")


def _arrow_schema() -> pa.Schema:
    long, text = pa.int64(), pa.string()
    ends = pa.list_(pa.struct([("start", pa.int32()), ("top", pa.int32()), ("cost", long), ("audit", text), ("made", text)]))
    kinds = {"conv_key": text, "content": pa.binary(), "first": text, "last": text, "ends": ends}
    names = ("conv_key", "run", "at", "turn", "content", "rows", "blank", "duplicate", "truncated", "illegal", "first",
             "last", "least", "most", "turns", "ends")
    return pa.schema([(n, kinds.get(n, long)) for n in names])


def _run(repairer: Repairer, conv: str, run: int, rows: Iterable[tuple], starts: list[int]) -> Iterator[dict]:
    """The rows of a run with their places, then its summary."""
    parses = {s: Run(repairer, s) for s in starts}
    n = blank = duplicate = truncated = illegal = turns = 0
    head = last = least = most = None
    for _, turn, role, content, copies, fault, seen in rows:
        yield {"conv_key": conv, "run": run, "at": n, "turn": turn, "content": content}
        initial = role[:1]
        for parse in parses.values():
            parse.row(initial, fault == "blank" or seen, fault == "truncated", copies)
        if fault == "blank":
            blank += copies
        else:
            duplicate += copies - (not seen)
            truncated += fault == "truncated" and not seen
        illegal += (n > 0 and last + initial not in LEGAL) + (copies - 1) * (initial * 2 not in LEGAL)
        if turn is not None and turn != most:
            least, most, turns = turn if least is None else least, turn, turns + 1
        head, last, n = initial if head is None else head, initial, n + copies
    yield {"conv_key": conv, "run": run, "rows": n, "blank": blank, "duplicate": duplicate, "truncated": truncated,
           "illegal": illegal, "first": head, "last": last, "least": least, "most": most, "turns": turns,
           "ends": [dict(zip(("start", "top", "cost", "audit", "made"), (s, *end), strict=True))
                    for s, parse in parses.items() for end in parse.ends()]}


@lru_cache(maxsize=1)
def _repairer() -> Repairer:
    """One for each worker process: its tables are the same for all conversations."""
    return Repairer()


def _joined(runs: list) -> tuple[int, list[tuple[str, str]]]:
    return joined(_repairer(), [[tuple(end) for end in run] for run in runs])


def audits(found: DataFrame) -> DataFrame:
    """``conv_key``, counts and ``cost, audit`` for each conversation with rows, and ``parts``, its runs' shares; staged."""
    runs = F.sort_array(F.collect_list(F.struct("run", "first", "last", "least", "most", "turns", "ends"))).alias("runs")
    sums = [F.sum(c).alias(c) for c in ("rows", "blank", "duplicate", "truncated", "illegal")]
    one = found.where("rows IS NOT NULL").groupBy("conv_key").agg(*sums, runs)
    seams = F.expr(f"""aggregate(sequence(1, size(runs)), 0L, (n, i) -> n + if(i < size(runs) AND
        concat(runs[i - 1].last, runs[least(i, size(runs) - 1)].first) NOT IN {LEGAL}, 1L, 0L))""")
    shared = F.expr("""aggregate(sequence(1, size(runs)), 0L, (n, i) -> n + if(i < size(runs) AND
        coalesce(runs[i - 1].most = runs[least(i, size(runs) - 1)].least, false), 1L, 0L))""")
    span = F.expr("array_max(runs.most) - array_min(runs.least) + 1")
    turns = F.expr("aggregate(runs.turns, 0L, (n, t) -> n + t)") - shared
    cheapest = F.udf(_joined, f"struct<{_ENDS}>", useArrow=False)
    best = one.withColumn("best", cheapest("runs.ends")) \
        .select("conv_key", F.coalesce(span - turns, F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated",
                (F.col("illegal") + seams).alias("illegal"), F.col("best.cost").alias("cost"),
                F.expr("array_join(best.parts.audit, '')").alias("audit"),
                F.expr("transform(best.parts, (p, i) -> struct(runs[i].run AS run, p.audit AS audit, p.made AS made))")
                .alias("parts"))
    return staged(best, "repair_audits")


def _edits(audited: DataFrame) -> DataFrame:
    """``conv_key, run, at, position, edit, initial``: rows that stay (with their place) and rows inserted (without)."""
    share = audited.select("conv_key", F.expr("""transform(parts, (p, i) -> struct(p.run AS run, p.audit AS audit, p.made AS made,
        aggregate(slice(parts, 1, i), 0L, (n, q) -> n + length(q.made)) AS before))""").alias("parts")) \
        .select("conv_key", F.explode("parts").alias("p")).select("conv_key", "p.*")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv_key", "run", "at", "position", "edit", "initial")
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for b in batches:
            for conv, run, audit, made, before in zip(*(b.column(c).to_pylist() for c in (
                    "conv_key", "run", "audit", "made", "before")), strict=True):
                at = done = 0
                for edit in audit:
                    if edit != "D":
                        out.append((conv, run, None if edit == "I" else at, before + done, edit, made[done]))
                        done += 1
                    at += edit != "I"
                    if len(out) == 10_000:
                        yield batch()
                        out.clear()
        yield batch()

    return share.mapInArrow(spread, "conv_key string, run long, at long, position long, edit string, initial string")


def _repaired(keyed: DataFrame, found: DataFrame, audited: DataFrame) -> DataFrame:
    edits = staged(_edits(audited), "repair_edits")
    name = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[F.col("initial")]
    inserted = edits.where("edit = 'I'").select("conv_key", "position", name.alias("role"), F.lit("").alias("text"), "edit")
    kept = edits.where("edit <> 'I'").join(found.where("rows IS NULL"), ["conv_key", "run", "at"]) \
        .select("conv_key", F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn_key"), "content", "position",
                "edit", name.alias("new_role"))
    texts = keyed.groupBy("conv_key", F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn_key"), "content") \
        .agg(F.first("role").alias("old_role"), F.first("text").alias("text"))
    role = F.when(F.col("edit") == "R", F.col("new_role")).otherwise(F.col("old_role"))
    return kept.join(texts, ["conv_key", "turn_key", "content"]) \
        .select("conv_key", "position", role.alias("role"), "text", "edit").unionByName(inserted)


def repair(rows: DataFrame) -> DataFrame:
    """``conv_key, position, role, text, edit``: the rows of the repaired conversations (``conv_key``: the id as text)."""
    keyed = _keyed(rows)
    found = _runs(_slim(keyed))
    return _repaired(keyed, found, audits(found))


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_key, repaired_sha256`` of the rows ``role:text``, joined by newlines; rows are read in order, one by one."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, hashes = [], []
        rows = (r for b in batches for r in zip(*(b.column(c) for c in ("conv_key", "role", "text")), strict=True))
        for conv, own in groupby(rows, key=lambda r: r[0].as_py()):
            h, between = hashlib.sha256(), b""
            for _, role, text in own:
                h.update(between + f"{role.as_py()}:{text.as_py()}".encode())
                between = b"\n"
            keys.append(conv)
            hashes.append(h.hexdigest())
        yield pa.RecordBatch.from_pydict({"conv_key": pa.array(keys, pa.string()), "repaired_sha256": pa.array(hashes, pa.string())})

    ordered = repaired.select("conv_key", "position", "role", "text") \
        .repartition("conv_key").sortWithinPartitions("conv_key", "position")
    return ordered.mapInArrow(digest, "conv_key string, repaired_sha256 string")


def verdicts(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Counts, cost, audit and digest for every id of ``conversations``, whose rows are now ``rows`` (or missing)."""
    keyed = _keyed(rows)
    found = _runs(_slim(keyed))
    audited = audits(found)
    hashed = digests(_repaired(keyed, found, audited))
    ids = conversations.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_key")).distinct()
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(audited.drop("parts"), "conv_key", "left").join(hashed, "conv_key", "left") \
        .select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by a hash of id and turn; nulls of role and text become a space."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")
