"""Conversation repair against an exhaustive search over edits, row by row."""

import hashlib
import random
import re
import zlib

import pytest

from aurum.llm import conversation_repair, role_parser
from tools.compare import compare

ROWS = "conv_id long, turn long, role string, text string, copies int, run int, at int, fault int, conv_key int, audit int"
NEXT = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """Least (cost, audit) over all edit strings of ``(initial, must go, truncated)`` rows (costs far above the best are cut)."""
    def inserted(now):
        for _ in range(3):
            more = {state: set(paths) for state, paths in now.items()}
            for state, paths in now.items():
                for t in "ua":
                    if (state, t) in NEXT:
                        more.setdefault(NEXT[state, t], set()).update((c + 3, a + "I") for c, a in paths if not a.endswith("III"))
            now = more
        return now

    now = {"0": {(0, "")}}
    for initial, doomed, truncated in rows:
        new = {}
        for state, paths in inserted(now).items():
            for cost, audit in paths:
                new.setdefault(state, set()).add((cost + 4, audit + "D"))
                for t, price, edit in () if doomed else ((initial, 0, "K"), ("u", 3, "R"), ("a", 3, "R")):
                    if (state, t) in NEXT:
                        new.setdefault(NEXT[state, t], set()).add((cost + price + 3 * truncated, audit + edit))
        least = min(c for paths in new.values() for c, _ in paths)
        now = {state: set(sorted(p for p in paths if p[0] <= least + 9)[:200]) for state, paths in new.items()}
    now = inserted(now)
    return min(p for state in "0a" for p in now.get(state, ()))


def plain(rows):
    """The counts, cost, audit and digest of one conversation's rows ``(turn, role, text)``, and the repaired rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", hashlib.sha256(
        f"{len(r[1] or '')}:{r[1] or ''}{r[2] or ''}".encode()).digest()))
    rows = [(t, r or "", x or "") for t, r, x in rows]
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()), []
    turns = {t for t, _, _ in rows if t is not None}
    seen, faults = set(), []
    for _, role, text in rows:
        word = re.findall(r"[^\x20\x09-\x0d]", text)
        faults.append("blank" if not word else "duplicate" if (role, text) in seen else "truncated" if word[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest([(r[:1], f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(rows, faults)])
    out, at = [], 0
    for edit in audit:
        role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit != "D":
            out.append((role, "") if edit == "I" else (rows[at][1] if edit == "K" else role, rows[at][2]))
        at += edit != "I"
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), illegal, cost, audit, digest), out


def verdicts(spark, rows, ids=()):
    df = spark.createDataFrame([(*r, 0, 0, 0, 0, 0, 0) for r in rows], ROWS).repartition(3)
    all_ids = spark.createDataFrame([(i, None, None, None, 0, 0, 0, 0, 0, 0) for i in ids], ROWS).unionByName(df)
    got = conversation_repair.verdicts(all_ids, df).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def wanted(rows, ids=()):
    by_id = {i: [] for i in ids}
    for conv, *row in rows:
        by_id.setdefault(conv, []).append(tuple(row))
    return {conv: plain(own)[0] for conv, own in by_id.items()}


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", " ", "", "Tail. \n", "é.", None, "same. text"]
    return [(c, rng.choice([None, *range(n + 2)]), rng.choice(["system", "user", "assistant", "tool", "", None, "user"]),
             rng.choice(texts) if rng.random() < 0.6 else f"text {rng.randrange(10**6)}.")
            for c in range(conversations) for n in [rng.randrange(most)] for _ in range(n)]


@pytest.fixture()
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repairs_are_those_of_a_search(spark):
    rows = random_rows(1, 60, 9)
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (-3, 5, "user", "x" * 200_000 + "."), (-3, 9, "assistant", "b.")]
    assert verdicts(spark, rows, [1000, 1001]) == wanted(rows, [1000, 1001])


def test_a_conversation_over_many_ranges(spark, many_ranges):
    rng = random.Random(5)
    hot = [(7, t, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice([f"n{t}.", "again.", "cut", " "]))
           for t in range(150)] + [(7, 40, "user", "again.")] * 30
    rows = hot + random_rows(2, 12, 6)
    assert verdicts(spark, rows) == wanted(rows)


def test_repaired_rows(spark, many_ranges):
    rows = random_rows(3, 30, 8)
    df = spark.createDataFrame([(*r, 0, 0, 0, 0, 0, 0) for r in rows], ROWS)
    got = {}
    for r in sorted(conversation_repair.repair(df).collect(), key=lambda r: (r.conv_key, r.position)):
        assert r.position == len(got.setdefault(int(r.conv_key), []))
        got[int(r.conv_key)].append((r.role, r.text))
    by_id = {}
    for conv, *row in rows:
        by_id.setdefault(conv, []).append(tuple(row))
    assert got == {conv: out for conv, own in by_id.items() if (out := plain(own)[1])}


def test_no_rows(spark):
    assert verdicts(spark, []) == {}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert verdicts(spark, [], [4]) == {4: empty}


def test_damage(spark):
    rows = [(c, t, ["user", "assistant", None][t % 3], "One. Two! Three?" if c % 5 else None) for c in range(40) for t in range(5)]
    rows += [(None, None, "user", "a.")]
    got = conversation_repair.damaged(spark.createDataFrame([(*r, 0, 0, 0, 0, 0, 0) for r in rows], ROWS)).collect()
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_parser_of_another_grammar():
    """Calls and results in pairs: ``(u c* a)+`` with any number of ``c``."""
    parser = role_parser.Repairer((("C", ""), ("C", "B"), ("B", "P"), ("B", "BP"), ("P", "uLa"), ("L", ""), ("L", "Lc")), "uac")
    def cost(text):
        run = role_parser.Run(parser, 0)
        for t in text:
            run.row(t, False, False)
        return role_parser.joined(parser, [[(0, *e) for e in run.ends()]] if text else [])
    assert cost("") == (0, [])
    assert cost("uccaua") == (0, [("KKKKKK", "uccaua")])
    assert cost("cua") == (4, [("DKK", "ua")])
    assert cost("uc") == (3, [("KKI", "uca")])
    assert cost("ux") == (3, [("KR", "ua")])


def test_sql_agrees_on_larger_tables(spark):
    found = compare(spark, "/root/testdata/sf0.1", ["op13_conversation_repair"], verbose=False)["op13_conversation_repair"]
    assert "error" not in found and found["cols_ok"] and found["types_ok"] and found["values_ok"], found
