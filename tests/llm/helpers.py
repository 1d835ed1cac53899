"""Small inputs for the corpus operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def documents(spark, rows, extra=False):
    """``rows`` of ``(doc_id, text)`` or ``(doc_id, text, source)`` as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:  # names that the operators use for columns of their own
        for name in ("size", "word", "rank", "kept", "copies", "maybe", "component_id", "gone_id", "draw", "bits"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def noisy(base, changes, seed):
    """``base`` with some words replaced: a near copy."""
    rng = random.Random(seed)
    out = list(base)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"n{rng.randrange(10**6)}"
    return out
