"""Data contracts: evaluation, clean/quarantine split, scorecard and checks."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum import config as C
from aurum.config import DomainConfig, LITERACY
from aurum.functions import rules as R
from aurum.functions.literals import literal_frame
from aurum.functions.normalize import normalize
from aurum.functions.rounding import pct
from aurum.operators.joins import maybe_broadcast

REASON = "rejection_reason"
QUARANTINE_TS = "_quarantine_timestamp"


def measure_types(cfg: DomainConfig = LITERACY) -> dict[str, str]:
    return {cfg.year_col: "int", cfg.score_col: "double", cfg.rate_col: "double", cfg.target_col: "double"}


def type_measures(df: DataFrame, cfg: DomainConfig = LITERACY) -> tuple[DataFrame, dict]:
    """``try_cast`` the text-typed measure columns; ``_type_bad`` flags values that did not convert."""
    casts = {c: t for c, t in measure_types(cfg).items()
             if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)}
    bad = F.lit(False)
    for c, t in casts.items():
        bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
    out = df.withColumn("_type_bad", bad)
    if casts:
        out = out.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})
    return out, casts


def evaluate(df: DataFrame, cfg: DomainConfig = LITERACY) -> DataFrame:
    """Add ``rejection_reason`` (null = conforming), then normalise the keys.

    Text-typed measure columns (a CSV fall-back lands every column as text)
    are typed first with ``try_cast``; a value that is present but does not
    convert is rejected with the type reason instead of failing the job.
    Priority: malformed message > completeness > type > accuracy > validity.
    With ``cfg.strict_validity`` the id rule sees the raw id; otherwise the id
    is padded first, as the published code does (where the rule cannot fail).
    """
    df, casts = type_measures(df, cfg)
    if not cfg.strict_validity:
        df = normalize(df, cfg)
    reason = R.rejection_reason(cfg)
    if casts:
        reason = (F.when(~R.completeness(cfg), F.lit(C.REASON_COMPLETENESS))
                  .when(F.col("_type_bad"), F.lit(C.REASON_TYPE))
                  .otherwise(reason))
    if "_corrupt_record" in df.columns:   # parsed messages: a malformed one is rejected as such
        reason = F.when(F.col("_corrupt_record").isNotNull(), F.lit(C.REASON_MALFORMED)).otherwise(reason)
    flagged = df.withColumn(REASON, reason).drop("_type_bad")
    return normalize(flagged, cfg) if cfg.strict_validity else flagged


def split(df: DataFrame, cfg: DomainConfig = LITERACY,
          stamp: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine); every input row is in exactly one of them."""
    flagged = evaluate(df, cfg)
    clean = flagged.where(F.col(REASON).isNull()).drop(REASON)
    quarantine = flagged.where(F.col(REASON).isNotNull())
    if stamp:
        quarantine = quarantine.withColumn(QUARANTINE_TS, F.current_timestamp())
    return clean, quarantine


def violation_flags(cfg: DomainConfig = LITERACY) -> dict[str, Column]:
    return {
        "completeness": ~R.completeness(cfg),
        "accuracy": ~R.accuracy(cfg),
        "validity": ~R.validity(cfg),
    }


def scorecard(df: DataFrame, cfg: DomainConfig = LITERACY, keys=None) -> DataFrame:
    """One row: per-rule violation counts, duplicate keys, quarantine rate.

    Rules are counted independently (a row may break several).  Uniqueness
    is computed by a partial aggregation on the key, so a hot key costs one
    row per map task at the shuffle.
    """
    keys = list(keys or cfg.key_cols)
    df, casts = type_measures(df, cfg)
    flags = {"type": F.col("_type_bad"), **violation_flags(cfg)}
    reason = R.rejection_reason(cfg)
    if casts:
        reason = F.when(F.col("_type_bad"), F.lit(C.REASON_TYPE)).otherwise(reason)
    per_key = (df.select(*keys, *[f.cast("int").alias(n) for n, f in flags.items()],
                         reason.isNotNull().cast("int").alias("_rej"))
                 .groupBy(*keys)
                 .agg(F.count(F.lit(1)).alias("_n"),
                      *[F.sum(n).alias(n) for n in flags],
                      F.sum("_rej").alias("_rej")))
    key_ok = R.completeness(cols=keys)
    out = per_key.agg(
        F.sum("_n").alias("rows_input"),
        *[F.sum(n).cast("bigint").alias(f"{n}_violations") for n in flags],
        F.sum(F.when(key_ok & (F.col("_n") > 1), 1).otherwise(0)).cast("bigint").alias("duplicate_keys"),
        F.sum(F.when(key_ok, F.col("_n") - 1).otherwise(0)).cast("bigint").alias("duplicate_rows"),
        F.sum("_rej").cast("bigint").alias("rows_quarantined"),
    )
    return out.withColumn("quarantine_rate_pct",
                          F.coalesce(pct("rows_quarantined", "rows_input"), F.lit(0.0)))


def six_dimensions(df: DataFrame, codes: DataFrame, code_expr: Column, event_ts, write_ts, cfg: DomainConfig = LITERACY,
                   keys=None, code_col: str = "code", late_after_s: int = 3600, max_codes: int = 10_000) -> DataFrame:
    """One row: rows that break completeness, accuracy, validity, uniqueness, consistency and timeliness, and their shares.

    Consistency compares the code inside the id (``code_expr``) with the group's code in ``codes``, joined as a
    broadcast once its size is checked; timeliness compares event and write time; a row whose code or lag is unknown
    breaks the rule.  All six come out of one aggregation by key and one over the keys.
    """
    keys = list(keys or cfg.key_cols)
    table = codes.select(F.col(cfg.group_col), F.col(code_col).alias("_expected"))
    joined = df.join(maybe_broadcast(table, max_codes), cfg.group_col, "left")
    flags = {**violation_flags(cfg),
             "consistency": ~R.total(code_expr == F.col("_expected")),
             "timeliness": ~R.total(lag_seconds(event_ts, write_ts) <= late_after_s)}
    per_key = joined.select(*keys, *[f.cast("int").alias(n) for n, f in flags.items()]) \
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(n).alias(n) for n in flags])
    repeated = F.when(R.completeness(cols=keys), F.col("_n") - 1).otherwise(0)
    out = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_input"),
                      *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(f"{n}_violations") for n in flags],
                      F.coalesce(F.sum(repeated), F.lit(0)).cast("bigint").alias("uniqueness_violations"))
    names = ("completeness", "accuracy", "validity", "uniqueness", "consistency", "timeliness")
    return out.select("rows_input", *[f"{n}_violations" for n in names],
                      *[(F.lit(100.0) - F.coalesce(pct(f"{n}_violations", "rows_input"), F.lit(0.0))).alias(f"{n}_pct")
                        for n in names])


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count (uniqueness check)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def consistency(df: DataFrame, codes: DataFrame, code_expr: Column,
                group_col: str, code_col: str = "code",
                max_codes: int = 10_000) -> DataFrame:
    """Flag rows whose id-embedded code differs from the group's numeric code.

    ``codes`` maps ``group_col`` to ``code_col`` (e.g. state -> IBGE code);
    it is broadcast only after its size is checked.
    """
    table = codes.select(F.col(group_col), F.col(code_col).alias("_expected_code"))
    joined = df.withColumn("_id_code", code_expr).join(
        maybe_broadcast(table, max_codes), group_col, "left")
    return (joined
            .withColumn("consistent", R.total(F.col("_id_code") == F.col("_expected_code")))
            .withColumnRenamed("_id_code", "id_code")
            .withColumnRenamed("_expected_code", "expected_code"))


def state_code_table(spark, codes=C.IBGE_STATE_CODES, group_col: str = "sigla_uf") -> DataFrame:
    """The fixed state-code directory as a DataFrame (27 rows)."""
    return literal_frame(spark, list(codes), f"{group_col} string, code int")


def lag_seconds(event_ts, write_ts) -> Column:
    """Whole elapsed seconds between event time and write time."""
    e = F.col(event_ts) if isinstance(event_ts, str) else event_ts
    w = F.col(write_ts) if isinstance(write_ts, str) else write_ts
    return F.timestamp_diff("SECOND", e, w)


def timeliness(df: DataFrame, event_ts: str, write_ts, by=(), late_after_s: int = 3600,
               approx_quantiles: bool = False) -> DataFrame:
    """Lag between event and write per group: count, min, max, mean, late share.

    ``approx_quantiles`` adds sketch-based p50/p95 (bounded memory per group).
    """
    lag = lag_seconds(event_ts, write_ts)
    aggs = [
        F.count(F.lit(1)).alias("n_events"),
        F.min("_lag").alias("min_lag_s"),
        F.max("_lag").alias("max_lag_s"),
        F.round(F.avg("_lag").cast("decimal(24,6)"), 2).cast("double").alias("avg_lag_s"),
        F.sum(F.when(F.col("_lag") > late_after_s, 1).otherwise(0)).cast("bigint").alias("late_events"),
    ]
    if approx_quantiles:
        aggs.append(F.percentile_approx("_lag", [0.5, 0.95], 10000).alias("lag_p50_p95"))
    return df.select(*by, lag.alias("_lag")).groupBy(*by).agg(*aggs)


#: Significant bits of a stored lag: a bucket is less than 1/32 of its lag wide, lags below 64 seconds are exact.
SKETCH_BITS = 6


def lag_sketch(df: DataFrame, event_ts, write_ts, by=()) -> DataFrame:
    """A mergeable sketch of the lags: ``by, low, n``, the number of lags in each bucket.

    A bucket holds the lags that share their ``SKETCH_BITS`` leading bits (negative ones apart), so a group has at most
    about 4,000 rows however many events it has, and the rows do not depend on the order of events.
    """
    lag = lag_seconds(event_ts, write_ts)
    size = F.abs(lag)
    drop = f"greatest(length(bin(_size)) - {SKETCH_BITS}, 0)"
    rows = df.select(*by, lag.alias("_lag"), size.alias("_size")).where("_lag IS NOT NULL")
    low = F.expr(f"shiftleft(shiftright(_size, {drop}), {drop})")
    return rows.select(*by, F.when(F.col("_lag") < 0, -low).otherwise(low).alias("low")) \
        .groupBy(*by, "low").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(sketches: DataFrame, by=()) -> DataFrame:
    """One sketch out of those of many batches (or parts): the counts of a bucket add up."""
    return sketches.groupBy(*by, "low").agg(F.sum("n").alias("n"))


def sketch_percentiles(sketch: DataFrame, by=(), percentages=(0.5, 0.95, 0.99)) -> DataFrame:
    """``by, n_events`` and a percentile each (``p50_s`` ...): the bucket that holds the lag of that rank.

    The rank is exact; the value is the bucket's end nearer to zero, so it is off by less than 1/32 of the lag.
    """
    by = list(by)
    order = Window.partitionBy(*by).orderBy("low").rowsBetween(Window.unboundedPreceding, 0)
    upto = sketch.withColumn("_upto", F.sum("n").over(order)) \
        .withColumn("_all", F.sum("n").over(Window.partitionBy(*by)))
    wanted = [F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(p)), F.col("low"))).alias(f"p{round(p * 100)}_s")
              for p in percentages]
    return upto.groupBy(*by).agg(F.max("_all").alias("n_events"), *wanted)


def schema_from_json(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def schema_contract(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Check a table against a declared schema, in one pass over the data.

    One row per declared field: expected and actual type, whether the field
    is present with that type, its null count, and a status
    (OK / MISSING / TYPE_MISMATCH / NULL_VIOLATION).  Undeclared columns are
    reported as EXTRA.
    """
    actual = {f.name: f for f in df.schema.fields}
    present = [f for f in expected.fields if f.name in actual]
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(f.name).isNull()).alias(f"_null_{i}")
                      for i, f in enumerate(present)])
    rows = []
    for i, f in enumerate(present):
        a = actual[f.name]
        rows.append(F.struct(
            F.lit(f.name).alias("field"),
            F.lit(f.dataType.simpleString()).alias("expected_type"),
            F.lit(a.dataType.simpleString()).alias("actual_type"),
            F.lit(a.dataType == f.dataType).alias("type_ok"),
            F.lit(f.nullable).alias("nullable"),
            F.col(f"_null_{i}").alias("null_count"),
        ))
    for f in expected.fields:
        if f.name not in actual:
            rows.append(F.struct(F.lit(f.name).alias("field"),
                                 F.lit(f.dataType.simpleString()).alias("expected_type"),
                                 F.lit(None).cast("string").alias("actual_type"),
                                 F.lit(False).alias("type_ok"),
                                 F.lit(f.nullable).alias("nullable"),
                                 F.lit(None).cast("bigint").alias("null_count")))
    declared = {f.name for f in expected.fields}
    for name, a in actual.items():
        if name not in declared:
            rows.append(F.struct(F.lit(name).alias("field"),
                                 F.lit(None).cast("string").alias("expected_type"),
                                 F.lit(a.dataType.simpleString()).alias("actual_type"),
                                 F.lit(False).alias("type_ok"),
                                 F.lit(True).alias("nullable"),
                                 F.lit(None).cast("bigint").alias("null_count")))
    out = counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    status = (F.when(F.col("actual_type").isNull(), F.lit("MISSING"))
              .when(F.col("expected_type").isNull(), F.lit("EXTRA"))
              .when(~F.col("type_ok"), F.lit("TYPE_MISMATCH"))
              .when(~F.col("nullable") & (F.col("null_count") > 0), F.lit("NULL_VIOLATION"))
              .otherwise(F.lit("OK")))
    return out.withColumn("status", status)


def typed(df: DataFrame, casts: dict[str, str], keep_raw: bool = False,
          required=()) -> DataFrame:
    """Strict typing: ``try_cast`` each column; a failed cast is a quarantine reason.

    ``casts`` maps column -> target type.  A value that is present but does not
    convert sets ``rejection_reason`` to the type reason (completeness of the
    ``required`` columns is checked first).
    """
    cols = {}
    failed = F.lit(False)
    for c, t in casts.items():
        v = F.col(c).try_cast(t)
        failed = failed | (F.col(c).isNotNull() & v.isNull())
        cols[c] = v
        if keep_raw:
            cols[f"_raw_{c}"] = F.col(c)
    incomplete = F.lit(False)
    for c in required:
        incomplete = incomplete | F.col(c).isNull()
    reason = (F.when(incomplete, F.lit(C.REASON_COMPLETENESS))
              .when(failed, F.lit(C.REASON_TYPE)))
    # the reason must see the raw values, so it is added before the casts
    return df.withColumn(REASON, reason).withColumns(cols)
