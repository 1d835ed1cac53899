"""The layered run: sources -> bronze -> silver (+ quarantine) -> gold.

Stages hand over through tables written under the shared folder, which also
cuts the lineage between stages (a lost executor recomputes from the last
written table, not from the raw sources).  Every count is read back from the
written table: a Parquet ``count()`` reads only file footers, and unlike an
accumulator it cannot be inflated by tasks that were re-run after a failure.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum import config as C
from aurum.config import DomainConfig, LITERACY
from aurum.functions import rules as R
from aurum.operators import gold as G
from aurum.operators.dedupe import latest_delivery, latest_per_key, order_column
from aurum.operators.joins import join_as_of, join_directory
from aurum.operators.merge import (
    ENVELOPE_SCHEMA, bucket_of, merge_into_buckets, merge_measurements, to_envelope, union_envelopes,
)
from aurum.operators.metrics import StageRun, quarantine_rate
from aurum.functions.normalize import normalize
from aurum.operators.quality import REASON, evaluate
from aurum.session import size_shuffles
from aurum.sinks.writers import overwrite_partitions, write_bronze, write_split, write_table
from aurum.sources.lineage import as_of_batch, make_batch_id, with_lineage
from aurum.sources.readers import read_bronze, read_declared
from aurum.streaming.events import run_available

#: Sources without which a run stops.
REQUIRED = ("metas_municipio",)

# Facts are partitioned by year (the usual filter) and clustered by group
# inside each file: a second partition level (year x state) multiplies small
# files, while sorted row groups still let min/max statistics skip data on a
# state filter.
GOLD_PARTITIONS = {
    "dim_tempo": ("ano",),
    "fato_indicador_alfabetizacao": ("ano",),
    "fato_metas_vs_resultado": ("ano",),
    "fato_metas_uf": ("ano",),
}
GOLD_CLUSTER = {
    "fato_indicador_alfabetizacao": ("sigla_uf", "id_municipio"),
    "fato_metas_vs_resultado": ("sigla_uf", "id_municipio"),
}


@dataclass
class Layers:
    root: str
    batch_id: str
    silver: DataFrame | None = None
    quarantine: DataFrame | None = None
    silver_schema: object = None
    bronze_schemas: dict = field(default_factory=dict)
    batch_silver: DataFrame | None = None   # the last incremental batch's silver rows
    gold: dict = field(default_factory=dict)
    metrics: list = field(default_factory=list)


def _write(df: DataFrame, path: str, partition_by=(), cluster_by=()):
    """Write a table and return its schema (to read it back with the same types)."""
    schema = df.schema
    # rebalance: AQE splits skewed partition values and merges small ones
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    write_table(df, path, "overwrite", list(partition_by) or None)
    return schema


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    # the declared schema keeps partition columns typed as written (no inference)
    return read_declared(spark, path, schema).select(*schema.fieldNames())


def concurrently(tasks: dict, workers: int = 4) -> dict:
    """Run independent Spark actions as concurrent jobs (one thread submits each)."""
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def ingest(spark: SparkSession, sources: dict[str, DataFrame], root: str, batch_id: str,
           ingested_at: str | None = None, layers: Layers | None = None, required=REQUIRED) -> dict:
    """Land every non-empty source as one bronze batch.

    A required source that is missing or cannot be landed stops the run; another one that
    cannot be landed is logged and not counted.
    """
    if missing := [n for n in required if sources.get(n) is None]:
        raise RuntimeError(f"required sources are missing: {', '.join(missing)}")

    def land(name, df):
        path = f"{root}/bronze/{name}"
        landed = with_lineage(df, name, batch_id, ingested_at)
        if not write_bronze(landed, path, batch_id):
            if name in required:
                raise RuntimeError(f"required source {name!r} could not be landed")
            return 0
        if layers is not None:
            layers.bronze_schemas[name] = landed.schema
        return spark.read.parquet(path).where(F.col("_batch_id") == batch_id).count()

    landed = concurrently({n: (lambda n=n, d=d: land(n, d)) for n, d in sources.items() if d is not None})
    size_shuffles(spark, max(landed.values(), default=0))
    total = sum(landed.values())
    return {"rows_input": total, "rows_clean": total, "rows_quarantined": 0,
            "rows_duplicate": 0, "quarantine_rate_pct": 0.0}


def _split(spark: SparkSession, flagged: DataFrame, path: str) -> DataFrame:
    """The contract split under ``path``, written in one pass; either outcome may be empty."""
    write_split(flagged, path)
    return read_declared(spark, path, T.StructType([*flagged.schema.fields, T.StructField("_outcome", T.StringType())]))


def _write_quarantine(envelope: DataFrame, root: str, source: str) -> None:
    """Replace the quarantine partition of one source whole: a rerun without rejects leaves none behind."""
    write_table(envelope.drop("source"), f"{root}/silver/quarantine/source={source}")


def _quarantine(spark: SparkSession, path: str) -> DataFrame:
    return read_declared(spark, path, ENVELOPE_SCHEMA)


STREAM_MEASURES = ("media_proficiencia_saeb", "indicador_alfabetizacao", "total_alunos_avaliados")


def stream_to_silver(spark: SparkSession, root: str, cfg: DomainConfig = LITERACY,
                     stream: str = "medicoes_stream") -> tuple[DataFrame | None, int, int]:
    """Bronze stream rows through the same contract as batch rows.

    Writes ``silver/fato_medicoes_stream`` (latest event per key, partitioned by
    group) and the stream's quarantine partition; returns (latest clean
    measurements, rows in, rows rejected).  ``(None, 0, 0)`` without a stream.
    """
    st = read_bronze(spark, f"{root}/bronze/{stream}")
    if st is None:
        return None, 0, 0
    split = _split(spark, evaluate(st, cfg), f"{root}/silver/_contract_stream")
    clean = split.where(F.col("_outcome") == "clean").drop("_outcome", REASON, "_corrupt_record", "_payload")
    rejects = split.where(F.col("_outcome") == "quarantine").drop("_outcome")
    order = [c for c in (cfg.ingest_ts_col, "timestamp_medicao", "event_id") if c in clean.columns]
    latest = latest_per_key(clean, list(cfg.key_cols), order)
    schema = _write(latest, f"{root}/silver/fato_medicoes_stream", (cfg.group_col,))
    envelope = to_envelope(rejects.withColumn("_quarantine_timestamp", F.current_timestamp()),
                           stream, ["event_id"], cfg.year_col)
    _write_quarantine(envelope, root, stream)
    n_in, n_rej = split.count(), split.where(F.col("_outcome") == "quarantine").count()
    return _read(spark, f"{root}/silver/fato_medicoes_stream", schema), n_in, n_rej


def _measurements(latest: DataFrame, cfg: DomainConfig) -> DataFrame:
    wanted = (*cfg.key_cols, cfg.group_col, cfg.ingest_ts_col, *STREAM_MEASURES)
    return latest.select(*[c for c in latest.columns if c in wanted])


def _merge_measured(fact: DataFrame, updates: DataFrame, table: str, cfg: DomainConfig, buckets: int) -> None:
    """Stream measurements into the stored fact rows of their keys; only the buckets of those keys are read."""
    keys = list(cfg.key_cols)
    touched = [r[0] for r in updates.select(bucket_of(keys, buckets)).distinct().collect()]  # at most `buckets` ids
    stored = fact.where(F.col("_bucket").isin(touched)).drop("_bucket").join(updates.select(*keys), keys, "left_semi")
    merge_into_buckets(merge_measurements(stored, _measurements(updates, cfg), keys, list(STREAM_MEASURES), cfg.ingest_ts_col),
                       table, keys, [cfg.ingest_ts_col, "_batch_id"], buckets)


def stream_changes(spark: SparkSession, root: str, cfg: DomainConfig, stream: str, on_updates, buckets: int = 64) -> dict:
    """The bronze stream's new files through the contract, micro-batch by micro-batch.

    A checkpointed stream over the bronze files hands each file over once, however many runs there are.  A micro-batch's
    contract split and quarantine are written per epoch (a replayed epoch replaces them), its latest rows are merged
    into the key-bucketed ``silver/<stream>_inc`` and handed to ``on_updates``, which must be idempotent.
    """
    path, keys = f"{root}/bronze/{stream}", list(cfg.key_cols)
    table = f"{root}/silver/{stream}_inc"
    bronze = read_bronze(spark, path, merge_schema=False)
    out = {"rows": 0, "rejected": 0, "years": set(), "table": table}
    if bronze is None:
        return out

    def merge(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        split = _split(session, evaluate(batch, cfg), f"{root}/silver/_contract_stream_inc/_epoch={epoch}")
        clean = split.where(F.col("_outcome") == "clean").drop("_outcome", REASON, "_corrupt_record", "_payload")
        rejects = split.where(F.col("_outcome") == "quarantine").drop("_outcome")
        envelope = to_envelope(rejects.withColumn("_quarantine_timestamp", F.current_timestamp()), stream, ["event_id"], cfg.year_col)
        write_table(envelope, f"{root}/silver/quarantine_inc/_batch_id={stream}_{epoch}", "overwrite", ["source"])
        order = [c for c in (cfg.ingest_ts_col, "timestamp_medicao", "event_id") if c in clean.columns]
        updates = _read(session, f"{root}/silver/_stream_updates", _write(latest_per_key(clean, keys, order), f"{root}/silver/_stream_updates"))
        out["rows"] += split.count()
        out["rejected"] += rejects.count()
        if merge_into_buckets(updates, table, keys, order, buckets):
            out["years"] |= {r[0] for r in updates.select(cfg.year_col).distinct().collect()}
            on_updates(updates)

    run_available(spark.readStream.schema(bronze.schema).parquet(path), f"{root}/silver/_stream_checkpoint", merge)
    return out


CENSUS_KEYS = ("id_escola",)


def census_to_silver(spark: SparkSession, root: str, cfg: DomainConfig, census: str = "censo_escolar",
                     schemas: dict | None = None) -> dict:
    """The latest delivery of each school and year to ``silver/<census>``; rows whose id breaks the contract go to quarantine."""
    raw = read_bronze(spark, f"{root}/bronze/{census}", schema=(schemas or {}).get(census))
    if raw is None:
        return {}
    keys = [k for k in (*CENSUS_KEYS, cfg.id_col, cfg.year_col) if k in raw.columns]
    normal = normalize(latest_delivery(raw, keys, [cfg.ingest_ts_col, "_batch_id"]), cfg)
    flagged = normal.withColumn(REASON, F.when(~R.validity(cfg), F.lit(C.REASON_VALIDITY)))
    split = _split(spark, flagged, f"{root}/silver/_contract_{census}")
    rejects = split.where(F.col("_outcome") == "quarantine").drop("_outcome")
    year = cfg.year_col if cfg.year_col in raw.columns else None
    _write_quarantine(to_envelope(rejects.withColumn("_quarantine_timestamp", F.current_timestamp()), census,
                                  [cfg.id_col], year), root, census)
    n_in, n_out = raw.count(), split.count()
    n_rej = split.where(F.col("_outcome") == "quarantine").count()
    return {"census_rows_input": n_in, "census_rows_clean": n_out - n_rej, "census_rows_quarantined": n_rej,
            "census_rows_duplicate": n_in - n_out}


def census_changes(spark: SparkSession, root: str, batch_id: str, cfg: DomainConfig, census: str = "censo_escolar",
                   buckets: int = 64, schemas: dict | None = None) -> tuple[dict, DataFrame | None]:
    """One batch of the census into the key-bucketed ``silver/<census>_inc``; its counts and its rejects' envelope.

    Judged rows are merged whatever their outcome, as a later delivery replaces an earlier one even if it breaks the contract.
    """
    raw = read_bronze(spark, f"{root}/bronze/{census}", schema=(schemas or {}).get(census))
    if raw is None:
        return {}, None
    raw = raw.where(F.col("_batch_id") == batch_id)
    keys = [k for k in (*CENSUS_KEYS, cfg.id_col, cfg.year_col) if k in raw.columns]
    order = [cfg.ingest_ts_col, "_batch_id"]
    normal = normalize(latest_delivery(raw, keys, order), cfg)
    flagged = normal.withColumn(REASON, F.when(~R.validity(cfg), F.lit(C.REASON_VALIDITY)))
    judged = flagged.withColumn("_outcome", F.when(F.col(REASON).isNull(), "clean").otherwise("quarantine"))
    path = f"{root}/silver/_census_batch"
    judged = _read(spark, path, _write(judged, path))
    merge_into_buckets(judged, f"{root}/silver/{census}_inc", keys, order, buckets, deliveries="_batch_id")
    rejects = judged.where(F.col("_outcome") == "quarantine").drop("_outcome")
    n_in, n_out, n_rej = raw.count(), judged.count(), rejects.count()
    envelope = to_envelope(rejects.withColumn("_quarantine_timestamp", F.current_timestamp()), census, [cfg.id_col],
                           cfg.year_col if cfg.year_col in raw.columns else None)
    return {"census_rows_input": n_in, "census_rows_clean": n_out - n_rej, "census_rows_quarantined": n_rej,
            "census_rows_duplicate": n_in - n_out}, envelope


def to_silver(spark: SparkSession, root: str, cfg: DomainConfig = LITERACY,
              metas: str = "metas_municipio", entities: str = "municipios",
              groups: str = "ufs", layers: Layers | None = None,
              stream: str | None = "medicoes_stream", merge_stream: bool = True) -> dict:
    """Contract split (one pass), directory enrichment, de-duplication, quarantine.

    When a bronze stream table exists its rows pass the same contract; with
    ``merge_stream`` newer stream measurements then replace the batch ones in
    the silver fact (column by column, the batch target is kept).
    """
    schemas = layers.bronze_schemas if layers is not None else {}
    raw = read_bronze(spark, f"{root}/bronze/{metas}", schema=schemas.get(metas))
    if raw is None:
        raise RuntimeError(f"bronze {metas!r} not found: run the ingestion first")
    split = _split(spark, evaluate(raw, cfg), f"{root}/silver/_contract")
    clean = split.where(F.col("_outcome") == "clean").drop("_outcome", REASON)
    rejects = split.where(F.col("_outcome") == "quarantine").drop("_outcome")

    clean = enrich(spark, clean, root, cfg, entities, groups, schemas)

    # W2: the ingestion time orders versions when present, else the year
    order = [order_column(clean, (cfg.ingest_ts_col,), cfg.year_col)]
    order += [c for c in ("_batch_id",) if c in clean.columns]
    silver = latest_per_key(clean, list(cfg.key_cols), order)
    batch_silver = silver
    st_latest, st_in, st_rej = (stream_to_silver(spark, root, cfg, stream) if stream else (None, 0, 0))
    merged = st_latest is not None and merge_stream
    if merged:
        silver = merge_measurements(silver, _measurements(st_latest, cfg), list(cfg.key_cols), list(STREAM_MEASURES), cfg.ingest_ts_col)
    envelope = to_envelope(rejects.withColumn("_quarantine_timestamp", F.current_timestamp()),
                           metas, [cfg.id_col], cfg.year_col)
    # the silver table and the quarantine are independent writes: submitted together.
    # One quarantine table holds every source's rejects; each source replaces its own
    # partition, so a rerun replaces its rejects instead of appending them again.
    written = concurrently({
        "silver": lambda: _write(silver, f"{root}/silver/fato_metas", (cfg.group_col,)),
        "quarantine": lambda: _write_quarantine(envelope, root, metas),
    })
    silver_schema = written["silver"]
    census_counts = census_to_silver(spark, root, cfg, schemas=schemas)
    counts = concurrently({
        "in": split.count,
        "rej": lambda: split.where(F.col("_outcome") == "quarantine").count(),
        "out": lambda: _read(spark, f"{root}/silver/fato_metas", silver_schema).count(),
    })
    n_in, n_rej, n_out = counts["in"], counts["rej"], counts["out"]
    if layers is not None:
        layers.silver = _read(spark, f"{root}/silver/fato_metas", silver_schema)
        layers.silver_schema = silver_schema
        layers.quarantine = _quarantine(spark, f"{root}/silver/quarantine")
    # the balance input = clean + quarantined + duplicates is kept for the batch rows;
    # keys that only the stream delivered are reported on their own
    n_batch = batch_silver.count() if merged else n_out
    out = {"rows_input": n_in, "rows_clean": n_batch, "rows_quarantined": n_rej,
           "rows_duplicate": n_in - n_rej - n_batch, "quarantine_rate_pct": quarantine_rate(n_rej, n_in),
           **census_counts}
    if merged:
        out["stream_keys_added"] = n_out - n_batch
    if st_latest is not None:
        # stream rows are reported alongside (input and rejects), as separate fields too
        n_st_clean = st_latest.count()
        out.update(stream_rows_input=st_in, stream_rows_quarantined=st_rej,
                   stream_rows_clean=n_st_clean, stream_rows_duplicate=st_in - st_rej - n_st_clean)
    return out


def enrich(spark: SparkSession, clean: DataFrame, root: str, cfg: DomainConfig = LITERACY,
           entities: str = "municipios", groups: str = "ufs", schemas: dict | None = None,
           as_of: bool = False) -> DataFrame:
    """Left-join directory rows onto clean facts: the latest of all batches, or those as of each fact's own batch (``as_of``)."""
    schemas = schemas or {}
    order = [cfg.ingest_ts_col, "_batch_id"]
    if as_of:
        for name, key, wanted in ((entities, cfg.id_col, (cfg.entity_name_col,)),
                                  (groups, cfg.group_col, (cfg.group_name_col, cfg.region_col))):
            raw = read_bronze(spark, f"{root}/bronze/{name}", schema=schemas.get(name))
            if raw is not None:
                rows = normalize(raw, cfg)
                rows = rows.select(key, "_batch_id", *[c for c in wanted if c in rows.columns])
                clean = join_as_of(clean, rows, key, "_batch_id", "_batch_id", probe=raw)
        return clean
    ent_raw = read_bronze(spark, f"{root}/bronze/{entities}", schema=schemas.get(entities))
    if ent_raw is not None:
        ent_dir = latest_per_key(normalize(ent_raw, cfg), [cfg.id_col], order)
        cols = [cfg.id_col] + [c for c in (cfg.entity_name_col,) if c in ent_dir.columns]
        clean = join_directory(clean, ent_dir.select(*cols), cfg.id_col, probe=ent_raw)
    grp_raw = read_bronze(spark, f"{root}/bronze/{groups}", schema=schemas.get(groups))
    if grp_raw is not None:
        grp_dir = latest_per_key(normalize(grp_raw, cfg), [cfg.group_col], order)
        cols = [cfg.group_col] + [c for c in (cfg.group_name_col, cfg.region_col) if c in grp_dir.columns]
        clean = join_directory(clean, grp_dir.select(*cols), cfg.group_col, probe=grp_raw)
    return clean


def replay(spark: SparkSession, root: str, batch_id: str, cfg: DomainConfig = LITERACY, metas: str = "metas_municipio") -> DataFrame:
    """The clean, enriched rows as they stood after ``batch_id``: later deliveries of facts and directories do not show."""
    raw = read_bronze(spark, f"{root}/bronze/{metas}")
    if raw is None:
        raise RuntimeError(f"bronze {metas!r} not found: run the ingestion first")
    judged = evaluate(as_of_batch(raw, batch_id), cfg)
    clean = judged.where(F.col(REASON).isNull()).drop(REASON)
    latest = latest_per_key(clean, list(cfg.key_cols), [cfg.ingest_ts_col, "_batch_id"])
    return enrich(spark, latest, root, cfg, as_of=True)


def to_silver_incremental(spark: SparkSession, root: str, batch_id: str, cfg: DomainConfig = LITERACY,
                          metas: str = "metas_municipio", entities: str = "municipios",
                          groups: str = "ufs", buckets: int = 64, layers: Layers | None = None,
                          stream: str | None = "medicoes_stream") -> dict:
    """Process ONE bronze batch and merge it into a key-bucketed silver table.

    The batch is read by partition pruning on ``_batch_id``; its contract
    split and quarantine are written per batch (a rerun replaces them); its
    clean rows are merged into ``silver/fato_metas_inc`` rewriting only the
    key buckets they touch.  The bronze stream's new files (``stream_changes``) and the census rows of the batch
    (``census_changes``) are merged the same way, so a daily run costs the day's files, not the history.  Measurements
    that earlier runs took from the stream are merged into the batch's rows of their keys where they are newer.
    """
    schemas = layers.bronze_schemas if layers is not None else {}
    bronze = read_bronze(spark, f"{root}/bronze/{metas}", schema=schemas.get(metas))
    if bronze is None:
        raise RuntimeError(f"bronze {metas!r} not found: run the ingestion first")
    raw = bronze.where(F.col("_batch_id") == batch_id)
    # each batch owns one folder, replaced whole: a re-delivered batch with fewer
    # rejects leaves no stale rows behind (a partition overwrite would keep them)
    split_path = f"{root}/silver/_contract_inc/_batch_id={batch_id}"
    split = _split(spark, evaluate(raw, cfg).drop("_batch_id"), split_path).withColumn("_batch_id", F.lit(batch_id))
    clean = split.where(F.col("_outcome") == "clean").drop("_outcome", REASON)
    rejects = split.where(F.col("_outcome") == "quarantine").drop("_outcome")

    keys, order = list(cfg.key_cols), [cfg.ingest_ts_col, "_batch_id"]
    enriched = latest_per_key(enrich(spark, clean, root, cfg, entities, groups, schemas), keys, order)
    streamed = read_bronze(spark, f"{root}/bronze/{stream}", merge_schema=False) if stream else None
    if streamed is not None:  # measures that only the stream has, so that all rows of the table have one schema
        for c in STREAM_MEASURES:
            if c not in enriched.columns and c in streamed.columns:
                enriched = enriched.withColumn(c, F.lit(None).cast(streamed.schema[c].dataType))
    # written once: the merge, the counts and the dimensions read it back
    batch_schema = _write(enriched, f"{root}/silver/_batch")
    enriched = _read(spark, f"{root}/silver/_batch", batch_schema)
    table = f"{root}/silver/fato_metas_inc"
    merge_into_buckets(enriched, table, keys, order, buckets)
    stored_schema = T.StructType([*batch_schema.fields, T.StructField("_bucket", T.IntegerType())])

    def merge_measured(updates: DataFrame) -> None:
        _merge_measured(read_declared(updates.sparkSession, table, stored_schema), updates, table, cfg, buckets)

    changes = {"rows": 0, "rejected": 0, "years": set()}
    if streamed is not None:
        changes = stream_changes(spark, root, cfg, stream, merge_measured, buckets)
        known = read_bronze(spark, changes["table"], merge_schema=False)
        if known is not None:  # measurements of earlier runs for this batch's keys
            touched = [r[0] for r in enriched.select(bucket_of(keys, buckets)).distinct().collect()]
            merge_measured(known.where(F.col("_bucket").isin(touched)).drop("_bucket").join(enriched.select(*keys), keys, "left_semi"))
    census_counts, census_rejects = census_changes(spark, root, batch_id, cfg, buckets=buckets, schemas=schemas)
    envelope = to_envelope(rejects.withColumn("_quarantine_timestamp", F.current_timestamp()),
                           metas, [cfg.id_col], cfg.year_col)
    if census_rejects is not None:
        envelope = union_envelopes(envelope, census_rejects)
    write_table(envelope, f"{root}/silver/quarantine_inc/_batch_id={batch_id}", "overwrite", ["source"])

    n_in = split.count()
    n_rej = split.where(F.col("_outcome") == "quarantine").count()
    n_clean = enriched.count()
    # the years this batch changed (a handful of values): gold rebuilds only those fact partitions
    years = {r[0] for r in clean.select(cfg.year_col).distinct().collect()} | changes["years"]
    years = sorted(y for y in years if y is not None)
    if layers is not None:
        layers.silver = spark.read.option("mergeSchema", True).parquet(table).drop("_bucket") if years or n_clean \
            else read_declared(spark, table, batch_schema)
        layers.quarantine = read_declared(spark, f"{root}/silver/quarantine_inc", ENVELOPE_SCHEMA + ", _batch_id string")
        layers.batch_silver = enriched
    return {"rows_input": n_in, "rows_clean": n_clean, "rows_quarantined": n_rej,
            "rows_duplicate": n_in - n_rej - n_clean, "quarantine_rate_pct": quarantine_rate(n_rej, n_in),
            "touched_years": years, "stream_rows_input": changes["rows"], "stream_rows_quarantined": changes["rejected"],
            **census_counts}


FACTS = ("fato_indicador_alfabetizacao", "fato_metas_vs_resultado")
MERGED_DIMS = {"dim_municipio": "id_col", "dim_uf": "group_col"}   # dimension -> key role


def to_gold(spark: SparkSession, root: str, cfg: DomainConfig = LITERACY,
            census: str = "censo_escolar", layers: Layers | None = None, years=None) -> dict:
    """Build and write the gold tables from silver.

    With ``years`` (an incremental run) the two facts are rebuilt only for those
    years and swapped in by dynamic partition overwrite of their ``ano``
    partitions, and the entity and group dimensions merge the batch's rows
    (latest year wins, a re-delivered year replaces) into key-bucketed tables;
    the other tables are rebuilt whole.
    """
    if layers is not None and layers.silver is not None:
        silver = layers.silver
    else:
        silver = spark.read.parquet(f"{root}/silver/fato_metas")
    schemas = layers.bronze_schemas if layers is not None else {}
    lineage = ("_ingestion_timestamp", "_source_table", "_batch_id")
    census_df = read_bronze(spark, f"{root}/silver/_contract_{census}" if years is None else f"{root}/silver/{census}_inc")
    if census_df is not None:
        census_df = census_df.where(F.col("_outcome") == "clean").drop(*lineage, "_outcome", "_bucket", REASON)
    levels = {}
    for name, keys in (("metas_uf", (cfg.group_col, cfg.year_col)), ("metas_brasil", (cfg.year_col,))):
        lv = read_bronze(spark, f"{root}/bronze/{name}", schema=schemas.get(name))
        if lv is not None:  # the latest delivery of each key counts
            order = [c for c in lineage if c in lv.columns and c != "_source_table"]
            lv = latest_per_key(lv, [k for k in keys if k in lv.columns], order).drop(*lineage)
        levels[name] = lv
    tables = G.build_gold(silver, census_df, cfg, levels["metas_uf"], levels["metas_brasil"])
    batch = layers.batch_silver if layers is not None else None

    def build(name, df):
        path = f"{root}/gold/{name}"
        if years is not None and batch is not None and name in MERGED_DIMS:
            key = getattr(cfg, MERGED_DIMS[name])
            rows = batch.select(*[c for c in df.columns if c in batch.columns], cfg.year_col)
            merge_into_buckets(latest_per_key(rows, [key], [cfg.year_col]), path, [key], [cfg.year_col])
            return df.schema, spark.read.parquet(path).count()
        if years is not None and name in FACTS:
            schema = df.schema
            part = df.where(F.col(cfg.year_col).isin(list(years)))
            part = part.hint("rebalance", cfg.year_col).sortWithinPartitions(
                cfg.year_col, *GOLD_CLUSTER.get(name, ()))
            overwrite_partitions(part, path, [cfg.year_col])
            return schema, spark.read.parquet(path).count()
        schema = _write(df, path, GOLD_PARTITIONS.get(name, ()), GOLD_CLUSTER.get(name, ()))
        return schema, spark.read.parquet(path).count()

    done = concurrently({n: (lambda n=n, d=d: build(n, d)) for n, d in tables.items()})
    schemas = {n: v[0] for n, v in done.items()}
    counts = {n: v[1] for n, v in done.items()}
    if layers is not None:
        layers.gold = {n: _read(spark, f"{root}/gold/{n}", schemas[n]) for n in tables}
    n_in = counts.get("fato_indicador_alfabetizacao", 0)  # a projection of silver: same rows
    return {"rows_input": n_in, "rows_clean": counts.get("fato_indicador_alfabetizacao", 0),
            "rows_quarantined": 0, "rows_duplicate": 0, "quarantine_rate_pct": 0.0}


def _claim_root(spark: SparkSession, root: str, mode: str) -> None:
    """A root is used in one mode: the first run stores it there, a run in the other mode is refused."""
    path = f"{root}/_mode"
    stored = [r["mode"] for r in read_declared(spark, path, "mode string", "json").collect()]
    if not stored:
        spark.range(1).select(F.lit(mode).alias("mode")).write.json(path)
    elif stored[0] != mode:
        raise ValueError(f"{root} holds {stored[0]} runs; a run in {mode} mode would lose their rows")


def run(spark: SparkSession, sources: dict[str, DataFrame], root: str, cfg: DomainConfig = LITERACY,
        batch_id: str | None = None, ingested_at: str | None = None, sink=None,
        incremental: bool = False, buckets: int = 64) -> Layers:
    """The three stages in order; an exception stops the run (and is logged as ERROR).

    ``incremental=True`` processes only this run's bronze batch at silver and
    merges it into the bucketed silver table (``to_silver_incremental``);
    the default recomputes silver from every bronze batch.
    """
    batch_id = batch_id or make_batch_id()
    layers = Layers(root=root, batch_id=batch_id)
    _claim_root(spark, root, "incremental" if incremental else "full")

    def keep(metric: dict) -> None:
        layers.metrics.append(metric)
        if sink is not None:
            sink(metric)

    def stage(name: str) -> StageRun:
        return StageRun(name, keep, cfg.alert_rate_pct, batch_id)

    with stage(C.STAGE_INGEST) as run_:
        run_.report(ingest(spark, sources, root, batch_id, ingested_at, layers))
    years = None
    with stage(C.STAGE_SILVER) as run_:
        if incremental:
            years = run_.report(to_silver_incremental(spark, root, batch_id, cfg, buckets=buckets, layers=layers))[
                "touched_years"]
        else:
            run_.report(to_silver(spark, root, cfg, layers=layers))
    with stage(C.STAGE_GOLD) as run_:
        run_.report(to_gold(spark, root, cfg, layers=layers, years=years))
    return layers


def register_gold(spark: SparkSession, run: Layers, database: str | None = None,
                  as_tables: bool = False) -> list[str]:
    """Expose the gold tables to SQL: temp views, or catalog tables over the written files.

    Catalog tables are created with ``CREATE TABLE … USING parquet LOCATION``
    and their partitions recovered from the paths (never by file globbing).
    """
    from aurum.sources.catalog import register_external
    names = []
    if as_tables and database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, df in run.gold.items():
        if as_tables:
            full = f"{database}.{name}" if database else name
            register_external(spark, full, f"{run.root}/gold/{name}",
                              partitioned=bool(GOLD_PARTITIONS.get(name)))
            names.append(full)
        else:
            df.createOrReplaceTempView(name)
            names.append(name)
    return names

