"""Extracts that map the TPC-H-style test tables onto the indicator model.

Roles: entity (municipality) <- customer, group (state) <- nation,
region <- region, year <- order year.  Per (customer, year):

    n = line items, q = sum(quantity), d = sum(round(discount * 100))
    score  = 29 * q / n              (0 ... ~1450; above 1000 breaks the range rule)
    rate   = 10 * d / n              (0 ... 100)
    target = 40 + custkey % 41
    id     = custkey zero-padded to 7 characters
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.functions.normalize import pad_id
from aurum.operators.joins import maybe_broadcast
from aurum.session import size_shuffles

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


#: Tables of narrow rows, whose number of rows sizes the shuffles of what reads them.
SIZED = ("customer", "supplier", "part", "orders", "lineitem", "events")


class Tables(dict):
    """Test tables opened on first use (opening a Parquet table reads its footer, counting its rows all footers)."""

    def __init__(self, spark: SparkSession, sf_dir: str, names=TABLES):
        super().__init__()
        self.spark, self.sf_dir, self.names = spark, sf_dir.rstrip("/"), tuple(names)

    def __missing__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        self[name] = df
        if name in SIZED:
            size_shuffles(self.spark, df.count())
        return df


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return Tables(spark, sf_dir, names)


def order_lines(t: dict) -> DataFrame:
    """Line-item measures pre-aggregated per order (map-side partial aggregation)."""
    li = t["lineitem"].select("l_orderkey", "l_quantity", "l_discount")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
        F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("d"))


def entity_year(t: dict) -> DataFrame:
    """(ent, grp, yr, n, q, d): measures per customer and order year."""
    orders = t["orders"].select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr"))
    per_cy = (order_lines(t).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .groupBy("o_custkey", "yr")
              .agg(F.sum("n").alias("n"), F.sum("q").alias("q"), F.sum("d").alias("d")))
    cust = t["customer"].select("c_custkey", "c_nationkey")
    nation = maybe_broadcast(t["nation"].select("n_nationkey", "n_name"), 100_000)
    return (per_cy.join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("ent"), F.col("n_name").alias("grp"), "yr", "n", "q", "d"))


def metas_extract(t: dict, ey: DataFrame | None = None) -> DataFrame:
    """The municipality-indicator extract (ano, sigla_uf, id_municipio, target, rate, score)."""
    ey = entity_year(t) if ey is None else ey
    return ey.select(
        F.col("yr").cast("int").alias("ano"),
        F.col("grp").alias("sigla_uf"),
        pad_id("ent").alias("id_municipio"),
        (F.lit(40) + F.col("ent") % 41).cast("double").alias("meta_alfabetizacao"),
        ((F.col("d") * 10).cast("double") / F.col("n")).alias("indicador_alfabetizacao"),
        ((F.col("q") * 29).cast("double") / F.col("n")).alias("media_proficiencia_saeb"),
    )


def municipios_extract(t: dict) -> DataFrame:
    nation = maybe_broadcast(t["nation"].select("n_nationkey", "n_name"), 100_000)
    c = t["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.select(pad_id("c_custkey").alias("id_municipio"), F.col("c_name").alias("nome_municipio"),
                    F.col("n_name").alias("sigla_uf"))


def ufs_extract(t: dict) -> DataFrame:
    region = maybe_broadcast(t["region"], 100_000)
    n = t["nation"].join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return n.select(F.col("n_name").alias("sigla_uf"), F.lower("n_name").alias("nome_uf"),
                    F.col("r_name").alias("regiao"))


def _level_measures(ey: DataFrame, keys) -> DataFrame:
    g = ey.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("q").alias("q"), F.sum("d").alias("d"))
    return g.select(*keys,
                    ((F.col("d") * 10).cast("double") / F.col("n")).alias("indicador_alfabetizacao"),
                    ((F.col("q") * 29).cast("double") / F.col("n")).alias("media_proficiencia_saeb"))


def metas_uf_extract(t: dict, ey: DataFrame | None = None) -> DataFrame:
    """State-level (nation) indicators per year: pooled ratios; target 60 + nation key."""
    ey = (entity_year(t) if ey is None else ey)
    ey = ey.withColumnRenamed("grp", "sigla_uf").withColumn("ano", F.col("yr").cast("int"))
    lv = _level_measures(ey, ["sigla_uf", "ano"])
    nation = maybe_broadcast(t["nation"].select(F.col("n_name").alias("sigla_uf"), "n_nationkey"), 100_000)
    return lv.join(nation, "sigla_uf", "left").select(
        "ano", "sigla_uf", "indicador_alfabetizacao",
        (F.lit(60) + F.col("n_nationkey")).cast("double").alias("meta_alfabetizacao"),
        "media_proficiencia_saeb")


def metas_brasil_extract(t: dict, ey: DataFrame | None = None) -> DataFrame:
    """National indicators per year: pooled ratios; target 70."""
    ey = (entity_year(t) if ey is None else ey).withColumn("ano", F.col("yr").cast("int"))
    return _level_measures(ey, ["ano"]).withColumn("meta_alfabetizacao", F.lit(70.0)).select(
        "ano", "indicador_alfabetizacao", "meta_alfabetizacao", "media_proficiencia_saeb")


def census_extract(t: dict) -> DataFrame:
    """One row per line item as a 'student record' of the order's 'school'.

    Location code 1 (urban) when the return flag is N, else 2; basic
    infrastructure flag 1 when the line status is O.
    """
    li = t["lineitem"]
    return li.select(
        pad_id("l_orderkey").alias("id_municipio"),
        F.year("l_shipdate").cast("int").alias("ano"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id_escola"),
        F.when(F.col("l_returnflag") == "N", "1").otherwise("2").alias("tp_localizacao"),
        F.when(F.col("l_linestatus") == "O", "1").otherwise("0").alias("in_agua_potavel"),
    )


def broken_metas(t: dict) -> DataFrame:
    """Indicator rows made from the customers that break every rule of the contract now and then.

    Null, short, long and non-numeric ids, null years, rates above 100, years 2021 to 2032, and a
    second copy of every tenth row.
    """
    padded = pad_id("c_custkey")
    kind = F.col("c_custkey") % 11
    rows = t["customer"].select(
        "c_custkey",
        F.when(F.col("c_custkey") % 13 != 0, (F.lit(2021) + F.col("c_custkey") % 12).cast("int")).alias("ano"),
        F.concat(F.lit("u"), (F.col("c_custkey") % 5).cast("string")).alias("sigla_uf"),
        F.when(kind == 1, F.substring(padded, 5, 3)).when(kind == 2, F.concat(F.lit("9"), padded))
        .when(kind == 3, F.concat(F.lit("x"), F.substring(padded, 2, 6))).when(kind != 0, padded).alias("id_municipio"),
        F.lit(70.0).alias("meta_alfabetizacao"),
        (F.col("c_custkey") % 130).cast("double").alias("indicador_alfabetizacao"),
        (F.lit(500) + F.col("c_custkey") % 300).cast("double").alias("media_proficiencia_saeb"))
    return rows.unionByName(rows.where(F.col("c_custkey") % 10 == 4)).drop("c_custkey")


def state_codes(t: dict) -> DataFrame:
    return t["nation"].select(F.col("n_name").alias("sigla_uf"), F.col("n_nationkey").alias("code"))


def sources(t: dict, share_aggregate: bool = True) -> dict[str, DataFrame]:
    """The batch extracts of the layered run, keyed by bronze source name.

    The entity-year aggregate feeds three extracts; with ``share_aggregate`` it
    is computed once and materialised by a reliable checkpoint (in the shared
    checkpoint folder) instead of scanning the line items three times.
    """
    ey = None
    if share_aggregate:
        from aurum.session import shared_root
        shared_root(t["lineitem"].sparkSession)   # makes sure a checkpoint folder is named
        ey = entity_year(t).checkpoint(eager=True)
    return {
        "metas_municipio": metas_extract(t, ey),
        "municipios": municipios_extract(t),
        "ufs": ufs_extract(t),
        "censo_escolar": census_extract(t),
        "metas_uf": metas_uf_extract(t, ey),
        "metas_brasil": metas_brasil_extract(t, ey),
    }
