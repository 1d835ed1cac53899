"""Feature table per (entity, year) and models from ``pyspark.ml`` (distributed)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.config import DomainConfig, LITERACY
from aurum.operators.joins import materialised

FEATURES = ("media_proficiencia_saeb", "indicador_alfabetizacao", "meta_oficial", "gap_percentual")


def feature_table(fact: DataFrame, target: DataFrame | None = None,
                  cfg: DomainConfig = LITERACY) -> DataFrame:
    keys = [cfg.id_col, cfg.year_col]
    out = fact.select(*keys, cfg.group_col, cfg.score_col, cfg.rate_col,
                      F.col("atingiu_corte_alfabetizado").cast("int").alias("label"))
    if target is not None:
        out = out.join(target.select(*keys, "meta_oficial", "gap_percentual"), keys, "left")
    return out


def fit_clusters(features: DataFrame, k: int = 5, seed: int = 42, cols=FEATURES) -> DataFrame:
    """k-means on standardised features; returns the rows with a ``cluster`` column."""
    cols = [c for c in cols if c in features.columns]
    # an iterative fit reads its rows many times: they are written once
    clean = materialised(features.na.drop(subset=cols), "cluster_features")
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=cols, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_features"),
        KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster"),
    ])
    model = pipe.fit(clean)
    return model.transform(clean).drop("_raw", "_features")


def fit_risk(features: DataFrame, label: str = "label", cols=FEATURES[1:]) -> DataFrame:
    """Logistic model of ``label`` (1: the cutoff is reached); the risk is the probability of label 0."""
    cols = [c for c in cols if c in features.columns]
    clean = materialised(features.na.drop(subset=cols + [label]), "risk_features")
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=cols, outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=label, maxIter=20),
    ])
    return pipe.fit(clean).transform(clean).drop("_features", "rawPrediction")


def assign_clusters(features: DataFrame, centres, cols=FEATURES) -> DataFrame:
    """Rows without nulls in ``cols`` with ``cluster``: the number of the nearest of the given centres, the first of equal ones."""
    clean = features.na.drop(subset=list(cols))
    far = []
    for centre in centres:
        steps = [(F.col(c).cast("double") - F.lit(float(x))) for c, x in zip(cols, centre, strict=True)]
        square = steps[0] * steps[0]
        for step in steps[1:]:
            square = square + step * step
        far.append(square)
    far = F.array(*far)
    return clean.withColumn("cluster", (F.array_position(far, F.array_min(far)) - 1).cast("int"))


def score_risk(features: DataFrame, coefficients, intercept: float, cols=FEATURES[1:]) -> DataFrame:
    """Rows without nulls in ``cols`` with ``risk`` (six places, the probability of not reaching the cutoff) of a given logistic model."""
    clean = features.na.drop(subset=list(cols))
    z = F.lit(float(intercept))
    for c, w in zip(cols, coefficients, strict=True):
        z = z + F.lit(float(w)) * F.col(c).cast("double")
    return clean.withColumn("risk", F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(z)), 6)) \
        .withColumn("prediction", (z > 0).cast("int"))
