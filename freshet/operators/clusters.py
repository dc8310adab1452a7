"""Clusters of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = "features"


def with_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES).transform(df)


def fit_clusters(df: DataFrame, columns: Sequence[str], k: int = 2, seed: int = 1) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=FEATURES).fit(with_features(df, columns))


def score(model: KMeansModel, df: DataFrame, columns: Sequence[str], distance: str | None = None) -> DataFrame:
    """Adds the number of the nearest cluster as ``prediction``.

    ``distance`` names a column for the distance to its centre, an outlier score.
    Works on a stream too: the model is fixed.
    """
    scored = model.transform(with_features(df, columns)).drop(FEATURES)
    if distance is None:
        return scored
    squares = [
        sum(((F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(columns, centre, strict=True)), F.lit(0.0))
        for centre in model.clusterCenters()
    ]
    return scored.withColumn(distance, F.sqrt(F.array_min(F.array(*squares))))


def in_order_of_centres(model: KMeansModel, scored: DataFrame) -> DataFrame:
    """Numbers the clusters by their centres, lowest first, whatever the seed was."""
    centres = [tuple(c) for c in model.clusterCenters()]
    places = [sorted(centres).index(c) for c in centres]
    return scored.withColumn("prediction", F.get(F.array(*map(F.lit, places)), F.col("prediction")))
