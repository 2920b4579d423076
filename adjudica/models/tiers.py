"""Provider tiers: scaled k-means with clusters named by value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = ("Bronze", "Silver", "Gold")
DEFAULT_TIER = "Silver"


@dataclass
class TierModel:
    """The fitted pipeline and the rank of each cluster, worst first."""

    pipeline: PipelineModel
    ranks: dict[int, int]
    features: list[str]

    def assign(self, df: DataFrame) -> DataFrame:
        """Rows with tier id and name; the scaler of the training data is applied, not fitted anew."""
        ranked = F.create_map(*[F.lit(x) for c, rank in self.ranks.items() for x in (c, rank)])
        names = F.array(*[F.lit(t) for t in TIERS])
        scored = self.pipeline.transform(df)
        return (
            scored.withColumn("value_tier_id", ranked[F.col("prediction")])
            .withColumn("value_tier_name", F.get(names, F.col("value_tier_id")))
            .drop("_raw", "_scaled", "prediction")
        )

    def silhouette(self, df: DataFrame) -> float:
        """Mean silhouette with squared Euclidean distance."""
        evaluator = ClusteringEvaluator(featuresCol="_scaled", predictionCol="prediction")
        return float(evaluator.evaluate(self.pipeline.transform(df)))


def fit_tiers(df: DataFrame, features: Sequence[str], costs: Sequence[str], k: int = 3, seed: int = 42) -> TierModel:
    """Clusters ranked by centroid value: the lower the summed ``costs`` features, the better the tier."""
    names = list(features)
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=names, outputCol="_raw", handleInvalid="skip"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
            KMeans(featuresCol="_scaled", k=k, seed=seed),
        ]
    ).fit(df)
    centers = pipeline.stages[-1].clusterCenters()
    burden = [sum(float(c[names.index(f)]) for f in costs) for c in centers]
    order = sorted(range(len(centers)), key=lambda c: -burden[c])
    return TierModel(pipeline, {cluster: rank for rank, cluster in enumerate(order)}, names)


def tier_of(providers: DataFrame, tiers: DataFrame, key: str) -> DataFrame:
    """Every provider with its tier; providers without one are Silver."""
    return providers.join(tiers.select(key, "value_tier_name"), key, "left").na.fill(DEFAULT_TIER, ["value_tier_name"])
