"""Provider-level statistics and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from .claims import AMOUNT, CLAIM, DATE, PROVIDER

# Spark numbers Sunday 1: Friday, Saturday and Sunday (fixed values).
WEEKEND = (1, 6, 7)


def provider_fwa_features(lines: DataFrame, high_cost: float = 5000.0) -> DataFrame:
    """Cost level, spread, volume, weekend share and high-cost share per provider; nulls become 0."""
    return (
        lines.groupBy(PROVIDER)
        .agg(
            F.avg(AMOUNT).alias("avg_cost_per_claim"),
            F.countDistinct(CLAIM).alias("claim_count"),
            F.stddev_samp(AMOUNT).alias("std_cost_per_claim"),
            X.share(F.dayofweek(DATE).isin(*WEEKEND)).alias("weekend_billing_ratio"),
            X.share(F.col(AMOUNT) > high_cost).alias("high_cost_claim_ratio"),
        )
        .na.fill(0, ["avg_cost_per_claim", "std_cost_per_claim"])
    )


def provider_value_features(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy(PROVIDER)
        .agg(F.avg(AMOUNT).alias("avg_cost_per_claim"), F.countDistinct(CLAIM).alias("claim_count"))
        .na.fill(0, ["avg_cost_per_claim"])
    )


def provider_stats(lines: DataFrame, providers: DataFrame) -> DataFrame:
    """Mean cost and distinct claims per provider with specialty and type."""
    stats = lines.groupBy(PROVIDER).agg(F.avg(AMOUNT).alias("avg_cost"), F.countDistinct(CLAIM).alias("claim_count"))
    return stats.join(providers, PROVIDER, "left")


def fraud_score_join(features: DataFrame, scores: DataFrame) -> DataFrame:
    """Providers with their FWA score; providers never scored get 0."""
    scored = scores.select(PROVIDER, "provider_fraud_score")
    return features.join(scored, PROVIDER, "left").na.fill(0, ["provider_fraud_score"])


def peer_group_zscore(stats: DataFrame) -> DataFrame:
    """Provider cost against peers of the same specialty; 0 where the peers do not vary.

    Peer means are aggregated and joined, not windowed: a specialty that holds most
    providers is then combined map-side instead of being sorted in one task.
    """
    peers = stats.groupBy("specialty").agg(
        F.avg("avg_cost").alias("peer_avg"), F.stddev_samp("avg_cost").alias("_peer_std")
    )
    z = F.try_divide(F.col("avg_cost") - F.col("peer_avg"), F.col("_peer_std"))
    return stats.join(peers, "specialty", "left").withColumn("peer_zscore", F.coalesce(z, F.lit(0.0))).drop("_peer_std")


def provider_value_equation(stats: DataFrame, specialties: DataFrame, quality: DataFrame) -> DataFrame:
    """(quality + efficiency) / cost, efficiency being the specialty mean over the provider mean."""
    peers = specialties.select("specialty", F.col("avg_cost").alias("specialty_avg"))
    joined = stats.join(peers, "specialty", "left").join(quality, PROVIDER, "left")
    efficiency = F.coalesce(F.try_divide(F.col("specialty_avg"), F.col("avg_cost")), F.lit(0.0))
    score = F.coalesce(F.col("quality"), F.lit(0.0))
    return joined.select(
        PROVIDER,
        efficiency.alias("efficiency"),
        score.alias("quality"),
        F.coalesce(F.try_divide(score + efficiency, F.col("avg_cost")), F.lit(0.0)).alias("value_score"),
    )


def top_k(df: DataFrame, score: str, key: str, k: int, ascending: bool = True) -> DataFrame:
    """First k rows by score, ties by key."""
    order = F.col(score).asc() if ascending else F.col(score).desc()
    return df.orderBy(order, F.col(key)).limit(k)
