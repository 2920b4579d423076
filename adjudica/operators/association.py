"""Rule lists mined from claims: which codes belong together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mine_pairs(
    items: DataFrame, claim: str, given: str, then: str, min_support: int = 2, min_confidence: float = 0.0,
    min_lift: float = 1.0,
) -> DataFrame:
    """Pairs of codes on one billed line that claims bear out, with support, confidence and lift.

    ``n_claims`` counts claims with the pair, ``confidence`` is their share of the claims
    with ``given``, and ``lift`` that share over the share of claims with ``then``. A claim
    counts once however often it repeats a pair; lines without either code give no pair and
    count nowhere. Pairs stay on their line, so the work is linear in the lines.
    """
    coded = items.filter(F.col(given).isNotNull() & F.col(then).isNotNull()).select(claim, given, then).distinct()

    def claims_per(*codes: str, out: str) -> DataFrame:
        return coded.select(claim, *codes).distinct().groupBy(*codes).agg(F.count(F.lit(1)).alias(out))

    everything = coded.select(F.countDistinct(claim)).scalar()
    return (
        coded.groupBy(given, then).agg(F.count(F.lit(1)).alias("n_claims"))
        .filter(F.col("n_claims") >= min_support)
        .join(claims_per(given, out="_given"), given)
        .join(claims_per(then, out="_then"), then)
        .withColumn("confidence", F.col("n_claims") / F.col("_given"))
        .withColumn("lift", F.col("confidence") * everything / F.col("_then"))
        .filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
        .select(given, then, "n_claims", "confidence", "lift")
    )
