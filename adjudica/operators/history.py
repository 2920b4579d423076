"""Member history as grouped aggregates, at claim grain or with flattened-row weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from .claims import AMOUNT, CLAIM, DATE, DIAGNOSIS, MEMBER, PROVIDER, claim_fanout, condition_column
from .skew import HOT_ROWS, dealt, exact_percentiles

GRAINS = ("claim", "flattened")


def weighted_claims(
    header: DataFrame, items: DataFrame, team: DataFrame, grain: str = "claim", parts: int | None = None
) -> DataFrame:
    """Claims with the weight each has in the chosen grain: 1, or its flattened row count."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    slim = header.select(CLAIM, MEMBER, AMOUNT, DATE)
    if grain == "claim":
        return slim.withColumn("weight", F.lit(1).cast("long"))
    sizes = claim_fanout(slim, items, team, parts)
    return sizes.select(CLAIM, MEMBER, AMOUNT, DATE, F.col("fanout").alias("weight"))


def member_history(
    header: DataFrame, items: DataFrame, team: DataFrame, grain: str = "claim", parts: int | None = None
) -> DataFrame:
    """Sizes and totals of a member's history lists, computed without building the lists.

    ``parts`` says in how many parts items and care team meet their claims.
    """
    weighted = weighted_claims(header, items, team, grain, parts)
    costs = weighted.groupBy(MEMBER).agg(
        F.sum(F.when(F.col(AMOUNT).isNotNull(), F.col("weight")).otherwise(0)).alias("n_costs"),
        F.sum(F.col(AMOUNT) * F.col("weight")).alias("sum_costs"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
    )
    owner = dealt(header.select(CLAIM, MEMBER), parts, CLAIM)
    diagnoses = (
        dealt(items.select(CLAIM, DIAGNOSIS), parts, CLAIM).join(owner, CLAIM).groupBy(MEMBER)
        .agg(F.countDistinct(DIAGNOSIS).alias("n_diagnoses"))
    )
    # Two distinct counts in one aggregate would copy every row; distinct pairs first are smaller.
    people = (
        dealt(team, parts, CLAIM).join(owner, CLAIM).select(MEMBER, "practitioner_license", "practice_desc").distinct().groupBy(MEMBER)
        .agg(
            F.countDistinct("practitioner_license").alias("n_practitioners"),
            F.countDistinct("practice_desc").alias("n_specialties"),
        )
    )
    counted = ["n_diagnoses", "n_practitioners", "n_specialties"]
    return costs.join(diagnoses, MEMBER, "left").join(people, MEMBER, "left").na.fill(0, counted)


def history_lists(header: DataFrame, items: DataFrame, team: DataFrame, parts: int | None = None) -> DataFrame:
    """A member's history lists in long form: ``patient_key, kind, value, cost, multiplicity``.

    Kind ``visit`` has the service date as value and the cost beside it; ``diagnosis``,
    ``provider`` and ``specialty`` are sets of codes. ``multiplicity`` counts the rows that
    hold the value. Whatever a member's size, one row holds one element. ``parts`` says in how
    many parts items and care team meet their claims.
    """
    owner = dealt(header.select(CLAIM, MEMBER), parts, CLAIM)
    visits = header.groupBy(MEMBER, F.col(DATE).cast("string").alias("value"), F.col(AMOUNT).alias("cost")).agg(
        F.count(F.lit(1)).alias("multiplicity")
    )
    out = visits.select(MEMBER, F.lit("visit").alias("kind"), "value", "cost", "multiplicity")
    for source, column, kind in (
        (items, DIAGNOSIS, "diagnosis"),
        (team, "practitioner_license", "provider"),
        (team, "practice_desc", "specialty"),
    ):
        # Values move to their claims as they are: sums per claim would move once more, and are hardly fewer.
        value = F.col(column).cast("string").alias("value")
        owned = dealt(source.filter(F.col(column).isNotNull()).select(CLAIM, value), parts, CLAIM).join(owner, CLAIM)
        held = owned.groupBy(MEMBER, "value").agg(F.count(F.lit(1)).alias("multiplicity"))
        out = out.unionByName(
            held.select(MEMBER, F.lit(kind).alias("kind"), "value", F.lit(None).cast("double").alias("cost"), "multiplicity")
        )
    return out


def cost_iqr(weighted: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Interquartile range of a member's claim costs."""
    quartiles = exact_percentiles(
        weighted, [MEMBER], AMOUNT, [0.25, 0.75], ["_q1", "_q3"], weight="weight", hot_rows=hot_rows
    )
    return quartiles.select(MEMBER, (F.col("_q3") - F.col("_q1")).alias("cost_volatility_iqr"))


def visit_gaps(weighted: DataFrame) -> DataFrame:
    """Population deviation of the gaps between a member's visits.

    Repeats on one day only add zero gaps, so the order of days alone decides: the
    window sees one row per member and day.
    """
    dated = F.when(F.col(DATE).isNotNull(), F.col("weight")).otherwise(0)
    days = weighted.groupBy(MEMBER, DATE).agg(F.sum(dated).alias("_n"))
    order = Window.partitionBy(MEMBER).orderBy(DATE)
    gap = F.datediff(F.col(DATE), F.lag(DATE).over(order)).cast("double")
    sums = days.withColumn("_gap", gap).groupBy(MEMBER).agg(
        (F.sum("_n") - 1).alias("_gaps"), F.sum("_gap").alias("_s"), F.sum(F.col("_gap") * F.col("_gap")).alias("_ss")
    )
    mean = F.try_divide(F.col("_s"), F.col("_gaps"))
    variance = F.greatest(F.try_divide(F.col("_ss"), F.col("_gaps")) - mean * mean, F.lit(0.0))
    return sums.select(MEMBER, F.coalesce(F.sqrt(variance), F.lit(0.0)).alias("days_between_visits_std"))


def cost_trend(weighted: DataFrame) -> DataFrame:
    """Least-squares slope of cost per day; 0 below two distinct days.

    A slope does not change when days are counted from another start, so one pass with
    a fixed start replaces the lookup of each member's first date.
    """
    x = F.datediff(F.col(DATE), F.lit("2000-01-01").cast("date")).cast("double")
    complete = F.col(DATE).isNotNull() & F.col(AMOUNT).isNotNull()
    w, y, day = F.when(complete, F.col("weight")), F.col(AMOUNT), F.when(complete, F.col(DATE))
    sums = weighted.groupBy(MEMBER).agg(
        F.sum(w).alias("_w"),
        F.sum(w * x).alias("_x"),
        F.sum(w * y).alias("_y"),
        F.sum(w * x * x).alias("_xx"),
        F.sum(w * x * y).alias("_xy"),
        (F.min(day) < F.max(day)).alias("_spread"),
    )
    top = F.col("_w") * F.col("_xy") - F.col("_x") * F.col("_y")
    bottom = F.col("_w") * F.col("_xx") - F.col("_x") * F.col("_x")
    slope = F.when(F.col("_spread"), F.try_divide(top, bottom))
    return sums.select(MEMBER, F.coalesce(slope, F.lit(0.0)).alias("cost_trend_slope"))


def member_provider_features(pairs: DataFrame, stats: DataFrame, specialties: DataFrame) -> DataFrame:
    """Mean credibility-weighted provider cost and hospital share over the providers a member visited.

    ``pairs`` holds member and provider; repeats count once. Providers without
    statistics score the overall mean, which is taken over providers.
    """
    overall = stats.agg(F.coalesce(F.avg("avg_cost"), F.lit(0.0)).alias("_overall")).scalar()
    peers = specialties.select("specialty", F.col("avg_cost").alias("_specialty_avg"))
    scored = (
        stats.join(peers, "specialty", "left")
        .select(
            PROVIDER,
            X.credibility_score("avg_cost", "claim_count", "_specialty_avg", overall).alias("_score"),
            F.lower("provider_type").contains("hospital").alias("_hospital"),
        )
    )
    return (
        pairs.select(MEMBER, PROVIDER).filter(F.col(PROVIDER).isNotNull()).distinct()
        .join(scored, PROVIDER, "left")
        .groupBy(MEMBER)
        .agg(
            F.avg("_score").alias("_known"),
            F.count("_score").alias("_scored"),
            F.count(F.lit(1)).alias("_all"),
            X.share(F.col("_hospital")).alias("hospital_visit_ratio"),
        )
        .select(
            MEMBER,
            (
                (F.coalesce(F.col("_known"), F.lit(0.0)) * F.col("_scored")
                 + overall * (F.col("_all") - F.col("_scored"))) / F.col("_all")
            ).alias("avg_provider_risk_score"),
            "hospital_visit_ratio",
        )
    )


def member_item_features(
    header: DataFrame,
    items: DataFrame,
    definitions: Mapping[str, Sequence[str]],
    medication: str,
    imaging: str,
) -> DataFrame:
    """Condition flags and medication and imaging shares per member, from one pass over the items.

    Items are summed per claim before they meet the header, so the join moves one row
    per claim.
    """
    columns = {condition_column(n): p for n, p in definitions.items()}
    kinds = {"_medication": medication, "_imaging": imaging}
    per_claim = items.groupBy(CLAIM).agg(
        F.count(F.lit(1)).alias("_items"),
        *[F.sum(X.flag(F.col("activity_type") == kind)).alias(c) for c, kind in kinds.items()],
        *[F.max(X.flag(X.has_prefix(DIAGNOSIS, p))).alias(c) for c, p in columns.items()],
    )

    def share_of(column: str) -> Column:
        return F.coalesce(F.try_divide(F.sum(column), F.sum("_items")), F.lit(0.0))

    return (
        header.select(CLAIM, MEMBER).join(per_claim, CLAIM, "left").groupBy(MEMBER)
        .agg(
            *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in columns],
            share_of("_medication").alias("medication_ratio"),
            share_of("_imaging").alias("imaging_ratio"),
        )
    )


def claim_outcomes(header: DataFrame, necessity_codes: list[str]) -> DataFrame:
    """Pre-authorisation denial rate and medical-necessity denials per member."""
    return header.groupBy(MEMBER).agg(
        X.share(F.col("pre_auth_outcome") == "rejected").alias("pre_auth_denial_rate"),
        F.sum(X.flag(F.col("adjudication_reason").isin(*necessity_codes))).alias("medical_necessity_denial_count"),
    )
