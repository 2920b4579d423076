"""Evaluation and monitoring: one aggregate each, whatever the number of rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import decisions as D
from .skew import HOT_ROWS, exact_percentiles, hashed_rank, in_ranges


def abs_error(actual: str, predicted: str) -> Column:
    return F.abs(F.col(actual) - F.col(predicted))


def mae(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.avg(abs_error(actual, predicted)).alias("mae"))


def champion_challenger(df: DataFrame, actual: str, champion: str, challenger: str) -> DataFrame:
    """Both errors, the relative improvement and the decision; promotion needs a strictly lower error."""
    errors = df.agg(
        F.avg(abs_error(actual, champion)).alias("champion_mae"),
        F.avg(abs_error(actual, challenger)).alias("challenger_mae"),
    )
    gain = F.try_divide(F.col("champion_mae") - F.col("challenger_mae"), F.col("champion_mae"))
    return errors.withColumn("improvement", F.coalesce(gain, F.lit(0.0))).withColumn(
        "decision", F.when(F.col("challenger_mae") < F.col("champion_mae"), "PROMOTE").otherwise("KEEP")
    )


def perf_gate(df: DataFrame, actual: str, champion: str, challenger: str, floor: float = -0.02) -> DataFrame:
    """Passes unless the candidate is worse than the floor allows."""
    return champion_challenger(df, actual, champion, challenger).withColumn(
        "passed", F.col("improvement") >= F.lit(floor)
    )


def bias_disparity(df: DataFrame, group: str, actual: str, predicted: str, limit: float = 0.15) -> DataFrame:
    """Relative distance of each group's error from the overall error, and whether it is within the limit.

    The overall error follows from the group sums, so the rows are read once.
    """
    groups = df.groupBy(group).agg(F.sum(abs_error(actual, predicted)).alias("_e"),
                                   F.count(abs_error(actual, predicted)).alias("_n"))
    overall = groups.agg(F.try_divide(F.sum("_e"), F.sum("_n"))).scalar()
    own = F.try_divide(F.col("_e"), F.col("_n"))
    gap = F.coalesce(F.try_divide(F.abs(own - overall), overall), F.lit(0.0))
    return groups.select(group, own.alias("mae"), gap.alias("disparity"), (gap <= limit).alias("passed"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def accuracy_f1(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy and support-weighted F1 from the confusion counts."""
    counts = confusion(df, actual, predicted)
    # A class's support, predictions and hits, from the few rows of the confusion table.
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), F.lit(0).alias("called"),
                         F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).alias("support"), F.col("n").alias("called"),
                         F.lit(0).alias("hit")),
            )
        )
    )
    classes = sides.groupBy("label").agg(F.sum("support").alias("s"), F.sum("called").alias("c"), F.sum("hit").alias("h"))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("h"), F.col("s") + F.col("c")), F.lit(0.0))
    return classes.agg(
        F.try_divide(F.sum("h"), F.sum("s")).alias("accuracy"),
        F.try_divide(F.sum(f1 * F.col("s")), F.sum("s")).alias("f1_weighted"),
    )


def label_precision(df: DataFrame, actual: str, predicted: str, labels: Sequence, floor: float = 0.95) -> DataFrame:
    """Precision of the given labels, 0 where one is never predicted, and whether it meets the floor."""
    counts = confusion(df, actual, predicted)
    parts = []
    for label in labels:
        called = F.sum(F.when(F.col("predicted") == label, F.col("n")).otherwise(0))
        hit = F.sum(F.when((F.col("predicted") == label) & (F.col("actual") == label), F.col("n")).otherwise(0))
        parts.append(F.struct(F.lit(str(label)).alias("label"),
                              F.coalesce(F.try_divide(hit, called), F.lit(0.0)).alias("precision")))
    return counts.agg(F.array(*parts).alias("_p")).select(F.inline("_p")).withColumn(
        "passed", F.col("precision") >= floor
    )


def auc(df: DataFrame, actual: str, score: str, per: int = HOT_ROWS) -> DataFrame:
    """Area under the ROC curve, ties counting half.

    Equal scores are counted together, then placed in ranges of the real order: positives
    in a range beat all negatives of the ranges below, and only scores of one range are
    sorted together.
    """
    scores = (
        df.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("_v"))
        .agg(F.sum(F.when(F.col(actual) == 1, 1).otherwise(0)).alias("_p"),
             F.sum(F.when(F.col(actual) == 1, 0).otherwise(1)).alias("_n"))
    )
    sized = scores.withColumn("_size", scores.agg(F.count(F.lit(1))).scalar())
    ranged = in_ranges(sized, [], "_v", "_size", "_range", per)
    # As many rows as ranges, so ordering them together is safe.
    below = Window.partitionBy("_one").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy("_range").agg(F.sum("_n").alias("_held")).withColumn("_one", F.lit(1))
        .select("_range", F.coalesce(F.sum("_held").over(below), F.lit(0)).alias("_below"))
    )
    inside = Window.partitionBy("_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("_p") * (F.col("_below") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) + F.col("_n") / 2.0)
    return (
        ranged.join(F.broadcast(totals), "_range").withColumn("_wins", wins)
        .agg(F.try_divide(F.sum("_wins"), F.sum("_p").cast("double") * F.sum("_n")).alias("auc"))
    )


def drift_check(live: DataFrame, base: DataFrame, limits: Sequence[tuple[str, float]]) -> DataFrame:
    """Relative move of each column's mean against the training data; no rows on a side gives no check."""
    names = [c for c, _ in limits]

    def means(df: DataFrame, tag: str) -> DataFrame:
        parts = [F.struct(F.lit(c).alias("metric"), F.avg(c).alias(tag)) for c in names]
        return df.agg(F.array(*parts).alias("_m")).select(F.inline("_m"))

    limit = reduce(lambda w, p: w.when(F.col("metric") == p[0], p[1]), limits, F.when(F.lit(False), 0.0))
    joined = means(live, "live_mean").join(means(base, "base_mean"), "metric")
    move = F.try_divide(F.abs(F.col("live_mean") - F.col("base_mean")), F.col("base_mean"))
    return (
        joined.filter(F.col("live_mean").isNotNull() & F.col("base_mean").isNotNull())
        .withColumn("relative_move", F.coalesce(move, F.lit(0.0)))
        .withColumn("drifted", F.col("relative_move") > limit)
    )


def prediction_report(log: DataFrame, prediction: str) -> DataFrame:
    return log.agg(F.count(F.lit(1)).alias("n_predictions"), F.avg(prediction).alias("mean_prediction"))


def threshold_gate(metrics: DataFrame, limits: Sequence[tuple[str, float | None, float | None]]) -> DataFrame:
    """Rows of (metric, value) with pass or fail against (name, low, high).

    A limit whose metric has no row gives a row with a null value that has not passed; a
    metric without a limit passes.
    """
    verdict = F.when(F.lit(False), F.lit(True))
    for name, low, high in limits:
        verdict = verdict.when(F.col("metric") == name, D.within("value", low, high))
    if not limits:
        return metrics.withColumn("passed", F.lit(True))
    spark = metrics.sparkSession
    wanted = spark.createDataFrame([(name, True) for name, _, _ in limits], "metric string, _wanted boolean").distinct()
    joined = metrics.join(wanted, "metric", "full")
    return joined.withColumn("passed", F.coalesce(verdict, F.col("_wanted").isNull())).drop("_wanted")


def business_value(
    decisions: DataFrame, decision: str, amount: str, saving: float = 5.5, prevented: float = 0.8
) -> DataFrame:
    """Straight-through rate, review savings and prevented payout over a decision log."""
    auto = F.sum(F.when(F.col(decision) == "AUTO_APPROVED", 1).otherwise(0))
    denied = F.sum(F.when(F.col(decision) == "AUTO_DENIED", F.col(amount)).otherwise(0.0))
    return decisions.agg(
        F.count(F.lit(1)).alias("n_claims"),
        F.try_divide(auto, F.count(F.lit(1))).alias("stp_rate"),
        (auto * saving).alias("review_savings"),
        (denied * prevented).alias("prevented_amount"),
        F.avg(amount).alias("mean_amount"),
    )


def retention_value(members: DataFrame, churn_probability: str, keep_below: float = 0.5, value: float = 1200.0) -> DataFrame:
    """Members expected to stay and what they are worth."""
    kept = F.sum(F.when(F.col(churn_probability) < keep_below, 1).otherwise(0))
    return members.agg(kept.alias("retained_members"), (kept * value).alias("retained_value"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and total counts of all columns in one pass, one row per column."""
    parts = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("n_null"),
                 F.count(F.lit(1)).alias("n_total"))
        for c in columns
    ]
    return df.agg(F.array(*parts).alias("_p")).select(F.inline("_p"))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns typed int, double, float or bigint."""
    wanted = {"int", "double", "float", "bigint"}
    return [n for n, t in df.dtypes if t in wanted and n not in exclude]


def align_columns(train: DataFrame, test: DataFrame, drop: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides without the dropped columns; the test side gets the training columns, 0 where absent."""
    kept = train.drop(*drop)
    present = set(test.columns)
    return kept, test.select(*[F.col(c) if c in present else F.lit(0).alias(c) for c in kept.columns])


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of column pairs over rows complete in ``columns``, in one aggregate."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns])
    parts = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.corr(a, b).alias("corr")) for a, b in pairs
    ]
    return df.filter(complete).agg(F.array(*parts).alias("_c")).select(F.inline("_c"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every pair of the given columns, both orders and the diagonal."""
    upper = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    half = correlations(df, upper, columns)
    sides = F.when(F.col("col_a") == F.col("col_b"), F.array(F.struct("col_a", "col_b", "corr"))).otherwise(
        F.array(
            F.struct("col_a", "col_b", "corr"),
            F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr"),
        )
    )
    return half.select(F.inline(sides))


def target_correlation(df: DataFrame, columns: Sequence[str], target: str, k: int = 6) -> DataFrame:
    """Features by correlation with the target, strongest first."""
    pairs = [(c, target) for c in columns]
    top = correlations(df, pairs, [*columns, target]).select(F.col("col_a").alias("feature"), "corr")
    return top.orderBy(F.desc_nulls_last("corr"), "feature").limit(k)


def stratified_split(df: DataFrame, label: str, key: str, test_share: float) -> DataFrame:
    """Rows marked ``is_test``: the same share of every label, chosen by the hash of the key."""
    ranked = hashed_rank(df, label, key, "_rank")
    place = F.when(F.col("_rank_total") > 1, F.col("_rank") / (F.col("_rank_total") - 1)).otherwise(0.0)
    return ranked.withColumn("is_test", place >= 1.0 - test_share).drop("_rank", "_rank_total")


def quantile_label(worklist: DataFrame, score: str, quantile: float = 0.25, min_rows: int = 5) -> DataFrame:
    """``is_fraud`` for scores below the quantile; empty when rows or a class are too few to train on."""
    cut = exact_percentiles(worklist, [], score, [quantile], ["_cut"])
    labelled = worklist.withColumn("is_fraud", F.when(F.col(score) < cut.scalar(), 1).otherwise(0))
    sizes = labelled.agg(
        ((F.count(F.lit(1)) >= min_rows) & (F.sum("is_fraud") >= 2)
         & (F.count(F.lit(1)) - F.sum("is_fraud") >= 2)).alias("_enough")
    )
    return labelled.filter(sizes.scalar())


def supervised_switch(df: DataFrame, labels: DataFrame, supervised: str, forest: str, minimum: int = 50) -> DataFrame:
    """Supervised score once more than ``minimum`` fraud labels exist, else the forest score."""
    enough = labels.filter(F.col("is_fraud") == 1).agg(F.count(F.lit(1))).scalar() > minimum
    return df.withColumn("score", F.when(enough, F.col(supervised)).otherwise(F.col(forest))).withColumn(
        "scored_by", F.when(enough, "supervised").otherwise("forest")
    )


