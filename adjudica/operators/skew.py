"""Order-dependent operators that stay balanced when one key owns a large share of rows.

A window over ``PARTITION BY member`` sorts a member's whole history in one task. The
operators here give the same values from pre-aggregated steps: only groups of bounded
size are ever sorted together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups up to this many rows may be handled by one task.
HOT_ROWS = 1_000_000
# Keys that may be broadcast.
HOT_KEYS = 10_000
# Cuts of one group into ranges, at most, and ranges per HOT_ROWS rows of it.
CUTS, FINENESS = 4096, 8
# Rows in a part of a table that is dealt out, and the least that a core is used for.
ROWS_PER_PART, ROWS_PER_CORE = 500_000, 5_000
# Times that a selection narrows its ranges; each divides what is ordered by up to CUTS, so one serves
# groups of up to CUTS * HOT_ROWS / FINENESS (5e8) distinct values, two any group.
NARROWINGS = 1


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", bounded: bool = False
) -> DataFrame:
    """Equi-join on ``keys`` where null matches null; the left keys are kept.

    ``bounded`` marks a right side whose size is limited by construction, which may be
    broadcast.
    """
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    renamed = F.broadcast(renamed) if bounded else renamed
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def part_count(table: DataFrame) -> int:
    """Parts for the rows of a table: one a core where there are rows for it, and at most ``ROWS_PER_PART`` rows in each.

    Counting a stored Parquet table reads its footers alone; count that, not what is made of it.
    """
    rows, cores = table.count(), table.sparkSession.sparkContext.defaultParallelism
    return max(min(cores, rows // ROWS_PER_CORE), -(-rows // ROWS_PER_PART), 1)


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """``df`` hashed on ``keys`` into ``parts`` parts; without ``parts`` left to the session's settings.

    A session has a fixed number of shuffle partitions, and small ones are merged, so that the
    rows of a task that sorts or groups grow with the table; a number taken from its rows keeps them.
    """
    return df.repartition(parts, *keys) if parts else df


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys owning more than ``hot_rows`` rows, the ``HOT_KEYS`` largest of them.

    The limit bounds what is broadcast, whatever the distribution; further keys take the
    way of ordinary ones, which gives the same values.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    return counted.orderBy(F.desc("_n"), *keys).limit(HOT_KEYS).select(*keys)


def in_ranges(
    rows: DataFrame, group: Sequence[str], value: str, size: str, out: str, per: int = HOT_ROWS, salt: int = 0
) -> DataFrame:
    """``rows`` with the number ``out`` of the range of ``value`` that a row falls in, within its group.

    Without ``group`` all rows are one. ``size`` holds the rows of the group. The cuts are the values whose hash is a multiple
    of a step, so they are an even sample of the distinct values whatever these are, and a
    repeated task finds the same. A range has about ``per / FINENESS`` rows, and fewer than
    ``per`` but for one case in thousands, up to ``CUTS`` ranges a group. Cuts take
    8 * FINENESS bytes per ``per`` rows in total, which bounds what is broadcast.
    """
    ranges = F.least(F.lit(CUTS), F.ceil(F.col(size) * FINENESS / max(per, 1)))
    step = F.greatest(F.lit(1), F.floor(F.col(size) / ranges)).cast("long")
    chosen = rows.filter(F.pmod(F.xxhash64(value, F.lit(salt)), step) == 0)
    found = F.sort_array(F.collect_set(value)).alias("_cuts")

    def search(at: Column, width: Column) -> Column:
        return F.when(F.get("_cuts", at + width - 1) <= F.col(value), at + width).otherwise(at)

    widths = F.array(*[F.lit(2**k) for k in reversed(range(CUTS.bit_length()))])
    if group:
        cut = join_null_safe(rows, chosen.groupBy(*group).agg(found), group, "left", bounded=True)
    else:
        cut = rows.withColumn("_cuts", chosen.agg(found).scalar())
    return cut.withColumn(out, F.aggregate(widths, F.lit(0), search)).drop("_cuts")


def running_total_before(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    tie: str,
    value: str,
    out: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the same ``keys``, ordered by ``day`` then ``tie``.

    Day sums are aggregated first, so the window over a key's history sees one row per
    day. Rows of one day are ordered by ``tie``; a day with more than ``hot_rows`` rows is
    cut into ranges of the real order, whose sums are added up in the same way.
    """
    dated = [*keys, day]
    amount = F.coalesce(F.col(value), F.lit(0.0))
    history = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    days = (
        df.groupBy(*dated)
        .agg(F.sum(amount).alias("_sum"), F.count(F.lit(1)).alias("_n"))
        .select(*dated, F.coalesce(F.sum("_sum").over(history), F.lit(0.0)).alias("_before"), "_n")
    )
    rows = join_null_safe(df, days, dated)

    in_day = Window.partitionBy(*dated).orderBy(tie).rowsBetween(Window.unboundedPreceding, -1)
    cold = rows.filter(F.col("_n") <= hot_rows).withColumn(
        out, F.col("_before") + F.coalesce(F.sum(amount).over(in_day), F.lit(0.0))
    )

    hot = in_ranges(rows.filter(F.col("_n") > hot_rows), dated, tie, "_n", "_range", hot_rows)
    ranged = [*dated, "_range"]
    over_ranges = Window.partitionBy(*dated).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        hot.groupBy(*ranged)
        .agg(F.sum(amount).alias("_sum"))
        .select(*ranged, F.coalesce(F.sum("_sum").over(over_ranges), F.lit(0.0)).alias("_in_day"))
    )
    in_range = Window.partitionBy(*ranged).orderBy(tie).rowsBetween(Window.unboundedPreceding, -1)
    hot = join_null_safe(hot, ranges, ranged).withColumn(
        out, F.col("_before") + F.col("_in_day") + F.coalesce(F.sum(amount).over(in_range), F.lit(0.0))
    )
    columns = [*df.columns, out]
    return cold.select(*columns).unionByName(hot.select(*columns))


def _interpolate(low: Column, high: Column, share: Column) -> Column:
    return low + (high - low) * share


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Sequence[float],
    outs: Sequence[str],
    weight: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact linear-interpolated percentiles per group; ``weight`` counts repeated rows.

    Ordinary groups use the built-in ``percentile``, which holds a group's distinct
    values in one buffer. Groups above ``hot_rows`` rows are resolved by rank: values are
    counted, ranges of the real order are narrowed to those that hold the wanted ranks, and
    only what is left is ordered. With no keys the whole table is one group and takes the
    second way. Null values do not count; a group without any value gives no row.
    """
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w")
    )
    if not keys:
        return _percentiles_by_rank(rows, keys, quantiles, outs, hot_rows)
    hot = hot_keys(rows, keys, hot_rows)
    probs = F.array(*[F.lit(float(q)) for q in quantiles])
    cold = (
        join_null_safe(rows, hot, keys, "left_anti", bounded=True)
        .groupBy(*keys)
        .agg(F.percentile("_v", probs, F.col("_w")).alias("_p"))
        .select(*keys, *[F.col("_p")[i].alias(o) for i, o in enumerate(outs)])
    )
    heavy = join_null_safe(rows, hot, keys, "left_semi", bounded=True)
    ranked = _percentiles_by_rank(heavy, keys, quantiles, outs, hot_rows)
    return cold.unionByName(ranked)


def _holds(first: str, size: str, ranks: Sequence[Column]) -> Column:
    """Whether one of the ranks lies among the ``size`` places from ``first``."""
    return reduce(lambda a, b: a | b, [(r >= F.col(first)) & (r < F.col(first) + F.col(size)) for r in ranks])


def narrowed(rows: DataFrame, group: Sequence[str], ranks: Sequence[Column], per: int, level: int) -> DataFrame:
    """The counted values (``_v``, ``_c``) in those ranges of a group that hold one of the ranks.

    ``_first`` is the place of the group's first value and ``_size`` its distinct values;
    both become those of the range, whose number is the new column ``_range<level>``.
    """
    name = f"_range{level}"
    inner = [*group, name]
    placed = in_ranges(rows, group, "_v", "_size", name, per, salt=level)
    before = Window.partitionBy(*group).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        placed.groupBy(*inner, "_n", "_first")
        .agg(F.sum("_c").alias("_held"), F.count(F.lit(1)).alias("_size"))
        .withColumn("_first", F.col("_first") + F.coalesce(F.sum("_held").over(before), F.lit(0)))
        .filter(_holds("_first", "_held", ranks))
        .select(*inner, "_first", "_size")
    )
    # One range per rank and group at most.
    return join_null_safe(placed.drop("_first", "_size"), wanted, inner, bounded=True)


def _percentiles_by_rank(
    rows: DataFrame, keys: Sequence[str], quantiles: Sequence[float], outs: Sequence[str], per: int
) -> DataFrame:
    group = list(keys)
    counts = rows.groupBy(*group, "_v").agg(F.sum("_w").alias("_c"))
    size = F.struct(F.sum("_c").alias("n"), F.count(F.lit(1)).alias("distinct")).alias("_s")
    if group:
        left = join_null_safe(counts, counts.groupBy(*group).agg(size), group, bounded=True)
    else:
        left = counts.withColumn("_s", counts.agg(size).scalar())
    left = left.select(
        *group, "_v", "_c", F.col("_s.n").alias("_n"), F.col("_s.distinct").alias("_size"), F.lit(0).cast("long").alias("_first")
    )

    def position(q: float) -> Column:
        return F.lit(float(q)) * (F.col("_n") - 1)

    ranks = [f(position(q)) for q in quantiles for f in (F.floor, F.ceil)]
    ranges: list[str] = []
    for level in range(NARROWINGS):
        left = narrowed(left, [*group, *ranges], ranks, per, level)
        ranges.append(f"_range{level}")
    inside = Window.partitionBy(*group, *ranges).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = left.withColumn("_at", F.col("_first") + F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    picks = placed.groupBy(*group, "_n").agg(
        *[F.max(F.when(_holds("_at", "_c", [r]), F.col("_v"))).alias(f"_r{i}") for i, r in enumerate(ranks)]
    )
    result = [
        _interpolate(F.col(f"_r{2 * i}"), F.col(f"_r{2 * i + 1}"), position(q) - F.floor(position(q))).alias(o)
        for i, (q, o) in enumerate(zip(quantiles, outs))
    ]
    return picks.select(*keys, *result)


def hashed_rank(df: DataFrame, label: str, key: str, out: str, digits: int = 4) -> DataFrame:
    """Zero-based rank of each row within ``label`` in the order of ``md5(key)``, and the label's size.

    Hash prefixes cut every label into even slices; ranks inside a slice are shifted by
    the number of rows in the slices before it. ``df`` is read twice: store it first if it
    is dear to compute.
    """
    hashed = df.withColumn("_h", F.md5(F.col(key).cast("string"))).withColumn("_slice", F.substring("_h", 1, digits))
    before = Window.partitionBy(label).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(label)
    slices = (
        hashed.groupBy(label, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            label,
            "_slice",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(whole).alias(f"{out}_total"),
        )
    )
    inside = Window.partitionBy(label, "_slice").orderBy("_h", key)
    return (
        join_null_safe(hashed, slices, [label, "_slice"])
        .withColumn(out, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_h", "_slice", "_before")
    )
