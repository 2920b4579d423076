"""Order-dependent operators: rolling counts, running spend, duplicates, yearly change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from .claims import AMOUNT, CLAIM, DATE, MEMBER, PROVIDER
from .skew import HOT_ROWS, dealt, join_null_safe, running_total_before


def premium_increase(premiums: DataFrame, year: str = "year", premium: str = "premium") -> DataFrame:
    """Relative premium change against the member's previous year; 0 in the first year.

    Input has one row per member and year, so a member's window is a handful of rows.
    """
    order = Window.partitionBy(MEMBER).orderBy(year)
    previous = F.lag(premium).over(order)
    change = F.try_divide(F.col(premium) - previous, previous)
    return premiums.withColumn("premium_increase_percentage", F.coalesce(change, F.lit(0.0)))


def ytd_spend(header: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Spend of the member before each claim within the calendar year."""
    dated = header.withColumn("_year", F.year(DATE))
    return running_total_before(dated, [MEMBER, "_year"], DATE, CLAIM, AMOUNT, "ytd_spend", hot_rows).drop("_year")


def amount_step(unit: float = 0.01, amount: str = AMOUNT) -> Column:
    """Whole units in an amount: what a duplicate signature holds of it."""
    return F.floor(F.col(amount) / F.lit(unit))


def signature_hash(signature: Sequence[str]) -> Column:
    """md5 of the signature columns; null parts are skipped."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in signature]))


def repeated_signatures(claims: DataFrame, signature: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Hashes of signatures that occur more than once, with the place of their first claim.

    The first claim is found by an aggregate, so copies of a very frequent signature are
    never sorted together.
    """
    first = claims.groupBy(signature_hash(signature).alias("claim_hash")).agg(
        F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    return first.filter(F.col("_n") > 1).select("claim_hash", "_first")


def mark_duplicates(
    claims: DataFrame, repeated: DataFrame, signature: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Claims with ``is_duplicate_suspect`` from a table of repeated signatures."""
    hashed = claims.withColumn("claim_hash", signature_hash(signature))
    later = F.col("_first").isNotNull() & (F.struct(*order) > F.col("_first"))
    return (
        hashed.join(repeated, "claim_hash", "left").withColumn("is_duplicate_suspect", X.flag(later)).drop("_first")
    )


def duplicate_claims(claims: DataFrame, signature: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Claims with ``is_duplicate_suspect``: an earlier claim has the same signature."""
    return mark_duplicates(claims, repeated_signatures(claims, signature, order), signature, order)


def _rolling(days: DataFrame, keys: Sequence[str], back: int, value: str, out: str) -> DataFrame:
    """Sum over the last ``back`` days, this one included, on one row per key and day."""
    number = F.datediff(F.col(DATE), F.lit("1970-01-01").cast("date"))
    window = Window.partitionBy(*keys).orderBy(number).rangeBetween(-back, 0)
    return days.withColumn(out, F.sum(value).over(window))


def rolling_claims(claims: DataFrame, keys: Sequence[str], days: int = 7, out: str = "claim_velocity_7d") -> DataFrame:
    """Each claim with the number of claims of the same keys in the last ``days`` days; 0 without a date.

    All claims of one day share the same frame, so the window runs over day counts.
    """
    counts = claims.filter(F.col(DATE).isNotNull()).groupBy(*keys, DATE).agg(F.count(F.lit(1)).alias("_n"))
    rolled = _rolling(counts, keys, days, "_n", out).select(*keys, DATE, out)
    return join_null_safe(claims, rolled, [*keys, DATE], "left").withColumn(out, F.coalesce(out, F.lit(0)))


def refill_frequency(visits: DataFrame, keys: Sequence[str], days: int = 7) -> DataFrame:
    """Most repeats of the keys within ``days`` days, and the visits that had an earlier repeat in reach.

    Both follow from the day counts, so visits are not joined back.
    """
    counts = visits.filter(F.col(DATE).isNotNull()).groupBy(*keys, DATE).agg(F.count(F.lit(1)).alias("_n"))
    rolled = _rolling(counts, keys, days, "_n", "_reach")
    return rolled.groupBy(*keys).agg(
        F.max("_reach").alias("most_in_a_week"),
        F.sum(F.when(F.col("_reach") > 1, F.col("_n")).otherwise(0)).alias("n_repeats"),
    )


def patient_velocity(claims: DataFrame, days: int = 7) -> DataFrame:
    """Claims per member in the ``days`` days up to the member's last visit; 0 without any date."""
    counts = claims.groupBy(MEMBER, DATE).agg(F.count(F.lit(1)).alias("_n"))
    last = counts.groupBy(MEMBER).agg(F.max(DATE).alias("_last"))
    inside = F.datediff(F.col("_last"), F.col(DATE)).between(0, days)
    return join_null_safe(counts, last, [MEMBER]).groupBy(MEMBER).agg(
        F.max("_last").alias(DATE), F.sum(F.when(inside, F.col("_n")).otherwise(0)).alias("claim_velocity_7d")
    )


def unique_providers(claims: DataFrame, days: int | None = None) -> DataFrame:
    """Distinct providers per member: all of them, or those within ``days`` of the last visit."""
    if days is None:
        return claims.groupBy(MEMBER).agg(F.countDistinct(PROVIDER).alias("unique_providers"))
    recent = claims.groupBy(MEMBER, PROVIDER).agg(F.max(DATE).alias("_d"))
    last = recent.groupBy(MEMBER).agg(F.max("_d").alias("_last"))
    inside = F.datediff(F.col("_last"), F.col("_d")).between(0, days) & F.col(PROVIDER).isNotNull()
    return join_null_safe(recent, last, [MEMBER]).groupBy(MEMBER).agg(
        F.sum(X.flag(inside)).alias(f"unique_providers_{days}d")
    )


def rolling_unique_providers(claims: DataFrame, days: int = 30, parts: int | None = None) -> DataFrame:
    """Distinct providers a member saw in the last ``days`` days, per member and visit day.

    A visit makes its provider count from that day until ``days`` days later or the next
    visit to the same provider, whichever is first. These spans never overlap per
    provider, so the count is the running sum of span starts and ends: no list or set
    of providers is held for a day.

    ``parts`` says in how many parts the claims are dealt out, and twice as many for the starts
    and ends. However many claims a key has, a part orders one row per member, provider and day,
    then one per member and day.
    """
    dated = claims.filter(F.col(DATE).isNotNull() & F.col(PROVIDER).isNotNull()).select(MEMBER, PROVIDER, DATE)
    visits = dealt(dated, parts, MEMBER, PROVIDER).distinct()
    following = F.lead(DATE).over(Window.partitionBy(MEMBER, PROVIDER).orderBy(DATE))
    expiry = F.date_add(F.col(DATE), days + 1)
    spans = visits.withColumn("_end", F.least(F.coalesce(following, expiry), expiry))
    steps = spans.select(
        MEMBER,
        F.inline(
            F.array(
                F.struct(F.col(DATE).alias(DATE), F.lit(1).alias("_step"), F.lit(1).alias("_visit")),
                F.struct(F.col("_end").alias(DATE), F.lit(-1).alias("_step"), F.lit(0).alias("_visit")),
            )
        ),
    )
    more = parts and 2 * parts
    # A day of a member has at most one start and one end per provider, so these need no sums before they move.
    daily = dealt(steps, more, MEMBER, DATE).groupBy(MEMBER, DATE).agg(
        F.sum("_step").alias("_step"), F.max("_visit").alias("_visit")
    )
    running = Window.partitionBy(MEMBER).orderBy(DATE).rowsBetween(Window.unboundedPreceding, 0)
    return (
        dealt(daily, more, MEMBER).withColumn(f"unique_providers_{days}d", F.sum("_step").over(running))
        .filter(F.col("_visit") == 1)
        .select(MEMBER, DATE, f"unique_providers_{days}d")
    )


def trailing_seconds_count(
    events: DataFrame, key: str, ts: str, seconds: int = 3600, out: str = "claims_in_last_hour"
) -> DataFrame:
    """Each event with the number of events of its key in the last ``seconds`` seconds, itself included.

    Events are counted per second, and each count is placed in its own time bucket and,
    as history, in the next one. Every frame then lies within one (key, bucket) group of
    at most ``2 * seconds`` rows, however many events a key has.
    """
    stamped = events.withColumn("_s", F.unix_seconds(F.col(ts)))
    per_second = stamped.groupBy(key, "_s").agg(F.count(F.lit(1)).alias("_n"))
    bucket = F.floor(F.col("_s") / seconds)
    placed = per_second.withColumn("_own", bucket).withColumn(
        "_bucket", F.explode(F.array(F.col("_own"), F.col("_own") + 1))
    )
    frame = Window.partitionBy(key, "_bucket").orderBy("_s").rangeBetween(-seconds, 0)
    counted = (
        placed.withColumn(out, F.sum("_n").over(frame))
        .filter(F.col("_bucket") == F.col("_own"))
        .select(key, "_s", out)
    )
    return join_null_safe(stamped, counted, [key, "_s"]).drop("_s")


def session_bounds(ts: str, gap: str) -> list[Column]:
    """First event of a session, and the end of the gap after its last one, as aggregates.

    The fields of ``session_window`` are the same instants, but a filter on those of a grouped
    table is pushed below the grouping, where it drops single events and so cuts sessions.
    """
    return [F.min(ts).alias("session_start"), (F.max(ts) + F.expr(f"INTERVAL {gap}")).alias("session_end")]


def member_sessions(events: DataFrame, key: str, ts: str, gap: str = "30 minutes") -> DataFrame:
    """Episodes of activity per member: a new one starts after a pause of at least ``gap``."""
    return (
        events.groupBy(key, F.session_window(ts, gap).alias("_w"))
        .agg(*session_bounds(ts, gap), F.count(F.lit(1)).alias("n_events"))
        .select(key, "session_start", "session_end", "n_events")
    )
