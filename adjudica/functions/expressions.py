"""Scalar features as Column expressions: built-in functions only, no Python per row."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Cols = Column | str

DEFAULT_PLAN_LIMIT = 10000.0
OUT_OF_NETWORK_TIER = 2
CREDIBILITY_CLAIMS = 20.0


def _c(column: Cols) -> Column:
    return F.col(column) if isinstance(column, str) else column


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def share(condition: Column) -> Column:
    """Aggregate: share of rows that meet the condition; unknown counts as no."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def has_prefix(code: Cols, prefixes: Sequence[str]) -> Column:
    """True when a code starts with one of the prefixes; null is false."""
    tests = [_c(code).startswith(p) for p in prefixes]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)) if tests else F.lit(False)


def any_has_prefix(codes: Cols, prefixes: Sequence[str]) -> Column:
    """True when any element of a code list starts with one of the prefixes."""
    return F.coalesce(F.exists(_c(codes), lambda code: has_prefix(code, prefixes)), F.lit(False))


def derive_conditions(codes: Cols, definitions: Mapping[str, Sequence[str]]) -> Column:
    """Names of the conditions met by a code list, each at most once."""
    names = [F.when(any_has_prefix(codes, p), F.lit(name)) for name, p in definitions.items()]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def condition_weight(name: str, cost: Mapping[str, float], freq: Mapping[str, float]) -> float:
    return (cost.get(name, 1.0) + freq.get(name, 1.0)) / 2.0


def listed_condition_score(conditions: Cols, cost: Mapping[str, float], freq: Mapping[str, float]) -> Column:
    """Sum of mean weights over listed conditions, duplicates counted; unknown names weigh 1."""
    names = sorted(set(cost) | set(freq))
    if names:
        pairs = [F.lit(x) for n in names for x in (n, float(condition_weight(n, cost, freq)))]
        weights = F.create_map(*pairs)

        def weigh(total: Column, name: Column) -> Column:
            return total + F.coalesce(F.try_element_at(weights, F.coalesce(name, F.lit(""))), F.lit(1.0))
    else:

        def weigh(total: Column, name: Column) -> Column:
            return total + F.lit(1.0)

    return F.coalesce(F.aggregate(_c(conditions), F.lit(0.0), weigh), F.lit(0.0))


def condition_risk_score(
    codes: Cols,
    definitions: Mapping[str, Sequence[str]],
    cost: Mapping[str, float],
    freq: Mapping[str, float],
) -> Column:
    """Sum of mean weights over the distinct conditions found in a code list."""
    parts = [
        F.when(any_has_prefix(codes, p), F.lit(float(condition_weight(name, cost, freq)))).otherwise(0.0)
        for name, p in definitions.items()
    ]
    return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row: list functions do not share equal parts."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def list_iqr(costs: Cols) -> Column:
    """Interquartile range of a list, linear interpolation; 0 for short lists or lists with nulls."""

    def between(values: Column) -> Column:
        n = F.size(values)

        def at(q: float) -> Column:
            pos = (n - 1) * F.lit(q)
            low, high = F.floor(pos).cast("int"), F.ceil(pos).cast("int")
            return F.get(values, low) + (F.get(values, high) - F.get(values, low)) * (pos - low)

        clean = (n > 1) & ~F.exists(values, lambda v: v.isNull())
        return F.coalesce(F.when(clean, at(0.75) - at(0.25)), F.lit(0.0))

    return bound(F.array_sort(_c(costs).cast("array<double>")), between)


def list_share(values: Cols, wanted: str) -> Column:
    """Share of list elements equal to ``wanted``; nulls stay in the length; 0 when empty."""
    column = _c(values)
    hits = F.size(F.filter(column, lambda v: v == F.lit(wanted)))
    return F.coalesce(F.when(F.size(column) > 0, hits / F.size(column)), F.lit(0.0))


def list_count_in(values: Cols, wanted: Sequence[str]) -> Column:
    """Number of list elements found in ``wanted``."""
    if not wanted:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(_c(values), lambda v: v.isin(*wanted))), F.lit(0))


def distinct_size(values: Cols) -> Column:
    return F.coalesce(F.size(F.array_distinct(_c(values))), F.lit(0))


def visit_gap_std(dates: Cols) -> Column:
    """Population deviation of the day gaps between sorted visits; 0 below two dates."""
    days = F.array_sort(F.filter(F.transform(_c(dates), lambda d: d.try_cast("date")), lambda d: d.isNotNull()))

    def deviation(days: Column) -> Column:
        n = F.size(days) - 1
        tail = F.slice(days, F.lit(2), F.greatest(n, F.lit(0)))
        head = F.slice(days, F.lit(1), F.greatest(n, F.lit(0)))
        gaps = F.zip_with(tail, head, lambda b, a: F.datediff(b, a).cast("double"))
        zero = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("squares"))
        sums = F.aggregate(
            gaps, zero, lambda s, g: F.struct((s["total"] + g).alias("total"), (s["squares"] + g * g).alias("squares"))
        )

        def spread(s: Column) -> Column:
            variance = F.greatest(s["squares"] / n - (s["total"] / n) * (s["total"] / n), F.lit(0.0))
            return F.coalesce(F.when(n > 0, F.sqrt(variance)), F.lit(0.0))

        return bound(sums, spread)

    return bound(days, deviation)


def cost_trend_slope(dates: Cols, costs: Cols) -> Column:
    """Least-squares slope of cost per day over parallel lists; 0 where undefined."""
    pairs = F.filter(
        F.arrays_zip(
            F.transform(_c(dates), lambda d: d.try_cast("date")).alias("d"),
            _c(costs).cast("array<double>").alias("y"),
        ),
        lambda p: p["d"].isNotNull() & p["y"].isNotNull(),
    )
    same_size = F.size(_c(dates)) == F.size(_c(costs))

    def over(pairs: Column) -> Column:
        n = F.size(pairs)

        def sums(first: Column) -> Column:
            points = F.transform(
                pairs, lambda p: F.struct(F.datediff(p["d"], first).cast("double").alias("x"), p["y"].alias("y"))
            )
            terms = {
                "sx": lambda p: p["x"], "sy": lambda p: p["y"], "sxx": lambda p: p["x"] * p["x"], "sxy": lambda p: p["x"] * p["y"],
            }
            zero = F.struct(*[F.lit(0.0).alias(k) for k in terms])
            return F.aggregate(points, zero, lambda s, p: F.struct(*[(s[k] + term(p)).alias(k) for k, term in terms.items()]))

        def slope(s: Column) -> Column:
            steep = F.try_divide(n * s["sxy"] - s["sx"] * s["sy"], n * s["sxx"] - s["sx"] * s["sx"])
            return F.coalesce(F.when(same_size & (n >= 2), F.nanvl(steep, F.lit(0.0))), F.lit(0.0))

        return bound(bound(F.array_min(F.transform(pairs, lambda p: p["d"])), sums), slope)

    return bound(pairs, over)


def recent_count(dates: Cols, current: Cols, days: int = 7) -> Column:
    """List elements at most ``days`` whole days before ``current``, both ends included."""
    end = _c(current)
    inside = F.filter(_c(dates), lambda d: F.datediff(end, d.cast("date")).between(0, days))
    return F.coalesce(F.when(end.isNotNull(), F.size(inside)), F.lit(0))


def plan_utilization(prior: Cols, amount: Cols, limit: Cols) -> Column:
    """Share of the plan limit used once this claim is paid; null amount gives null."""
    used = F.coalesce(_c(prior), F.lit(0.0)) + _c(amount)
    return F.try_divide(used, F.coalesce(_c(limit), F.lit(DEFAULT_PLAN_LIMIT)))


def network_tier(tier: Cols) -> Column:
    return F.coalesce(_c(tier), F.lit(OUT_OF_NETWORK_TIER))


def round_amount(amount: Cols) -> Column:
    """1 when the amount is a multiple of 100."""
    return flag(_c(amount) % 100 == 0)


def first_digit(amount: Cols) -> Column:
    """First digit of the whole part as text; null for null."""
    return F.substring(F.abs(_c(amount).cast("bigint")).cast("string"), 1, 1)


def starts_with_nine(amount: Cols) -> Column:
    return flag(first_digit(amount) == "9")


def out_of_pocket_ratio(cost: Cols, premium: Cols) -> Column:
    """Cost over premium held in 0..2; a zero premium gives 2 when there is any cost."""
    c, p = _c(cost), _c(premium)
    ratio = F.least(F.greatest(F.try_divide(c, p), F.lit(0.0)), F.lit(2.0))
    zero = F.when(c > 0, 2.0).otherwise(0.0)
    return F.when(p == 0, zero).otherwise(F.coalesce(F.when(c.isNotNull() & p.isNotNull(), ratio), F.lit(0.0)))


def claim_hash(service_date: Cols, amount: Cols, provider: Cols) -> Column:
    """md5 of date, amount and provider; equal claims get equal hashes."""
    return F.md5(F.concat_ws("|", *[_c(c).cast("string") for c in (service_date, amount, provider)]))


def parse_list_text(text: Cols) -> Column:
    """``"['a','b']"`` as an array; anything else is an empty array."""
    column = _c(text)
    looks_listed = column.startswith("[") & column.endswith("]")
    parsed = F.from_json(F.when(looks_listed, F.regexp_replace(column, "'", '"')), "array<string>")
    return F.coalesce(parsed, F.array().cast("array<string>"))


def soc_compliant(diagnosis: Cols, procedure: Cols, allowed: Cols) -> Column:
    """1 when the pair is an allowed one, or when either code is missing."""
    missing = F.coalesce(_c(diagnosis), F.lit("")).eqNullSafe("") | F.coalesce(_c(procedure), F.lit("")).eqNullSafe("")
    return F.when(missing, 1).otherwise(flag(_c(allowed)))


def normal_gender(gender: Cols) -> Column:
    """'Male'/'Female' spellings reduced to the rule codes 'M' and 'F'."""
    g = F.lower(F.trim(_c(gender)))
    return F.when(g.isin("m", "male"), "M").when(g.isin("f", "female"), "F").otherwise(_c(gender))


def gender_compliant(procedure: Cols, gender: Cols, allowed: Cols) -> Column:
    """1 unless the procedure is restricted to genders other than the member's."""
    missing = F.coalesce(_c(procedure), F.lit("")).eqNullSafe("") | F.coalesce(_c(gender), F.lit("")).eqNullSafe("")
    unrestricted = F.coalesce(F.size(_c(allowed)), F.lit(0)) == 0
    return F.when(missing | unrestricted, 1).otherwise(flag(F.array_contains(_c(allowed), normal_gender(gender))))


def credibility_score(avg_cost: Cols, claims: Cols, specialty_avg: Cols, overall: Cols) -> Column:
    """Provider cost pulled to its specialty by claim volume; unknown providers get the overall mean."""
    z = _c(claims) / (_c(claims) + F.lit(CREDIBILITY_CLAIMS))
    blended = z * _c(avg_cost) + (1 - z) * F.coalesce(_c(specialty_avg), _c(overall))
    return F.coalesce(blended, _c(overall), F.lit(0.0))


def hashed_uniform(key: Cols, salt: str = "") -> Column:
    """Number in [0, 1) fixed by the key: the same on every run and every layout."""
    digits = F.substring(F.md5(F.concat(_c(key).cast("string"), F.lit(salt))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def hashed_percent(key: Cols) -> Column:
    """Whole number 0..99 fixed by the key."""
    return F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint") % 100
