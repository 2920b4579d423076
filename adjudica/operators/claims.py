"""Joins and aggregations at claim and member grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from .skew import dealt

CLAIM, MEMBER, PROVIDER = "claim_request_bundle_id", "patient_key", "provider_license_key"
AMOUNT, DATE, DIAGNOSIS = "payer_share_amount", "max_serviced_date", "principal_diagnosis_code"


def condition_column(name: str) -> str:
    return "is_" + name.lower().replace(" ", "_")


def split_members(patients: DataFrame, train_percent: int = 70, key: str = MEMBER) -> DataFrame:
    """Distinct members marked ``is_train`` by a hash of the key, the same on every run."""
    return patients.select(key).distinct().withColumn("is_train", X.hashed_percent(key) < train_percent)


def train_claims(header: DataFrame, members: DataFrame) -> DataFrame:
    """Claims of the given members; the id list only filters."""
    return header.join(members.select(MEMBER), MEMBER, "left_semi")


def condition_claims(header: DataFrame, items: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Claims with any diagnosis under one of the prefixes."""
    hits = items.filter(X.has_prefix(DIAGNOSIS, prefixes)).select(CLAIM).distinct()
    return header.join(hits, CLAIM, "left_semi")


def claim_condition_flags(items: DataFrame, definitions: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per claim with a 0/1 column per condition."""
    return items.groupBy(CLAIM).agg(
        *[F.max(X.flag(X.has_prefix(DIAGNOSIS, p))).alias(condition_column(n)) for n, p in definitions.items()]
    )


def member_condition_flags(
    header: DataFrame, items: DataFrame, definitions: Mapping[str, Sequence[str]]
) -> DataFrame:
    """One row per member with claims and a 0/1 column per condition."""
    columns = [condition_column(n) for n in definitions]
    flagged = header.select(CLAIM, MEMBER).join(claim_condition_flags(items, definitions), CLAIM, "left")
    return flagged.groupBy(MEMBER).agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in columns])


def conditions_array(definitions: Mapping[str, Sequence[str]]) -> Column:
    """Sorted condition names from the 0/1 columns."""
    named = [F.when(F.col(condition_column(n)) == 1, F.lit(n)) for n in sorted(definitions)]
    return F.array_compact(F.array(*named))


def conditions_risk(
    definitions: Mapping[str, Sequence[str]], cost: Mapping[str, float], freq: Mapping[str, float]
) -> Column:
    """Sum of mean condition weights from the 0/1 columns."""
    total = F.lit(0.0)
    for name in definitions:
        total = total + F.coalesce(F.col(condition_column(name)), F.lit(0)) * F.lit(X.condition_weight(name, cost, freq))
    return total


def learned_weights(
    header: DataFrame, items: DataFrame, members: DataFrame, definitions: Mapping[str, Sequence[str]]
) -> Column:
    """Mean weight per condition as a map, learnt from the claims of the given members; weights have 2 decimals.

    It is a scalar subquery, so nothing is joined or collected.
    """
    learned = chronic_weights(train_claims(header, members), items, definitions)
    weight = (F.round("cost_weight", 2) + F.round("freq_weight", 2)) / 2
    return learned.agg(F.map_from_entries(F.collect_list(F.struct("condition", weight.alias("weight"))))).scalar()


def learned_risk(definitions: Mapping[str, Sequence[str]], weights: Column) -> Column:
    """Sum of learnt weights from the 0/1 columns; a condition without a weight counts 1."""
    total = F.lit(0.0)
    for name in definitions:
        weight = F.coalesce(F.try_element_at(weights, F.lit(name)), F.lit(1.0))
        total = total + F.coalesce(F.col(condition_column(name)), F.lit(0)) * weight
    return total


def known_diagnoses(items: DataFrame, dimension: DataFrame, keep: Sequence[str] = (CLAIM,)) -> DataFrame:
    """Items with the dimension's code: codes missing from the dimension become null."""
    codes = dimension.select(F.col(DIAGNOSIS).alias("code")).distinct()
    return items.select(*keep, DIAGNOSIS).join(codes, F.col(DIAGNOSIS) == F.col("code"), "left").select(*keep, "code")


def claim_diagnosis(header: DataFrame, items: DataFrame, dimension: DataFrame) -> DataFrame:
    """Claims with their known diagnosis codes, one row per claim and code; a null code where a claim has none."""
    codes = claim_diag_list(known_diagnoses(items, dimension), "code")
    return header.join(codes, CLAIM, "left").na.fill(0, ["multiplicity"])


def claim_diag_list(items: DataFrame, code: str = DIAGNOSIS) -> DataFrame:
    """The list of codes per claim in long form: a row per claim and code with its multiplicity; nulls drop out.

    A claim of any size has this one shape, and no row grows with the claim.
    """
    return (
        items.filter(F.col(code).isNotNull())
        .groupBy(CLAIM, F.col(code).alias("diagnosis_code"))
        .agg(F.count(F.lit(1)).alias("multiplicity"))
    )


def patient_stats(header: DataFrame) -> DataFrame:
    """Total cost and distinct claims per member."""
    return header.groupBy(MEMBER).agg(
        F.sum(AMOUNT).alias("annualized_cost"), F.countDistinct(CLAIM).alias("claim_count")
    )


def patient_cost_join(header: DataFrame) -> DataFrame:
    """Claims with their member's totals; the result stays at claim grain."""
    return header.join(patient_stats(header), MEMBER, "left")


def chronic_weights(header: DataFrame, items: DataFrame, definitions: Mapping[str, Sequence[str]]) -> DataFrame:
    """Cost weight per condition: mean member cost over its claims against all claims, at least 1.

    The means run over claims, each carrying its member's total. Summing per member
    first (claims with the condition times the total) gives the same means without
    joining the totals back to the claims.
    """
    columns = {n: condition_column(n) for n in definitions}
    flagged = header.select(CLAIM, MEMBER, AMOUNT).join(claim_condition_flags(items, definitions), CLAIM, "left")
    members = flagged.groupBy(MEMBER).agg(
        F.sum(AMOUNT).alias("_cost"),
        F.count(F.lit(1)).alias("_claims"),
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in columns.values()],
    )
    known = F.col("_cost").isNotNull()

    def mean(count: Column) -> Column:
        return F.try_divide(F.sum(count * F.col("_cost")), F.sum(F.when(known, count)))

    means = members.agg(
        mean(F.col("_claims")).alias("_overall"), *[mean(F.col(c)).alias(c) for c in columns.values()]
    )
    rows = F.array(
        *[F.struct(F.lit(n).alias("condition"), F.col(c).alias("avg_cost")) for n, c in columns.items()]
    )
    ratio = F.coalesce(F.try_divide(F.col("avg_cost"), F.col("_overall")), F.lit(1.0))
    weight = F.greatest(F.lit(1.0), ratio)
    return means.select("_overall", F.inline(rows)).select(
        "condition", weight.alias("cost_weight"), weight.alias("freq_weight")
    )


def claims_flatten(header: DataFrame, items: DataFrame, team: DataFrame) -> DataFrame:
    """Header, items and care team flattened, without building every item-practitioner pair.

    Flattening repeats a claim once per item and practitioner, so an item stands in as
    many rows as the claim has practitioners and the other way round. One row per
    distinct value with that ``multiplicity`` carries the same multiset in i + c rows
    instead of i * c.
    """
    sizes = claim_fanout(header, items, team)
    diagnoses = items.groupBy(CLAIM, F.col(DIAGNOSIS).alias("value")).agg(F.count(F.lit(1)).alias("_rows"))
    people = team.groupBy(CLAIM, F.col("practitioner_license").cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("_rows")
    )

    def spread(values: DataFrame, kind: str, own: str) -> DataFrame:
        joined = sizes.join(values, CLAIM, "left")
        # The rows of the other side, from both counts: the counts then move once for both kinds.
        other = F.expr(f"fanout div greatest({own}, 1L)")
        return joined.select(
            CLAIM,
            F.lit(kind).alias("kind"),
            "value",
            (F.coalesce(F.col("_rows"), F.lit(1)) * other).alias("multiplicity"),
        )

    return spread(diagnoses, "diagnosis", "n_items").unionByName(spread(people, "practitioner", "n_team"))


def claim_fanout(header: DataFrame, items: DataFrame, team: DataFrame, parts: int | None = None) -> DataFrame:
    """Claims with item and practitioner counts and the rows a full flattening would give."""
    one, none = F.lit(1), F.lit(0)
    # Counted in one grouping, a task holds one table of counts and sorts it once, not one of items and one of team.
    rows = items.select(CLAIM, one.alias("n_items"), none.alias("n_team")).unionByName(
        team.select(CLAIM, none.alias("n_items"), one.alias("n_team"))
    )
    counts = dealt(rows, parts, CLAIM).groupBy(CLAIM).agg(F.sum("n_items").alias("n_items"), F.sum("n_team").alias("n_team"))
    counted = dealt(header, parts, CLAIM).join(counts, CLAIM, "left").na.fill(0, ["n_items", "n_team"])
    return counted.withColumn(
        "fanout", F.greatest(F.col("n_items"), one) * F.greatest(F.col("n_team"), one)
    )


def claims_provider(lines: DataFrame, providers: DataFrame) -> DataFrame:
    """Claims of known providers with the provider's attributes."""
    return lines.join(providers, PROVIDER, "inner")


def claims_patient(header: DataFrame, patients: DataFrame) -> DataFrame:
    return header.join(patients, MEMBER, "left")


def specialty_costs(lines: DataFrame, providers: DataFrame) -> DataFrame:
    """Mean cost per specialty over all claims.

    Sums are taken per provider before the join, so only one row per provider moves.
    """
    sums = lines.groupBy(PROVIDER).agg(F.sum(AMOUNT).alias("_sum"), F.count(AMOUNT).alias("_n"))
    return (
        sums.join(providers.select(PROVIDER, "specialty"), PROVIDER, "inner")
        .groupBy("specialty")
        .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avg_cost"))
    )


def distinct_members(header: DataFrame) -> DataFrame:
    return header.select(MEMBER).distinct()


def new_members(policies: DataFrame, header: DataFrame, before: str | None = None) -> DataFrame:
    """Policy holders without claims, or without claims before a snapshot day."""
    if before is not None:
        header = header.filter(F.col(DATE) < F.lit(before).cast("date"))
    return policies.join(header.select(MEMBER).distinct(), MEMBER, "left_anti")


def pre_auth_rejected_claimed(header: DataFrame, pre_auth: DataFrame) -> DataFrame:
    """Claims made although their pre-authorisation was rejected."""
    rejected = pre_auth.filter(F.col("pre_auth_outcome") == "rejected").select("pre_auth_ref").distinct()
    return header.join(rejected, "pre_auth_ref", "left_semi")


def pre_auth_service_mismatch(items: DataFrame, header: DataFrame, pre_auth: DataFrame) -> DataFrame:
    """Billed items whose procedure is none of those their pre-authorisation names.

    An anti-join on reference and procedure: items are never paired with every
    authorised service.
    """
    asked = pre_auth.filter(F.col("procedure_code").isNotNull()).select("pre_auth_ref", "procedure_code").distinct()
    linked = header.select(CLAIM, "pre_auth_ref").join(asked.select("pre_auth_ref").distinct(), "pre_auth_ref")
    billed = items.filter(F.col("procedure_code").isNotNull()).join(linked, CLAIM)
    return billed.join(asked, ["pre_auth_ref", "procedure_code"], "left_anti")


def member_profitability(policies: DataFrame, header: DataFrame) -> DataFrame:
    """Premium against claim cost per member."""
    cost = header.groupBy(MEMBER).agg(F.sum(AMOUNT).alias("claim_cost"))
    joined = policies.select(MEMBER, "premium").join(cost, MEMBER, "left")
    spent = F.coalesce(F.col("claim_cost"), F.lit(0.0))
    return joined.select(
        MEMBER,
        "premium",
        spent.alias("claim_cost"),
        (F.col("premium") - spent).alias("profit"),
        F.try_divide(spent, F.col("premium")).alias("loss_ratio"),
    )


def diag_proc_top(items: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent procedures per diagnosis; ties by procedure code."""
    counts = (
        items.filter(F.col(DIAGNOSIS).isNotNull() & F.col("procedure_code").isNotNull())
        .groupBy(DIAGNOSIS, "procedure_code")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy(DIAGNOSIS).orderBy(F.desc("n"), "procedure_code")
    return counts.withColumn("rnk", F.row_number().over(order)).filter(F.col("rnk") <= k)


def denial_reason_rollup(header: DataFrame, mapping: DataFrame, amount: str = AMOUNT) -> DataFrame:
    """Denied claims per class (FINANCIAL, MEDICAL, FWA); unmapped reasons count as OTHER.

    Reasons are counted before the mapping joins, so the join sees one row per code.
    """
    counts = header.groupBy("adjudication_reason").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_amount")
    )
    return (
        counts.join(mapping, "adjudication_reason", "left")
        .groupBy(F.coalesce(F.col("denial_class"), F.lit("OTHER")).alias("denial_class"))
        .agg(F.sum("_n").alias("n_claims"), F.sum("_amount").alias("amount"))
    )


def stp_flags(
    header: DataFrame,
    items: DataFrame,
    covered_services: DataFrame,
    complex_prefixes: Sequence[str],
    service: str = "service_key",
) -> DataFrame:
    """Claims with has_pre_auth, service_is_covered and is_complex_diag.

    A claim is covered unless one of its items lies outside the covered services.
    """
    covered = covered_services.select(service).distinct().withColumn("_covered", F.lit(1))
    per_claim = (
        items.join(covered, service, "left")
        .groupBy(CLAIM)
        .agg(
            F.min(F.coalesce(F.col("_covered"), F.lit(0))).alias("service_is_covered"),
            F.max(X.flag(X.has_prefix(DIAGNOSIS, complex_prefixes))).alias("is_complex_diag"),
        )
    )
    return (
        header.withColumn("net_amount", F.col(AMOUNT))
        .withColumn("has_pre_auth", X.flag(F.col("pre_auth_ref").isNotNull()))
        .join(per_claim, CLAIM, "left")
        .na.fill({"service_is_covered": 1, "is_complex_diag": 0})
    )


def medical_items(
    items: DataFrame, header: DataFrame, patients: DataFrame, pairs: DataFrame, gender_rules: DataFrame
) -> DataFrame:
    """Items with the member's attributes and both medical checks."""
    members = header.select(CLAIM, MEMBER).join(patients, MEMBER, "left")
    allowed = pairs.select(DIAGNOSIS, "procedure_code").distinct().withColumn("_allowed", F.lit(True))
    rules = gender_rules.select("procedure_code", "allowed_genders")
    return (
        items.join(members, CLAIM, "left")
        .join(allowed, [DIAGNOSIS, "procedure_code"], "left")
        .join(rules, "procedure_code", "left")
        .withColumn("is_soc_compliant", X.soc_compliant(DIAGNOSIS, "procedure_code", "_allowed"))
        .withColumn("is_gender_compliant", X.gender_compliant("procedure_code", "gender", "allowed_genders"))
        .drop("_allowed", "allowed_genders")
    )
