"""Feature functions over member and claim tables: ``(df, artifacts) -> df``.

``artifacts`` holds learned parameters. A small table may be a dict, which becomes a map
literal; a table that grows with the data is a DataFrame and is joined.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import expressions as X

Artifacts = Mapping[str, Any]


def lookup(table: Mapping[str, Any], key: Column) -> Column:
    """Value of a small dict for a key column; null when absent."""
    if not table:
        return F.lit(None)
    pairs = F.create_map(*[F.lit(x) for k, v in table.items() for x in (str(k), v)])
    return F.try_element_at(pairs, F.coalesce(key.cast("string"), F.lit("")))


def _weights(artifacts: Artifacts) -> tuple[Mapping[str, float], Mapping[str, float]]:
    return artifacts["chronic_condition_cost_weights"], artifacts["chronic_condition_freq_weights"]


def create_onboarding_features(df: DataFrame, artifacts: Artifacts) -> DataFrame:
    """Chronic score of the conditions an applicant reports, and its product with age."""
    conditions = F.col("self_reported_conditions")
    if dict(df.dtypes)["self_reported_conditions"] == "string":
        conditions = X.parse_list_text(conditions)
    scored = df.withColumn("self_reported_chronic_score", X.listed_condition_score(conditions, *_weights(artifacts)))
    return scored.withColumn("age_x_chronic_score", F.col("age") * F.col("self_reported_chronic_score"))


def create_renewal_vice_champion_features(df: DataFrame, artifacts: Artifacts) -> DataFrame:
    """Features of a member's history lists, without those that need provider statistics."""
    necessity = artifacts.get("denial_codes", {}).get("medical_necessity", [])
    definitions = artifacts["chronic_conditions_definitions"]
    return df.withColumns(
        {
            "data_driven_risk_score": X.condition_risk_score(
                "diagnosis_codes_list", definitions, *_weights(artifacts)
            ),
            "cost_volatility_iqr": X.list_iqr("claim_costs_list"),
            "pre_auth_denial_rate": X.list_share("pre_auth_outcomes_list", "rejected"),
            "days_between_visits_std": X.visit_gap_std("service_dates_list"),
            "cost_trend_slope": X.cost_trend_slope("service_dates_list", "claim_costs_list"),
            "care_team_complexity": X.distinct_size("practitioner_specialty_list"),
            "medication_ratio": X.list_share("activity_type_list", "Medication"),
            "imaging_ratio": X.list_share("activity_type_list", "Imaging"),
            "medical_necessity_denial_count": X.list_count_in("adjudication_reason_list", necessity),
        }
    )


def provider_score_table(df: DataFrame, artifacts: Artifacts) -> tuple[DataFrame, Column]:
    """Providers with credibility score and hospital mark, and the score of unknown providers."""
    stats = artifacts.get("provider_stats", {})
    if isinstance(stats, DataFrame):
        table = stats.withColumn("provider", F.col("provider_license_key").cast("string"))
    else:
        specialty = artifacts.get("provider_to_specialty_map", {})
        kinds = artifacts.get("provider_to_type_map", {})
        ids = sorted({str(k) for k in stats} | {str(k) for k in kinds})
        rows = [
            (
                i,
                float(stats[i]["avg_cost"]) if i in stats else None,
                int(stats[i]["claim_count"]) if i in stats else None,
                specialty.get(i),
                kinds.get(i) if isinstance(kinds.get(i), str) else None,
            )
            for i in ids
        ]
        table = df.sparkSession.createDataFrame(
            rows, "provider string, avg_cost double, claim_count bigint, specialty string, provider_type string"
        )
    overall = table.agg(F.coalesce(F.avg("avg_cost"), F.lit(0.0))).scalar()
    peers = artifacts.get("specialty_avg_costs", {})
    if isinstance(peers, DataFrame):
        table = table.join(peers.select("specialty", F.col("avg_cost").alias("_peer")), "specialty", "left")
    else:
        table = table.withColumn("_peer", lookup(peers, F.col("specialty")).cast("double"))
    scored = table.select(
        "provider",
        X.credibility_score("avg_cost", "claim_count", "_peer", overall).alias("_score"),
        F.coalesce(F.lower("provider_type").contains("hospital"), F.lit(False)).alias("_hospital"),
    )
    return scored, overall


def create_renewal_champion_features(
    df: DataFrame, original_abt: DataFrame | None, artifacts: Artifacts, key: str = "patient_key"
) -> DataFrame:
    """Provider cost and hospital share over each row's provider list.

    ``key`` must identify rows. ``original_abt`` is accepted for callers that pass it and
    is not read. Lists are exploded and joined, so provider tables may be of any size.
    """
    scored, overall = provider_score_table(df, artifacts)
    visits = df.select(key, F.explode("providers_visited_list").alias("_p")).select(
        key, F.col("_p").cast("string").alias("provider")
    )
    per_row = visits.join(scored, "provider", "left").groupBy(key).agg(
        F.sum("_score").alias("_sum"),
        F.count("_score").alias("_known"),
        F.count(F.lit(1)).alias("_all"),
        X.share(F.col("_hospital")).alias("_hospitals"),
    )
    mean = (F.coalesce(F.col("_sum"), F.lit(0.0)) + overall * (F.col("_all") - F.col("_known"))) / F.col("_all")
    return (
        df.join(per_row, key, "left")
        .withColumn("avg_provider_risk_score", F.coalesce(mean, overall))
        .withColumn("hospital_visit_ratio", F.coalesce(F.col("_hospitals"), F.lit(0.0)))
        .drop("_sum", "_known", "_all", "_hospitals")
    )


def create_financial_approval_features(df: DataFrame, artifacts: Artifacts) -> DataFrame:
    """Plan utilisation, network tier and, with hash columns present, the duplicate mark."""
    limits = artifacts.get("plan_limits", {})
    if isinstance(limits, DataFrame):
        df = df.join(limits.select("plan_id", F.col("plan_limit").alias("_limit")), "plan_id", "left")
    else:
        df = df.withColumn("_limit", lookup(limits, F.col("plan_id")).cast("double"))
    master = artifacts.get("provider_master", {})
    if isinstance(master, DataFrame):
        df = df.join(master.select("provider_license_key", F.col("tier").alias("_tier")), "provider_license_key", "left")
    else:
        tiers = {k: v.get("tier", X.OUT_OF_NETWORK_TIER) for k, v in master.items()}
        df = df.withColumn("_tier", lookup(tiers, F.col("provider_license_key")).cast("int"))
    out = df.withColumn(
        "plan_utilization_percent", X.plan_utilization("ytd_spend", "claim_amount", "_limit")
    ).withColumn("provider_network_tier", X.network_tier("_tier"))
    if {"claim_hash", "history_hashes"} <= set(df.columns):
        seen = F.array_contains("history_hashes", F.col("claim_hash"))
        out = out.withColumn("is_duplicate_suspect", X.flag(seen))
    return out.drop("_limit", "_tier")


def create_claim_fwa_features(df: DataFrame, artifacts: Artifacts | None = None) -> DataFrame:
    return df.withColumn("is_round_amount", X.round_amount("payer_share_amount")).withColumn(
        "starts_with_nine", X.starts_with_nine("payer_share_amount")
    )


def create_patient_fwa_features(df: DataFrame, artifacts: Artifacts | None = None) -> DataFrame:
    """Distinct providers of the listed history and visits in the last seven days."""
    return df.withColumn("unique_providers_30d", X.distinct_size("provider_history_list")).withColumn(
        "claim_velocity_7d", X.recent_count("service_dates_list", "max_serviced_date", 7)
    )


def create_medical_approval_features(df: DataFrame, artifacts: Artifacts) -> DataFrame:
    """Standard-of-care and gender checks against dicts of codes."""
    care = artifacts.get("standard_of_care", {})
    genders = artifacts.get("gender_restricted_procedures", {})
    allowed = F.array_contains(
        lookup({k: F.array(*[F.lit(c) for c in v]) for k, v in care.items()}, F.col("diagnosis_code")),
        F.col("procedure_code"),
    ) if care else F.lit(False)
    restricted = (
        lookup({k: F.array(*[F.lit(g) for g in v]) for k, v in genders.items()}, F.col("procedure_code"))
        if genders
        else F.lit(None).cast("array<string>")
    )
    return df.withColumn(
        "is_soc_compliant", X.soc_compliant("diagnosis_code", "procedure_code", allowed)
    ).withColumn("is_gender_compliant", X.gender_compliant("procedure_code", "gender", restricted))
