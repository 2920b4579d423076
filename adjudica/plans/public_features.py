"""The public feature functions as queries: the lists of one claim each, with learnt artifacts.

The functions take array columns, so the queries give them one row per claim: a claim form
bounds its lists, while a member's lists may be of any length (those have the long form).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as A
from ..operators import claims as C
from ..operators import providers as P
from ..registry import query
from ..sources import claims_model as M
from .common import r
from .features import DIGIT_SQL
from .joins import CLAIM_TIER_CTE, FINANCIAL_CTE, LEARNED_CTE, LEARNED_SQL
from .joins import financial_table, provider_master
from .views import using

#: Pairs of the standard of care: the most frequent ones, an artifact of fixed size.
CARE_PAIRS = 50


def weight_artifacts(spark, sf_dir):
    """Weights per condition, learnt from the claims of the training members, and the definitions."""
    members = C.split_members(M.patient(spark, sf_dir)).filter("is_train")
    header, items = M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir)
    rows = C.chronic_weights(C.train_claims(header, members), items, M.CONDITIONS).collect()  # one row per condition
    return {
        "chronic_condition_cost_weights": {w["condition"]: round(w["cost_weight"], 2) for w in rows},
        "chronic_condition_freq_weights": {w["condition"]: round(w["freq_weight"], 2) for w in rows},
        "chronic_conditions_definitions": M.CONDITIONS,
        "denial_codes": {"medical_necessity": M.NECESSITY_CODES},
    }


def claim_lists(spark, sf_dir):
    """Claims with the lists of their items; both dates and costs are in line order."""
    specialty = M.provider(spark, sf_dir).select(C.PROVIDER, "specialty")
    items = M.claim_item(spark, sf_dir).join(specialty, C.PROVIDER, "left")
    kind = F.col("activity_type")
    line = F.struct(
        "line_no", C.PROVIDER, C.AMOUNT, C.DATE, C.DIAGNOSIS, "specialty",
        F.when(kind == M.MEDICATION, "Medication").when(kind == M.IMAGING, "Imaging").otherwise(kind).alias("activity_type"),
    )
    lists = items.groupBy(C.CLAIM).agg(F.sort_array(F.collect_list(line)).alias("_lines"), F.max(C.DATE).alias("_last"))
    header = M.claim_header(spark, sf_dir).select(C.CLAIM, C.MEMBER, "pre_auth_outcome", "adjudication_reason")

    def of(name):
        return F.transform("_lines", lambda one: one[name])

    return header.join(lists, C.CLAIM, "left").select(
        C.CLAIM, C.MEMBER, F.col("_last").alias(C.DATE),
        of(C.DIAGNOSIS).alias("diagnosis_codes_list"), of(C.AMOUNT).alias("claim_costs_list"),
        of(C.DATE).alias("service_dates_list"), of("specialty").alias("practitioner_specialty_list"),
        of("activity_type").alias("activity_type_list"), of(C.PROVIDER).alias("providers_visited_list"),
        F.array("pre_auth_outcome").alias("pre_auth_outcomes_list"), F.array("adjudication_reason").alias("adjudication_reason_list"),
    )


@query(
    "create_onboarding_features",
    using(
        "header item policy",
        LEARNED_CTE
        + f""" SELECT patient_key, ROUND({LEARNED_SQL}, 6) AS self_reported_chronic_score,
        ROUND(age * ({LEARNED_SQL}), 6) AS age_x_chronic_score FROM policy LEFT JOIN members USING (patient_key)""",
    ),
)
def create_onboarding_features(spark, sf_dir):
    flags = C.member_condition_flags(M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.CONDITIONS)
    people = M.policy(spark, sf_dir).join(flags, C.MEMBER, "left")
    reported = people.withColumn("self_reported_conditions", C.conditions_array(M.CONDITIONS))
    return A.create_onboarding_features(reported, weight_artifacts(spark, sf_dir)).select(
        C.MEMBER, r("self_reported_chronic_score").alias("self_reported_chronic_score"),
        r("age_x_chronic_score").alias("age_x_chronic_score"),
    )


CLAIM_RISK = " + ".join(f"CASE WHEN c{i} THEN (SELECT w{i} FROM learned)::DOUBLE ELSE 0 END" for i in range(len(M.CONDITIONS)))


@query(
    "create_renewal_vice_champion_features",
    using(
        "header item careteam",
        LEARNED_CTE
        + f""", risk AS (SELECT claim_request_bundle_id, {CLAIM_RISK} AS risk FROM flags),
        lists AS (SELECT claim_request_bundle_id, QUANTILE_CONT(payer_share_amount, 0.75)
        - QUANTILE_CONT(payer_share_amount, 0.25) AS iqr, AVG(CASE WHEN activity_type = '{M.MEDICATION}' THEN 1.0 ELSE 0.0 END)
        AS med, AVG(CASE WHEN activity_type = '{M.IMAGING}' THEN 1.0 ELSE 0.0 END) AS img FROM item GROUP BY 1),
        gaps AS (SELECT claim_request_bundle_id, STDDEV_POP(gap) AS gaps FROM (SELECT claim_request_bundle_id,
        CAST(max_serviced_date - LAG(max_serviced_date) OVER (PARTITION BY claim_request_bundle_id ORDER BY
        max_serviced_date) AS DOUBLE) AS gap FROM item) GROUP BY 1),
        xy AS (SELECT claim_request_bundle_id, payer_share_amount AS y, max_serviced_date - MIN(max_serviced_date)
        OVER (PARTITION BY claim_request_bundle_id) AS x FROM item),
        slopes AS (SELECT claim_request_bundle_id, CASE WHEN COUNT(DISTINCT x) < 2 THEN 0 ELSE REGR_SLOPE(y, x) END AS slope
        FROM xy GROUP BY 1),
        team AS (SELECT claim_request_bundle_id, COUNT(DISTINCT practice_desc) AS team FROM careteam GROUP BY 1)
        SELECT claim_request_bundle_id, ROUND(COALESCE(risk, 0), 6) AS data_driven_risk_score,
        ROUND(COALESCE(iqr, 0), 6) AS cost_volatility_iqr,
        CASE WHEN pre_auth_outcome = 'rejected' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pre_auth_denial_rate,
        ROUND(COALESCE(gaps, 0), 6) AS days_between_visits_std, ROUND(COALESCE(slope, 0), 3) AS cost_trend_slope,
        COALESCE(team, 0)::INTEGER AS care_team_complexity, ROUND(COALESCE(med, 0), 6) AS medication_ratio,
        ROUND(COALESCE(img, 0), 6) AS imaging_ratio,
        CASE WHEN adjudication_reason = '{M.NECESSITY_CODES[0]}' THEN 1 ELSE 0 END AS medical_necessity_denial_count
        FROM header LEFT JOIN risk USING (claim_request_bundle_id) LEFT JOIN lists USING (claim_request_bundle_id)
        LEFT JOIN gaps USING (claim_request_bundle_id) LEFT JOIN slopes USING (claim_request_bundle_id)
        LEFT JOIN team USING (claim_request_bundle_id)""",
    ),
)
def create_renewal_vice_champion_features(spark, sf_dir):
    made = A.create_renewal_vice_champion_features(claim_lists(spark, sf_dir), weight_artifacts(spark, sf_dir))
    return made.select(
        C.CLAIM, r("data_driven_risk_score").alias("data_driven_risk_score"), r("cost_volatility_iqr").alias("cost_volatility_iqr"),
        "pre_auth_denial_rate", r("days_between_visits_std").alias("days_between_visits_std"),
        r("cost_trend_slope", 3).alias("cost_trend_slope"), "care_team_complexity",
        r("medication_ratio").alias("medication_ratio"), r("imaging_ratio").alias("imaging_ratio"), "medical_necessity_denial_count",
    )


@query(
    "create_renewal_champion_features",
    using(
        "header line provider",
        """, st AS (SELECT provider_license_key, AVG(payer_share_amount) AS avg_cost, COUNT(DISTINCT claim_request_bundle_id)
        AS n FROM line GROUP BY 1),
        sp AS (SELECT specialty, AVG(payer_share_amount) AS spec FROM line JOIN provider USING (provider_license_key) GROUP BY 1),
        k AS (SELECT *, AVG(avg_cost) OVER () AS overall FROM st),
        z AS (SELECT k.provider_license_key, provider_type, n / (n + 20.0) * avg_cost + (1 - n / (n + 20.0))
        * COALESCE(spec, overall) AS score FROM k LEFT JOIN provider USING (provider_license_key) LEFT JOIN sp USING (specialty)),
        pr AS (SELECT claim_request_bundle_id, AVG(COALESCE(score, (SELECT MAX(overall) FROM k))) AS risk,
        AVG(CASE WHEN LOWER(provider_type) LIKE '%hospital%' THEN 1.0 ELSE 0.0 END) AS hosp
        FROM line LEFT JOIN z USING (provider_license_key) GROUP BY 1)
        SELECT claim_request_bundle_id, ROUND(COALESCE(risk, (SELECT MAX(overall) FROM k)), 4) AS avg_provider_risk_score,
        ROUND(COALESCE(hosp, 0), 6) AS hospital_visit_ratio FROM header LEFT JOIN pr USING (claim_request_bundle_id)""",
    ),
)
def create_renewal_champion_features(spark, sf_dir):
    lines, providers = M.claim_line(spark, sf_dir), M.provider(spark, sf_dir)
    artifacts = {"provider_stats": P.provider_stats(lines, providers), "specialty_avg_costs": C.specialty_costs(lines, providers)}
    lists = claim_lists(spark, sf_dir).select(C.CLAIM, "providers_visited_list")
    return A.create_renewal_champion_features(lists, None, artifacts, key=C.CLAIM).select(
        C.CLAIM, r("avg_provider_risk_score", 4).alias("avg_provider_risk_score"), r("hospital_visit_ratio").alias("hospital_visit_ratio")
    )


@query(
    "create_financial_approval_features",
    using(
        "header policy line",
        FINANCIAL_CTE
        + CLAIM_TIER_CTE
        + """ SELECT f.claim_request_bundle_id, ROUND((ytd_spend + claim_amount) / lim, 9) AS plan_utilization_percent,
        CAST(is_duplicate_suspect AS INTEGER) AS is_duplicate_suspect,
        COALESCE(provider_network_tier, 2) AS provider_network_tier
        FROM financial f LEFT JOIN claim_tier t ON f.claim_request_bundle_id = t.claim_request_bundle_id""",
    ),
)
def create_financial_approval_features(spark, sf_dir):
    """The history holds the hash of a claim that was there before, if there was one."""
    table = financial_table(spark, sf_dir)
    seen = F.when(F.col("is_duplicate_suspect") == 1, F.array("claim_hash")).otherwise(F.array().cast("array<string>"))
    table = table.withColumn("history_hashes", seen).drop("is_duplicate_suspect")
    artifacts = {"plan_limits": M.PLAN_LIMITS, "provider_master": provider_master(spark, sf_dir)}
    return A.create_financial_approval_features(table, artifacts).select(
        C.CLAIM, r("plan_utilization_percent", 9).alias("plan_utilization_percent"), "is_duplicate_suspect", "provider_network_tier"
    )


@query(
    "create_claim_fwa_features",
    using(
        "header",
        f"""SELECT claim_request_bundle_id, CAST(CASE WHEN payer_share_amount % 100 = 0 THEN 1 ELSE 0 END AS INTEGER)
        AS is_round_amount, CAST(CASE WHEN {DIGIT_SQL} = '9' THEN 1 ELSE 0 END AS INTEGER) AS starts_with_nine FROM header""",
    ),
)
def create_claim_fwa_features(spark, sf_dir):
    return A.create_claim_fwa_features(M.claim_header(spark, sf_dir)).select(C.CLAIM, "is_round_amount", "starts_with_nine")


@query(
    "create_patient_fwa_features",
    using(
        "header line",
        """, last AS (SELECT claim_request_bundle_id, MAX(max_serviced_date) AS last FROM line GROUP BY 1),
        seen AS (SELECT l.claim_request_bundle_id, COUNT(DISTINCT provider_license_key) AS n,
        COUNT(*) FILTER (WHERE last - max_serviced_date BETWEEN 0 AND 7) AS recent FROM line l
        JOIN last ON l.claim_request_bundle_id = last.claim_request_bundle_id GROUP BY 1)
        SELECT h.claim_request_bundle_id, COALESCE(n, 0)::INTEGER AS unique_providers_30d,
        COALESCE(recent, 0)::INTEGER AS claim_velocity_7d FROM header h LEFT JOIN seen USING (claim_request_bundle_id)""",
    ),
)
def create_patient_fwa_features(spark, sf_dir):
    lists = claim_lists(spark, sf_dir).withColumnRenamed("providers_visited_list", "provider_history_list")
    return A.create_patient_fwa_features(lists).select(C.CLAIM, "unique_providers_30d", "claim_velocity_7d")


def frequent_pairs(items):
    """The diagnosis and procedure pairs billed most often."""
    counted = items.filter(F.col(C.DIAGNOSIS).isNotNull() & F.col("procedure_code").isNotNull()).groupBy(
        C.DIAGNOSIS, "procedure_code"
    ).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), C.DIAGNOSIS, "procedure_code").limit(CARE_PAIRS)


@query(
    "create_medical_approval_features",
    using(
        "header item patient",
        f""", pairs AS (SELECT principal_diagnosis_code AS d, procedure_code AS p, COUNT(*) AS n FROM item
        WHERE principal_diagnosis_code IS NOT NULL AND procedure_code IS NOT NULL GROUP BY 1, 2
        ORDER BY n DESC, d, p LIMIT {CARE_PAIRS}),
        first AS (SELECT p FROM pairs ORDER BY n DESC, d, p LIMIT 1)
        SELECT i.claim_request_bundle_id, line_no, service_key, CAST(CASE WHEN principal_diagnosis_code IS NULL
        OR procedure_code IS NULL OR d IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS is_soc_compliant,
        CAST(CASE WHEN procedure_code = (SELECT p FROM first) AND gender <> 'F' THEN 0 ELSE 1 END AS INTEGER)
        AS is_gender_compliant FROM item i JOIN header h ON i.claim_request_bundle_id = h.claim_request_bundle_id
        LEFT JOIN patient t ON h.patient_key = t.patient_key
        LEFT JOIN pairs ON principal_diagnosis_code = d AND procedure_code = p""",
    ),
)
def create_medical_approval_features(spark, sf_dir):
    """Care rules learnt as the most frequent pairs; the first pair's procedure is kept to one gender."""
    items = M.claim_item(spark, sf_dir)
    pairs = frequent_pairs(items).collect()  # CARE_PAIRS rows
    care: dict[str, list[str]] = {}
    for pair in pairs:
        care.setdefault(pair[C.DIAGNOSIS], []).append(pair["procedure_code"])
    genders = {pairs[0]["procedure_code"]: ["F"]} if pairs else {}
    owner = M.claim_header(spark, sf_dir).select(C.CLAIM, C.MEMBER)
    table = items.join(owner, C.CLAIM).join(M.patient(spark, sf_dir), C.MEMBER, "left").withColumnRenamed(C.DIAGNOSIS, "diagnosis_code")
    made = A.create_medical_approval_features(table, {"standard_of_care": care, "gender_restricted_procedures": genders})
    return made.select(C.CLAIM, "line_no", "service_key", "is_soc_compliant", "is_gender_compliant")
