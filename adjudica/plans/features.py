"""The feature operators one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import expressions as X
from ..operators import claims as C
from ..operators import history as H
from ..operators import providers as P
from ..registry import query
from ..sources import claims_model as M
from .aggregates import MEMBER_LINES, member_lines
from .common import r
from .joins import COST_WEIGHTS, FLAT, FREQ_WEIGHTS, LEARNED_CTE, LEARNED_SQL, MEMBER_CONDITIONS, RISK_SQL, STAGE_CTE
from .joins import FINANCIAL_CTE, TIER_CTE, financial_table, learned_risk, plan_limits, provider_master
from .rule_lists import INDICATION, mined_pairs, mined_sql
from .views import using

WEIGHT_ROWS = ", ".join(
    f"('{n}', {X.condition_weight(n, COST_WEIGHTS, FREQ_WEIGHTS)}::DOUBLE)" for n in ("Diabetes", "Hypertension", "Heart Disease")
)
LISTED_CTE = (
    MEMBER_CONDITIONS
    + f""", w(condition, weight) AS (VALUES {WEIGHT_ROWS}),
    scored AS (SELECT h.patient_key, SUM(COALESCE(weight, 1.0)) AS score FROM hits h LEFT JOIN w
    ON h.condition = w.condition GROUP BY 1)"""
)


def member_conditions(spark, sf_dir):
    flags = C.member_condition_flags(M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.CONDITIONS)
    return M.patient(spark, sf_dir).join(flags, C.MEMBER, "left")


@query(
    "self_reported_score",
    using(
        "header item patient",
        LISTED_CTE
        + """ SELECT patient_key, ROUND(COALESCE(score, 0), 6)::DOUBLE AS self_reported_chronic_score FROM patient
        LEFT JOIN scored USING (patient_key)""",
    ),
)
def self_reported_score(spark, sf_dir):
    """Score of the listed conditions, one of which has no weight of its own."""
    score = X.listed_condition_score(C.conditions_array(M.CONDITIONS), COST_WEIGHTS, FREQ_WEIGHTS)
    return member_conditions(spark, sf_dir).select(C.MEMBER, r(score).alias("self_reported_chronic_score"))


@query(
    "age_x_chronic",
    using(
        "header item patient",
        LISTED_CTE
        + """ SELECT patient_key, ROUND(age * COALESCE(score, 0), 6)::DOUBLE AS age_x_chronic_score FROM patient
        LEFT JOIN scored USING (patient_key)""",
    ),
)
def age_x_chronic(spark, sf_dir):
    score = X.listed_condition_score(C.conditions_array(M.CONDITIONS), COST_WEIGHTS, FREQ_WEIGHTS)
    return member_conditions(spark, sf_dir).select(C.MEMBER, r(F.col("age") * score).alias("age_x_chronic_score"))


@query(
    "data_driven_risk",
    using(
        "header item",
        STAGE_CTE + f" SELECT patient_key, ROUND({RISK_SQL}, 6) AS data_driven_risk_score FROM members",
    ),
)
def data_driven_risk(spark, sf_dir):
    flags = C.member_condition_flags(M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.CONDITIONS)
    risk = C.conditions_risk(M.CONDITIONS, COST_WEIGHTS, FREQ_WEIGHTS)
    return flags.select(C.MEMBER, r(risk).alias("data_driven_risk_score"))


@query(
    "age_x_chronic_learned",
    using(
        "header item patient",
        LEARNED_CTE
        + f""" SELECT patient_key, ROUND(age * ({LEARNED_SQL}), 6) AS age_x_chronic_score FROM patient
        LEFT JOIN members USING (patient_key)""",
    ),
)
def age_x_chronic_learned(spark, sf_dir):
    """Every condition here is listed once at most, so the list's score is that of the flags."""
    score = F.col("age") * learned_risk(spark, sf_dir)
    return member_conditions(spark, sf_dir).select(C.MEMBER, r(score).alias("age_x_chronic_score"))


@query(
    "data_driven_risk_learned",
    using(
        "header item",
        LEARNED_CTE + f" SELECT patient_key, ROUND({LEARNED_SQL}, 6) AS data_driven_risk_score FROM members",
    ),
)
def data_driven_risk_learned(spark, sf_dir):
    flags = C.member_condition_flags(M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.CONDITIONS)
    return flags.select(C.MEMBER, r(learned_risk(spark, sf_dir)).alias("data_driven_risk_score"))


def _weighted(spark, sf_dir, grain):
    return H.weighted_claims(
        M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.careteam(spark, sf_dir), grain
    )


def _grain_sql(grain: str, body: str) -> str:
    source = "SELECT * FROM header" if grain == "claim" else "SELECT * FROM flat"
    return using("header item careteam", FLAT + f", base AS ({source}) {body}")


IQR_BODY = """SELECT patient_key, ROUND(QUANTILE_CONT(payer_share_amount, 0.75)
    - QUANTILE_CONT(payer_share_amount, 0.25), 6) AS cost_volatility_iqr FROM base GROUP BY 1"""
GAP_BODY = """, g AS (SELECT patient_key, CAST(max_serviced_date - LAG(max_serviced_date) OVER (PARTITION BY patient_key
    ORDER BY max_serviced_date) AS DOUBLE) AS gap FROM base)
    SELECT patient_key, ROUND(COALESCE(STDDEV_POP(gap), 0), 6) AS days_between_visits_std FROM g GROUP BY 1"""
SLOPE_BODY = """, d AS (SELECT *, max_serviced_date - MIN(max_serviced_date) OVER (PARTITION BY patient_key) AS x FROM base)
    SELECT patient_key, ROUND(CASE WHEN COUNT(DISTINCT x) < 2 THEN 0 ELSE REGR_SLOPE(payer_share_amount, x) END, 6)
    AS cost_trend_slope FROM d GROUP BY 1"""


@query("cost_iqr", _grain_sql("claim", IQR_BODY))
def cost_iqr(spark, sf_dir):
    return H.cost_iqr(_weighted(spark, sf_dir, "claim")).withColumn("cost_volatility_iqr", r("cost_volatility_iqr"))


@query("cost_iqr_flattened", _grain_sql("flattened", IQR_BODY))
def cost_iqr_flattened(spark, sf_dir):
    return H.cost_iqr(_weighted(spark, sf_dir, "flattened")).withColumn(
        "cost_volatility_iqr", r("cost_volatility_iqr")
    )


@query("visit_gap_std", _grain_sql("claim", GAP_BODY))
def visit_gap_std(spark, sf_dir):
    return H.visit_gaps(_weighted(spark, sf_dir, "claim")).withColumn(
        "days_between_visits_std", r("days_between_visits_std")
    )


@query("visit_gap_std_flattened", _grain_sql("flattened", GAP_BODY))
def visit_gap_std_flattened(spark, sf_dir):
    return H.visit_gaps(_weighted(spark, sf_dir, "flattened")).withColumn(
        "days_between_visits_std", r("days_between_visits_std")
    )


@query("cost_trend_slope", _grain_sql("claim", SLOPE_BODY))
def cost_trend_slope(spark, sf_dir):
    return H.cost_trend(_weighted(spark, sf_dir, "claim")).withColumn("cost_trend_slope", r("cost_trend_slope"))


@query("cost_trend_slope_flattened", _grain_sql("flattened", SLOPE_BODY))
def cost_trend_slope_flattened(spark, sf_dir):
    return H.cost_trend(_weighted(spark, sf_dir, "flattened")).withColumn("cost_trend_slope", r("cost_trend_slope"))


@query(
    "care_team_complexity",
    using(
        "header careteam",
        """SELECT patient_key, COUNT(DISTINCT practice_desc) AS care_team_complexity FROM header
        LEFT JOIN careteam USING (claim_request_bundle_id) GROUP BY 1""",
    ),
)
def care_team_complexity(spark, sf_dir):
    header = M.claim_header(spark, sf_dir).select(C.CLAIM, C.MEMBER)
    return header.join(M.careteam(spark, sf_dir), C.CLAIM, "left").groupBy(C.MEMBER).agg(
        F.countDistinct("practice_desc").alias("care_team_complexity")
    )


@query(
    "pre_auth_denial_rate",
    using(
        "header",
        """SELECT patient_key, ROUND(AVG(CASE WHEN pre_auth_outcome = 'rejected' THEN 1.0 ELSE 0.0 END), 6)
        AS pre_auth_denial_rate FROM header GROUP BY 1""",
    ),
)
def pre_auth_denial_rate(spark, sf_dir):
    return H.claim_outcomes(M.claim_header(spark, sf_dir), M.NECESSITY_CODES).select(
        C.MEMBER, r("pre_auth_denial_rate", 6).alias("pre_auth_denial_rate")
    )


@query(
    "necessity_denials",
    using(
        "header",
        """SELECT patient_key, COUNT(*) FILTER (WHERE adjudication_reason = '1-URGENT')
        AS medical_necessity_denial_count FROM header GROUP BY 1""",
    ),
)
def necessity_denials(spark, sf_dir):
    return H.claim_outcomes(M.claim_header(spark, sf_dir), M.NECESSITY_CODES).select(
        C.MEMBER, "medical_necessity_denial_count"
    )


PROVIDER_RISK = (
    MEMBER_LINES
    + """, stats AS (SELECT provider_license_key, AVG(payer_share_amount) AS avg_cost,
    COUNT(DISTINCT claim_request_bundle_id) AS n FROM line GROUP BY 1),
    spec AS (SELECT specialty, AVG(payer_share_amount) AS spec_avg FROM line JOIN provider
    USING (provider_license_key) GROUP BY 1),
    known AS (SELECT *, AVG(avg_cost) OVER () AS overall FROM stats),
    z AS (SELECT k.provider_license_key, n / (n + 20.0) * avg_cost
    + (1 - n / (n + 20.0)) * COALESCE(spec_avg, overall) AS score FROM known k
    LEFT JOIN provider USING (provider_license_key) LEFT JOIN spec USING (specialty)),
    pairs AS (SELECT DISTINCT patient_key, provider_license_key FROM visits)"""
)


def provider_features(spark, sf_dir):
    """Member features over visited providers."""
    lines, providers = M.claim_line(spark, sf_dir), M.provider(spark, sf_dir)
    stats = P.provider_stats(lines, providers)
    return H.member_provider_features(member_lines(spark, sf_dir), stats, C.specialty_costs(lines, providers))


@query(
    "avg_provider_risk",
    using(
        "header line provider",
        PROVIDER_RISK
        + """ SELECT patient_key, ROUND(AVG(COALESCE(score, (SELECT MAX(overall) FROM known))), 6)
        AS avg_provider_risk_score FROM pairs LEFT JOIN z USING (provider_license_key) GROUP BY 1""",
    ),
)
def avg_provider_risk(spark, sf_dir):
    return provider_features(spark, sf_dir).select(
        C.MEMBER, r("avg_provider_risk_score").alias("avg_provider_risk_score")
    )


@query(
    "hospital_ratio",
    using(
        "header line provider",
        MEMBER_LINES
        + """ SELECT patient_key, ROUND(AVG(CASE WHEN LOWER(provider_type) LIKE '%hospital%' THEN 1.0 ELSE 0.0 END), 6)
        AS hospital_visit_ratio FROM (SELECT DISTINCT patient_key, provider_license_key FROM visits)
        LEFT JOIN provider USING (provider_license_key) GROUP BY 1""",
    ),
)
def hospital_ratio(spark, sf_dir):
    lines, providers = M.claim_line(spark, sf_dir), M.provider(spark, sf_dir)
    features = H.member_provider_features(
        member_lines(spark, sf_dir), P.provider_stats(lines, providers), C.specialty_costs(lines, providers)
    )
    return features.select(C.MEMBER, r("hospital_visit_ratio", 6).alias("hospital_visit_ratio"))


def _ratio_sql(activity: str, out: str) -> str:
    return using(
        "header item",
        f"""SELECT patient_key, ROUND(COALESCE(AVG(CASE WHEN i.claim_request_bundle_id IS NULL THEN NULL
        WHEN activity_type = '{activity}' THEN 1.0 ELSE 0.0 END), 0), 6) AS {out} FROM header h
        LEFT JOIN item i ON h.claim_request_bundle_id = i.claim_request_bundle_id GROUP BY 1""",
    )


def _ratios(spark, sf_dir):
    return H.member_item_features(
        M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), {}, M.MEDICATION, M.IMAGING
    )


@query("medication_ratio", _ratio_sql(M.MEDICATION, "medication_ratio"))
def medication_ratio(spark, sf_dir):
    return _ratios(spark, sf_dir).select(C.MEMBER, r("medication_ratio", 6).alias("medication_ratio"))


@query("imaging_ratio", _ratio_sql(M.IMAGING, "imaging_ratio"))
def imaging_ratio(spark, sf_dir):
    return _ratios(spark, sf_dir).select(C.MEMBER, r("imaging_ratio", 6).alias("imaging_ratio"))


@query(
    "plan_utilization",
    using(
        "header policy line",
        FINANCIAL_CTE
        + """ SELECT claim_request_bundle_id, ROUND((ytd_spend + claim_amount) / lim, 9) AS plan_utilization_percent
        FROM financial""",
    ),
)
def plan_utilization(spark, sf_dir):
    """Two plans have no limit of their own and take the default."""
    table = financial_table(spark, sf_dir).join(plan_limits(spark), "plan_id", "left")
    used = X.plan_utilization("ytd_spend", "claim_amount", "plan_limit")
    return table.select(C.CLAIM, r(used, 9).alias("plan_utilization_percent"))


@query(
    "network_tier",
    using(
        "line",
        TIER_CTE
        + """ SELECT claim_request_bundle_id, line_no, provider_license_key, service_key,
        COALESCE(tier, 2) AS provider_network_tier FROM line LEFT JOIN tiers USING (provider_license_key)""",
    ),
)
def network_tier(spark, sf_dir):
    lines = M.claim_line(spark, sf_dir).join(provider_master(spark, sf_dir), C.PROVIDER, "left")
    return lines.select(
        C.CLAIM, "line_no", C.PROVIDER, "service_key", X.network_tier("tier").alias("provider_network_tier")
    )


@query(
    "round_amount",
    using(
        "line",
        """SELECT claim_request_bundle_id, line_no, payer_share_amount, CAST(CASE WHEN payer_share_amount % 100 = 0 THEN 1
        ELSE 0 END AS INTEGER) AS is_round_amount FROM line""",
    ),
)
def round_amount(spark, sf_dir):
    return M.claim_line(spark, sf_dir).select(
        C.CLAIM, "line_no", C.AMOUNT, X.round_amount(C.AMOUNT).alias("is_round_amount")
    )


DIGIT_SQL = "substr(CAST(ABS(CAST(TRUNC(payer_share_amount) AS BIGINT)) AS VARCHAR), 1, 1)"


@query(
    "starts_with_nine",
    using(
        "line",
        f"""SELECT claim_request_bundle_id, line_no, payer_share_amount, CAST(CASE WHEN {DIGIT_SQL} = '9' THEN 1 ELSE 0
        END AS INTEGER) AS starts_with_nine FROM line""",
    ),
)
def starts_with_nine(spark, sf_dir):
    return M.claim_line(spark, sf_dir).select(
        C.CLAIM, "line_no", C.AMOUNT, X.starts_with_nine(C.AMOUNT).alias("starts_with_nine")
    )


@query(
    "first_digit_distribution",
    using(
        "line",
        f""", d AS (SELECT {DIGIT_SQL} AS digit, COUNT(*) AS n FROM line GROUP BY 1)
        SELECT digit, n, ROUND(n / SUM(n) OVER (), 6) AS observed, ROUND(LOG10(1 + 1.0 / CAST(digit AS INTEGER)), 6)
        AS expected FROM d WHERE digit <> '0'""",
    ),
)
def first_digit_distribution(spark, sf_dir):
    """First digits of all amounts beside the share Benford's law expects."""
    digits = M.claim_line(spark, sf_dir).groupBy(X.first_digit(C.AMOUNT).alias("digit")).agg(
        F.count(F.lit(1)).alias("n")
    ).filter(F.col("digit") != "0")
    total = digits.agg(F.sum("n")).scalar()
    return digits.select(
        "digit", "n", r(F.col("n") / total, 6).alias("observed"),
        r(F.log10(1 + 1 / F.col("digit").cast("double")), 6).alias("expected"),
    )


GENDER_RULES = {"Brand#3": ["F"], "Brand#7": ["M"], "Brand#11": ["F", "M"]}
MEDICAL_CTE = """, n AS (SELECT principal_diagnosis_code AS d, procedure_code AS p, COUNT(*) AS n FROM item GROUP BY 1, 2),
    pairs AS (SELECT d, p FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY d ORDER BY n DESC, p) AS rnk FROM n)
    WHERE rnk <= 5),
    medical AS (SELECT i.claim_request_bundle_id, line_no, i.service_key,
    CAST(CASE WHEN pairs.d IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS is_soc_compliant,
    CAST(CASE procedure_code WHEN 'Brand#3' THEN CASE WHEN gender = 'F' THEN 1 ELSE 0 END
    WHEN 'Brand#7' THEN CASE WHEN gender = 'M' THEN 1 ELSE 0 END ELSE 1 END AS INTEGER) AS is_gender_compliant
    FROM item i JOIN header h USING (claim_request_bundle_id) LEFT JOIN patient USING (patient_key)
    LEFT JOIN pairs ON pairs.d = i.principal_diagnosis_code AND pairs.p = i.procedure_code)"""


def medical_table(spark, sf_dir):
    """Items with the care check against the mined pairs and the gender rule check."""
    items = M.claim_item(spark, sf_dir)
    pairs = C.diag_proc_top(items, 5)
    rules = spark.createDataFrame(list(GENDER_RULES.items()), "procedure_code string, allowed_genders array<string>")
    return C.medical_items(items, M.claim_header(spark, sf_dir), M.patient(spark, sf_dir), pairs, rules)


@query(
    "soc_compliant",
    using(
        "header item patient",
        MEDICAL_CTE + " SELECT claim_request_bundle_id, line_no, service_key, is_soc_compliant FROM medical",
    ),
)
def soc_compliant(spark, sf_dir):
    return medical_table(spark, sf_dir).select(C.CLAIM, "line_no", "service_key", "is_soc_compliant")


@query(
    "gender_compliant",
    using(
        "header item patient",
        MEDICAL_CTE + " SELECT claim_request_bundle_id, line_no, service_key, is_gender_compliant FROM medical",
    ),
)
def gender_compliant(spark, sf_dir):
    return medical_table(spark, sf_dir).select(C.CLAIM, "line_no", "service_key", "is_gender_compliant")


@query(
    "medical_necessity_label",
    using(
        "header item patient",
        MEDICAL_CTE
        + """ SELECT claim_request_bundle_id, line_no, service_key, CAST(CASE WHEN is_soc_compliant = 1
        AND is_gender_compliant = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_necessary FROM medical""",
    ),
)
def medical_necessity_label(spark, sf_dir):
    label = D.medical_necessity_label("is_soc_compliant", "is_gender_compliant")
    return medical_table(spark, sf_dir).select(C.CLAIM, "line_no", "service_key", label.alias("is_necessary"))


@query(
    "out_of_pocket_ratio",
    using(
        "header policy",
        """, c AS (SELECT patient_key, SUM(payer_share_amount) / 100 AS cost FROM header GROUP BY 1)
        SELECT patient_key, ROUND(CASE WHEN premium = 0 THEN CASE WHEN COALESCE(cost, 0) > 0 THEN 2.0 ELSE 0.0 END
        ELSE LEAST(GREATEST(COALESCE(cost, 0) / premium, 0.0), 2.0) END, 6) AS out_of_pocket_ratio
        FROM policy LEFT JOIN c USING (patient_key)""",
    ),
)
def out_of_pocket_ratio(spark, sf_dir):
    cost = M.claim_header(spark, sf_dir).groupBy(C.MEMBER).agg((F.sum(C.AMOUNT) / 100).alias("_cost"))
    joined = M.policy(spark, sf_dir).join(cost, C.MEMBER, "left")
    ratio = X.out_of_pocket_ratio(F.coalesce("_cost", F.lit(0.0)), "premium")
    return joined.select(C.MEMBER, r(ratio, 6).alias("out_of_pocket_ratio"))


@query(
    "claim_hash",
    using(
        "line",
        """SELECT claim_request_bundle_id, line_no, service_key, md5(CAST(max_serviced_date AS VARCHAR) || '|'
        || CAST(CAST(ROUND(payer_share_amount * 100) AS BIGINT) AS VARCHAR) || '|'
        || CAST(provider_license_key AS VARCHAR)) AS claim_hash FROM line""",
    ),
)
def claim_hash(spark, sf_dir):
    """Hash over date, amount in cents and provider: whole numbers print alike everywhere."""
    cents = F.round(F.col(C.AMOUNT) * 100).cast("bigint")
    return M.claim_line(spark, sf_dir).select(
        C.CLAIM, "line_no", "service_key", X.claim_hash(C.DATE, cents, C.PROVIDER).alias("claim_hash")
    )


@query(
    "parse_list_text",
    """, """.join(
        [
            """WITH t AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN event_type WHEN event_id % 5 = 0 THEN '[]'
            ELSE '[''' || event_type || ''',''' || user_id || ''']' END AS txt FROM events)""",
            """l AS (SELECT event_id, CASE WHEN txt LIKE '[%]' THEN from_json(replace(txt, '''', '"')::JSON, '["VARCHAR"]')
            ELSE []::VARCHAR[] END AS items FROM t)""",
        ]
    )
    + " SELECT event_id, CAST(len(items) AS INTEGER) AS n_items, COALESCE(array_to_string(items, '|'), '') AS items FROM l",
)
def parse_list_text(spark, sf_dir):
    """Lists written as text, among texts that are no list."""
    quoted = F.concat(
        F.lit("['"), F.col("event_type"), F.lit("','"), F.col("user_id").cast("string"), F.lit("']")
    )
    text = F.when(F.col("event_id") % 7 == 0, F.col("event_type")).when(F.col("event_id") % 5 == 0, "[]").otherwise(quoted)
    items = X.parse_list_text(text)
    return M.events(spark, sf_dir).select(
        "event_id", F.size(items).alias("n_items"), F.array_join(items, "|").alias("items")
    )


@query(
    "out_of_network",
    using(
        "header line policy",
        MEMBER_LINES
        + """, planned AS (SELECT v.*, classname AS plan_id FROM visits v JOIN policy USING (patient_key)),
        contracts AS (SELECT plan_id, provider_license_key FROM planned GROUP BY 1, 2 HAVING ROUND(AVG(discount), 6) >= 0.05)
        SELECT p.plan_id, p.provider_license_key, COUNT(*) AS n_lines,
        CAST(MAX(CASE WHEN c.plan_id IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS is_out_of_network FROM planned p
        LEFT JOIN contracts c ON p.plan_id = c.plan_id AND p.provider_license_key = c.provider_license_key
        GROUP BY 1, 2""",
    ),
)
def out_of_network(spark, sf_dir):
    """Plan and provider pairs without a contract; a contract shows as a mean discount of 5 % or more."""
    plans = M.policy(spark, sf_dir).select(C.MEMBER, F.col("classname").alias("plan_id"))
    planned = member_lines(spark, sf_dir).join(plans, C.MEMBER)
    pairs = planned.groupBy("plan_id", C.PROVIDER).agg(
        F.count(F.lit(1)).alias("n_lines"), r(F.avg("discount"), 6).alias("_discount")
    )
    contracts = pairs.filter(F.col("_discount") >= 0.05).select("plan_id", C.PROVIDER, F.lit(1).alias("_in"))
    return pairs.join(contracts, ["plan_id", C.PROVIDER], "left").select(
        "plan_id", C.PROVIDER, "n_lines", X.flag(F.col("_in").isNull()).alias("is_out_of_network")
    )


@query(
    "cob_flag",
    using(
        "header",
        """SELECT claim_request_bundle_id, patient_key, CAST(CASE WHEN EXISTS (SELECT 1 FROM events e
        WHERE e.user_id = h.patient_key AND e.event_type = 'signup') THEN 1 ELSE 0 END AS INTEGER) AS has_other_payer
        FROM header h""",
    ),
)
def cob_flag(spark, sf_dir):
    """Claims of members who also signed up with another payer."""
    others = M.events(spark, sf_dir).filter("event_type = 'signup'").select(
        F.col("user_id").alias(C.MEMBER)
    ).distinct().withColumn("_other", F.lit(1))
    return M.claim_header(spark, sf_dir).join(others, C.MEMBER, "left").select(
        C.CLAIM, C.MEMBER, X.flag(F.col("_other") == 1).alias("has_other_payer")
    )


@query(
    "policy_active",
    using(
        "header policy",
        """SELECT claim_request_bundle_id, CAST(policyexpirydate AS VARCHAR) AS policyexpirydate,
        CASE WHEN max_serviced_date > policyexpirydate THEN 'REJECT' ELSE 'ACTIVE' END AS policy_status
        FROM header JOIN policy USING (patient_key)""",
    ),
)
def policy_active(spark, sf_dir):
    expiry = M.policy(spark, sf_dir).select(C.MEMBER, "policyexpirydate")
    status = F.when(F.col(C.DATE) > F.col("policyexpirydate"), "REJECT").otherwise("ACTIVE")
    return M.claim_header(spark, sf_dir).join(expiry, C.MEMBER).select(
        C.CLAIM, F.col("policyexpirydate").cast("string").alias("policyexpirydate"), status.alias("policy_status")
    )


@query(
    "chronic_mismatch",
    using(
        "header item",
        STAGE_CTE
        + """, meds AS (SELECT patient_key, MAX(CASE WHEN activity_type = 'PROMO' THEN 1 ELSE 0 END) AS med FROM header
        JOIN item USING (claim_request_bundle_id) GROUP BY 1)
        SELECT patient_key, CAST(CASE WHEN patient_key % 3 <> 0 AND COALESCE(c1, 0) = 1 AND COALESCE(med, 0) = 1
        THEN 1 ELSE 0 END AS INTEGER) AS is_mismatch FROM members LEFT JOIN meds USING (patient_key)""",
    ),
)
def chronic_mismatch(spark, sf_dir):
    """Members declared free of chronic disease (two in three here) with drugs for hypertension."""
    header, items = M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir)
    features = H.member_item_features(header, items, M.CONDITIONS, M.MEDICATION, M.IMAGING)
    mismatch = (
        (F.col(C.MEMBER) % 3 != 0) & (F.col("is_hypertension") == 1) & (F.col("medication_ratio") > 0)
    )
    return features.select(C.MEMBER, X.flag(mismatch).alias("is_mismatch"))


@query(
    "service_type_consistency",
    using(
        "item",
        mined_sql("mined", "activity_type", "principal_diagnosis_code", INDICATION)
        + """ SELECT claim_request_bundle_id, line_no, service_key, CAST(CASE WHEN activity_type NOT IN ('PROMO', 'LARGE')
        OR mined.n_claims IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS is_consistent
        FROM item LEFT JOIN mined USING (activity_type, principal_diagnosis_code)""",
    ),
)
def service_type_consistency(spark, sf_dir):
    """Medication and device items must carry a diagnosis that the claims show them indicated for."""
    allowed = mined_pairs(spark, sf_dir, "activity_type", C.DIAGNOSIS, INDICATION).select(
        "activity_type", C.DIAGNOSIS, F.lit(1).alias("_indicated")
    )
    items = M.claim_item(spark, sf_dir).join(allowed, ["activity_type", C.DIAGNOSIS], "left")
    consistent = ~F.col("activity_type").isin(M.MEDICATION, M.IMAGING) | F.col("_indicated").isNotNull()
    return items.select(C.CLAIM, "line_no", "service_key", X.flag(consistent).alias("is_consistent"))
