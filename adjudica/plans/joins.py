"""Joins that build claim- and member-level tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import expressions as X
from ..operators import claims as C
from ..operators import history as H
from ..operators import providers as P
from ..operators import windows as W
from ..operators.skew import part_count
from ..registry import query
from ..sources import claims_model as M
from ..sources.tables import load_table
from .common import day_text, r
from .rules import MEMBER_CONDITIONS
from .views import condition_sql, using

TRAIN = "('0x' || substr(md5(CAST(patient_key AS VARCHAR)), 1, 8))::BIGINT % 100 < 70"


@query(
    "train_claims",
    using("header", f"SELECT claim_request_bundle_id, patient_key, payer_share_amount FROM header WHERE {TRAIN}"),
)
def train_claims(spark, sf_dir):
    members = C.split_members(M.patient(spark, sf_dir)).filter("is_train")
    return C.train_claims(M.claim_header(spark, sf_dir), members).select(C.CLAIM, C.MEMBER, C.AMOUNT)


@query(
    "claim_diagnosis",
    using(
        "header item service",
        """, known AS (SELECT DISTINCT principal_diagnosis_code AS code FROM service),
        lists AS (SELECT claim_request_bundle_id, code, COUNT(*) AS n FROM item JOIN known
        ON principal_diagnosis_code = code GROUP BY 1, 2)
        SELECT h.claim_request_bundle_id, patient_key, COALESCE(code, '-') AS diagnosis_code,
        COALESCE(n, 0) AS multiplicity
        FROM header h LEFT JOIN lists l ON h.claim_request_bundle_id = l.claim_request_bundle_id""",
    ),
)
def claim_diagnosis(spark, sf_dir):
    """Claims with their codes known to the dimension, one row per code."""
    joined = C.claim_diagnosis(
        M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.service(spark, sf_dir)
    )
    return joined.select(C.CLAIM, C.MEMBER, F.coalesce("diagnosis_code", F.lit("-")).alias("diagnosis_code"), "multiplicity")


@query(
    "patient_cost_join",
    using(
        "header",
        """SELECT claim_request_bundle_id, patient_key, ROUND(SUM(payer_share_amount) OVER w, 2) AS annualized_cost,
        COUNT(*) OVER w AS claim_count FROM header WINDOW w AS (PARTITION BY patient_key)""",
    ),
)
def patient_cost_join(spark, sf_dir):
    return C.patient_cost_join(M.claim_header(spark, sf_dir)).select(
        C.CLAIM, C.MEMBER, r("annualized_cost", 2).alias("annualized_cost"), "claim_count"
    )


FLAT = """, flat AS (SELECT h.claim_request_bundle_id, h.patient_key, h.payer_share_amount, h.max_serviced_date,
    i.principal_diagnosis_code, t.practitioner_license, t.practice_desc FROM header h
    LEFT JOIN item i ON h.claim_request_bundle_id = i.claim_request_bundle_id
    LEFT JOIN careteam t ON h.claim_request_bundle_id = t.claim_request_bundle_id)"""


@query(
    "claims_flatten",
    using(
        "header item careteam",
        FLAT
        + """ SELECT claim_request_bundle_id, 'diagnosis' AS kind, COALESCE(principal_diagnosis_code, '-') AS value,
        COUNT(*) AS multiplicity FROM flat GROUP BY 1, 3 UNION ALL
        SELECT claim_request_bundle_id, 'practitioner', COALESCE(CAST(practitioner_license AS VARCHAR), '-'), COUNT(*)
        FROM flat GROUP BY 1, 3""",
    ),
)
def claims_flatten(spark, sf_dir):
    flat = C.claims_flatten(
        M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.careteam(spark, sf_dir)
    )
    return flat.withColumn("value", F.coalesce("value", F.lit("-")))


RENEWAL = using(
    "header item careteam policy",
    """, costs AS (SELECT patient_key, SUM(payer_share_amount) AS annualized_cost, COUNT(*) AS n_costs,
    MIN(max_serviced_date) AS first_date, MAX(max_serviced_date) AS last_date FROM header GROUP BY 1),
    codes AS (SELECT patient_key, COUNT(DISTINCT principal_diagnosis_code) AS n_diagnoses FROM header
    JOIN item USING (claim_request_bundle_id) GROUP BY 1),
    people AS (SELECT patient_key, COUNT(DISTINCT practitioner_license) AS n_practitioners,
    COUNT(DISTINCT practice_desc) AS n_specialties FROM header JOIN careteam USING (claim_request_bundle_id)
    GROUP BY 1)
    SELECT p.patient_key, p.age, p.gender, p.city, p.classname, p.premium,
    ROUND(COALESCE(annualized_cost, 0), 2) AS annualized_cost, COALESCE(n_costs, 0) AS n_costs,
    COALESCE(n_diagnoses, 0) AS n_diagnoses, COALESCE(n_practitioners, 0) AS n_practitioners,
    COALESCE(n_specialties, 0) AS n_specialties, COALESCE(CAST(first_date AS VARCHAR), '-') AS first_date,
    COALESCE(CAST(last_date AS VARCHAR), '-') AS last_date
    FROM policy p LEFT JOIN costs USING (patient_key) LEFT JOIN codes USING (patient_key)
    LEFT JOIN people USING (patient_key)""",
)


def renewal_table(spark, sf_dir):
    """Policy master with cost and history measures; members without claims keep zeros."""
    history = H.member_history(
        M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.careteam(spark, sf_dir),
        parts=part_count(M.claim_line(spark, sf_dir)),
    )
    counts = ["n_costs", "n_diagnoses", "n_practitioners", "n_specialties"]
    return (
        M.policy(spark, sf_dir)
        .join(history, C.MEMBER, "left")
        .withColumn("annualized_cost", F.coalesce("sum_costs", F.lit(0.0)))
        .na.fill(0, counts)
    )


@query("abt_renewal", RENEWAL)
def abt_renewal(spark, sf_dir):
    return renewal_table(spark, sf_dir).select(
        C.MEMBER, "age", "gender", "city", "classname", "premium", r("annualized_cost", 2).alias("annualized_cost"),
        "n_costs", "n_diagnoses", "n_practitioners", "n_specialties",
        F.coalesce(day_text("first_date"), F.lit("-")).alias("first_date"),
        F.coalesce(day_text("last_date"), F.lit("-")).alias("last_date"),
    )


@query(
    "claims_provider",
    using(
        "line provider",
        """SELECT claim_request_bundle_id, line_no, provider_license_key, payer_share_amount, specialty,
        provider_type FROM line JOIN provider USING (provider_license_key)""",
    ),
)
def claims_provider(spark, sf_dir):
    return C.claims_provider(M.claim_line(spark, sf_dir), M.provider(spark, sf_dir)).select(
        C.CLAIM, "line_no", C.PROVIDER, C.AMOUNT, "specialty", "provider_type"
    )


@query(
    "abt_onboarding",
    using(
        "header item policy",
        MEMBER_CONDITIONS
        + """, named AS (SELECT patient_key, STRING_AGG(condition, '|' ORDER BY condition) AS names FROM hits GROUP BY 1),
        costs AS (SELECT patient_key, SUM(payer_share_amount) AS cost FROM header GROUP BY 1)
        SELECT patient_key, age, gender, city, classname, COALESCE(names, '') AS self_reported_conditions,
        ROUND(COALESCE(cost, 0), 2) AS annualized_cost FROM policy LEFT JOIN named USING (patient_key)
        LEFT JOIN costs USING (patient_key)""",
    ),
)
def abt_onboarding(spark, sf_dir):
    header = M.claim_header(spark, sf_dir)
    flags = C.member_condition_flags(header, M.claim_item(spark, sf_dir), M.CONDITIONS)
    cost = header.groupBy(C.MEMBER).agg(F.sum(C.AMOUNT).alias("_cost"))
    names = F.array_join(C.conditions_array(M.CONDITIONS), "|")
    return (
        M.policy(spark, sf_dir).join(flags, C.MEMBER, "left").join(cost, C.MEMBER, "left")
        .select(
            C.MEMBER, "age", "gender", "city", "classname", names.alias("self_reported_conditions"),
            r(F.coalesce("_cost", F.lit(0.0)), 2).alias("annualized_cost"),
        )
    )


LIMITS_SQL = ", ".join(f"('{plan}', {limit}::DOUBLE)" for plan, limit in M.PLAN_LIMITS.items())
#: Amounts of one claim signature differ by less than this.
AMOUNT_UNIT = 20_000.0
BILLING_CTE = """, billing AS (SELECT claim_request_bundle_id, provider_license_key FROM (SELECT *, ROW_NUMBER() OVER
    (PARTITION BY claim_request_bundle_id ORDER BY line_no, provider_license_key) AS rn FROM line) WHERE rn = 1)"""
FINANCIAL_CTE = f"""{BILLING_CTE}, running AS (SELECT *, SUM(payer_share_amount) OVER (PARTITION BY patient_key,
    YEAR(max_serviced_date) ORDER BY max_serviced_date, claim_request_bundle_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS spent,
    ROW_NUMBER() OVER (PARTITION BY max_serviced_date, FLOOR(payer_share_amount / {AMOUNT_UNIT}), provider_license_key
    ORDER BY claim_request_bundle_id) AS rn FROM header LEFT JOIN billing USING (claim_request_bundle_id)),
    limits(plan, plan_limit) AS (VALUES {LIMITS_SQL}),
    financial AS (SELECT r.claim_request_bundle_id, r.patient_key, p.classname AS plan_id,
    r.payer_share_amount AS claim_amount, COALESCE(spent, 0.0) AS ytd_spend, COALESCE(plan_limit, 10000.0) AS lim,
    CASE WHEN rn > 1 THEN 1 ELSE 0 END AS is_duplicate_suspect FROM running r
    LEFT JOIN policy p ON r.patient_key = p.patient_key LEFT JOIN limits ON p.classname = plan)"""


def plan_limits(spark):
    return spark.createDataFrame(list(M.PLAN_LIMITS.items()), "plan_id string, plan_limit double")


def billed_header(spark, sf_dir):
    """Claims with the provider of their first line and the whole units of their amount."""
    first = F.min(F.struct("line_no", C.PROVIDER))[C.PROVIDER].alias(C.PROVIDER)
    billing = M.claim_line(spark, sf_dir).groupBy(C.CLAIM).agg(first)
    return M.claim_header(spark, sf_dir).join(billing, C.CLAIM, "left").withColumn("amount_units", W.amount_step(AMOUNT_UNIT))


SIGNATURE = [C.DATE, "amount_units", C.PROVIDER]


def financial_table(spark, sf_dir):
    """Claims with the member's plan, their provider, spend so far this year, and repeats of date, amount and provider."""
    plans = M.policy(spark, sf_dir).select(C.MEMBER, F.col("classname").alias("plan_id"))
    header, order = billed_header(spark, sf_dir), [C.DATE, C.CLAIM]
    # Both side tables come from the stored header, so the running total is not computed twice.
    repeated = W.repeated_signatures(header, SIGNATURE, order)
    marked = W.mark_duplicates(W.ytd_spend(header), repeated, SIGNATURE, order)
    return marked.join(plans, C.MEMBER, "left").withColumn("claim_amount", F.col(C.AMOUNT))


TIER_CTE = """, tiers AS (SELECT s_suppkey AS provider_license_key, CAST(CASE WHEN s_acctbal >= 5000 THEN 1
    WHEN s_acctbal < 500 THEN 3 ELSE 2 END AS INTEGER) AS tier FROM supplier)"""


def provider_master(spark, sf_dir):
    """Contracted tiers by balance."""
    balance = F.col("s_acctbal")
    return load_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias(C.PROVIDER),
        F.when(balance >= 5000, 1).when(balance < 500, 3).otherwise(2).alias("tier"),
    )


CLAIM_TIER_CTE = (
    TIER_CTE
    + """, claim_tier AS (SELECT claim_request_bundle_id, provider_license_key, COALESCE(tier, 2) AS provider_network_tier
    FROM billing LEFT JOIN tiers USING (provider_license_key))"""
)


def with_claim_tier(spark, sf_dir, claims):
    """Billed claims with the network tier of their provider; 2 where either is unknown."""
    tiers = provider_master(spark, sf_dir).select(C.PROVIDER, "tier")
    return claims.join(tiers, C.PROVIDER, "left").withColumn("provider_network_tier", X.network_tier("tier")).drop("tier")


@query(
    "abt_financial",
    using(
        "header policy line",
        FINANCIAL_CTE
        + CLAIM_TIER_CTE
        + """ SELECT f.claim_request_bundle_id, patient_key, plan_id, claim_amount, ROUND(ytd_spend, 2) AS ytd_spend,
        CAST(is_duplicate_suspect AS INTEGER) AS is_duplicate_suspect,
        COALESCE(provider_license_key, -1) AS provider_license_key,
        COALESCE(provider_network_tier, 2) AS provider_network_tier
        FROM financial f LEFT JOIN claim_tier t ON f.claim_request_bundle_id = t.claim_request_bundle_id""",
    ),
)
def abt_financial(spark, sf_dir):
    return with_claim_tier(spark, sf_dir, financial_table(spark, sf_dir)).select(
        C.CLAIM, C.MEMBER, "plan_id", "claim_amount", r("ytd_spend", 2).alias("ytd_spend"), "is_duplicate_suspect",
        F.coalesce(C.PROVIDER, F.lit(-1)).alias(C.PROVIDER), "provider_network_tier",
    )


@query(
    "abt_medical",
    using(
        "header item patient",
        """SELECT i.claim_request_bundle_id, line_no, provider_license_key, i.payer_share_amount, patient_key, age,
        gender, procedure_code, principal_diagnosis_code AS diagnosis_code, activity_type FROM item i
        JOIN header h USING (claim_request_bundle_id) LEFT JOIN patient USING (patient_key)""",
    ),
)
def abt_medical(spark, sf_dir):
    owner = M.claim_header(spark, sf_dir).select(C.CLAIM, C.MEMBER)
    return (
        M.claim_item(spark, sf_dir).join(owner, C.CLAIM).join(M.patient(spark, sf_dir), C.MEMBER, "left")
        .select(
            C.CLAIM, "line_no", C.PROVIDER, C.AMOUNT, C.MEMBER, "age", "gender", "procedure_code",
            F.col(C.DIAGNOSIS).alias("diagnosis_code"), "activity_type",
        )
    )


@query(
    "claims_patient",
    using(
        "header patient",
        """SELECT claim_request_bundle_id, patient_key, payer_share_amount, age, gender FROM header
        LEFT JOIN patient USING (patient_key)""",
    ),
)
def claims_patient(spark, sf_dir):
    return C.claims_patient(M.claim_header(spark, sf_dir), M.patient(spark, sf_dir)).select(
        C.CLAIM, C.MEMBER, C.AMOUNT, "age", "gender"
    )


FRAUD_SCORES = """, stats AS (SELECT provider_license_key, AVG(payer_share_amount) AS avg_cost_per_claim,
    COUNT(DISTINCT claim_request_bundle_id) AS claim_count,
    AVG(CASE WHEN payer_share_amount > 90000 THEN 1.0 ELSE 0.0 END) AS high FROM line GROUP BY 1)"""


@query(
    "fraud_score_join",
    using(
        "line",
        FRAUD_SCORES
        + """ SELECT provider_license_key, ROUND(avg_cost_per_claim, 4) AS avg_cost_per_claim, claim_count,
        ROUND(high, 6) AS provider_fraud_score FROM stats""",
    ),
)
def fraud_score_join(spark, sf_dir):
    """Provider value features with the share of high-cost bills as fraud score."""
    lines = M.claim_line(spark, sf_dir)
    scores = P.provider_fwa_features(lines, 90000.0).select(
        C.PROVIDER, F.col("high_cost_claim_ratio").alias("provider_fraud_score")
    )
    return P.fraud_score_join(P.provider_value_features(lines), scores).select(
        C.PROVIDER, r("avg_cost_per_claim", 4).alias("avg_cost_per_claim"), "claim_count",
        r("provider_fraud_score", 6).alias("provider_fraud_score"),
    )


@query(
    "labels_outcome_join",
    """SELECT doc_id, n_chars AS champion_prediction, quality AS actual, toxic AS flagged FROM documents
    JOIN labels USING (doc_id)""",
)
def labels_outcome_join(spark, sf_dir):
    """Predictions joined to the outcomes known for some of them."""
    log = load_table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("champion_prediction"))
    outcomes = load_table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("actual"), F.col("toxic").alias("flagged")
    )
    return log.join(outcomes, "doc_id", "inner")


def pre_auth_requests(spark, sf_dir):
    """One pre-authorisation per claim: the outcome with the procedure of the claim's first item."""
    items = M.claim_item(spark, sf_dir)
    first = items.groupBy(C.CLAIM).agg(
        F.min(F.struct("line_no", "procedure_code"))["procedure_code"].alias("procedure_code")
    )
    asked = M.claim_header(spark, sf_dir).filter("pre_auth_ref IS NOT NULL")
    return asked.select(C.CLAIM, "pre_auth_ref", "pre_auth_outcome").join(first, C.CLAIM, "left")


@query(
    "pre_auth_contradiction",
    using(
        "header item",
        """, first AS (SELECT claim_request_bundle_id, procedure_code AS asked FROM (SELECT *, ROW_NUMBER() OVER
        (PARTITION BY claim_request_bundle_id ORDER BY line_no, procedure_code) AS rn FROM item) WHERE rn = 1),
        bad AS (SELECT i.claim_request_bundle_id, COUNT(*) AS n FROM item i JOIN header h
        USING (claim_request_bundle_id) JOIN first f USING (claim_request_bundle_id)
        WHERE pre_auth_ref IS NOT NULL AND i.procedure_code <> asked GROUP BY 1)
        SELECT claim_request_bundle_id, 'rejected_but_claimed' AS kind, 1::BIGINT AS n_items FROM header
        WHERE pre_auth_outcome = 'rejected' UNION ALL
        SELECT claim_request_bundle_id, 'service_differs', n FROM bad""",
    ),
)
def pre_auth_contradiction(spark, sf_dir):
    header, requests = M.claim_header(spark, sf_dir), pre_auth_requests(spark, sf_dir)
    claimed = C.pre_auth_rejected_claimed(header, requests).select(
        C.CLAIM, F.lit("rejected_but_claimed").alias("kind"), F.lit(1).cast("long").alias("n_items")
    )
    differs = C.pre_auth_service_mismatch(M.claim_item(spark, sf_dir), header, requests).groupBy(C.CLAIM).agg(
        F.count(F.lit(1)).alias("n_items")
    )
    return claimed.unionByName(differs.withColumn("kind", F.lit("service_differs")))


@query(
    "new_member_anti",
    using(
        "header policy",
        """SELECT patient_key, age, gender, classname FROM policy p WHERE NOT EXISTS (SELECT 1 FROM header h
        WHERE h.patient_key = p.patient_key AND max_serviced_date < DATE '1995-06-01')""",
    ),
)
def new_member_anti(spark, sf_dir):
    """Members without any claim before the snapshot day, which is the operator's parameter."""
    found = C.new_members(M.policy(spark, sf_dir), M.claim_header(spark, sf_dir), before="1995-06-01")
    return found.select(C.MEMBER, "age", "gender", "classname")


@query(
    "new_members",
    using(
        "header policy",
        """SELECT patient_key, age, gender, classname FROM policy p
        WHERE NOT EXISTS (SELECT 1 FROM header h WHERE h.patient_key = p.patient_key)""",
    ),
)
def new_members(spark, sf_dir):
    """Members without any claim at all, the onboarding path."""
    found = C.new_members(M.policy(spark, sf_dir), M.claim_header(spark, sf_dir))
    return found.select(C.MEMBER, "age", "gender", "classname")


STAGE_CTE = (
    ", flags AS (SELECT claim_request_bundle_id, "
    + ", ".join(f"BOOL_OR({condition_sql(n)}) AS c{i}" for i, n in enumerate(M.CONDITIONS))
    + """ FROM item GROUP BY 1), members AS (SELECT patient_key, """
    + ", ".join(f"MAX(CASE WHEN c{i} THEN 1 ELSE 0 END) AS c{i}" for i in range(len(M.CONDITIONS)))
    + """, SUM(payer_share_amount) AS cost, AVG(CASE WHEN pre_auth_outcome = 'rejected' THEN 1.0 ELSE 0.0 END) AS denial
    FROM header LEFT JOIN flags USING (claim_request_bundle_id) GROUP BY 1)"""
)
COST_WEIGHTS = {"Diabetes": 1.8, "Hypertension": 1.2, "Heart Disease": 2.5}
FREQ_WEIGHTS = {"Diabetes": 1.2, "Hypertension": 1.0}
RISK_SQL = " + ".join(
    f"COALESCE(c{i}, 0) * {X.condition_weight(n, COST_WEIGHTS, FREQ_WEIGHTS)}::DOUBLE"
    for i, n in enumerate(M.CONDITIONS)
)
LEARNED_CTE = (
    STAGE_CTE
    + f""", totals AS (SELECT patient_key, SUM(payer_share_amount) AS c FROM header WHERE {TRAIN} GROUP BY 1),
    trained AS (SELECT t.c, flags.* FROM header h JOIN totals t ON h.patient_key = t.patient_key
    LEFT JOIN flags ON h.claim_request_bundle_id = flags.claim_request_bundle_id),
    learned AS (SELECT """
    + ", ".join(
        f"ROUND(COALESCE(GREATEST(1.0, AVG(c) FILTER (WHERE c{i}) / AVG(c)), 1.0), 2) AS w{i}"
        for i in range(len(M.CONDITIONS))
    )
    + " FROM trained)"
)
LEARNED_SQL = " + ".join(f"COALESCE(c{i}, 0) * (SELECT w{i} FROM learned)::DOUBLE" for i in range(len(M.CONDITIONS)))
OOP_SQL = """CASE WHEN premium = 0 THEN CASE WHEN COALESCE(cost, 0) > 0 THEN 2.0 ELSE 0.0 END
    ELSE LEAST(GREATEST(COALESCE(cost, 0) / premium, 0.0), 2.0) END"""


def learned_risk(spark, sf_dir):
    """The risk score with the weights learnt from all claims of the training members."""
    header, items = M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir)
    members = C.split_members(M.patient(spark, sf_dir)).filter("is_train")
    return C.learned_risk(M.CONDITIONS, C.learned_weights(header, items, members, M.CONDITIONS))


def _stage_sql(cte: str, risk: str) -> str:
    return using(
        "header item policy",
        cte
        + f""" SELECT patient_key, ROUND({risk}, 6) AS data_driven_risk_score,
        ROUND(age * ({risk}), 6) AS age_x_chronic_score, ROUND(COALESCE(denial, 0), 6) AS pre_auth_denial_rate,
        ROUND({OOP_SQL}, 6) AS out_of_pocket_ratio FROM policy LEFT JOIN members USING (patient_key)""",
    )


def _stage(spark, sf_dir, risk):
    header = M.claim_header(spark, sf_dir)
    flags = C.member_condition_flags(header, M.claim_item(spark, sf_dir), M.CONDITIONS)
    totals = header.groupBy(C.MEMBER).agg(
        F.sum(C.AMOUNT).alias("_cost"), X.share(F.col("pre_auth_outcome") == "rejected").alias("_denial")
    )
    joined = M.policy(spark, sf_dir).join(flags, C.MEMBER, "left").join(totals, C.MEMBER, "left")
    return joined.select(
        C.MEMBER,
        r(risk).alias("data_driven_risk_score"),
        r(F.col("age") * risk).alias("age_x_chronic_score"),
        r(F.coalesce("_denial", F.lit(0.0)), 6).alias("pre_auth_denial_rate"),
        r(X.out_of_pocket_ratio(F.coalesce("_cost", F.lit(0.0)), "premium"), 6).alias("out_of_pocket_ratio"),
    )


@query("feature_stage", _stage_sql(STAGE_CTE, RISK_SQL))
def feature_stage(spark, sf_dir):
    """Member features composed on one plan, without files between the steps; weights as given in the SQL."""
    return _stage(spark, sf_dir, C.conditions_risk(M.CONDITIONS, COST_WEIGHTS, FREQ_WEIGHTS))


@query("feature_stage_learned", _stage_sql(LEARNED_CTE, LEARNED_SQL))
def feature_stage_learned(spark, sf_dir):
    """The same with learnt weights."""
    return _stage(spark, sf_dir, learned_risk(spark, sf_dir))


@query(
    "financial_reject_label",
    using(
        "header policy line",
        FINANCIAL_CTE
        + CLAIM_TIER_CTE
        + """ SELECT f.claim_request_bundle_id, CAST(CASE WHEN (ytd_spend + claim_amount) / lim > 0.9
        OR is_duplicate_suspect = 1 OR COALESCE(provider_network_tier, 2) > 1 THEN 1 ELSE 0 END AS INTEGER) AS is_rejected
        FROM financial f LEFT JOIN claim_tier t ON f.claim_request_bundle_id = t.claim_request_bundle_id""",
    ),
)
def financial_reject_label(spark, sf_dir):
    table = with_claim_tier(spark, sf_dir, financial_table(spark, sf_dir)).join(plan_limits(spark), "plan_id", "left")
    used = X.plan_utilization("ytd_spend", "claim_amount", "plan_limit")
    label = D.financial_reject_label(used, "provider_network_tier", "is_duplicate_suspect")
    return table.select(C.CLAIM, label.alias("is_rejected"))
