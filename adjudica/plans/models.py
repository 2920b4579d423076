"""Model queries: anomaly scores, provider tiers, cost and decision models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import expressions as X
from ..models import forest as I
from ..models import supervised as S
from ..models import tiers as T
from ..operators import claims as C
from ..operators import history as H
from ..operators import metrics as E
from ..operators import providers as P
from ..operators import windows as W
from ..registry import query
from ..sources import claims_model as M
from .aggregates import HIGH_COST, member_lines
from .common import r, stored
from .features import medical_table, plan_limits, provider_features
from .joins import COST_WEIGHTS, FREQ_WEIGHTS, LEARNED_CTE, LEARNED_SQL, RISK_SQL, STAGE_CTE
from .joins import financial_table, learned_risk, with_claim_tier
from .rules import labelled_claims
from .views import using
from .windows import PROVIDER_FEATURES, churn_table


def stored_provider_features(spark, sf_dir):
    return stored(spark, P.provider_fwa_features(M.claim_line(spark, sf_dir), HIGH_COST), "provider-features")


def _scored(df, key, features, contamination, k):
    _, scores = I.fit_scores(df, key, features, contamination)
    return P.top_k(scores.withColumn("anomaly_score", r("anomaly_score", 6)), "anomaly_score", key, k)


@query("isolation_forest_score")
def isolation_forest_score(spark, sf_dir):
    """Anomaly score of every provider."""
    features = stored_provider_features(spark, sf_dir)
    return I.fit_scores(features, C.PROVIDER, PROVIDER_FEATURES, 0.05)[1]


@query("isolation_forest_claims")
def isolation_forest_claims(spark, sf_dir):
    """The 50 oddest claims by amount, roundness and leading digit, out of all of them."""
    claims = M.claim_header(spark, sf_dir).select(
        C.CLAIM, C.AMOUNT, X.round_amount(C.AMOUNT).alias("is_round_amount"),
        X.starts_with_nine(C.AMOUNT).alias("starts_with_nine"),
    )
    return _scored(claims, C.CLAIM, ["is_round_amount", "starts_with_nine", C.AMOUNT], 0.001, 50)


@query("isolation_forest_patients")
def isolation_forest_patients(spark, sf_dir):
    """The 20 oddest members by providers visited and claims in a week."""
    visits = member_lines(spark, sf_dir)
    profile = W.unique_providers(visits, 30).join(W.patient_velocity(visits), C.MEMBER).select(
        C.MEMBER, "unique_providers_30d", "claim_velocity_7d"
    )
    return _scored(stored(spark, profile, "patient-profile"), C.MEMBER, ["unique_providers_30d", "claim_velocity_7d"], 0.005, 20)


@query("score_new_providers")
def score_new_providers(spark, sf_dir):
    """Every provider scored by a forest that has not seen it: two folds by key hash, each fitted on the other."""
    features = stored_provider_features(spark, sf_dir)
    first = F.coalesce(X.hashed_percent(C.PROVIDER) < 50, F.lit(False))
    parts = [
        I.forest_scores(features.filter(fold), I.fit_forest(features.filter(~fold), C.PROVIDER, PROVIDER_FEATURES, 0.05))
        for fold in (first, ~first)
    ]
    return parts[0].unionByName(parts[1])


TIER_FEATURES = ["avg_cost_per_claim", "claim_count", "provider_fraud_score"]


def tier_table(spark, sf_dir):
    lines = M.claim_line(spark, sf_dir)
    scores = P.provider_fwa_features(lines, HIGH_COST).select(
        C.PROVIDER, F.col("high_cost_claim_ratio").alias("provider_fraud_score")
    )
    return stored(spark, P.fraud_score_join(P.provider_value_features(lines), scores), "provider-value")


@query("provider_tiers")
def provider_tiers(spark, sf_dir):
    """Every provider with Bronze, Silver or Gold; providers without claims are Silver."""
    table = tier_table(spark, sf_dir)
    model = T.fit_tiers(table, TIER_FEATURES, ["avg_cost_per_claim", "provider_fraud_score"])
    return T.tier_of(M.provider(spark, sf_dir).select(C.PROVIDER), model.assign(table), C.PROVIDER)


@query("silhouette")
def silhouette(spark, sf_dir):
    table = tier_table(spark, sf_dir)
    model = T.fit_tiers(table, TIER_FEATURES, ["avg_cost_per_claim", "provider_fraud_score"])
    value = model.silhouette(table)
    metrics = table.agg(F.count(F.lit(1)).alias("n_providers")).select(
        F.lit("silhouette").alias("metric"), F.lit(value).alias("value"), "n_providers"
    )
    return E.threshold_gate(metrics, [("silhouette", 0.3, None)])


ONBOARDING = ["age", "self_reported_chronic_score", "age_x_chronic_score"]
VICE = [
    "age", "data_driven_risk_score", "cost_volatility_iqr", "pre_auth_denial_rate", "days_between_visits_std",
    "cost_trend_slope", "care_team_complexity", "medication_ratio", "imaging_ratio", "medical_necessity_denial_count",
]
CHAMPION = [*VICE, "avg_provider_risk_score", "hospital_visit_ratio"]
CATEGORIES = ["gender", "city", "classname"]


def featured_members(spark, sf_dir, risk=None):
    """Members with every pricing feature and their annualized cost; the risk has learnt weights unless given."""
    header, items = M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir)
    team = M.careteam(spark, sf_dir)
    weighted = H.weighted_claims(header, items, team, "claim")
    features = H.member_item_features(header, items, M.CONDITIONS, M.MEDICATION, M.IMAGING)
    risk = learned_risk(spark, sf_dir) if risk is None else risk
    people = team.join(header.select(C.CLAIM, C.MEMBER), C.CLAIM).groupBy(C.MEMBER).agg(
        F.countDistinct("practice_desc").alias("care_team_complexity")
    )
    parts = [
        header.groupBy(C.MEMBER).agg(F.sum(C.AMOUNT).alias("annualized_cost")),
        features.select(
            C.MEMBER, risk.alias("data_driven_risk_score"), risk.alias("self_reported_chronic_score"),
            "medication_ratio", "imaging_ratio",
        ),
        H.cost_iqr(weighted),
        H.visit_gaps(weighted),
        H.cost_trend(weighted),
        H.claim_outcomes(header, M.NECESSITY_CODES),
        people,
        provider_features(spark, sf_dir),
    ]
    table = M.policy(spark, sf_dir)
    for part in parts:
        table = table.join(part, C.MEMBER, "left")
    numbers = [c for c, t in table.dtypes if t in ("int", "bigint", "double") and c != C.MEMBER]
    return table.na.fill(0, numbers).withColumn(
        "age_x_chronic_score", F.col("age") * F.col("self_reported_chronic_score")
    )


PRICING_SQL = using(
    "header item careteam policy line provider",
    STAGE_CTE
    + """, v AS (SELECT patient_key, l.* FROM line l JOIN header h USING (claim_request_bundle_id)),
    q AS (SELECT patient_key, QUANTILE_CONT(payer_share_amount, 0.75) - QUANTILE_CONT(payer_share_amount, 0.25) AS iqr,
    COUNT(*) FILTER (WHERE adjudication_reason = '1-URGENT') AS urgent FROM header GROUP BY 1),
    g AS (SELECT patient_key, STDDEV_POP(gap) AS gaps FROM (SELECT patient_key, CAST(max_serviced_date
    - LAG(max_serviced_date) OVER (PARTITION BY patient_key ORDER BY max_serviced_date) AS DOUBLE) AS gap FROM header)
    GROUP BY 1),
    d AS (SELECT patient_key, payer_share_amount AS y, max_serviced_date - MIN(max_serviced_date)
    OVER (PARTITION BY patient_key) AS x FROM header),
    sl AS (SELECT patient_key, CASE WHEN COUNT(DISTINCT x) < 2 THEN 0 ELSE REGR_SLOPE(y, x) END AS slope FROM d GROUP BY 1),
    t AS (SELECT patient_key, COUNT(DISTINCT practice_desc) AS team FROM header JOIN careteam
    USING (claim_request_bundle_id) GROUP BY 1),
    a AS (SELECT patient_key, AVG(CASE WHEN activity_type = 'PROMO' THEN 1.0 ELSE 0.0 END) AS med,
    AVG(CASE WHEN activity_type = 'LARGE' THEN 1.0 ELSE 0.0 END) AS img FROM header
    JOIN item USING (claim_request_bundle_id) GROUP BY 1),
    st AS (SELECT provider_license_key, AVG(payer_share_amount) AS avg_cost, COUNT(DISTINCT claim_request_bundle_id) AS n
    FROM line GROUP BY 1),
    sp AS (SELECT specialty, AVG(payer_share_amount) AS spec FROM line JOIN provider USING (provider_license_key) GROUP BY 1),
    k AS (SELECT *, AVG(avg_cost) OVER () AS overall FROM st),
    z AS (SELECT k.provider_license_key, provider_type, n / (n + 20.0) * avg_cost + (1 - n / (n + 20.0))
    * COALESCE(spec, overall) AS score FROM k LEFT JOIN provider USING (provider_license_key)
    LEFT JOIN sp USING (specialty)),
    pr AS (SELECT patient_key, AVG(COALESCE(score, (SELECT MAX(overall) FROM k))) AS risk,
    AVG(CASE WHEN LOWER(provider_type) LIKE '%hospital%' THEN 1.0 ELSE 0.0 END) AS hosp
    FROM (SELECT DISTINCT patient_key, provider_license_key FROM v) LEFT JOIN z USING (provider_license_key) GROUP BY 1)
    SELECT patient_key, gender, city, classname, age, """
    + f"ROUND({RISK_SQL}, 6)::DOUBLE AS data_driven_risk_score, "
    + f"ROUND({RISK_SQL}, 6)::DOUBLE AS self_reported_chronic_score, "
    + f"ROUND(age * ({RISK_SQL}), 6)::DOUBLE AS age_x_chronic_score, "
    + """ROUND(COALESCE(iqr, 0), 6) AS cost_volatility_iqr, ROUND(COALESCE(denial, 0), 6) AS pre_auth_denial_rate,
    ROUND(COALESCE(gaps, 0), 6) AS days_between_visits_std, ROUND(COALESCE(slope, 0), 4) AS cost_trend_slope,
    COALESCE(team, 0) AS care_team_complexity, ROUND(COALESCE(med, 0), 6) AS medication_ratio,
    ROUND(COALESCE(img, 0), 6) AS imaging_ratio, COALESCE(urgent, 0) AS medical_necessity_denial_count,
    ROUND(COALESCE(risk, 0), 4) AS avg_provider_risk_score, ROUND(COALESCE(hosp, 0), 6) AS hospital_visit_ratio,
    ROUND(COALESCE(cost, 0), 2) AS annualized_cost FROM policy LEFT JOIN members USING (patient_key)
    LEFT JOIN q USING (patient_key) LEFT JOIN g USING (patient_key) LEFT JOIN sl USING (patient_key)
    LEFT JOIN t USING (patient_key) LEFT JOIN a USING (patient_key) LEFT JOIN pr USING (patient_key)""",
)
ROUNDED = {"cost_trend_slope": 4, "avg_provider_risk_score": 4}
WHOLE = ["age", "care_team_complexity", "medical_necessity_denial_count"]


def _pricing(table):
    return table.select(
        C.MEMBER, *CATEGORIES, *WHOLE,
        *[r(c, ROUNDED.get(c, 6)).alias(c) for c in dict.fromkeys([*ONBOARDING, *CHAMPION]) if c not in WHOLE],
        r("annualized_cost", 2).alias("annualized_cost"),
    )


@query("pricing_features", PRICING_SQL)
def pricing_features(spark, sf_dir):
    """The featured member table with the weights given in the SQL."""
    return _pricing(featured_members(spark, sf_dir, C.conditions_risk(M.CONDITIONS, COST_WEIGHTS, FREQ_WEIGHTS)))


@query("pricing_features_learned", PRICING_SQL.replace(STAGE_CTE, LEARNED_CTE).replace(RISK_SQL, LEARNED_SQL))
def pricing_features_learned(spark, sf_dir):
    """The featured member table that the cost models read, with learnt weights."""
    return _pricing(featured_members(spark, sf_dir))


@query("cost_model")
def cost_model(spark, sf_dir):
    """Test error of the three cost models beside that of the training mean."""
    table = stored(spark, featured_members(spark, sf_dir), "featured-members")
    train, test = S.hash_split(table, C.MEMBER)
    base = train.agg(F.avg("annualized_cost")).scalar()
    rows = None
    variants = (
        ("onboarding", ONBOARDING, S.ROUNDS), ("vice_champion", VICE, S.COST_ROUNDS), ("champion", CHAMPION, S.COST_ROUNDS)
    )
    for name, numeric, rounds in variants:
        model = S.fit_cost_model(train, numeric, CATEGORIES, "annualized_cost", rounds)
        part = model.transform(test).agg(
            F.lit(name).alias("variant"),
            F.count(F.lit(1)).alias("n_test"),
            F.avg(F.abs(F.col("annualized_cost") - F.col("prediction"))).alias("mae"),
            F.avg(F.abs(F.col("annualized_cost") - base)).alias("mean_mae"),
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query("batch_score")
def batch_score(spark, sf_dir):
    """Every member priced by the champion and the vice champion."""
    table = stored(spark, featured_members(spark, sf_dir), "featured-members")
    train, _ = S.hash_split(table, C.MEMBER)
    champion = S.fit_cost_model(train, CHAMPION, CATEGORIES, "annualized_cost")
    challenger = S.fit_cost_model(train, VICE, CATEGORIES, "annualized_cost")
    return S.batch_score(table, champion, challenger).select(
        C.MEMBER, "champion_prediction", "challenger_prediction"
    )


STP_FEATURES = ["net_amount", "has_pre_auth", "service_is_covered", "is_complex_diag"]


@query("stp_model")
def stp_model(spark, sf_dir):
    """Accuracy and weighted F1 of the adjudication forest on a stratified test set."""
    columns = [C.CLAIM, *STP_FEATURES, "adjudication_target"]
    labelled = stored(spark, labelled_claims(spark, sf_dir).select(*columns), "labelled-claims")
    split = E.stratified_split(labelled, "adjudication_target", C.CLAIM, 0.2)
    model = S.fit_multiclass(split.filter("NOT is_test"), STP_FEATURES, "adjudication_target")
    scored = S.probabilities(model, split.filter("is_test"))
    label, _ = D.best_class("probabilities", S.classes_of(model))
    return E.accuracy_f1(scored.withColumn("predicted", label), "adjudication_target", "predicted")


def _binary(spark, table, key, features, target, name):
    """AUC and F1 of a boosted classifier on rows held out by key."""
    table = stored(spark, table.select(key, *features, target), name)
    train, test = S.hash_split(table, key)
    model = S.fit_binary(train, features, target)
    scored = S.probabilities(model, test).withColumn("score", F.col("probabilities")[1]).withColumn(
        "predicted", (F.col("score") > 0.5).cast("int")
    )
    f1 = E.accuracy_f1(scored, target, "predicted")
    return f1.withColumn("auc", E.auc(scored, target, "score").scalar())


CHURN_FEATURES = [
    "out_of_pocket_ratio", "premium_increase_percentage", "pre_auth_denial_rate", "policy_duration_days",
    "manual_adjudication_rate",
]


def churn_training(spark, sf_dir):
    yearly = M.claim_header(spark, sf_dir).groupBy(C.MEMBER, F.year(C.DATE).alias("year")).agg(
        (F.sum(C.AMOUNT) / 10).alias("premium")
    )
    increase = W.premium_increase(yearly)
    latest = increase.groupBy(C.MEMBER).agg(
        F.max(F.struct("year", "premium_increase_percentage"))["premium_increase_percentage"].alias(
            "premium_increase_percentage"
        )
    )
    # The first claim stands for the start of the policy, which the policy table does not hold.
    start = M.claim_header(spark, sf_dir).groupBy(C.MEMBER).agg(F.min(C.DATE).alias("_start"))
    drawn = X.hashed_uniform(C.MEMBER, "churn") < F.col("churn_probability")
    table = churn_table(spark, sf_dir).withColumn("did_churn", X.flag(drawn)).join(latest, C.MEMBER, "left").join(start, C.MEMBER, "left")
    days = F.datediff("policyexpirydate", "_start")
    return table.withColumn("policy_duration_days", days).na.fill(0, ["premium_increase_percentage", "policy_duration_days"])


@query("churn_model")
def churn_model(spark, sf_dir):
    return _binary(spark, churn_training(spark, sf_dir), C.MEMBER, CHURN_FEATURES, "did_churn", "churn-training")


def driven_members(spark, sf_dir):
    columns = churn_training(spark, sf_dir).select(C.MEMBER, *CHURN_FEATURES, "did_churn")
    ranked = S.churn_drivers(stored(spark, columns, "churn-training"), CHURN_FEATURES, "did_churn")
    return ranked.select(C.MEMBER, "predicted_churn", F.array_join("top_churn_drivers", "|").alias("top_churn_drivers"))


@query("churn_drivers")
def churn_drivers(spark, sf_dir):
    """Members with their churn probability and its three strongest drivers."""
    return driven_members(spark, sf_dir)


@query("retention_worklist")
def retention_worklist(spark, sf_dir):
    """All members by predicted churn, highest first (a range-partitioned sort), with their drivers."""
    return driven_members(spark, sf_dir).orderBy(F.desc("predicted_churn"), C.MEMBER)


@query("fwa_model")
def fwa_model(spark, sf_dir):
    """Classifier over provider features, taught by the lowest quarter of the forest scores."""
    features = stored_provider_features(spark, sf_dir)
    _, scores = I.fit_scores(features, C.PROVIDER, PROVIDER_FEATURES, 0.05)
    labelled = E.quantile_label(scores, "anomaly_score")
    return _binary(spark, labelled, C.PROVIDER, PROVIDER_FEATURES, "is_fraud", "fwa-training")


@query("financial_model")
def financial_model(spark, sf_dir):
    table = with_claim_tier(spark, sf_dir, financial_table(spark, sf_dir)).join(plan_limits(spark), "plan_id", "left")
    used = X.plan_utilization("ytd_spend", "claim_amount", "plan_limit")
    table = table.withColumn("plan_utilization_percent", used).withColumn(
        "is_rejected", D.financial_reject_label(
            "plan_utilization_percent", "provider_network_tier", "is_duplicate_suspect"
        )
    )
    features = ["plan_utilization_percent", "is_duplicate_suspect", "claim_amount", "provider_network_tier"]
    return _binary(spark, table, C.CLAIM, features, "is_rejected", "financial-training")


@query("medical_model")
def medical_model(spark, sf_dir):
    table = medical_table(spark, sf_dir).withColumn(
        "is_necessary", D.medical_necessity_label("is_soc_compliant", "is_gender_compliant")
    )
    features = ["is_soc_compliant", "is_gender_compliant", "age"]
    return _binary(spark, table, C.CLAIM, features, "is_necessary", "medical-training")
