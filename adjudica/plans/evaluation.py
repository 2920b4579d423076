"""Evaluation, drift, splits and score switching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import claims as C
from ..operators import metrics as E
from ..operators import providers as P
from ..registry import query
from ..sources import claims_model as M
from ..sources.tables import load_table
from .aggregates import FWA_CTE, HIGH_COST
from .common import r, stored
from .rules import FLAGS_CTE, TRIAGE_CTE, labelled_claims, triaged_lines
from .views import using
from .windows import PROVIDER_FEATURES, provider_distance

PREDICTED_CTE = """, s AS (SELECT specialty, AVG(payer_share_amount) AS champion FROM line JOIN provider
    USING (provider_license_key) GROUP BY 1),
    pr AS (SELECT provider_license_key, AVG(payer_share_amount) AS challenger FROM line GROUP BY 1),
    scored AS (SELECT l.payer_share_amount AS actual, champion, challenger, CASE WHEN h.patient_key % 2 = 0 THEN 'M'
    ELSE 'F' END AS gender FROM line l JOIN header h USING (claim_request_bundle_id)
    JOIN provider p ON l.provider_license_key = p.provider_license_key JOIN s ON p.specialty = s.specialty
    JOIN pr ON pr.provider_license_key = l.provider_license_key)"""


def scored_costs(spark, sf_dir):
    """Line amounts with two predictions: the specialty mean (champion) and the provider mean (challenger)."""
    lines, providers = M.claim_line(spark, sf_dir), M.provider(spark, sf_dir)
    specialties = C.specialty_costs(lines, providers).withColumnRenamed("avg_cost", "champion")
    stats = P.provider_stats(lines, providers).join(specialties, "specialty").select(
        C.PROVIDER, "champion", F.col("avg_cost").alias("challenger")
    )
    owner = M.claim_header(spark, sf_dir).select(C.CLAIM, C.MEMBER)
    gender = F.when(F.col(C.MEMBER) % 2 == 0, "M").otherwise("F").alias("gender")
    return lines.join(stats, C.PROVIDER).join(owner, C.CLAIM).select(
        F.col(C.AMOUNT).alias("actual"), "champion", "challenger", gender
    )


@query(
    "mae",
    using("header line provider", PREDICTED_CTE + " SELECT ROUND(AVG(ABS(actual - champion)), 6) AS mae FROM scored"),
)
def mae(spark, sf_dir):
    return E.mae(scored_costs(spark, sf_dir), "actual", "champion").select(r("mae").alias("mae"))


CC_BODY = """, e AS (SELECT AVG(ABS(actual - champion)) AS a, AVG(ABS(actual - challenger)) AS b FROM scored)
    SELECT ROUND(a, 6) AS champion_mae, ROUND(b, 6) AS challenger_mae, ROUND((a - b) / a, 6) AS improvement, """


def _rounded_errors(df):
    return df.withColumns(
        {
            "champion_mae": r("champion_mae"),
            "challenger_mae": r("challenger_mae"),
            "improvement": r("improvement", 6),
        }
    )


@query(
    "champion_challenger",
    using(
        "header line provider",
        PREDICTED_CTE + CC_BODY + "CASE WHEN b < a THEN 'PROMOTE' ELSE 'KEEP' END AS decision FROM e",
    ),
)
def champion_challenger(spark, sf_dir):
    return _rounded_errors(
        E.champion_challenger(scored_costs(spark, sf_dir), "actual", "champion", "challenger")
    )


@query(
    "perf_gate",
    using("header line provider", PREDICTED_CTE + CC_BODY + "(a - b) / a >= -0.02 AS passed FROM e"),
)
def perf_gate(spark, sf_dir):
    return _rounded_errors(E.perf_gate(scored_costs(spark, sf_dir), "actual", "champion", "challenger")).drop("decision")


@query(
    "bias_disparity",
    using(
        "header line provider",
        PREDICTED_CTE
        + """, t AS (SELECT AVG(ABS(actual - champion)) AS t FROM scored),
        g AS (SELECT gender, AVG(ABS(actual - champion)) AS m FROM scored GROUP BY 1)
        SELECT gender, ROUND(m, 6) AS mae, ROUND(ABS(m - t) / t, 6) AS disparity, ABS(m - t) / t <= 0.15 AS passed
        FROM g, t""",
    ),
)
def bias_disparity(spark, sf_dir):
    groups = E.bias_disparity(scored_costs(spark, sf_dir), "gender", "actual", "champion")
    return groups.withColumn("mae", r("mae")).withColumn("disparity", r("disparity", 6))


def predicted_claims(spark, sf_dir):
    """Adjudication targets beside a call made from the pre-authorisation alone."""
    outcome = F.col("pre_auth_outcome")
    call = F.when(outcome == "rejected", "DENY").when(outcome == "approved", "APPROVE").otherwise("PEND")
    return labelled_claims(spark, sf_dir).withColumn("predicted", call)


CALLS_CTE = (
    FLAGS_CTE
    + """, calls AS (SELECT adjudication_target AS y, CASE pre_auth_outcome WHEN 'rejected' THEN 'DENY'
    WHEN 'approved' THEN 'APPROVE' ELSE 'PEND' END AS p FROM labelled)"""
)


@query(
    "accuracy_f1",
    using(
        "header item",
        CALLS_CTE
        + """, k AS (SELECT UNNEST(['APPROVE', 'DENY', 'PEND']) AS c),
        f AS (SELECT c, COUNT(*) FILTER (WHERE y = c) AS s, COUNT(*) FILTER (WHERE p = c) AS q,
        COUNT(*) FILTER (WHERE y = c AND p = c) AS h FROM calls, k GROUP BY c)
        SELECT ROUND(SUM(h) / SUM(s), 6) AS accuracy, ROUND(SUM(CASE WHEN h = 0 THEN 0.0 ELSE
        2 * (h / q) * (h / s) / (h / q + h / s) END * s) / SUM(s), 6) AS f1_weighted FROM f""",
    ),
)
def accuracy_f1(spark, sf_dir):
    scores = E.accuracy_f1(predicted_claims(spark, sf_dir), "adjudication_target", "predicted")
    return scores.select(r("accuracy", 6).alias("accuracy"), r("f1_weighted", 6).alias("f1_weighted"))


@query(
    "label_precision",
    using(
        "header item",
        CALLS_CTE
        + """ SELECT c AS label, ROUND(COUNT(*) FILTER (WHERE p = c AND y = c) / COUNT(*) FILTER (WHERE p = c), 6)
        AS precision, COUNT(*) FILTER (WHERE p = c AND y = c) / COUNT(*) FILTER (WHERE p = c) >= 0.95 AS passed
        FROM calls, (SELECT UNNEST(['APPROVE', 'DENY']) AS c) GROUP BY c""",
    ),
)
def label_precision(spark, sf_dir):
    table = E.label_precision(
        predicted_claims(spark, sf_dir), "adjudication_target", "predicted", ["APPROVE", "DENY"]
    )
    return table.withColumn("precision", r("precision", 6))


AUC_BODY = """, k AS (SELECT y, RANK() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM d),
    n AS (SELECT COUNT(*) FILTER (WHERE y = 1) AS p, COUNT(*) FILTER (WHERE y <> 1) AS q FROM d)
    SELECT ROUND(((SELECT SUM(rk) FROM k WHERE y = 1)::DOUBLE - p * (p + 1) / 2.0::DOUBLE) / (p::DOUBLE * q), 6) AS auc
    FROM n"""


@query(
    "auc",
    "WITH d AS (SELECT quality AS y, n_chars AS s FROM labels JOIN documents USING (doc_id))" + AUC_BODY,
)
def auc(spark, sf_dir):
    """Labelled texts scored by their length: many ties."""
    scored = load_table(spark, sf_dir, "labels").join(
        load_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    return E.auc(scored, "quality", "n_chars").select(r("auc", 6).alias("auc"))


@query(
    "auc_claims",
    using(
        "header",
        """, d AS (SELECT CASE WHEN pre_auth_outcome = 'rejected' THEN 1 ELSE 0 END AS y, payer_share_amount AS s
        FROM header)"""
        + AUC_BODY,
    ),
)
def auc_claims(spark, sf_dir):
    """Rejections ranked by the claim amount: hardly a tie."""
    scored = M.claim_header(spark, sf_dir).select(
        X.flag(F.col("pre_auth_outcome") == "rejected").alias("y"), F.col(C.AMOUNT).alias("s")
    )
    return E.auc(scored, "y", "s").select(r("auc", 6).alias("auc"))


DRIFT_LIMITS = [("age", 0.10), ("payer_share_amount", 0.20)]


@query(
    "drift_check",
    using(
        "header patient",
        """, rows AS (SELECT max_serviced_date >= DATE '2000-01-01' AS live, payer_share_amount, age FROM header
        JOIN patient USING (patient_key)),
        m AS (SELECT 'age' AS metric, 0.10 AS lim, AVG(age) FILTER (WHERE live) AS a, AVG(age) FILTER (WHERE NOT live)
        AS b FROM rows UNION ALL SELECT 'payer_share_amount', 0.20, AVG(payer_share_amount) FILTER (WHERE live),
        AVG(payer_share_amount) FILTER (WHERE NOT live) FROM rows)
        SELECT metric, ROUND(a, 6) AS live_mean, ROUND(b, 6) AS base_mean, ROUND(ABS(a - b) / b, 6) AS relative_move,
        ABS(a - b) / b > lim AS drifted FROM m""",
    ),
)
def drift_check(spark, sf_dir):
    """Claims since 2000 against the earlier ones."""
    rows = C.claims_patient(M.claim_header(spark, sf_dir), M.patient(spark, sf_dir))
    since = F.lit("2000-01-01").cast("date")
    table = E.drift_check(rows.filter(F.col(C.DATE) >= since), rows.filter(F.col(C.DATE) < since), DRIFT_LIMITS)
    return table.select(
        "metric", r("live_mean").alias("live_mean"), r("base_mean").alias("base_mean"),
        r("relative_move", 6).alias("relative_move"), "drifted",
    )


@query(
    "prediction_report",
    using(
        "line",
        TRIAGE_CTE
        + """ SELECT COUNT(*) AS n_predictions, ROUND(AVG(champion_confidence), 6) AS mean_prediction FROM triaged""",
    ),
)
def prediction_report(spark, sf_dir):
    report = E.prediction_report(triaged_lines(M.claim_line(spark, sf_dir)), "champion_confidence")
    return report.select("n_predictions", r("mean_prediction", 6).alias("mean_prediction"))


@query(
    "stratified_split",
    using(
        "header item",
        FLAGS_CTE
        + """ SELECT claim_request_bundle_id, adjudication_target, PERCENT_RANK() OVER (PARTITION BY adjudication_target
        ORDER BY md5(CAST(claim_request_bundle_id AS VARCHAR))) >= 0.8::DOUBLE AS is_test FROM labelled""",
    ),
)
def stratified_split(spark, sf_dir):
    labels = labelled_claims(spark, sf_dir).select(C.CLAIM, "adjudication_target")
    split = E.stratified_split(stored(spark, labels, "claim-labels"), "adjudication_target", C.CLAIM, 0.2)
    return split.select(C.CLAIM, "adjudication_target", "is_test")


DISTANCE_SQL = (
    FWA_CTE
    + ", m AS (SELECT "
    + ", ".join(f"AVG({c}) AS m{i}, STDDEV_SAMP({c}) AS s{i}" for i, c in enumerate(PROVIDER_FEATURES))
    + " FROM fwa), scored AS (SELECT fwa.*, ROUND(-("
    + " + ".join(f"ABS(COALESCE(({c} - m{i}) / NULLIF(s{i}, 0), 0))" for i, c in enumerate(PROVIDER_FEATURES))
    + f") / {len(PROVIDER_FEATURES)}, 6) AS anomaly_score FROM fwa, m)"
)


@query(
    "supervised_switch",
    using(
        "line",
        DISTANCE_SQL
        + """, k AS (SELECT COUNT(*) FILTER (WHERE toxic = 1) > 50 AS enough FROM labels)
        SELECT provider_license_key, ROUND(CASE WHEN enough THEN high_cost_claim_ratio ELSE anomaly_score END, 6) AS score,
        CASE WHEN enough THEN 'supervised' ELSE 'forest' END AS scored_by FROM scored, k""",
    ),
)
def supervised_switch(spark, sf_dir):
    """Provider score from the labelled model once the label table holds more than 50 positives."""
    scored = provider_distance(P.provider_fwa_features(M.claim_line(spark, sf_dir), HIGH_COST))
    labels = load_table(spark, sf_dir, "labels").select(F.col("toxic").alias("is_fraud"))
    switched = E.supervised_switch(scored, labels, "high_cost_claim_ratio", "anomaly_score")
    return switched.select(C.PROVIDER, r("score", 6).alias("score"), "scored_by")
