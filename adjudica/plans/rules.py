"""Filters, labels, triage rules and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import expressions as X
from ..operators import claims as C
from ..operators import metrics as E
from ..registry import query
from ..sources import claims_model as M
from .common import r
from .views import condition_sql, prefix_sql, using

APPROVE_BELOW = 100000.0
COVERED_SIZE = 45


@query(
    "condition_filter",
    using(
        "header item",
        f"""SELECT claim_request_bundle_id, patient_key, payer_share_amount FROM header h WHERE EXISTS
        (SELECT 1 FROM item i WHERE i.claim_request_bundle_id = h.claim_request_bundle_id
         AND {condition_sql('Diabetes')})""",
    ),
)
def condition_filter(spark, sf_dir):
    claims = C.condition_claims(
        M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.CONDITIONS["Diabetes"]
    )
    return claims.select(C.CLAIM, C.MEMBER, C.AMOUNT)


MEMBER_CONDITIONS = (
    """, hits AS (SELECT DISTINCT h.patient_key, c.condition FROM header h
    JOIN item i ON h.claim_request_bundle_id = i.claim_request_bundle_id
    JOIN (VALUES """
    + ", ".join(f"('{n}', '{p}')" for n, ps in M.CONDITIONS.items() for p in ps)
    + """) c(condition, prefix) ON starts_with(i.principal_diagnosis_code, c.prefix))"""
)


@query(
    "derive_conditions",
    using(
        "header item",
        MEMBER_CONDITIONS
        + """ SELECT m.patient_key, COALESCE(STRING_AGG(condition, '|' ORDER BY condition), '') AS conditions
        FROM (SELECT DISTINCT patient_key FROM header) m LEFT JOIN hits ON m.patient_key = hits.patient_key
        GROUP BY 1""",
    ),
)
def derive_conditions(spark, sf_dir):
    flags = C.member_condition_flags(M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.CONDITIONS)
    return flags.select(C.MEMBER, F.array_join(C.conditions_array(M.CONDITIONS), "|").alias("conditions"))


FLAGS_CTE = f""", per_claim AS (SELECT claim_request_bundle_id, MIN(CASE WHEN service_size <= {COVERED_SIZE} THEN 1
    ELSE 0 END) AS covered, MAX(CASE WHEN {prefix_sql('principal_diagnosis_code', M.COMPLEX_PREFIXES)} THEN 1 ELSE 0
    END) AS complex FROM item GROUP BY 1),
    flags AS (SELECT h.*, CAST(CASE WHEN pre_auth_ref IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS has_pre_auth,
    CAST(COALESCE(covered, 1) AS INTEGER) AS service_is_covered,
    CAST(COALESCE(complex, 0) AS INTEGER) AS is_complex_diag
    FROM header h LEFT JOIN per_claim p ON h.claim_request_bundle_id = p.claim_request_bundle_id),
    labelled AS (SELECT *, CASE WHEN has_pre_auth = 1 AND payer_share_amount < {APPROVE_BELOW}
    AND service_is_covered = 1 THEN 'APPROVE' WHEN service_is_covered = 0 THEN 'DENY' ELSE 'PEND' END
    AS adjudication_target FROM flags)"""


def flagged_claims(spark, sf_dir):
    covered = M.service(spark, sf_dir).filter(F.col("service_size") <= COVERED_SIZE)
    return C.stp_flags(M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), covered, M.COMPLEX_PREFIXES)


def labelled_claims(spark, sf_dir):
    label = D.stp_label("has_pre_auth", "net_amount", "service_is_covered", APPROVE_BELOW)
    return flagged_claims(spark, sf_dir).withColumn("adjudication_target", label)


@query(
    "stp_flags",
    using(
        "header item",
        FLAGS_CTE
        + """ SELECT claim_request_bundle_id, payer_share_amount AS net_amount, has_pre_auth, service_is_covered,
        is_complex_diag FROM flags""",
    ),
)
def stp_flags(spark, sf_dir):
    return flagged_claims(spark, sf_dir).select(
        C.CLAIM, "net_amount", "has_pre_auth", "service_is_covered", "is_complex_diag"
    )


@query(
    "stp_label",
    using("header item", FLAGS_CTE + " SELECT claim_request_bundle_id, adjudication_target FROM labelled"),
)
def stp_label(spark, sf_dir):
    return labelled_claims(spark, sf_dir).select(C.CLAIM, "adjudication_target")


APPROVE_AT, DENY_AT = 0.7, 0.6


def scored_lines(lines):
    """Billed lines with three class probabilities built from discount, tax and quantity."""
    weights = [F.col("discount") * 10 + 0.05, F.col("tax") * 10 + 0.05, F.col("quantity") / 100 + 0.05]
    total = weights[0] + weights[1] + weights[2]
    return lines.withColumn("probabilities", F.array(*[w / total for w in weights]))


def triaged_lines(lines):
    label, confidence = D.best_class("probabilities", [D.APPROVE, D.DENY, D.PEND])
    return (
        scored_lines(lines)
        .withColumn("champion_prediction", label)
        .withColumn("champion_confidence", confidence)
        .withColumn(
            "final_decision",
            D.triage_decision("champion_prediction", "champion_confidence", APPROVE_AT, DENY_AT),
        )
    )


TRIAGE_CTE = f""", w AS (SELECT *, discount * 10 + 0.05::DOUBLE AS a, tax * 10 + 0.05::DOUBLE AS d,
    quantity / 100 + 0.05::DOUBLE AS p FROM line),
    s AS (SELECT *, a / (a + d + p) AS pa, d / (a + d + p) AS pd, p / (a + d + p) AS pp FROM w),
    b AS (SELECT *, GREATEST(pa, pd, pp) AS champion_confidence, CASE WHEN pa >= pd AND pa >= pp THEN 'APPROVE'
    WHEN pd >= pp THEN 'DENY' ELSE 'PEND' END AS champion_prediction FROM s),
    triaged AS (SELECT *, CASE WHEN champion_prediction = 'APPROVE' AND champion_confidence >= {APPROVE_AT}
    THEN 'AUTO_APPROVED' WHEN champion_prediction = 'DENY' AND champion_confidence >= {DENY_AT} THEN 'AUTO_DENIED'
    ELSE 'PEND_FOR_REVIEW' END AS final_decision FROM b)"""


@query(
    "triage_decision",
    using(
        "line",
        TRIAGE_CTE
        + """ SELECT claim_request_bundle_id, line_no, champion_prediction, ROUND(champion_confidence, 6)
        AS champion_confidence, final_decision FROM triaged""",
    ),
)
def triage_decision(spark, sf_dir):
    return triaged_lines(M.claim_line(spark, sf_dir)).select(
        C.CLAIM, "line_no", "champion_prediction", r("champion_confidence", 6).alias("champion_confidence"),
        "final_decision",
    )


@query(
    "auto_pay_gate",
    using(
        "line",
        """, g AS (SELECT claim_request_bundle_id, MAX(discount) AS worst_discount, MIN(quantity) AS least,
        MAX(tax) AS top_tax FROM line GROUP BY 1)
        SELECT claim_request_bundle_id, CASE WHEN NOT (1.0::DOUBLE - worst_discount > 0.91::DOUBLE) THEN 'REJECT'
        WHEN NOT (least / 50 > 0.1::DOUBLE) THEN 'DENY' WHEN NOT (top_tax < 0.075::DOUBLE) THEN 'FLAG'
        ELSE 'AUTO-PAY' END AS outcome FROM g""",
    ),
)
def auto_pay_gate(spark, sf_dir):
    """Financial, medical and fraud gates over scores of each claim's worst line."""
    scores = M.claim_line(spark, sf_dir).groupBy(C.CLAIM).agg(
        (1.0 - F.max("discount")).alias("financial"),
        (F.min("quantity") / 50).alias("medical"),
        F.max("tax").alias("fwa"),
    )
    medical = F.when(F.col("medical") > 0.1, 1.0).otherwise(0.0)
    return scores.select(C.CLAIM, D.auto_pay_gate("financial", medical, "fwa", 0.91, 0.075).alias("outcome"))


@query(
    "threshold_gate",
    using(
        "line",
        """, m AS (SELECT AVG(discount) AS mean_discount, AVG(tax) AS mean_tax,
        AVG(CASE WHEN payer_share_amount > 50000 THEN 1.0 ELSE 0.0 END) AS high_cost FROM line)
        SELECT 'high_cost_ratio' AS metric, ROUND(high_cost, 6) AS value, high_cost >= 0.6 AS passed FROM m
        UNION ALL SELECT 'mean_discount', ROUND(mean_discount, 6), mean_discount <= 0.15 FROM m
        UNION ALL SELECT 'mean_tax', ROUND(mean_tax, 6), mean_tax >= 0.01 AND mean_tax <= 0.05 FROM m""",
    ),
)
def threshold_gate(spark, sf_dir):
    lines = M.claim_line(spark, sf_dir)
    parts = F.array(
        F.struct(F.lit("high_cost_ratio").alias("metric"), X.share(F.col(C.AMOUNT) > 50000).alias("value")),
        F.struct(F.lit("mean_discount").alias("metric"), F.avg("discount").alias("value")),
        F.struct(F.lit("mean_tax").alias("metric"), F.avg("tax").alias("value")),
    )
    metrics = lines.agg(parts.alias("m")).select(F.inline("m"))
    limits = [("high_cost_ratio", 0.6, None), ("mean_discount", None, 0.15), ("mean_tax", 0.01, 0.05)]
    return E.threshold_gate(metrics, limits).select("metric", r("value").alias("value"), "passed")
