"""Grouped statistics at member, provider and claim grain."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import claims as C
from ..operators import history as H
from ..operators import metrics as E
from ..operators import providers as P
from ..operators import windows as W
from ..operators.skew import dealt, part_count
from ..registry import query
from ..sources import claims_model as M
from .common import day_text, r
from .joins import AMOUNT_UNIT, FLAT, SIGNATURE
from .rules import FLAGS_CTE, TRIAGE_CTE, labelled_claims, triaged_lines
from .scans import WEIGHTS_SQL
from .views import using


@query(
    "patient_stats",
    using(
        "header",
        """SELECT patient_key, ROUND(SUM(payer_share_amount), 2) AS annualized_cost,
        COUNT(DISTINCT claim_request_bundle_id) AS claim_count FROM header GROUP BY 1""",
    ),
)
def patient_stats(spark, sf_dir):
    return C.patient_stats(M.claim_header(spark, sf_dir)).select(
        C.MEMBER, r("annualized_cost", 2).alias("annualized_cost"), "claim_count"
    )


@query(
    "claim_diag_list",
    using(
        "item",
        """SELECT claim_request_bundle_id, principal_diagnosis_code AS diagnosis_code, COUNT(*) AS multiplicity
        FROM item WHERE principal_diagnosis_code IS NOT NULL GROUP BY 1, 2""",
    ),
)
def claim_diag_list(spark, sf_dir):
    return C.claim_diag_list(M.claim_item(spark, sf_dir))


def _history_sql(source: str) -> str:
    return using(
        "header item careteam",
        FLAT
        + f""", base AS ({source}), sizes AS (SELECT patient_key, COUNT(payer_share_amount) AS n_costs,
        ROUND(SUM(payer_share_amount), 2) AS sum_costs, CAST(MIN(max_serviced_date) AS VARCHAR) AS first_date,
        CAST(MAX(max_serviced_date) AS VARCHAR) AS last_date FROM base GROUP BY 1),
        sets AS (SELECT patient_key, COUNT(DISTINCT principal_diagnosis_code) AS n_diagnoses,
        COUNT(DISTINCT practitioner_license) AS n_practitioners, COUNT(DISTINCT practice_desc) AS n_specialties
        FROM flat GROUP BY 1) SELECT * FROM sizes JOIN sets USING (patient_key)""",
    )


def _history(spark, sf_dir, grain):
    history = H.member_history(
        M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.careteam(spark, sf_dir), grain,
        part_count(M.claim_line(spark, sf_dir)),
    )
    return history.select(
        C.MEMBER, "n_costs", r("sum_costs", 2).alias("sum_costs"), day_text("first_date").alias("first_date"),
        day_text("last_date").alias("last_date"), "n_diagnoses", "n_practitioners", "n_specialties",
    )


@query("member_history", _history_sql("SELECT * FROM header"))
def member_history(spark, sf_dir):
    return _history(spark, sf_dir, "claim")


@query("member_history_flattened", _history_sql("SELECT * FROM flat"))
def member_history_flattened(spark, sf_dir):
    return _history(spark, sf_dir, "flattened")


HISTORY_LISTS = """, lists AS (SELECT patient_key, 'visit' AS kind, CAST(max_serviced_date AS VARCHAR) AS value,
    payer_share_amount AS cost, COUNT(*) AS multiplicity FROM header GROUP BY 1, 3, 4 UNION ALL
    SELECT patient_key, 'diagnosis', principal_diagnosis_code, NULL, COUNT(*) FROM header JOIN item
    USING (claim_request_bundle_id) WHERE principal_diagnosis_code IS NOT NULL GROUP BY 1, 3 UNION ALL
    SELECT patient_key, 'provider', CAST(practitioner_license AS VARCHAR), NULL, COUNT(*) FROM header JOIN careteam
    USING (claim_request_bundle_id) WHERE practitioner_license IS NOT NULL GROUP BY 1, 3 UNION ALL
    SELECT patient_key, 'specialty', practice_desc, NULL, COUNT(*) FROM header JOIN careteam
    USING (claim_request_bundle_id) WHERE practice_desc IS NOT NULL GROUP BY 1, 3)"""


def history_rows(spark, sf_dir):
    return H.history_lists(
        M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.careteam(spark, sf_dir),
        part_count(M.claim_line(spark, sf_dir)),
    )


@query(
    "member_history_lists",
    using(
        "header item careteam",
        HISTORY_LISTS
        + " SELECT patient_key, kind, value, ROUND(COALESCE(cost, 0), 2) AS cost, multiplicity FROM lists",
    ),
)
def member_history_lists(spark, sf_dir):
    """The history lists, one row per element."""
    return history_rows(spark, sf_dir).select(
        C.MEMBER, "kind", "value", r(F.coalesce("cost", F.lit(0.0)), 2).alias("cost"), "multiplicity"
    )


@query(
    "abt_renewal_history",
    using(
        "header item careteam policy",
        HISTORY_LISTS
        + """ SELECT p.patient_key, age, gender, classname, COALESCE(kind, '-') AS kind, COALESCE(value, '-') AS value,
        ROUND(COALESCE(cost, 0), 2) AS cost, COALESCE(multiplicity, 0) AS multiplicity
        FROM policy p LEFT JOIN lists USING (patient_key)""",
    ),
)
def abt_renewal_history(spark, sf_dir):
    """The history lists of the renewal table; members without claims have one row."""
    joined = M.policy(spark, sf_dir).join(history_rows(spark, sf_dir), C.MEMBER, "left")
    dash = [F.coalesce(c, F.lit("-")).alias(c) for c in ("kind", "value")]
    return joined.select(
        C.MEMBER, "age", "gender", "classname", *dash, r(F.coalesce("cost", F.lit(0.0)), 2).alias("cost"),
        F.coalesce("multiplicity", F.lit(0)).alias("multiplicity"),
    )


@query("chronic_weights", WEIGHTS_SQL)
def chronic_weights(spark, sf_dir):
    weights = C.chronic_weights(M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.CONDITIONS)
    return weights.select("condition", r("cost_weight").alias("cost_weight"), r("freq_weight").alias("freq_weight"))


@query(
    "specialty_costs",
    using(
        "line provider",
        """SELECT specialty, ROUND(AVG(payer_share_amount), 4) AS avg_cost FROM line
        JOIN provider USING (provider_license_key) GROUP BY 1""",
    ),
)
def specialty_costs(spark, sf_dir):
    costs = C.specialty_costs(M.claim_line(spark, sf_dir), M.provider(spark, sf_dir))
    return costs.select("specialty", r("avg_cost", 4).alias("avg_cost"))


@query(
    "provider_stats",
    using(
        "line provider",
        """SELECT provider_license_key, ROUND(AVG(payer_share_amount), 4) AS avg_cost,
        COUNT(DISTINCT claim_request_bundle_id) AS claim_count, specialty, provider_type FROM line
        LEFT JOIN provider USING (provider_license_key) GROUP BY 1, 4, 5""",
    ),
)
def provider_stats(spark, sf_dir):
    stats = P.provider_stats(M.claim_line(spark, sf_dir), M.provider(spark, sf_dir))
    return stats.select(
        C.PROVIDER, r("avg_cost", 4).alias("avg_cost"), "claim_count", "specialty", "provider_type"
    )


HIGH_COST = 90000.0
FWA_CTE = f""", fwa AS (SELECT provider_license_key, COALESCE(AVG(payer_share_amount), 0) AS avg_cost_per_claim,
    COUNT(DISTINCT claim_request_bundle_id) AS claim_count,
    COALESCE(STDDEV_SAMP(payer_share_amount), 0) AS std_cost_per_claim,
    AVG(CASE WHEN dayofweek(max_serviced_date) IN (0, 5, 6) THEN 1.0 ELSE 0.0 END) AS weekend_billing_ratio,
    AVG(CASE WHEN payer_share_amount > {HIGH_COST} THEN 1.0 ELSE 0.0 END) AS high_cost_claim_ratio
    FROM line GROUP BY 1)"""


@query(
    "provider_fwa_features",
    using(
        "line",
        FWA_CTE
        + """ SELECT provider_license_key, ROUND(avg_cost_per_claim, 4) AS avg_cost_per_claim, claim_count,
        ROUND(std_cost_per_claim, 6) AS std_cost_per_claim, ROUND(weekend_billing_ratio, 6) AS weekend_billing_ratio,
        ROUND(high_cost_claim_ratio, 6) AS high_cost_claim_ratio FROM fwa""",
    ),
)
def provider_fwa_features(spark, sf_dir):
    features = P.provider_fwa_features(M.claim_line(spark, sf_dir), HIGH_COST)
    return features.select(
        C.PROVIDER, r("avg_cost_per_claim", 4).alias("avg_cost_per_claim"), "claim_count",
        r("std_cost_per_claim").alias("std_cost_per_claim"),
        r("weekend_billing_ratio", 6).alias("weekend_billing_ratio"),
        r("high_cost_claim_ratio", 6).alias("high_cost_claim_ratio"),
    )


@query(
    "provider_value_features",
    using(
        "line",
        """SELECT provider_license_key, ROUND(AVG(payer_share_amount), 4) AS avg_cost_per_claim,
        COUNT(DISTINCT claim_request_bundle_id) AS claim_count FROM line GROUP BY 1""",
    ),
)
def provider_value_features(spark, sf_dir):
    return P.provider_value_features(M.claim_line(spark, sf_dir)).select(
        C.PROVIDER, r("avg_cost_per_claim", 4).alias("avg_cost_per_claim"), "claim_count"
    )


def member_lines(spark, sf_dir, parts=None):
    """Billed lines with their member."""
    owner = M.claim_header(spark, sf_dir).select(C.CLAIM, C.MEMBER)
    return dealt(M.claim_line(spark, sf_dir), parts, C.CLAIM).join(dealt(owner, parts, C.CLAIM), C.CLAIM)


MEMBER_LINES = """, visits AS (SELECT l.*, h.patient_key FROM line l
    JOIN header h ON l.claim_request_bundle_id = h.claim_request_bundle_id)"""


@query(
    "patient_fwa_profile",
    using(
        "header line",
        MEMBER_LINES
        + """ SELECT patient_key, COUNT(provider_license_key) AS n_providers_listed, COUNT(max_serviced_date)
        AS n_dates_listed, CAST(MAX(max_serviced_date) AS VARCHAR) AS max_serviced_date FROM visits GROUP BY 1""",
    ),
)
def patient_fwa_profile(spark, sf_dir):
    """Sizes of a member's provider and date lists with the last visit; the lists are never built."""
    return member_lines(spark, sf_dir).groupBy(C.MEMBER).agg(
        F.count(C.PROVIDER).alias("n_providers_listed"),
        F.count(C.DATE).alias("n_dates_listed"),
        F.max(C.DATE).cast("string").alias(C.DATE),
    )


@query(
    "eda_value_counts",
    using(
        "service header",
        """SELECT 'activity_type' AS column_name, activity_type AS value, COUNT(*) AS n FROM service GROUP BY 2
        UNION ALL SELECT 'adjudication_outcome', COALESCE(pre_auth_outcome, '-'), COUNT(*) FROM header GROUP BY 2""",
    ),
)
def eda_value_counts(spark, sf_dir):
    def counts(df, name, column):
        return df.groupBy(F.coalesce(F.col(column), F.lit("-")).alias("value")).agg(
            F.count(F.lit(1)).alias("n")
        ).select(F.lit(name).alias("column_name"), "value", "n")

    return counts(M.service(spark, sf_dir), "activity_type", "activity_type").unionByName(
        counts(M.claim_header(spark, sf_dir), "adjudication_outcome", "pre_auth_outcome")
    )


PROFILED = ["claim_request_bundle_id", "patient_key", "payer_share_amount", "pre_auth_outcome", "pre_auth_ref"]


@query(
    "eda_null_profile",
    using(
        "header",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null, COUNT(*) AS n_total FROM header"
            for c in PROFILED
        ),
    ),
)
def eda_null_profile(spark, sf_dir):
    return E.null_profile(M.claim_header(spark, sf_dir), PROFILED)


LINE_NUMBERS = ["payer_share_amount", "quantity", "discount", "tax"]


@query(
    "correlation_matrix",
    using(
        "line",
        " UNION ALL ".join(
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(CORR({a}, {b}), 6) AS corr FROM line"
            for a in LINE_NUMBERS
            for b in LINE_NUMBERS
        ),
    ),
)
def correlation_matrix(spark, sf_dir):
    return E.correlation_matrix(M.claim_line(spark, sf_dir), LINE_NUMBERS).withColumn("corr", r("corr", 6))


FEATURES = ["age", "premium", "n_claims", "denial", "urgent"]


@query(
    "target_correlation",
    using(
        "header policy",
        """, m AS (SELECT patient_key, CAST(COUNT(*) AS DOUBLE) AS n_claims, SUM(payer_share_amount) AS cost,
        AVG(CASE WHEN pre_auth_outcome = 'rejected' THEN 1.0 ELSE 0.0 END) AS denial,
        AVG(CASE WHEN adjudication_reason = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS urgent FROM header GROUP BY 1),
        t AS (SELECT * FROM policy JOIN m USING (patient_key))
        """
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, ROUND(CORR({c}, cost), 6) AS corr FROM t" for c in FEATURES
        ),
    ),
)
def target_correlation(spark, sf_dir):
    """Member features by their correlation with annualized cost."""
    members = M.claim_header(spark, sf_dir).groupBy(C.MEMBER).agg(
        F.count(F.lit(1)).cast("double").alias("n_claims"),
        F.sum(C.AMOUNT).alias("annualized_cost"),
        X.share(F.col("pre_auth_outcome") == "rejected").alias("denial"),
        X.share(F.col("adjudication_reason").isin(*M.NECESSITY_CODES)).alias("urgent"),
    )
    table = M.policy(spark, sf_dir).join(members, C.MEMBER)
    return E.target_correlation(table, FEATURES, "annualized_cost").withColumn("corr", r("corr", 6))


@query(
    "diag_proc_top5",
    using(
        "item",
        """, n AS (SELECT principal_diagnosis_code, procedure_code, COUNT(*) AS n FROM item GROUP BY 1, 2)
        SELECT principal_diagnosis_code, procedure_code, n, CAST(rnk AS INTEGER) AS rnk FROM (SELECT *, ROW_NUMBER()
        OVER (PARTITION BY principal_diagnosis_code ORDER BY n DESC, procedure_code) AS rnk FROM n) WHERE rnk <= 5""",
    ),
)
def diag_proc_top5(spark, sf_dir):
    return C.diag_proc_top(M.claim_item(spark, sf_dir), 5)


DENIAL_CLASSES = {"1-URGENT": "MEDICAL", "2-HIGH": "FINANCIAL", "3-MEDIUM": "FWA"}


@query(
    "denial_reason_rollup",
    using(
        "header",
        """SELECT CASE adjudication_reason WHEN '1-URGENT' THEN 'MEDICAL' WHEN '2-HIGH' THEN 'FINANCIAL'
        WHEN '3-MEDIUM' THEN 'FWA' ELSE 'OTHER' END AS denial_class, COUNT(*) AS n_claims,
        ROUND(SUM(payer_share_amount), 2) AS amount FROM header WHERE pre_auth_outcome = 'rejected' GROUP BY 1""",
    ),
)
def denial_reason_rollup(spark, sf_dir):
    mapping = spark.createDataFrame(list(DENIAL_CLASSES.items()), "adjudication_reason string, denial_class string")
    denied = M.claim_header(spark, sf_dir).filter(F.col("pre_auth_outcome") == "rejected")
    return C.denial_reason_rollup(denied, mapping).withColumn("amount", r("amount", 2))


@query(
    "member_profitability",
    using(
        "header policy",
        """, c AS (SELECT patient_key, SUM(payer_share_amount) AS cost FROM header GROUP BY 1)
        SELECT patient_key, premium, ROUND(COALESCE(cost, 0), 2) AS claim_cost,
        ROUND(premium - COALESCE(cost, 0), 2) AS profit,
        ROUND(COALESCE(cost, 0) / NULLIF(premium, 0), 6) AS loss_ratio FROM policy LEFT JOIN c USING (patient_key)""",
    ),
)
def member_profitability(spark, sf_dir):
    table = C.member_profitability(M.policy(spark, sf_dir), M.claim_header(spark, sf_dir))
    return table.select(
        C.MEMBER, "premium", r("claim_cost", 2).alias("claim_cost"), r("profit", 2).alias("profit"),
        r("loss_ratio").alias("loss_ratio"),
    )


@query(
    "provider_duplicate_ratio",
    using(
        "line",
        f""", d AS (SELECT *, DENSE_RANK() OVER (PARTITION BY provider_license_key, max_serviced_date,
        FLOOR(payer_share_amount / {AMOUNT_UNIT}) ORDER BY claim_request_bundle_id) > 1 AS dup FROM line)
        SELECT provider_license_key, ROUND(AVG(CASE WHEN dup THEN 1.0 ELSE 0.0 END), 6) AS duplicate_ratio
        FROM d GROUP BY 1""",
    ),
)
def provider_duplicate_ratio(spark, sf_dir):
    """Share of a provider's lines whose date and amount an earlier claim of the provider has already."""
    lines = M.claim_line(spark, sf_dir).select(C.CLAIM, C.PROVIDER, C.DATE, W.amount_step(AMOUNT_UNIT).alias("amount_units"))
    marked = W.duplicate_claims(lines, SIGNATURE, [C.CLAIM])
    return marked.groupBy(C.PROVIDER).agg(r(X.share(F.col("is_duplicate_suspect") == 1), 6).alias("duplicate_ratio"))


@query(
    "provider_value_equation",
    using(
        "line provider",
        """, s AS (SELECT provider_license_key, specialty, AVG(payer_share_amount) AS avg_cost, AVG(1 - discount)
        AS quality FROM line LEFT JOIN provider USING (provider_license_key) GROUP BY 1, 2),
        p AS (SELECT specialty, AVG(payer_share_amount) AS specialty_avg FROM line
        JOIN provider USING (provider_license_key) GROUP BY 1)
        SELECT provider_license_key, ROUND(specialty_avg / avg_cost, 6) AS efficiency, ROUND(quality, 6) AS quality,
        ROUND((quality + specialty_avg / avg_cost) / avg_cost * 1e6, 6) AS value_per_million
        FROM s JOIN p USING (specialty)""",
    ),
)
def provider_value_equation(spark, sf_dir):
    """Quality here is the share of the list price a provider keeps after discounts."""
    lines, providers = M.claim_line(spark, sf_dir), M.provider(spark, sf_dir)
    quality = lines.groupBy(C.PROVIDER).agg(F.avg(1 - F.col("discount")).alias("quality"))
    value = P.provider_value_equation(
        P.provider_stats(lines, providers), C.specialty_costs(lines, providers), quality
    )
    return value.select(
        C.PROVIDER, r("efficiency", 6).alias("efficiency"), r("quality", 6).alias("quality"),
        r(F.col("value_score") * 1e6).alias("value_per_million"),
    )


@query(
    "manual_adjudication_rate",
    using(
        "header item",
        FLAGS_CTE
        + """ SELECT patient_key, ROUND(AVG(CASE WHEN adjudication_target = 'PEND' THEN 1.0 ELSE 0.0 END), 6)
        AS manual_adjudication_rate FROM labelled GROUP BY 1""",
    ),
)
def manual_adjudication_rate(spark, sf_dir):
    rate = X.share(F.col("adjudication_target") == "PEND")
    return labelled_claims(spark, sf_dir).groupBy(C.MEMBER).agg(r(rate, 6).alias("manual_adjudication_rate"))


@query(
    "business_value",
    using(
        "line",
        TRIAGE_CTE
        + """ SELECT COUNT(*) AS n_claims, ROUND(AVG(CASE WHEN final_decision = 'AUTO_APPROVED' THEN 1.0 ELSE 0.0 END), 6)
        AS stp_rate, ROUND(SUM(CASE WHEN final_decision = 'AUTO_APPROVED' THEN 5.5 ELSE 0 END)::DOUBLE, 2)
        AS review_savings, ROUND(SUM(CASE WHEN final_decision = 'AUTO_DENIED' THEN payer_share_amount ELSE 0 END) * 0.8,
        2) AS prevented_amount, ROUND(AVG(payer_share_amount), 6) AS mean_amount FROM triaged""",
    ),
)
def business_value(spark, sf_dir):
    value = E.business_value(triaged_lines(M.claim_line(spark, sf_dir)), "final_decision", C.AMOUNT)
    return value.select(
        "n_claims", r("stp_rate", 6).alias("stp_rate"), r("review_savings", 2).alias("review_savings"),
        r("prevented_amount", 2).alias("prevented_amount"), r("mean_amount").alias("mean_amount"),
    )
