"""Rolling counts, running spend, rankings and worklists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decisions as D
from ..functions import expressions as X
from ..operators import claims as C
from ..operators import metrics as E
from ..operators import providers as P
from ..operators import windows as W
from ..operators.skew import part_count
from ..registry import query
from ..sources import claims_model as M
from .aggregates import FWA_CTE, HIGH_COST, MEMBER_LINES, member_lines
from .common import day_text, r
from .joins import AMOUNT_UNIT, BILLING_CTE, SIGNATURE, billed_header
from .views import using


def yearly_premiums(spark, sf_dir):
    """One premium per member and year: a tenth of the year's billed amount."""
    return M.claim_header(spark, sf_dir).groupBy(C.MEMBER, F.year(C.DATE).alias("year")).agg(
        (F.sum(C.AMOUNT) / 10).alias("premium")
    )


@query(
    "premium_increase",
    using(
        "header",
        """, y AS (SELECT patient_key, CAST(YEAR(max_serviced_date) AS INTEGER) AS year, SUM(payer_share_amount) / 10
        AS premium FROM header GROUP BY 1, 2), p AS (SELECT *, LAG(premium) OVER (PARTITION BY patient_key ORDER BY year)
        AS previous FROM y) SELECT patient_key, year, ROUND(premium, 6) AS premium,
        ROUND(COALESCE((premium - previous) / previous, 0), 6) AS premium_increase_percentage FROM p""",
    ),
)
def premium_increase(spark, sf_dir):
    return W.premium_increase(yearly_premiums(spark, sf_dir)).select(
        C.MEMBER, "year", r("premium").alias("premium"),
        r("premium_increase_percentage", 6).alias("premium_increase_percentage"),
    )


@query(
    "ytd_spend",
    using(
        "header",
        """SELECT claim_request_bundle_id, patient_key, ROUND(COALESCE(SUM(payer_share_amount) OVER (
        PARTITION BY patient_key, YEAR(max_serviced_date) ORDER BY max_serviced_date, claim_request_bundle_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 2) AS ytd_spend FROM header""",
    ),
)
def ytd_spend(spark, sf_dir):
    return W.ytd_spend(M.claim_header(spark, sf_dir)).select(C.CLAIM, C.MEMBER, r("ytd_spend", 2).alias("ytd_spend"))


@query(
    "duplicate_claims",
    using(
        "header line",
        BILLING_CTE
        + f""" SELECT claim_request_bundle_id, CAST(CASE WHEN ROW_NUMBER() OVER (PARTITION BY max_serviced_date,
        FLOOR(payer_share_amount / {AMOUNT_UNIT}), provider_license_key ORDER BY claim_request_bundle_id) > 1 THEN 1 ELSE 0
        END AS INTEGER) AS is_duplicate_suspect FROM header LEFT JOIN billing USING (claim_request_bundle_id)""",
    ),
)
def duplicate_claims(spark, sf_dir):
    """Repeats of an earlier claim with the same date, amount and provider."""
    marked = W.duplicate_claims(billed_header(spark, sf_dir), SIGNATURE, [C.DATE, C.CLAIM])
    return marked.select(C.CLAIM, "is_duplicate_suspect")


@query(
    "duplicate_lines",
    using(
        "line",
        f"""SELECT provider_license_key, CAST(max_serviced_date AS VARCHAR) AS max_serviced_date, COUNT(*) AS n_lines,
        COUNT(*) - COUNT(*) FILTER (WHERE claim_request_bundle_id = first) AS n_suspect FROM (SELECT *,
        MIN(claim_request_bundle_id) OVER (PARTITION BY provider_license_key, max_serviced_date,
        FLOOR(payer_share_amount / {AMOUNT_UNIT})) AS first FROM line) GROUP BY 1, 2""",
    ),
)
def duplicate_lines(spark, sf_dir):
    """Suspect lines per provider and day: a claim before has the same date, amount and provider."""
    lines = M.claim_line(spark, sf_dir).select(C.CLAIM, C.PROVIDER, C.DATE, W.amount_step(AMOUNT_UNIT).alias("amount_units"))
    marked = W.duplicate_claims(lines, SIGNATURE, [C.CLAIM])
    return marked.groupBy(C.PROVIDER, day_text(C.DATE).alias(C.DATE)).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("is_duplicate_suspect").alias("n_suspect")
    )


@query(
    "claim_velocity_7d",
    using(
        "header",
        """, m AS (SELECT patient_key, MAX(max_serviced_date) AS last FROM header GROUP BY 1)
        SELECT patient_key, CAST(last AS VARCHAR) AS max_serviced_date, COUNT(*) FILTER (WHERE last - max_serviced_date
        BETWEEN 0 AND 7) AS claim_velocity_7d FROM header JOIN m USING (patient_key) GROUP BY 1, 2""",
    ),
)
def claim_velocity_7d(spark, sf_dir):
    return W.patient_velocity(M.claim_header(spark, sf_dir)).select(
        C.MEMBER, day_text(C.DATE).alias(C.DATE), "claim_velocity_7d"
    )


@query(
    "claim_velocity_rolling",
    using(
        "header",
        """SELECT claim_request_bundle_id, COUNT(*) OVER (PARTITION BY patient_key ORDER BY max_serviced_date
        RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS claim_velocity_7d FROM header""",
    ),
)
def claim_velocity_rolling(spark, sf_dir):
    """Every claim with its member's claims of the last seven days."""
    return W.rolling_claims(M.claim_header(spark, sf_dir), [C.MEMBER]).select(C.CLAIM, "claim_velocity_7d")


@query(
    "unique_providers_30d",
    using(
        "header line",
        MEMBER_LINES
        + """, m AS (SELECT patient_key, MAX(max_serviced_date) AS last FROM visits GROUP BY 1)
        SELECT patient_key, COUNT(DISTINCT provider_license_key) AS unique_providers,
        COUNT(DISTINCT provider_license_key) FILTER (WHERE last - max_serviced_date BETWEEN 0 AND 30)
        AS unique_providers_30d FROM visits JOIN m USING (patient_key) GROUP BY 1""",
    ),
)
def unique_providers_30d(spark, sf_dir):
    """Distinct providers per member, over all visits and over the last 30 days."""
    visits = member_lines(spark, sf_dir)
    return W.unique_providers(visits).join(W.unique_providers(visits, 30), C.MEMBER)


@query(
    "unique_providers_rolling",
    using(
        "header line",
        MEMBER_LINES
        + """, d AS (SELECT DISTINCT patient_key, max_serviced_date FROM visits)
        SELECT d.patient_key, CAST(d.max_serviced_date AS VARCHAR) AS max_serviced_date,
        COUNT(DISTINCT v.provider_license_key) AS unique_providers_30d FROM d JOIN visits v
        ON d.patient_key = v.patient_key AND v.max_serviced_date BETWEEN d.max_serviced_date - 30
        AND d.max_serviced_date GROUP BY 1, 2""",
    ),
)
def unique_providers_rolling(spark, sf_dir):
    """Distinct providers in the 30 days up to each visit day."""
    parts = part_count(M.claim_line(spark, sf_dir))
    rolled = W.rolling_unique_providers(member_lines(spark, sf_dir, parts), 30, parts)
    return rolled.select(C.MEMBER, day_text(C.DATE).alias(C.DATE), "unique_providers_30d")


@query(
    "refill_frequency",
    using(
        "header item",
        """, v AS (SELECT patient_key, procedure_code, i.max_serviced_date FROM item i
        JOIN header h USING (claim_request_bundle_id)),
        w AS (SELECT *, COUNT(*) OVER (PARTITION BY patient_key, procedure_code ORDER BY max_serviced_date
        RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS n FROM v)
        SELECT patient_key, procedure_code, MAX(n) AS most_in_a_week, COUNT(*) FILTER (WHERE n > 1) AS n_repeats
        FROM w GROUP BY 1, 2""",
    ),
)
def refill_frequency(spark, sf_dir):
    """Most repeats of one procedure for one member within seven days."""
    owner = M.claim_header(spark, sf_dir).select(C.CLAIM, C.MEMBER)
    visits = M.claim_item(spark, sf_dir).select(C.CLAIM, "procedure_code", C.DATE).join(owner, C.CLAIM)
    return W.refill_frequency(visits, [C.MEMBER, "procedure_code"], 7)


Z_CTE = """, s AS (SELECT provider_license_key, specialty, AVG(payer_share_amount) AS avg_cost FROM line
    LEFT JOIN provider USING (provider_license_key) GROUP BY 1, 2),
    z AS (SELECT *, AVG(avg_cost) OVER (PARTITION BY specialty) AS peer_avg,
    STDDEV_SAMP(avg_cost) OVER (PARTITION BY specialty) AS peer_std FROM s)"""


@query(
    "peer_group_zscore",
    using(
        "line provider",
        Z_CTE
        + """ SELECT provider_license_key, specialty, ROUND(avg_cost, 4) AS avg_cost, ROUND(peer_avg, 6) AS peer_avg,
        ROUND(COALESCE((avg_cost - peer_avg) / NULLIF(peer_std, 0), 0), 6) AS peer_zscore FROM z""",
    ),
)
def peer_group_zscore(spark, sf_dir):
    stats = P.provider_stats(M.claim_line(spark, sf_dir), M.provider(spark, sf_dir))
    return P.peer_group_zscore(stats).select(
        C.PROVIDER, "specialty", r("avg_cost", 4).alias("avg_cost"), r("peer_avg").alias("peer_avg"),
        r("peer_zscore").alias("peer_zscore"),
    )


PROVIDER_FEATURES = [
    "avg_cost_per_claim", "claim_count", "std_cost_per_claim", "weekend_billing_ratio", "high_cost_claim_ratio",
]
WORKLIST_SQL = using(
    "line",
    FWA_CTE
    + ", m AS (SELECT "
    + ", ".join(f"AVG({c}) AS m{i}, STDDEV_SAMP({c}) AS s{i}" for i, c in enumerate(PROVIDER_FEATURES))
    + " FROM fwa), scored AS (SELECT provider_license_key, ROUND(-("
    + " + ".join(f"ABS(COALESCE(({c} - m{i}) / NULLIF(s{i}, 0), 0))" for i, c in enumerate(PROVIDER_FEATURES))
    + f") / {len(PROVIDER_FEATURES)}, 6) AS anomaly_score FROM fwa, m)"
    + " SELECT provider_license_key, anomaly_score FROM scored ORDER BY anomaly_score, provider_license_key LIMIT 20",
)


def provider_distance(features):
    """Providers with minus the mean absolute z-score over their features: lower is odder."""
    moments = features.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in PROVIDER_FEATURES],
            *[F.stddev_samp(c).alias(f"s_{c}") for c in PROVIDER_FEATURES],
        )
    ).scalar()
    scored = features.withColumn("_m", moments)
    total = F.lit(0.0)
    for c in PROVIDER_FEATURES:
        z = F.try_divide(F.col(c) - F.col(f"_m.m_{c}"), F.col(f"_m.s_{c}"))
        total = total + F.abs(F.coalesce(z, F.lit(0.0)))
    return scored.withColumn("anomaly_score", r(-total / len(PROVIDER_FEATURES))).drop("_m")


@query("provider_worklist", WORKLIST_SQL)
def provider_worklist(spark, sf_dir):
    """The 20 providers that differ most from the others."""
    features = P.provider_fwa_features(M.claim_line(spark, sf_dir), HIGH_COST)
    return P.top_k(provider_distance(features), "anomaly_score", C.PROVIDER, 20).select(C.PROVIDER, "anomaly_score")


@query(
    "worklist_topk",
    using(
        "header line",
        MEMBER_LINES
        + """, providers AS (SELECT provider_license_key AS id, ROUND(-AVG(payer_share_amount), 4) AS score FROM line
        GROUP BY 1 ORDER BY 2, 1 LIMIT 20),
        claims AS (SELECT claim_request_bundle_id AS id, ROUND(-payer_share_amount, 6) AS score FROM header
        ORDER BY 2, 1 LIMIT 50),
        patients AS (SELECT patient_key AS id, -COUNT(DISTINCT provider_license_key)::DOUBLE AS score FROM visits
        GROUP BY 1 ORDER BY 2, 1 LIMIT 20)
        SELECT 'provider' AS kind, * FROM providers UNION ALL SELECT 'claim', * FROM claims
        UNION ALL SELECT 'patient', * FROM patients""",
    ),
)
def worklist_topk(spark, sf_dir):
    """Providers, claims and patients to review: 20, 50 and 20 rows by ascending score."""
    providers = P.provider_value_features(M.claim_line(spark, sf_dir)).select(
        F.col(C.PROVIDER).alias("id"), r(-F.col("avg_cost_per_claim"), 4).alias("score")
    )
    claims = M.claim_header(spark, sf_dir).select(F.col(C.CLAIM).alias("id"), r(-F.col(C.AMOUNT)).alias("score"))
    patients = W.unique_providers(member_lines(spark, sf_dir)).select(
        F.col(C.MEMBER).alias("id"), (-F.col("unique_providers")).cast("double").alias("score")
    )
    lists = [("provider", providers, 20), ("claim", claims, 50), ("patient", patients, 20)]
    parts = [P.top_k(df, "score", "id", k).select(F.lit(kind).alias("kind"), "id", "score") for kind, df, k in lists]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


CHURN_CTE = """, m AS (SELECT patient_key, SUM(payer_share_amount) / 100 AS cost, AVG(CASE WHEN pre_auth_outcome =
    'rejected' THEN 1.0 ELSE 0.0 END) AS denial, AVG(CASE WHEN pre_auth_ref IS NULL THEN 1.0 ELSE 0.0 END) AS manual
    FROM header GROUP BY 1),
    f AS (SELECT patient_key, CASE WHEN premium = 0 THEN CASE WHEN COALESCE(cost, 0) > 0 THEN 2.0 ELSE 0.0 END
    ELSE LEAST(GREATEST(COALESCE(cost, 0) / premium, 0.0), 2.0) END AS oop, COALESCE(denial, 0) AS denial,
    COALESCE(manual, 0) AS manual FROM policy LEFT JOIN m USING (patient_key)),
    churn AS (SELECT *, ROUND(0.05::DOUBLE + 0.5::DOUBLE * oop + 0.3::DOUBLE * denial + 0.2::DOUBLE * manual, 6)
    AS churn_probability FROM f)"""


def churn_table(spark, sf_dir):
    """Members with friction features and the churn label's target rate."""
    totals = M.claim_header(spark, sf_dir).groupBy(C.MEMBER).agg(
        (F.sum(C.AMOUNT) / 100).alias("_cost"),
        X.share(F.col("pre_auth_outcome") == "rejected").alias("pre_auth_denial_rate"),
        X.share(F.col("pre_auth_ref").isNull()).alias("manual_adjudication_rate"),
    )
    joined = M.policy(spark, sf_dir).join(totals, C.MEMBER, "left").na.fill(
        0, ["_cost", "pre_auth_denial_rate", "manual_adjudication_rate"]
    )
    features = joined.withColumn("out_of_pocket_ratio", X.out_of_pocket_ratio("_cost", "premium"))
    rate = D.churn_probability("out_of_pocket_ratio", "pre_auth_denial_rate", "manual_adjudication_rate")
    return features.withColumn("churn_probability", r(rate, 6)).drop("_cost")


@query(
    "churn_target_prob",
    using(
        "header policy",
        CHURN_CTE
        + """ SELECT patient_key, churn_probability, CAST(CASE WHEN ('0x' || substr(md5(patient_key || 'churn'), 1, 8)
        )::BIGINT / 4294967296.0::DOUBLE < churn_probability THEN 1 ELSE 0 END AS INTEGER) AS did_churn FROM churn""",
    ),
)
def churn_target_prob(spark, sf_dir):
    """The target rate and a label drawn with a number fixed by the member key."""
    drawn = X.hashed_uniform(C.MEMBER, "churn") < F.col("churn_probability")
    return churn_table(spark, sf_dir).select(C.MEMBER, "churn_probability", X.flag(drawn).alias("did_churn"))


@query(
    "retention_worklist_rates",
    using(
        "header policy",
        CHURN_CTE + " SELECT patient_key, churn_probability FROM churn ORDER BY churn_probability DESC, patient_key",
    ),
)
def retention_worklist_rates(spark, sf_dir):
    """All members by the rate of the target formula, highest first (a range-partitioned sort)."""
    return churn_table(spark, sf_dir).select(C.MEMBER, "churn_probability").orderBy(
        F.desc("churn_probability"), C.MEMBER
    )


@query(
    "retention_value",
    using(
        "header policy",
        CHURN_CTE
        + """ SELECT COUNT(*) FILTER (WHERE churn_probability < 0.5) AS retained_members,
        (COUNT(*) FILTER (WHERE churn_probability < 0.5) * 1200.0)::DOUBLE AS retained_value FROM churn""",
    ),
)
def retention_value(spark, sf_dir):
    return E.retention_value(churn_table(spark, sf_dir), "churn_probability")


@query("distinct_members", "SELECT DISTINCT o_custkey AS patient_key FROM orders")
def distinct_members(spark, sf_dir):
    return C.distinct_members(M.claim_header(spark, sf_dir))


@query(
    "quantile_label",
    WORKLIST_SQL.replace(
        " SELECT provider_license_key, anomaly_score FROM scored ORDER BY",
        ", top AS (SELECT provider_license_key, anomaly_score FROM scored ORDER BY",
    )
    + """) SELECT provider_license_key, anomaly_score, CAST(CASE WHEN anomaly_score < (SELECT
    QUANTILE_CONT(anomaly_score, 0.25) FROM top) THEN 1 ELSE 0 END AS INTEGER) AS is_fraud FROM top""",
)
def quantile_label(spark, sf_dir):
    """The worklist with its lowest quarter labelled as fraud."""
    return E.quantile_label(provider_worklist(spark, sf_dir), "anomaly_score")
