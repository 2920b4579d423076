"""Scans, sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import claims as C
from ..operators import metrics as E
from ..operators import providers as P
from ..registry import query
from ..session import scratch_path
from ..sources import claims_model as M
from ..sources import files as S
from ..sources.tables import get_data, load_table
from .common import r, through_json
from .views import condition_sql, using

SCANNED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels"]


@query(
    "scan_tables",
    "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in SCANNED),
)
def scan_tables(spark, sf_dir):
    tables = get_data(sf_dir, SCANNED, spark)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query(
    "conform_schema",
    """SELECT o_custkey AS patient_key, o_orderkey AS claim_request_bundle_id, o_totalprice AS payer_share_amount,
    COALESCE(o_totalprice, 0.0) AS net_amount, COALESCE(o_orderpriority, 'NONE') AS o_orderpriority,
    0 AS has_pre_auth, 1000.0::DOUBLE AS premium, 365 AS policy_duration_days, 0 AS n_outcomes FROM orders""",
)
def conform_schema(spark, sf_dir):
    raw = load_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    keys = {
        "patient_key": ["Patient_KEY", "custkey"],
        "claim_request_bundle_id": ["Claim_ID", "o_orderkey"],
        "payer_share_amount": ["net_amount", "o_totalprice"],
    }
    fills = {
        "o_orderpriority": F.lit("NONE"),
        "has_pre_auth": F.lit(0),
        "premium": F.lit(1000.0),
        "policy_duration_days": F.lit(365),
        "pre_auth_outcomes_list": F.array().cast("array<string>"),
    }
    conformed = S.conform(raw, keys, fills)
    return conformed.withColumn("net_amount", F.coalesce("payer_share_amount", F.lit(0.0))).withColumn(
        "n_outcomes", F.size("pre_auth_outcomes_list")
    ).drop("pre_auth_outcomes_list")


ABT_SQL = using(
    "header policy",
    """SELECT p.patient_key, p.age, p.classname, p.premium, ROUND(COALESCE(SUM(h.payer_share_amount), 0), 2)
    AS annualized_cost FROM policy p LEFT JOIN header h ON p.patient_key = h.patient_key
    GROUP BY p.patient_key, p.age, p.classname, p.premium""",
)


@query("read_write_abt", ABT_SQL)
def read_write_abt(spark, sf_dir):
    """The member table written to the shared scratch folder as Parquet and read back."""
    cost = M.claim_header(spark, sf_dir).groupBy(C.MEMBER).agg(F.sum(C.AMOUNT).alias("cost"))
    abt = M.policy(spark, sf_dir).join(cost, C.MEMBER, "left").select(
        C.MEMBER, "age", "classname", "premium", r(F.coalesce("cost", F.lit(0.0)), 2).alias("annualized_cost")
    )
    path = scratch_path(spark, "abt")
    S.write_abt(abt, path)
    return S.read_abt(spark, path, abt.schema)


WEIGHTS_SQL = using(
    "header item",
    """, flags AS (SELECT claim_request_bundle_id, """
    + ", ".join(f"BOOL_OR({condition_sql(n)}) AS c{i}" for i, n in enumerate(M.CONDITIONS))
    + """ FROM item GROUP BY 1),
    stats AS (SELECT patient_key, SUM(payer_share_amount) AS annualized_cost FROM header GROUP BY 1),
    rows AS (SELECT s.annualized_cost AS c, f.* FROM header h JOIN stats s ON h.patient_key = s.patient_key
        LEFT JOIN flags f ON h.claim_request_bundle_id = f.claim_request_bundle_id)
    """
    + " UNION ALL ".join(
        f"SELECT '{n}' AS condition, ROUND(GREATEST(1.0, AVG(c) FILTER (WHERE c{i}) / AVG(c)), 6) AS cost_weight,"
        f" ROUND(GREATEST(1.0, AVG(c) FILTER (WHERE c{i}) / AVG(c)), 6) AS freq_weight FROM rows"
        for i, n in enumerate(M.CONDITIONS)
    ),
)


@query("artifact_io", WEIGHTS_SQL)
def artifact_io(spark, sf_dir):
    """Learned condition weights after a trip through a JSON artifact."""
    weights = C.chronic_weights(M.claim_header(spark, sf_dir), M.claim_item(spark, sf_dir), M.CONDITIONS)
    stored = through_json(spark, weights, "chronic-weights")
    return stored.select("condition", r("cost_weight").alias("cost_weight"), r("freq_weight").alias("freq_weight"))


@query(
    "read_prediction_log",
    """SELECT event_id, event_type, CAST(props::JSON->>'$.k' AS BIGINT) AS k, value AS prediction FROM events""",
)
def read_prediction_log(spark, sf_dir):
    """Requests logged as JSON lines with a nested body, read back with a declared schema."""
    log = S.parse_request(M.events(spark, sf_dir), "props", "k bigint").select(
        "event_id", "event_type", "request_body", F.col("value").alias("champion_prediction")
    )
    path = scratch_path(spark, "prediction-log")
    S.append_prediction_log(log, path)
    stored = S.read_prediction_log(
        spark, path, "event_id bigint, event_type string, request_body struct<k: bigint>, champion_prediction double"
    )
    return stored.select(
        "event_id", "event_type", F.col("request_body.k").alias("k"), F.col("champion_prediction").alias("prediction")
    )


@query(
    "write_worklist",
    using(
        "line",
        """SELECT provider_license_key, ROUND(AVG(payer_share_amount), 4) AS avg_cost_per_claim,
        COUNT(DISTINCT claim_request_bundle_id) AS claim_count FROM line GROUP BY 1
        ORDER BY ROUND(AVG(payer_share_amount), 4) DESC, provider_license_key LIMIT 20""",
    ),
)
def write_worklist(spark, sf_dir):
    """The 20 most expensive providers written as CSV and read back."""
    features = P.provider_value_features(M.claim_line(spark, sf_dir)).withColumn(
        "avg_cost_per_claim", r("avg_cost_per_claim", 4)
    )
    worklist = P.top_k(features, "avg_cost_per_claim", C.PROVIDER, 20, ascending=False)
    path = scratch_path(spark, "worklist")
    S.write_worklist(worklist, path)
    return S.read_worklist(spark, path, worklist.schema)


@query(
    "split_members",
    """SELECT DISTINCT c_custkey AS patient_key,
    ('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 70 AS is_train FROM customer""",
)
def split_members(spark, sf_dir):
    return C.split_members(M.patient(spark, sf_dir))


@query("select_numeric", "SELECT UNNEST(['age', 'annualized_cost', 'premium']) AS column_name")
def select_numeric(spark, sf_dir):
    """Numeric columns of the member table, read from its schema, that hold any value."""
    cost = M.claim_header(spark, sf_dir).groupBy(C.MEMBER).agg(F.sum(C.AMOUNT).alias("annualized_cost"))
    abt = M.policy(spark, sf_dir).join(cost, C.MEMBER, "left")
    names = E.numeric_columns(abt, exclude=[C.MEMBER])
    profile = E.null_profile(abt.select(*names), names)
    return profile.filter(F.col("n_null") < F.col("n_total")).select("column_name")


@query(
    "drop_columns",
    using(
        "policy",
        """SELECT gender, 0 AS n_lists, classname, age FROM policy
        WHERE ('0x' || substr(md5(CAST(patient_key AS VARCHAR)), 1, 8))::BIGINT % 100 >= 70""",
    ),
)
def drop_columns(spark, sf_dir):
    """Test members with the training columns: ids, targets and dates dropped, absent ones filled."""
    members = M.policy(spark, sf_dir)
    split = C.split_members(members)
    train = members.join(split.filter("is_train"), C.MEMBER, "left_semi").withColumn("n_lists", F.lit(0))
    test = members.join(split.filter("NOT is_train"), C.MEMBER, "left_semi")
    return E.align_columns(train, test, [C.MEMBER, "premium", "policyexpirydate", "city"])[1]
