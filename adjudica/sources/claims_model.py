"""Claims tables over the star-schema test data.

Each function is one projection of the stored tables, so column pruning and filters
still reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import load_table


def _day(column: str) -> Column:
    return F.to_date(F.col(column))


def claim_header(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per claim."""
    status = F.col("o_orderstatus")
    return load_table(spark, data_dir, "orders").select(
        F.col("o_orderkey").alias("claim_request_bundle_id"),
        F.col("o_custkey").alias("patient_key"),
        F.col("o_totalprice").alias("payer_share_amount"),
        _day("o_orderdate").alias("max_serviced_date"),
        F.when(status == "F", "rejected").when(status == "P", "approved").alias("pre_auth_outcome"),
        F.when(status != "O", F.concat(F.lit("PA-"), F.col("o_orderkey").cast("string"))).alias("pre_auth_ref"),
        F.col("o_orderpriority").alias("adjudication_reason"),
    )


def claim_line(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per billed line with its provider."""
    return load_table(spark, data_dir, "lineitem").select(
        F.col("l_orderkey").alias("claim_request_bundle_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("provider_license_key"),
        F.col("l_partkey").alias("service_key"),
        F.col("l_extendedprice").alias("payer_share_amount"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        _day("l_shipdate").alias("max_serviced_date"),
    )


def service(spark: SparkSession, data_dir: str) -> DataFrame:
    """Product or service dimension with the diagnosis it is billed under."""
    return load_table(spark, data_dir, "part").select(
        F.col("p_partkey").alias("service_key"),
        F.concat_ws(".", "p_type", F.col("p_size").cast("string")).alias("principal_diagnosis_code"),
        F.col("p_brand").alias("procedure_code"),
        F.col("p_type").alias("activity_type"),
        F.col("p_size").alias("service_size"),
        F.col("p_retailprice").alias("list_price"),
    )


def claim_item(spark: SparkSession, data_dir: str) -> DataFrame:
    """Billed lines with diagnosis, procedure and activity."""
    return claim_line(spark, data_dir).join(service(spark, data_dir), "service_key", "left")


def patient(spark: SparkSession, data_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return load_table(spark, data_dir, "customer").select(
        key.alias("patient_key"),
        (F.lit(20) + key % 60).cast("int").alias("age"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
    )


def policy(spark: SparkSession, data_dir: str) -> DataFrame:
    """Policy master: one row per member."""
    key = F.col("c_custkey")
    nation = load_table(spark, data_dir, "nation").select("n_nationkey", "n_name")
    customer = load_table(spark, data_dir, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("patient_key"),
        (F.lit(20) + key % 60).cast("int").alias("age"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("classname"),
        F.col("c_acctbal").alias("premium"),
        F.date_add(F.lit("1999-01-01").cast("date"), (key % 1000).cast("int")).alias("policyexpirydate"),
    )


def provider(spark: SparkSession, data_dir: str) -> DataFrame:
    nation = load_table(spark, data_dir, "nation")
    region = load_table(spark, data_dir, "region")
    kind = F.when(F.col("r_name").isin("ASIA", "EUROPE"), " Hospital").otherwise(" Clinic")
    return (
        load_table(spark, data_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("s_suppkey").alias("provider_license_key"),
            F.col("n_name").alias("specialty"),
            F.concat(F.col("r_name"), kind).alias("provider_type"),
        )
    )


def careteam(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per practitioner on a claim."""
    line = load_table(spark, data_dir, "lineitem").select(
        F.col("l_orderkey").alias("claim_request_bundle_id"),
        F.col("l_suppkey").alias("provider_license_key"),
    )
    return line.join(provider(spark, data_dir), "provider_license_key", "left").select(
        "claim_request_bundle_id",
        F.col("provider_license_key").alias("practitioner_license"),
        F.col("specialty").alias("practice_desc"),
    )


def events(spark: SparkSession, data_dir: str) -> DataFrame:
    """Claim requests as they arrive; event time as an instant in UTC."""
    return load_table(spark, data_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# Codes of the test data that stand for the concepts of a claims book.
CONDITIONS = {
    "Diabetes": ["ECONOMY.1", "ECONOMY.2"],
    "Hypertension": ["PROMO"],
    "Heart Disease": ["SMALL.1", "MEDIUM.2"],
    "Kidney Disease": ["LARGE.4"],
}
NECESSITY_CODES = ["1-URGENT"]
COMPLEX_PREFIXES = ["LARGE.1", "PROMO.3"]
MEDICATION, IMAGING = "PROMO", "LARGE"
PLAN_LIMITS = {"AUTOMOBILE": 500000.0, "BUILDING": 1000000.0, "FURNITURE": 2000000.0}
