"""Named tables: file lookup with prefix fallback and declared schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Name prefixes tried in this order; the first file present wins (fixed values).
PREFIXES = ("", "d_", "D_", "f_", "F_")
FORMATS = ("parquet", "csv")

SCHEMAS: Mapping[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def _system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _system(spark, path)
    return system.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, target = _system(spark, path)
    return system.exists(target) and system.getFileStatus(target).isDirectory()


def resolve(spark: SparkSession, data_dir: str, name: str, formats: Iterable[str] = FORMATS) -> tuple[str, str]:
    """``(path, format)`` of a table; works on any Hadoop file system."""
    for fmt in formats:
        for prefix in PREFIXES:
            path = f"{data_dir.rstrip('/')}/{prefix}{name}.{fmt}"
            if path_exists(spark, path):
                return path, fmt
    raise FileNotFoundError(f"no file for table {name!r} in {data_dir}")


def load_table(spark: SparkSession, data_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """One table. CSV without a declared schema falls back to inference."""
    path, fmt = resolve(spark, data_dir, name)
    schema = schema or SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
        if not schema:
            reader = reader.option("inferSchema", True)
        return reader.csv(path)
    return reader.parquet(path)


def get_data(
    data_dir: str,
    tables: Iterable[str],
    spark: SparkSession,
    schemas: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Name to DataFrame for a list of tables; a missing table raises."""
    schemas = schemas or {}
    return {name: load_table(spark, str(data_dir), name, schemas.get(name)) for name in tables}
