"""Stage tables, prediction logs, artifacts and worklists on any Spark file system."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def write_abt(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def read_abt(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared scratch folder, for work that reads it several times."""
    path = scratch_path(spark, name)
    write_abt(df, path)
    return read_abt(spark, path, df.schema)


def save_artifact(df: DataFrame, path: str) -> None:
    """A learned parameter table as JSON lines."""
    df.write.mode("overwrite").json(path)


def load_artifact(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_prediction_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_prediction_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a nested request; malformed lines become rows of nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def parse_request(df: DataFrame, text: str, schema: str) -> DataFrame:
    """The nested ``request_body`` of a log held as a text column."""
    return df.withColumn("request_body", F.from_json(F.col(text), schema))


def write_worklist(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_worklist(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def conform(df: DataFrame, keys: Mapping[str, list[str]], fills: Mapping[str, Column]) -> DataFrame:
    """One projection that settles names and missing values.

    ``keys`` maps a wanted name to the names it may have, tried in order without regard
    to case, then as a part of a column name. ``fills`` gives the value for a column that
    is absent or null.
    """
    chosen: dict[str, str] = {}
    lower = {c.lower(): c for c in df.columns}
    for wanted, candidates in keys.items():
        found = next((lower[c.lower()] for c in candidates if c.lower() in lower), None)
        if found is None:
            near = [c for c in df.columns if any(n.lower() in c.lower() for n in candidates)]
            # Readers number columns whose names clash; the first of these stands for them.
            if len({c.lower().rstrip("0123456789") for c in near}) > 1:
                raise ValueError(f"{wanted!r} could be any of {near}")
            found = near[0] if near else None
        if found is None:
            raise ValueError(f"no column for {wanted!r} among {df.columns}")
        chosen[wanted] = found
    dropped = {c.lower() for c in chosen.values()}
    fills_lower = {n.lower(): (n, v) for n, v in fills.items()}
    columns = [F.col(f"`{source}`").alias(wanted) for wanted, source in chosen.items()]
    for name in df.columns:
        if name.lower() in dropped:
            continue
        filled = fills_lower.pop(name.lower(), None)
        columns.append(F.coalesce(F.col(f"`{name}`"), filled[1]).alias(filled[0]) if filled else F.col(f"`{name}`"))
    columns += [value.alias(name) for name, value in fills_lower.values()]
    return df.select(*columns)
