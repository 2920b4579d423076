"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.files import load_artifact, save_artifact, stored


def r(column: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, digits)


def day_text(column: str) -> Column:
    return F.col(column).cast("string")


def through_json(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The table after a trip through a JSON artifact file."""
    path = scratch_path(spark, name)
    save_artifact(df, path)
    return load_artifact(spark, path, df.schema)
