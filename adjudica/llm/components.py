"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import settled, spread

#: Rows of two numbers that one task takes without effort.
ONE_TASK = 200_000


def _least(edges: DataFrame, total: int) -> DataFrame:
    """Every edge ``u, v`` with ``least``, the smallest of u and its neighbours."""
    found = edges.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("degree"))
    joined = spread(edges, found, "u", "degree", total, by="v", hot_least=ONE_TASK)
    return joined.select("u", "v", F.least("u", "low").alias("least"))


def roots(links: DataFrame) -> DataFrame:
    """``u, v``: for every linked node u that is not the smallest of its component, that smallest node v.

    ``links`` has columns ``a, b`` (long) in any order and number. Only minima per node and
    edge lists move; a node with very many links is joined by broadcast of its minimum.
    """
    edges = settled(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while True:
        # Done when each node points to one root and no root points on.
        roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("child")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("child")))
        per_node = roles.groupBy("node").agg(F.sum("child").alias("parents"), F.min("child").alias("low"))
        total, loose = per_node.agg(
            F.coalesce(F.sum("parents"), F.lit(0)), F.count(F.when((F.col("parents") > 1) | ((F.col("parents") > 0) & (F.col("low") == 0)), 1))
        ).first()
        if not loose:
            return edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both, 2 * total).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = _least(settled(large), total)
        edges = settled(
            small.select("u", F.col("least").alias("v"))
            .unionByName(small.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")))
            .distinct()
        )
