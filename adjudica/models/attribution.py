"""Contributions of features to the margin of boosted trees.

A leaf's value is shared among the features on its path: Shapley values of the game in
which a known feature sends a row on, and an unknown one sends it both ways by the rows
that training saw. They follow from the node table of the fitted ensemble: per leaf, the
tests on each feature and the share of rows that pass them. Contributions and the base
value sum to the margin.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


@dataclass(frozen=True)
class Leaf:
    """A leaf's weighted value; per feature on its path the open lower and closed upper bound, and the share that passes.

    A missing value (NaN) goes right at every test, so it passes where there is no upper bound.
    """

    value: float
    bounds: dict[int, tuple[float, float]]
    shares: dict[int, float]

    def passes(self, values: np.ndarray, feature: int) -> np.ndarray:
        low, high = self.bounds[feature]
        column = values[:, feature]
        return ~(column <= low) & ((column <= high) | (high == np.inf))


def leaves_of(nodes: dict[int, dict], weight: float) -> list[Leaf]:
    """Leaves of one tree from its nodes by id; root is 0."""
    out: list[Leaf] = []
    pending = [(0, {}, {})]
    while pending:
        at, bounds, shares = pending.pop()
        node = nodes[at]
        if node["leftChild"] < 0:
            out.append(Leaf(weight * node["prediction"], bounds, shares))
            continue
        feature, threshold = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
        low, high = bounds.get(feature, (-np.inf, np.inf))
        sides = ((node["leftChild"], (low, min(high, threshold))), (node["rightChild"], (max(low, threshold), high)))
        rows = sum(nodes[child]["rawCount"] for child, _ in sides)
        for child, bound in sides:
            share = nodes[child]["rawCount"] / rows if rows else 0.5
            pending.append((child, bounds | {feature: bound}, shares | {feature: shares.get(feature, 1.0) * share}))
    return out


def contributions(leaves: Sequence[Leaf], values: np.ndarray) -> np.ndarray:
    """One row per row of ``values``: the contribution of each feature."""
    out = np.zeros(values.shape)
    for leaf in leaves:
        names = list(leaf.bounds)
        known = {f: leaf.passes(values, f).astype(float) for f in names}
        for feature in names:
            others = [f for f in names if f != feature]
            total = np.zeros(len(values))
            for size in range(len(others) + 1):
                share = factorial(size) * factorial(len(others) - size) / factorial(len(names))
                for chosen in combinations(others, size):
                    part = np.full(len(values), share)
                    for f in others:
                        part *= known[f] if f in chosen else leaf.shares[f]
                    total += part
            out[:, feature] += leaf.value * (known[feature] - leaf.shares[feature]) * total
    return out


def base_value(leaves: Sequence[Leaf]) -> float:
    """The margin with no feature known."""
    return float(sum(leaf.value * np.prod(list(leaf.shares.values())) for leaf in leaves))


def ensemble_leaves(df: DataFrame, ensemble) -> list[Leaf]:
    """Leaves of a fitted boosted ensemble, read from its stored node tables.

    Their number is bounded by the rounds and the depth.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ensemble")
    ensemble.write().overwrite().save(path)
    trees: dict[int, dict[int, dict]] = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        node = row["nodeData"].asDict(recursive=True)
        trees.setdefault(row["treeID"], {})[node["id"]] = node
    weights = ensemble.treeWeights
    return [leaf for tree, nodes in sorted(trees.items()) for leaf in leaves_of(nodes, weights[tree])]


def with_contributions(df: DataFrame, features: Sequence[str], leaves: Sequence[Leaf], out: str = "contributions") -> DataFrame:
    """``df`` with the contributions of ``features`` as an array; one narrow pass."""
    shared = df.sparkSession.sparkContext.broadcast(list(leaves))

    @F.pandas_udf("array<double>")
    def shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(contributions(shared.value, batch.to_numpy(dtype=float))))

    return df.withColumn(out, shares(F.struct(*[F.col(c).cast("double").alias(c) for c in features])))
