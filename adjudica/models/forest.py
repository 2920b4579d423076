"""Isolation forest (Liu, Ting and Zhou 2008) as Spark jobs.

Each tree grows from a sample of fixed size drawn by a hash, so growing never sees more
than one small sample per task, and the fitted forest is a node table whose size depends
on the parameters alone. Scoring is one narrow pass over the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import exact_percentiles
from ..sources.files import stored

EULER = 0.5772156649015329
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size int"


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    size = np.asarray(n, dtype=float)
    big = np.maximum(size, 3.0)
    path = 2.0 * (np.log(big - 1.0) + EULER) - 2.0 * (big - 1.0) / big
    return np.where(size <= 1, 0.0, np.where(size == 2, 1.0, path))


def grow_tree(values: np.ndarray, max_depth: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, size) of one random tree; leaves have feature -1."""
    nodes: list[tuple] = []
    pending = [(0, np.arange(len(values)), 0)]
    made = 1
    while pending:
        node, rows, depth = pending.pop()
        part = values[rows]
        low, high = (part.min(axis=0), part.max(axis=0)) if len(rows) else (None, None)
        splittable = np.flatnonzero(high > low) if len(rows) > 1 else np.array([], dtype=int)
        if depth >= max_depth or not len(splittable):
            nodes.append((node, -1, 0.0, -1, -1, len(rows)))
            continue
        feature = int(rng.choice(splittable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] <= threshold
        left, right = made, made + 1
        made += 2
        nodes.append((node, feature, threshold, left, right, len(rows)))
        pending.append((left, rows[goes_left], depth + 1))
        pending.append((right, rows[~goes_left], depth + 1))
    return nodes


@dataclass
class IsolationForest:
    """A fitted forest: node arrays per tree, sample size and the score offset."""

    features: list[str]
    nodes: pd.DataFrame
    sample: int
    offset: float = 0.0

    def score(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        """Rows with their score; lower is more anomalous, below 0 is an outlier."""
        trees = [
            t.sort_values("node")[["feature", "threshold", "left", "right", "size"]].to_numpy(dtype=float)
            for _, t in self.nodes.groupby("tree")
        ]
        shared = df.sparkSession.sparkContext.broadcast(trees)
        names, norm, offset = self.features, float(average_path(self.sample)), self.offset

        @F.pandas_udf("double")
        def anomaly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                values = batch.to_numpy(dtype=float)
                every = np.arange(len(values))
                total = np.zeros(len(values))
                for tree in shared.value:
                    at = np.zeros(len(values), dtype=int)
                    depth = np.zeros(len(values))
                    while True:
                        feature = tree[at, 0].astype(int)
                        inner = feature >= 0
                        if not inner.any():
                            break
                        goes_left = values[every, np.maximum(feature, 0)] <= tree[at, 1]
                        step = np.where(goes_left, tree[at, 2], tree[at, 3]).astype(int)
                        at = np.where(inner, step, at)
                        depth += inner
                    total += depth + average_path(tree[at, 4])
                mean = total / max(len(shared.value), 1)
                yield pd.Series(-np.power(2.0, -mean / norm) - offset if norm else np.zeros(len(values)))

        # Only the features travel to Python; keys and all other columns stay as they are.
        return df.withColumn(out, anomaly(F.struct(*names)))


def draw_samples(df: DataFrame, key: str, rows: int, trees: int, sample: int, seed: int) -> DataFrame:
    """Rows repeated for the trees that drew them, about ``sample`` per tree.

    A first hash keeps about ``trees * sample`` rows, so only those are copied per tree,
    however many rows there are.
    """

    def uniform(*parts):
        return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(2**31)) / F.lit(float(2**31))

    keep = min(1.0, trees * sample / rows)
    share = sample / (rows * keep)
    kept = df if keep >= 1.0 else df.filter(uniform(F.lit("row"), F.col(key)) < keep)
    copies = kept.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    return copies if share >= 1.0 else copies.filter(uniform(F.lit("tree"), F.col("tree"), F.col(key)) < share)


def _filled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` with its features as numbers, 0 where they are missing."""
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in features else F.col(c) for c in df.columns])


def grow_forest(
    df: DataFrame, key: str, features: Sequence[str], trees: int = 100, sample: int = 256, seed: int = 42
) -> IsolationForest:
    """A forest without an offset yet."""
    names = list(features)
    data = _filled(df.select(key, *names), names)
    rows = max(data.count(), 1)
    psi = min(sample, rows)
    max_depth = max(1, ceil(log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        values = pdf.sort_values([key, *names])[names].to_numpy(dtype=float)
        grown = grow_tree(values, max_depth, np.random.default_rng([seed, tree]))
        table = pd.DataFrame(grown, columns=["node", "feature", "threshold", "left", "right", "size"])
        table.insert(0, "tree", tree)
        return table

    drawn = draw_samples(data, key, rows, trees, psi, seed)
    # The node table has at most 2 * rows_per_sample - 1 nodes per tree.
    return IsolationForest(names, drawn.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas(), psi)


def _cut(scores: DataFrame, score: str, contamination: float) -> float:
    cut = exact_percentiles(scores.select(score), [], score, [contamination], ["_cut"]).first()
    return float(cut["_cut"]) if cut else 0.0


def fit_forest(
    df: DataFrame, key: str, features: Sequence[str], contamination: float, trees: int = 100, sample: int = 256, seed: int = 42
) -> IsolationForest:
    """Fit on ``df``; the offset makes the given share of its rows score below 0."""
    forest = grow_forest(df, key, features, trees, sample, seed)
    forest.offset = _cut(forest.score(_filled(df.select(*features), features), "_s"), "_s", contamination)
    return forest


def fit_scores(
    df: DataFrame, key: str, features: Sequence[str], contamination: float, out: str = "anomaly_score", seed: int = 42
) -> tuple[IsolationForest, DataFrame]:
    """The forest fitted on ``df`` and the scores of these rows, each of which Python sees once.

    The scores are written to the scratch folder; the cut is selected from what is stored
    there and taken off.
    """
    forest = grow_forest(df, key, features, seed=seed)
    raw = stored(df.sparkSession, forest.score(_filled(df, features), out), "forest-scores")
    forest.offset = _cut(raw, out, contamination)
    return forest, raw.withColumn(out, F.col(out) - F.lit(forest.offset))


def forest_scores(df: DataFrame, forest: IsolationForest, out: str = "anomaly_score") -> DataFrame:
    """Score any table that has the forest's features, also one it was not fitted on."""
    return forest.score(_filled(df, forest.features), out)
