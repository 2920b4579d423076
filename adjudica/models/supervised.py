"""Supervised models with MLlib: cost regression, decision and risk classifiers."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..sources.files import stored
from .attribution import ensemble_leaves, with_contributions

log = logging.getLogger(__name__)

COST_ROUNDS, ROUNDS, TREES = 150, 100, 100  # as in the surveyed configurations; onboarding prices take ROUNDS


ROWS_PER_TASK = 100_000


def dealt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns a fit reads, in even parts: one a core where there are rows for it, and never over ``ROWS_PER_TASK`` rows.

    A fit keeps its rows in the parts it gets (a forest with the bags of all its trees beside
    them), so parts that a shuffle has merged would grow with the table and leave cores idle.
    """
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df.select(*dict.fromkeys(columns)).repartition(max(min(cores, rows // 5_000), -(-rows // ROWS_PER_TASK), 1))


def hash_split(df: DataFrame, key: str, train_percent: int = 70) -> tuple[DataFrame, DataFrame]:
    train = X.hashed_percent(key) < train_percent
    return df.filter(train), df.filter(~train)


def assemble(numeric: Sequence[str], categories: Sequence[str] = ()) -> list:
    """Indexers fitted on the training rows only, then one vector; unseen categories get their own code."""
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categories]
    inputs = [*numeric, *[f"{c}_idx" for c in categories]]
    return [*indexers, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")]


def fit_cost_model(
    df: DataFrame, numeric: Sequence[str], categories: Sequence[str], target: str, rounds: int = COST_ROUNDS, depth: int = 4
) -> PipelineModel:
    """Boosted trees on absolute error; bins follow the largest category column."""
    sizes = df.agg(*[F.countDistinct(c).alias(c) for c in categories]).first() if categories else ()
    trees = GBTRegressor(
        labelCol=target, lossType="absolute", maxIter=rounds, maxDepth=depth, maxBins=max(64, *(n + 2 for n in sizes), 0), seed=42
    )
    return Pipeline(stages=[*assemble(numeric, categories), trees]).fit(dealt(df, [*numeric, *categories, target]))


def fit_binary(df: DataFrame, numeric: Sequence[str], target: str, rounds: int = ROUNDS, depth: int = 3) -> PipelineModel:
    """Boosted trees over the distinct rows of features and target, weighted by how often they occur.

    A tree sees of its rows just the sums per bin, so copies of a row say no more than its weight.
    """
    distinct = df.groupBy(*dict.fromkeys([*numeric, target])).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    trees = GBTClassifier(labelCol=target, weightCol="_weight", maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=42)
    folded = stored(df.sparkSession, distinct, "distinct-rows")
    return Pipeline(stages=[*assemble(numeric), trees]).fit(dealt(folded, folded.columns))


def fit_multiclass(
    df: DataFrame, numeric: Sequence[str], target: str, trees: int = TREES, depth: int = 5
) -> PipelineModel:
    """Random forest over a string target; class order is alphabetical."""
    index = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc")
    forest = RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=42)
    return Pipeline(stages=[index, *assemble(numeric), forest]).fit(dealt(df, [*numeric, target]))


def classes_of(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def probabilities(model: PipelineModel, df: DataFrame, out: str = "probabilities") -> DataFrame:
    """Class probabilities as an array; the target column is not needed."""
    scored = df
    for stage in model.stages:
        if isinstance(stage, type(model.stages[0])) and getattr(stage, "getOutputCol", lambda: "")() == "label":
            continue
        scored = stage.transform(scored)
    return scored.withColumn(out, vector_to_array("probability")).select(*df.columns, out)


Scorer = Callable[[pd.DataFrame], Sequence[float]]
FAILED = -1.0


def guarded(score: Scorer) -> Scorer:
    """The scorer with ``FAILED`` for the rows it raises on, found by halving the batch.

    A scorer that fails on every row is called at most twice per row.
    """

    def attempt(rows: pd.DataFrame) -> np.ndarray:
        try:
            found = np.asarray(score(rows), float)
            if found.shape == (len(rows),):
                return found
            log.warning("the scorer gave %s values for %d rows", found.shape, len(rows))
            return np.full(len(rows), FAILED)
        except Exception:  # whatever a scorer of others may raise
            if len(rows) <= 1:
                log.warning("the scorer failed on a row", exc_info=True)
                return np.full(len(rows), FAILED)
            half = len(rows) // 2
            return np.concatenate([attempt(rows.iloc[:half]), attempt(rows.iloc[half:])])

    return attempt


def batch_score(
    df: DataFrame, champion: PipelineModel, challenger: PipelineModel | Scorer | None
) -> DataFrame:
    """Champion and challenger predictions on every row.

    Without a challenger, or with one that cannot be applied to these rows, its column is
    -1: the champion's answer never depends on it. A challenger that is a function of pandas
    batches may also fail inside a task: only the rows it raises on get -1.
    """
    scored = champion.transform(df).select(*df.columns, F.col("prediction").alias("champion_prediction"))
    if challenger is not None and not isinstance(challenger, PipelineModel):
        safe = guarded(challenger)

        @F.pandas_udf("double")
        def run(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(safe(rows))

        columns = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        return scored.withColumn("challenger_prediction", run(columns))
    if challenger is not None:
        try:
            return challenger.transform(scored).select(
                *scored.columns, F.col("prediction").alias("challenger_prediction")
            )
        except (AnalysisException, IllegalArgumentException):
            log.warning("the challenger cannot score this table", exc_info=True)
    return scored.withColumn("challenger_prediction", F.lit(FAILED))


def churn_drivers(df: DataFrame, features: Sequence[str], target: str, top: int = 3, rounds: int = ROUNDS) -> DataFrame:
    """Churn probability by boosted trees and the features that move it most per row, strongest first.

    ``contributions`` holds what each feature adds to the margin, in the order of
    ``features``. A missing feature counts as 0.
    """
    names = list(features)
    df = df.na.fill(0, names)
    model = fit_binary(df, names, target, rounds)
    scored = model.transform(df).select(*df.columns, vector_to_array("probability")[1].alias("predicted_churn"))
    shared = with_contributions(scored, names, ensemble_leaves(df, model.stages[-1]))
    parts = F.array(
        *[F.struct((-F.abs(F.col("contributions")[i])).alias("size"), F.lit(c).alias("name")) for i, c in enumerate(names)]
    )
    strongest = F.transform(F.slice(F.array_sort(parts), 1, top), lambda p: p["name"])
    return shared.withColumn("top_churn_drivers", strongest)
