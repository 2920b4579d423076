"""Invariants of the model operators."""

import inspect
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adjudica.functions import decisions as D
from adjudica.models import attribution as B
from adjudica.models import forest as I
from adjudica.models import supervised as S
from adjudica.models import tiers as T
from adjudica.plans import models as Q


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": range(1000), "x": rng.normal(0, 1, 1000), "y": rng.normal(5, 2, 1000)})
    pdf.loc[0, ["x", "y"]] = [40.0, -60.0]
    return spark.createDataFrame(pdf)


def test_planted_outlier_ranks_first_and_share_below_zero(points):
    forest = I.fit_forest(points, "id", ["x", "y"], 0.05, trees=50, sample=128)
    scores = I.forest_scores(points, forest).toPandas()
    assert scores.sort_values("anomaly_score")["id"].iloc[0] == 0
    assert (scores["anomaly_score"] < 0).mean() == pytest.approx(0.05, abs=0.005)


def test_scoring_leaves_keys_and_other_columns_alone(spark, points):
    forest = I.fit_forest(points, "id", ["x", "y"], 0.05, trees=10, sample=64)
    keys = [None, 2**53 + 1, 2**53 + 3]
    df = spark.createDataFrame([(k, 0.0, 5.0, "t") for k in keys], "id bigint, x double, y double, note string")
    assert sorted((r["id"] or 0, r["note"]) for r in I.forest_scores(df, forest).collect()) == [
        (0, "t"), (2**53 + 1, "t"), (2**53 + 3, "t")
    ]


def test_broken_challenger_scores_minus_one(spark):
    df = spark.range(60).select("id", (F.col("id") % 5).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    champion = S.fit_cost_model(df, ["x"], [], "y", rounds=1, depth=2)
    broken = S.fit_cost_model(df.withColumn("z", F.col("x")), ["z"], [], "y", rounds=1, depth=2)
    got = S.batch_score(df, champion, broken)
    assert got.filter("challenger_prediction = -1").count() == 60 and got.filter("champion_prediction IS NULL").isEmpty()


def test_cost_model_takes_a_thousand_categories(spark):
    df = spark.range(2000).select(
        F.concat(F.lit("c"), F.col("id") % 1000).alias("city"), (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 7 * 10).cast("double").alias("y"),
    )
    model = S.fit_cost_model(df, ["x"], ["city"], "y", rounds=1, depth=2)
    assert model.transform(df).filter("prediction IS NULL").isEmpty()


def test_refit_is_equal_whatever_the_layout(points):
    one = I.fit_forest(points, "id", ["x", "y"], 0.05, trees=20, sample=64)
    two = I.fit_forest(points.repartition(7), "id", ["x", "y"], 0.05, trees=20, sample=64)
    order = ["tree", "node"]
    pd.testing.assert_frame_equal(
        one.nodes.sort_values(order, ignore_index=True), two.nodes.sort_values(order, ignore_index=True)
    )
    assert one.offset == two.offset


def test_samples_have_the_wanted_size(points):
    drawn = I.draw_samples(points, "id", 1000, 30, 64, 1).groupBy("tree").count().toPandas()
    assert len(drawn) == 30 and drawn["count"].mean() == pytest.approx(64, rel=0.15)
    every = I.draw_samples(points, "id", 1000, 3, 1000, 1).groupBy("tree").count().toPandas()
    assert list(every["count"]) == [1000] * 3
    sparse = I.draw_samples(points, "id", 1000, 4, 8, 1)
    assert sparse.count() == pytest.approx(32, abs=20)


def test_constant_and_tiny_tables(spark):
    flat = spark.createDataFrame([(i, 1.0) for i in range(10)], "id int, x double")
    forest = I.fit_forest(flat, "id", ["x"], 0.1, trees=5, sample=8)
    assert I.forest_scores(flat, forest).select("anomaly_score").distinct().count() == 1
    single = spark.createDataFrame([(1, None)], "id int, x double")
    forest = I.fit_forest(single, "id", ["x"], 0.1, trees=2)
    assert I.forest_scores(single, forest).count() == 1


def test_average_path():
    assert list(I.average_path(np.array([0, 1, 2]))) == [0, 0, 1]
    assert float(I.average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_tiers_follow_cost(spark):
    rows = [(i, 100.0 * (1 + i // 10) + i % 10) for i in range(30)]
    df = spark.createDataFrame(rows, "provider_license_key int, cost double")
    model = T.fit_tiers(df, ["cost"], ["cost"])
    named = model.assign(df)
    means = {r["value_tier_name"]: r["m"] for r in named.groupBy("value_tier_name").agg(F.avg("cost").alias("m")).collect()}
    assert means["Gold"] < means["Silver"] < means["Bronze"]
    assert model.silhouette(df) > 0.8
    more = spark.createDataFrame([(1,), (99,)], "provider_license_key int")
    got = {r[0]: r[1] for r in T.tier_of(more, named, "provider_license_key").collect()}
    assert got == {1: "Gold", 99: "Silver"}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, float(i % 10), float(i % 7), "M" if i % 2 else "F", "A" if i % 10 > 6 else "B" if i % 10 > 2 else "C") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, x double, z double, g string, label_name string")
    return df.withColumn("y", (F.col("x") > 4).cast("int")).withColumn("cost", F.col("x") * 100 + F.col("z"))


def test_classifiers_learn(labelled):
    model = S.fit_multiclass(labelled, ["x", "z"], "label_name", trees=5)
    assert S.classes_of(model) == ["A", "B", "C"]
    scored = S.probabilities(model, labelled.drop("label_name"))
    label, _ = D.best_class("probabilities", S.classes_of(model))
    joined = scored.withColumn("p", label).join(labelled.select("id", "label_name"), "id")
    assert joined.filter("p = label_name").count() > 390
    binary = S.fit_binary(labelled, ["x", "z"], "y", rounds=3)
    right = S.probabilities(binary, labelled).filter((F.col("probabilities")[1] > 0.5).cast("int") == F.col("y"))
    assert right.count() == 400


def test_batch_score_and_missing_challenger(labelled):
    model = S.fit_cost_model(labelled, ["x", "z"], ["g"], "cost", rounds=3)
    both = S.batch_score(labelled, model, model)
    assert both.filter("champion_prediction = challenger_prediction").count() == 400
    alone = S.batch_score(labelled, model, None)
    assert {r[0] for r in alone.select("challenger_prediction").distinct().collect()} == {-1.0}


def test_a_challenger_that_raises_on_some_rows_loses_only_these(labelled):
    model = S.fit_cost_model(labelled, ["x", "z"], ["g"], "cost", rounds=3)

    def challenger(rows):
        if (rows["id"] % 50 == 7).any():
            raise ZeroDivisionError("a row it cannot score")
        return rows["id"] * 2.0

    got = S.batch_score(labelled.repartition(3), model, challenger).select("id", "champion_prediction", "challenger_prediction").collect()
    assert {r["id"]: r["challenger_prediction"] for r in got} == {i: -1.0 if i % 50 == 7 else 2.0 * i for i in range(400)}
    alone = S.batch_score(labelled, model, None)
    assert {r["id"]: r["champion_prediction"] for r in got} == {r["id"]: r["champion_prediction"] for r in alone.collect()}


def test_a_guarded_scorer_fails_whole_or_in_part():
    calls = []

    def broken(rows):
        calls.append(len(rows))
        raise ValueError

    rows = pd.DataFrame({"x": range(8)})
    assert S.guarded(broken)(rows).tolist() == [-1.0] * 8 and len(calls) == 15
    assert S.guarded(lambda rows: [1.0])(rows).tolist() == [-1.0] * 8  # too few values
    assert S.guarded(lambda rows: [])(rows.iloc[:0]).tolist() == []


def test_churn_drivers_name_the_moving_feature(labelled):
    got = S.churn_drivers(labelled, ["x", "z"], "y", top=1)
    extreme = got.filter("x = 9").select("top_churn_drivers").distinct().collect()
    assert [r[0] for r in extreme] == [["x"]]
    assert got.filter("predicted_churn < 0 OR predicted_churn > 1").count() == 0


def test_hash_split_is_disjoint_and_stable(labelled):
    train, test = S.hash_split(labelled, "id")
    assert train.count() + test.count() == 400
    assert train.join(test, "id").count() == 0
    assert train.count() / 400 == pytest.approx(0.7, abs=0.07)


def test_training_is_not_cut(labelled, monkeypatch):
    default = lambda f, name: inspect.signature(f).parameters[name].default
    assert default(S.fit_cost_model, "rounds") == 150 and default(S.fit_binary, "rounds") == 100
    assert S.fit_multiclass(labelled, ["x", "z"], "label_name").stages[-1].getNumTrees == 100
    asked = []
    fit = S.fit_cost_model

    def recorded(df, numeric, categories, target, rounds=default(fit, "rounds")):
        asked.append(rounds)
        return fit(df, ["x"], [], "cost", rounds=1)

    monkeypatch.setattr(S, "fit_cost_model", recorded)
    monkeypatch.setattr(Q, "featured_members", lambda spark, sf_dir: labelled.withColumn("patient_key", F.col("id")).withColumn("annualized_cost", F.col("cost")))
    Q.batch_score(labelled.sparkSession, "")
    Q.cost_model(labelled.sparkSession, "")
    assert asked == [150, 150, 100, 150, 150]


def test_every_new_provider_is_scored_by_a_forest_that_has_not_seen_it(spark, monkeypatch):
    rows = [(k, *[float((k or 0) * (j + 3) % 11) for j in range(len(Q.PROVIDER_FEATURES))]) for k in [None, *range(1, 60)]]
    table = spark.createDataFrame(rows, "provider_license_key bigint, " + ", ".join(f"{c} double" for c in Q.PROVIDER_FEATURES))
    seen, fit = [], I.fit_forest
    monkeypatch.setattr(Q, "stored_provider_features", lambda spark, sf_dir: table)
    monkeypatch.setattr(I, "fit_forest", lambda df, *rest: (seen.append({r[0] for r in df.select("provider_license_key").collect()}), fit(df, *rest))[1])
    got = [r[0] for r in Q.score_new_providers(spark, "").select("provider_license_key").collect()]
    assert sorted(got, key=str) == sorted([r[0] for r in rows], key=str)
    assert len(seen) == 2 and not seen[0] & seen[1] and seen[0] | seen[1] == set(got)


def expected(nodes, row, known, at=0):
    """The value of a tree for a row when only ``known`` features are."""
    node = nodes[at]
    if node["leftChild"] < 0:
        return node["prediction"]
    sides = [node["leftChild"], node["rightChild"]]
    feature, threshold = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
    if feature in known:
        return expected(nodes, row, known, sides[0] if row[feature] <= threshold else sides[1])
    counts = [nodes[s]["rawCount"] for s in sides]
    return sum(n * expected(nodes, row, known, s) for n, s in zip(counts, sides)) / sum(counts)


def test_contributions_equal_shapley_values_over_all_subsets():
    def inner(feature, threshold, left, right, n):
        return {"leftChild": left, "rightChild": right, "rawCount": n, "prediction": 0.0, "split": {"featureIndex": feature, "leftCategoriesOrThreshold": [threshold]}}

    def leaf(value, n):
        return {"leftChild": -1, "rightChild": -1, "rawCount": n, "prediction": value, "split": None}

    nodes = {
        0: inner(0, 0.5, 1, 2, 100), 1: inner(1, 0.3, 3, 4, 60), 2: inner(0, 0.8, 5, 6, 40), 3: leaf(-1.0, 20),
        4: inner(2, 0.1, 7, 8, 40), 5: leaf(2.0, 30), 6: leaf(5.0, 10), 7: leaf(0.5, 15), 8: leaf(3.0, 25),
    }
    leaves = B.leaves_of(nodes, 1.0)
    rows = np.random.default_rng(0).uniform(0, 1, (20, 4))
    rows[0, 1] = np.nan
    got = B.contributions(leaves, rows)
    for row, parts in zip(rows, got):
        for feature in range(4):
            others = [f for f in range(4) if f != feature]
            want = 0.0
            for size in range(4):
                for chosen in itertools.combinations(others, size):
                    share = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                    want += share * (expected(nodes, row, {*chosen, feature}) - expected(nodes, row, set(chosen)))
            assert parts[feature] == pytest.approx(want)
        assert B.base_value(leaves) + parts.sum() == pytest.approx(expected(nodes, row, {0, 1, 2, 3}))
    assert (got[:, 3] == 0).all()


def test_drivers_sum_to_the_margin_of_the_fitted_trees(spark):
    rows = [(i, i % 10 / 10, (i * 7) % 13 / 13, 1.0, int(i % 10 > 6)) for i in range(300)]
    df = spark.createDataFrame(rows, "k bigint, a double, b double, flat double, y int").withColumn("b", F.when(F.col("k") != 5, F.col("b")))
    got = S.churn_drivers(df, ["a", "b", "flat"], "y", top=2, rounds=4)
    model = S.fit_binary(df.na.fill(0), ["a", "b", "flat"], "y", 4)
    base = B.base_value(B.ensemble_leaves(df, model.stages[-1]))
    for r in got.collect():
        margin = base + sum(r["contributions"])
        assert r["predicted_churn"] == pytest.approx(1 / (1 + math.exp(-2 * margin)))
        assert r["top_churn_drivers"][0] == "a" and len(r["top_churn_drivers"]) == 2


def test_scored_once_equals_fit_then_score(spark):
    df = spark.range(400).select(F.col("id").alias("k"), F.rand(3).alias("a"), F.when(F.col("id") == 7, 9.0).otherwise(F.rand(4)).alias("b"))
    df = spark.createDataFrame(df.toPandas())
    forest, scores = I.fit_scores(df, "k", ["a", "b"], 0.05)
    again = I.fit_forest(df, "k", ["a", "b"], 0.05)
    assert forest.offset == pytest.approx(again.offset)
    got = {r["k"]: r["anomaly_score"] for r in scores.collect()}
    assert got == pytest.approx({r["k"]: r["anomaly_score"] for r in I.forest_scores(df, again).collect()})
    assert sum(s < 0 for s in got.values()) == 20 and min(got, key=got.get) == 7


def test_boosting_reads_each_distinct_row_once(spark, monkeypatch):
    """A row of features and target that occurs often is one weighted row, and the model is that of all rows."""
    rows = spark.range(6000).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("b"))
    rows = rows.withColumn("y", (F.col("a") * 2 + F.col("b") > 6).cast("int"))
    read, deal = [], S.dealt
    monkeypatch.setattr(S, "dealt", lambda df, columns: read.append(df.count()) or deal(df, columns))
    model = S.fit_binary(rows, ["a", "b"], "y", rounds=3)
    assert read == [14]
    plain = S.GBTClassifier(labelCol="y", maxIter=3, maxDepth=3, stepSize=0.1, seed=42)
    want = S.Pipeline(stages=[*S.assemble(["a", "b"]), plain]).fit(rows)
    got = [[round(r["probabilities"][1], 9) for r in S.probabilities(m, rows.limit(14)).collect()] for m in (model, want)]
    assert got[0] == got[1]


def test_rows_of_a_fit_are_dealt_out_evenly(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_TASK", 1000)
    merged = spark.range(20_500).coalesce(1).withColumn("other", F.lit(1))
    parts = S.dealt(merged, ["id"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) == 21 and max(p["count"] for p in parts) <= 1000
    assert sum(p["count"] for p in parts) == 20_500
