"""Evaluation and monitoring against direct computation."""

import random

import pytest
from pyspark.sql import functions as F

from adjudica.operators import metrics as E


def test_auc_with_ties_and_one_bin(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 1), round(rng.random(), 1)) for _ in range(300)] + [(1, 1e9), (0, None)]
    df = spark.createDataFrame(rows, "y int, s double").repartition(4)
    used = [r for r in rows if r[1] is not None]
    pos, neg = [s for y, s in used if y == 1], [s for y, s in used if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for bins in (1, 10, 1000):
        assert E.auc(df, "y", "s", bins).first()["auc"] == pytest.approx(want)
    assert E.auc(df.filter("y = 1"), "y", "s").first()["auc"] is None
    assert E.auc(df.withColumn("s", F.lit(0.5)), "y", "s").first()["auc"] == pytest.approx(0.5)


def test_champion_challenger_and_gate(spark):
    df = spark.createDataFrame([(10.0, 12.0, 11.0), (20.0, 16.0, 19.0)], "y double, a double, b double")
    row = E.champion_challenger(df, "y", "a", "b").first()
    assert (row["champion_mae"], row["challenger_mae"], row["decision"]) == (3.0, 1.0, "PROMOTE")
    assert row["improvement"] == pytest.approx(2 / 3)
    assert not E.perf_gate(df, "y", "b", "a").first()["passed"]
    assert E.champion_challenger(df, "y", "a", "a").first()["decision"] == "KEEP"


def test_bias_disparity(spark):
    rows = [("M", 100, 110), ("M", 100, 90), ("F", 100, 130), ("F", 100, 100)]
    got = {r["g"]: r for r in E.bias_disparity(spark.createDataFrame(rows, "g string, y int, p int"), "g", "y", "p").collect()}
    assert got["M"]["mae"] == 10 and got["F"]["mae"] == 15
    assert got["M"]["disparity"] == pytest.approx(0.2) and not got["M"]["passed"]


def test_accuracy_f1_and_precision(spark):
    rows = [("A", "A"), ("A", "B"), ("B", "B"), ("C", "B"), ("C", "C"), ("B", "B")]
    df = spark.createDataFrame(rows, "y string, p string")
    row = E.accuracy_f1(df, "y", "p").first()
    assert row["accuracy"] == pytest.approx(4 / 6)
    assert row["f1_weighted"] == pytest.approx((2 * (2 / 3) + 2 * (2 * 0.5 * 1 / 1.5) + 2 * (2 / 3)) / 6)
    got = {r["label"]: (r["precision"], r["passed"]) for r in E.label_precision(df, "y", "p", ["A", "B", "Z"]).collect()}
    assert got == {"A": (1.0, True), "B": (0.5, False), "Z": (0.0, False)}


def test_drift_needs_rows_on_both_sides(spark):
    base = spark.createDataFrame([(40.0, 100.0), (60.0, 100.0)], "age double, cost double")
    live = spark.createDataFrame([(54.0, 150.0)], "age double, cost double")
    got = {r["metric"]: r["drifted"] for r in E.drift_check(live, base, [("age", 0.1), ("cost", 0.2)]).collect()}
    assert got == {"age": False, "cost": True}
    assert E.drift_check(live.limit(0), base, [("age", 0.1)]).count() == 0


def test_quantile_label_wants_enough_rows(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(20)], "id int, s double")
    assert sorted(r["id"] for r in E.quantile_label(df, "s").filter("is_fraud = 1").collect()) == [0, 1, 2, 3, 4]
    assert E.quantile_label(df.limit(4), "s").count() == 0
    assert E.quantile_label(df.filter("id < 5"), "s").count() == 0


def test_supervised_switch(spark):
    df = spark.createDataFrame([(1, 0.9, -0.1)], "id int, sup double, iso double")
    many = spark.range(51).withColumn("is_fraud", F.lit(1))
    few = spark.range(50).withColumn("is_fraud", F.lit(1))
    assert E.supervised_switch(df, many, "sup", "iso").first()["score"] == 0.9
    assert E.supervised_switch(df, few, "sup", "iso").first()["score"] == -0.1


def test_correlations_skip_incomplete_rows(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (None, 1.0), (float("nan"), 100.0)]
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in E.correlation_matrix(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).collect()}
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(0.9979487, abs=1e-6)
    assert got[("a", "a")] == pytest.approx(1.0) and len(got) == 4


def test_null_profile_and_numeric_columns(spark):
    df = spark.createDataFrame([(1, None, 2.0), (None, None, None)], "a int, b string, c double")
    got = {r["column_name"]: (r["n_null"], r["n_total"]) for r in E.null_profile(df, df.columns).collect()}
    assert got == {"a": (1, 2), "b": (2, 2), "c": (1, 2)}
    wide = df.withColumn("d", F.lit(1).cast("decimal(4,2)")).withColumn("e", F.lit(1).cast("smallint"))
    assert E.numeric_columns(wide) == ["a", "c"] and E.numeric_columns(wide, ["a"]) == ["c"]


def test_align_columns(spark):
    train = spark.createDataFrame([(1, 2, 3)], "id int, x int, y int")
    test = spark.createDataFrame([(9, 5, 7)], "id int, y int, other int")
    kept, aligned = E.align_columns(train, test, ["id"])
    assert kept.columns == aligned.columns == ["x", "y"]
    assert tuple(aligned.first()) == (0, 5)


def test_stratified_split_shares(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(400)], "id int, label string")
    got = {(r["label"], r["is_test"]): r["count"] for r in E.stratified_split(df, "label", "id", 0.2).groupBy("label", "is_test").count().collect()}
    assert got[("a", True)] == pytest.approx(60, abs=1) and got[("b", True)] == pytest.approx(20, abs=1)


def test_threshold_gate_and_business_value(spark):
    df = spark.createDataFrame([("auc", 0.9), ("auc2", 0.5), ("f1", None)], "metric string, value double")
    got = {r["metric"]: r["passed"] for r in E.threshold_gate(df, [("auc", 0.85, None), ("auc2", 0.6, None), ("f1", 0.1, None)]).collect()}
    assert got == {"auc": True, "auc2": False, "f1": False}
    absent = E.threshold_gate(df.filter("metric = 'auc'"), [("auc", 0.85, None), ("mae", None, 1.0)]).collect()
    assert {r["metric"]: r["passed"] for r in absent} == {"auc": True, "mae": False}
    log = spark.createDataFrame([("AUTO_APPROVED", 10.0), ("AUTO_DENIED", 100.0), ("PEND_FOR_REVIEW", 1.0), ("AUTO_APPROVED", 5.0)], "d string, a double")
    row = E.business_value(log, "d", "a").first()
    assert (row["stp_rate"], row["review_savings"], row["prevented_amount"]) == (0.5, 11.0, 80.0)
