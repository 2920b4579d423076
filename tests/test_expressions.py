"""Scalar and list features on edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adjudica.functions import decisions as D
from adjudica.functions import expressions as X


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("v")).collect()]


DEFINITIONS = {"Diabetes": ["E11"], "Hypertension": ["I10"]}
COST = {"Diabetes": 1.8, "Hypertension": 1.2}
FREQ = {"Diabetes": 1.2, "Hypertension": 1.0}


def test_condition_risk_score(spark):
    rows = [(["E11.9", "I10"],), (["E11.0"],), (["R51"],), ([],), (None,), (["E11.0", None, "E11.1"],)]
    score = X.condition_risk_score("c", DEFINITIONS, COST, FREQ)
    assert values(spark, rows, "c array<string>", score) == pytest.approx([2.6, 1.5, 0, 0, 0, 1.5])


def test_listed_condition_score_counts_duplicates_and_unknowns(spark):
    rows = [(["Diabetes", "Diabetes"],), (["Other"],), ([],), (None,), ([None],)]
    score = X.listed_condition_score("c", COST, FREQ)
    assert values(spark, rows, "c array<string>", score) == pytest.approx([3.0, 1.0, 0.0, 0.0, 1.0])
    assert values(spark, [(["a", "b"],)], "c array<string>", X.listed_condition_score("c", {}, {})) == [2.0]


def test_derive_conditions(spark):
    rows = [(["E11.9", "I10", "E11.1"],), (["R51", None],), (None,)]
    assert values(spark, rows, "c array<string>", X.derive_conditions("c", DEFINITIONS)) == [
        ["Diabetes", "Hypertension"], [], [],
    ]


def test_list_iqr(spark):
    rows = [([1.0, 2.0, 3.0, 4.0],), ([5.0],), ([],), (None,), ([1.0, None, 3.0],), ([10.0, 0.0],)]
    assert values(spark, rows, "c array<double>", X.list_iqr("c")) == pytest.approx([1.5, 0, 0, 0, 0, 5.0])


def test_list_share_keeps_nulls_in_the_length(spark):
    rows = [(["rejected", "Rejected", None, "rejected"],), ([],), (None,)]
    assert values(spark, rows, "c array<string>", X.list_share("c", "rejected")) == pytest.approx([0.5, 0, 0])


def test_list_count_in(spark):
    rows = [(["N-1", "N-2", "N-1", None],), ([],), (None,)]
    assert values(spark, rows, "c array<string>", X.list_count_in("c", ["N-1"])) == [2, 0, 0]
    assert values(spark, rows, "c array<string>", X.list_count_in("c", [])) == [0, 0, 0]


def test_visit_gap_std(spark):
    days = [dt.date(2023, 1, 1), dt.date(2023, 2, 1), dt.date(2023, 1, 5)]
    rows = [(days,), (days[:2],), (days[:1],), ([],), (None,), ([days[0], None, days[1], days[2]],)]
    assert values(spark, rows, "c array<date>", X.visit_gap_std("c")) == pytest.approx([11.5, 0, 0, 0, 0, 11.5])
    text = [(["2023-01-01", "junk", "2023-01-05", "2023-02-01"],)]
    assert values(spark, text, "c array<string>", X.visit_gap_std("c")) == pytest.approx([11.5])


def test_cost_trend_slope(spark):
    d = [dt.date(2023, 1, 1), dt.date(2023, 1, 3), dt.date(2023, 1, 5)]
    rows = [
        (d, [10.0, 14.0, 18.0]),
        (d, [10.0, 14.0]),
        ([d[0], d[0]], [1.0, 9.0]),
        (d[:1], [1.0]),
        ([], []),
        (None, [1.0]),
        ([d[0], d[1], None], [10.0, 14.0, 99.0]),
    ]
    slope = X.cost_trend_slope("d", "c")
    assert values(spark, rows, "d array<date>, c array<double>", slope) == pytest.approx([2, 0, 0, 0, 0, 0, 2])


def test_recent_count_takes_both_ends(spark):
    now = dt.date(2023, 1, 10)
    days = [now, now - dt.timedelta(7), now - dt.timedelta(8), now + dt.timedelta(1), None]
    rows = [(days, now), (days, None), (None, now), ([], now)]
    assert values(spark, rows, "d array<date>, n date", X.recent_count("d", "n")) == [2, 0, 0, 0]


def test_distinct_size(spark):
    assert values(spark, [(["a", "b", "a"],), ([],), (None,)], "c array<string>", X.distinct_size("c")) == [2, 0, 0]


def test_amount_flags(spark):
    rows = [(500.0,), (493.21,), (0.0,), (None,), (948.7,), (0.95,), (-93.0,), (9.0,)]
    assert values(spark, rows, "a double", X.round_amount("a")) == [1, 0, 1, 0, 0, 0, 0, 0]
    assert values(spark, rows, "a double", X.starts_with_nine("a")) == [0, 0, 0, 0, 1, 0, 1, 1]


def test_out_of_pocket_ratio(spark):
    rows = [(50.0, 100.0), (500.0, 100.0), (-5.0, 100.0), (5.0, 0.0), (0.0, 0.0), (None, 100.0), (5.0, None), (5.0, -1.0)]
    got = values(spark, rows, "c double, p double", X.out_of_pocket_ratio("c", "p"))
    assert got == pytest.approx([0.5, 2, 0, 2, 0, 0, 0, 0])


def test_plan_utilization_and_tier(spark):
    rows = [(None, 100.0, None), (900.0, 100.0, 5000.0), (1.0, None, 10.0)]
    got = values(spark, rows, "y double, a double, l double", X.plan_utilization("y", "a", "l"))
    assert got[:2] == pytest.approx([0.01, 0.2]) and got[2] is None
    assert values(spark, [(1,), (3,), (None,)], "t int", X.network_tier("t")) == [1, 3, 2]


def test_compliance(spark):
    rows = [("E11", "LAB", True), ("E11", "X", None), (None, "LAB", None), ("E11", "", None)]
    got = values(spark, rows, "d string, p string, a boolean", X.soc_compliant("d", "p", "a"))
    assert got == [1, 0, 1, 1]
    rows = [("C", "F", ["F"]), ("C", "Male", ["F"]), ("C", "female", ["F"]), ("C", None, ["F"]), ("L", "M", None), (None, "M", ["F"]), ("L", "M", [])]
    got = values(spark, rows, "p string, g string, a array<string>", X.gender_compliant("p", "g", "a"))
    assert got == [1, 0, 1, 1, 1, 1, 1]


def test_parse_list_text(spark):
    rows = [("['a','b']",), ("[]",), ("plain",), (None,), ("[broken",), ('["a"]',)]
    assert values(spark, rows, "t string", X.parse_list_text("t")) == [["a", "b"], [], [], [], [], ["a"]]


def test_hash_skips_nulls_and_uniform_is_stable(spark):
    rows = [("2023-01-01", 1.0, None), ("2023-01-01", 1.0, "p")]
    got = values(spark, rows, "d string, a double, p string", X.claim_hash("d", "a", "p"))
    assert got[0] != got[1] and all(len(h) == 32 for h in got)
    drawn = values(spark, [(i,) for i in range(200)], "k bigint", X.hashed_uniform("k"))
    assert all(0 <= u < 1 for u in drawn) and 0.35 < sum(drawn) / 200 < 0.65


def test_credibility_score(spark):
    rows = [(100.0, 20, 200.0, 50.0), (100.0, 20, None, 50.0), (None, None, 200.0, 50.0)]
    got = values(spark, rows, "a double, n int, s double, o double", X.credibility_score("a", "n", "s", "o"))
    assert got == pytest.approx([150, 75, 50])


def test_labels_and_gates(spark):
    rows = [(1, 499.0, 1), (1, 500.0, 1), (0, 1.0, 1), (1, 1.0, 0), (1, None, 1), (1, None, 0)]
    got = values(spark, rows, "p int, n double, c int", D.stp_label("p", "n", "c"))
    assert got == ["APPROVE", "PEND", "PEND", "DENY", "PEND", "DENY"]
    rows = [("APPROVE", 0.9), ("APPROVE", 0.5), ("DENY", 0.9), ("PEND", 1.0), (None, None)]
    got = values(spark, rows, "l string, c double", D.triage_decision("l", "c", 0.8, 0.8))
    assert got == ["AUTO_APPROVED", "PEND_FOR_REVIEW", "AUTO_DENIED", "PEND_FOR_REVIEW", "PEND_FOR_REVIEW"]
    rows = [(1.0, 1.0, 0.0), (0.5, 0.0, 1.0), (1.0, 0.5, 1.0), (1.0, 1.0, 0.5), (None, 1.0, 0.0)]
    got = values(spark, rows, "f double, m double, w double", D.auto_pay_gate("f", "m", "w"))
    assert got == ["AUTO-PAY", "REJECT", "DENY", "FLAG", "REJECT"]
    label, conf = D.best_class("p", ["A", "B"])
    frame = spark.createDataFrame([([0.4, 0.6],), ([0.5, 0.5],)], "p array<double>")
    assert [tuple(r) for r in frame.select(label, conf).collect()] == [("B", 0.6), ("A", 0.5)]


def test_churn_and_within(spark):
    rows = [(1.0, 0.5, 0.25)]
    assert values(spark, rows, "o double, d double, m double", D.churn_probability("o", "d", "m")) == pytest.approx([0.75])
    rows = [(0.5,), (0.1,), (None,)]
    assert values(spark, rows, "v double", D.within("v", 0.2, 0.9)) == [True, False, False]


def test_no_python_udf_in_any_expression(spark):
    frame = spark.createDataFrame([(["E11"], [1.0])], "c array<string>, a array<double>")
    plan = frame.select(
        X.condition_risk_score("c", DEFINITIONS, COST, FREQ), X.list_iqr("a"), F.size("c")
    )._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_list_features_name_their_list_once(spark):
    """List functions do not share equal parts: what the expression names often is computed as often."""
    for made, column, times in (
        (X.list_iqr("some_costs"), "some_costs", 1),
        (X.visit_gap_std("some_dates"), "some_dates", 1),
        (X.cost_trend_slope("some_dates", "some_costs"), "some_dates", 2),  # the list, and its size
    ):
        assert str(made).count(column) == times
