"""Skew-safe operators with tiny thresholds, so that the split ways run, against brute force."""

import datetime as dt
import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adjudica.operators import history as H
from adjudica.operators import skew as K
from adjudica.operators import windows as W
from adjudica.operators.claims import claim_fanout
from adjudica.plans import all_queries

DAY0 = dt.date(2023, 1, 1)


@pytest.fixture(scope="module")
def claims():
    """Member 1 owns most rows, and most of those fall on one day."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        member = 1 if rng.random() < 0.6 else rng.randint(2, 9)
        day = 5 if member == 1 and rng.random() < 0.7 else rng.randint(0, 60)
        rows.append((i, member, round(rng.uniform(1, 500), 2), DAY0 + dt.timedelta(day), rng.randint(1, 6)))
    return pd.DataFrame(
        rows,
        columns=["claim_request_bundle_id", "patient_key", "payer_share_amount", "max_serviced_date",
                 "provider_license_key"],
    )


SCHEMA = (
    "claim_request_bundle_id bigint, patient_key bigint, payer_share_amount double, max_serviced_date date, "
    "provider_license_key bigint"
)


@pytest.fixture(scope="module")
def frame(spark, claims):
    return spark.createDataFrame(claims, SCHEMA).repartition(3)


@pytest.mark.parametrize("hot_rows", [1000, 20, 1])
def test_running_total(frame, claims, hot_rows):
    got = K.running_total_before(
        frame, ["patient_key"], "max_serviced_date", "claim_request_bundle_id", "payer_share_amount", "spent",
        hot_rows,
    ).toPandas().set_index("claim_request_bundle_id")["spent"].to_dict()
    ordered = claims.sort_values(["patient_key", "max_serviced_date", "claim_request_bundle_id"])
    want = ordered.groupby("patient_key")["payer_share_amount"].cumsum() - ordered["payer_share_amount"]
    assert got == pytest.approx(dict(zip(ordered["claim_request_bundle_id"], want)), abs=1e-6)


def test_running_total_keeps_null_days_and_keys(spark):
    rows = [(1, None, 5.0, None), (2, None, 7.0, None), (3, 1, None, DAY0), (4, 1, 2.0, DAY0)]
    df = spark.createDataFrame(rows, "id bigint, k bigint, v double, d date")
    got = {r["id"]: r["s"] for r in K.running_total_before(df, ["k"], "d", "id", "v", "s").collect()}
    assert got == {1: 0.0, 2: 5.0, 3: 0.0, 4: 0.0}


@pytest.mark.parametrize("hot_rows", [10_000, 30, 1])
def test_exact_percentiles(frame, claims, hot_rows):
    got = K.exact_percentiles(
        frame, ["patient_key"], "payer_share_amount", [0.25, 0.5, 0.9], ["a", "b", "c"], hot_rows=hot_rows
    ).toPandas().set_index("patient_key").sort_index()
    want = claims.groupby("patient_key")["payer_share_amount"].quantile([0.25, 0.5, 0.9]).unstack()
    np.testing.assert_allclose(got[["a", "b", "c"]], want, rtol=1e-9)


@pytest.mark.parametrize("values", ["outlier", "clustered"])
def test_selection_orders_few_values_whatever_their_spread(spark, values):
    """200,000 values, one of them 1e12 or nearly all in one narrow place."""
    number = F.col("id").cast("double")
    one = F.when(F.col("id") == 7, 1e12).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**15)) / 1e9)
    dense = F.when(F.col("id") < 5, number * 1e6).otherwise(F.lit(0.5) + number / 1e9)
    rows = spark.range(200_000).select((one if values == "outlier" else dense).alias("_v"), F.lit(1).alias("_c"), F.lit(0).alias("g"))
    sized = rows.withColumns({"_n": F.lit(200_000), "_size": F.lit(200_000), "_first": F.lit(0)})
    per = 4000
    ranges = K.in_ranges(sized, ["g"], "_v", "_size", "part", per)
    assert ranges.groupBy("part").count().agg(F.max("count")).first()[0] < per
    left = K.narrowed(K.narrowed(sized, ["g"], [F.lit(50_000)], per, 0), ["g", "_range0"], [F.lit(50_000)], per, 1)
    assert left.count() < per
    want = rows.toPandas()["_v"].quantile([0.25, 0.9])
    got = K.exact_percentiles(rows, [], "_v", [0.25, 0.9], ["a", "b"], hot_rows=per).first()
    assert tuple(got) == pytest.approx(tuple(want))


def test_running_total_of_one_hot_day_with_hashed_ids(spark):
    rows = spark.range(60_000).select(
        F.lit(1).alias("k"), F.lit(DAY0).alias("d"), F.xxhash64("id").alias("id"), (F.col("id") % 100).cast("double").alias("v")
    )
    counted = rows.withColumn("n", F.lit(60_000))
    per = 2000
    assert K.in_ranges(counted, ["k", "d"], "id", "n", "part", per).groupBy("part").count().agg(F.max("count")).first()[0] < per
    got = K.running_total_before(rows, ["k"], "d", "id", "v", "s", per).toPandas().sort_values("id")
    assert (got["s"] == got["v"].cumsum() - got["v"]).all()


def test_exact_percentiles_weights_and_whole_table(spark, frame, claims):
    rows = [(1, 1.0, 3), (1, 9.0, 1), (1, None, 5), (2, 4.0, 2)]
    df = spark.createDataFrame(rows, "k bigint, v double, w bigint")
    for hot in (0, 100):
        got = {
            r["k"]: r["q"]
            for r in K.exact_percentiles(df, ["k"], "v", [0.75], ["q"], weight="w", hot_rows=hot).collect()
        }
        assert got == pytest.approx({1: float(np.quantile([1, 1, 1, 9], 0.75)), 2: 4.0})
    one = K.exact_percentiles(frame, [], "payer_share_amount", [0.05], ["q"]).first()["q"]
    assert one == pytest.approx(claims["payer_share_amount"].quantile(0.05))


def test_history_lists_have_one_shape(frame, claims):
    items = frame.select("claim_request_bundle_id", F.lit("E11").alias("principal_diagnosis_code"))
    team = frame.select(
        "claim_request_bundle_id",
        F.col("provider_license_key").alias("practitioner_license"),
        F.concat(F.lit("S"), F.col("provider_license_key") % 3).alias("practice_desc"),
    )
    got = H.history_lists(frame, items, team).toPandas()
    hot = got[got["patient_key"] == 1]
    visits = hot[hot["kind"] == "visit"]
    assert visits["multiplicity"].sum() == (claims["patient_key"] == 1).sum()
    assert sorted(c for c, n in zip(visits["cost"], visits["multiplicity"]) for _ in range(n)) == sorted(
        claims[claims["patient_key"] == 1]["payer_share_amount"]
    )
    assert sorted(hot[hot["kind"] == "specialty"]["value"]) == ["S0", "S1", "S2"]


def test_hot_keys_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(K, "HOT_KEYS", 1)
    rows = [(k, float(i)) for k in (1, 2, 3) for i in range(20 + k)]
    df = spark.createDataFrame(rows, "k bigint, v double")
    assert [r["k"] for r in K.hot_keys(df, ["k"], 10).collect()] == [3]
    got = {r["k"]: r["q"] for r in K.exact_percentiles(df, ["k"], "v", [0.5], ["q"], hot_rows=10).collect()}
    assert got == {1: 10.0, 2: 10.5, 3: 11.0}


@pytest.mark.parametrize("digits", [1, 4])
def test_hashed_rank(frame, claims, digits):
    got = K.hashed_rank(frame, "patient_key", "claim_request_bundle_id", "rk", digits).toPandas()
    md5 = {i: hashlib.md5(str(i).encode()).hexdigest() for i in claims["claim_request_bundle_id"]}
    for member, part in got.groupby("patient_key"):
        ids = sorted(part["claim_request_bundle_id"], key=md5.get)
        assert part.set_index("claim_request_bundle_id")["rk"].to_dict() == {c: i for i, c in enumerate(ids)}
        assert set(part["rk_total"]) == {len(part)}


def test_rolling_claims(frame, claims):
    got = W.rolling_claims(frame, ["patient_key"], 7).toPandas()
    for r in got.itertuples():
        inside = claims[
            (claims["patient_key"] == r.patient_key)
            & claims["max_serviced_date"].between(r.max_serviced_date - dt.timedelta(7), r.max_serviced_date)
        ]
        assert r.claim_velocity_7d == len(inside)


def test_rolling_unique_providers(frame, claims):
    got = W.rolling_unique_providers(frame, 30).toPandas()
    assert len(got) == len(claims[["patient_key", "max_serviced_date"]].drop_duplicates())
    for r in got.itertuples():
        inside = claims[
            (claims["patient_key"] == r.patient_key)
            & claims["max_serviced_date"].between(r.max_serviced_date - dt.timedelta(30), r.max_serviced_date)
        ]
        assert r.unique_providers_30d == inside["provider_license_key"].nunique()


def test_unique_providers_and_velocity(frame, claims):
    got = W.unique_providers(frame, 30).join(W.patient_velocity(frame), "patient_key").toPandas()
    for r in got.itertuples():
        own = claims[claims["patient_key"] == r.patient_key]
        age = (own["max_serviced_date"].max() - own["max_serviced_date"]).map(lambda d: d.days)
        assert r.unique_providers_30d == own[age <= 30]["provider_license_key"].nunique()
        assert r.claim_velocity_7d == (age <= 7).sum()


def test_trailing_seconds_count(spark):
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, 1 if rng.random() < 0.7 else 2, base + dt.timedelta(seconds=rng.randint(0, 20000))) for i in range(300)]
    rows += [(900, 1, rows[0][2]), (901, 1, rows[0][2])]
    df = spark.createDataFrame(rows, "id bigint, k bigint, ts timestamp")
    got = {r["id"]: r["claims_in_last_hour"] for r in W.trailing_seconds_count(df, "k", "ts", 3600).collect()}
    want = {
        i: sum(k2 == k and 0 <= (t - t2).total_seconds() <= 3600 for _, k2, t2 in rows) for i, k, t in rows
    }
    assert got == want


def test_duplicate_claims_marks_later_copies_only(spark):
    rows = [(1, "p", 10.0), (2, "p", 10.0), (3, "p", 10.0), (4, None, 10.0), (5, None, 10.0), (6, "q", 1.0)]
    df = spark.createDataFrame(rows, "id bigint, p string, a double")
    got = {r["id"]: r["is_duplicate_suspect"] for r in W.duplicate_claims(df, ["p", "a"], ["id"]).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0, 5: 1, 6: 0}


def test_claims_without_a_date_count_nothing(spark):
    rows = [(1, 1, DAY0), (2, 1, None), (3, 2, None), (4, None, DAY0)]
    df = spark.createDataFrame(rows, "id bigint, patient_key bigint, max_serviced_date date")
    rolled = {r["id"]: r["claim_velocity_7d"] for r in W.rolling_claims(df, ["patient_key"]).collect()}
    assert rolled == {1: 1, 2: 0, 3: 0, 4: 1}
    last = {r["patient_key"]: r["claim_velocity_7d"] for r in W.patient_velocity(df).collect()}
    assert last == {1: 1, 2: 0, None: 1}


def test_hot_null_key_is_split_too(spark):
    rows = [(None, float(i)) for i in range(50)] + [(1, 3.0)]
    df = spark.createDataFrame(rows, "k bigint, v double")
    got = {r["k"]: r["q"] for r in K.exact_percentiles(df, ["k"], "v", [0.5], ["q"], hot_rows=10).collect()}
    assert got == {None: 24.5, 1: 3.0}


def test_premium_increase(spark):
    rows = [(1, 2020, 100.0), (1, 2021, 110.0), (2, 2020, 0.0), (2, 2021, 5.0), (3, 2020, 7.0)]
    df = spark.createDataFrame(rows, "patient_key bigint, year int, premium double")
    got = {(r[0], r[1]): r["premium_increase_percentage"] for r in W.premium_increase(df).collect()}
    assert got == pytest.approx({(1, 2020): 0, (1, 2021): 0.1, (2, 2020): 0, (2, 2021): 0, (3, 2020): 0})


@pytest.mark.parametrize("grain", ["claim", "flattened"])
def test_history_statistics_in_both_grains(spark, frame, claims, grain):
    """Weights must equal really repeating each claim items x practitioners times."""
    items = frame.filter("claim_request_bundle_id % 3 > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("provider_license_key").cast("int")))).select("claim_request_bundle_id")
    team = frame.filter("claim_request_bundle_id % 5 > 0").withColumn("_n", F.explode(F.array(F.lit(1), F.lit(2)))).select("claim_request_bundle_id")
    weighted = H.weighted_claims(frame, items, team, grain)
    repeat = pd.Series(1, index=claims.index)
    if grain == "flattened":
        n_items = np.where(claims["claim_request_bundle_id"] % 3 > 0, claims["provider_license_key"], 1)
        n_team = np.where(claims["claim_request_bundle_id"] % 5 > 0, 2, 1)
        repeat = pd.Series(n_items * n_team, index=claims.index)
    flat = claims.loc[claims.index.repeat(repeat)]
    iqr = H.cost_iqr(weighted, hot_rows=50).toPandas().set_index("patient_key")["cost_volatility_iqr"]
    gaps = H.visit_gaps(weighted).toPandas().set_index("patient_key")["days_between_visits_std"]
    slope = H.cost_trend(weighted).toPandas().set_index("patient_key")["cost_trend_slope"]
    for member, own in flat.groupby("patient_key"):
        costs = own["payer_share_amount"].to_numpy()
        days = np.sort([(d - DAY0).days for d in own["max_serviced_date"]])
        assert iqr[member] == pytest.approx(np.subtract(*np.percentile(costs, [75, 25])))
        assert gaps[member] == pytest.approx(np.std(np.diff(days)))
        x = np.array([(d - DAY0).days for d in own["max_serviced_date"]])
        assert slope[member] == pytest.approx(np.polyfit(x, costs, 1)[0], abs=1e-6)


@pytest.mark.parametrize("parts", [1, 7])
def test_rolling_unique_providers_dealt_out(frame, parts):
    want = sorted(W.rolling_unique_providers(frame, 30).collect())
    # The same claim twice, and claims without a day or a provider, change nothing.
    odd = frame.unionByName(frame).unionByName(frame.withColumn("max_serviced_date", F.lit(None).cast("date")))
    odd = odd.unionByName(frame.withColumn("provider_license_key", F.lit(None).cast("bigint")))
    dealt = W.rolling_unique_providers(odd, 30, parts)
    assert sorted(dealt.collect()) == want
    assert dealt.rdd.getNumPartitions() == 2 * parts


def test_parts_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(K, "ROWS_PER_PART", 100)
    monkeypatch.setattr(K, "ROWS_PER_CORE", 10)
    assert [K.part_count(spark.range(n)) for n in (0, 5, 25, 400, 401, 4000)] == [1, 1, 2, 4, 5, 40]


SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_rolling_providers_query_has_parts_by_its_rows(spark, monkeypatch):
    """The session has 4 shuffle partitions; 6,000 lines in parts of 500 take 12, and 24 for starts and ends."""
    monkeypatch.setattr(K, "ROWS_PER_PART", 500)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    got = all_queries()["unique_providers_rolling"](spark, SF)
    assert got.rdd.getNumPartitions() == 2 * -(-lines // 500)


@pytest.fixture(scope="module")
def odd_history(spark, frame):
    """Items and care team with nulls, repeats, claims without an owner and claims without either."""
    ids = frame.select("claim_request_bundle_id", "provider_license_key").filter("claim_request_bundle_id % 9 > 0")
    ids = ids.unionByName(ids.filter("claim_request_bundle_id % 4 = 0")).unionByName(ids.withColumn("claim_request_bundle_id", F.lit(-1).cast("bigint")))
    code = F.when(F.col("provider_license_key") > 1, F.concat(F.lit("E"), F.col("claim_request_bundle_id") % 7))
    items = ids.select("claim_request_bundle_id", code.alias("principal_diagnosis_code"))
    name = F.when(F.col("provider_license_key") != 3, F.concat(F.lit("S"), F.col("provider_license_key") % 3))
    license_ = F.when(F.col("provider_license_key") != 2, F.col("provider_license_key")).alias("practitioner_license")
    return items, ids.select("claim_request_bundle_id", license_, name.alias("practice_desc"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_lists_move_a_value_to_its_claim_once(frame, odd_history):
    def plain(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    items, team = odd_history
    got = H.history_lists(frame, items, team, 7)
    assert plain(got) == plain(H.history_lists(frame, items, team))
    assert "hashpartitioning(claim_request_bundle_id" in plan_of(got)
    assert not re.search(r"hashpartitioning\(claim_request_bundle_id#\d+L, value", plan_of(got))
    want = {}
    owner = {r[0]: r[1] for r in frame.select("claim_request_bundle_id", "patient_key").collect()}
    for rows, kinds in ((items, ("diagnosis",)), (team, ("provider", "specialty"))):
        for r in rows.collect():
            for kind, value in zip(kinds, r[1:]):
                if r[0] in owner and value is not None:
                    key = (owner[r[0]], kind, str(value))
                    want[key] = want.get(key, 0) + 1
    lists = got.filter("kind != 'visit'").collect()
    assert {(r["patient_key"], r["kind"], r["value"]): r["multiplicity"] for r in lists} == want


@pytest.mark.parametrize("grain", ["claim", "flattened"])
def test_member_history_dealt_out(frame, odd_history, grain):
    items, team = odd_history
    got, want = (H.member_history(frame, items, team, grain, parts).toPandas().set_index("patient_key").sort_index() for parts in (7, None))
    pd.testing.assert_frame_equal(got, want)


@pytest.mark.parametrize("parts", [7, None])
def test_fanout_counts_items_and_team_in_one_grouping(frame, odd_history, parts):
    """A task of the flattened counts holds one table of claims, not one of items and one of team."""
    items, team = odd_history
    team = team.filter("practitioner_license is null or practitioner_license % 2 = 1")
    sizes = claim_fanout(frame, items, team, parts)
    n_items, n_team = (Counter(r[0] for r in rows.select("claim_request_bundle_id").collect()) for rows in (items, team))
    assert 0 in {n_items[r[0]] for r in frame.select("claim_request_bundle_id").collect()}
    got = sizes.select("claim_request_bundle_id", "n_items", "n_team", "fanout").collect()
    assert len(got) == frame.count()
    assert all(tuple(r[1:]) == (n_items[r[0]], n_team[r[0]], max(n_items[r[0]], 1) * max(n_team[r[0]], 1)) for r in got)
    plan = plan_of(sizes)
    assert len(re.findall(r"HashAggregate\(keys=\[claim_request_bundle_id", plan)) == 2 and plan.count("Join") == 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", ["abt_renewal_history", "abt_renewal", "member_history", "member_history_flattened"])
def test_history_queries_have_parts_by_their_rows(spark, monkeypatch, name):
    monkeypatch.setattr(K, "ROWS_PER_PART", 500)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    plan = plan_of(all_queries()[name](spark, SF))
    assert re.search(rf"hashpartitioning\(claim_request_bundle_id#\d+L, {-(-lines // 500)}\), REPARTITION_BY_NUM", plan)
