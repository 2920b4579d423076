"""Claim joins and aggregates on small tables with nulls, repeats and misses."""

import pytest
from pyspark.sql import functions as F

from adjudica.operators import association as A
from adjudica.operators import claims as C
from adjudica.operators import history as H
from adjudica.operators import providers as P
from adjudica.operators import semistructured as J

DEFINITIONS = {"Diabetes": ["E11"], "Hypertension": ["I10"], "Heart Disease": ["I21", "I25"]}


@pytest.fixture(scope="module")
def header(spark):
    rows = [(1, 10, 100.0, "2023-01-01"), (2, 10, 300.0, "2023-01-05"), (3, 20, 50.0, None), (4, 30, None, "2023-02-01")]
    schema = "claim_request_bundle_id bigint, patient_key bigint, payer_share_amount double, d string"
    return spark.createDataFrame(rows, schema).withColumn("max_serviced_date", F.to_date("d")).drop("d")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, 1, "E11.9", "P1"), (1, 2, "I10", "P2"), (2, 1, "E11.0", "P1"), (3, 1, "Z99", "P9"), (3, 2, None, None)]
    schema = "claim_request_bundle_id bigint, line_no int, principal_diagnosis_code string, procedure_code string"
    return spark.createDataFrame(rows, schema).withColumn("service_key", F.col("line_no")).withColumn(
        "provider_license_key", F.lit(1)
    )


@pytest.fixture(scope="module")
def team(spark):
    rows = [(1, "a", "Cardio"), (1, "b", "Cardio"), (3, "a", None)]
    return spark.createDataFrame(rows, "claim_request_bundle_id bigint, practitioner_license string, practice_desc string")


def test_condition_claims_and_flags(header, items):
    assert sorted(r[0] for r in C.condition_claims(header, items, ["E11"]).select(C.CLAIM).collect()) == [1, 2]
    flags = {r[C.MEMBER]: (r["is_diabetes"], r["is_hypertension"]) for r in C.member_condition_flags(header, items, DEFINITIONS).collect()}
    assert flags == {10: (1, 1), 20: (0, 0), 30: (0, 0)}


def test_chronic_weights(header, items):
    got = {r["condition"]: r["cost_weight"] for r in C.chronic_weights(header, items, DEFINITIONS).collect()}
    # Claims carry their member's total: 400, 400 and 50; the claim without a cost has none.
    assert got["Diabetes"] == pytest.approx(400 / ((400 + 400 + 50) / 3))
    assert got["Heart Disease"] == 1.0


def test_risk_follows_the_corpus(spark, header, items):
    members = spark.createDataFrame([(10,), (20,), (30,)], "patient_key bigint")
    flags = C.member_condition_flags(header, items, DEFINITIONS)

    def scores(claims):
        risk = C.learned_risk(DEFINITIONS, C.learned_weights(claims, items, members, DEFINITIONS))
        return {r[0]: r[1] for r in flags.select(C.MEMBER, risk.alias("risk")).collect()}

    # Diabetes and hypertension: 400 over (400 + 400 + 50) / 3; a dearer member 20 lowers both to the floor.
    assert scores(header) == pytest.approx({10: 2 * 1.41, 20: 0.0, 30: 0.0})
    dearer = header.withColumn(C.AMOUNT, F.when(F.col(C.MEMBER) == 20, 900.0).otherwise(F.col(C.AMOUNT)))
    assert scores(dearer) == pytest.approx({10: 2.0, 20: 0.0, 30: 0.0})


def test_claim_diagnosis_drops_unknown_codes(spark, header, items):
    dimension = spark.createDataFrame([("E11.9",), ("I10",), ("E11.0",)], "principal_diagnosis_code string")
    doubled = items.unionByName(items.filter("claim_request_bundle_id = 2"))
    got = {
        (r[C.CLAIM], r["diagnosis_code"], r["multiplicity"])
        for r in C.claim_diagnosis(header, doubled, dimension).collect()
    }
    assert got == {(1, "E11.9", 1), (1, "I10", 1), (2, "E11.0", 2), (3, None, 0), (4, None, 0)}


def test_new_members_with_and_without_snapshot(spark, header):
    policies = spark.createDataFrame([(10,), (20,), (99,)], "patient_key bigint")
    assert {r[0] for r in C.new_members(policies, header).collect()} == {99}
    assert {r[0] for r in C.new_members(policies, header, before="2023-01-01").collect()} == {10, 20, 99}


def test_new_members_query_reads_all_claims(spark, header, monkeypatch):
    from adjudica import plans
    from adjudica.sources import claims_model as M

    policies = spark.createDataFrame([(10, 30, "F", "A"), (30, 40, "M", "A"), (99, 50, "F", "B")], "patient_key bigint, age int, gender string, classname string")
    monkeypatch.setattr(M, "policy", lambda spark, sf_dir: policies)
    monkeypatch.setattr(M, "claim_header", lambda spark, sf_dir: header)
    # All claims of 10 and 30 lie after the snapshot day of new_member_anti.
    assert {r[0] for r in plans.all_queries()["new_members"](spark, "").collect()} == {99}


def test_flatten_multiplicities_equal_the_real_fanout(header, items, team):
    flat = header.join(items, C.CLAIM, "left").join(team, C.CLAIM, "left")
    for kind, column in (("diagnosis", "principal_diagnosis_code"), ("practitioner", "practitioner_license")):
        want = {(r[0], r[1]): r[2] for r in flat.groupBy(C.CLAIM, column).count().collect()}
        got = {
            (r[C.CLAIM], r["value"]): r["multiplicity"]
            for r in C.claims_flatten(header, items, team).filter(F.col("kind") == kind).collect()
        }
        assert got == want
    sizes = {r[C.CLAIM]: r["fanout"] for r in C.claim_fanout(header, items, team).collect()}
    assert sizes == {1: 4, 2: 1, 3: 2, 4: 1}


def test_member_history_grains(header, items, team):
    got = {r[C.MEMBER]: r for r in H.member_history(header, items, team, "flattened").collect()}
    assert got[10]["n_costs"] == 5 and got[10]["sum_costs"] == 700.0
    assert got[10]["n_diagnoses"] == 3 and got[10]["n_practitioners"] == 2 and got[10]["n_specialties"] == 1
    assert got[30]["n_costs"] == 0 and got[30]["sum_costs"] is None
    with pytest.raises(ValueError):
        H.weighted_claims(header, items, team, "other")


def test_visit_gaps_and_trend_edges(header, items, team):
    weighted = H.weighted_claims(header, items, team)
    gaps = {r[C.MEMBER]: r["days_between_visits_std"] for r in H.visit_gaps(weighted).collect()}
    assert gaps == {10: 0.0, 20: 0.0, 30: 0.0}
    slope = {r[C.MEMBER]: r["cost_trend_slope"] for r in H.cost_trend(weighted).collect()}
    assert slope == pytest.approx({10: 50.0, 20: 0.0, 30: 0.0})


def test_provider_features_nulls_and_weekend(spark):
    rows = [(1, 1, 6000.0, "2023-01-06"), (1, 2, None, None), (2, 3, 10.0, "2023-01-04"), (None, 4, 10.0, "2023-01-08")]
    lines = spark.createDataFrame(rows, "provider_license_key int, claim_request_bundle_id int, payer_share_amount double, d string").withColumn("max_serviced_date", F.to_date("d"))
    got = {r[0]: r for r in P.provider_fwa_features(lines).collect()}
    assert got[1]["avg_cost_per_claim"] == 6000.0 and got[1]["claim_count"] == 2
    assert got[1]["weekend_billing_ratio"] == 0.5 and got[1]["high_cost_claim_ratio"] == 0.5
    assert got[2]["std_cost_per_claim"] == 0.0 and got[2]["weekend_billing_ratio"] == 0.0
    assert got[None]["weekend_billing_ratio"] == 1.0


def test_member_provider_features(spark):
    stats = spark.createDataFrame([(1, 100.0, 20, "C", "City Hospital"), (2, 300.0, 60, None, None)], "provider_license_key int, avg_cost double, claim_count int, specialty string, provider_type string")
    peers = spark.createDataFrame([("C", 200.0)], "specialty string, avg_cost double")
    pairs = spark.createDataFrame([(10, 1), (10, 1), (10, 9), (11, 2)], "patient_key int, provider_license_key int")
    got = {r["patient_key"]: (r[1], r[2]) for r in H.member_provider_features(pairs, stats, peers).collect()}
    assert got[10] == pytest.approx(((150 + 200) / 2, 0.5))
    assert got[11] == pytest.approx((0.75 * 300 + 0.25 * 200, 0.0))


def test_peer_zscore_single_provider(spark):
    stats = spark.createDataFrame([(1, "A", 10.0), (2, "A", 20.0), (3, "B", 5.0)], "provider_license_key int, specialty string, avg_cost double")
    got = {r["provider_license_key"]: r["peer_zscore"] for r in P.peer_group_zscore(stats).collect()}
    assert got[3] == 0.0 and got[1] == pytest.approx(-0.70710678)


def test_stp_flags(spark, header, items):
    covered = spark.createDataFrame([(1,)], "service_key int")
    frame = header.withColumn("pre_auth_ref", F.when(F.col(C.CLAIM) == 1, "PA"))
    got = {r[C.CLAIM]: (r["has_pre_auth"], r["service_is_covered"], r["is_complex_diag"]) for r in C.stp_flags(frame, items, covered, ["I10"]).collect()}
    assert got == {1: (1, 0, 1), 2: (0, 1, 0), 3: (0, 0, 0), 4: (0, 1, 0)}


def test_pre_auth_contradictions(spark, header, items):
    linked = header.withColumn("pre_auth_ref", F.concat(F.lit("R"), F.col(C.CLAIM).cast("string")))
    asked = spark.createDataFrame([("R1", "P1", "approved"), ("R1", "P2", "approved"), ("R2", "P7", "rejected")], "pre_auth_ref string, procedure_code string, pre_auth_outcome string")
    got = [(r[C.CLAIM], r["procedure_code"]) for r in C.pre_auth_service_mismatch(items, linked, asked).collect()]
    assert got == [(2, "P1")]
    assert [r[C.CLAIM] for r in C.pre_auth_rejected_claimed(linked, asked).collect()] == [2]


def test_diag_proc_top_breaks_ties_by_code(spark):
    rows = [("D", p) for p in ["c", "b", "a", "a", "e", "f", "d"]] + [(None, "x"), ("D", None)]
    got = C.diag_proc_top(spark.createDataFrame(rows, "principal_diagnosis_code string, procedure_code string"), 3)
    assert [(r["procedure_code"], r["n"]) for r in got.orderBy("rnk").collect()] == [("a", 2), ("b", 1), ("c", 1)]


def test_user_json(spark):
    rows = [('{"name":"E","gender":"Male","birth_date":"1998-01-01","had_chronic_diseases":1}',), ("{broken",), (None,), ('{"name":"E","birth_date":"soon"}',), ('{"name":"E","had_chronic_diseases":"2"}',)]
    got = J.user_json_features(spark.createDataFrame(rows, "t string"), "t").collect()
    assert [r["age"] for r in got] == [27, None, None, 30, None]
    assert [r["had_chronic_diseases"] for r in got] == [1, 0, 0, 0, 2]
    assert [r["user_id"] for r in got] == ["E", None, None, "E", "E"]


def test_flatten_claim_items(spark):
    schema = "`ID` string, `Service Code (Service Items)` string, `Billed Net Amount (Service Items)` string, `Product Code (Medications)` string, `Net Amount (Medications)` string"
    rows = [("1", "S1", "10.5", "M1", None), ("2", None, None, "M2", "bad"), ("3", None, "1", None, "1")]
    got = [tuple(r) for r in J.flatten_claim_items(spark.createDataFrame(rows, schema)).collect()]
    assert got == [("1", "Service", "S1", None, 10.5), ("1", "Medication", "M1", None, 0.0), ("2", "Medication", "M2", None, None)]


def test_mined_pairs_equal_counting_claims(spark):
    lines = [
        (1, "D1", "P1"), (1, "D1", "P1"), (1, "D2", "P2"), (2, "D1", "P1"), (2, "D1", "P2"), (3, "D2", "P2"),
        (4, "D1", None), (5, None, "P1"), (6, "D3", "P1"), (6, "D3", "P3"), (7, "D2", "P1"),
    ]
    claims = {}
    for claim, given, then in lines:
        if given and then:
            claims.setdefault(claim, set()).add((given, then))
    pairs = {pair for held in claims.values() for pair in held}
    expected = {}
    for given, then in pairs:
        n = sum((given, then) in held for held in claims.values())
        with_given = sum(any(g == given for g, _ in held) for held in claims.values())
        with_then = sum(any(t == then for _, t in held) for held in claims.values())
        expected[given, then] = (n, n / with_given, n / with_given * len(claims) / with_then)
    table = spark.createDataFrame(lines, "claim int, g string, t string")
    every = A.mine_pairs(table, "claim", "g", "t", min_support=1, min_lift=0.0).collect()
    assert {(r["g"], r["t"]): (r["n_claims"], r["confidence"], r["lift"]) for r in every} == expected
    some = A.mine_pairs(table, "claim", "g", "t", min_support=2, min_confidence=0.6, min_lift=1.2).collect()
    kept = {pair for pair, (n, share, lift) in expected.items() if n >= 2 and share >= 0.6 and lift >= 1.2}
    assert {(r["g"], r["t"]) for r in some} == kept and kept
    assert A.mine_pairs(table.filter("claim > 99"), "claim", "g", "t").count() == 0
