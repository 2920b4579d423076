"""The public feature functions on array tables."""

import datetime as dt

import pytest

from adjudica.functions import features as A

ARTIFACTS = {
    "chronic_condition_cost_weights": {"Diabetes": 1.8, "Hypertension": 1.2},
    "chronic_condition_freq_weights": {"Diabetes": 1.2, "Hypertension": 1.0},
    "chronic_conditions_definitions": {"Diabetes": ["E11"], "Hypertension": ["I10"]},
    "denial_codes": {"medical_necessity": ["N-DC-045"]},
    "provider_stats": {"P1": {"avg_cost": 100.0, "claim_count": 20}, "P2": {"avg_cost": 300.0, "claim_count": 60}},
    "provider_to_specialty_map": {"P1": "C"},
    "specialty_avg_costs": {"C": 200.0},
    "provider_to_type_map": {"P1": "City HOSPITAL", "P3": "hospital"},
}


def test_onboarding(spark):
    df = spark.createDataFrame([(40, ["Diabetes"]), (None, [])], "age int, self_reported_conditions array<string>")
    got = [tuple(r) for r in A.create_onboarding_features(df, ARTIFACTS).select("self_reported_chronic_score", "age_x_chronic_score").collect()]
    assert got == [(1.5, 60.0), (0.0, None)]
    text = spark.createDataFrame([(40, "['Diabetes']"), (1, "none")], "age int, self_reported_conditions string")
    assert [r[0] for r in A.create_onboarding_features(text, ARTIFACTS).select("self_reported_chronic_score").collect()] == [1.5, 0.0]


def test_vice_champion(spark):
    d = [dt.date(2023, 1, 1), dt.date(2023, 1, 3)]
    rows = [(1, ["E11.9"], [10.0, 20.0], ["rejected", "approved"], d, ["A", "A"], ["Medication", "Imaging", "x", "x"], ["N-DC-045", "z"]), (2, None, None, None, None, None, None, None)]
    schema = "patient_key int, diagnosis_codes_list array<string>, claim_costs_list array<double>, pre_auth_outcomes_list array<string>, service_dates_list array<date>, practitioner_specialty_list array<string>, activity_type_list array<string>, adjudication_reason_list array<string>"
    first, second = A.create_renewal_vice_champion_features(spark.createDataFrame(rows, schema), ARTIFACTS).orderBy("patient_key").collect()
    assert tuple(first)[8:] == pytest.approx((1.5, 5.0, 0.5, 0.0, 5.0, 1, 0.25, 0.25, 1))
    assert set(tuple(second)[8:]) == {0}


def test_champion_with_dicts_and_tables(spark):
    rows = [(1, ["P1", "P1", "P9"]), (2, []), (3, None), (4, ["P3"])]
    df = spark.createDataFrame(rows, "patient_key int, providers_visited_list array<string>")
    got = {r["patient_key"]: (r["avg_provider_risk_score"], r["hospital_visit_ratio"]) for r in A.create_renewal_champion_features(df, None, ARTIFACTS).collect()}
    assert got[1] == pytest.approx(((150 + 150 + 200) / 3, 2 / 3))
    assert got[2] == got[3] == pytest.approx((200.0, 0.0))
    assert got[4] == pytest.approx((200.0, 1.0))
    stats = spark.createDataFrame([("P1", 100.0, 20, "C", "Hospital")], "provider_license_key string, avg_cost double, claim_count int, specialty string, provider_type string")
    table = A.create_renewal_champion_features(df, df, {"provider_stats": stats, "specialty_avg_costs": {"C": 200.0}})
    assert table.filter("patient_key = 1").first()["avg_provider_risk_score"] == pytest.approx((150 + 150 + 100) / 3)
    empty = A.create_renewal_champion_features(df, None, {})
    assert {r["avg_provider_risk_score"] for r in empty.collect()} == {0.0}


def test_financial(spark):
    artifacts = {"plan_limits": {"P001": 5000.0}, "provider_master": {"A": {"tier": 1}, "B": {}}}
    rows = [("P001", 1000.0, 500.0, "A", "h", ["h"]), ("X", 1000.0, None, "B", "h", []), (None, None, None, None, "h", None)]
    df = spark.createDataFrame(rows, "plan_id string, claim_amount double, ytd_spend double, provider_license_key string, claim_hash string, history_hashes array<string>")
    got = [tuple(r) for r in A.create_financial_approval_features(df, artifacts).select("plan_utilization_percent", "provider_network_tier", "is_duplicate_suspect").collect()]
    assert got == [(0.3, 1, 1), (0.1, 2, 0), (None, 2, 0)]
    limits = spark.createDataFrame([("P001", 10000.0)], "plan_id string, plan_limit double")
    master = spark.createDataFrame([("A", 3)], "provider_license_key string, tier int")
    table = A.create_financial_approval_features(df.drop("claim_hash"), {"plan_limits": limits, "provider_master": master})
    assert "is_duplicate_suspect" not in table.columns
    assert table.filter("plan_id = 'P001'").first()["plan_utilization_percent"] == 0.15


def test_fwa_and_medical(spark):
    df = spark.createDataFrame([(900.0,), (None,)], "payer_share_amount double")
    assert [tuple(r)[1:] for r in A.create_claim_fwa_features(df, {}).collect()] == [(1, 1), (0, 0)]
    day = dt.date(2023, 1, 8)
    df = spark.createDataFrame([(["a", "b", "a"], [day, dt.date(2023, 1, 1), dt.date(2022, 1, 1)], day)], "provider_history_list array<string>, service_dates_list array<date>, max_serviced_date date")
    assert tuple(A.create_patient_fwa_features(df).first())[3:] == (2, 2)
    artifacts = {"standard_of_care": {"E11": ["LAB"]}, "gender_restricted_procedures": {"C_SECTION": ["F"]}}
    rows = [("E11", "LAB", "M"), ("I10", "LAB", "M"), ("E11", "C_SECTION", "Male"), (None, "C_SECTION", "F")]
    df = spark.createDataFrame(rows, "diagnosis_code string, procedure_code string, gender string")
    assert [tuple(r)[3:] for r in A.create_medical_approval_features(df, artifacts).collect()] == [(1, 1), (0, 1), (0, 0), (1, 1)]
    assert [tuple(r)[3:] for r in A.create_medical_approval_features(df, {}).collect()] == [(0, 1), (0, 1), (0, 1), (1, 1)]
