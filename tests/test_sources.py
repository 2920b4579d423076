"""Table lookup, schema conforming, logs, artifacts and worklists."""

import pytest
from pyspark.sql import functions as F

from adjudica.session import scratch_path, scratch_root
from adjudica.sources import files as S
from adjudica.sources import tables as T


def test_prefix_fallback_and_missing_table(spark, tmp_path):
    (tmp_path / "F_Claims.csv").write_text("id,amount\n1,2.5\n")
    (tmp_path / "d_Claims.csv").write_text("id,amount\n7,1.5\n8,1.0\n")
    got = T.get_data(str(tmp_path), ["Claims"], spark)["Claims"]
    assert got.count() == 2 and dict(got.dtypes) == {"id": "int", "amount": "double"}
    typed = T.load_table(spark, str(tmp_path), "Claims", "id bigint, amount double")
    assert dict(typed.dtypes)["id"] == "bigint"
    with pytest.raises(FileNotFoundError):
        T.get_data(str(tmp_path), ["Nothing"], spark)


def test_conform_picks_keys_and_fills(spark):
    df = spark.createDataFrame([(5, 6, 2.0, None)], "Patient_KEY0 int, patient_key2 int, amount double, note string")
    fills = {"note": F.lit("-"), "premium": F.lit(1000.0)}
    got = S.conform(df, {"patient_key": ["Patient_KEY"]}, fills)
    assert got.columns == ["patient_key", "patient_key2", "amount", "note", "premium"]
    assert tuple(got.first()) == (5, 6, 2.0, "-", 1000.0)
    with pytest.raises(ValueError):
        S.conform(df, {"claim": ["claim_id"]}, {})


def test_log_keeps_malformed_lines_as_nulls(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"id": 1, "request_body": {"age": 30}}\nnot json\n')
    got = S.read_prediction_log(spark, str(tmp_path), "id int, request_body struct<age: int>").collect()
    assert sorted((r["id"] or 0, r["request_body"]["age"] if r["request_body"] else None) for r in got) == [(0, None), (1, 30)]


def test_artifact_and_worklist_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", 2.0)], "name string, weight double")
    S.save_artifact(df, str(tmp_path / "art"))
    back = S.load_artifact(spark, str(tmp_path / "art"), df.schema)
    assert {r["name"]: r["weight"] for r in back.collect()} == {"a": 1.5, "b": 2.0}
    S.write_worklist(df, str(tmp_path / "list"))
    assert S.read_worklist(spark, str(tmp_path / "list"), df.schema).count() == 2
    S.write_abt(df, str(tmp_path / "abt"), partition_by="name")
    assert S.read_abt(spark, str(tmp_path / "abt")).count() == 2


class FakeSession:
    """Only what the scratch lookup reads."""

    def __init__(self, folder):
        self.conf = {"spark.sql.warehouse.dir": "hdfs://shared/warehouse"} | ({"spark.checkpoint.dir": folder} if folder else {})


def test_scratch_follows_the_session_setting(spark):
    shared = FakeSession("hdfs://shared/scratch")
    assert scratch_root(shared) == "hdfs://shared/scratch"
    assert scratch_path(shared, "x").startswith("hdfs://shared/scratch/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")
    assert scratch_root(FakeSession(None)) == "hdfs://shared/warehouse/adjudica-stored"
    assert scratch_root(spark).startswith("file:")


def test_conform_keeps_unchosen_candidates_and_refuses_doubt(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, net_amount double, o_totalprice double")
    got = S.conform(df, {"amount": ["net_amount", "o_totalprice"]}, {})
    assert got.columns == ["amount", "id", "o_totalprice"]
    with pytest.raises(ValueError, match="could be any of"):
        S.conform(spark.createDataFrame([(1, 2)], "a_key int, b_key int"), {"key": ["key"]}, {})
