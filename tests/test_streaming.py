"""Streams against their batch forms, on several files with late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adjudica.functions import decisions as D
from adjudica.models import supervised
from adjudica.operators import windows as W
from adjudica.streaming import claims as S
from adjudica.streaming import requests as R

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def at(minutes):
    return BASE + dt.timedelta(minutes=minutes)


def source(spark, tmp_path, batches):
    """A file stream that takes one file per micro-batch, in order."""
    for i, rows in enumerate(batches):
        path = tmp_path / f"in/part={i}"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(path))
    reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
    return reader.parquet(str(tmp_path / "in/*"))


@pytest.fixture(scope="module")
def rows():
    return [(i, at(7 * i), i % 3, "a" if i % 2 else "b", float(i)) for i in range(120)]


def test_windows_equal_batch_for_closed_windows(spark, tmp_path, rows):
    stream = source(spark, tmp_path, [rows])
    got = S.drain(S.claims_last_hour(stream, "user_id"), "t-windows")
    limit = at(7 * 119) - dt.timedelta(hours=1)
    batch = (
        spark.createDataFrame(rows, SCHEMA).groupBy("user_id", F.window("ts", "1 hour", "15 minutes").alias("w"))
        .agg(F.count(F.lit(1)).alias("n_claims")).filter(F.col("w.end") <= F.lit(limit))
        .select("user_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_claims")
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_late_rows_beyond_the_watermark_are_dropped(spark, tmp_path):
    on_time = [(1, at(0), 1, "a", 1.0), (2, at(600), 1, "a", 1.0)]
    later = [(3, at(700), 1, "a", 1.0)]
    late = [(4, at(5), 1, "a", 1.0), (5, at(900), 1, "a", 1.0)]
    # A batch drops what was already late when the batch before it began.
    got = S.drain(S.claims_last_hour(source(spark, tmp_path, [on_time, later, late]), "user_id"), "t-late")
    first = got.filter(F.col("window_start") == F.lit(at(0))).collect()
    assert [r["n_claims"] for r in first] == [1]


def test_dedup_keeps_one_row_per_signature(spark, tmp_path, rows):
    doubled = [(1000 + r[0], r[1], *r[2:]) for r in rows]
    stream = source(spark, tmp_path, [rows, doubled])
    got = S.drain(S.stream_dedup(stream, ["user_id", "event_type"], "event_id"), "t-dedup")
    pairs = [(r["user_id"], r["event_type"]) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) == 6


def test_sessions_equal_batch(spark, tmp_path):
    times = [0, 10, 39, 70, 71, 200, 500]
    rows = [(i, at(m), 1, "a", 1.0) for i, m in enumerate(times)]
    batch = W.member_sessions(spark.createDataFrame(rows, SCHEMA), "user_id", "ts")
    want = sorted(map(tuple, batch.collect()))
    assert [(w[3]) for w in want] == [3, 2, 1, 1]
    got = S.drain(S.member_sessions(source(spark, tmp_path, [rows]), "user_id"), "t-sessions")
    assert sorted(map(tuple, got.collect())) == want[:3]


def test_sessions_over_the_watermark_are_whole(spark, tmp_path):
    """The watermark stands at minute 100: a session held open keeps its events whose own gap ended before."""
    rows = [(i, at(m), u, "a", 1.0) for i, (m, u) in enumerate([(60, 1), (75, 1), (0, 2), (20, 2), (65, 2), (160, 3)])]
    done = S.drained(S.member_sessions(source(spark, tmp_path, [rows]), "user_id"), "t-over")
    whole = W.member_sessions(spark.createDataFrame(rows, SCHEMA), "user_id", "ts")
    got = S.with_open_windows(done, whole, "session_start", "session_end", "1 hour")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    assert (1, at(60), at(105), 2) in set(map(tuple, got.collect()))
    after = whole.filter(F.col("session_start") >= F.lit(at(10)))
    assert (2, at(20), at(50), 1) not in set(map(tuple, after.collect()))


def test_drift_marks_days(spark, tmp_path):
    rows = [(i, at(60 * i), 1, "a", 10.0 if i < 24 else 20.0) for i in range(80)]
    base = spark.createDataFrame([("a", 10.0)], "event_type string, base_mean double")
    stream = source(spark, tmp_path, [rows])
    got = S.drain(S.stream_drift(stream, base, "event_type", "value", 0.2), "t-drift").orderBy("day").collect()
    assert [r["drifted"] for r in got] == [False, True, True]


def test_triage_logs_every_event_once(spark, tmp_path, rows):
    def decide(batch):
        return batch.withColumn(
            "final_decision", D.triage_decision(F.lit("APPROVE"), F.col("value") / 120, 0.5, 0.5)
        )

    half = len(rows) // 2
    log = S.stream_triage(source(spark, tmp_path, [rows[:half], rows[half:]]), decide, "t-triage", f"{SCHEMA}, final_decision string")
    assert sorted(r["event_id"] for r in log.collect()) == list(range(120))
    assert log.select("batch_id").distinct().count() == 2
    assert log.filter("final_decision = 'AUTO_APPROVED'").count() == 60


def completed(spark, tmp_path, rows, seen, name):
    """The windows of a stream over ``seen``, completed from the batch form over ``rows``."""
    done = S.drained(S.claims_last_hour(source(spark, tmp_path, [seen]), "user_id"), name)
    whole = S.claims_last_hour(spark.createDataFrame(rows, SCHEMA), "user_id")
    got = S.with_open_windows(done, whole, "window_start", "window_end", "1 hour")
    return done, sorted(map(tuple, got.collect())), sorted(map(tuple, whole.collect()))


def test_open_windows_complete_the_closed_ones(spark, tmp_path, rows):
    done, got, want = completed(spark, tmp_path, rows, rows, "t-open")
    assert 0 < done.rows.count() < len(got) and got == want


@pytest.mark.parametrize("kept", [0, 60])
def test_windows_of_an_emptied_or_cut_stream_are_not_made_up_for(spark, tmp_path, rows, kept):
    seen = rows[:kept] or [(0, None, 1, "a", 1.0)]
    done, got, want = completed(spark, tmp_path, rows, seen, f"t-cut-{kept}")
    assert got != want and set(got) < set(want) | set(map(tuple, done.rows.collect()))
    assert (done.watermark is None) == (kept == 0)


def test_dedup_forgets_what_is_past(spark, tmp_path):
    """One signature per member and day over 30 days: the state holds the last days only."""
    batches = [[(100 * d + i, at(1440 * d + i), i, "a", 1.0) for i in range(20)] * 2 for d in range(30)]
    held = []
    with S.state_store(spark, S.ROCKSDB):
        for last in (3, 30):
            stream = source(spark, tmp_path / str(last), batches[:last]).withColumn("day", F.to_date("ts"))
            done = S.drained(S.stream_dedup(stream, ["user_id", "day"], "event_id", slices=4), f"t-forget-{last}")
            assert done.rows.count() == 20 * last
            held.append(done.state_rows)
    assert held[1] <= held[0] <= 2 * 20 * 3
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != S.ROCKSDB


@pytest.mark.parametrize("parts", [1, 3])
def test_table_of_part_files_is_read_whole(spark, tmp_path, parts):
    whole = spark.range(90).select(
        F.col("id").alias("event_id"), F.lit(BASE).cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"),
        F.lit("a").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"),
    )
    whole.repartition(parts).write.parquet(str(tmp_path / "events.parquet"))
    assert S.drain(S.event_stream(spark, str(tmp_path), files_per_batch=1), "t-parts").count() == 90


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    out, state, place = (str(tmp_path / n) for n in ("out", "state", "in"))
    for first in (0, 10):
        rows = [(i, at(i), 1, "a", 1.0) for i in range(first, first + 10)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(place)
        got = S.drain(spark.readStream.schema(SCHEMA).parquet(place), "t-restart", out, state)
    assert sorted(r["event_id"] for r in got.collect()) == list(range(20))


def counted_by_batch(spark, rows):
    return W.trailing_seconds_count(spark.createDataFrame(rows, SCHEMA), "user_id", "ts", 3600)


def test_counts_by_state_equal_batch_and_state_is_dropped(spark, tmp_path, rows):
    parts = [rows[i : i + 30] for i in range(0, 120, 30)]
    with S.state_store(spark, S.ROCKSDB):
        stream = R.trailing_counts(source(spark, tmp_path, parts), "user_id", bucket=7200)
        done = S.drained(stream, "t-counts")
    got = done.rows.select("event_id", "claims_in_last_hour")
    batch = counted_by_batch(spark, rows).select("event_id", "claims_in_last_hour")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    # 21 stretches were open in all; those before the watermark, an hour before the last event, are gone.
    assert 0 < done.state_rows <= 6


def test_counts_cross_the_end_of_a_bucket_and_repeat_within_a_second(spark, tmp_path):
    minutes = [59, 59, 60, 61, 118, 119, 120, 121, 180]
    rows = [(i, at(m), 1, "a", 1.0) for i, m in enumerate(minutes)] + [(99, at(60), None, "a", 1.0)]
    with S.state_store(spark, S.ROCKSDB):
        got = S.drain(R.trailing_counts(source(spark, tmp_path, [rows]), "user_id", bucket=3600), "t-edges")
    counts = {row["event_id"]: row["claims_in_last_hour"] for row in got.collect()}
    whole = {row["event_id"]: row["claims_in_last_hour"] for row in counted_by_batch(spark, rows).collect()}
    assert counts == whole
    assert counts[5] == 6 and counts[99] == 1  # an hour holds both of its ends


def test_counts_by_state_call_python_per_slice_not_per_key(spark, tmp_path):
    """Many keys, one of them null, over two micro-batches: the state has one value and one timer a slice and day."""
    rows = [(i, at(i % 500), 2**53 + i % 301 if i % 301 else None, "a", 1.0) for i in range(1500)]
    rows.sort(key=lambda row: row[1])
    with S.state_store(spark, S.ROCKSDB):
        stream = R.trailing_counts(source(spark, tmp_path, [rows[:700], rows[700:]]), "user_id", slices=4)
        done = S.drained(stream, "t-slices")
    columns = ["event_id", "user_id", "claims_in_last_hour"]
    assert {tuple(r) for r in done.rows.select(columns).collect()} == {
        tuple(r) for r in counted_by_batch(spark, rows).select(columns).collect()
    }
    assert 0 < done.state_rows <= 3 * (4 + 1)  # value and timer with its index, of four slices and the null


def test_a_bucket_shorter_than_the_counted_time_is_refused(spark, tmp_path, rows):
    with pytest.raises(ValueError):
        R.trailing_counts(source(spark, tmp_path, [rows]), "user_id", bucket=60)


def test_decisions_by_the_stored_model_equal_batch_after_stop_and_restart(spark, tmp_path, rows):
    decided = F.when(F.col("claims_in_last_hour") < 3, D.APPROVE).when(F.col("value") < 60, D.DENY).otherwise(D.PEND)
    known = counted_by_batch(spark, rows).withColumn("decided", decided)
    features, model = ["value", "claims_in_last_hour"], str(tmp_path / "model")
    supervised.fit_multiclass(known, features, "decided", trees=5).write().save(model)
    decide = R.scorer(model, 0.8, 0.6, ["event_id"])
    schema = "event_id bigint, champion_prediction string, champion_confidence double, final_decision string"
    out, state = str(tmp_path / "log"), str(tmp_path / "state")

    def run(batches):
        with S.state_store(spark, S.ROCKSDB):
            counted = R.trailing_counts(source(spark, tmp_path, batches), "user_id", bucket=7200)
            return S.stream_triage(counted, decide, "t-model", schema, out, state).drop("batch_id")

    assert run([rows[:50]]).count() == 50
    spark.createDataFrame(rows[50:], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in/part=1"))
    got = run([])
    batch = decide(counted_by_batch(spark, rows))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert {row["final_decision"] for row in batch.collect()} >= {"AUTO_APPROVED", "AUTO_DENIED"}
