"""Streaming queries and their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decisions as D
from ..models import supervised
from ..operators import windows as W
from ..registry import query
from ..session import scratch_path
from ..sources import claims_model as M
from ..streaming import claims as S
from ..streaming import requests as R
from .common import r, stored

STAMP = "yyyy-MM-dd HH:mm:ss"
LATE = "1 hour"  # the streams' allowance for late events


def instants(spark, sf_dir):
    """The stored events with event time as an instant, as the stream has it."""
    return M.events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


def stamp(column):
    return F.date_format(F.col(column), STAMP).alias(column)


LAST_HOUR = """SELECT event_id, COUNT(*) OVER (PARTITION BY user_id ORDER BY CAST(FLOOR(EPOCH(ts)) AS BIGINT)
    RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS claims_in_last_hour FROM events"""


@query("claims_last_hour", LAST_HOUR)
def claims_last_hour(spark, sf_dir):
    """Each event with its member's events of the last hour."""
    counted = W.trailing_seconds_count(M.events(spark, sf_dir), "user_id", "ts", 3600)
    return counted.select("event_id", "claims_in_last_hour")


@query(
    "claims_last_hour_stream",
    """WITH w AS (SELECT user_id, time_bucket(INTERVAL 15 MINUTES, ts) - k * INTERVAL 15 MINUTES AS s FROM events,
    (SELECT UNNEST([0, 1, 2, 3]) AS k))
    SELECT user_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, COUNT(*) AS n_claims FROM w GROUP BY user_id, s""",
)
def claims_last_hour_stream(spark, sf_dir):
    """Sliding one-hour windows from the stream, with those that it still holds open."""
    closed = S.drained(S.claims_last_hour(S.event_stream(spark, sf_dir), "user_id"), "claims-last-hour")
    whole = S.claims_last_hour(instants(spark, sf_dir), "user_id")
    windows = S.with_open_windows(closed, whole, "window_start", "window_end", LATE)
    return windows.select("user_id", stamp("window_start"), "n_claims")


@query(
    "stream_drift",
    """WITH b AS (SELECT event_type, AVG(value) AS base FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY 1),
    d AS (SELECT event_type, date_trunc('day', ts) AS day, AVG(value) AS live FROM events GROUP BY 1, 2)
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, ROUND(live, 6) AS live_mean, ROUND(base, 6) AS base_mean,
    ROUND(ABS(live - base) / base, 6) AS relative_move, ABS(live - base) / base > 0.2 AS drifted
    FROM d JOIN b USING (event_type)""",
)
def stream_drift(spark, sf_dir):
    """Daily mean value per event type against the first week's mean."""
    base = (
        M.events(spark, sf_dir).filter(F.col("ts") < F.lit("2024-01-08 00:00:00").cast("timestamp"))
        .groupBy("event_type").agg(F.avg("value").alias("base_mean"))
    )
    closed = S.drained(S.stream_drift(S.event_stream(spark, sf_dir), base, "event_type", "value", 0.2), "stream-drift")
    whole = S.stream_drift(instants(spark, sf_dir), base, "event_type", "value", 0.2)
    daily = S.with_open_windows(closed, whole, "day", "day_end", LATE)
    return daily.select(
        "event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), r("live_mean", 6).alias("live_mean"),
        r("base_mean", 6).alias("base_mean"), r("relative_move", 6).alias("relative_move"), "drifted",
    )


@query(
    "stream_dedup",
    "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events",
)
def stream_dedup(spark, sf_dir):
    """One event per member, type and day."""
    days = S.event_stream(spark, sf_dir).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    with S.state_store(spark, S.ROCKSDB):
        kept = S.drain(S.stream_dedup(days, ["user_id", "event_type", "day"], "event_id"), "stream-dedup")
    return kept.select("user_id", "event_type", "day")


DECISIONS = (
    "event_id bigint, user_id bigint, champion_prediction string, champion_confidence double, final_decision string"
)


def decide_events(events):
    """Triage of a request by its value and the number in its JSON body."""
    k = F.from_json("props", "k bigint")["k"]
    label = F.when(k < 50, D.APPROVE).when(k < 80, D.DENY).otherwise(D.PEND)
    return events.withColumn("champion_prediction", label).withColumn(
        "champion_confidence", F.round(1 / (1 + F.col("value") / 100), 6)
    ).withColumn(
        "final_decision", D.triage_decision("champion_prediction", "champion_confidence", 0.8, 0.6)
    ).select("event_id", "user_id", "champion_prediction", "champion_confidence", "final_decision")


@query(
    "stream_triage",
    """WITH p AS (SELECT *, CAST(props::JSON->>'$.k' AS BIGINT) AS k, ROUND(1 / (1 + value / 100), 6) AS conf FROM events)
    SELECT event_id, user_id, CASE WHEN k < 50 THEN 'APPROVE' WHEN k < 80 THEN 'DENY' ELSE 'PEND' END
    AS champion_prediction, conf AS champion_confidence, CASE WHEN k < 50 AND conf >= 0.8 THEN 'AUTO_APPROVED'
    WHEN k >= 50 AND k < 80 AND conf >= 0.6 THEN 'AUTO_DENIED' ELSE 'PEND_FOR_REVIEW' END AS final_decision FROM p""",
)
def stream_triage(spark, sf_dir):
    """Every request decided in its micro-batch and appended to the log."""
    log = S.stream_triage(S.event_stream(spark, sf_dir), decide_events, "stream-triage", DECISIONS)
    return log.drop("batch_id")


@query("claims_last_hour_state", LAST_HOUR)
def claims_last_hour_state(spark, sf_dir):
    """Each event with its member's events of the last hour, from keyed state as the events arrive."""
    events = S.event_stream(spark, sf_dir).select("event_id", "user_id", "ts")
    with S.state_store(spark, S.ROCKSDB):
        counted = S.drain(R.trailing_counts(events, "user_id"), "claims-last-hour-state")
    return counted.select("event_id", "claims_in_last_hour")


REQUEST_FEATURES = ["value", "k", "claims_in_last_hour"]


def requests_of(events):
    """What a request brings along: its value and the number in its JSON body."""
    return events.select("event_id", "user_id", "ts", "value", F.from_json("props", "k bigint")["k"].alias("k"))


def fit_triage(spark, sf_dir):
    """Folder of a fitted triage forest.

    Past decisions are not in the tables: a rule stands in for them, which denies from the
    third request within an hour on.
    """
    counted = W.trailing_seconds_count(requests_of(instants(spark, sf_dir)), "user_id", "ts", 3600)
    past = F.when((F.col("k") < 50) & (F.col("claims_in_last_hour") < 3), D.APPROVE).when(
        F.col("k") < 80, D.DENY
    ).otherwise(D.PEND)
    train, _ = supervised.hash_split(counted.withColumn("decided", past), "user_id")
    train = stored(spark, train.select(*REQUEST_FEATURES, "decided"), "triage-training")
    path = scratch_path(spark, "triage-model")
    supervised.fit_multiclass(train, REQUEST_FEATURES, "decided").write().save(path)
    return path


@query("stream_triage_model")
def stream_triage_model(spark, sf_dir):
    """Every request scored by the stored forest on its state, decided and appended to the log."""
    decide = R.scorer(fit_triage(spark, sf_dir), 0.8, 0.6, ["event_id", "user_id", "claims_in_last_hour"])
    schema = DECISIONS.replace("user_id bigint,", "user_id bigint, claims_in_last_hour bigint,")
    with S.state_store(spark, S.ROCKSDB):
        requests = R.trailing_counts(requests_of(S.event_stream(spark, sf_dir)), "user_id")
        log = S.stream_triage(requests, decide, "stream-triage-model", schema)
    return log.drop("batch_id")


SESSIONS = """WITH g AS (SELECT user_id, ts, CASE WHEN LAG(ts) OVER w IS NULL OR ts - LAG(ts) OVER w >= INTERVAL 30
    MINUTES THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    n AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g),
    s AS (SELECT user_id, sid, MIN(ts) AS a, MAX(ts) + INTERVAL 30 MINUTES AS b, COUNT(*) AS n_events FROM n
    GROUP BY 1, 2) SELECT user_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS session_start,
    strftime(b, '%Y-%m-%d %H:%M:%S') AS session_end, n_events FROM s"""


@query("member_session", SESSIONS)
def member_session(spark, sf_dir):
    sessions = W.member_sessions(M.events(spark, sf_dir), "user_id", "ts")
    return sessions.select("user_id", stamp("session_start"), stamp("session_end"), "n_events")


@query("member_session_stream", SESSIONS)
def member_session_stream(spark, sf_dir):
    """Sessions from the stream, with those that it still holds open."""
    closed = S.drained(S.member_sessions(S.event_stream(spark, sf_dir), "user_id"), "member-sessions")
    whole = W.member_sessions(instants(spark, sf_dir), "user_id", "ts")
    sessions = S.with_open_windows(closed, whole, "session_start", "session_end", LATE)
    return sessions.select("user_id", stamp("session_start"), stamp("session_end"), "n_events")
