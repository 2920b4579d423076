"""Streaming operators over claim events, and the runners that drain a source once.

Events later than the watermark are dropped, which is Spark's rule. All operators use
append output: a row appears when it can no longer change.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import session_bounds
from ..session import scratch_path
from ..sources.tables import SCHEMAS, is_folder, path_exists

DEDUP_SLICES = 256
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_stream(spark: SparkSession, data_dir: str, table: str = "events", files_per_batch: int = 1000) -> DataFrame:
    """A stored table, one file or a folder of part files, read as a file stream; event time as an instant.

    A micro-batch takes ``files_per_batch`` files at most.
    """
    path = f"{data_dir.rstrip('/')}/{table}.parquet"
    reader = spark.readStream.schema(SCHEMAS[table]).option("maxFilesPerTrigger", files_per_batch)
    if is_folder(spark, path):
        stream = reader.parquet(path)
    else:  # file streams read folders only
        stream = reader.option("pathGlobFilter", f"{table}.parquet").parquet(data_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def claims_last_hour(events: DataFrame, key: str, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Events per key in sliding one-hour windows, every 15 minutes."""
    return (
        events.withWatermark(ts, late)
        .groupBy(key, F.window(ts, "1 hour", "15 minutes").alias("w"))
        .agg(F.count(F.lit(1)).alias("n_claims"))
        .select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_claims")
    )


def stream_drift(
    events: DataFrame, base: DataFrame, key: str, value: str, limit: float, ts: str = "ts", late: str = "1 hour"
) -> DataFrame:
    """Daily mean per key against a static table of base means."""
    daily = (
        events.withWatermark(ts, late)
        .groupBy(key, F.window(ts, "1 day").alias("w"))
        .agg(F.avg(value).alias("live_mean"))
        .select(key, F.col("w.start").alias("day"), F.col("w.end").alias("day_end"), "live_mean")
    )
    move = F.try_divide(F.abs(F.col("live_mean") - F.col("base_mean")), F.col("base_mean"))
    return (
        daily.join(base, key)
        .withColumn("relative_move", F.coalesce(move, F.lit(0.0)))
        .withColumn("drifted", F.col("relative_move") > limit)
    )


def stream_dedup(
    events: DataFrame, signature: Sequence[str], spread: str, ts: str = "ts", keep_for: str = "25 hours",
    slices: int = DEDUP_SLICES,
) -> DataFrame:
    """First event of each signature within the watermark.

    ``keep_for`` is how long a signature is remembered, and how late an event may be: for a
    signature that holds the day, a day and the lateness. Copies are first dropped within
    hash slices of the ``spread`` column, so a very frequent signature reaches the final
    step at most once per slice.
    """
    hashed = events.withWatermark(ts, keep_for).withColumn(
        "claim_hash", F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in signature]))
    )
    sliced = hashed.withColumn("_slice", F.pmod(F.xxhash64(spread), F.lit(slices)))
    thinned = sliced.dropDuplicatesWithinWatermark(["claim_hash", "_slice"]).drop("_slice")
    return thinned.dropDuplicatesWithinWatermark(["claim_hash"])


def member_sessions(events: DataFrame, key: str, ts: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Episodes of activity per key, closed once the watermark has passed their end."""
    return (
        events.withWatermark(ts, late)
        .groupBy(key, F.session_window(ts, gap).alias("w"))
        .agg(*session_bounds(ts, gap), F.count(F.lit(1)).alias("n_events"))
        .select(key, "session_start", "session_end", "n_events")
    )


@contextmanager
def state_store(spark: SparkSession, provider: str) -> Iterator[None]:
    """Streams started inside keep their state in this provider; the setting is put back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, provider)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


@dataclass(frozen=True)
class Drained:
    """What a drained stream has written, its last watermark (``None`` if it saw no event), and the rows of state it holds."""

    rows: DataFrame
    watermark: datetime | None
    state_rows: int


def drained(stream: DataFrame, name: str, out: str | None = None, state: str | None = None) -> Drained:
    """Run a stream over all data present.

    ``out`` and ``state`` are the output and checkpoint folders; a job that is started
    again with the same two goes on where it stopped. Without them a run has its own.
    """
    spark = stream.sparkSession
    out, state = out or scratch_path(spark, name), state or scratch_path(spark, f"{name}-state")
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    last = json.loads(query.lastProgress.json) if query.lastProgress else {}
    told = last.get("eventTime", {}).get("watermark")
    watermark = datetime.fromisoformat(told.replace("Z", "+00:00")) if told else None
    if watermark is not None and watermark.timestamp() <= 0:  # where a stream starts
        watermark = None
    held = sum(part.get("numRowsTotal", 0) for part in last.get("stateOperators", []))
    return Drained(spark.read.schema(stream.schema).parquet(out), watermark, held)


def drain(stream: DataFrame, name: str, out: str | None = None, state: str | None = None) -> DataFrame:
    """The rows that :func:`drained` has written."""
    return drained(stream, name, out, state).rows


def with_open_windows(done: Drained, whole: DataFrame, start: str, end: str, late: str) -> DataFrame:
    """The windows that a drained stream has closed, and those it still holds open.

    ``whole`` is the batch form over the stored events. Of it come only the windows that the
    stream must still hold: they end after its watermark and start no later than the last
    event it saw (the watermark and ``late``). What the stream had to close itself, or never
    saw, is not made up for.
    """
    if done.watermark is None:
        return done.rows
    mark = F.lit(done.watermark).cast("timestamp")
    # Watermarks are cut to milliseconds, events are not.
    last = mark + F.expr(f"INTERVAL {late}") + F.expr("INTERVAL 1 MILLISECOND")
    held = (F.col(end) > mark) & (F.col(start) < last)
    return done.rows.unionByName(whole.select(done.rows.columns).filter(held))


def stream_triage(
    events: DataFrame,
    decide: Callable[[DataFrame], DataFrame],
    name: str,
    schema: str,
    out: str | None = None,
    state: str | None = None,
) -> DataFrame:
    """Decide each micro-batch and append it to a decision log of the given ``schema``.

    A batch that is run again after a failure overwrites its own folder, so with fixed
    ``out`` and ``state`` folders every event is logged once.
    """
    spark = events.sparkSession
    out, state = out or scratch_path(spark, name), state or scratch_path(spark, f"{name}-state")

    def append(batch: DataFrame, batch_id: int) -> None:
        decide(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = (
        events.writeStream.foreachBatch(append)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not path_exists(spark, out):  # no batch ran
        return spark.createDataFrame([], f"{schema}, batch_id bigint")
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(out)
