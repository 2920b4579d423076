"""Scoring of requests as they arrive: keyed state for the events of the last hour, and a stored model.

The state is kept per hash slice of the members and stretch of time (``bucket``), so that neither
a group nor its state grows with all the events of a member, no call is made per member, and an
event-time timer drops the state when the watermark has passed the stretch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import decisions as D
from ..models import supervised as S

DAY = 86_400
SLICES = 256


class TrailingCounts(StatefulProcessor):
    """Counts per key and second of one (slice of the keys, bucket); each row of its own bucket gets the count of its last seconds.

    The state is one Arrow table of key, second and count, so that it moves as one value and is
    counted in arrays: a call costs the same for a thousand keys as for one.
    """

    def __init__(self, columns: Sequence[str], seconds: int, bucket: int, out: str):
        self.columns, self.own_columns = [*columns, "_s", "_key", "_slice", "_bucket", "_own"], list(columns)
        self.seconds, self.bucket, self.out = seconds, bucket, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "counts binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        batch.columns = self.columns  # names that begin with an underscore do not come through
        names, when = pa.array(batch["_key"], pa.string()), batch["_s"].to_numpy(np.int64)
        n = np.ones(len(batch), np.int64)
        if self.seen.exists():
            old = pa.ipc.open_stream(self.seen.get()[0]).read_all()
            names = pa.concat_arrays([names, *old["key"].chunks])
            when = np.concatenate([when, old["at"].to_numpy()])
            n = np.concatenate([n, old["n"].to_numpy()])
        else:
            self.handle.registerTimer((int(key[1]) + 1) * self.bucket * 1000)
        coded = names.dictionary_encode("encode")
        who, at = coded.indices.to_numpy(), when - int(key[1] - 1) * self.bucket
        # Keys lie one after the other, further apart than a frame reaches.
        place = who * np.int64(2 * self.bucket + self.seconds + 1) + at + self.seconds
        order, first = np.unique(place, return_index=True)
        counts = np.zeros(len(order), np.int64)
        np.add.at(counts, np.searchsorted(order, place), n)
        kept = pa.table({"key": names.take(pa.array(first)), "at": when[first], "n": counts})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kept.schema) as out:
            out.write_table(kept)
        self.seen.update((sink.getvalue().to_pybytes(),))
        own = batch["_own"].to_numpy(bool)
        if own.any():
            mine, upto = place[: len(batch)][own], np.concatenate([[0], np.cumsum(counts)])
            found = upto[np.searchsorted(order, mine, "right")] - upto[np.searchsorted(order, mine - self.seconds, "left")]
            yield batch.loc[own, self.own_columns].assign(**{self.out: found})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


def trailing_counts(
    events: DataFrame, key: str, ts: str = "ts", seconds: int = 3600, bucket: int = DAY, late: str = "1 hour",
    out: str = "claims_in_last_hour", slices: int = SLICES,
) -> DataFrame:
    """Each event of a stream with the events of its key in its last ``seconds`` seconds, itself included.

    A row leaves in the micro-batch it came in and counts what has arrived by then; events
    that come in the order of their time get what the batch form gives them. Late events
    and events without a time are dropped. An event near the end of a bucket goes to the
    next one too, as history; ``bucket`` is at least ``seconds``. The state is kept per
    bucket and hash slice of the keys: calls into Python grow with ``slices``, not with the
    keys. Needs the RocksDB store (:func:`adjudica.streaming.claims.state_store`).
    """
    if bucket < seconds:
        raise ValueError("a bucket must hold the counted seconds")
    own = F.floor(F.col("_s") / bucket)
    near_end = F.col("_s") >= (own + 1) * bucket - seconds
    place = F.struct(own.alias("_bucket"), F.lit(True).alias("_own"))
    following = F.struct((own + 1).alias("_bucket"), F.lit(False).alias("_own"))
    placed = (
        events.withWatermark(ts, late)
        .filter(F.col(ts).isNotNull())
        .withColumn("_s", F.unix_seconds(ts))
        .withColumn("_key", F.col(key).cast("string"))
        # Rows without a key stay apart: pandas would turn whole numbers beside a null into doubles.
        .withColumn("_slice", F.when(F.col(key).isNull(), slices).otherwise(F.pmod(F.xxhash64(key), F.lit(slices))))
        .withColumn("_place", F.explode(F.when(near_end, F.array(place, following)).otherwise(F.array(place))))
        .select(*events.columns, "_s", "_key", "_slice", "_place.*")
    )
    schema = StructType([*(StructField(f.name, f.dataType) for f in events.schema), StructField(out, LongType())])
    return placed.groupBy("_slice", "_bucket").transformWithStateInPandas(
        TrailingCounts(events.columns, seconds, bucket, out), schema, "Append", "EventTime"
    )


def scorer(path: str, approve_at: float, deny_at: float, keep: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Decide rows by the fitted pipeline stored at ``path``; the same function serves streams and tables."""
    model = PipelineModel.load(path)

    def decide(rows: DataFrame) -> DataFrame:
        label, confidence = D.best_class("probabilities", S.classes_of(model))
        return (
            S.probabilities(model, rows)
            .withColumn("champion_prediction", label)
            .withColumn("champion_confidence", confidence)
            .withColumn("final_decision", D.triage_decision("champion_prediction", "champion_confidence", approve_at, deny_at))
            .select(*keep, "champion_prediction", "champion_confidence", "final_decision")
        )

    return decide
