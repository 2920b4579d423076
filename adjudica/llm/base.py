"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, with its lineage cut.

    The folder is ``spark.checkpoint.dir``. Where a local session (a test) names none, a
    temporary folder is set. ``spark.cleaner.referenceTracking.cleanCheckpoints`` makes
    Spark remove the files once nothing refers to them.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="adjudica-llm-"))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one for local sessions without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="adjudica-llm-")


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns under fixed names, whatever else the table holds."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def one_thread() -> None:
    """Libraries with threads of their own stay on the task's core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Memo(dict):
    """What a task knows about units of text, in two generations of ``limit`` entries each.

    ``missing`` makes room, brings units back from the older generation and returns those
    that have to be computed; afterwards the caller stores these.
    """

    def __init__(self, limit: int = 250_000):
        super().__init__()
        self.limit, self.old = limit, {}

    def missing(self, units: set[str]) -> list[str]:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        out = []
        for unit in units:
            if unit not in self:
                if (known := self.old.get(unit)) is None:
                    out.append(unit)
                else:
                    self[unit] = known
        return out


# Bijective 64-bit mixing with the published constants of the splitmix64 finaliser (fixed values).
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


def spread(
    rows: DataFrame,
    summary: DataFrame,
    key: str,
    weight: str,
    total: int,
    by: str,
    how: str = "inner",
    hot_share: int = 1000,
    hot_least: int = 1,
) -> DataFrame:
    """``rows`` joined to one ``summary`` row per ``key``, without a task that gets a whole hot key.

    Keys whose ``weight`` is at least ``total / hot_share`` go by broadcast: there are at
    most ``hot_share`` of them, whatever the size of the table. All others shuffle; rows
    already served and rows without a key are dealt out by column ``by``. With
    ``how="left"`` rows of other keys, null keys too, stay and get nulls. ``summary`` should
    be settled, since it is read twice; ``rows`` is read once. A key of less weight than
    ``hot_least`` is never hot, so a table below that weight takes the plain join.
    """
    floor = max(total // hot_share, hot_least)
    named = [c for c in summary.columns if c != key]
    if total < floor:
        plain = summary.select(F.col(key).alias("_key"), *named)
        return rows.join(plain, F.col(key) == F.col("_key"), how).select(*rows.columns, *named)
    small = summary.filter(F.col(weight) < floor).select(F.col(key).alias("_key"), F.struct(*named).alias("_small"))
    hot = summary.filter(F.col(weight) >= floor).select(F.col(key).alias("_hot_key"), F.struct(*named).alias("_hot"))
    tried = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    open_key = F.col("_hot_key").isNull() & F.col(key).isNotNull()
    salt = F.when(open_key, F.lit(0)).otherwise(F.xxhash64(by).bitwiseOR(F.lit(1)))
    joined = tried.join(small.withColumn("_salt", F.lit(0).cast("long")), (F.col(key) == F.col("_key")) & (salt == F.col("_salt")), "left")
    found = F.coalesce("_hot", "_small")
    out = joined.select(*rows.columns, *(found[c].alias(c) for c in named))
    return out.filter(F.coalesce("_hot_key", "_key").isNotNull()) if how == "inner" else out
