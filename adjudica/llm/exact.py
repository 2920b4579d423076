"""Exact copies by two passes over Bloom filters.

The first pass fills two filters from the hashes: bits seen, and bits seen by more than
one row. The second pass asks the latter: a row whose bits are not all set there is
unique for certain and passes straight through; only the others shuffle and are grouped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import mixed, settled, spread

#: Characters whose presence does not matter (fixed values).
WHITE = " \t\n\x0b\x0c\r"
#: Filter size limit: 2**27 bits, 16 MiB. Beyond its capacity more rows shuffle; results stay exact.
MOST_BITS = 1 << 27
PROBES = 4
BLOCK = 8192  # 64-bit words per block of a filter, the unit in which tasks merge filters
BUILDERS = 256  # tasks that fill filters, so that so many blocks meet in a merge at most


def digest_of(text: Column) -> Column:
    """SHA-256 of the text without white space, 32 bytes."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), WHITE, ""), 256))


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and masks, one row per probe."""
    steps = np.arange(1, PROBES + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    at = mixed(hashes[None, :] + steps) & np.uint64(bits - 1)
    return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _all_set(words: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    at, mask = _probes(hashes, bits)
    return ((words[at] & mask) != 0).all(axis=0)


def _set(words: np.ndarray, hashes: np.ndarray, bits: int) -> None:
    at, mask = _probes(hashes, bits)
    np.bitwise_or.at(words, at.ravel(), mask.ravel())


def _pack(words: np.ndarray) -> bytes:
    return zlib.compress(words.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint64).copy()


def repeated_bits(hashes: DataFrame, rows: int) -> tuple[bytes, int]:
    """The filter of bits set by more than one row of ``hashes`` (one column, long), and its size in bits.

    Tasks fill their own pair of filters; pairs merge block by block (a bit seen by two
    tasks counts as repeated), so a hash that two rows share has all its bits set. What
    comes to the driver is one filter of at most ``MOST_BITS``.
    """
    bits = min(MOST_BITS, max(1 << 16, 1 << (16 * max(rows, 1) - 1).bit_length()))
    size = bits // 64
    block = min(BLOCK, size)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, twice = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        for batch in batches:
            found, times = np.unique(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), return_counts=True)
            again = (times > 1) | _all_set(seen, found, bits)
            _set(twice, found[again], bits)
            _set(seen, found, bits)
        for k in range(size // block):
            part = slice(k * block, (k + 1) * block)
            if seen[part].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([_pack(seen[part])]), pa.array([_pack(twice[part])])],
                    ["block", "seen", "twice"],
                )

    def merge(part: pa.Table) -> pa.Table:
        seen, twice = np.zeros(block, np.uint64), np.zeros(block, np.uint64)
        for s, t in zip(part.column("seen"), part.column("twice")):
            s = _unpack(s.as_py())
            twice |= _unpack(t.as_py()) | (seen & s)
            seen |= s
        return pa.table({"block": part.column("block").slice(0, 1), "twice": pa.array([_pack(twice)])})

    filled = hashes.coalesce(BUILDERS).mapInArrow(fill, "block int, seen binary, twice binary")
    merged = filled.groupBy("block").applyInArrow(merge, "block int, twice binary").collect()
    words = np.zeros(size, np.uint64)
    for row in merged:
        words[row.block * block : (row.block + 1) * block] = _unpack(bytes(row.twice))
    return words.tobytes(), bits


def _maybe(hashes: DataFrame, count: int) -> Column:
    """A column on ``digest`` that is false only where the digest occurs once."""
    words, bits = repeated_bits(hashes, count)
    shared = hashes.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        table = np.frombuffer(shared.value, np.uint64)
        return pd.Series(_all_set(table, hashes.to_numpy().view(np.uint64), bits))

    return maybe(F.xxhash64("digest"))


def _groups(candidates: DataFrame) -> DataFrame:
    """Size and best row per digest: most code points, then smallest id, null ids last."""
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc").isNull().alias("no_id"), F.col("doc").alias("doc")))
    return candidates.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))


def _stays() -> Column:
    return (F.col("chars") == -F.col("best.less")) & F.col("doc").eqNullSafe(F.col("best.doc"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per row of ``docs``.

    Texts are equal when they are after white space is deleted; of equal texts the one with
    the most code points, then the smallest id stays. Null counts as empty, and so do all
    empty texts equal each other. A null id loses against any other and stays only if no
    row of its group has an id. Rows that repeat id and text cannot be told apart and are
    all marked alike. Other columns are not read; an empty table gives no rows.

    Shuffled: 64 KB filter blocks, and of the rows that may be copies id, length and digest.
    The largest groups (at most a thousand) are joined by broadcast.
    """
    rows = settled(
        docs.select(
            F.col(id_col).cast("long").alias("doc"),
            F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("chars"),
            digest_of(F.col(text_col)).alias("digest"),
        )
    )
    count = rows.count()
    marked = settled(rows.withColumn("maybe", _maybe(rows.select(F.xxhash64("digest")), count)))
    alone = marked.filter(~F.col("maybe"))
    candidates = marked.filter("maybe")
    groups = settled(_groups(candidates))
    grouped = spread(candidates, groups, "digest", "group_size", count, by="doc")
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    return alone.select(
        F.col("doc").alias("doc_id"), F.col("doc").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha,
    ).unionByName(
        grouped.select(
            F.col("doc").alias("doc_id"), F.col("best.doc").alias("keep_id"), "group_size", _stays().alias("kept"), sha
        )
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Choice as in :func:`exact_duplicates`; of rows that repeat id and text one stays.
    Unique rows are never shuffled; of the others whole rows are, except in the largest
    groups.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).cast("long").alias("doc"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("chars"),
        digest_of(F.col(text_col)).alias("digest"),
    )
    facts = settled(rows.select("doc", "chars", "digest"))
    count = facts.count()
    maybe = _maybe(facts.select(F.xxhash64("digest")), count)
    marked = rows.withColumn("maybe", maybe)
    candidates = marked.filter("maybe")
    groups = settled(_groups(facts.filter(maybe)))
    stay = spread(candidates, groups, "digest", "group_size", count, by="doc").filter(_stays())
    one = stay.dropDuplicates(["digest"])
    return marked.filter(~F.col("maybe")).select("row.*").unionByName(one.select("row.*"))
