"""Packing into the fewest windows: dominance reduction, then best fit on counts per length.

Pieces of equal length are interchangeable, so the whole corpus is an instance of at most
``size`` lengths with a count each. On these counts the reduction of Martello and Toth
fixes windows for good: a set of pieces that, part by part, is at least as long as whatever
else could share a window with the same longest piece costs no window. It shrinks the
instance until nothing more is provable; the rest goes by best fit, longest lengths first.
The plan says for each length how its pieces, numbered over the corpus, fall into windows;
its size follows the number of lengths and not that of documents.
"""

from __future__ import annotations

import uuid
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import id_and_text, shared_folder, text_slices
from .ranked import text_coder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task long, place long"


@dataclass(frozen=True)
class Filling:
    """``windows`` windows filled alike: ``(length, copies)`` in order of place."""

    parts: tuple[tuple[int, int], ...]
    windows: int


def _best_pair(lengths: np.ndarray, counts: np.ndarray, room: int) -> int:
    """The largest sum of two pieces that is at most ``room``; 0 if none."""
    lengths = lengths[lengths < room]
    if not len(lengths):
        return 0
    partner = np.searchsorted(lengths, room - lengths, "right") - 1
    # A length may be its own partner only if there are two of it.
    alone = (partner >= 0) & (partner == np.arange(len(lengths))) & (counts[lengths] < 2)
    partner[alone] -= 1
    sums = np.where(partner >= 0, lengths + lengths[partner], 0)
    return int(sums.max())


def _least(lengths: np.ndarray, counts: np.ndarray, n: int) -> list[int]:
    """The ``n`` shortest pieces, fewer if there are fewer."""
    out: list[int] = []
    for length in lengths[:n].tolist():
        out += [length] * min(int(counts[length]), n)
    return out[:n]


def _dominating(counts: np.ndarray, longest: int, size: int) -> tuple[int, ...] | None:
    """Pieces that may join one piece ``longest`` (already taken out of ``counts``) without loss.

    With k the number of further pieces that fit at most:
    * k = 0: it stays alone;
    * k = 1, or the longest partner fills the window: that partner is at least as long as
      all that could be there together;
    * k = 2: the longest partner a if no two fitting pieces are longer together; else a and
      the longest piece b beside it, if no two pieces longer than b fit.
    """
    room = size - longest
    lengths = np.flatnonzero(counts)
    fitting = lengths[: np.searchsorted(lengths, room, "right")]
    if not len(fitting):
        return ()
    partner = int(fitting[-1])
    least = _least(fitting, counts, 3)
    if partner == room or sum(least[:2]) > room or len(least) < 2:
        return (partner,)
    if len(least) == 3 and sum(least) <= room:
        return None
    if partner >= _best_pair(fitting, counts, room):
        return (partner,)
    counts[partner] -= 1
    second = fitting[: np.searchsorted(fitting, room - partner, "right")]
    second = second[counts[second] > 0]
    above = fitting[np.searchsorted(fitting, second[-1], "right") :] if len(second) else fitting
    above = above[counts[above] > 0]
    two = _least(above, counts, 2)
    counts[partner] += 1
    return (partner, int(second[-1])) if len(second) and (len(two) < 2 or sum(two) > room) else None


def reduce_by_dominance(counts: np.ndarray, size: int) -> list[Filling]:
    """Windows fixed for good; their pieces leave ``counts``. Goes on until nothing more is provable.

    What holds for one piece of a length holds for as many as there are such sets: taking
    pieces out only makes the conditions easier.
    """
    fixed: list[Filling] = []
    changed = True
    while changed:
        changed = False
        for longest in range(size, 0, -1):
            while counts[longest]:
                counts[longest] -= 1
                others = _dominating(counts, longest, size)
                counts[longest] += 1
                if others is None:
                    break
                needs: dict[int, int] = {}
                for length in (longest, *others):
                    needs[length] = needs.get(length, 0) + 1
                times = min(int(counts[length]) // n for length, n in needs.items())
                for length, n in needs.items():
                    counts[length] -= n * times
                fixed.append(Filling(tuple(needs.items()), times))
                changed = True
    return fixed


def best_fit(counts: np.ndarray, size: int) -> list[Filling]:
    """Best fit, longest first: a piece goes to the fullest window that takes it.

    Windows filled alike are handled together. Equal pieces that follow one another fill
    up a window before the next, since it has become the fullest.
    """
    groups: dict[int, list[Filling]] = {}
    rooms: list[int] = []

    def keep(parts: tuple[tuple[int, int], ...], windows: int, room: int) -> None:
        if windows:
            if not groups.setdefault(room, []):
                insort(rooms, room)
            groups[room].append(Filling(parts, windows))

    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                old = groups[room].pop()
                if not groups[room]:
                    rooms.pop(at)
            else:
                room, old = size, Filling((), -(-left // (size // length)))
            copies = room // length
            full = min(old.windows, left // copies)
            keep((*old.parts, (length, copies)), full, room - copies * length)
            left -= full * copies
            rest = old.windows - full
            if left < copies and left and rest:
                keep((*old.parts, (length, left)), 1, room - left * length)
                left, rest = 0, rest - 1
            if old.parts:
                keep(old.parts, rest, room)
    counts[:] = 0
    return [filling for room in rooms for filling in groups[room]]


def plan_windows(lengths: Mapping[int, int], size: int) -> list[Filling]:
    """Fillings for ``lengths`` (length: count) in windows of ``size``."""
    counts = np.zeros(size + 1, np.int64)
    for length, n in lengths.items():
        counts[length] = n
    return reduce_by_dominance(counts, size) + best_fit(counts, size)


@dataclass(frozen=True)
class Places:
    """The plan as sorted arrays: a search in ``keys`` (length and first number) finds a piece's slot."""

    shift: int
    keys: np.ndarray
    first: np.ndarray
    copies: np.ndarray
    window: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, plan: list[Filling], size: int) -> Places:
        taken: dict[int, int] = {}
        rows, window = [], 0
        for filling in plan:
            offset = 0
            for length, copies in filling.parts:
                rows.append((length, taken.get(length, 0), copies, window, offset))
                taken[length] = taken.get(length, 0) + copies * filling.windows
                offset += copies * length
            window += filling.windows
        shift = 62 - size.bit_length()
        columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
        return cls(shift, columns[0] << shift | columns[1], *columns[1:])

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and offset of the pieces with these numbers among those of their length."""
        slot = np.searchsorted(self.keys, length << self.shift | number, "right") - 1
        beyond = number - self.first[slot]
        return self.window[slot] + beyond // self.copies[slot], self.offset[slot] + beyond % self.copies[slot] * length


def _pieces(docs: DataFrame, tokenizer_path: str, pattern: str, size: int, end_id: int) -> DataFrame:
    """Documents encoded and cut; ``place`` numbers the pieces of a length within their task."""
    end = int(end_id).to_bytes(4, "little")
    names = [field.split()[0] for field in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_coder(tokenizer_path, pattern)
        task = TaskContext.get().partitionId()
        seen = [0] * (size + 1)
        for batch in text_slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = coder.encode(text or "") + end
                tokens = len(ids) // 4
                start, stop = 0, (tokens - 1) % size + 1
                for piece in range(-(-tokens // size)):
                    part = ids[4 * start : 4 * stop]
                    rows.append((doc, piece, start, stop - start, zlib.crc32(part), part, task, seen[stop - start]))
                    seen[stop - start] += 1
                    start, stop = stop, stop + size
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.mapInArrow(run, PIECES)


def pack_best_fit(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    size: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset``.

    Documents are encoded by the tokenizer file (``pattern`` is its split into pre-tokens)
    and get ``end_id``, so null and empty texts are one token and no row is lost. Only
    documents of more than ``size`` tokens are cut: whole windows, with what is left over as
    the first piece. Repeated rows are packed each for itself, null ids stay null, an empty
    table gives no rows, and other columns are not read.

    Pieces are written once to the shared folder. The driver gets one count per length, at
    most ``size`` of them, and makes the plan; tasks get the plan, whose size is bounded by
    the lengths as well. A piece's number among those of its length is its place within its
    task plus the counts of the tasks before, so nothing is sorted. ``ids`` are read only if
    they are asked for.
    """
    path = f"{shared_folder(docs.sparkSession)}/pieces-{uuid.uuid4().hex[:12]}"
    _pieces(id_and_text(docs, id_col, text_col), tokenizer_path, pattern, size, end_id).write.option("compression", "zstd").parquet(path)
    pieces = docs.sparkSession.read.schema(PIECES).parquet(path)
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {row["length"]: row["n"] for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places.of(plan_windows(counts, size), size)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_task.select(
        F.col("length").alias("_length"), F.col("task").alias("_task"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_shift")
    )

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        window, offset = places.find(length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": window, "offset": offset})

    numbered = pieces.join(shifts, (F.col("length") == F.col("_length")) & (F.col("task") == F.col("_task")))
    found = numbered.withColumn("_at", placed("length", F.col("place") + F.col("_shift")))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "_at.sequence_id", "_at.offset")
