"""Packing of tokenized documents into windows by the sum-of-squares rule.

Each task keeps the count of partially filled windows per fill level in one array. A
document goes to the level whose use leaves the smallest sum of squared counts, which
steers the counts to be even, so that any later length finds a level that it completes.

Windows that a task leaves open are packed on by the same rule, as if each were one
document of its fill, in as many tasks as their tokens need. Only what is open after that
is cut anew.
"""

from __future__ import annotations

import uuid
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .base import Memo, id_and_text, one_thread, shared_folder, text_slices, texts_of
from .ranked import WordCoder

Piece = tuple[int | None, int, int, bytes]  # doc_id, start, doc_tokens, packed ids

OUTPUT = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)
#: Tokens of open windows that one task packs on: 64 MB of ids.
SECOND_TOKENS = 16 << 20


#: Signs that ``str.split`` takes for white space and the tokenizer does not.
NOT_SPACE = "\x1c\x1d\x1e\x1f"


class WordEncoder:
    """Ids by a tokenizer that drops white space, so that parts between spaces are independent.

    Plain parts are encoded in bulk by ranks, all others by the tokenizer.
    """

    def __init__(self, path: str):
        one_thread()
        self.full = Tokenizer.from_file(path)
        self.bulk = WordCoder(self.full)
        self.memo = Memo()

    def learn(self, parts: set[str]) -> None:
        new = self.memo.missing(parts)
        plain = [part for part in new if self.bulk.plain(part)]
        self.memo.update(zip(plain, self.bulk.encode(plain)))
        other = [part for part in new if part not in self.memo]
        for at in range(0, len(other), 4096):
            some = other[at : at + 4096]
            found = self.full.encode_batch_fast(some, add_special_tokens=False)
            self.memo.update((part, array("I", e.ids).tobytes()) for part, e in zip(some, found))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [t.split(" ") if any(c in t for c in NOT_SPACE) else t.split() for t in texts]
        self.learn(set().union(*cut))
        get = self.memo.__getitem__
        return [b"".join(map(get, parts)) for parts in cut]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@dataclass
class Window:
    pieces: list[Piece] = field(default_factory=list)

    def filled(self) -> int:
        return sum(len(p[3]) for p in self.pieces) // 4


class SquaresPacker:
    """Windows of ``size`` tokens filled online.

    ``put`` takes a window that is partly filled (of one document, say) and gives full
    windows; with more than ``max_open`` it also gives the fullest open one.
    """

    def __init__(self, size: int, max_open: int | None = None):
        self.size, self.max_open = size, max_open
        self.counts = np.zeros(size + 1, np.int64)
        self.at_level: dict[int, deque[Window]] = {}
        self.opened = 0

    def level_for(self, length: int) -> int:
        """The level (0: a new window) where ``length`` more tokens give the least sum of squares.

        Moving a window from level h to h + length changes the sum by
        2 (counts[h + length] - counts[h] + 1); a new window or a full one lacks one term.
        """
        top = self.size - length
        change = 2 * (self.counts[length:] - self.counts[: top + 1] + 1)
        change[0] = 2 * self.counts[length] + 1 if top else 0
        if top:
            change[top] = 1 - 2 * self.counts[top]
        usable = np.flatnonzero(self.counts[: top + 1])
        if not len(usable):
            return 0
        best = usable[::-1][np.argmin(change[usable[::-1]])]  # of ties the fullest
        return int(best) if change[best] <= change[0] else 0

    def take(self, level: int) -> Window:
        self.counts[level] -= 1
        self.opened -= 1
        return self.at_level[level].popleft()

    def put(self, added: Window) -> Iterator[Window]:
        length = added.filled()
        level = self.level_for(length)
        window = self.take(level) if level else Window()
        window.pieces += added.pieces
        if level + length == self.size:
            yield window
            return
        self.counts[level + length] += 1
        self.at_level.setdefault(level + length, deque()).append(window)
        self.opened += 1
        if self.max_open is not None and self.opened > self.max_open:
            yield self.take(int(np.flatnonzero(self.counts)[-1]))

    def open_windows(self) -> Iterator[Window]:
        """What is open, the fullest first; nothing is open afterwards."""
        for level in np.flatnonzero(self.counts)[::-1].tolist():
            while self.counts[level]:
                yield self.take(level)


def cut_anew(windows: Iterator[Window], size: int) -> Iterator[Window]:
    """Windows laid end to end and cut into full ones; the rest is cut into powers of two, unpadded."""
    pieces = deque(p for w in windows for p in w.pieces)
    total = sum(len(p[3]) for p in pieces) // 4
    sizes = [size] * (total // size)
    sizes += [1 << b for b in reversed(range(size.bit_length())) if total % size >> b & 1]
    for room in sizes:
        window = Window()
        while room:
            doc, start, tokens, ids = pieces.popleft()
            take = min(room, len(ids) // 4)
            window.pieces.append((doc, start, tokens, ids[: 4 * take]))
            if 4 * take < len(ids):
                pieces.appendleft((doc, start + take, tokens, ids[4 * take :]))
            room -= take
        yield window


def pack_ids(rows: Iterator[tuple[int | None, bytes]], size: int, max_open: int) -> Iterator[Window]:
    """Windows from ``(doc_id, packed ids)``, open ones too; whole windows are cut off long documents first."""
    packer = SquaresPacker(size, max_open)
    for doc, ids in rows:
        tokens = len(ids) // 4
        whole = tokens // size * size
        for start in range(0, whole, size):
            yield Window([(doc, start, tokens, ids[4 * start : 4 * (start + size)])])
        if whole < tokens:
            yield from packer.put(Window([(doc, whole, tokens, ids[4 * whole :])]))
    yield from packer.open_windows()


def _rows_of(windows: Iterator[Window], number: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches of pieces; ``open`` tells those of windows that are not full."""
    out: list[tuple] = []
    held = 0
    for window in windows:
        offset, is_open = 0, window.filled() < size
        for doc, start, tokens, ids in window.pieces:
            length = len(ids) // 4
            out.append((doc, start, length, tokens, number, offset, ids, is_open))
            offset += length
        number += 1
        held += 4 * offset
        if held > 4 << 20:
            yield _batch(out)
            out, held = [], 0
    if out:
        yield _batch(out)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    size: int = 4096,
    end_id: int = 2,
    max_open: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    Every text gets ``end_id`` after its ids, so null and empty texts are one token and no
    row is lost; repeated rows are packed each for itself, null ids stay null, an empty
    table gives no rows, other columns are not read. A long text is cut into whole windows
    and a rest. Each partition packs its own rows, holding at most ``max_open`` open
    windows (beyond that the fullest leaves), and writes all pieces to the shared folder.
    The open windows of all partitions shuffle, about ``SECOND_TOKENS`` tokens to a task,
    and are packed on; what is open then is cut anew, so only lengths that are powers of two
    stay below ``size``. ``sequence_id`` is the number of the task and a counter.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_encoder(tokenizer_path)

        def rows() -> Iterator[tuple[int | None, bytes]]:
            for batch in text_slices(batches):
                for doc, ids in zip(batch.column(0).to_pylist(), coder.encode(texts_of(batch))):
                    yield doc, ids + end

        yield from _rows_of(pack_ids(rows(), size, max_open), TaskContext.get().partitionId() << 40, size)

    def pack_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows() -> Iterator[Window]:
            number, window = None, Window()
            for batch in batches:
                for name, *piece in zip(*(batch.column(k).to_pylist() for k in range(5))):
                    if name != number and window.pieces:
                        yield window
                        window = Window()
                    number = name
                    window.pieces.append(tuple(piece))
            if window.pieces:
                yield window

        packer = SquaresPacker(size)

        def packed() -> Iterator[Window]:
            for window in windows():
                yield from packer.put(window)
            yield from cut_anew(packer.open_windows(), size)

        # Numbers apart from those of the first pass.
        yield from _rows_of(packed(), 1 << 62 | TaskContext.get().partitionId() << 40, size)

    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/packed-{uuid.uuid4().hex[:12]}"
    schema = f"{OUTPUT}, open boolean"
    id_and_text(docs, id_col, text_col).mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    first = spark.read.schema(schema).parquet(path)
    names = [field.split()[0] for field in OUTPUT.split(", ")]
    left = first.filter("open")
    tokens = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    dealt = left.select("sequence_id", "doc_id", "start", "doc_tokens", "ids", "offset").repartition(
        max(-(-tokens // SECOND_TOKENS), 1), "sequence_id"
    )
    again = dealt.sortWithinPartitions("sequence_id", "offset").drop("offset").mapInArrow(pack_on, schema)
    return first.filter("not open").select(*names).unionByName(again.select(*names))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.binary(), pa.bool_()]
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids", "open"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
