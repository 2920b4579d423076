"""Removal of repeated byte strings by a hash-compared suffix sort.

A window is a string of ``length`` bytes; a window that also starts earlier is removed.
Windows that can be equal are brought together by anchors: the anchor of a window is its
shorter string of least hash, so equal windows have equal anchors at equal places, and the
windows of one anchor are neighbours (a segment). Segments shuffle as hashes. Equal ones
are settled by their hashes alone. Where different segments share an anchor, their bytes
follow: the suffixes at the anchors, and the prefixes before them read backwards, are
sorted by a mergesort whose comparisons find the common extension of two suffixes by
binary search over prefix polynomial hashes. Two windows are equal if they extend far
enough to both sides. The order of the suffixes is verified on the bytes; a group in which
hashes collide is sorted by its bytes.

Anchors that very many documents share are found on a sample beforehand and go by window
instead of by segment, so that no group holds all of them. The sample only routes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import id_and_text, mixed, settled

CHUNK = 1 << 20  # window starts hashed at a time
HELD = 1_000_000  # segments a task holds before it deals them out
GROUP_BYTES = 4 << 20  # text, or segments, that meet in one group
SAMPLE, HOT_SHARE, HOT_LEAST, HOT_MOST = 64, 1000, 8, 65536

SEGMENT = np.dtype([("h", "<u8"), ("sig", "<u8"), ("uid", "<i8"), ("start", "<i8"), ("n", "u1"), ("off", "u1")])
MARK = np.dtype([("uid", "<i8"), ("start", "<i8"), ("n", "u1")])
REQUEST = np.dtype([("h", "<u8"), ("uid", "<i8"), ("start", "<i8"), ("n", "u1"), ("off", "u1")])


def pack(rows: np.ndarray) -> bytes:
    """Structured rows column by column, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(rows[f]).tobytes() for f in rows.dtype.names))


def unpack(blobs: list[bytes], kind: np.dtype) -> np.ndarray:
    parts, reader = [], zstandard.ZstdDecompressor()
    for blob in blobs:
        data = reader.decompress(blob)
        rows, at = np.empty(len(data) // kind.itemsize, kind), 0
        for name in kind.names:
            size = kind[name].itemsize * len(rows)
            rows[name] = np.frombuffer(data, kind[name], len(rows), at)
            at += size
        parts.append(rows)
    return np.concatenate(parts) if parts else np.empty(0, kind)


class Polynomial:
    """Prefix polynomial hashes modulo 2**64 over random byte values."""

    def __init__(self, seed: int):
        source = np.random.default_rng(seed)
        self.value = source.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(source.integers(1, 1 << 62)) * 8 + 3
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        step, back = self.base % (1 << 64), pow(self.base, -1, 1 << 64)
        powers = np.full(n + 1, step, np.uint64)
        inverse = np.full(n + 1, back, np.uint64)
        powers[0] = inverse[0] = 1
        self.powers, self.inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.powers):
            self._grow(max(len(data), 2 * len(self.powers)))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.powers[: len(data)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.inverse[start]


@lru_cache(maxsize=1)
def _polynomials() -> tuple[Polynomial, Polynomial]:
    return Polynomial(1), Polynomial(2)


def segments_of(data: np.ndarray, ends: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, text number, prefix hashes)`` of texts laid end to end; ``start`` counts in ``data``."""
    first, second = _polynomials()
    span = length - anchor + 1
    prefix = first.prefixes(data)
    empty = np.empty(0, SEGMENT), np.empty(0, np.int64), prefix
    if len(data) < length:
        return empty
    grams = mixed((prefix[anchor:] - prefix[:-anchor]) * first.inverse[: len(data) - anchor + 1])
    # The least hash per window, ties to the left: places ride in the low bits.
    low = np.uint64((1 << 30) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    rows = -(-len(keys) // span)
    blocks = np.full(rows * span, np.iinfo(np.uint64).max)
    blocks[: len(keys)] = keys
    blocks = blocks.reshape(rows, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - length + 1
    place = (np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows]) & low).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int32)
    starts = np.concatenate([[0], ends[:-1]])
    full = ends - starts >= length
    inside[starts[full]] += 1
    np.add.at(inside, ends[full] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside)[:windows] > 0)
    if not len(at):
        return empty
    text = np.searchsorted(ends, at, "right")
    new = np.concatenate([[True], (place[at][1:] != place[at][:-1]) | (text[1:] != text[:-1])])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(at)))
    out = np.empty(len(head), SEGMENT)
    out["start"], out["n"] = at[head], count
    out["off"] = place[at[head]] - at[head]
    out["h"] = grams[place[at[head]]]
    other = second.prefixes(data)
    out["sig"] = mixed(second.spans(other, at[head], at[head] + count - 1 + length))
    return out, text[head], prefix


def _chunks(uids: list[int], texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(data, ends, uids, offsets)``: texts, or parts of long ones that share ``length - 1`` bytes."""
    held, parts, size = [], [], 0
    for uid, text in zip(uids, texts):
        for offset in range(0, max(len(text) - length + 1, 0), CHUNK):
            part = text[offset : offset + CHUNK + length - 1]
            if size and size + len(part) > CHUNK:
                yield _joined(held, parts)
                held, parts, size = [], [], 0
            held.append((uid, offset))
            parts.append(part)
            size += len(part)
    if parts:
        yield _joined(held, parts)


def _joined(held: list[tuple[int, int]], parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    pairs = np.array(held, np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts]), pairs[:, 0], pairs[:, 1]


def _by_window(rows: np.ndarray, prefix: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """One row per window of the given segments, keyed by the window's own hash, and each row's segment."""
    first, second = _polynomials()
    owner = np.repeat(np.arange(len(rows)), rows["n"])
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(rows["n"], dtype=np.int64) - rows["n"], rows["n"])
    out = np.empty(len(owner), SEGMENT)
    at = rows["start"][owner] + inner
    out["start"], out["n"], out["off"] = at, 1, 0
    out["h"] = mixed(first.spans(prefix, at, at + length) + np.uint64(1))
    out["sig"] = mixed(second.spans(second.prefixes(data), at, at + length))
    return out, owner


def first_of_equal(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order (h, sig, uid, start) and which of them begin a run of equal h and sig."""
    rows = rows[np.lexsort((rows["start"], rows["uid"], rows["sig"], rows["h"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["h"][1:] != rows["h"][:-1]) | (rows["sig"][1:] != rows["sig"][:-1])
    return rows, new


def _marks(rows: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), MARK)
    for name in MARK.names:
        out[name] = rows[name]
    return out


def _dealt(rows: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(rows) else []
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(bucket[a]), rows[a:b]


def _blobs(found: Iterator[tuple[int, np.ndarray]], kind: str) -> Iterator[pa.RecordBatch]:
    pairs = [(bucket, kind, pack(rows)) for bucket, rows in found]
    for at in range(0, len(pairs), 1000):
        buckets, kinds, blobs = zip(*pairs[at : at + 1000])
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(kinds), pa.array(blobs, pa.binary())], ["bucket", "kind", "blob"])


BLOBS = "bucket long, kind string, blob binary"


# --- the suffix sort ---------------------------------------------------------------------


def _common(prefix: np.ndarray, poly: Polynomial, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Common extension of the suffixes at a and b, ``most`` at most, by binary search over hashes."""
    low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
    while True:
        middle = (low + high + 1) >> 1
        todo = low < high
        if not todo.any():
            return low
        same = (prefix[a + middle] - prefix[a]) * poly.powers[b] == (prefix[b + middle] - prefix[b]) * poly.powers[a]
        low = np.where(todo & same, middle, low)
        high = np.where(todo & ~same, middle - 1, high)


@dataclass
class Suffixes:
    """Suffixes ``start[i]`` of ``size[i]`` bytes in ``data``."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray

    def __post_init__(self):
        self.poly = _polynomials()[0]
        self.prefix = self.poly.prefixes(self.data)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return _common(self.prefix, self.poly, self.start[i], self.start[j], np.minimum(self.size[i], self.size[j]))

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i sorts before suffix j; equal ones by number."""
        return self._less(i, j, self.common(i, j))

    def _less(self, i: np.ndarray, j: np.ndarray, same: np.ndarray) -> np.ndarray:
        """:meth:`before` for suffixes with ``same`` bytes in common."""
        end_i, end_j = same == self.size[i], same == self.size[j]
        last = len(self.data) - 1
        left, right = self.data[np.minimum(self.start[i] + same, last)], self.data[np.minimum(self.start[j] + same, last)]
        return np.where(end_i & end_j, i < j, np.where(end_i | end_j, end_i, left < right))

    def sorted(self, group: np.ndarray) -> np.ndarray:
        """Suffix numbers, groups apart (``group`` ascending), each in suffix order: bottom-up mergesort.

        All merges of a level run at once: an element's place is its own rank plus its rank
        in the neighbour run, found by bisection.
        """
        order = np.arange(len(group))
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.empty(0, np.int64)
        sizes = np.diff(np.append(heads, len(group)))
        base, size = np.repeat(heads, sizes), np.repeat(sizes, sizes)
        rank = np.arange(len(group)) - base
        width = 1
        while len(sizes) and width < sizes.max():
            live = np.flatnonzero(size > width)
            own = rank[live] // width
            pair = own & ~1
            other = np.minimum((own ^ 1) * width, size[live])
            low, high = other.copy(), np.minimum((own ^ 1) * width + width, size[live])
            from_left = (own & 1) == 0
            me = order[live]
            while (todo := low < high).any():
                middle = (low + high) >> 1
                at = np.flatnonzero(todo)
                it = order[base[live[at]] + middle[at]]
                less = self.before(it, me[at])
                low[at] = np.where(less, middle[at] + 1, low[at])
                high[at] = np.where(less, high[at], middle[at])
            place = base[live] + pair * width + (rank[live] - own * width) + (low - other)
            merged = order.copy()
            merged[place] = me
            order = merged
            width *= 2
        return order

    def checked(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order and the bytes each suffix has in common with the one before it, verified byte by byte.

        If every neighbour follows its predecessor by the bytes themselves, the whole order is
        right, whatever the hashes said on the way. Groups in which it is not (hashes collided)
        are sorted by their bytes.
        """
        order = self.sorted(group)
        near = np.zeros(len(order), np.int64)
        near[1:] = self.common(order[:-1], order[1:])
        at = np.flatnonzero(group[1:] == group[:-1])
        i, j, same = order[at], order[at + 1], near[at + 1]
        right = self._less(i, j, same) & _equal_bytes(self.data, self.start[i], self.start[j], same)
        for number in np.unique(group[at[~right]]):
            low, high = np.searchsorted(group, [number, number + 1])
            strings = [self.data[a : a + n].tobytes() for a, n in zip(self.start[low:high], self.size[low:high])]
            found = sorted(range(high - low), key=strings.__getitem__)
            order[low:high] = low + np.array(found)
            near[low + 1 : high] = [len(commonprefix([strings[a], strings[b]])) for a, b in zip(found, found[1:])]
        return order, near


def _equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at a and b are equal, compared in blocks of a few megabytes."""
    out, ends, at = np.ones(len(a), bool), np.cumsum(size), 0
    while at < len(a):
        done = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        n = size[at:upto]
        owner = np.repeat(np.arange(at, upto), n)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        out[owner[data[a[owner] + step] != data[b[owner] + step]]] = False
        at = upto
    return out


def _classes(order: np.ndarray, group: np.ndarray, near: np.ndarray, least: int) -> np.ndarray:
    """Class numbers of suffixes whose first ``least`` bytes are equal."""
    cut = np.ones(len(order), bool)
    cut[1:] = (near[1:] < least) | (group[order[1:]] != group[order[:-1]])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(cut)
    return out


def repeated_windows(rows: np.ndarray, data: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """The windows (as marks) of the segments ``rows`` that an earlier one of the same anchor repeats.

    Segment i covers ``data[place[i] : place[i] + n - 1 + length]``.
    """
    order = np.lexsort((rows["start"], rows["uid"], rows["h"]))
    rows, place = rows[order], place[order]
    group = np.cumsum(np.concatenate([[0], rows["h"][1:] != rows["h"][:-1]])) if len(rows) else np.empty(0, np.int64)
    n, off = rows["n"].astype(np.int64), rows["off"].astype(np.int64)
    anchor = place + off
    right = Suffixes(data, anchor, n - 1 + length - off)
    left = Suffixes(np.ascontiguousarray(data[::-1]), len(data) - anchor, off)
    sides = [side.checked(group) for side in (right, left)]
    out = []
    for before in range(int(off.max(initial=-1)) + 1):
        has = np.flatnonzero((before <= off) & (before > off - n))
        if len(has) < 2:
            continue
        key = _classes(sides[0][0], group, sides[0][1], length - before)[has] * (len(rows) + 1)
        key += _classes(sides[1][0], group, sides[1][1], before)[has]
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        again = has[np.arange(len(has)) != first[which]]
        # A segment can repeat a window of its own document only at another start, so marks are per row.
        mark = np.empty(len(again), MARK)
        mark["uid"], mark["n"] = rows["uid"][again], 1
        mark["start"] = rows["start"][again] + off[again] - before
        out.append(mark)
    return np.concatenate(out) if out else np.empty(0, MARK)


# --- the jobs ----------------------------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``uid, doc_id, text`` with a unique uid in the order of doc_id."""
    source = id_and_text(docs, id_col, text_col)
    twice = source.groupBy("doc_id").count().filter((F.col("count") > 1) | F.col("doc_id").isNull())
    if twice.isEmpty():
        return source.select(F.col("doc_id").alias("uid"), "doc_id", "text")
    ordered = settled(source.sort(F.col("doc_id").asc_nulls_last(), "text"))
    return ordered.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield part.column(0).to_pylist(), [(t or "").encode() for t in part.column(1).to_pylist()]


def _hot_anchors(keyed: DataFrame, length: int, anchor: int) -> np.ndarray:
    """Anchors in at least a thousandth of the sampled documents, the most frequent ``HOT_MOST`` of them."""
    sample = keyed.select("uid", "text").filter(F.pmod(F.xxhash64("uid"), F.lit(SAMPLE)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uids, texts in _slices(batches):
            hashes = [np.array([0], np.uint64)] * len(uids)
            for data, ends, _, _ in _chunks(uids, texts, length):
                rows, text, _ = segments_of(data, ends, length, anchor)
                hashes.append(np.unique(np.stack([rows["h"], text.astype(np.uint64)], 1), axis=0)[:, 0])
            flat = np.concatenate(hashes).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat)], ["h"])

    counts = settled(sample.mapInArrow(run, "h long").groupBy("h").count())
    number = counts.filter("h = 0").first()
    least = max(HOT_LEAST, (number["count"] if number else 0) // HOT_SHARE)
    hot = counts.filter((F.col("count") >= least) & (F.col("h") != 0)).orderBy(F.col("count").desc(), "h").limit(HOT_MOST)
    return np.sort(np.array([r.h for r in hot.select("h").collect()], np.int64).view(np.uint64))


def remove_repeats(
    docs: DataFrame, length: int = 100, anchor: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` per row; ``kept`` are the remaining bytes.

    Removed is each byte covered by a ``length``-byte string that also starts earlier: in a
    document of smaller id, or earlier in the same one. Strings are judged on the input and
    never cross documents. Null and empty texts give empty bytes. Rows that repeat an id
    come in the order of their texts, rows with a null id after all others; an empty table
    gives no rows. Other columns are not read.

    Segments shuffle as 16 bytes of hashes and a packed place; texts shuffle compressed,
    once to look up bytes of segments that hashes leave open and once for the result.
    ``length`` is 255 at most.
    """
    keyed = _keyed(docs, id_col, text_col)
    n_bytes = keyed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(1, -(-n_bytes // GROUP_BYTES))
    hot = _hot_anchors(keyed, length, anchor)
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def text_group(uid: np.ndarray) -> np.ndarray:
        return (mixed(uid.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)

    def deal(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows, new = first_of_equal(rows)
        again = _marks(rows[~new])
        yield from _blobs(_dealt(again, text_group(again["uid"])), "mark")
        keep = rows[new]
        keep = keep[np.lexsort((keep["start"], keep["uid"]))]
        yield from _blobs(_dealt(keep, (keep["h"] % np.uint64(groups)).astype(np.int64)), "segment")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for uids, texts in _slices(batches):
            for data, ends, own, offset in _chunks(uids, texts, length):
                rows, text, prefix = segments_of(data, ends, length, anchor)
                often = np.isin(rows["h"], shared.value) if len(shared.value) else np.zeros(len(rows), bool)
                if often.any():
                    single, owner = _by_window(rows[often], prefix, data, length)
                    rows, text = np.concatenate([rows[~often], single]), np.concatenate([text[~often], text[often][owner]])
                base = np.concatenate([[0], ends[:-1]])
                rows["start"] += offset[text] - base[text]
                rows["uid"] = own[text]
                held.append(rows)
                size += len(rows)
                if size >= HELD:
                    yield from deal(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield from deal(np.concatenate(held))

    def settle(part: pa.Table) -> pa.Table:
        kinds, blobs = part.column("kind").to_pylist(), part.column("blob").to_pylist()
        rows, new = first_of_equal(unpack([b for k, b in zip(kinds, blobs) if k == "segment"], SEGMENT))
        again = _marks(rows[~new])
        rows = rows[new]
        same_next = np.zeros(len(rows), bool)
        same_next[:-1] = rows["h"][1:] == rows["h"][:-1]
        open_rows = rows[same_next | np.concatenate([[False], same_next[:-1]])] if len(rows) else rows
        asked = np.empty(len(open_rows), REQUEST)
        for name in REQUEST.names:
            asked[name] = open_rows[name]
        out = [*_blobs(_dealt(again, text_group(again["uid"])), "mark"), *_blobs(_dealt(asked, text_group(asked["uid"])), "request")]
        own = part.column("bucket")[0].as_py()
        passed = [pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), pa.array(["mark"]), pa.array([b], pa.binary())], ["bucket", "kind", "blob"]) for k, b in zip(kinds, blobs) if k == "mark"]
        return pa.Table.from_batches(out + passed, pa.schema([("bucket", pa.int64()), ("kind", pa.string()), ("blob", pa.binary())]))

    def packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            uid = batch.column(0).to_numpy()
            data = [squeeze.compress((t or "").encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(text_group(uid)), batch.column(0), batch.column(1), pa.array(data, pa.binary())], ["bucket", "uid", "doc_id", "data"])

    def fetch(texts: pa.Table, asks: pa.Table) -> pa.Table:
        rows = unpack(asks.column("blob").to_pylist(), REQUEST)
        rows = rows[np.argsort(rows["uid"], kind="stable")]
        reader = zstandard.ZstdDecompressor()
        found = dict(zip(texts.column("uid").to_pylist(), texts.column("data").to_pylist()))
        pieces, uid, text = [], None, b""
        for r in rows.tolist():
            if r[1] != uid:
                uid, text = r[1], reader.decompress(found[r[1]])
            pieces.append(text[r[2] : r[2] + r[3] - 1 + length])
        sizes = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(sizes)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        bucket = (mixed(rows["h"]) % np.uint64(groups)).astype(np.int64)
        squeeze, out = zstandard.ZstdCompressor(level=1), []
        for b, at in _dealt(np.arange(len(rows)), bucket):
            out.append((b, pack(rows[at]), squeeze.compress(b"".join(flat[ends[i] - sizes[i] : ends[i]].tobytes() for i in at))))
        buckets, blobs, data = zip(*out) if out else ((), (), ())
        return pa.table({"bucket": pa.array(buckets, pa.int64()), "blob": pa.array(blobs, pa.binary()), "data": pa.array(data, pa.binary())})

    def sort(part: pa.Table) -> pa.Table:
        reader = zstandard.ZstdDecompressor()
        rows = unpack(part.column("blob").to_pylist(), REQUEST)
        data = np.frombuffer(b"".join(reader.decompress(d) for d in part.column("data").to_pylist()), np.uint8)
        sizes = rows["n"].astype(np.int64) - 1 + length
        marks = repeated_windows(rows, data, np.cumsum(sizes) - sizes, length)
        out = list(_blobs(_dealt(marks, text_group(marks["uid"])), "mark"))
        return pa.Table.from_batches(out, pa.schema([("bucket", pa.int64()), ("kind", pa.string()), ("blob", pa.binary())]))

    def strip(texts: pa.Table, marked: pa.Table) -> pa.Table:
        marks = unpack(marked.column("blob").to_pylist(), MARK) if marked.num_rows else np.empty(0, MARK)
        marks = marks[np.argsort(marks["uid"], kind="stable")]
        reader, out = zstandard.ZstdDecompressor(), []
        for uid, doc_id, data in zip(*(texts.column(c).to_pylist() for c in ("uid", "doc_id", "data"))):
            text = np.frombuffer(reader.decompress(data), np.uint8)
            a, b = np.searchsorted(marks["uid"], [uid, uid + 1])
            edge = np.zeros(len(text) + 1, np.int32)
            np.add.at(edge, marks["start"][a:b], 1)
            np.add.at(edge, marks["start"][a:b] + marks["n"][a:b] - 1 + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
            out.append((doc_id, len(text), int(gone.sum()), spans, text[~gone].tobytes()))
        columns = zip(*out) if out else [()] * 5
        kinds = [pa.int64()] * 4 + [pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    segments = keyed.select("uid", "text").mapInArrow(cut, BLOBS)
    first = settled(segments.groupBy("bucket").applyInArrow(settle, BLOBS))
    texts = keyed.mapInArrow(packed_texts, "bucket long, uid long, doc_id long, data binary")
    asks = first.filter("kind = 'request'")
    fetched = texts.groupBy("bucket").cogroup(asks.groupBy("bucket")).applyInArrow(fetch, "bucket long, blob binary, data binary")
    second = fetched.groupBy("bucket").applyInArrow(sort, BLOBS)
    marks = first.filter("kind = 'mark'").unionByName(second)
    return texts.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInArrow(
        strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
