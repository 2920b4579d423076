"""Byte-level BPE by ranks: encoding in two tiers, decoding, and the split into pre-tokens.

Tier one is a minimal perfect hash over the vocabulary: one probe tells whether a whole
pre-token is a token. Tier two merges the bytes of the others, with a heap of candidate
pairs over a linked list, so a long run costs n log n.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from xxhash import xxh3_64_intdigest

from .base import Memo, id_and_text, mixed, text_slices, texts_of

#: Odd constant that spreads displacements (fixed value).
_STEP = np.array(0x9E3779B97F4A7C15, np.uint64)
#: White space around a lone space: there a unit boundary would split a run of white space.
_SPLIT_RUN = re.compile(r"\s (?=\s|\Z)")


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """Minimal perfect hash of a fixed set of byte strings by hash and displace.

    Keys fall into about n/2 buckets; each bucket, largest first, gets the first
    displacement that sends all its keys to free slots of a table of exactly n slots.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.size, self.buckets = n, max(1, n // 2)
        hashes = np.fromiter(map(xxh3_64_intdigest, keys), np.uint64, n)
        order = np.argsort(hashes % np.uint64(self.buckets), kind="stable")
        groups = np.split(order, np.cumsum(np.bincount((hashes % np.uint64(self.buckets)).astype(np.int64), minlength=self.buckets))[:-1])
        self.shift = np.zeros(self.buckets, np.int64)
        self.slot_key = np.full(n, -1, np.int64)
        taken = np.zeros(n, bool)
        by_size = sorted((b for b in range(self.buckets) if len(groups[b])), key=lambda b: -len(groups[b]))
        for place, b in enumerate(by_size):
            if len(groups[b]) == 1:
                break
            mine, d = hashes[groups[b]], 0
            while True:
                d += 1
                slots = self._slots(mine, np.array(d, np.uint64))
                if not taken[slots].any() and len(set(slots.tolist())) == len(slots):
                    break
            taken[slots], self.shift[b], self.slot_key[slots] = True, d, groups[b]
        else:
            place = len(by_size)
        # Lone keys take the free slots directly, marked by a negative shift.
        for b, slot in zip(by_size[place:], np.flatnonzero(~taken).tolist()):
            self.shift[b], self.slot_key[slot] = -1 - slot, groups[b][0]

    def _slots(self, hashes: np.ndarray, shift) -> np.ndarray:
        return (mixed(hashes + shift * _STEP) % np.uint64(self.size)).astype(np.int64)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Index of the one key each word could equal; the caller compares the bytes."""
        hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
        shift = self.shift[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        slots = np.where(shift < 0, -1 - shift, self._slots(hashes, shift.astype(np.uint64)))
        return self.slot_key[slots]


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: the pair of lowest rank, leftmost first, is merged until none is left."""
    n = len(piece)
    after = list(range(1, n + 1))  # where the part that starts here ends
    before = list(range(-1, n))  # where the part ending here starts
    get = ranks.get
    heap = []
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i))
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        middle = after[i]
        if middle == 0 or middle >= n or get(piece[i : after[middle]]) != rank:
            continue  # one of the two parts has been merged meanwhile
        end = after[middle]
        after[i], after[middle] = end, 0
        if end < n:
            before[end] = i
            if (rank := get(piece[i : after[end]])) is not None:
                heappush(heap, (rank, i))
        if i and (rank := get(piece[before[i] : end])) is not None:
            heappush(heap, (rank, before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


def units_of(text: str) -> list[str] | None:
    """The text cut before its spaces, where no pre-token can cross; ``None`` if one could."""
    if _SPLIT_RUN.search(text):
        return None
    first, *rest = text.split(" ")
    return [first, *(" " + part for part in rest)]


class Encoder:
    """Ids of whole texts, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pieces = ranks, regex.compile(pattern).findall
        self.tokens = list(ranks)
        self.ids = list(ranks.values())
        self.hash = PerfectHash(self.tokens)
        self.by_id = {i: t for t, i in ranks.items()}
        self.memo = Memo()

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of pre-tokens."""
        raw = [p.encode() for p in pieces]
        out = []
        for word, at in zip(raw, self.hash.find(raw).tolist() if raw else ()):
            ids = (self.ids[at],) if self.tokens[at] == word else merge_bytes(word, self.ranks)
            out.append(b"".join([i.to_bytes(4, "little") for i in ids]))
        return out

    def learn(self, units: set[str]) -> None:
        """Fill the memo for units not in it."""
        new = self.memo.missing(units)
        cut = [self.pieces(u) for u in new]
        distinct = list(dict.fromkeys(p for pieces in cut for p in pieces))
        known = dict(zip(distinct, self.encode_pieces(distinct)))
        for unit, pieces in zip(new, cut):
            self.memo[unit] = known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [u if (u := units_of(t)) is not None else self.pieces(t) for t in texts]
        self.learn(set().union(*cut))
        get = self.memo.__getitem__
        return [b"".join(map(get, units)) for units in cut]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.by_id.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids`` per row; ``ids`` is packed as little-endian unsigned 32-bit integers.

    A null or empty text has no ids and a null id stays null. Repeated rows each give a
    row; an empty table gives none. Other columns are not read. Narrow: no shuffle; a task
    holds 4 MB of text, a row at least, and a memo of bounded size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(ranks_path, pattern)
        for batch in text_slices(batches):
            ids = code.encode(texts_of(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` with the ``decoded`` bytes; null or empty ids decode to nothing.

    Rows come out as they came in, repeated ones too and those with a null ``doc_id``; long
    rows are decoded whole, other columns are not read, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(ranks_path, pattern)
        for batch in text_slices(batches, "ids"):
            decoded = [code.decode(x or b"") for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"]
            )

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded binary"
    )
