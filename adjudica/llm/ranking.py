"""Ranked lexical search by the best position algorithm.

Documents lie in blocks. A block has an impact list per term of the queries: its documents
by falling share of the score. Lists are read from the top; each document met is scored in
full by direct access to its own row, which also tells its place in every other list. The
best position of a list is the end of its seen beginning, whether read or met by direct
access. A document not yet met stands behind the best position in each list, so its score
is at most the sum of the first impacts behind them. Once that is strictly below the k-th
score found, nothing is left to find, ties included.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import id_and_text, settled, text_slices

#: Signs that end a term become spaces, A-Z becomes a-z; all beyond ASCII is kept.
_KEEP = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
ITEM_BLOCK = 2000  # items searched at a time
POSTINGS = 2_000_000  # entries of the impact lists of a block
FIRST_READ = 32  # positions read from each list at first; doubled each time


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and signs beyond ASCII, with only A-Z lowered."""
    return (text or "").encode().translate(_KEEP).split()


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Query:
    """One item: its distinct terms by number and how often each occurs."""

    terms: np.ndarray
    times: np.ndarray


class Block:
    """Impact lists of some documents and, for direct access, the documents' own rows."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        """Row r holds entries ``starts[r]`` to ``starts[r + 1]`` of ``terms`` and ``impacts``."""
        self.starts, self.terms, self.impacts = starts, terms, impacts
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        order = np.lexsort((-impacts, terms))
        self.listed, self.falling = owner[order], impacts[order]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.list_start = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def best(self, query: Query, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """``(rows, scores)`` of all documents met whose score is above 0 and may be among the k best.

        ``floor`` is a score that k documents elsewhere are known to reach.
        """
        times = np.zeros(len(self.list_start) - 1, np.int64)
        times[query.terms] = query.times
        begin, end = self.list_start[query.terms], self.list_start[query.terms + 1]
        best = begin.copy()
        seen = np.zeros(len(self.terms), bool)
        met = np.zeros(len(self.starts) - 1, bool)
        rows, scores, kth, step = [], [], floor, FIRST_READ
        while True:
            inside = best < end
            rest = int((self.falling[best[inside]] * query.times[inside]).sum())
            if rest < kth or not rest:
                break
            read = np.concatenate([self.listed[a : min(a + step, b)] for a, b in zip(best[inside], end[inside])])
            new = np.unique(read[~met[read]])
            met[new] = True
            sizes = self.starts[new + 1] - self.starts[new]
            entries = np.repeat(self.starts[new] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            shares = self.impacts[entries] * times[self.terms[entries]]
            seen[self.place[entries]] = True
            rows.append(new)
            scores.append(np.add.reduceat(shares, np.cumsum(sizes) - sizes) if len(new) else np.empty(0, np.int64))
            every = np.concatenate(scores)
            if len(every) >= k:
                kth = max(kth, int(np.partition(every, len(every) - k)[len(every) - k]))
            for at in np.flatnonzero(inside).tolist():
                a, b = int(best[at]), int(end[at])
                while a < b:
                    ahead = seen[a : min(a + 2 * step, b)]
                    gap = int(ahead.argmin())
                    if not ahead[gap]:
                        a += gap
                        break
                    a += len(ahead)
                best[at] = a
            step *= 2
        if not rows:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        found, score = np.concatenate(rows), np.concatenate(scores)
        stay = (score >= kth) & (score > 0)
        return found[stay], score[stay]


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, counts``: a document's number of terms, and those of the queries with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sizes, terms, counts = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                found = Counter(map(vocabulary.get, words))
                found.pop(None, None)
                sizes.append(len(words))
                terms.append(np.fromiter(found.keys(), "<i4", len(found)).tobytes())
                counts.append(np.fromiter(found.values(), "<i4", len(found)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                ["doc_id", "n", "terms", "counts"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, terms binary, counts binary")


def _document_counts(postings: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "df"])

    rows = postings.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(n_terms, np.int64)
    for row in rows:
        out[row["term"]] = row["df"]
    return out


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """``(doc ids, sizes, row starts, terms, counts)``, about ``limit`` entries at a time, one document at least."""
    held: list[tuple] = []
    entries = 0
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if row[2]:
                held.append(row)
                entries += len(row[2]) // 4
            if entries >= limit:
                yield _block(held)
                held, entries = [], 0
    if held:
        yield _block(held)


def _block(held: list[tuple]) -> tuple[list, list[int], np.ndarray, np.ndarray, np.ndarray]:
    ids, sizes, terms, counts = zip(*held)
    starts = np.concatenate([[0], np.cumsum([len(t) // 4 for t in terms])]).astype(np.int64)
    return list(ids), list(sizes), starts, np.frombuffer(b"".join(terms), "<i4").astype(np.int64), np.frombuffer(b"".join(counts), "<i4").astype(np.int64)


def _ranked(docs: DataFrame, items: dict[int | None, Counter], k: int, limit: int) -> DataFrame:
    """``item_id, doc_id, score``: candidates of a block of items, the k best of each among them."""
    vocabulary = {term: at for at, term in enumerate(sorted({t for found in items.values() for t in found}))}
    postings = settled(_postings(docs, vocabulary))
    row = postings.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    documents, length = row["documents"], max(row["length"], 1)
    df = _document_counts(postings, len(vocabulary))
    weights = np.array([term_weight(documents, int(n)) for n in df], np.int64)
    names = list(items)
    queries = [
        Query(np.array([vocabulary[t] for t in found], np.int64), np.array(list(found.values()), np.int64)) for found in items.values()
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, object), np.empty(0, np.int64))] * len(queries)
        for ids, sizes, starts, terms, counts in _blocks(batches, limit):
            spread = np.array([25 + 75 * n * documents // length for n in sizes], np.int64)
            impacts = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * np.repeat(spread, np.diff(starts))))
            block, own = Block(starts, terms, impacts, len(vocabulary)), np.array(ids, object)
            for at, query in enumerate(queries):
                old_ids, old = best[at]
                rows, scores = block.best(query, k, int(old[-1]) if len(old) == k else 0)
                if len(rows):
                    all_ids, all_scores = np.concatenate([old_ids, own[rows]]), np.concatenate([old, scores])
                    order = sorted(range(len(all_ids)), key=lambda i: (-all_scores[i], all_ids[i] is None, all_ids[i] or 0))[:k]
                    best[at] = all_ids[order], all_scores[order]
        found = [(name, doc, int(score)) for name, (docs_, scores) in zip(names, best) for doc, score in zip(docs_, scores)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["item_id", "doc_id", "score"])

    return postings.mapInArrow(run, "item_id long, doc_id long, score long")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    postings: int = POSTINGS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents of highest score above 0 for each item.

    The score is the sum over an item's terms, repeats included, of w * ((10^9 tf) div
    (1000 tf + 8 m)), with w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 25 + (75 n N) div L.
    Equal scores go by ascending doc_id, null ids last. Null and empty texts, and texts
    without a term, are in no result. Documents that repeat an id are ranked each for
    itself; item rows that repeat an id (null is an id too) are one item with the terms of
    all their texts. An empty table on either side gives no rows. Other columns are not read.

    The items are a stated set of queries; ``ITEM_BLOCK`` of them at a time, dealt by hash,
    meet all documents. Each task keeps the k best per item and block of documents, so only
    k rows per item and task are shuffled. Statistics count all documents.
    """
    source = id_and_text(docs, id_col, text_col)
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    blocks = -(-asked.count() // ITEM_BLOCK)
    spark = docs.sparkSession
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for number in range(blocks):
        mine = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number)
        terms: dict[int | None, Counter] = {}
        for row in mine.collect():
            terms.setdefault(row["item_id"], Counter()).update(terms_of(row["text"]))
        terms = {name: counted for name, counted in terms.items() if counted}
        if terms:
            found = found.unionByName(_ranked(source, terms, k, postings))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
