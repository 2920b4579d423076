"""Near-duplicate documents: fast similarity sketches, banding and exact verification.

A sketch has one coordinate per bin. In round i every shingle is thrown into a random bin
with a value in [i, i + 1); a bin keeps its least value, so bins filled in an early round
are final. Rounds past the number of bins send every shingle to one bin each, so all bins
are filled after twice as many rounds. Agreement of two sketches is then concentrated
around the similarity as for independent permutations.

Documents with equal shingle sets form a class and go on as one. Classes that agree in a
band meet in a bucket, and a pair belongs to the first band in which it agrees. In a bucket,
sketches tell which members have a promising partner in another component; only these get
their texts, and all their promising pairs are compared on the full shingle sets until they
are connected or none is left.

A bucket beyond the size of one group is cut into chunks. What is outside its largest
component visits all chunks if it is small enough; if not, the bucket is refined by a
further band, so that no group and no copying grows with the square of a bucket.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .base import id_and_text, mixed, settled, spread, text_slices
from .components import roots

BINS, BAND_ROWS = 128, 4  # 32 bands: a pair of similarity 0.8 shares none with probability 5e-8
BANDS = BINS // BAND_ROWS
FIRST_BANDS = 4  # bands searched first; they connect most families
CHUNK = 1000  # members of a bucket compared in one group, and visitors to it
SETS_BYTES = 64 << 20  # shingle sets that a group keeps at hand
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
STEP = np.uint64(0x9E3779B97F4A7C15)  # odd constant that spreads counters (fixed value)


@dataclass(frozen=True)
class Similarity:
    """Words per shingle, the similarity in per cent, and the least sketch agreement worth a comparison.

    At 128 bins a pair of similarity 0.8 agrees in under 0.6 with probability 8e-8.
    """

    words: int = 5
    per_cent: int = 80
    promising: float = 0.6


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles: A-Z lowered, words between ASCII white space.

    Fewer words than a shingle form one shingle; no words give an empty set.
    """
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(found))
    total = np.full(len(found) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total * STEP + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(total)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``BINS`` 64-bit coordinates per set; sets must not be empty."""
    out = np.full((len(sets), BINS), EMPTY)
    if not sets:
        return out
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets)
    steps = np.arange(1, 2 * BINS + 1, dtype=np.uint64) * STEP
    for step in range(2 * BINS):
        open_rows = (out == EMPTY).any(axis=1)
        if not open_rows.any():
            break
        if not open_rows.all():
            stay = open_rows[owner]
            owner, items = owner[stay], items[stay]
        hashes = mixed(items + steps[step])
        bins = (hashes & np.uint64(BINS - 1)).astype(np.int64) if step < BINS else step - BINS
        np.minimum.at(out, (owner, bins), np.uint64(step) << np.uint64(56) | hashes >> np.uint64(8))
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; equal keys of different bands do not meet."""
    bands = coordinates.reshape(len(coordinates), BINS // BAND_ROWS, BAND_ROWS)
    keys = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for row in range(BAND_ROWS):
        keys = mixed(keys * STEP + bands[:, :, row])
    return keys


def _short(coordinates: np.ndarray) -> np.ndarray:
    """Coordinates as bytes: enough to estimate agreement, which they raise by 1/256 of the rest."""
    return (mixed(coordinates) & np.uint64(0xFF)).astype(np.uint8)


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, digest, sketch, marks, rest``; the last four are null without shingles.

    ``marks`` and ``rest`` are the lower and upper halves of the band keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = [shingle_set(t or "", words) for t in batch.column(1).to_pylist()]
            full = [k for k, s in enumerate(sets) if len(s)]
            found = sketches([sets[k] for k in full])
            halves = band_keys(found).astype("<u8").view("<u4").reshape(len(full), BANDS, 2)
            short, marks, rest = _short(found), halves[:, :, 0].copy(), halves[:, :, 1].copy()
            columns: list[list[bytes | None]] = [[None] * len(sets) for _ in range(4)]
            for row, k in enumerate(full):
                columns[0][k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
                for column, values in zip(columns[1:], (short, marks, rest)):
                    column[k] = values[row].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(c, pa.binary()) for c in columns)],
                ["doc_id", "n_shingles", "digest", "sketch", "marks", "rest"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, sketch binary, marks binary, rest binary")


def _keys(marks: list[bytes], rest: list[bytes]) -> np.ndarray:
    """Band keys from their halves, a row per class."""
    halves = [np.frombuffer(b"".join(part), "<u4").astype(np.uint64).reshape(-1, BANDS) for part in (marks, rest)]
    return halves[1] << np.uint64(32) | halves[0]


def _band_rows(classes: DataFrame) -> DataFrame:
    """``id, band, depth, key``: one row per class and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, marks, rest = (c.to_pylist() for c in batch.columns)
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(ids, np.int64), BANDS)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n)),
                    pa.array(np.ones(n * BANDS, np.int32)), pa.array(_keys(marks, rest).view(np.int64).ravel()),
                ],
                ["id", "band", "depth", "key"],
            )

    return classes.select("id", "marks", "rest").mapInArrow(run, "id long, band int, depth int, key long")


def _refined(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``id, band, depth, key``: members of a bucket dealt anew by its key and each later band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, band, depth, key = (batch.column(k).to_numpy() for k in range(4))
            own = _keys(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            at, later = np.nonzero(np.arange(BANDS) > band[:, None])
            found = mixed(key.view(np.uint64)[at] * STEP + own[at, later])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.array(later.astype(np.int32)), pa.array((depth[at] + 1).astype(np.int32)), pa.array(found.view(np.int64))],
                ["id", "band", "depth", "key"],
            )

    joined = rows.select("id", "band", "depth", "key").join(classes.select("id", "marks", "rest"), "id")
    return joined.select("id", "band", "depth", "key", "marks", "rest").mapInArrow(run, "id long, band int, depth int, key long")


def _crowded(banded: DataFrame) -> DataFrame:
    """The rows whose key occurs more than once."""
    sizes = settled(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return settled(spread(banded, sizes, "key", "size", max(total, 1), by="id").drop("size"))


def _packed_texts(docs: DataFrame) -> DataFrame:
    """``id, data``: texts compressed, since they move several times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in text_slices(batches):
            data = [pack.compress((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["id", "data"])

    return docs.mapInArrow(run, "id long, data binary")


@dataclass
class Cell:
    """Members that meet in one group: components, set sizes, sketches, band marks, and who is at home."""

    group: np.ndarray
    sizes: np.ndarray
    short: np.ndarray
    marks: np.ndarray
    home: np.ndarray
    band: int
    depth: int

    @classmethod
    def of(cls, part: pa.Table) -> Cell:
        n = part.num_rows
        return cls(
            part.column("comp").to_numpy(), part.column("n").to_numpy(),
            np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(n, BINS),
            np.frombuffer(b"".join(part.column("marks").to_pylist()), "<u4").reshape(n, BANDS),
            part.column("home").to_numpy(), part.column("band")[0].as_py(), part.column("depth")[0].as_py(),
        )

    def partners(self, rule: Similarity) -> Iterator[tuple[int, np.ndarray]]:
        """Each member outside the largest component with its promising partners in other components, the likeliest first.

        Every pair comes once. Two visitors are left to the cells where one is at home, a
        pair of another first band to its bucket.
        """
        names, place, sizes = np.unique(self.group, return_inverse=True, return_counts=True)
        beside = place != sizes.argmax()
        every = np.arange(len(self.group))
        for at in np.flatnonzero(beside).tolist():
            other = every[(place != place[at]) & (~beside | (every > at)) & (self.home | self.home[at])]
            low, high = np.minimum(self.sizes[other], self.sizes[at]), np.maximum(self.sizes[other], self.sizes[at])
            other = other[100 * low >= rule.per_cent * high]
            agree = (self.short[other] == self.short[at]).mean(axis=1)
            shared = (self.marks[other, : self.band + 1] == self.marks[at, : self.band + 1]).sum(axis=1)
            stay = (agree >= rule.promising) & (shared == self.depth)
            if stay.any():
                yield at, other[stay][np.argsort(-agree[stay], kind="stable")]


class Sets:
    """Shingle sets of packed texts; those used last stay at hand within ``SETS_BYTES``."""

    def __init__(self, data: list[bytes], words: int):
        self.data, self.words, self.held = data, words, 0
        self.known: OrderedDict[int, np.ndarray] = OrderedDict()
        self.unpack = zstandard.ZstdDecompressor()

    def __getitem__(self, at: int) -> np.ndarray:
        if at in self.known:
            self.known.move_to_end(at)
            return self.known[at]
        found = self.known[at] = shingle_set(self.unpack.decompress(self.data[at]).decode(), self.words)
        self.held += found.nbytes
        while self.held > SETS_BYTES and len(self.known) > 1:
            self.held -= self.known.popitem(last=False)[1].nbytes
        return found

    def linked(self, at: int, others: list[int], rule: Similarity) -> np.ndarray:
        """Which of ``others`` are linked with ``at``, by their full sets."""
        mine = self[at]
        out = np.empty(len(others), bool)
        start = 0
        while start < len(others):  # a few million shingles at a time
            sets, items = [], 0
            while start + len(sets) < len(others) and (not sets or items < 1 << 21):
                sets.append(self[others[start + len(sets)]])
                items += len(sets[-1])
            flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
            hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
            shared = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
            out[start : start + len(sets)] = 100 * shared >= rule.per_cent * (len(mine) + sizes - shared)
            start += len(sets)
        return out


def _links_of(cell: Cell, sets: Sets, rule: Similarity) -> list[tuple[int, int]]:
    """Components of the cell that links join, as few pairs of rows as connect them."""
    names, root = np.unique(cell.group, return_inverse=True)
    links = []
    for at, other in cell.partners(rule):
        batch = 8
        while len(other := other[root[other] != root[at]]):
            now, other = other[:batch], other[batch:]
            batch *= 4
            for hit in now[sets.linked(at, now.tolist(), rule)].tolist():
                if root[hit] != root[at]:
                    links.append((at, hit))
                    root[root == root[hit]] = root[at]
    return links


def _links(cells: DataFrame, classes: DataFrame, texts: DataFrame, rule: Similarity) -> DataFrame:
    """``a, b``: components joined by a link within a cell of ``key, cell, band, depth, id, comp, home``.

    No step makes more rows than the cells have.
    """
    rows = cells.join(classes.select("id", "n", "sketch", "marks"), "id")
    schema = "id long, key long, cell long, band int, depth int, comp long, home boolean, n long, sketch binary, marks binary"
    names = [field.split()[0] for field in schema.split(", ")]

    def promising(part: pa.Table) -> pa.Table:
        found = np.zeros(part.num_rows, bool)
        for at, other in Cell.of(part).partners(rule):
            found[at] = True
            found[other] = True
        return part.filter(pa.array(found))

    def compare(part: pa.Table) -> pa.Table:
        part = part.sort_by([("id", "ascending")])
        cell = Cell.of(part)
        links = _links_of(cell, Sets(part.column("data").to_pylist(), rule.words), rule)
        ends = [pa.array(cell.group[[link[k] for link in links]] if links else [], pa.int64()) for k in (0, 1)]
        return pa.table(dict(zip(("a", "b"), ends)))

    wanted = rows.select(*names).groupBy("key", "cell").applyInArrow(promising, schema)
    return wanted.join(texts, "id").groupBy("key", "cell").applyInArrow(compare, "a long, b long")


def _open_rows(members: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Members of the buckets that hold several components, with the bucket's ``held, main, beside, pivot``.

    ``main`` is the largest component, ``beside`` the members outside it. ``None`` if all are closed.
    """
    placed = members.join(labels, "id")
    parts = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    buckets = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("comps"), F.sum("n").alias("held"), F.max(F.struct("n", "comp")).alias("top"), F.min("first").alias("pivot")
    )
    kept = F.col("top.comp").alias("main"), (F.col("held") - F.col("top.n")).alias("beside"), "pivot"
    several = settled(buckets.filter("comps > 1").select("key", "held", *kept))
    total = several.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    return settled(spread(placed, several, "key", "held", total, by="id")) if total else None


def _cells(rows: DataFrame) -> DataFrame:
    """Members of open buckets dealt into groups of at most about ``CHUNK`` at home and as many visitors.

    A bucket of at most ``CHUNK`` members is one cell, a larger one is cut into chunks. If
    at most ``CHUNK`` members are outside its main component, they visit all chunks, which
    adds no more rows than the bucket has, and all pairs meet. Else only its smallest
    member does, which connects families; the rest is left to refined buckets.
    """
    chunks = F.when(F.col("held") > CHUNK, F.ceil(F.col("held") / CHUNK)).otherwise(1).cast("long")
    own = F.pmod(F.xxhash64("id", "key"), chunks)
    goes = F.when(F.col("beside") <= CHUNK, F.col("comp") != F.col("main")).otherwise(F.col("id") == F.col("pivot"))
    cells = F.when(goes, F.sequence(F.lit(0).cast("long"), chunks - 1)).otherwise(F.array(own))
    dealt = rows.select("key", "band", "depth", "id", "comp", own.alias("own"), F.explode(cells).alias("cell"))
    return dealt.select("key", "cell", "band", "depth", "id", "comp", (F.col("cell") == F.col("own")).alias("home"))


def _merged(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
    """Labels after the links of components ``a, b``, and whether there is any."""
    if links.isEmpty():
        return labels, False
    found = roots(links)
    return settled(labels.join(found.withColumnRenamed("u", "comp"), "comp", "left").select("id", F.coalesce("v", "comp").alias("comp"))), True


def _connected(members: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, rule: Similarity) -> DataFrame:
    """``id, comp`` after all promising pairs of different components were compared.

    The first round sees few bands, which connect most families; the next sees all. A
    bucket with too many members outside its main component goes on while that changes,
    and is then refined.
    """
    bands = FIRST_BANDS
    while True:
        rows = _open_rows(members.filter(F.col("band") < bands), labels)
        if rows is None:
            if bands == BANDS:
                return labels
            bands = BANDS
            continue
        labels, changed = _merged(labels, settled(_links(_cells(rows), classes, texts, rule)))
        if bands < BANDS:
            bands = BANDS
            continue
        wide = rows.filter((F.col("held") > CHUNK) & (F.col("beside") > CHUNK))
        if wide.isEmpty():
            return labels
        if not changed:
            members = _crowded(_refined(wide, classes))


def link_components(docs: DataFrame, rule: Similarity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Two documents are linked if 100 * shared >= per_cent * union over their shingle sets;
    ``component_id`` is the smallest id that links reach, and ``kept`` tells the document
    that has it. Null and empty texts, and texts of white space, have no shingles and are
    linked with nothing. A row with a null id is linked with nothing; its component is null
    and it is kept. Rows that repeat an id are one document with all their texts, and all
    of them are kept or none. Other columns are not read; an empty table gives no rows.
    """
    source = id_and_text(docs, id_col, text_col)
    signed = settled(_signatures(source, rule.words))
    total = signed.count()
    named = signed.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    one = [F.first(name).alias(name) for name in ("sketch", "marks", "rest")]
    classes = settled(
        named.groupBy("digest").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("size"), F.first("n_shingles").alias("n"), *one)
    )
    members = _crowded(_band_rows(classes))
    texts = settled(_packed_texts(source.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")))
    labels = settled(members.select("id").distinct().withColumn("comp", F.col("id")))
    labels = _connected(members, labels, classes, texts, rule)
    of_class = settled(
        classes.select("digest", "id", "size").join(labels, "id", "left").select("digest", "size", F.coalesce("comp", "id").alias("comp"))
    )
    key = F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")
    out = spread(signed.select("doc_id", "n_shingles", key), of_class, "digest", "size", total, by="doc_id", how="left")
    component = F.coalesce("comp", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, rule: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`link_components` keeps, with all their columns.

    Rows with a null id, and texts without words (null, empty, white space), stay. Rows that
    repeat an id stay or go together; of equal texts under different ids the smallest id
    stays. Texts of any length are compared whole. An empty table gives an empty one, and
    columns of any other name pass through.
    """
    gone = link_components(docs, rule, id_col, text_col).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
