"""Whitening of embeddings over their distinct vectors, with multiplicities as weights.

Rows with the same whole-number vector are one vector of the fit list, with their count or
one as its weight. Its covariance is a weighted centred matrix product; each distinct
vector is whitened once and the result is joined back to all its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import settled, spread

LONG = np.iinfo(np.int64)
#: Eigenvalues below this share of the largest are rounding; their components are left out.
RANK_TOLERANCE = 1e-12
#: Entries beyond this are held at it, so that adding the shift stays within a long.
WIDEST = 2.0**52


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


@dataclass(frozen=True)
class Fit:
    """Whitening of the vectors of one length: exact sums, and the components as columns over sqrt(e)."""

    n: int
    sums: np.ndarray  # Python integers
    axes: np.ndarray
    explained: tuple[float, ...]

    def centred(self, vectors: np.ndarray) -> np.ndarray:
        """n x - S as exact integers: longs if they cannot overflow, else Python integers."""
        widest = max(int(np.abs(vectors).max(initial=0)), 1)
        if widest * self.n * 2 < LONG.max and int(np.abs(self.sums).max(initial=0)) * 2 < LONG.max:
            return vectors * self.n - self.sums.astype(np.int64)
        return vectors.astype(object) * self.n - self.sums

    def deviations(self, centred: np.ndarray) -> np.ndarray:
        """Sums of squares, exact; beyond a long they are held at its end."""
        widest = int(np.abs(centred).max(initial=0))
        if widest * widest * max(centred.shape[1], 1) <= LONG.max:
            return (centred * centred).sum(axis=1)
        return np.array([min(sum(int(c) * int(c) for c in row), LONG.max) for row in centred.tolist()], np.int64)

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.axes


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, matrix)`` for each vector length in the batch; the vectors are column 0."""
    column = batch.column(0)
    offsets = column.offsets.to_numpy()
    sizes, flat = np.diff(offsets), column.values.to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[offsets[rows][:, None] + np.arange(size)]


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per vector length the weight in total and the weighted sums per dimension, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            weights = batch.column(1).to_numpy()
            for rows, vectors in _by_length(batch):
                mine = weights[rows]
                n, sums = found.get(vectors.shape[1], (0, np.zeros(vectors.shape[1], object)))
                exact = int(np.abs(vectors).max(initial=0)) * int(mine.sum()) < LONG.max
                part = mine @ vectors if exact else mine.astype(object) @ vectors.astype(object)
                found[vectors.shape[1]] = n + int(mine.sum()), sums + part.astype(object)
        rows = [(size, at, n, str(s)) for size, (n, sums) in found.items() for at, s in enumerate(sums)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["size", "at", "n", "total"])

    parts = distinct.select("x", "weight").mapInArrow(run, "size long, at long, n long, total string")
    rows = parts.groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for row in sorted(rows, key=lambda r: (r["size"], r["at"])):
        out.setdefault(row["size"], (row["n"], []))[1].append(int(row["total"]))
    return out


def _products(table: DataFrame, fits: dict[int, Fit] | None) -> dict[int, np.ndarray]:
    """Per ``size`` the sums of weighted products of all pairs of columns.

    With ``fits`` the columns are the centred vectors; without, the components ``whitened``
    as they are, with a column of ones that gives their means.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column(1).to_numpy().astype(np.float64)
            sizes = batch.column(2).to_numpy()
            for rows, values in _by_length(batch):
                for size in np.unique(sizes[rows]).tolist():
                    pick = sizes[rows] == size
                    part = fits[size].centred(values[pick]).astype(np.float64) / fits[size].n if fits else values[pick]
                    if not fits:
                        part = np.hstack([part, np.ones((len(part), 1))])
                    product = part.T @ (weights[rows][pick][:, None] * part)
                    found[size] = found[size] + product if size in found else product
        for size, product in found.items():
            i, j = np.triu_indices(len(product))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), size)), pa.array(i), pa.array(j), pa.array(product[i, j])], ["size", "i", "j", "value"]
            )

    parts = table.mapInArrow(run, "size long, i long, j long, value double")
    rows = parts.groupBy("size", "i", "j").agg(F.sum("value").alias("value")).collect()
    out = {}
    for size in {row["size"] for row in rows}:
        mine = [row for row in rows if row["size"] == size]
        matrix = np.zeros((max(row["j"] for row in mine) + 1,) * 2)
        for row in mine:
            matrix[row["i"], row["j"]] = matrix[row["j"], row["i"]] = row["value"]
        out[size] = matrix
    return out


def _fit(n: int, sums: list[int], products: np.ndarray, components: int) -> Fit:
    covariance = products / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > RANK_TOLERANCE * max(values.max(initial=0.0), 0.0)]
    axes = vectors[:, order]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    explained = tuple((values[order] / np.trace(covariance)).tolist())
    return Fit(n, np.array(sums, object), axes / np.sqrt(values[order]), explained)


def whiten(
    table: DataFrame,
    components: int = 16,
    scale: float = 64.0,
    shift: int = 1_000_000,
    by_count: bool = False,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component.

    Entries become x = floor(scale * c) + shift. The fit list holds each distinct x vector
    once (``by_count``: as often as it occurs); n is its size, S its sums per dimension.
    ``deviation`` is the sum of (n x - S)^2, ``whitened`` the projection of x - S/n on the
    unit eigenvector of the covariance over sqrt(e), ``explained`` e over the trace and
    ``identity_error`` the largest entry of the whitened covariance minus the identity.

    Null vectors, vectors with a null or non-finite entry and empty ones are left out.
    Vectors of different lengths are whitened apart, each length with its own list; the
    driver holds one matrix per length. Components without variance (all, if there is one
    distinct vector) are left out, so a row may have fewer than asked, or none. Null ids
    stay, repeated rows each give rows, an empty table gives none. Entries beyond 2^52 in
    size are held there, and a deviation beyond a long is held at its end. Other columns are
    not read. Sums of doubles may differ in their last digits from run to run.

    Only counts, sums and one square matrix reach the driver. A vector that very many rows
    share is counted before it is shuffled and joined back by broadcast.
    """
    vector = F.col(vector_col).cast("array<double>")
    whole = F.transform(
        vector, lambda c: F.floor(F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), c * F.lit(scale)))).cast("long") + F.lit(shift)
    )
    rows = table.filter(_usable(vector)).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x"))
    counted = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    weight = F.col("copies") if by_count else F.lit(1).cast("long")
    distinct = settled(counted.select("x", weight.alias("weight"), "copies"))
    spark = table.sparkSession
    output = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sums = _sums(distinct)
    if not sums:
        return spark.createDataFrame([], output)
    sized = distinct.withColumn("size", F.size("x").cast("long"))
    blank = {size: Fit(n, np.array(s, object), np.empty((size, 0)), ()) for size, (n, s) in sums.items()}
    products = _products(sized.select("x", "weight", "size"), blank)
    fits = {size: _fit(*sums[size], products[size], components) for size in sums}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, vectors in _by_length(batch):
                fit = fits[vectors.shape[1]]
                centred = fit.centred(vectors)
                found = fit.project(centred)
                width = found.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, width) if width else np.zeros(len(rows) + 1, int), pa.int32()), pa.array(found.ravel()))
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [lists, *taken.columns[1:], taken.column(0), pa.array(fit.deviations(centred), pa.int64())],
                    ["whitened", "weight", "size", "copies", "x", "deviation"],
                )

    done = settled(
        sized.select("x", "weight", "size", "copies").mapInArrow(
            run, "whitened array<double>, weight long, size long, copies long, x array<long>, deviation long"
        )
    )
    errors = {}
    for size, products in _products(done.select("whitened", "weight", "size"), None).items():
        n = products[-1, -1]
        mean = products[:-1, -1] / n
        error = np.abs(products[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(mean)))
        errors[size] = float(error.max(initial=0.0))
    per_size = [
        (size, fit.n, list(fit.explained), errors.get(size, 0.0)) for size, fit in fits.items()
    ]
    facts = spark.createDataFrame(per_size, "_size long, n long, shares array<double>, identity_error double")
    total = int(done.agg(F.sum("copies")).first()[0])
    joined = spread(rows, done, "x", "copies", total, by="vec_id").join(F.broadcast(facts), F.col("size") == F.col("_size"))
    spelt = joined.select("vec_id", "n", "deviation", "shares", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return spelt.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.get("shares", F.col("at")).alias("explained"), "identity_error",
    )
