"""Exact top-k inner products by segment statistics at several resolutions.

A vector cut into segments has a mean and a deviation norm per segment. For two vectors
the distance is at least sum(m (mean_q - mean_x)^2 + (dev_q - dev_x)^2), which with the
norms bounds the inner product from above. Coarse segments come first; pairs whose bound
is below the k-th exact score found so far are out, the others go on to finer segments,
and what is left is computed exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (16, 4, 2)  # components per segment after the first level, which has one segment
DENSE = 0.02  # share of pairs left above which all exact products of a block come from one matrix product
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
EXACT_BELOW = 2.0**53


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _sketch(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(m) mean and deviation norm: inner products of these bound those of the vectors."""
    edges = np.unique(np.linspace(0, vectors.shape[1], segments + 1).astype(int))
    out = np.empty((len(vectors), 2 * (len(edges) - 1)))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        part = vectors[:, a:b]
        mean = part.mean(axis=1)
        out[:, 2 * k] = mean * np.sqrt(b - a)
        out[:, 2 * k + 1] = np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))
    return out


def _fits(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether inner products of whole numbers stay exact in floating point."""
    largest = np.abs(left).max(initial=0.0) * np.abs(right).max(initial=0.0) * max(left.shape[1], 1)
    return bool(largest < EXACT_BELOW)


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of row pairs as long, held at its limits if they are beyond."""
    if _fits(left, right):
        return np.einsum("ij,ij->i", left, right).astype(np.int64)
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    whole = [sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in zip(left.tolist(), right.tolist())]
    return np.array([min(max(s, low), high) for s in whole], np.int64)


def best_pairs(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query row, candidate row, score)`` of each query's k best candidates of this block."""
    other = query_ids[:, None] != ids[None, :]
    # Rounding of the bounds, allowed for in the least score that a pair must be able to reach.
    slack = 1e-9 * (np.sqrt((queries**2).sum(1)) * np.sqrt((vectors**2).sum(1)).max(initial=0.0) + 1.0)
    bound = _sketch(queries, 1) @ _sketch(vectors, 1).T
    bound[~other] = -np.inf
    first = min(k, bound.shape[1])
    start = np.argpartition(bound, bound.shape[1] - first, axis=1)[:, -first:]
    rows = np.repeat(np.arange(len(queries)), first)
    seeds = _scores(queries[rows], vectors[start.ravel()]).reshape(len(queries), first).astype(float)
    seeds[~np.take_along_axis(other, start, 1)] = -np.inf
    enough = np.full(len(queries), -np.inf) if first < k else seeds.min(1) - slack
    alive = other & (bound >= enough[:, None])
    for part in LEVELS:
        segments = queries.shape[1] // part
        if segments > 1 and alive.any():
            alive &= _sketch(queries, segments) @ _sketch(vectors, segments).T >= enough[:, None]
    if alive.mean() > DENSE and _fits(queries, vectors):
        exact = queries @ vectors.T  # whole numbers below 2**53: exact in any order of summing
        exact[~alive] = -np.inf
        least = np.partition(exact, exact.shape[1] - first, axis=1)[:, -first]
        at_q, at_v = np.nonzero(alive & (exact >= least[:, None]))
        score = exact[at_q, at_v].astype(np.int64)
    else:
        at_q, at_v = np.nonzero(alive)
        score = np.concatenate(
            [_scores(queries[at_q[i : i + 65536]], vectors[at_v[i : i + 65536]]) for i in range(0, len(at_q), 65536)]
            or [np.empty(0, np.int64)]
        )
    order = np.lexsort((ids[at_v], ~score, at_q))
    at_q, at_v, score = at_q[order], at_v[order], score[order]
    place = np.arange(len(at_q)) - np.searchsorted(at_q, at_q)
    return at_q[place < k], at_v[place < k], score[place < k]


def top_inner_products(
    table: DataFrame,
    every: int = 50,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query, ties to smaller ids.

    Components become floor(scale * x). Queries are the rows whose id is divisible by
    ``every``; candidates all rows with another id. Null ids, null vectors and vectors with
    a null or non-finite component take no part; vectors of different lengths are not
    compared. Rows that repeat an id are candidates each for itself, and an id asked for
    twice is asked with its smallest vector. Scores beyond a long are held at its limits.
    An empty table, or one without queries, gives no rows. Other columns are not read.

    Queries and candidates are dealt into blocks of bounded size and each block of queries
    meets each block of candidates in a group of its own; k rows per query leave a group.
    """
    rows = table.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    ).filter(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    asks = F.col("vec_id") % every == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(asks.cast("long")), F.lit(0))).first()
    q_blocks, c_blocks = -(-n_queries // QUERY_BLOCK) or 1, -(-n // CANDIDATE_BLOCK) or 1
    own = F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int")
    cell = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(c_blocks)).cast("int")
    each_q, each_c = F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))), F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))
    cells = rows.filter(asks).select(own.alias("q"), each_c.alias("c"), "vec_id", "vector", F.lit(True).alias("asks")).unionByName(
        rows.select(each_q.alias("q"), cell.alias("c"), "vec_id", "vector", F.lit(False).alias("asks"))
    )

    def search(group: pa.Table) -> pa.Table:
        ids, ask = group.column("vec_id").to_numpy(), group.column("asks").to_numpy(zero_copy_only=False)
        column = group.column("vector").combine_chunks()
        sizes = np.diff(column.offsets.to_numpy())
        flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))
        out: list[list[np.ndarray]] = [[], [], []]
        for size in np.unique(sizes[ask]).tolist():
            pick = sizes == size
            vectors = flat[np.repeat(pick, sizes)].reshape(-1, size)
            mine, asked = ids[pick], ask[pick]
            order = np.lexsort((*vectors[asked].T[::-1], mine[asked]))
            names, first = np.unique(mine[asked][order], return_index=True)
            if asked.all():
                continue
            q, v, score = best_pairs(names, vectors[asked][order][first], mine[~asked], vectors[~asked], k)
            for part, values in zip(out, (names[q], mine[~asked][v], score)):
                part.append(values)
        found = [np.concatenate(p) if p else np.empty(0, np.int64) for p in out]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found)))

    found = cells.groupBy("q", "c").applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
