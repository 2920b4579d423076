"""Quality scores by a regularised quadratic discriminant over document statistics.

Each class has a normal density over transformed statistics of whole texts. Its covariance
is shrunk towards the pooled one and towards a multiple of the identity; the amounts are
chosen by cross-validation. A score is the logistic of the scaled difference of the two
log-densities, which are Mahalanobis distances through cached inverse Cholesky factors.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import id_and_text, text_slices, texts_of

#: Labelled rows to learn from at most, those of least id hash.
TRAIN_ROWS = 20_000
FOLDS = 5
SHRINK = (0.0, 0.1, 0.3, 0.6, 1.0)  # towards the pooled covariance
RIDGE = (1e-3, 1e-2, 0.1)  # towards the identity
THRESHOLD = 0.3

_UPPER, _LOWER = np.arange(65, 91), np.arange(97, 123)
_DIGIT = np.arange(48, 58)
_COMMON = np.frombuffer(b".,;:'\"-()?", np.uint8)  # punctuation of prose
_ODD = np.frombuffer(b"!#$%&*+/<=>@[\\]^_`{|}~", np.uint8)  # other ASCII signs

STATISTICS = (
    "log_chars", "log_words", "word_length", "word_length_deviation", "upper", "digits", "prose_signs", "odd_signs",
    "bar", "bang", "signs_per_word", "distinct_words", "top_word", "adjacent_repeats", "line_repeats", "words_per_line",
    "sentence_ends", "packed", "odd_words", "worst_line",
)


def statistics(text: str) -> list[float]:
    """Transformed statistics of one text, in the order of ``STATISTICS``; all defined for an empty one."""
    raw = text.encode()
    n = len(raw)
    tally = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = text.split()
    w = len(words)
    lengths = np.fromiter(map(len, words), np.int64, w)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line]
    upper, digits = int(tally[_UPPER].sum()), int(tally[_DIGIT].sum())
    prose, odd = int(tally[_COMMON].sum()), int(tally[_ODD].sum())
    letters = upper + int(tally[_LOWER].sum())
    share = lambda part, whole: np.sqrt(part / whole) if whole else 0.0
    odd_words = sum(c for word, c in counts.items() if not word[-1].isalnum() and word[-1] not in ".,;:'\"-()?")
    worst = max((_roughness(line) for line in lines), default=0.0)
    return [
        np.log1p(n), np.log1p(w), float(lengths.mean()) if w else 0.0, np.log1p(lengths.std()) if w else 0.0,
        share(upper, letters), share(digits, n), share(prose, n), share(odd, n), share(int(tally[124]), n),
        share(int(tally[33]), n), np.log1p((prose + odd) / w) if w else 0.0, share(len(counts), w) * w**0.1,
        share(max(counts.values(), default=0), w), share(sum(map(str.__eq__, words, words[1:])), w),
        share(len(lines) - len(set(lines)), len(lines)), np.log1p(w / len(lines)) if lines else 0.0,
        share(int(tally[46]), w), len(zlib.compress(raw, 1)) / n if n else 0.0, share(odd_words, w), worst,
    ]


def _roughness(line: str) -> float:
    """Share of words of a line that are followed by themselves, shouted or end in odd signs."""
    words = line.split()
    if len(words) < 4:
        return 0.0
    rough = sum(a == b or (len(a) > 1 and a.isupper()) or a[-1] in "!#$%&*|" for a, b in zip(words, words[1:]))
    return rough / (len(words) - 1)


@dataclass(frozen=True)
class Discriminant:
    """Two class densities over standardised statistics and the scaling of their difference."""

    centre: np.ndarray
    scale: np.ndarray
    bounds: np.ndarray
    means: np.ndarray
    factors: np.ndarray  # inverse Cholesky factors
    constants: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, values: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, priors included."""
        x = (np.clip(values, *self.bounds) - self.centre) / self.scale
        part = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return part[1] - part[0]

    def score(self, values: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.difference(values) + self.offset, -700, 700)))


def _densities(values: np.ndarray, labels: np.ndarray, shrink: float, ridge: float) -> Discriminant:
    bounds = np.quantile(values, [0.001, 0.999], axis=0)
    x = np.clip(values, *bounds)
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    x = (x - centre) / scale
    parts = [x[labels == k] for k in (0, 1)]
    own = [np.cov(p.T, bias=True) if len(p) > 1 else np.zeros((x.shape[1],) * 2) for p in parts]
    pooled = sum(c * len(p) for c, p in zip(own, parts)) / len(x)
    means, factors, constants = [], [], []
    for part, covariance in zip(parts, own):
        mean = part.mean(axis=0) if len(part) else np.zeros(x.shape[1])
        covariance = (1 - shrink) * covariance + shrink * pooled
        covariance = (1 - ridge) * covariance + ridge * (np.trace(covariance) / len(covariance) + 1e-6) * np.eye(len(covariance))
        root = np.linalg.cholesky(covariance)
        means.append(mean)
        factors.append(np.linalg.inv(root))
        constants.append(np.log((len(part) + 1) / (len(x) + 2)) - np.log(np.diag(root)).sum())
    return Discriminant(centre, scale, bounds, np.array(means), np.array(factors), np.array(constants))


def _calibrated(difference: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic that fits the labels best, by damped Newton steps."""
    spread = np.std(difference) or 1.0
    x = np.stack([np.clip(difference / spread, -8, 8), np.ones(len(difference))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (labels - p) - 1e-3 * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-6) / spread), float(beta[1])


def fit(values: np.ndarray, labels: np.ndarray) -> Discriminant:
    """The discriminant whose shrinkage has the least cross-validated log-loss.

    With fewer than two rows of a class it cannot separate and scores every text alike.
    """
    if min((labels == 0).sum(), (labels == 1).sum()) < 2:
        n = len(STATISTICS)
        share = (labels.sum() + 1) / (len(labels) + 2)
        flat = np.zeros((2, n)), np.zeros((2, n, n)), np.zeros(2)
        return Discriminant(np.zeros(n), np.ones(n), np.array([np.zeros(n), np.ones(n)]), *flat, 1.0, float(np.log(share / (1 - share))))
    fold = np.arange(len(labels)) % FOLDS
    best = None
    for shrink in SHRINK:
        for ridge in RIDGE:
            difference = np.empty(len(labels))
            for k in range(FOLDS):
                part = _densities(values[fold != k], labels[fold != k], shrink, ridge)
                difference[fold == k] = part.difference(values[fold == k])
            slope, offset = _calibrated(difference, labels)
            p = np.clip(1 / (1 + np.exp(-np.clip(slope * difference + offset, -30, 30))), 1e-6, 1 - 1e-6)
            loss = -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))
            if best is None or loss < best[0]:
                best = loss, shrink, ridge, slope, offset
    _, shrink, ridge, slope, offset = best
    made = _densities(values, labels, shrink, ridge)
    return Discriminant(made.centre, made.scale, made.bounds, made.means, made.factors, made.constants, slope, offset)


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the CRC of its id as text; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _values(rows: DataFrame, also: str) -> DataFrame:
    """Columns ``also`` (a schema of fixed names) with ``values`` from ``text``."""
    names = [part.split()[0] for part in also.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            values = [statistics(t) for t in texts_of(batch)]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(values, pa.list_(pa.float64()))], [*names, "values"])

    return rows.select(*names, "text").mapInArrow(run, f"{also}, values array<double>")


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    most: int = TRAIN_ROWS,
) -> Discriminant:
    """Fitted on labelled rows that are not held out, ``most`` of them at most (least id hash first).

    Rows with a null id or label, or a label other than 0 and 1, teach nothing.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
    source = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    rows = _values(source, "doc_id long, label int").orderBy("doc_id", "label", "values").limit(2 * most).collect()
    values = np.array([r["values"] for r in rows], float).reshape(len(rows), len(STATISTICS))
    return fit(values, np.array([r["label"] for r in rows], int))


def score_documents(
    docs: DataFrame, model: Discriminant, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; the score sees nothing but the whole text.

    Null and empty texts get the score of an empty text, repeated rows each a row, a null
    id stays null; an empty table gives no rows. Narrow: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            score = model.score(np.array([statistics(t) for t in texts_of(batch)]).reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    scored = id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Discriminant, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns.

    Null and empty texts have the score of an empty text, null ids do not matter, a score
    equal to ``threshold`` stays, and repeated rows stay or go together. Texts of any length
    are scored whole. An empty table gives an empty one; other columns pass through whatever
    their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col):
            score = model.score(np.array([statistics(t) for t in texts_of(batch, text_col)]).reshape(batch.num_rows, -1))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
