"""Personal data: rules, and a character BiLSTM with CRF transitions that adds what rules miss.

The network is trained in numpy from labelled spans: windows of a bounded sample of
documents, labelled where the rules match, and copies of them in which a labelled span is
rewritten into a form that the rules do not cover. In use, overlapping windows give
scores per character; each character takes them from the window in whose middle it lies
best, and one Viterbi pass over each stretch of windows decides on the spans.

Every kind of personal data here holds a digit or an at sign, and spans without one are
refused, so stretches that hold neither need no window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .base import id_and_text, settled, text_slices, texts_of

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
BLOCK = 512  # windows scored at once
TRAIN_DOCS, TRAIN_WINDOWS = 20_000, 2_000  # the sample to learn from, at most
MARGIN = 2.0  # log-odds against no span that an added span must have

_TRIGGER = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, int]  # number of the kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Matches of the e-mail rule, found from the at signs outwards, so in linear time."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        free = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            free = domain.end()
            yield 0, start, free
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """What the rules find, by kind, then start."""
    out = list(_emails(text)) if "@" in text else []
    if not _TRIGGER.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def plausible(kind: int, span: str) -> bool:
    """Whether a span of the network may be added: the form of its kind, with the rules' limits loosened."""
    digits = _NOT_DIGIT.sub("", span)
    if span != span.strip() or "\n" in span:
        return False
    if kind == 0:
        return re.fullmatch(r"[^\s@]+\x20?@\x20?[^\s@]+\.[^\s@]*[A-Za-z0-9]", span) is not None
    if kind == 1:
        return re.fullmatch(r"[0-9]{1,3}(?:\x20?\.\x20?[0-9]{1,3}){3}", span) is not None
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9](?:[\x20.-]{0,2}[0-9])+", span) is not None
    signs = len(re.findall(r"[\x20().-]+", span))
    return 9 <= len(digits) <= 15 and signs >= 2 and re.fullmatch(r"[(+0-9][\x20().0-9-]*[0-9]", span) is not None


# --- the network -------------------------------------------------------------------------

_LETTER, _OTHER, _PAD = 96, 97, 98  # classes past printable ASCII
CLASSES, EMBED, HIDDEN = 99, 12, 20
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside per kind


def char_classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where((codes >= 32) & (codes < 127), codes - 32, np.where(codes >= 0xC0, _LETTER, np.where(codes == 10, 95, _OTHER)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Weights by name; ``f`` and ``b`` stand for the forward and the backward direction."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 7) -> Tagger:
        source = np.random.default_rng(seed)
        draw = lambda *shape: source.normal(0, 1 / np.sqrt(shape[0]), shape)
        w = {"embed": source.normal(0, 0.5, (CLASSES, EMBED)), "out": draw(2 * HIDDEN, TAGS), "out_bias": np.zeros(TAGS)}
        for d in "fb":
            w |= {f"in_{d}": draw(EMBED, 4 * HIDDEN), f"own_{d}": draw(HIDDEN, 4 * HIDDEN), f"bias_{d}": np.zeros(4 * HIDDEN)}
            w[f"bias_{d}"][HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
        return cls(w | {"move": source.normal(0, 0.1, (TAGS, TAGS)), "first": np.zeros(TAGS)})

    def _run(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        w, steps, n = self.weights, x.shape[0], x.shape[1]
        given = x @ w[f"in_{d}"] + w[f"bias_{d}"]
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        out, kept = np.empty((steps, n, HIDDEN)), [None] * steps
        for t in range(steps) if d == "f" else reversed(range(steps)):
            z = given[t] + h @ w[f"own_{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            before_h, before_c = h, c
            c = f * c + i * g
            bent = np.tanh(c)
            h = o * bent
            out[t], kept[t] = h, (i, f, o, g, before_h, before_c, bent)
        return out, kept

    def emissions(self, windows: np.ndarray) -> np.ndarray:
        """Scores (window, place, tag) of character classes (window, place)."""
        x = self.weights["embed"][windows.T]
        both = np.concatenate([self._run(x, "f")[0], self._run(x, "b")[0]], axis=2)
        return (both @ self.weights["out"] + self.weights["out_bias"]).transpose(1, 0, 2)

    def gradients(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags and its gradients."""
        w, (n, steps) = self.weights, windows.shape
        x = w["embed"][windows.T]
        runs = {d: self._run(x, d) for d in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        scores = both @ w["out"] + w["out_bias"]
        y = tags.T
        ahead, back = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0] + w["first"]
        for t in range(1, steps):
            ahead[t] = scores[t] + _log_sum(ahead[t - 1][:, :, None] + w["move"], 1)
        for t in range(steps - 2, -1, -1):
            back[t] = _log_sum(w["move"] + (scores[t + 1] + back[t + 1])[:, None, :], 2)
        total = _log_sum(ahead[-1], 1)
        one = np.eye(TAGS)
        path = np.take_along_axis(scores, y[:, :, None], 2).sum() + w["move"][y[:-1], y[1:]].sum() + w["first"][y[0]].sum()
        d_scores = (np.exp(ahead + back - total[None, :, None]) - one[y]) / n
        pairs = np.exp(ahead[:-1, :, :, None] + w["move"] + (scores[1:] + back[1:])[:, :, None, :] - total[None, :, None, None])
        seen = np.zeros((TAGS, TAGS))
        np.add.at(seen, (y[:-1], y[1:]), 1.0)
        grads = {
            "move": (pairs.sum((0, 1)) - seen) / n, "first": d_scores[0].sum(0),
            "out": np.einsum("tnh,tnk->hk", both, d_scores), "out_bias": d_scores.sum((0, 1)),
        }
        d_both = d_scores @ w["out"].T
        d_x = np.zeros_like(x)
        for d, part in (("f", d_both[:, :, :HIDDEN]), ("b", d_both[:, :, HIDDEN:])):
            d_h, d_c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            d_z = np.empty((steps, n, 4 * HIDDEN))
            before = np.empty((steps, n, HIDDEN))
            for t in reversed(range(steps)) if d == "f" else range(steps):
                i, f, o, g, before[t], old_c, bent = runs[d][1][t]
                d_h = d_h + part[t]
                d_c = d_c + d_h * o * (1 - bent**2)
                d_z[t] = np.concatenate(
                    [d_c * g * i * (1 - i), d_c * old_c * f * (1 - f), d_h * bent * o * (1 - o), d_c * i * (1 - g**2)], axis=1
                )
                d_c = d_c * f
                d_h = d_z[t] @ w[f"own_{d}"].T
            grads[f"in_{d}"] = np.einsum("tne,tnz->ez", x, d_z)
            grads[f"own_{d}"] = np.einsum("tnh,tnz->hz", before, d_z)
            grads[f"bias_{d}"] = d_z.sum((0, 1))
            d_x += d_z @ w[f"in_{d}"].T
        grads["embed"] = np.zeros_like(w["embed"])
        np.add.at(grads["embed"], windows.T, d_x)
        return float((total.sum() - path) / n), grads

    def best_tags(self, scores: np.ndarray) -> np.ndarray:
        """Viterbi over one stretch of scores (place, tag)."""
        move = self.weights["move"]
        best, links = scores[0] + self.weights["first"], np.zeros(scores.shape, np.uint8)
        for at in range(1, len(scores)):
            options = best[:, None] + move
            links[at] = options.argmax(0)
            best = options.max(0) + scores[at]
        out = np.empty(len(scores), np.int64)
        out[-1] = best.argmax()
        for at in range(len(scores) - 1, 0, -1):
            out[at - 1] = links[at, out[at]]
        return out


def train(windows: np.ndarray, tags: np.ndarray, steps: int = 700, batch: int = 24, rate: float = 0.02) -> Tagger | None:
    """Adam with clipped gradients and a falling rate; ``None`` if no window holds a span."""
    if not len(windows) or not tags.any():
        return None
    model, source = Tagger.fresh(), np.random.default_rng(11)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    marked, plain = np.flatnonzero(tags.any(1)), np.flatnonzero(~tags.any(1))
    for step in range(1, steps + 1):
        pick = source.choice(marked, batch * 2 // 3)
        if len(plain):
            pick = np.concatenate([pick, source.choice(plain, batch // 3)])
        _, grads = model.gradients(windows[pick], tags[pick])
        size = np.sqrt(sum((g**2).sum() for g in grads.values()))
        pace = rate * min(1.0, 2 * (1 - (step - 1) / steps))
        for name, g in grads.items():
            g = g * min(1.0, 5.0 / (size + 1e-9))
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.999 * second[name] + 0.001 * g**2
            model.weights[name] -= pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return model


def window_starts(text: str) -> list[int]:
    """Starts of the overlapping windows that hold a digit or an at sign."""
    out: list[int] = []
    for m in _TRIGGER.finditer(text):
        last = m.start() // STRIDE
        for k in (last - 1, last):
            if k >= 0 and (not out or k * STRIDE > out[-1]):
                out.append(k * STRIDE)
    return out


def _classes_at(classes: np.ndarray, start: int) -> np.ndarray:
    part = classes[start : start + WINDOW]
    return part if len(part) == WINDOW else np.concatenate([part, np.full(WINDOW - len(part), _PAD)])


def _tags_at(spans: list[Span], start: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.int64)
    for kind, a, b in spans:
        a, b = max(a - start, 0), min(b - start, WINDOW)
        if a < b:
            out[a:b] = 2 * kind + 2
            out[a] = 2 * kind + 1
    return out


def rewritten(kind: int, span: str, pick: int) -> str:
    """A form of a span that the rules miss."""
    if kind == 0:
        return span.replace("@", (" @ ", "@ ", " @")[pick % 3])
    if kind == 1:
        return span.replace(".", (" . ", " .", ". ")[pick % 3])
    if kind == 2:
        digits = _NOT_DIGIT.sub("", span)
        return (". ", "  ", " - "[:2])[pick % 3].join(digits[k : k + 4] for k in range(0, len(digits), 4))
    return span.removeprefix("+") if pick % 2 else "(" + span.removeprefix("+").replace("(", "").replace(")", "").replace(" ", ") ", 1)


def examples(text: str, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Labelled windows of a text, and windows of it with one span rewritten."""
    spans = sorted(base_spans(text), key=lambda s: (s[1], s[0]))
    classes = char_classes(text)
    for start in window_starts(text):
        yield _classes_at(classes, start), _tags_at(spans, start)
    for k, (kind, a, b) in enumerate(spans):
        other = rewritten(kind, text[a:b], seed + k)
        lead = max(0, a - WINDOW // 3)
        near = text[lead:a] + other + text[b : b + WINDOW]
        yield _classes_at(char_classes(near[:WINDOW]), 0), _tags_at([(kind, a - lead, a - lead + len(other))], 0)


class Finder:
    """Spans of texts: those of the rules, and those that the network adds."""

    def __init__(self, model: Tagger | None):
        self.model = model

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        out: list[list[Span]] = [[] for _ in texts]
        if self.model is None:
            return out
        places = [(k, start) for k, text in enumerate(texts) for start in window_starts(text)]
        classes = {k: char_classes(texts[k]) for k in {k for k, _ in places}}
        ends = [i for i in range(1, len(places) + 1) if i == len(places) or places[i][0] != places[i - 1][0] or places[i][1] - places[i - 1][1] >= WINDOW]
        stretches = iter(ends)
        first = end = 0
        for at in range(0, len(places), BLOCK):
            part = places[at : at + BLOCK]
            scores = self.model.emissions(np.array([_classes_at(classes[k], s) for k, s in part]))
            i = at
            while i < at + len(part):
                if i == end:  # a stretch begins; it may go on over any number of blocks
                    first, end = i, next(stretches)
                    k, start = places[first]
                    size = min(places[end - 1][1] + WINDOW, len(texts[k])) - start
                    merged, depth = np.zeros((size, TAGS)), np.full(size, -1, np.int8)
                stop = min(end, at + len(part))
                self._merge(merged, depth, [s - start for _, s in places[i:stop]], scores[i - at : stop - at])
                if stop == end:
                    out[k] += self._spans(texts[k], start, merged, base[k])
                i = stop
        return out

    @staticmethod
    def _merge(out: np.ndarray, depth: np.ndarray, starts: list[int], scores: np.ndarray) -> None:
        """Puts windows into ``out``, one score row per place from the window in which it is farthest from an end."""
        own = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
        for start, rows in zip(starts, scores):
            n = min(WINDOW, len(out) - start)
            better = own[:n] > depth[start : start + n]
            out[start : start + n][better] = rows[:n][better]
            depth[start : start + n][better] = own[:n][better]

    def _spans(self, text: str, start: int, scores: np.ndarray, base: list[Span]) -> Iterator[Span]:
        tags, move = self.model.best_tags(scores), self.model.weights["move"]
        at = 0
        while at < len(tags):
            if tags[at] == 0:
                at += 1
                continue
            kind, end = (int(tags[at]) - 1) // 2, at + 1
            while end < len(tags) and tags[end] == 2 * kind + 2:
                end += 1
            inside = tags[at:end]
            odds = (scores[np.arange(at, end), inside] - scores[at:end, 0]).sum()
            steps = np.concatenate([tags[at - 1 : at], inside, tags[end : end + 1]])
            odds += move[steps[:-1], steps[1:]].sum() - move[0, 0] * (len(steps) - 1)
            a, b = start + at, start + end
            while kind == 3 and a and text[a - 1] in "(+":
                a -= 1  # a sign that opens the number belongs to it
            clear = all(b <= s or a >= e for _, s, e in base)
            if clear and odds >= MARGIN and _TRIGGER.search(text, a, b) and plausible(kind, text[a:b]):
                yield kind, a, b
            at = end

    def find(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        base = [base_spans(t) for t in texts]
        return [(b, sorted(a)) for b, a in zip(base, self.added(texts, base))]


# --- the jobs ----------------------------------------------------------------------------


def sample(plain: list[Row], marked: list[list[Row]], most: int) -> list[Row]:
    """At most ``most`` rows: a quarter plain, the rest from the kinds in turn; what one side lacks the other gets.

    A row may stand under several kinds and is taken once.
    """
    kept: dict[Row, None] = {}
    for turn in zip_longest(*marked):
        kept |= dict.fromkeys(row for row in turn if row is not None)
    n_plain = min(len(plain), max(most // 4, most - len(kept)))
    return sorted([*plain[:n_plain], *list(kept)[: most - n_plain]])


def learn(
    docs: DataFrame, most_docs: int = TRAIN_DOCS, most_windows: int = TRAIN_WINDOWS, id_col: str = "doc_id", text_col: str = "text"
) -> Tagger | None:
    """A tagger from at most ``most_windows`` labelled windows of at most ``most_docs`` documents (least id hash).

    Windows are taken by hash for each kind and for those without a span, see :func:`sample`.
    """
    source = id_and_text(docs, id_col, text_col)
    chosen = source.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            ids, places, chars, tags, kinds = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                for place, (c, t) in enumerate(examples(text, doc_id)):
                    ids.append(doc_id)
                    places.append(place)
                    chars.append(c.astype(np.uint8).tobytes())
                    tags.append(t.astype(np.uint8).tobytes())
                    kinds.append(sum(1 << int(k) for k in np.unique((t[t > 0] - 1) // 2)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(places, pa.int64()), pa.array(chars, pa.binary()), pa.array(tags, pa.binary()), pa.array(kinds, pa.int64())],
                ["doc_id", "place", "chars", "tags", "kinds"],
            )

    made = source.join(F.broadcast(chosen), "doc_id").mapInArrow(run, "doc_id long, place long, chars binary, tags binary, kinds long")
    made = settled(made.withColumn("hash", F.xxhash64("chars", "doc_id")))
    order = ["hash", "chars", "tags", "doc_id", "place"]

    def least(rows: DataFrame) -> list[Row]:
        return rows.select(*order).orderBy(*order).limit(most_windows).collect()

    rows = sample(least(made.filter("kinds = 0")), [least(made.filter(F.col("kinds").bitwiseAND(1 << k) > 0)) for k in range(len(KINDS))], most_windows)
    chars, tags = (np.array([np.frombuffer(bytes(r[c]), np.uint8) for r in rows]).reshape(len(rows), WINDOW).astype(np.int64) for c in ("chars", "tags"))
    return train(chars, tags)


def find_personal_data(docs: DataFrame, model: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` per row; spans are ``kind, start, end, base``, by kind, then start.

    Places count code points, ends excluded. ``base`` marks the rules' spans; the network
    adds only spans that overlap none of these. Null and empty texts have no spans, a null
    id stays null, repeated rows each give a row; an empty table gives none. Narrow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in text_slices(batches):
            spans = [
                [{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in sorted([(*s, True) for s in base] + [(*s, False) for s in added])]
                for base, added in finder.find(texts_of(batch))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean>>"
    )


def redact(docs: DataFrame, model: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by its kind in brackets; other columns stay.

    Where spans of several kinds overlap, their union is replaced, named after the first.
    Null texts stay null and empty ones empty; texts of any length are read whole; repeated
    rows each come out alike. An empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        for batch in text_slices(batches, text_col):
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            found = finder.find([t or "" for t in texts])
            clean = [None if t is None else _replaced(t, base + added) for t, (base, added) in zip(texts, found)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def _replaced(text: str, spans: list[Span]) -> str:
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]
