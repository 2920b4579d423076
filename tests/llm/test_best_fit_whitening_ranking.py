"""Best-fit packing, whitening and ranked search against brute force."""

import math
import random
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from adjudica.llm import bestfit, packing, ranked, ranking, whitening

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def fewest(items, size):
    """The least number of windows, by search."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(items):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= items[at]}:
            other = list(rooms)
            other.remove(room)
            place(at + 1, [*other, room - items[at]])
        place(at + 1, [*rooms, size - items[at]])

    if items:
        place(0, [])
    return best[0]


def windows_of(plan):
    return sum(f.windows for f in plan)


def test_reduction_costs_no_window():
    source, fixed_some = random.Random(3), 0
    for _ in range(400):
        size = source.choice([10, 12, 20, 30])
        low = source.choice([1, 1, size // 5, size // 4 + 1])
        items = [source.randint(max(low, 1), size) for _ in range(source.randint(0, 9))]
        counts = np.bincount(items, minlength=size + 1).astype(np.int64)
        fixed = bestfit.reduce_by_dominance(counts, size)
        rest = np.repeat(np.arange(size + 1), counts).tolist()
        fixed_some += bool(fixed)
        assert windows_of(fixed) + fewest(rest, size) == fewest(items, size)
        assert windows_of(bestfit.plan_windows(Counter(items), size)) <= fewest(items, size) + 1
    assert fixed_some > 300


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    size = [64, 50, 7, 1][seed]
    counts = {length: int(rng.integers(0, 40)) for length in range(1, size + 1)}
    plan = bestfit.plan_windows(counts, size)
    places = bestfit.Places.of(plan, size)
    taken = np.zeros((windows_of(plan), size), int)
    for length, n in counts.items():
        for window, offset in zip(*places.find(np.full(n, length), np.arange(n))):
            taken[window, offset : offset + length] += 1
    used = taken.sum(axis=1)
    assert taken.max() == 1 and (used > 0).all() and (taken[:, 0] == 1).all()
    assert all(row[:n].all() for row, n in zip(taken, used))  # gapless from 0
    plain = np.array([0, *counts.values()], np.int64)
    assert len(used) <= windows_of(bestfit.best_fit(plain, size))  # the reduction never costs


TEXTS = ["plain words here. " * 40, "", None, "a", "a", "x" * 9000, " \n\t " * 50, "<|endoftext|> in a text", "Ünï çø 中文 кот ẞ", "word " * 3000]


def test_best_fit_packing(spark):
    rows = [(i if i != 4 else None, t, "k", 7) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "k", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, piece string, length bigint").repartition(3)
    size = 64
    got = bestfit.pack_best_fit(docs, BYTES, public_tokenizers.PATTERN, size=size).collect()
    model = Tokenizer.from_file(BYTES)
    want = Counter()
    for doc, text, *_ in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % size + 1
        cuts = [0, *range(first, len(ids) + 1, size)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, piece, a, b - a, array("I", ids[a:b]).tobytes()] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in got) == want
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) for r in got)
    by_window = {}
    for r in got:
        by_window.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_window.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert len(by_window) <= math.ceil(sum(r["length"] for r in got) / size) + 1
    assert bestfit.pack_best_fit(docs.limit(0), BYTES, public_tokenizers.PATTERN).count() == 0


def test_bulk_ids_equal_the_tokenizer():
    source = random.Random(5)
    signs = "abcdeEXYZ  .,'\n\t0123é中кßǅ\u0085  　😀'st"
    texts = ["".join(source.choices(signs, k=source.randint(0, 60))) for _ in range(3000)] + [" " * 200_000, "ab" * 50_000]
    model, coder = Tokenizer.from_file(BYTES), ranked.text_coder(BYTES, public_tokenizers.PATTERN)
    for text in texts:
        assert coder.encode(text) == array("I", model.encode(text, add_special_tokens=False).ids).tobytes()
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coder = ranked.WordCoder(model)
    parts = ["".join(source.choices("abcdeXYZéÑüßøÿªµº²¼0123.,!'stmd<|>_-\\[`×÷¿Įį", k=source.randint(1, 25))) for _ in range(20_000)]
    parts += ["don't", "IT'S", "x'LL", "<|end", "a<|endoftext|>b"]
    plain = [p for p in parts if coder.plain(p)]
    assert len(plain) == len(parts) - 1 and not any(map(coder.plain, ("", "a b", "中", "İ", "e\u0301", "\x85", "a\xa0b", "\x00", "\x01")))
    assert coder.encode(plain) == [array("I", e.ids).tobytes() for e in model.encode_batch_fast(plain, add_special_tokens=False)]
    every = [chr(c) for c in range(33, 0x130) if coder.plain(chr(c))]
    assert coder.encode(every) == [array("I", e.ids).tobytes() for e in model.encode_batch_fast(every, add_special_tokens=False)]
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["".join(source.choices("abXé. ,'\n\t\x1c\x1f\x85\xa0\u2003\u0301中0", k=source.randint(0, 40))) for _ in range(3000)]
    assert encoder.encode(texts) == [array("I", e.ids).tobytes() for e in model.encode_batch_fast(texts, add_special_tokens=False)]


def whitened_by_hand(vectors, components, weights=None):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors])
    fit, copies = np.unique(x, axis=0, return_counts=True)
    weights = np.ones(len(fit), int) if weights is None else copies
    n, sums = int(weights.sum()), weights @ fit
    centred = (fit * n - sums) / n
    values, axes = np.linalg.eigh((weights[:, None] * centred).T @ centred / n)
    order = np.argsort(-values)[:components]
    return n, ((x * n - sums) ** 2).sum(1), ((x * n - sums) / n) @ (axes[:, order] / np.sqrt(values[order])), values[order] / values.sum()


@pytest.mark.parametrize("by_count", [False, True])
def test_whitening(spark, by_count):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.2, (60, 6)) * np.arange(1, 7)
    vectors[20:40] = vectors[0]  # a third of all rows is one vector
    rows = [(i, v.tolist(), "s") for i, v in enumerate(vectors)]
    odd = [(90, None, "s"), (91, [1.0, None, 1.0, 1.0, 1.0, 1.0], "s"), (92, [float("nan")] * 6, "s"), (93, [float("inf")] * 6, "s"), (94, [], "s")]
    table = spark.createDataFrame(rows + odd + [(5, vectors[5].tolist(), "s"), (None, vectors[6].tolist(), "s")], "vec_id bigint, embedding array<double>, size string")
    got = whitening.whiten(table, components=4, by_count=by_count).collect()
    every = np.vstack([vectors, vectors[5], vectors[6]])
    n, deviation, whitened, explained = whitened_by_hand(every, 4, by_count or None)
    assert len(got) == len(every) * 4
    signs = {}
    for r in got:
        at = 61 if r["vec_id"] is None else r["vec_id"]
        value, want = r["whitened"], whitened[at, r["component"] - 1]
        sign = signs.setdefault(r["component"], np.sign(value * want) or 1.0)
        assert value == pytest.approx(sign * want, abs=1e-9) and r["deviation"] == deviation[at] and r["n"] == n
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9) and r["identity_error"] < 1e-9


def test_whitening_of_odd_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], schema)).count() == 0  # no variance
    rows = [(i, [float(i), float(i % 3)]) for i in range(6)] + [(10 + i, [float(i % 2)] * 3) for i in range(4)]
    got = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert {(r["vec_id"] >= 10, r["n"], r["component"]) for r in got} == {(False, 6, 1), (False, 6, 2), (True, 2, 1)}
    wide = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 5.0])]
    assert {r["deviation"] for r in whitening.whiten(spark.createDataFrame(wide, "vec_id bigint, embedding array<double>")).collect()} == {2**63 - 1} | {
        r["deviation"] for r in whitening.whiten(spark.createDataFrame(wide, "vec_id bigint, embedding array<double>")).collect() if r["vec_id"] == 3
    }


def ranked_by_hand(docs, items, k):
    found = [(doc, Counter(ranking.terms_of(text))) for doc, text in docs]
    found = [(doc, c) for doc, c in found if c]
    documents, length = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, asked in items.items():
        scores = []
        for doc, c in found:
            m = 25 + 75 * sum(c.values()) * documents // length
            score = sum(n * ranking.term_weight(documents, df[t]) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, n in asked.items() if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("postings", [40, 1_000_000])
def test_ranked_search(spark, postings, monkeypatch):
    monkeypatch.setattr(ranking, "FIRST_READ", 2)
    source = random.Random(9)
    words = ["the", "The", "über", "x1", "ab-cd", "a b", "中文", *(f"w{i}" for i in range(30))]
    docs = [(i, " ".join(source.choices(words, weights=[30, 9, *[3] * 35], k=source.randint(0, 25)))) for i in range(300)]
    docs += [(400 + i, "the copy w1 w2") for i in range(60)] + [(7, "the copy w1 w2"), (None, "the copy w1 w2"), (500, None), (501, "--- !"), (502, "w3 " * 5000)]
    items = [(1, "the W1 copy copy"), (2, "w3 über 中文 cd ab"), (3, None), (4, "unknown"), (5, "w3"), (5, "w4 w4"), (None, "x1 a b")]
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(ranking.terms_of(text))
    table = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id bigint, text string, item_id bigint, rank int").repartition(5)
    queries = spark.createDataFrame([(*i, 3) for i in items], "item_id bigint, text string, doc_id bigint")
    want = ranked_by_hand(docs, asked, 10)
    got = ranking.rank_documents(table, queries, postings=postings)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    monkeypatch.setattr(ranking, "ITEM_BLOCK", 3)
    assert sorted(map(tuple, ranking.rank_documents(table, queries, postings=postings).collect()), key=str) == want
    assert ranking.rank_documents(table.limit(0), queries).count() == 0 == ranking.rank_documents(table, queries.limit(0)).count()


def test_search_stops_before_the_end_of_the_lists():
    """One document far above the others: the rest of long lists is not read."""
    rng = np.random.default_rng(0)
    n = 5000
    starts, terms = np.arange(0, 2 * n + 1, 2), np.tile([0, 1], n)
    impacts = rng.permutation(np.arange(1, 2 * n + 1)) + 0
    impacts[:20] += 10**6
    block = ranking.Block(starts, terms, impacts, 2)
    rows, scores = block.best(ranking.Query(np.array([0, 1]), np.array([1, 2])), 10, 0)
    full = impacts.reshape(-1, 2) @ [1, 2]
    assert set(np.argsort(-full)[:10]) <= set(rows.tolist()) and len(rows) < 100
    assert all(full[r] == s for r, s in zip(rows, scores))
