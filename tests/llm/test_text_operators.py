"""Tokenizer, packing, quality and personal-data operators on small tables and hard texts."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adjudica.llm import bpe, counts, packing, pii, quality

RANKS, GPT, WORDS = (P.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json"))
TEXTS = [
    None, "", " ", "a  b", "a   b\n \nc ", "it's <|endoftext|> x<|endoftext|>", "\x1c\x1d a\x85b  c", "日本 語 🎉🎉 ñandú",
    "aaaa" * 3000, "x \n", " \t z", "12 345 ٣٤ 4.5", "İstanbul ΣΑΣ straße. É, don't", "same text", "same text",
    "word " * 9000, "K Å", "z" * 5001,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else None, t, "x", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens int")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_encoding_equals_the_library_and_decodes(docs):
    encoded = bpe.encode_documents(docs, RANKS, P.PATTERN)
    rows = by_id(bpe.decode_documents(encoded, RANKS, P.PATTERN))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        row = rows[i if i != 3 else None]
        assert np.frombuffer(bytes(row["ids"]), "<u4").tolist() == own.encode_ordinary(text or "")
        assert bytes(row["decoded"]) == (text or "").encode()


def test_perfect_hash_is_minimal():
    keys = list(bpe.read_ranks(RANKS))[::50]
    table = bpe.PerfectHash(keys)
    assert sorted(table.slot_key.tolist()) == list(range(len(keys)))
    assert table.find(keys).tolist() == list(range(len(keys)))


def test_counts_equal_the_library_at_every_cut(docs):
    rows = by_id(counts.count_tokens(docs, GPT, P.PATTERN, limit=5))
    model = Tokenizer.from_file(GPT)
    size = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    for i, text in enumerate(TEXTS):
        row, text = rows[i if i != 3 else None], text or ""
        assert row["n_tokens"] == size(text) and row["n_bytes"] == len(text.encode())
        assert row["over_limit"] == (row["n_tokens"] > 5)
        assert row["fit_bytes"] <= row["n_bytes"]
    count = counts.counter(GPT, P.PATTERN)
    for piece in (" thouinor", "aaaaaaaaaaaa", "überß"):
        got = count.prefix_counts(piece.encode())
        whole = [k for k in range(1, len(piece) + 1)]
        assert [got[len(piece[:k].encode())] for k in whole] == [size(piece[:k]) for k in whole]


def test_longest_prefix_within_a_limit_equals_the_library():
    """Every cut of texts full of white space, contractions, joined signs and special strings."""
    model, count, source = Tokenizer.from_file(GPT), counts.counter(GPT, P.PATTERN), random.Random(7)
    parts = [
        " ", "  ", "\n", "\n\n", " \t", "a", "they're", "don't", "'", "'v", "!", "!!!", "<|endoftext|>", "<|endo", "é", "日本",
        "12", "antidisestablishment", "=" * 9, " " * 15, "\x1c", "\x85", "🎉", " the", "\u3000",
    ]
    size = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    for _ in range(400):
        text = "".join(source.choices(parts, k=source.randint(1, 9)))
        (units, ends), = count.running([text])
        sizes = [size(text[:n]) for n in range(len(text) + 1)]
        assert ends[-1] == sizes[-1]
        for limit in range(0, sizes[-1] + 1):
            longest = max(n for n, held in enumerate(sizes) if held <= limit)
            assert count.fits(units, ends, limit) == len(text[:longest].encode()), (text, limit)


def check_pieces(rows, docs_ids, size):
    for doc, ids in docs_ids.items():
        at = 0
        for r in sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids[at : at + r["length"]]
            at += r["length"]
        assert at == len(ids)
    windows = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert r["offset"] == windows.get(r["sequence_id"], 0)
        windows[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n == size or n & (n - 1) == 0 for n in windows.values())


def test_packing_keeps_every_token_once(spark):
    texts = [t for t in TEXTS if t is not None]
    model = Tokenizer.from_file(WORDS)
    df = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "doc_id bigint, text string").repartition(3)
    rows = packing.pack_documents(df, WORDS, size=64, max_open=3).collect()
    ids = {i: model.encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts)} | {99: [2]}
    check_pieces(rows, ids, 64)


def test_squares_rule_takes_the_level_of_least_sum():
    packer = packing.SquaresPacker(10)
    source = np.random.default_rng(0)
    for _ in range(300):
        length = int(source.integers(1, 10))
        best = {}
        for level in [0, *np.flatnonzero(packer.counts[: 11 - length])]:
            after = packer.counts.copy()
            if level:
                after[level] -= 1
            if level + length < 10:
                after[level + length] += 1
            best[int(level)] = int((after**2).sum())
        assert best[packer.level_for(length)] == min(best.values())
        list(packer.put(packing.Window([(0, 0, length, b"\0\0\0\0" * length)])))


def test_open_windows_are_packed_on_by_the_rule(spark):
    """Pieces of several tasks share windows, and few of them are cut anew."""
    source = np.random.default_rng(4)
    texts = [" ".join(["word"] * int(source.integers(1, 60))) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    rows = packing.pack_documents(df, WORDS, size=64).collect()
    check_pieces(rows, {i: [2653] * (len(t.split())) + [2] for i, t in enumerate(texts)}, 64)
    pieces = Counter(r["doc_id"] for r in rows)
    cut = sum(n > 1 for n in pieces.values())
    assert cut < 0.2 * len(texts)
    packer = packing.SquaresPacker(10, 2)
    windows = [packing.Window([(k, 0, n, b"\0\0\0\0" * n)]) for k, n in enumerate((9, 8, 7))]
    assert [w for window in windows for w in packer.put(window)] == [windows[0]]  # the fullest leaves


def test_quality_separates_and_defines_hard_cases(spark):
    good = [f"The {w} of the {v} is here, and it was seen by all. Then {v} went on." for w in ("dog", "tree") for v in map(str, range(40))]
    bad = [f"w{v} " * 60 for v in range(40)] + [f"BUY{v}!! NOW!! CHEAP{v}!!" * 9 for v in range(40)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(900, None), (901, ""), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame(
        [(i, int(i < 80), 0) for i in range(160)] + [(5, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    model = quality.learn(df, labels)
    got = by_id(quality.score_documents(df, model))
    for i in range(160):
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["predicted"] == int(i < 80) == int(got[i]["score"] >= 0.3)
    assert got[900]["score"] == got[901]["score"] and 0 <= got[900]["score"] <= 1
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns and kept.filter("doc_id < 160").count() == 80
    lone = quality.learn(df, labels.filter("quality = 1"))
    assert len({r["score"] for r in quality.score_documents(df, lone).collect()}) == 1
    assert quality.score_documents(df.limit(0), lone).count() == 0


def test_rules_keep_the_limits():
    text = "a@b@c.d.e x@y..z 1.2.3.4.5 1.1.1 01.002.255.256 @x.y a.b@c-d.e, +1 (743) 555-3824 x 4111 1111 1111 1111 x 4111111111111112, 4111-1111-1111-1111 4111111111111111"
    found = [(pii.KINDS[k], text[a:b]) for k, a, b in pii.base_spans(text)]
    assert found == [
        ("email", "b@c.d.e"), ("email", "a.b@c-d.e"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"),
        ("phone", "+1 (743) 555-3824"),
    ]  # the last run of digits, spaces and hyphens is too long for a card as a whole
    assert pii.base_spans("x" * 200_000 + "@" + "1" * 200_000) == []


def spans_by_patterns(text):
    """The four rules as their patterns state them."""
    digits = lambda found: [int(c) for c in found if c.isdigit()]

    def luhn(numbers):
        doubled = [sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(numbers))]
        return sum(doubled) % 10 == 0

    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: max(map(int, t.split("."))) <= 255),
        (r"[0-9]([\x20-]?[0-9])+", lambda t: 16 <= len(digits(t)) <= 19 and luhn(digits(t))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 8 <= len(digits(t)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, (rule, holds) in enumerate(rules) for m in re.finditer(rule, text) if holds(m.group())]


def test_rules_equal_their_patterns_on_random_texts():
    source, found = random.Random(11), [0] * 4
    parts = [
        "a", "b.c", "@", "@", ".", "-", " ", "+", "+1", "(", ")", "0", "7", "12", "255", "256", "007", "1.2.3", "4111111111111111",
        "4111 1111-1111 1111", "555-3824", "%", "\n", "é", "٣", "x@y.z", "1.2.3.4", "  ", "--", "+49 30 1234567",
    ]
    for _ in range(20_000):
        text = "".join(source.choices(parts, k=source.randint(1, 14)))
        want = spans_by_patterns(text)
        assert pii.base_spans(text) == want, text
        for kind, _, _ in want:
            found[kind] += 1
    assert min(found) > 200


@pytest.mark.parametrize("shrink, ridge", [(0.0, 0.1), (0.3, 0.01), (1.0, 0.001)])
def test_discriminant_equals_densities_by_inverse_and_determinant(shrink, ridge):
    source = np.random.default_rng(8)
    values = source.normal(size=(120, 6)) @ source.normal(size=(6, 6)) + 3
    labels = (values[:, 0] + source.normal(size=120) > 3).astype(int)
    model = quality._densities(values, labels, shrink, ridge)
    low, high = np.quantile(values, [0.001, 0.999], axis=0)
    x = np.minimum(np.maximum(values, low), high)
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    own = {k: np.cov(x[labels == k], rowvar=False, bias=True) for k in (0, 1)}
    pooled = sum((labels == k).mean() * own[k] for k in (0, 1))
    log_density = {}
    for k in (0, 1):
        covariance = (1 - shrink) * own[k] + shrink * pooled
        covariance = (1 - ridge) * covariance + ridge * (covariance.trace() / 6 + 1e-6) * np.eye(6)
        away = x - x[labels == k].mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(covariance), away)
        prior = ((labels == k).sum() + 1) / (len(labels) + 2)
        log_density[k] = np.log(prior) - 0.5 * np.log(np.linalg.det(covariance)) - 0.5 * distance
    assert np.allclose(model.difference(values), log_density[1] - log_density[0], rtol=1e-8, atol=1e-8)


def test_gradients_of_the_tagger():
    source = np.random.default_rng(3)
    model = pii.Tagger.fresh()
    windows, tags = source.integers(0, 90, (3, 7)), source.integers(0, pii.TAGS, (3, 7))
    _, grads = model.gradients(windows, tags)
    for name, weight in model.weights.items():
        at = tuple(source.integers(0, n) for n in weight.shape) if name != "embed" else (windows[0, 2], 1)
        step = 1e-5
        weight[at] += step
        high = model.gradients(windows, tags)[0]
        weight[at] -= 2 * step
        low = model.gradients(windows, tags)[0]
        weight[at] += step
        assert grads[name][at] == pytest.approx((high - low) / (2 * step), rel=1e-3, abs=1e-6), name


def test_personal_data_is_found_and_redacted(spark):
    rows = [(i, f"word{'s' * (i % 5)} and me{i}@mail.org or +1 ({200 + i}) 555-{1000 + i} so on") for i in range(120)]
    rows += [(900, None), (901, ""), (902, "plain words only"), (None, "10.0.0.1")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("spans", F.lit(1))
    model = pii.learn(df, most_windows=300)
    assert model is not None
    got = by_id(pii.find_personal_data(df, model))
    assert len(got) == len(rows)
    for i, text in rows[:120]:
        spans = got[i]["spans"]
        assert [(s["kind"], text[s["start"] : s["end"]]) for s in spans if s["base"]][0] == ("email", f"me{i}@mail.org")
    assert got[900]["spans"] == got[901]["spans"] == got[902]["spans"] == []
    clean = pii.redact(df, model)
    assert clean.columns == df.columns
    assert clean.filter("text LIKE '%@%'").count() == 0
    assert by_id(clean)[902]["text"] == "plain words only" and by_id(clean)[900]["text"] is None
    assert pii.learn(df.filter("doc_id = 902")) is None


def test_network_learns_forms_that_rules_miss():
    texts = [f"so {i} the word +1 ({200 + i}) 555-{1000 + i} ended and it was" for i in range(150)]
    pairs = [e for i, t in enumerate(texts) for e in pii.examples(t, i)]
    model = pii.train(np.array([c for c, _ in pairs]), np.array([t for _, t in pairs]), steps=250)
    finder = pii.Finder(model)
    text = "so on the word (943) 555-3824 ended and it was"
    (base, added), = finder.find([text])
    assert base == [] and [text[a:b] for _, a, b in added] == ["(943) 555-3824"]


def test_a_long_stretch_is_decoded_once(monkeypatch):
    text = "17, 4 apples; 2026-01-05 " * 6000  # over 4,096 windows with digits, one stretch
    sizes, best = [], pii.Tagger.best_tags
    monkeypatch.setattr(pii.Tagger, "best_tags", lambda self, scores: (sizes.append(len(scores)), best(self, scores))[1])
    finder = pii.Finder(pii.Tagger.fresh())
    alone = finder.find([text])
    assert sizes == [len(text)]
    assert finder.find(["1 a " * 5000, text])[1:] == alone


def test_rare_kinds_are_in_the_sample(spark, monkeypatch):
    rows = [(i, f"{i} {i * 7} {i * 13}") for i in range(3000)] + [(9000, "write to ann.lee@example.org"), (9001, "call +1 (202) 555-0143 now")]
    seen = []
    monkeypatch.setattr(pii, "train", lambda windows, tags: seen.append(tags))
    pii.learn(spark.createDataFrame(rows, "doc_id long, text string"), most_windows=40)
    (tags,) = seen
    assert len(tags) == 40
    assert {1, 7} <= set(np.unique(tags).tolist())  # an e-mail and a phone number begin


def test_sample_fills_its_bound():
    plain, mails, cards = ([(n, k) for k in range(50)] for n in "abc")
    got = pii.sample(plain, [mails, [], cards, mails[:5]], 40)
    assert [sum(r[0] == n for r in got) for n in "abc"] == [10, 15, 15]
    assert len(pii.sample(plain, [mails[:3]], 40)) == 40 and len(pii.sample(plain[:2], [mails, cards], 40)) == 40
