"""Deduplication, search, archives and the pipeline against brute force."""

import hashlib
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from adjudica.llm import components, exact, near, suffixes, topk, warc
from adjudica.llm.base import Memo, spread

EXTRA = "doc_id bigint, text string, kept string, digest string, uid bigint"


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", "d", 7) for r in rows], EXTRA)


def test_exact_copies(spark):
    rows = [(5, "a b"), (2, "ab"), (7, "a  b"), (3, "c"), (9, None), (1, ""), (4, " \n"), (None, "c"), (8, "ab c"), (6, "a b")]
    got = {r["doc_id"]: r for r in exact.exact_duplicates(table(spark, rows)).collect()}
    assert {d: (r["keep_id"], r["group_size"], r["kept"]) for d, r in got.items()} == {
        5: (7, 3, False), 2: (7, 3, False), 7: (7, 3, True), 3: (3, 2, True), None: (3, 2, False),
        9: (4, 3, False), 1: (4, 3, False), 4: (4, 3, True), 8: (8, 1, True), 6: (6, 1, True),
    }
    assert got[5]["text_sha256"] == hashlib.sha256(b"ab").hexdigest()
    kept = exact.drop_exact_copies(table(spark, [*rows, (7, "a  b")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 6, 7, 8] and kept.columns == table(spark, rows).columns
    assert exact.exact_duplicates(table(spark, rows).limit(0)).count() == 0


def test_full_filter_only_costs_shuffle(spark, monkeypatch):
    monkeypatch.setattr(exact, "MOST_BITS", 64)
    rows = [(i, f"text {i % 150}") for i in range(200)]
    got = exact.exact_duplicates(table(spark, rows).repartition(5)).collect()
    assert {r["doc_id"]: r["keep_id"] for r in got} == {i: i % 150 for i in range(200)}


@pytest.mark.parametrize("share", [1, 1000])
def test_spread_join_equals_plain_join(spark, share):
    rows = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(100)], "i bigint, k bigint")
    summary = rows.filter("k < 5").groupBy("k").agg(F.count("*").alias("n"))
    for how in ("inner", "left"):
        got = spread(rows, summary, "k", "n", 100, by="i", how=how, hot_share=share).select("i", "n")
        want = rows.join(summary, "k", how).select("i", "n")
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_memo_has_two_generations():
    memo = Memo(2)
    for units in ({"a", "b", "c"}, {"a", "d"}):
        memo.update((u, u) for u in memo.missing(units))
    assert set(memo) == {"a", "d"} and memo.missing({"b"}) == [] and memo.missing({"z"}) == ["z"]


def brute_repeats(docs, length):
    seen, out = set(), []
    for text in docs:
        raw, gone = (text or "").encode(), bytearray(len((text or "").encode()))
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def noisy_texts(n, seed):
    source = random.Random(seed)
    passages = ["".join(source.choices("abcdé \n", k=source.randint(30, 260))) for _ in range(12)]
    out = []
    for _ in range(n):
        parts = [source.choice(passages) if source.random() < 0.6 else "".join(source.choices("xyz ", k=40)) for _ in range(source.randint(0, 6))]
        out.append("".join(parts))
    return out + ["ab" * 300, "a" * 700, "", None, passages[0], passages[0]]


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_bytes_equal_brute_force(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(suffixes, "SAMPLE", 1)
        monkeypatch.setattr(suffixes, "HOT_LEAST", 3)
    monkeypatch.setattr(suffixes, "CHUNK", 300)
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 3000)
    texts = noisy_texts(60, 1)
    df = table(spark, list(enumerate(texts))).repartition(4)
    got = {r["doc_id"]: r for r in suffixes.remove_repeats(df, length=40, anchor=20).collect()}
    for i, want in enumerate(brute_repeats(texts, 40)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == want


def test_repeated_and_null_ids_are_taken_in_order(spark):
    text = "".join(random.Random(5).choices("abcdef", k=300))
    df = table(spark, [(2, text), (2, text), (None, text), (1, None)])
    got = sorted((r["n_bytes"], r["n_removed"]) for r in suffixes.remove_repeats(df).collect())
    assert got == [(0, 0), (300, 0), (300, 300), (300, 300)]
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


def test_suffix_sort_equals_sorted():
    source = np.random.default_rng(2)
    data = source.integers(97, 100, 400).astype(np.uint8)
    start = source.integers(0, 380, 120)
    size = np.minimum(source.integers(1, 30, 120), 400 - start)
    group = np.sort(source.integers(0, 5, 120))
    order = suffixes.Suffixes(data, start, size).sorted(group)
    key = [(group[i], data[start[i] : start[i] + size[i]].tobytes(), i) for i in range(120)]
    assert order.tolist() == sorted(range(120), key=key.__getitem__)


@pytest.mark.parametrize("collide", [False, True])
def test_colliding_hashes_are_settled_by_bytes(monkeypatch, collide):
    """With a and b of equal hash every comparison may go wrong; the order and the repeats stay right."""
    source = np.random.default_rng(4)
    if collide:
        weak = suffixes.Polynomial(1)
        weak.value = weak.value.copy()
        weak.value[ord("b")] = weak.value[ord("a")]
        monkeypatch.setattr(suffixes, "_polynomials", lambda: (weak, weak))
    data = source.choice(np.frombuffer(b"aabbc", np.uint8), 600)
    start, group = np.sort(source.integers(0, 550, 200)), np.sort(source.integers(0, 9, 200))
    size = np.minimum(source.integers(0, 40, 200), 600 - start)
    order, near = suffixes.Suffixes(data, start, size).checked(group)
    strings = [data[a : a + n].tobytes() for a, n in zip(start, size)]
    assert order.tolist() == sorted(range(200), key=lambda i: (group[i], strings[i], i))
    for k in range(1, 200):
        if group[k] == group[k - 1]:
            x, y = strings[order[k - 1]], strings[order[k]]
            assert near[k] == next((m for m, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))

    length, anchor = 40, 20
    shared = [source.choice(np.frombuffer(b"ab", np.uint8), 20).tobytes() for _ in range(3)]
    sides = [source.choice(np.frombuffer(b"ab", np.uint8), 20).tobytes() for _ in range(4)]
    rows, pieces = [], []
    for uid in range(60):
        h = int(source.integers(0, 3))
        cuts = [bytearray(sides[int(source.integers(0, 4))]) for _ in range(2)]
        for cut in cuts:
            cut[int(source.integers(0, 20))] = ord("a")
        rows.append((h, uid, 0, length - anchor + 1, length - anchor))
        pieces.append(bytes(cuts[0]) + shared[h] + bytes(cuts[1]))
    rows, flat = np.array(rows, suffixes.REQUEST), np.frombuffer(b"".join(pieces), np.uint8)
    marks = suffixes.repeated_windows(rows, flat, np.arange(60) * 60, length)
    seen, want = set(), set()
    for uid, piece in enumerate(pieces):
        for at in range(21):
            window = (rows["h"][uid], at, piece[at : at + length])
            if window in seen:
                want.add((uid, at))
            seen.add(window)
    assert {(int(m["uid"]), int(m["start"])) for m in marks} == want and want


def brute_components(texts, words, per_cent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(texts):
        for j in sorted(texts):
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= per_cent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {i: (len(sets[i]), find(i)) for i in texts}


@pytest.mark.parametrize("chunk", [1000, 8])
def test_near_copies_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(near, "CHUNK", chunk)
    source = random.Random(4)
    base = [[source.choice("abcdefghijklmnop") + str(source.randint(0, 60)) for _ in range(source.randint(8, 60))] for _ in range(6)]
    texts = {}
    for i in range(90):
        w = list(source.choice(base))
        for _ in range(source.randint(0, 4)):
            w[source.randrange(len(w))] = f"n{source.randint(0, 9)}"
        texts[i] = " ".join(w) if i % 11 else " ".join(w).upper()
    texts |= {200: None, 201: "", 202: "one", 203: "ONE", 204: " \n", 205: texts[3], 206: "a b"}
    got = near.link_components(table(spark, list(texts.items())), near.Similarity(words=2)).collect()
    want = brute_components(texts, 2, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def members_of(similar, marks, home=(True, True), depth=1):
    short = np.zeros((2, near.BINS), np.uint8)
    short[1, similar:] = 1
    return near.Cell(np.arange(2), np.array([10, 10]), short, np.array(marks, np.uint32), np.array(home), 2, depth)


def test_a_pair_belongs_to_the_first_band_in_which_it_agrees():
    def meets(cell):
        return [(at, other.tolist()) for at, other in cell.partners(near.Similarity())]

    here, before = [[1, 2, 3], [4, 5, 3]], [[1, 2, 3], [4, 2, 3]]
    assert meets(members_of(120, here)) == [(1, [0])] == meets(members_of(120, before, depth=2))
    assert meets(members_of(120, before)) == [] == meets(members_of(70, here))
    assert meets(members_of(120, here, (False, False))) == []


@pytest.fixture
def one_family():
    source = random.Random(6)
    base = [f"w{source.randint(0, 999)}" for _ in range(120)]

    def texts(n):
        out = {}
        for i in range(n):
            w = list(base)
            for _ in range(source.randint(0, 4)):
                w[source.randrange(len(w))] = f"n{source.randint(0, 10**6)}"
            out[i] = " ".join(w)
        return out

    return texts


def test_work_on_one_hot_group_grows_with_its_size(spark, one_family, monkeypatch):
    monkeypatch.setattr(near, "CHUNK", 60)
    dealt, linked = {}, {}
    real_cells, real_merged = near._cells, near._merged
    monkeypatch.setattr(near, "_cells", lambda rows: (lambda f: dealt.setdefault(n, []).append((rows.count(), f.count())) or f)(real_cells(rows)))
    monkeypatch.setattr(near, "_merged", lambda labels, links: linked.setdefault(n, []).append(links.count()) or real_merged(labels, links))
    for n in (150, 300, 600):
        got = near.link_components(table(spark, list(one_family(n).items())), near.Similarity(words=2))
        assert got.select("component_id").distinct().count() <= 3
    for n, rounds in dealt.items():
        assert all(cells <= 2 * rows for rows, cells in rounds)  # visitors at most double a bucket
        assert sum(linked[n]) <= sum(rows for rows, _ in rounds)
    work = {n: sum(cells for _, cells in rounds) for n, rounds in dealt.items()}
    assert all(cells <= 40 * n for n, cells in work.items())


def test_sets_beyond_the_bound_are_made_again(monkeypatch):
    monkeypatch.setattr(near, "SETS_BYTES", 100)
    texts = ["a b c d e f g h i j k", "a b c d e f g h i j", "x y z", "a b c d e f g h i k"]
    sets = near.Sets([near.zstandard.compress(t.encode()) for t in texts], 2)
    rule = near.Similarity(words=2)
    # 9 of 10 shingles; none; 8 of 11.
    assert sets.linked(0, [1, 2, 3], rule).tolist() == [True, False, False] and len(sets.known) < 3
    assert sets.linked(2, [0, 1], rule).tolist() == [False, False]


def test_crowded_buckets_of_unlike_texts_are_refined(spark, monkeypatch):
    """Texts that share passages but are no copies, among them pairs that are."""
    monkeypatch.setattr(near, "CHUNK", 12)
    source = random.Random(2)
    shared = " ".join(f"s{i}" for i in range(40))
    texts = {}
    for i in range(90):
        own = [f"o{i}x{k}" for k in range(30)]
        texts[i] = f"{shared} {' '.join(own)}"
        if i % 9 == 0:
            own[source.randrange(30)] = "changed"
            texts[500 + i] = f"{shared} {' '.join(own)}"
    got = near.link_components(table(spark, list(texts.items())), near.Similarity(words=2)).collect()
    want = brute_components(texts, 2, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_near_copies_of_odd_tables(spark):
    df = table(spark, [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")])
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near.link_components(df, near.Similarity()).collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (None, None, True)]
    assert near.link_components(df.limit(0), near.Similarity()).count() == 0


def test_sketches_estimate_similarity():
    source = np.random.default_rng(1)
    items = source.integers(0, 1 << 63, 1000, np.uint64)
    a, b = np.unique(items[:900]), np.unique(items[100:])
    left, right, tiny = near.sketches([a, b, a[:2]])
    assert (left == right).mean() == pytest.approx(0.8, abs=0.15)
    assert (tiny != near.EMPTY).all()


def test_roots_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 150)] + [(5, 5), (149, 101)]
    got = {r["u"]: r["v"] for r in components.roots(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 150)}


def test_top_products_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    source = np.random.default_rng(8)
    rows = [(i, source.normal(0, 1, 12).round(1).tolist()) for i in range(200)]
    rows[7] = (7, rows[50][1])
    odd = [(300, None), (350, [None] * 12), (400, [float("nan")] * 12), (450, [float("inf")] * 12), (None, [1.0] * 12), (500, [1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id bigint, embedding array<float>, score int")
    whole = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in rows}
    got = {}
    for r in topk.top_inner_products(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in (0, 50, 100, 150):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)[:5]
        assert sorted(got.pop(q)) == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got == {}
    assert topk.top_inner_products(df.limit(0)).count() == 0


def test_archives_round_trip(spark, tmp_path):
    long = "<p>ü</p>" * 400
    rows = [(1, "u1", long), (2, "u2", long), (9, None, long), (3, "u3", "short"), (4, "u4", "short"), (5, "u5", None), (6, "u 6\r\n", ""), (7, "u7", "x" * 300_000), (None, "u", long)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, digest int").repartition(2)
    written = warc.write_packages(pages, str(tmp_path), package_bytes=300)
    assert written.count() > 2
    got = {r["page_id"]: r for r in warc.read_packages(written).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        payload = (html or "").encode()
        assert got[page]["payload_digest"] == hashlib.sha1(payload).hexdigest()
        assert got[page]["payload_bytes"] == len(payload)
        revisit = html == long and page != 9
        assert (got[page]["record_type"], got[page]["refers_to"]) == (("revisit", 9) if revisit else ("response", None))
        assert revisit or bytes(got[page]["payload"]) == payload
    assert warc.read_packages(warc.write_packages(pages.limit(0), str(tmp_path))).count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_directory_of_ordinary_and_zip64_files(tmp_path, monkeypatch, wide):
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as out:
        out.writestr("one", b"first member")
        out.writestr("packed", b"x" * 99, zipfile.ZIP_DEFLATED)
        out.writestr("dir/twö", b"second member, longer")
        out.comment = b"PK note"
    with open(path, "rb") as source:
        found = warc.members(source, path.stat().st_size)
        assert set(found) == {"one", "dir/twö"}
        assert warc._read(source, found["dir/twö"].start, found["dir/twö"].size) == b"second member, longer"
    (tmp_path / "bad").write_bytes(b"no archive")
    with open(tmp_path / "bad", "rb") as source, pytest.raises(ValueError):
        warc.members(source, 10)


def test_pipeline_on_the_small_tables(spark):
    import corpus_pipeline

    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, data)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, data).select("doc_id").distinct().collect()}
    assert packed == ids and 0 < len(ids) < docs.count()


def test_pipeline_stages_take_odd_tables(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, clashing columns, an empty table."""
    import corpus_pipeline

    copy = "The river rose in the night and the people of the town went up to the old church on the hill. " * 3
    rows = [
        (1, copy, "en"), (2, copy, "en"), (2, copy, "en"), (3, copy + "They stayed.", None), (4, None, None), (5, "", "en"),
        (6, "  \n ", "en"), (None, "a row without an id, but with a text of some length. " * 5, None), (None, None, None),
        (7, "word " * 60_000, "en"), (8, "write to ann@example.org or 10.0.0.1", "en"),
    ]
    clashing = ["_gone", "row", "digest", "doc", "chars", "kept", "score", "component_id", "n_shingles", "ids", "start"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").select(
        "doc_id", "text", "lang", F.char_length("text").cast("long").alias("n_chars"), *[F.lit(c).alias(c) for c in clashing]
    )
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)] + [(None, None, None)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality_classifier", "exact_dedup", "near_dedup", "personal_data"):
        out = stages[name](spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert stages[name](spark, docs.limit(0), str(tmp_path)).count() == 0, name
        if name == "exact_dedup":
            found = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.select("doc_id").collect())
            # One of the equal copies, one of all texts without a letter: the one with the most characters.
            assert found == [(False, 1), (False, 3), (False, 6), (False, 7), (False, 8), (True, 0)]
        if name == "near_dedup":
            kept = [r["doc_id"] for r in out.select("doc_id").collect()]
            assert sorted(i for i in kept if i is not None) == [1, 4, 5, 6, 7, 8] and kept.count(None) == 2
        if name == "personal_data":
            texts = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"]}
            assert texts[4] is None and texts[5] == "" and "ann@" not in texts[8] and "10.0.0.1" not in texts[8]
            assert texts[7] == "word " * 60_000
    packed = stages["packing"](spark, docs, str(tmp_path))
    assert packed.agg(F.countDistinct("doc_id")).first()[0] == 8
    assert stages["packing"](spark, docs.limit(0), str(tmp_path)).count() == 0
