"""Operators on documents against brute force, over rows with every odd case."""

from collections import Counter, defaultdict
from itertools import combinations
import zlib

import numpy as np
import pyarrow as pa
import pytest

from spanflow.llm import (
    byte_bpe, byte_cnn, bytework, common, gam, packing, positional_index, suffix_buckets, suffix_trees,
    superminhash, token_counts,
)
from spanflow.llm.queries import tokenizer
from tests.llm import data

ROWS = data.documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, data.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], data.SCHEMA)


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(205, 203), (203, 204), (7, 7)]
    from spanflow.llm.components import connected_components

    frame = spark.createDataFrame(links, "low bigint, high bigint").repartition(8)
    found = {r.id: r.component for r in connected_components(frame).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 203: 203, 204: 203, 205: 203}


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate((a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)))
    ranks = superminhash.signatures(np.concatenate((a, b, a[:1])), np.array([0, 400, 800, 801]), 512)
    assert abs((ranks[0] == ranks[1]).mean() - 0.6) < 0.08
    assert np.isfinite(ranks).all()
    assert sorted(np.floor(ranks[2]).astype(int)) == list(range(512))  # one element: a permutation of ranks
    # The early stop changes nothing: a set in one batch with others signs as alone.
    assert (superminhash.signatures(a, np.array([0, 400]), 512)[0] == ranks[0]).all()


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicate_groups(docs, width):
    sets = [(r[0], data.shingles(r[1], width)) for r in ROWS]
    groups = data.Sets()
    for (a, x), (b, y) in combinations([s for s in sets if s[0] is not None], 2):
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            groups.join(a, b)
    want = Counter((i, len(s), groups.find(i) if i is not None else None) for i, s in sets)
    assert bag(superminhash.near_duplicate_groups(docs, width=width).collect()) == want
    assert len({groups.find(i) for i, _ in sets if i is not None}) < len({i for i, _ in sets}) - 5


def test_contested_bucket_keeps_all_links(spark):
    """A chain of copies of which only neighbours are similar, all in one component."""
    words = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join([f"x{i}_{k}" if k < 3 * i else words[k] for k in range(200)][::-1])) for i in range(18)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = {i: data.shingles(t, 5) for i, t in rows}
    groups = data.Sets()
    for a, b in combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            groups.join(a, b)
    found = {r.doc_id: r.component_id for r in superminhash.near_duplicate_groups(frame).collect()}
    assert found == {i: groups.find(i) for i in sets}


def test_without_repeats(docs):
    length = 400
    texts = [(r[0], (r[1] or "").encode()) for r in ROWS]
    often = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    want = Counter()
    for i, t in texts:
        hit = data.covered(len(t), length, [p for p in range(len(t) - length + 1) if often[t[p : p + length]] > 1])
        runs = sum(h and not (k and hit[k - 1]) for k, h in enumerate(hit))
        want[i, len(t), sum(hit), runs, bytes(b for b, h in zip(t, hit) if not h)] += 1
    found = suffix_buckets.without_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == want
    assert sum(n * k[2] for k, n in want.items()) > 3000


@pytest.mark.parametrize("gram, block", [(8, 3), (20, 16), (30, 1)])
def test_repeats_of_short_strings(spark, gram, block):
    """Many short repeats over few letters, so that every refinement is reached."""
    rng = np.random.default_rng(gram)
    rows = [(i, "".join(rng.choice(["ab", "ba", "abb"], 80))) for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    often = Counter(t[p : p + 36] for _, t in rows for p in range(len(t) - 35))
    want = {}
    for i, t in rows:
        hit = data.covered(len(t), 36, [p for p in range(len(t) - 35) if often[t[p : p + 36]] > 1])
        want[i] = "".join(c for c, h in zip(t, hit) if not h)
    found = suffix_buckets.without_repeats(frame, length=36, gram=gram, block=block).collect()
    assert {r.doc_id: bytes(r.kept).decode() for r in found} == want


def test_long_texts_are_cut_into_pieces():
    text = "".join(chr(97 + k % 23) for k in range(1000))
    batch = pa.record_batch([pa.array(["", text, "short"])], names=["text"])
    pieces = list(common.segments(iter([batch]), 9, most=100))
    starts = {(int(r), int(place) + p) for rows, _, at, places, _ in pieces for k, (r, place) in enumerate(zip(rows, places)) for p in range(int(at[k + 1] - at[k]) - 9)}
    assert starts == {(1, p) for p in range(991)}


@pytest.mark.parametrize("group", [2, 50_000])
def test_without_repeated_windows(docs, group):
    width = 20
    order = sorted(range(len(ROWS)), key=lambda k: (ROWS[k][0] is not None, ROWS[k][0]))
    words = {k: WORDS(ROWS[k][1]) for k in order}
    first = {}
    for k in order:
        for p in range(len(words[k]) - width + 1):
            first.setdefault(tuple(words[k][p : p + width]), (ROWS[k][0], p))
    want = Counter()
    for k in order:
        w = words[k]
        hit = data.covered(len(w), width, [p for p in range(len(w) - width + 1) if first[tuple(w[p : p + width])] != (ROWS[k][0], p)])
        want[ROWS[k][0], len(w), sum(hit), b" ".join(x for x, h in zip(w, hit) if not h)] += 1
    found = suffix_trees.without_repeated_windows(docs, group=group).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in found) == want


def WORDS(text):
    return data.WORDS.findall((text or "").encode())


def test_contamination(spark, docs):
    import re

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    parts = ROWS[2][1].split()
    items = [(0, ROWS[5][1], "k"), (1, " ".join(parts[3:16]).upper(), "k"), (2, "one", "k"), (3, None, "k"), (4, "", "k"), (5, "!!", "k"),
             (1, " ".join(parts[3:16]), "k"), (11, "Two words", None), (None, "x", None), (12, "nowhere to be found", "k")]
    frame = spark.createDataFrame(items, "item_id int, text string, key_id string")
    windows = defaultdict(set)
    for i, t, _ in items:
        w = split(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    want = Counter()
    for r in ROWS:
        w, hit, ids = split(r[1]), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    ids |= windows[tuple(w[p : p + n])]
        want[r[0], len(w), len(hit), tuple(sorted(str(i) for i in ids if i is not None))] += 1
    for bound in (0, 200_000):  # shuffled, and broadcast
        found = positional_index.contamination(docs, frame, bound=bound).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in found) == want
    assert sum(k[2] > 0 for k in want) > 3


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b x c d"), (2, "c d a b"), (3, "a b c d"), (4, "d z z z z a b c")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b c d")], "item_id int, text string")
    hits = lambda slop: {r.doc_id for r in positional_index.contamination(docs, items, slop=slop).collect() if r.n_hit}
    assert hits(None) == {3} and hits(1) == {1, 3} and hits(4) == {1, 2, 3} and hits(9) == {1, 2, 3, 4}


def test_lists_are_intersected_before_windows_are_compared(spark):
    """A term that is the rarest of 60 windows and stands 300 times asks for each distance once."""
    rows = [(i, f"hot b{i} c{i} " + "pad " * 6 + "x") for i in range(300)] + [(300, "p0 hot q0 r0"), (301, "p1 q1 hot r1"), (302, " ".join(f"p{k} q{k} r{k}" for k in range(60) for _ in range(400)))]
    items = [(k, f"p{k} hot q{k} r{k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    tests = spark.createDataFrame(items, "item_id string, text string")
    windows = positional_index.test_windows(tests, 4)
    postings, probes = positional_index.build_index(common.with_key(docs), windows, 4, 0)
    assert probes.where("first = 'hot'").count() == 60
    found = positional_index.candidates(postings, probes, 0)
    assert found.count() < 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    hits = positional_index.contamination(docs, tests, width=4).where("n_hit > 0").collect()
    assert [(r.doc_id, r.n_hit, r.item_ids) for r in hits] == [(300, 4, ["0"])]


def test_packing(docs):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    tokens = Counter()
    for r in ROWS:
        ids = np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            tokens[r[0], start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    found = packing.packed_documents(docs, tokenizer("byte_bpe_50k.json")).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == tokens
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048
    assert sorted(sequences) == list(range(len(sequences)))


def test_least_squares_plan():
    rng = np.random.default_rng(3)
    counts = np.bincount(rng.integers(1, 257, 20_000), minlength=257)
    plan = packing.packing_plan(counts)
    used = np.zeros(257, int)
    for pattern, repeats in plan:
        assert sum(pattern) <= 256
        np.add.at(used, list(pattern), repeats)
    assert (used == counts).all()
    assert sum(r for _, r in plan) * 256 < 1.01 * (counts @ np.arange(257))
    a = rng.random((12, 40))
    x = packing.non_negative_least_squares(a, a @ np.maximum(rng.normal(size=40), 0))
    assert (x >= 0).all() and np.abs(a @ x).max() > 0
    assert packing.packing_plan(np.zeros(257, int)) == []


@pytest.mark.parametrize("text", ["", "a<|endoftext|>b", "　x  \n\n y", "İstanbul ǅ ſ", "é́ 'S don't I'LL 😀", "a\x85b \x1c", "१२ ½", "b" * 3000])
def test_byte_bpe_equals_the_library(text):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    assert byte_bpe.byte_bpe(tokenizer("byte_bpe_50k.json")).ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_counts(docs):
    path = tokenizer("word_bpe_49k.json")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    want = Counter((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in ROWS)
    assert bag(token_counts.token_counts(docs, path).collect()) == want
    assert max(n for _, n, _ in want) > 2 * token_counts.HUGE  # so chunks are spliced here
    assert bag(token_counts.token_counts(docs, path, huge_bytes=1).collect()) == want


@pytest.mark.parametrize("chunk, overlap", [(97, 4), (300, 16), (5000, 64)])
def test_chunks_resynchronise(chunk, overlap):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    spans = lambda t: library.encode(t, add_special_tokens=False).offsets
    for text in ["x" * 700 + " " + "y" * 900 + " z" * 50, " é́ " * 90 + "日本語" * 90, "<|endoftext|> a b" * 60, "", ROWS[-3][1] or "", "　Ab　c " * 99]:
        assert token_counts.encoded_in_chunks(text, spans, chunk, overlap) == spans(text)


def test_languages(spark, docs):
    rng = np.random.default_rng(2)
    tongues = {"en": ["the", "that", "with", "thing"], "de": ["über", "schön", "nicht", "ach"], "fr": ["où", "été", "que", "ça"]}
    rows = [(i, " ".join(rng.choice(tongues[lang], rng.integers(4, 60))), lang) for i in range(240) for lang in [list(tongues)[i % 3]]]
    rows += [(1000, None, "en"), (1001, "12 !", "en"), (1002, "", None), (None, "the thing", None), (5, rows[5][1], rows[5][2])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = byte_cnn.languages(frame).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    assert {by_id[k].lang_pred for k in (1000, 1001, 1002)} == {"und"}
    held = [(r.lang_pred, list(tongues)[r.doc_id % 3]) for r in found if r.held_out and r.doc_id < 240]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found if r.doc_id is not None)
    unlabelled = byte_cnn.languages(frame.withColumn("lang", common.F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def test_languages_learn_from_different_texts_of_every_language(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(byte_cnn.ByteNetwork, "fit", lambda self, x, y: seen.update(names=self.names, x=x, y=y) or self)
    rows = [(i, "the same text", "en") for i in range(700)] + [(1000 + i, f"text number {i} " * 40, "en") for i in range(40)]
    rows += [(2000 + 4 * i + k, "ab"[k % 2] * (i % 9 + 1), f"lang {i:03d}") for i in range(300) for k in range(4)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lang string, h string, n int")
    byte_cnn.fit_languages(frame, 20)
    assert len(seen["names"]) > 290 and "lang 299" in seen["names"]
    english = seen["x"][seen["y"] == seen["names"].index("en")]
    assert len(english) >= 20 and len({w.tobytes() for w in english}) > 20  # copies count once
    assert len({x.tobytes() for x in seen["x"]}) > 40 and byte_cnn.fit_languages(frame.where("false")) is None


def test_languages_of_odd_rows(spark):
    """Very long texts, an id with two texts, repeated rows and columns with clashing names."""
    rows = [(i, ["the that with " * 9, "über schön ach " * 9][i % 2] + "ab"[i % 3 == 0], ["en", "de"][i % 2], "x", 0) for i in range(80)]
    rows += [(7, "the thing that " * 40_000, None, None, None), (7, "schön", "de", None, None), rows[3], rows[3]]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, held_out string, lettered int")
    found = byte_cnn.languages(frame).collect()
    assert len(found) == len(rows) and {r.lang_pred for r in found if r.doc_id == 7} == {"en", "de"}
    assert len({(r.lang_pred, r.score) for r in found if r.doc_id == rows[3][0]}) == 1


def test_quality(spark):
    rng = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]
    good = [" ".join(rng.choice(words, rng.integers(5, 90))) for _ in range(150)]
    bad = [" ".join(w + rng.choice(["$$$", "%%%"]) for w in rng.choice(words, rng.integers(5, 90))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(None, "x"), (900, None), (901, ""), (3, good[3])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(210)] + [(2, None), (None, 1)], "doc_id bigint, quality int")
    found = gam.quality_scores(frame, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    held = [(r.predicted, int(r.doc_id < 150)) for r in found if r.held_out and r.doc_id < 210]
    assert len(held) > 20 and np.mean([a == b for a, b in held]) > 0.95
    none = gam.quality_scores(frame, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}


def test_quality_of_odd_rows(spark):
    """Very long texts, an id with two texts, repeated rows and columns with clashing names."""
    rows = [(i, ("alpha beta gamma " if i % 2 else "alpha$$$ %%% ") * (i % 7 + 3), "f", 0.5, "k") for i in range(60)]
    rows += [(5, "alpha " * 300_000, "f", None, None), (5, "%%% " * 9, "f", None, None), rows[3], rows[3], (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, features string, score double, key_text string")
    labels = spark.createDataFrame([(i, i % 2, "f") for i in range(60)] + [(5, 0, "f"), (5, 0, "f")], "doc_id bigint, quality int, features string")
    found = gam.quality_scores(frame, labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert len({r.score for r in found if r.doc_id == 3}) == 1 and all(0 <= r.score <= 1 for r in found)
    by_parity = [np.mean([r.score for r in found if r.doc_id is not None and r.doc_id % 2 == k]) for k in (0, 1)]
    assert by_parity[0] < by_parity[1]


def test_classifiers_on_documents(spark):
    """Held-out accuracy on the given documents, whole texts."""
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    languages = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in byte_cnn.languages(documents).collect() if r.held_out and languages[r.doc_id] is not None]
    assert len(held) > 150 and np.mean([r.lang_pred == languages[r.doc_id] for r in held]) > 0.95
    marks = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    held = [(r.score, marks[r.doc_id]) for r in gam.quality_scores(documents, labels).collect() if r.held_out and r.doc_id in marks]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert len(good) > 20 and len(bad) > 5
    assert np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good]) > 0.9  # the area under the curve


def test_packing_of_documents(spark):
    """Ids as the named library gives them for every document, and little padding."""
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = Counter()
    for r in documents.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            want[r.doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    found = packing.packed_documents(documents, tokenizer("byte_bpe_50k.json")).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == want
    assert sum(r.length for r in found) > 0.97 * 2048 * len({r.sequence_id for r in found})


def test_pair_tables_learn_an_interaction():
    rng = np.random.default_rng(5)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = gam.AdditiveModel().fit(x, y)
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.97
    assert (1, 0) in model.pair_tables


def test_features_of_an_empty_text_are_zero():
    values = gam.text_features(*common.utf8(pa.array(["", None, "a b"])))
    assert (values[:2] == 0).all() and (values[2] != 0).any()


def test_least_in_windows():
    values = np.random.default_rng(6).integers(0, 5, 90)
    for width in (1, 2, 7, 90, 91):
        assert bytework.least_in_windows(values, width).tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(90 - width + 1)]


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([], "item_id int, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    for frame in (
        superminhash.near_duplicate_groups(empty), suffix_buckets.without_repeats(empty), suffix_trees.without_repeated_windows(empty),
        positional_index.contamination(empty, items), packing.packed_documents(empty, tokenizer("byte_bpe_50k.json")),
        token_counts.token_counts(empty, tokenizer("word_bpe_49k.json")), byte_cnn.languages(empty), gam.quality_scores(empty, labels),
    ):
        assert frame.collect() == []
