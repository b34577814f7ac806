"""Hard negatives, exact duplicates and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanflow.llm import extendible_hash, periodic_runs, queries, rns_gemm
from tests.llm.data import SCHEMA, WORDS, documents

SMALL = "/root/testdata/sf0.001"


def lowered(text):
    return (text or "").translate({k: k + 32 for k in range(65, 91)})


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# Hard negatives.


def test_exact_products():
    rng = np.random.default_rng(3)
    for scale, width in ((3, 5), (300, 64), (90_000, 200), (2**26, 130), (2**28, 3)):
        one, two = rng.integers(-scale, scale, (7, width)), rng.integers(-scale, scale, (9, width))
        bound = int(max((one.astype(object) ** 2).sum(1).max(), (two.astype(object) ** 2).sum(1).max()))
        primes = rns_gemm.moduli(bound)
        assert np.prod([int(p) for p in primes], dtype=object) > 2 * bound + 1
        got = rns_gemm.exact_products(rns_gemm.residues(one, primes), rns_gemm.residues(two, primes), primes)
        assert (got == one.astype(object) @ two.astype(object).T).all()


def brute_negatives(rows, is_anchor):
    """``rows``: id, label, vector; as the docstring of ``hard_negatives`` has it."""
    best = {}
    for i, label, v, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        if sum((min(abs(x * 256.0), 1e100) + 1) ** 2 for x in v) >= 2.0**62:
            continue
        row = (label, [int(np.floor(x * 256.0)) for x in v])
        best[i] = min(best.get(i, row), row)
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, (label, v) in best.items():
        if not is_anchor(i):
            continue
        scores = sorted(((-score(v, w), j, other) for j, (other, w) in best.items() if j != i))
        for s, j, _ in [x for x in scores if x[2] == label][:5]:
            near = [x for x in scores if x[2] != label and -50 * s <= -100 * x[0] <= -95 * s][:3]
            out += [(i, j, n, k, -s, -t) for n, (t, k, _) in enumerate(near, 1)]
    return sorted(out)


VECTORS = "vec_id bigint, label int, embedding array<double>, part string, ints int, v string, is_anchor int"


def vector_rows():
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(6, 12))
    rows = []
    for i in range(500):
        v = centers[rng.integers(6)] + rng.normal(size=12) * 0.8
        label = 0 if rng.random() < 0.35 else int(rng.integers(1, 6))  # a hot label
        rows.append((i, label, [float(x) for x in np.round(v, 2)], "p", 1, "v", 0))
    rows += rows[:30] + [(1000 + i, *r[1:]) for i, r in enumerate(rows[:60])]  # repeated rows, and ties
    rows += [(5, 3, [0.5] * 12, "p", 1, "v", 0), (2000, 77, [1.0] * 12, "p", 1, "v", 0)]  # an id with two vectors; a lone label
    odd = [None, [], [None] * 12, [float("nan")] * 12, [float("inf")] * 12, [1e300] * 12, [0.0] * 12, [2.0] * 5, [0.5] * 400]
    rows += [(3000 + i, i % 2, v, None, None, None, None) for i, v in enumerate(odd)]
    return rows + [(None, 1, [1.0] * 12, None, None, None, None), (4000, None, [1.0] * 12, None, None, None, None)]


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(rns_gemm, "FEWEST_ROWS", 100)  # several parts
    monkeypatch.setattr(rns_gemm, "_ROWS", 64)
    rows = vector_rows()
    frame = spark.createDataFrame(rows, VECTORS).repartition(7)
    found = rns_gemm.hard_negatives(frame, F.col("vec_id") % 5 == 0).collect()
    want = brute_negatives(rows, lambda i: i % 5 == 0)
    assert sorted(map(tuple, found)) == want and len(want) > 500
    assert rns_gemm.hard_negatives(frame.where("false"), F.col("vec_id") % 5 == 0).collect() == []
    assert rns_gemm.hard_negatives(frame.where("label = 77"), F.col("vec_id") % 5 == 0).collect() == []


# Exact duplicates.


def copies():
    rows = documents()
    ids = [r[0] for r in rows if r[0] is not None]
    more = [(i + 100, r[1].swapcase() if r[1] and r[1].isascii() else r[1]) for i, r in zip(ids[:40], rows[:40], strict=False)]
    more += [(1000 + k, ["hot copy", "HOT copy"][k % 2]) for k in range(400)] + [(900, "ÉA"), (901, "Éa"), (902, "éa")]
    return rows + [(i, t, "en", "s", 0, "k", 1, "n", "x", 2) for i, t in more]


def brute_copies(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[lowered(text)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    return Counter(out)


@pytest.mark.parametrize("bits, capacity", [(63, 8192), (63, 4), (5, 3), (1, 1)])
def test_exact_duplicates(spark, bits, capacity):
    rows = copies()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = extendible_hash.exact_duplicates(frame, capacity=capacity, bits=bits)
    assert Counter(map(tuple, found.collect())) == brute_copies(rows)
    assert extendible_hash.exact_duplicates(frame.where("false"), capacity=capacity).collect() == []


def test_directory_and_chains(spark):
    rows = copies()
    frame = spark.createDataFrame(rows, SCHEMA)
    index = extendible_hash.build_index(frame, capacity=4, bits=4)
    buckets = index.buckets.collect()
    texts = {lowered(r[1]) for r in rows}
    assert len(buckets) == len(texts) == len({b.text_sha256 for b in buckets})
    held, named = defaultdict(list), {d.bucket: (d.depth, d.address) for d in index.directory.collect()}
    for b in buckets:
        held[b.bucket].append(b.key)
        depth, address = named[b.bucket]
        assert b.key >> (4 - depth) == address
    # Only entries of one key may overfill a bucket, and chains number them without gaps.
    assert all(len(k) <= 4 or len(set(k)) == 1 for k in held.values()) and any(len(k) > 4 for k in held.values())
    chains = defaultdict(list)
    for b in buckets:
        chains[b.key].append(b.chain)
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in chains.values()) and max(map(len, chains.values())) > 1
    assert len(index.depths) > 1
    some = extendible_hash.lookup(frame.where("doc_id in (3, 1001)"), index).collect()
    assert Counter(map(tuple, some)) == Counter((i, k, n, s) for (i, k, n, _, s), m in brute_copies(rows).items() if i in (3, 1001) for _ in range(m))


def test_exact_dedup_stays_native(spark):
    frame = spark.createDataFrame(copies(), SCHEMA)
    plan = extendible_hash.exact_duplicates(frame)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|RDDScan.*udf", plan.split("== Physical Plan ==")[1].replace("LogicalRDD", ""))


# Periodic runs.


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            stretch = words[i : i + size]
            if size >= max(24, 3 * q) and not any(stretch[p:] == stretch[: size - p] for p in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for a, size, q in runs for k in range(a + q, a + size)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def periodic_texts():
    rng = random.Random(4)
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += [rng.choice(["a", "b", "é", "dd"][: rng.randint(1, 4)]) for _ in range(rng.randint(1, 12))] * rng.randint(1, 9)
            words += ["x"] * (rng.random() < 0.3)
        texts.append(rng.choice([" ", "\n", " \t "]).join(words))
    texts += ["a " * 3000, ("p q r " * 900 + "z ") * 2, None, "", "\n \t", "one"]
    return texts


def test_periodic_runs(spark):
    rows = [(i, t, None, None, None, "k", 1, "n", "x", 2) for i, t in enumerate(periodic_texts())]
    rows += documents() + rows[:3]
    found = periodic_runs.periodic_runs(spark.createDataFrame(rows, SCHEMA)).collect()
    want = []
    for i, text, *_ in rows:
        words = WORDS.findall((text or "").encode())
        runs = brute_runs(words) if len(words) < 7000 else []
        want.append((i, len(words), tuple(runs), collapsed(words, runs).decode()))
    got = [(r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in found]
    assert Counter(got) == Counter(want) and sum(len(w[2]) for w in want) > 100
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic_runs.periodic_runs(empty).collect() == []


def test_long_runs_take_little_time():
    rng = np.random.default_rng(2)
    for word, want in ((np.zeros(60_000, int), [(0, 60_000, 1)]), (np.append(np.arange(5, 900), np.zeros(30_000, int)), [(895, 30_000, 1)])):
        assert list(map(tuple, periodic_runs.find_runs(word, np.zeros(len(word), int)))) == want
    passage = np.concatenate([np.append(1000 + i, np.arange(30)) for i in range(3000)])  # no run, but one hot passage
    assert not len(periodic_runs.find_runs(passage, np.zeros(len(passage), int)))
    assert not len(periodic_runs.find_runs(rng.integers(0, 500, 50_000), np.zeros(50_000, int)))


def test_op13_query(spark):
    got = queries.op13_maximal_pairs(spark, SMALL)
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = []
    for doc_id, text in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        words = WORDS.findall((text or "").encode())
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{a},{size},{q}\n" for a, size, q in runs)
        want.append((doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], sha(lines), sha(collapsed(words, runs))))
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert sum(w[1] > 0 for w in want) > 10
