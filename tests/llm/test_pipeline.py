"""The pipeline's stages, each on all that the stage before kept."""

from collections import Counter
from itertools import combinations
import re

import corpus_pipeline
from spanflow.llm import common, gam
from tests.llm import data


def rows_of(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    odd = [(r[0], r[1]) for r in data.documents()]
    noisy = [(500 + i, " ".join(f"word{k}$$$ %%%" for k in range(i, i + 40))) for i in range(40)]
    columns = "doc_id bigint, text string, lang string, n_chars int, key_id string, _gone int, __id string, score double"
    documents = [(i, t, "en", len(t or ""), "k", 1, "u", 0.5) for i, t in odd + noisy]
    spark.createDataFrame(documents, columns).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 500), 0) for i, _ in odd + noisy if i is not None]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    taken = " ".join(odd[3][1].split()[2:14])
    spark.createDataFrame([(1, taken), (2, None)], "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        scored = {(r.doc_id, r.key_text): r.predicted for r in gam.quality_scores(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()} if name.startswith("quality") else {}
        before = rows_of(docs)
        out = common.stage(function(spark, docs, folder), "pipeline")
        assert out.columns == docs.columns and out.schema["n_chars"] == docs.schema["n_chars"]
        kept[name] = before, rows_of(out), scored, out
        docs = out

    before, after, scored, _ = kept["quality classifier"]
    assert after.total() == sum(n for (i, _), n in before.items() if any(k[0] == i and v for k, v in scored.items()))
    assert sum(i is not None and i >= 500 for i, _ in after) < 5 and sum(i is None or i < 500 for i, _ in after) > 50

    before, after, *_ = kept["minhash near-duplicates"]
    groups, sets = data.Sets(), {i: data.shingles(t, 5) for i, t in before if i is not None}
    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            groups.join(a, b)
    assert after == Counter({k: n for k, n in before.items() if k[0] is None or groups.find(k[0]) == k[0]})

    before, after, _, out = kept["suffix-array repeats"]
    texts = [(k, (k[1] or "").encode()) for k in before.elements()]
    size = corpus_pipeline.REPEATED_BYTES
    often = Counter(t[p : p + size] for _, t in texts for p in range(len(t) - size + 1))
    want = Counter()
    for (i, text), t in texts:
        hit = data.covered(len(t), size, [p for p in range(len(t) - size + 1) if often[t[p : p + size]] > 1])
        want[i, text if text is None else bytes(b for b, h in zip(t, hit) if not h).decode(errors="ignore")] += 1
    assert after == want != before
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)

    before, after, *_ = kept["benchmark decontamination"]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    tests = {tuple(words(taken)[k : k + 10]) for k in range(3)}
    dirty = lambda t: any(tuple(words(t)[k : k + 10]) in tests for k in range(len(words(t))))
    assert after == Counter({k: n for k, n in before.items() if not dirty(k[1])}) and after.total() < before.total()

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == Counter(i for i, _ in after.elements())


def test_stages_on_empty_tables(spark, tmp_path):
    tables = {
        "documents": "doc_id bigint, text string, n_chars int, key_id string", "labels": "doc_id bigint, quality int, toxic int",
        "benchmark": "item_id int, text string",
    }
    for name, schema in tables.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.collect() == []
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_reads_the_tables(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(found.columns) and found.count() > 100
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
