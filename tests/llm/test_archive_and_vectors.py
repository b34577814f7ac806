"""Revisits and vectors against brute force."""

from collections import Counter
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from spanflow.llm import common, nn_descent, revisits
from tests.llm.data import Sets

SPELLINGS = [
    ("https://www.Site.org/a/?utm_source=x#top", "site.org/a"), ("http://site.org:80/a", "site.org/a"),
    ("HTTP://u@m.site.org/a/index.html", "site.org/a"), ("site.org/a?b=2&a=1&ref=z", "site.org/a?a=1&b=2"),
    ("https://site.org", "site.org"), ("  ", None), ("", None), (None, None),
]


def test_canonical_urls(spark):
    frame = spark.createDataFrame([(a,) for a, _ in SPELLINGS], "url string").select(revisits.canonical_url(F.col("url")))
    assert [r[0] for r in frame.collect()] == [b for _, b in SPELLINGS]


def test_revisits(spark):
    rng, start = np.random.default_rng(1), datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        url = ["https://a.org/x", "http://www.a.org/x/", "https://b.org/y?ref=1", None, ""][rng.choice(5, p=[0.4, 0.3, 0.2, 0.05, 0.05])]
        # Days apart, seconds apart, and apart within a second.
        seconds, part = int(rng.integers(0, 400_000)) // 4000 * 4000, int(rng.integers(0, 4)) * 300_000
        at = start + timedelta(seconds=seconds, microseconds=part) if rng.random() > 0.03 else None
        tag = ['"1"', 'W/"1"', '"2"', None][rng.integers(4)]
        headers = None if rng.random() < 0.05 else {k: v for k, v in (("ETag", tag), ("Content-Length", str(i)), ("X", str(i))) if v}
        rows.append((i, rng.choice(["response", "revisit", "request"]), url, at, headers, 1, "s"))
    frame = spark.createDataFrame(rows, "record_id bigint, kind string, url string, at timestamp, headers map<string,string>, found int, stored string")
    clean = {"https://a.org/x": "a.org/x", "http://www.a.org/x/": "a.org/x", "https://b.org/y?ref=1": "b.org/y"}
    want = {}
    for i, kind, url, at, headers, *_ in rows:
        if kind != "revisit":
            continue
        before = [r for r in rows if r[1] == "response" and clean.get(r[2]) == clean.get(url) and r[3] and at and r[3] < at] if clean.get(url) else []
        if not before:
            want[i] = (clean.get(url), None, "no response", None)
            continue
        best = max(before, key=lambda r: (r[3], r[0]))
        tag, own = (headers or {}).get("ETag"), (best[4] or {}).get("ETag")
        if tag is not None and (own is None or tag.removeprefix("W/") != own.removeprefix("W/")):
            want[i] = (clean[url], None, "validators differ", None)
            continue
        merged = {k.lower(): v for k, v in (best[4] or {}).items()}
        merged |= {k.lower(): v for k, v in (headers or {}).items() if k != "Content-Length"}
        want[i] = (clean[url], best[0], "resolved", merged)
    found = {r.record_id: (r.url, r.response_id, r.status, r.headers) for r in revisits.resolve_revisits(frame).collect()}
    assert found == want
    assert Counter(v[2] for v in want.values()).keys() == {"resolved", "no response", "validators differ"}
    assert revisits.resolve_revisits(frame.where("false")).collect() == []


def test_the_latest_response_within_a_second(spark):
    start = datetime(2024, 1, 1)
    moments = [start, start + timedelta(days=1, milliseconds=100), start + timedelta(days=1, milliseconds=900), start + timedelta(days=1, milliseconds=900)]
    rows = [(i, "revisit" if i == 2 else "response", "http://a.org/", at, {}) for i, at in enumerate(moments)]
    frame = spark.createDataFrame(rows, "record_id bigint, kind string, url string, at timestamp, headers map<string,string>")
    assert revisits.resolve_revisits(frame).first().response_id == 1


def test_a_hot_url(spark):
    start, rng = datetime(2024, 1, 1), np.random.default_rng(3)
    rows = [(i, "revisit" if i % 3 == 0 else "response", "http://hot.org/", start + timedelta(seconds=int(rng.integers(0, 3000)) * 90, milliseconds=int(rng.integers(0, 3))), {}) for i in range(3000)]
    frame = spark.createDataFrame(rows, "record_id bigint, kind string, url string, at timestamp, headers map<string,string>")
    found = {r.record_id: r.response_id for r in revisits.resolve_revisits(frame).collect()}
    responses = sorted((r[3], r[0]) for r in rows if r[1] == "response")
    assert found == {i: max((x for x in responses if x[0] < at), default=(None, None))[1] for i, kind, _, at, _ in rows if kind == "revisit"}


def test_header_names_that_clash(spark):
    frame = spark.sql("select map('ETag', 'a', 'etag', 'b', 'X', 'c') as h").select(revisits.lowered(F.col("h")).alias("h"))
    assert frame.first().h == {"etag": "b", "x": "c"}


def test_linked_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=24).tolist(), int(i % 2)) for i in range(160)]
    rows += [(1000 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(20)]  # equal vectors
    rows += [(2000 + i, (np.array(rows[9][1]) + rng.normal(size=24) * 0.05).tolist(), rows[9][2]) for i in range(45)]  # a saturated group
    rows += [(3000 + i, (np.array(rows[20 + i][1]) * 3 + rng.normal(size=24) * 0.2).tolist(), rows[20 + i][2]) for i in range(30)]
    rows += [(4000, None, 1), (4001, [0.0] * 24, 1), (4002, [float("nan")] * 24, 1), (4003, rows[0][1], None), (4004, [1.0, 2.0], 1), (4005, [2.0, 4.0], 1),
             (4006, [], 1), (4007, [None] * 24, 1), (4008, [-x for x in rows[9][1]], rows[9][2]), (4009, [1e300] * 24, 1), (4010, [1e-300] * 24, 1), rows[3], (None, rows[4][1], 0)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, id string, component int")
    good = {}
    for i, v, label in rows:
        if i is not None and v and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
            u = np.array(v) / np.abs(v).max()
            good[i] = (label, u / np.linalg.norm(u))
    links, sets = Counter(), Sets()
    for a, (label, u) in good.items():
        for b, (other, w) in good.items():
            if a != b and label == other and len(u) == len(w) and u @ w >= 0.93:
                links[a] += 1
                sets.join(a, b)
    want = Counter((i, links[i] if i is not None else 0, sets.find(i) if i is not None else None) for i, _, _ in rows)
    assert Counter(tuple(r) for r in nn_descent.linked_vectors(frame).collect()) == want
    assert max(links.values()) > 40
    assert nn_descent.linked_vectors(frame.where("false")).collect() == []


def linked_by_brute_force(rows):
    """(id, links, component) of usable vectors with distinct ids and one length."""
    sets, links = Sets(), Counter()
    for label in {r[2] for r in rows}:
        ids = [r[0] for r in rows if r[2] == label]
        x = np.array([r[1] for r in rows if r[2] == label])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i, j in np.argwhere(x @ x.T >= 0.93).tolist():
            if i != j:
                links[ids[i]] += 1
                sets.join(ids[i], ids[j])
    return {(i, links[i], sets.find(i)) for i, _, _ in rows}


def near(rng, v, cosine):
    """A vector at that cosine to ``v``, in a random direction."""
    off = rng.normal(size=len(v))
    off -= off @ v / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * off / np.linalg.norm(off)


def nested_groups(rng):
    """Groups of 20 close vectors that link to one another: all lists of ten stay within a group."""
    top = rng.normal(size=64)
    groups = [near(rng, top, 0.968) for _ in range(30)]
    return [(k * 100 + n, near(rng, g, 0.9995).tolist(), 0) for k, g in enumerate(groups) for n in range(20)]


def test_groups_within_a_group_stay_linked(spark, monkeypatch):
    rows = nested_groups(np.random.default_rng(5))
    want = linked_by_brute_force(rows)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert len({c for _, _, c in want}) == 1 and min(n for _, n, _ in want) > 20
    assert {tuple(r) for r in nn_descent.linked_vectors(frame).collect()} == want
    # Several parts, and products of a few rows and columns.
    for name, value in (("PART_ROWS", 90), ("ROWS", 7), ("COLUMNS", 50)):
        monkeypatch.setattr(nn_descent, name, value)
    assert {tuple(r) for r in nn_descent.linked_vectors(frame).collect()} == want


def test_rare_pairs_beside_a_hot_vector(spark):
    """Pairs just above the threshold among many vectors without links; copies of one vector
    have nearly all link ends, so that a share of ends says nothing about the pairs."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=64), 0) for i in range(4000)]
    rows += [(10_000 + i, near(rng, rows[i][1], 0.931), 0) for i in range(600)]
    rows += [(20_000 + i, rows[3999][1], 0) for i in range(200)]
    want = linked_by_brute_force(rows)
    frame = spark.createDataFrame([(i, v.tolist(), k) for i, v, k in rows], "vec_id bigint, embedding array<double>, label int")
    found = {tuple(r) for r in nn_descent.linked_vectors(frame).collect()}
    assert found == want and sum(n == 1 for _, n, _ in want) >= 1190


def test_the_neighbour_graph_alone_finds_the_links(spark, caplog):
    """Recall of the lists against brute force; the audit logs it, and blocks are few."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=32), i % 3) for i in range(1500)]
    rows += [(5000 + i, near(rng, rows[i % 300][1], 0.94), rows[i % 300][2]) for i in range(900)]
    frame = spark.createDataFrame([(i, v.tolist(), k) for i, v, k in rows], "vec_id bigint, embedding array<double>, label int")
    want = linked_by_brute_force(rows)
    units = common.stage(nn_descent.classes(nn_descent.usable(frame, "vec_id", "embedding", "label")), "units")
    graph = nn_descent.neighbour_graph(units, 0.93, 1)
    pairs = graph.where("sim >= 0.929").select(F.least("id", "other").alias("low"), F.greatest("id", "other").alias("high")).distinct()
    found = nn_descent._confirmed(pairs, units, 0.93).count()
    assert found >= 0.999 * sum(n for _, n, _ in want) / 2 and graph.where("saturated").count() == 0
    with caplog.at_level("INFO", "spanflow.llm.nn_descent"):
        assert {tuple(r) for r in nn_descent.linked_vectors(frame).collect()} == want
    assert "recall 1.000000" in caplog.text
    for bits in (0, 1, 8, 22):
        apart, tables = 1 - (1 - np.arccos(0.93) / np.pi) ** bits, nn_descent.tables_for(bits, 0.93)
        assert apart**tables <= nn_descent.MISS < (apart ** (tables - 1) if tables > 1 else 1.1)
