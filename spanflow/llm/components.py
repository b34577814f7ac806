"""Connected components of a link table, by union-find within tasks and star steps across them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanflow.llm.common import discard, stage

LINK = "low bigint, high bigint"


def _local_union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of a batch: each id points to the least of its set."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x: int, parent=parent) -> int:
            root = x
            while (up := parent.setdefault(root, root)) != root:
                root = up
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        pairs = [(find(x), x) for x in list(parent)]
        pairs = [(low, high) for low, high in pairs if low != high]
        yield pa.record_batch(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
            names=["low", "high"],
        )


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step. Minima are aggregated with partial results and joined back, so
    the neighbours of a hot id are never gathered; such a join may split its key."""
    sides = links.select(F.col("low").alias("other"), F.col("high").alias("node"))
    if large:
        sides = sides.union(links.select(F.col("high").alias("other"), F.col("low").alias("node")))
    least = sides.groupBy("node").agg(F.min("other").alias("least"))
    moved = sides.join(least, "node")
    if large:
        moved = moved.where("other > node").select(
            F.least("node", "least").alias("low"), F.col("other").alias("high")
        )
    else:
        moved = moved.select(F.col("least").alias("low"), F.col("other").alias("high")).union(
            least.select(F.col("least").alias("low"), F.col("node").alias("high"))
        )
    return moved.where("low < high").distinct()


def connected_components(links: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """``id, component`` for every id that has a link; component is the least id reachable.

    Rounds go on until nothing changes; every round is written to the shared folder.
    """
    pairs = links.select(
        F.least(low, high).cast("bigint").alias("low"), F.greatest(low, high).cast("bigint").alias("high")
    ).where("low < high")
    now = stage(pairs.mapInArrow(_local_union, LINK).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        last, now = now, stage(_star(_star(now, True), False), "links")
        discard(last)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("high").alias("id"), F.col("low").alias("component")).union(
        now.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("low", "high")).alias("x"),
        F.sum(F.hash("low", "high").cast("bigint")).alias("s"),
    ).first()
    return row.n, row.x, row.s
