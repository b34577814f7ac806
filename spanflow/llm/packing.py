"""Packing of token sequences by non-negative least squares over length combinations.

1. Documents become ids and are cut into whole windows and a rest; the pieces'
   lengths, rounded up to slots, give a histogram of at most ``window / SLOT`` bins.
2. All combinations of at most ``DEPTH`` slot lengths that fill a window are the
   columns of a non-negative least-squares problem whose right side is the histogram.
   An active-set solution has no more combinations than bins.
3. Repeat counts are rounded and held below what the histogram has left.
4. Residual pieces are packed greedily, the longest that fits first; a pattern is
   repeated until it exhausts a bin, so there are no more patterns than bins.
5. A piece's rank within its bin names its pattern, copy and slot.

The plan depends on the histogram alone, of fixed size; ranks come from counts per
bin and salt, so no task ranks a whole bin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanflow.llm.byte_bpe import byte_bpe
from spanflow.llm.common import slices, stage, text_rows

SLOT = 8
DEPTH = 3
_PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint"


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of at most ``window`` tokens: ``doc_id, start, length, ids, doc_tokens``.

    ``ids`` are unsigned 32-bit little-endian integers. A null text counts as empty and
    gives one piece with the end id; repeated rows give pieces each.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(tokenizer)
        for batch in slices(batches):
            rows, starts, lengths, parts, totals = [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encoder.ids(text or ""), end_id).astype("<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(part))
                    parts.append(part.tobytes())
                    totals.append(len(ids))
            yield pa.record_batch(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(parts, pa.binary()), pa.array(totals, pa.int64())],
                names=["doc_id", "start", "length", "ids", "doc_tokens"],
            )

    return text_rows(docs, doc_id, text).mapInArrow(cut, _PIECES)


def combinations(sizes: np.ndarray, full: int, depth: int) -> list[tuple[int, ...]]:
    """Non-ascending tuples of at most ``depth`` of the sizes that sum to ``full``."""
    there, found = set(sizes.tolist()), []

    def extend(prefix: tuple[int, ...], left: int) -> None:
        if left in there and (not prefix or left <= prefix[-1]):
            found.append((*prefix, left))
        if len(prefix) + 1 < depth:
            for size in there:
                if size < left and (not prefix or size <= prefix[-1]):
                    extend((*prefix, size), left - size)

    extend((), full)
    return sorted(found, reverse=True)


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Active-set solution of min |a x - b| with x >= 0."""
    x = np.zeros(a.shape[1])
    passive: list[int] = []
    gradient = a.T @ b
    tolerance = 1e-9 * max(1.0, float(np.abs(gradient).max(initial=0.0)))
    for _ in range(3 * a.shape[0]):
        gradient[passive] = -np.inf
        if not len(gradient) or gradient.max() <= tolerance:
            break
        passive.append(int(np.argmax(gradient)))
        while passive:
            own = a[:, passive]
            solved = np.linalg.solve(own.T @ own + 1e-9 * np.eye(len(passive)), own.T @ b)
            if (solved > 0).all():
                break
            now = x[passive]
            falling = solved <= 0
            step = (now[falling] / np.maximum(now[falling] - solved[falling], 1e-300)).min()
            x[passive] = now + step * (solved - now)
            gone = [k for k in passive if x[k] <= 1e-12]
            x[gone] = 0
            passive = [k for k in passive if x[k] > 1e-12]
        x[:] = 0
        if passive:
            x[passive] = solved
        gradient = a.T @ (b - a @ x)
    return x


def packing_plan(counts: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of slot lengths and their repeats that use up ``counts``, which has the
    number of pieces of each slot length from 0 to a full window."""
    left, full = counts.astype(np.int64).copy(), len(counts) - 1
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...], repeats: int) -> None:
        sizes, times = np.unique(pattern, return_counts=True)
        repeats = min(repeats, int((left[sizes] // times).min()))
        if repeats > 0:
            left[sizes] -= repeats * times
            plan.append((pattern, repeats))

    whole = int(left[full])
    if whole:
        take((full,), whole)
    sizes = np.flatnonzero(left)
    columns = combinations(sizes, full, depth) if len(sizes) else []
    if columns:
        a = np.zeros((full + 1, len(columns)))
        for k, pattern in enumerate(columns):
            np.add.at(a[:, k], list(pattern), 1)
        x = non_negative_least_squares(a[sizes], left[sizes].astype(float))
        for k in np.argsort(-x):
            if x[k] >= 0.5:
                take(columns[k], int(round(float(x[k]))))
    while left.any():
        trial, pattern, room = left.copy(), [], full
        while room and (fits := np.flatnonzero(trial[: room + 1])).size:
            size = int(fits[-1])
            pattern.append(size)
            trial[size] -= 1
            room -= size
        take(tuple(pattern), int(left.max()))
    return plan


def pack(pieces: DataFrame, window: int = 2048, slot: int = SLOT, salts: int | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. They need ``doc_id, start, length``
    and no columns of those two names, nor ``bin``, ``salt``, ``rank`` or ``slot``."""
    pieces = pieces.withColumn("bin", F.ceil(F.col("length") / slot).cast("int"))
    histogram = pieces.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()  # window / slot rows at most
    counts = np.zeros(-(-window // slot) + 1, np.int64)
    for row in histogram:
        counts[row.bin] = row.n
    plan = packing_plan(counts)
    # For each bin: from which rank on which pattern, and its slots for that bin.
    starts: dict[int, list[tuple[int, int, int, int]]] = {}
    used, base = np.zeros(len(counts), np.int64), 0
    for pattern, repeats in plan:
        for size in sorted(set(pattern)):
            times = pattern.count(size)
            starts.setdefault(size, []).append((int(used[size]), base, times, pattern.index(size)))
            used[size] += repeats * times
        base += repeats
    lookup = {size: np.array(rows, np.int64) for size, rows in starts.items()}
    if salts is None:  # about a million pieces for each
        salts = max(64, int(counts.max(initial=0)) // 1_000_000)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "length"), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("bin", "salt").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn(
        "_before", F.sum("_n").over(Window.partitionBy("bin").orderBy("salt")) - F.col("_n")
    ).drop("_n")
    order = Window.partitionBy("bin", "salt").orderBy("doc_id", "start", "length")
    ranked = (
        salted.withColumn("rank", F.row_number().over(order))
        .join(before, ["bin", "salt"])
        .withColumn("rank", F.col("rank") - 1 + F.col("_before"))
        .drop("_before", "salt")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("bin").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, at = np.zeros(len(size), np.int64), np.zeros(len(size), np.int32)
            for one in np.unique(size):
                own = np.flatnonzero(size == one)
                rows = lookup[int(one)]
                found = rows[np.searchsorted(rows[:, 0], rank[own], side="right") - 1]
                local = rank[own] - found[:, 0]
                sequence[own] = found[:, 1] + local // found[:, 2]
                at[own] = found[:, 3] + local % found[:, 2]
            keep = [batch.column(k) for k in names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(at)], names=[*names, "sequence_id", "slot"])

    names = [c for c in ranked.columns if c not in ("bin", "rank")]
    schema = ranked.select(*names).schema.add("sequence_id", "long").add("slot", "integer")
    placed = ranked.mapInArrow(place, schema)
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0).cast("bigint"))).drop("slot")


def packed_documents(docs: DataFrame, tokenizer: str, window: int = 2048) -> DataFrame:
    """Pieces of all documents with a checksum in place of their ids, and their places."""
    pieces = token_pieces(docs, tokenizer, window=window)
    digest = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(stage(digest, "pieces"), window)
