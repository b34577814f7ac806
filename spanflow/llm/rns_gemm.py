"""Hard negatives by exact integer scores: matrix products in a residue number system.

Components are whole numbers. Their residues modulo a few small primes are multiplied as
float32 matrices: with residues between -p/2 and p/2 and a bounded number of columns at a
time, every sum stays below 2**24, where float32 is exact. Chinese remaindering in mixed
radix with signed digits gives the exact signed score, as long as twice its size is below
the product of the primes; how many primes that takes follows from the largest norm.

1. Rows get a part by a hash of their id. Anchors are sent to every part; a task reads the
   rows of a part, then the anchors in batches. So the rows are shuffled once, whatever
   the number of anchors, and a task holds one part. No key of the data decides where a
   row goes, so a label with a third of all rows is spread like others.
2. First pass: of every part each anchor keeps its best rows of the same label, and the
   best of these over all parts are its positives.
3. Second pass: anchors carry the scores of their positives, which bound a window for the
   scores of negatives. Each part gives the first rows of each window, and the first of
   these over all parts are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanflow.llm.common import stage

#: Residues are below this, so that 64 columns and more can be multiplied at a time.
LARGEST_MODULUS = 1024
EXACT = 1 << 24
#: Components that a part holds at most, about 4 bytes each for every prime and 16 besides.
#: Small tables have a part for every ``FEWEST_ROWS`` rows, so that several tasks work.
PART_COMPONENTS = 1 << 23
FEWEST_ROWS, PARTS = 4096, 256
#: Scores are computed for so many anchors and rows at once.
_ANCHORS, _ROWS = 256, 8192


def moduli(bound: int) -> list[int]:
    """The largest primes below ``LARGEST_MODULUS`` whose product exceeds ``2 * bound + 1``."""
    sieve = np.ones(LARGEST_MODULUS, bool)
    sieve[:2] = False
    for p in range(2, math.isqrt(LARGEST_MODULUS) + 1):
        sieve[p * p :: p] &= not sieve[p]
    found, product = [], 1
    for p in np.flatnonzero(sieve)[::-1].tolist():
        if product > 2 * bound + 1:
            break
        found.append(p)
        product *= p
    return found


def _signed(values: np.ndarray, p: int) -> np.ndarray:
    """Residues between -(p - 1) / 2 and (p - 1) / 2."""
    half = p // 2
    return (values + half) % p - half


def residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [_signed(vectors, p).astype(np.float32) for p in primes]


def exact_products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed inner products of all rows of ``left`` and ``right``, given by residues."""
    digits: list[np.ndarray] = []
    score, weight = None, 1
    for k, p in enumerate(primes):
        width = max(1, (EXACT - 1) // (p // 2) ** 2)
        now = np.zeros((left[k].shape[0], right[k].shape[0]), np.int32)
        for c in range(0, left[k].shape[1], width):
            now += _signed((left[k][:, c : c + width] @ right[k][:, c : c + width].T).astype(np.int32), p)
        now = _signed(now, p)
        # What the digits so far leave, divided by the primes before, is the next digit.
        for q, digit in zip(primes, digits, strict=False):
            now = _signed((now - digit) * pow(q, -1, p), p)
        digits.append(now)
        part = now.astype(np.int64) * np.uint64(weight % 2**64).astype(np.int64)
        score = part if score is None else score + part
        weight *= p
    return score


def _ints(column: pa.ListArray) -> np.ndarray:
    """Rows of integer vectors as a matrix; shorter ones end with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    wide = int(size.max(initial=1)) or 1
    if len(size) and (size == wide).all():
        return flat.reshape(len(size), wide)
    out = np.zeros((len(size), wide), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _widened(matrix: np.ndarray, wide: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, wide - matrix.shape[1]))) if matrix.shape[1] < wide else matrix


class _Part:
    """The rows of a part, by id, as residues."""

    def __init__(self, batches: list[pa.RecordBatch], primes: list[int]):
        rows = pa.Table.from_batches(batches).combine_chunks()
        order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
        self.id = rows["vec_id"].to_numpy()[order]
        self.label = rows["label"].to_numpy()[order]
        self.residues, self.primes = residues(_ints(rows["ints"].combine_chunks())[order], primes), primes

    def scores(self, anchors: np.ndarray, chosen: np.ndarray | slice) -> np.ndarray:
        """Of all anchors and the chosen rows; vectors of other lengths end with zeros."""
        wide = max(anchors.shape[1], self.residues[0].shape[1])
        self.residues = [_widened(r, wide) for r in self.residues]
        left = [_widened(r, wide) for r in residues(anchors, self.primes)]
        return exact_products(left, [r[chosen] for r in self.residues], self.primes)


def _first(score: np.ndarray, wanted: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` best columns of one row among the wanted, ties by place."""
    at = np.flatnonzero(wanted)
    if len(at) > n:
        worst = np.partition(score[at], len(at) - n)[len(at) - n]
        at = at[score[at] >= worst]
    return at[np.argsort(-score[at], kind="stable")][:n]


def _parts(primes: list[int], work) -> object:
    """Reads rows sorted by part, rows before anchors, and calls ``work(part, anchors)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, part = None, [], None
        for batch in batches:
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            anchor = batch.column("is_anchor").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(parts) != 0) | (anchor[1:] != anchor[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if a == b:
                    continue
                if parts[a] != number:
                    number, waiting, part = parts[a], [], None
                if not anchor[a]:
                    waiting.append(batch.slice(a, b - a))
                    continue
                if not waiting and part is None:
                    continue
                if part is None:
                    part, waiting = _Part(waiting, primes), []
                for c in range(a, b, _ANCHORS):
                    yield from work(part, batch.slice(c, min(_ANCHORS, b - c)))

    return run


_BEST = "anchor_id bigint, positive_id bigint, positive_score bigint"


def _positives(n: int):
    def work(part: _Part, anchors: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        label = anchors.column("label").to_numpy(zero_copy_only=False)
        ids, vectors, found = anchors.column("vec_id").to_numpy(), _ints(anchors.column("ints")), []
        for value in np.unique(label):
            chosen = np.flatnonzero(part.label == value)
            own = np.flatnonzero(label == value)
            for c in range(0, len(chosen), _ROWS):
                block = chosen[c : c + _ROWS]
                score = part.scores(vectors[own], block)
                for i, row in zip(own, score, strict=True):
                    best = _first(row, part.id[block] != ids[i], n)
                    found.append((np.full(len(best), ids[i]), part.id[block][best], row[best]))
        if found:
            yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["anchor_id", "positive_id", "positive_score"])

    return work


_FOUND = f"{_BEST}, negative_id bigint, negative_score bigint"


def _negatives(n: int, low: int, high: int):
    def work(part: _Part, anchors: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        label = anchors.column("label").to_numpy(zero_copy_only=False)
        ids, vectors, found = anchors.column("vec_id").to_numpy(), _ints(anchors.column("ints")), []
        windows = anchors.column("positives").to_pylist()
        for c in range(0, len(part.id), _ROWS):
            score = part.scores(vectors, slice(c, c + _ROWS))
            other = part.label[c : c + _ROWS]
            for i, row in enumerate(score):
                # Whole bounds: 100 x at least low y and at most high y, in Python's integers.
                bounds = [(-(-low * w["positive_score"] // 100), high * w["positive_score"] // 100, w) for w in windows[i]]
                if not bounds:
                    continue
                near = np.flatnonzero((row >= min(b[0] for b in bounds)) & (row <= max(b[1] for b in bounds)) & (other != label[i]))
                near = near[np.argsort(-row[near], kind="stable")]
                falling = -row[near]
                for least, most, w in bounds:
                    a = np.searchsorted(falling, -most, side="left")
                    b = np.searchsorted(falling, -least, side="right")
                    taken = near[a : max(a, min(b, a + n))]
                    if len(taken):
                        found.append((
                            np.full(len(taken), ids[i]), np.full(len(taken), w["positive_id"]), np.full(len(taken), w["positive_score"]),
                            part.id[c : c + _ROWS][taken], row[taken],
                        ))
        if found:
            yield pa.record_batch(
                [pa.array(np.concatenate(x)) for x in zip(*found, strict=True)],
                names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
            )

    return work


def _usable(vectors: DataFrame, vec_id: str, label: str, embedding: str, scale: int) -> DataFrame:
    """``vec_id, label, ints``: one row for each id."""
    values = F.transform(vectors[embedding], lambda x: x.cast("double"))
    rows = vectors.select(vectors[vec_id].cast("bigint").alias("vec_id"), vectors[label].cast("bigint").alias("label"), values.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    # Rounding down adds less than 1 to a component's size.
    small = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x * float(scale)) + 1, F.lit(2.0))) < float(2**62)
    rows = rows.where(small).select("vec_id", "label", F.transform("v", lambda x: F.floor(x * float(scale))).alias("ints"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "ints")).alias("r")).select("vec_id", "r.label", "r.ints")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A component x counts as floor(``scale`` * x); a score is the integer inner product with
    the anchor, higher ones first, ties by smaller id. ``is_anchor`` is a condition on
    ``vec_id``. An anchor's positives are its first rows of the same label but itself; for
    each come the first rows of other labels with ``low`` <= 100 * score / positive score
    <= ``high``, all if there are fewer. An anchor without positives gives no rows.

    Rows with a null id, label or vector, or a null or non-finite component, take no part,
    nor do vectors so long that a score may not fit a long. Shorter vectors count as if
    they ended with zeros, empty ones score 0. Rows that share an id count once, the least
    by label, then vector. Other columns take no part.
    """
    rows = stage(_usable(vectors, vec_id, label, embedding, scale), "integer_vectors")
    norm = F.aggregate("ints", F.lit(0).cast("bigint"), lambda s, x: s + x * x)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ints")).alias("components"), F.max(norm).alias("norm")).first()
    primes = moduli(size.norm or 0)
    parts = max(math.ceil((size.components or 0) / PART_COMPONENTS), min(PARTS, math.ceil(size.n / FEWEST_ROWS)), 1)
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    columns = ["part", "is_anchor", "vec_id", "label", "ints"]
    laid = rows.withColumns({"part": part, "is_anchor": F.lit(False)}).select(*columns)

    def met(anchors: DataFrame, work, schema: str) -> DataFrame:
        sent = anchors.withColumn("is_anchor", F.lit(True)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        both = laid.unionByName(sent, allowMissingColumns=True)
        return both.repartition("part").sortWithinPartitions("part", "is_anchor").mapInArrow(_parts(primes, work), schema)

    anchors = rows.where(is_anchor)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = met(anchors, _positives(positives), _BEST).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= positives)
    chosen = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    windows = stage(anchors.join(chosen.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), "windows")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    found = met(windows, _negatives(negatives, low, high), _FOUND).withColumn("rank", rank).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
