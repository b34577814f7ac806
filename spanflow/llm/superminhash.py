"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

Each shingle draws a random permutation of the signature's slots; its rank at slot
``p(j)`` is ``j`` plus a fraction. Ranks of one shingle are thus correlated: no two
slots get the same whole rank, which lowers the variance against independent hashes,
and once every slot of a document holds less than ``j`` no later rank can matter, so
drawing stops early.

Documents with equal shingle sets form a class, and one representative goes on. In a
band's bucket one member, that which meets most others in all its buckets, is the
center and is compared with all others; links join components. Where a bucket still
holds several components, its documents are contested: those outside a center's
component are looked up by their rarest shingles among all contested documents. A
similar pair must share one of these, at places early enough to leave room for the
overlap needed (the prefix and positional filters of set joins, which are exact). So
each pair that shares a bucket is verified, ruled out or already connected, and a
group of copies costs links in proportion to its size.

Nulls, empty texts and texts without words have no shingles and link with nothing.
Fewer words than a shingle make one shingle. Rows that repeat a doc_id share that
id's fate. Texts of any length count whole, one at a time where they are long. Of buckets'
members that meet equally many, that with the largest id is the center; it changes no
result. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanflow.llm import bytework
from spanflow.llm.common import discard, slices, stage, text_rows, utf8
from spanflow.llm.components import connected_components

BANDS, ROWS = 25, 5
SLOTS = BANDS * ROWS
_GOLDEN = 0x9E3779B97F4A7C15


def shingle_sets(raw: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle prints of every text, one after another, and their offsets."""
    start, end, owner = bytework.words(bytework.lower_ascii(raw), at)
    prints = bytework.word_prints(bytework.lower_ascii(raw), start, end)
    first = np.searchsorted(owner, np.arange(len(at)))
    found, offsets = [], [0]
    rolled = np.zeros(max(0, len(prints) - width + 1), np.uint64)
    for k in range(width):
        rolled += prints[k : k + len(rolled)] * bytework.ODD[2 + k]
    rolled = bytework.mix(rolled)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            own = np.sort(rolled[a : b - width + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            weights = bytework.ODD[20 : 20 + b - a]
            own = bytework.mix(np.sum(prints[a:b] * weights, keepdims=True))
        else:
            own = rolled[:0]
        found.append(own)
        offsets.append(offsets[-1] + len(own))
    return np.concatenate(found) if found else rolled[:0], np.array(offsets)


def signatures(elements: np.ndarray, at: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set of elements, as rows of ``slots`` ranks; sets without elements stay infinite."""
    count = len(at) - 1
    ranks = np.full(count * slots, np.inf)
    owner = np.repeat(np.arange(count), np.diff(at))
    swaps: list[np.ndarray] = []  # one small number for each element and step
    small = np.min_scalar_type(slots - 1)
    for j in range(slots):
        draw = bytework.mix(elements + np.uint64((j + 1) * _GOLDEN % 2**64))
        swap = j + ((draw >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(small)
        place = swap.copy()
        for i in range(j - 1, -1, -1):  # undo the swaps of earlier steps
            np.copyto(place, i, where=place == swaps[i])
        swaps.append(swap)
        rank = j + (bytework.mix(draw) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        np.minimum.at(ranks, owner * slots + place, rank)
        going = ranks.reshape(count, slots).max(axis=1) >= j + 1
        more = going[owner]
        if not more.any():
            break
        if not more.all():
            elements, owner = elements[more], owner[more]
            swaps = [s[more] for s in swaps]
    return ranks.reshape(count, slots)


def band_prints(ranks: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One print for each band of a signature; the band's number is part of it."""
    parts = bytework.mix(ranks.view(np.uint64)).reshape(len(ranks), bands, -1)
    rolled = np.zeros(parts.shape[:2], np.uint64)
    for k in range(parts.shape[2]):
        rolled += parts[:, :, k] * bytework.ODD[30 + k]
    return bytework.mix(rolled + np.arange(1, bands + 1, dtype=np.uint64) * bytework.ODD[29])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id``, size and two prints of the shingle set, and the band prints."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            elements, at = shingle_sets(*utf8(batch.column("text")), width)
            sizes = np.diff(at)
            bands = band_prints(signatures(elements, at))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(elements, dtype=np.uint64)))
            others = np.concatenate((np.zeros(1, np.uint64), np.cumsum(bytework.mix(elements * bytework.ODD[28]), dtype=np.uint64)))
            kept = np.where(sizes > 0, BANDS, 0)
            flat = bands[sizes > 0].reshape(-1)
            yield pa.record_batch(
                [
                    batch.column("doc_id"), pa.array(sizes.astype(np.int64)),
                    _signed(sums[at[1:]] - sums[at[:-1]]), _signed(others[at[1:]] - others[at[:-1]]),
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(kept))).astype(np.int32)), _signed(flat)),
                ],
                names=["doc_id", "n_shingles", "print_a", "print_b", "bands"],
            )

    schema = "doc_id bigint, n_shingles bigint, print_a bigint, print_b bigint, bands array<bigint>"
    return docs.mapInArrow(sketch, schema)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "text_high"), "text_low"):
            a, at_a = shingle_sets(*utf8(batch.column("text_low")), width)
            b, at_b = shingle_sets(*utf8(batch.column("text_high")), width)
            shared, union = np.zeros(batch.num_rows, np.int64), np.ones(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                x, y = a[at_a[i] : at_a[i + 1]], b[at_b[i] : at_b[i + 1]]
                if len(x) and len(y):
                    where = np.searchsorted(y, x)
                    where[where == len(y)] = 0
                    shared[i] = (y[where] == x).sum()
                    union[i] = len(x) + len(y) - shared[i]
            good = (shared > 0) & (100 * shared >= percent * union)
            yield pa.RecordBatch.from_arrays(
                [batch.column("low"), batch.column("high")], names=["low", "high"]
            ).filter(pa.array(good))

    first = pairs.join(texts.select(F.col("doc_id").alias("low"), F.col("text").alias("text_low")), "low")
    both = first.join(texts.select(F.col("doc_id").alias("high"), F.col("text").alias("text_high")), "high")
    return both.select("low", "high", "text_low", "text_high").mapInArrow(confirm, "low bigint, high bigint")


def _contested_pairs(contested: DataFrame, texts: DataFrame, width: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs of contested documents of different components that may be similar, and the
    stages that they are read from.

    ``contested`` has ``rep, group, outside``; at least one of a pair is outside.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            elements, at = shingle_sets(*utf8(batch.column("text")), width)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), _signed(elements))
            yield pa.record_batch([batch.column("doc_id"), lists], names=["rep", "shingles"])

    wanted = texts.join(contested.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    sets = wanted.select("doc_id", "text").mapInArrow(listed, "rep bigint, shingles array<bigint>")
    held = sets.select("rep", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    held = stage(held, "contested")
    often = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("often", "shingle"))
    needed = F.ceil(F.col("size") * percent / 100)
    prefixes = (
        held.join(often, "shingle").withColumn("place", place)
        .where((F.col("place") <= F.col("size") - needed + 1) & (F.col("often") > 1))
        .join(contested, "rep").select("shingle", "rep", "group", "outside", "size", "place")
    )
    prefixes = stage(prefixes, "prefixes")
    x, y = (prefixes.select("shingle", *(F.col(c).alias(f"{c}_{side}") for c in prefixes.columns[1:])) for side in "xy")
    room = 1 + F.least(F.col("size_x") - F.col("place_x"), F.col("size_y") - F.col("place_y"))
    fits = (room * (100 + percent) >= percent * (F.col("size_x") + F.col("size_y"))) & (
        100 * F.least("size_x", "size_y") >= percent * F.greatest("size_x", "size_y")
    )
    met = x.where("outside_x").join(y, "shingle").where(
        fits & (F.col("group_x") != F.col("group_y")) & (~F.col("outside_y") | (F.col("rep_x") < F.col("rep_y")))
    )
    pairs = met.select(F.least("rep_x", "rep_y").alias("low"), F.greatest("rep_x", "rep_y").alias("high")).distinct()
    return pairs, [held, prefixes]


def near_duplicate_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row for every row of ``docs``.

    Documents whose sets of ``width``-word shingles have a Jaccard similarity of
    ``percent`` / 100 or more are linked, and component_id is the least id reachable.
    """
    rows = text_rows(docs, doc_id, text)
    drawn = stage(sketches(rows, width), "sketches")
    named = drawn.where("n_shingles > 0 and doc_id is not null")
    same = ["print_a", "print_b", "n_shingles"]
    classes = stage(named.groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")
    # An id that stands for several sets (repeated ids with different texts) draws one row for each.
    members = named.join(classes, same)
    buckets = stage(
        members.where("doc_id = rep").select(F.explode("bands").alias("bucket"), "rep").distinct(), "bands"
    )
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(buckets.join(sizes, "bucket"), "shared")
    discard(buckets)
    met = shared.groupBy("rep").agg(F.sum("n").alias("met"))
    centers = shared.join(met, "rep").groupBy("bucket").agg(F.max_by("rep", F.struct("met", "rep")).alias("center"))
    centered = stage(shared.join(centers, "bucket").select("bucket", "rep", "center"), "centered")
    discard(shared)
    shared = centered

    def pair(x: str, y: str) -> list:
        return [F.least(x, y).alias("low"), F.greatest(x, y).alias("high")]

    pairs = shared.where("rep != center").select(*pair("rep", "center")).distinct()
    needed = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = stage(rows.join(needed, "doc_id").dropDuplicates(["doc_id", "text"]), "texts")
    links = stage(_verified(pairs, texts, width, percent), "links")
    groups = connected_components(links)

    def grouped(found: DataFrame, of: str, name: str) -> DataFrame:
        """Adds the component of an id; ids without links are their own."""
        own = groups.select(F.col("id").alias(of), F.col("component").alias("_c"))
        return found.join(own, of, "left").withColumn(name, F.coalesce("_c", of)).drop("_c")

    # Buckets that still hold more than one component.
    placed = grouped(grouped(shared, "rep", "group"), "center", "main")
    several = placed.where("group != main").select("bucket").distinct()
    contested = stage(
        placed.join(several, "bucket", "left_semi").groupBy("rep", "group")
        .agg(F.max(F.col("group") != F.col("main")).alias("outside")),
        "open",
    )
    found, read = _contested_pairs(contested, texts, width, percent)
    rest = found.join(pairs, ["low", "high"], "left_anti")
    more = stage(_verified(rest, texts, width, percent), "more")
    for done in (*read, contested, shared, texts):
        discard(done)
    # All members of a class; a repeated id with two sets joins their classes.
    copies = members.where("doc_id != rep").select(F.col("rep").alias("low"), F.col("doc_id").alias("high"))
    groups = connected_components(links.union(more).union(copies))
    for done in (classes, links, more):
        discard(done)
    return grouped(
        drawn.select("doc_id", "n_shingles"), "doc_id", "component_id"
    ).select("doc_id", "n_shingles", "component_id")
