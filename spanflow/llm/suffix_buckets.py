"""Exact removal of long repeated byte strings, by bucket-pointer refinement of suffixes.

Suffixes are compared by the identifiers of the buckets that they and their later
offsets fall into, never byte by byte: a bucket identifier is a 64-bit fingerprint of
the stretch that its suffixes share, so the identifier at any offset and of any
length is at hand from prefix sums, and a refined bucket's identifier serves the next
refinement as its pointer.

1. Initial q-gram buckets. Every window of ``length`` bytes picks its least q-gram as
   anchor; equal windows pick the same one. Only anchored suffixes go into buckets,
   one for about (length - q) / 2 bytes, with the run of windows that picked them.
   A bucket with one suffix is done: its windows occur once.
2. A bucket whose suffixes agree in the identifier of their whole run is done: all its
   windows are repeats. Others are refined; of suffixes that agree one goes on for all.
3. Runs are cut into blocks of window starts at fixed distances from the anchor, and
   buckets are split by the identifier of the stretch common to a block's windows.
   Single ones hold no repeat, those that agree in the block's whole stretch only repeats.
4. What is left differs at the fringe of a block, and each of its few windows gets a
   bucket of its own.

All steps are grouped counts with partial results, written out, and joins back to them,
of which Spark splits large keys. So a bucket that holds a third of all suffixes neither
gathers in a task nor makes pairs. Suffixes of one text that agree in their whole run
travel as one row with a list of places, however often a line repeats in it.

A null text counts as empty; a text shorter than ``length`` keeps all bytes. Rows that
repeat one another are copies like any other. Texts of any length work, since they are
cut into overlapping pieces for the scan for anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanflow.llm import bytework
from spanflow.llm.common import KEY, discard, segments, slices, stage, text_rows, utf8, with_key

GRAM = 128
BLOCK = 16
_ANCHOR = "key_id bigint, key_text bigint, places array<bigint>, lead int, spread int, gram bigint, run bigint"


def _anchors(length: int, gram: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at, places, batch in segments(batches, length - 1):
            if len(raw) < length:
                continue
            prints = bytework.Prints(bytework.BYTE_VALUE[raw])
            index = np.arange(len(raw) - gram + 1)
            grams = prints.of(index, index + gram)
            picked = bytework.least_in_windows(grams, length - gram + 1)
            owner = np.repeat(np.arange(len(rows)), np.diff(at))[: len(picked)]
            start = np.flatnonzero(np.arange(len(picked)) + length <= at[owner + 1])
            if not len(start):
                continue
            anchor, own = picked[start], owner[start]
            new = np.ones(len(start), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(start)) - 1
            low, high, anchor, own = start[first], start[last], anchor[first], own[first]
            lead, spread = anchor - low, high - low
            run = bytework.mix(prints.of(low, high + length) + lead.astype(np.uint64) * bytework.ODD[5])
            # Suffixes of a text that agree in their whole run are one row with many places.
            order = np.lexsort((anchor, run, own))
            own, anchor, run, lead, spread = own[order], anchor[order], run[order], lead[order], spread[order]
            gram_of = grams[anchor]
            head = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (run[1:] != run[:-1]) | (gram_of[1:] != gram_of[:-1])))
            lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(own)).astype(np.int32)), pa.array(places[own] + anchor - at[own]))
            source = pa.array(rows[own[head]])
            yield pa.record_batch(
                [
                    batch.column("key_id").take(source), batch.column("key_text").take(source), lists,
                    pa.array(lead[head].astype(np.int32)), pa.array(spread[head].astype(np.int32)),
                    pa.array(gram_of[head].view(np.int64)), pa.array(run[head].view(np.int64)),
                ],
                names=["key_id", "key_text", "places", "lead", "spread", "gram", "run"],
            )

    return scan


def _contexts(length: int):
    """The bytes of each open suffix's run, cut from its text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, at = utf8(batch.column("text"))
            lists = batch.column("suffixes")
            count = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            source = np.repeat(np.arange(batch.num_rows), count)
            found = lists.flatten()
            place, lead, spread = (found.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
            low = at[source] + place - lead
            cuts = [raw[a : a + n].tobytes() for a, n in zip(low, spread + length, strict=True)]
            taken = pa.array(source)
            yield pa.record_batch(
                [batch.column("key_id").take(taken), batch.column("key_text").take(taken), *(found.field(k) for k in range(4)), pa.array(cuts, pa.binary())],
                names=["key_id", "key_text", "place", "lead", "spread", "gram", "bytes"],
            )

    return cut


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and each value's offset."""
    values = column.to_pylist()
    at = np.cumsum([0] + [len(v) for v in values])
    return np.frombuffer(b"".join(values), np.uint8), at


def _blocks(length: int, block: int):
    """A row for each block of window starts: identifiers of its common and its whole stretch."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = _joined(batch.column("bytes"))
            prints = bytework.Prints(bytework.BYTE_VALUE[raw])
            lead, spread, gram = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("lead", "spread", "gram"))
            lead, spread = lead.astype(np.int64), spread.astype(np.int64)
            least = (lead - spread) // block
            count = lead // block - least + 1
            source = np.repeat(np.arange(batch.num_rows), count)
            number = least[source] + np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count)
            # Window starts from the run's first byte; a larger distance to the anchor starts earlier.
            high = np.minimum(lead[source] - number * block, spread[source])
            low = np.maximum(lead[source] - number * block - block + 1, 0)
            base = at[:-1][source]
            inner = base + lead[source] - number * block
            common = bytework.mix(
                prints.of(inner, inner - block + 1 + length) + number.astype(np.uint64) * bytework.ODD[6]
                + gram[source].view(np.uint64)
            )
            whole = bytework.mix(
                prints.of(base + low, base + high + length)
                + (lead[source] - low).astype(np.uint64) * bytework.ODD[7]
            )
            taken = pa.array(source)
            yield pa.record_batch(
                [
                    *(batch.column(k).take(taken) for k in ("key_id", "key_text", "place")),
                    pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
                    pa.array(common.view(np.int64)), pa.array(whole.view(np.int64)),
                ],
                names=["key_id", "key_text", "place", "low", "high", "common", "whole"],
            )

    return split


def _windows(length: int):
    """A row for each window start of an open block, with two identifiers of its bytes."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = _joined(batch.column("bytes"))
            low, high, place, lead = (
                batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("low", "high", "place", "lead")
            )
            count = high - low + 1
            source = np.repeat(np.arange(batch.num_rows), count)
            start = low[source] + np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count)
            begin = at[:-1][source] + start
            one = bytework.Prints(bytework.BYTE_VALUE[raw]).of(begin, begin + length)
            two = bytework.Prints(bytework.mix(bytework.BYTE_VALUE)[raw]).of(begin, begin + length)
            taken = pa.array(source)
            yield pa.record_batch(
                [
                    batch.column("key_id").take(taken), batch.column("key_text").take(taken),
                    pa.array(place[source] - lead[source] + start), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                ],
                names=["key_id", "key_text", "start", "one", "two"],
            )

    return explode


def repeated_spans(keyed: DataFrame, length: int = 400, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """``key_id, key_text, starts, size`` in bytes: where in a text stretches of ``size``
    bytes start that repeated windows cover.

    ``keyed`` has ``text`` and the columns of ``with_key``. Stretches may overlap.
    """
    if not block <= length - gram + 1:
        raise ValueError("blocks must be shorter than the run of an anchor")
    scanned = stage(keyed.mapInArrow(_anchors(length, gram), _ANCHOR), "anchors")
    buckets = scanned.groupBy("gram").agg(
        F.sum(F.size("places")).alias("n"), F.min("run").alias("low_run"), F.max("run").alias("high_run")
    ).where("n > 1")
    buckets = stage(buckets, "buckets")
    repeated = stage(
        scanned.join(buckets.select("gram", (F.col("low_run") == F.col("high_run")).alias("agreed")), "gram"), "repeated"
    )
    discard(scanned)
    whole_run = [F.transform("places", lambda p: p - F.col("lead")).alias("starts"), (F.col("spread") + length).alias("size")]
    # Within a bucket that is refined: those that agree are repeats, and one of them goes on.
    split = repeated.where("not agreed")
    kinds = split.groupBy("gram", "run").agg(
        F.sum(F.size("places")).alias("n"), F.min(F.struct(*KEY, F.get("places", F.lit(0)).alias("place"))).alias("one")
    )
    kinds = stage(kinds, "kinds")
    judged = split.join(kinds, ["gram", "run"])
    open_rows = kinds.select("gram", "run", "one.*").join(
        split.select("gram", "run", *KEY, F.get("places", F.lit(0)).alias("place"), "lead", "spread"), ["gram", "run", *KEY, "place"]
    ).dropDuplicates(["gram", "run"])
    by_text = open_rows.groupBy(*KEY).agg(F.collect_list(F.struct("place", "lead", "spread", "gram")).alias("suffixes"))
    contexts = stage(
        keyed.select(*KEY, "text").join(by_text, KEY).dropDuplicates(KEY).mapInArrow(
            _contexts(length), "key_id bigint, key_text bigint, place bigint, lead int, spread int, gram bigint, bytes binary"
        ),
        "contexts",
    )
    blocks = contexts.mapInArrow(
        _blocks(length, block),
        "key_id bigint, key_text bigint, place bigint, low int, high int, common bigint, whole bigint",
    )
    refined = blocks.groupBy("common").agg(
        F.count(F.lit(1)).alias("n"), (F.min("whole") == F.max("whole")).alias("agreed")
    ).where("n > 1")
    refined = stage(refined, "refined")
    fringe = stage(blocks.join(refined.select("common", "agreed"), "common"), "fringe")
    places = contexts.select(*KEY, "place", "lead")
    agreed_blocks = fringe.where("agreed").join(places, [*KEY, "place"])
    windows = (
        fringe.where("not agreed").select(*KEY, "place", "low", "high")
        .join(contexts.select(*KEY, "place", "lead", "bytes"), [*KEY, "place"])
        .mapInArrow(_windows(length), "key_id bigint, key_text bigint, start bigint, one bigint, two bigint")
    )
    windows = stage(windows, "windows")
    twice = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    twice = stage(twice, "twice")
    first = F.col("place") - F.col("lead")
    return (
        repeated.where("agreed").select(*KEY, *whole_run)
        .union(judged.where("n > 1").select(*KEY, *whole_run))
        .union(agreed_blocks.select(*KEY, F.array(first + F.col("low")), F.col("high") - F.col("low") + length))
        .union(windows.join(twice, ["one", "two"]).select(*KEY, F.array("start"), F.lit(length)))
    )


def spans_of_texts(keyed: DataFrame, length: int = 400, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """``key_id, key_text, spans`` of the texts that have repeated spans."""
    spans = repeated_spans(keyed, length, gram, block)
    return spans.groupBy(*KEY).agg(F.collect_set(F.struct("starts", "size")).alias("spans"))


def _covered(size: int, spans: list[dict]) -> np.ndarray:
    edges = np.zeros(size + 1, np.int32)
    for span in spans:
        starts = np.array(span["starts"], np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + span["size"], -1)
    return np.cumsum(edges)[:-1] > 0


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = utf8(batch.column("text"))
        spans = batch.column("spans").to_pylist()
        removed, runs, kept = [], [], []
        for i, found in enumerate(spans):
            own = raw[at[i] : at[i + 1]]
            covered = _covered(len(own), found) if found else np.zeros(len(own), bool)
            removed.append(int(covered.sum()))
            runs.append(int((np.diff(covered.astype(np.int8), prepend=0) == 1).sum()))
            kept.append(own[~covered].tobytes())
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("key_text"), pa.array(np.diff(at)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "key_text", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def cut_text(text: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts less their spans, for ``arrow_udf``; a character that is cut in two goes whole."""
    raw, at = utf8(text)
    left = [
        raw[at[i] : at[i + 1]][~_covered(int(at[i + 1] - at[i]), found or [])].tobytes().decode(errors="ignore")
        for i, found in enumerate(spans.to_pylist())
    ]
    return pa.array(left, pa.string())


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400,
    gram: int = GRAM, block: int = BLOCK,
) -> DataFrame:
    """``doc_id, key_text, n_bytes, n_removed, n_spans, kept`` for every row of ``docs``:
    the bytes left when those are removed that a string of ``length`` bytes covers which
    also starts elsewhere. ``key_text`` is xxhash64 of the text."""
    keyed = with_key(text_rows(docs, doc_id, text))
    by_text = spans_of_texts(keyed, length, gram, block)
    return keyed.join(by_text, KEY, "left").select("doc_id", "key_text", "text", "spans").mapInArrow(
        _cut_out, "doc_id bigint, key_text bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )
