"""Removal of repeated word windows by prefix-partitioned suffix trees.

A word is removed where a window of ``width`` words covers it that also starts earlier.

1. Every window picks its least ``gram`` of words as anchor; equal windows pick the
   same one, so windows whose anchor occurs once need no tree. Where an anchored run
   of windows equals another one as a whole, all but the earliest run are repeats.
2. The windows that remain are suffixes, cut off at ``width`` words. They are split by
   prefixes of variable length: a prefix that has more than ``group`` suffixes is made
   longer, until it is the whole window, whose suffixes then are one node.
3. A task gets whole groups, sorts their suffixes and takes the common prefix lengths
   of neighbours: the leaves of each group's suffix tree in order, and the depths of its
   internal nodes. Below a node as deep as a window, all leaves but the earliest repeat.

Counts and joins carry partial results, so no step gathers the copies of one passage.
Sorting within tasks spills; a group holds at most ``group`` suffixes.

A null id counts as smaller than all others; a null text has no words. Rows that repeat
an id and a text are one document in two rows: neither is earlier than the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanflow.llm import bytework
from spanflow.llm.common import KEY, discard, slices, stage, text_rows, utf8, with_key

GRAM = 8
GROUP = 50_000


def _word_values(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prints of all words, their texts, and the first word of each text."""
    raw, at = utf8(text)
    start, end, owner = bytework.words(raw, at)
    return bytework.word_prints(raw, start, end), owner, np.searchsorted(owner, np.arange(len(at)))


def _anchors(width: int, gram: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, owner, first = _word_values(batch.column("text"))
            if len(values) < width:
                continue
            prints = bytework.Prints(values)
            index = np.arange(len(values) - gram + 1)
            grams = prints.of(index, index + gram)
            picked = bytework.least_in_windows(grams, width - gram + 1)
            start = np.flatnonzero(owner[: len(picked)] == owner[width - 1 :])
            if not len(start):
                continue
            anchor, own = picked[start], owner[start]
            new = np.ones(len(start), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(start)) - 1
            low, high, anchor, own = start[heads], start[tails], anchor[heads], own[heads]
            run = bytework.mix(prints.of(low, high + width) + (anchor - low).astype(np.uint64) * bytework.ODD[8])
            source = pa.array(own)
            yield pa.record_batch(
                [
                    batch.column("key_id").take(source), batch.column("key_text").take(source),
                    pa.array(low - first[own]), pa.array((high - low).astype(np.int32)),
                    pa.array(grams[anchor].view(np.int64)), pa.array(run.view(np.int64)),
                ],
                names=["key_id", "key_text", "start", "spread", "gram", "run"],
            )

    return scan


def _suffixes(width: int, depths: list[int]):
    """A row for each window of the open runs: its prefixes' prints, and short prints of
    the words after the shortest prefix, the edges below its node."""
    below = width - depths[0]

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, _, first = _word_values(batch.column("text"))
            prints = bytework.Prints(values)
            lists = batch.column("runs")
            rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            found = lists.flatten()
            low, spread = (found.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2))
            count = spread + 1
            run = np.repeat(np.arange(len(rows)), count)
            start = low[run] + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
            place = first[rows[run]] + start
            words = (values[place[:, None] + np.arange(depths[0], width)].reshape(-1) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            ends = pa.array(np.arange(0, len(words) + 1, below, dtype=np.int32))
            taken = pa.array(rows[run])
            yield pa.record_batch(
                [
                    batch.column("key_id").take(taken), batch.column("key_text").take(taken), pa.array(start),
                    pa.ListArray.from_arrays(ends, pa.array(words)),
                    *(pa.array(prints.of(place, place + d).view(np.int64)) for d in depths[:-1]),
                ],
                names=["key_id", "key_text", "start", "words", *(f"prefix_{d}" for d in depths[:-1])],
            )

    return explode


def _repeated_leaves(below: int):
    """Of suffixes sorted by words and place: those below a node of full depth that are not its earliest leaf."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: np.ndarray | None = None  # the last leaf, and the earliest of its node
        head = (0, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("words").flatten().to_numpy(zero_copy_only=False).reshape(-1, below)
            words = np.concatenate((batch.column("prefix").to_numpy(zero_copy_only=False)[:, None], words), axis=1)
            ids = batch.column("key_id").to_numpy(zero_copy_only=False)
            starts = batch.column("start").to_numpy(zero_copy_only=False)
            above = np.concatenate((words[:1] if before is None else before[None], words[:-1]))
            equal = words == above
            # Edges shared with the leaf before; a leaf that shares all is below the same deepest node.
            depth = np.where(equal.all(axis=1), below + 1, equal.argmin(axis=1))
            new = depth <= below
            if before is None:
                new[0] = True
            node = np.cumsum(new)  # 0: the node that the batch before left open
            heads_id = np.concatenate(([head[0]], ids[new]))
            heads_start = np.concatenate(([head[1]], starts[new]))
            later = (ids != heads_id[node]) | (starts != heads_start[node])
            before, head = words[-1].copy(), (int(heads_id[node[-1]]), int(heads_start[node[-1]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("key_id", "key_text", "start")], names=["key_id", "key_text", "start"]
            ).filter(pa.array(later))

    return walk


def repeated_windows(keyed: DataFrame, width: int = 20, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``key_id, key_text, start, end`` in words: stretches of windows that start earlier too."""
    scanned = stage(
        keyed.mapInArrow(_anchors(width, gram), "key_id bigint, key_text bigint, start bigint, spread int, gram bigint, run bigint"),
        "anchors",
    )
    often = scanned.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    often = stage(often, "often")  # written out, so that Spark can split large keys of the join
    repeated = stage(scanned.join(often, "gram"), "repeated")
    discard(scanned)
    # The earliest of equal runs, and whether its anchor has other runs.
    kinds = repeated.groupBy("gram", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key_id", "start")).alias("earliest")
    )
    kinds = stage(kinds, "kinds")
    mixed = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").drop("kinds")
    judged = repeated.join(kinds.where("n > 1").drop("n"), ["gram", "run"])
    whole = judged.where(F.struct("key_id", "start") != F.col("earliest")).select(
        *KEY, "start", (F.col("start") + F.col("spread") + width).alias("end")
    )
    firsts = (
        kinds.join(mixed, "gram", "left_semi").select("gram", "run", "earliest.*")
        .join(repeated, ["gram", "run", "key_id", "start"]).dropDuplicates(["gram", "run"])
    )
    by_text = firsts.groupBy(*KEY).agg(F.collect_list(F.struct("start", "spread")).alias("runs"))
    depths = sorted({*range(gram, width, gram), width})
    schema = "key_id bigint, key_text bigint, start bigint, words array<int>, " + ", ".join(f"prefix_{d} bigint" for d in depths[:-1])
    suffixes = stage(
        keyed.select(*KEY, "text").join(by_text, KEY).dropDuplicates(KEY).mapInArrow(_suffixes(width, depths), schema),
        "suffixes",
    )
    written, done = suffixes, []
    for d in depths[:-1]:
        crowd = suffixes.groupBy(f"prefix_{d}").agg(F.count(F.lit(1)).alias("n")).where(f"n > {group}").drop("n")
        crowd = stage(crowd, "crowded")  # at most a row for each ``group`` suffixes
        part = suffixes.join(crowd, f"prefix_{d}", "left_anti")
        done.append(part.select(*KEY, "start", "words", F.col(f"prefix_{d}").alias("group"), F.col(f"prefix_{depths[0]}").alias("prefix")))
        suffixes = suffixes.join(crowd, f"prefix_{d}", "left_semi")
        if crowd.isEmpty():
            break
    else:
        # Prefixes as long as a window: every group is one node.
        node = [f"prefix_{depths[0]}", "words"]
        nodes = suffixes.groupBy(*node).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key_id", "start")).alias("earliest"))
        last = suffixes.join(stage(nodes.where("n > 1"), "nodes"), node).where(F.struct("key_id", "start") != F.col("earliest"))
        whole = whole.union(last.select(*KEY, "start", (F.col("start") + width).alias("end")))
    for part in done:
        leaves = (
            part.repartition("group").sortWithinPartitions("prefix", "words", "key_id", "start")
            .mapInArrow(_repeated_leaves(width - depths[0]), "key_id bigint, key_text bigint, start bigint")
        )
        whole = whole.union(leaves.select(*KEY, "start", (F.col("start") + width).alias("end")))
    spans = stage(whole, "spans")
    for frame in (repeated, kinds, written):
        discard(frame)
    return spans


def _kept_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = utf8(batch.column("text"))
        total, removed, kept = [], [], []
        for i, found in enumerate(batch.column("spans").to_pylist()):
            words = raw[at[i] : at[i + 1]].tobytes().split()
            total.append(len(words))
            if found:
                edges = np.zeros(len(words) + 1, np.int32)
                np.add.at(edges, [s["start"] for s in found], 1)
                np.add.at(edges, [s["end"] for s in found], -1)
                stays = np.cumsum(edges)[:-1] == 0
                words = list(compress(words, stays.tolist()))
            removed.append(total[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def without_repeated_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 20, gram: int = GRAM, group: int = GROUP
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs``: the words that stay,
    joined by one space, as UTF-8 bytes."""
    keyed = with_key(text_rows(docs, doc_id, text))
    spans = repeated_windows(keyed, width, gram, group)
    by_text = spans.groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return keyed.join(by_text, KEY, "left").select("doc_id", "text", "spans").mapInArrow(
        _kept_words, "doc_id bigint, n_words bigint, n_removed bigint, kept binary"
    )
