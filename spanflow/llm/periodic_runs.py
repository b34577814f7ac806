"""Periodic runs of words, by maximal pairs of an LCP-interval tree.

Two places of a text are a maximal pair of length m when the m words from either agree,
and neither the words before nor the words after do. If their distance d is at most half
of m, the stretch from the first place to the end of the second copy has period d and
cannot be extended: it is a run, and every run of three periods or more comes from the
pair of its start and the next place where the same words stand. So runs are read off
pairs, with no extension.

For every document, in arrays over a slice of documents:

1. Words become numbers that order as they do. A run of 24 words and three periods gives
   a pair of 16 equal words at least, so only subtrees of the tree from 16 words on matter.
   Their roots are groups of places that share 16 words; a root whose places all follow
   the same word has no pair that differs on the left and goes.
2. Doubling ranks order the places of what is left, and the ranks of each doubling give
   common prefix lengths.
3. Intervals of the tree are closed bottom-up. Each holds the sorted places below it and
   the class of the words on their left, one word or several; a smaller set goes into the
   larger one. A pair is formed only where places from two children become neighbours:
   with d at most m / 2, the pair that spells the least period always is one. Its left
   words must differ. So a root with n places makes about n log n pairs at most, however
   often a word or passage repeats.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanflow.llm import bytework
from spanflow.llm.common import slices, text_rows, utf8

LEAST_WORDS = 24
PERIODS = 3
_LOAD = 1024
_RUN = "start:bigint,length:bigint,period:bigint"


class _Places:
    """Places in order, in blocks, and the word that stands left of all of them, or -2
    where there are several."""

    def __init__(self, place: int, left: int):
        self.blocks, self.least, self.size, self.left = [[place]], [place], 1, left

    def add(self, place: int) -> tuple[int, int]:
        """Puts the place in; returns its neighbours, -1 where there is none."""
        k = max(bisect_left(self.least, place) - 1, 0)
        block = self.blocks[k]
        at = bisect_left(block, place)
        before = block[at - 1] if at else self.blocks[k - 1][-1] if k else -1
        after = block[at] if at < len(block) else self.blocks[k + 1][0] if k + 1 < len(self.blocks) else -1
        block.insert(at, place)
        if not at:
            self.least[k] = place
        if len(block) > 2 * _LOAD:
            self.blocks[k : k + 1] = [block[:_LOAD], block[_LOAD:]]
            self.least.insert(k + 1, block[_LOAD])
        self.size += 1
        return before, after

    def __iter__(self):
        for block in self.blocks:
            yield from block


def _merge(one: _Places, two: _Places, common: int, left: np.ndarray, pairs: list) -> _Places:
    """Both sets as one, and the maximal pairs of ``common`` words among new neighbours.
    Places of the smaller set that neighbour each other formed their pairs below."""
    if one.size < two.size:
        one, two = two, one
    mixed = one.left == -2 or two.left == -2 or one.left != two.left
    for place in two:
        before, after = one.add(place)
        if mixed:
            if before >= 0 and 2 * (place - before) <= common and left[before] != left[place]:
                pairs.append((before, place, common))
            if after >= 0 and 2 * (after - place) <= common and left[after] != left[place]:
                pairs.append((place, after, common))
    if mixed:
        one.left = -2
    return one


def _pairs(places: np.ndarray, common: np.ndarray, left: np.ndarray) -> list[tuple[int, int, int]]:
    """Maximal pairs of suffixes in order, ``common[i]`` words shared by i - 1 and i.

    Intervals stand on a stack with the words that their suffixes share; one is closed
    when the next suffix shares fewer.
    """
    pairs: list[tuple[int, int, int]] = []
    stack: list[tuple[int, _Places]] = []
    for place, shared in zip(places.tolist(), [*common[1:].tolist(), 0], strict=True):
        now = _Places(place, int(left[place]))
        while stack and stack[-1][0] > shared:
            deep, below = stack.pop()
            now = _merge(below, now, deep, left, pairs)
        if stack and stack[-1][0] == shared:
            now = _merge(stack.pop()[1], now, shared, left, pairs)
        if shared:
            stack.append((shared, now))
    return pairs


def _ranks(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Ranks of pairs, equal for equal ones."""
    joined = one.astype(np.int64) * (int(two.max(initial=0)) + 2) + two + 1
    return np.unique(joined, return_inverse=True)[1]


def _shifted(rank: np.ndarray, step: int, end: np.ndarray) -> np.ndarray:
    """Rank of the place ``step`` words on, -1 beyond the document's end."""
    later = np.full(len(rank), -1, np.int64)
    if step < len(rank):
        inside = np.arange(len(rank)) + step < end
        later[inside] = rank[np.flatnonzero(inside) + step]
    return later


def find_runs(
    word: np.ndarray, doc: np.ndarray, least_words: int = LEAST_WORDS, periods: int = PERIODS
) -> np.ndarray:
    """Runs of at least ``least_words`` words and ``periods`` periods: rows of first place,
    length and period, by place and period. ``word`` holds numbers, ``doc`` numbers the
    documents, which stand one after the other."""
    none = np.zeros((0, 3), np.int64)
    if periods < 3:
        raise ValueError("pairs at half their length show runs of three periods or more")
    # A run of L words and period q <= L / periods has a pair of L - q words.
    root = least_words - least_words // periods
    if len(word) < least_words:
        return none
    size = np.bincount(doc)
    end = np.cumsum(size)[doc]
    left = np.empty(len(word), np.int64)
    left[1:], left[0] = word[:-1], -1
    left[np.append(True, doc[1:] != doc[:-1])] = -1

    # Roots by fingerprints: only documents that have one with several left words go on.
    prints = bytework.Prints(bytework.mix(word.astype(np.uint64) + np.uint64(1)))
    index = np.flatnonzero(np.arange(len(word)) + root <= end)
    gram = bytework.mix(prints.of(index, index + root) + doc[index].astype(np.uint64) * bytework.ODD[9])
    order = np.argsort(gram, kind="stable")
    gram, index = gram[order], index[order]
    new = np.append(True, gram[1:] != gram[:-1])
    group = np.cumsum(new) - 1
    first_left = left[index[np.flatnonzero(new)]][group]
    several = np.bincount(group, weights=left[index] != first_left) > 0
    index = np.sort(index[several[group]])
    if not len(index):
        return none

    chosen = np.zeros(int(doc[-1]) + 1, bool)
    chosen[doc[index]] = True
    inside = chosen[doc]
    moved = np.cumsum(inside) - 1
    own_doc, own_left, own_end = doc[inside], left[inside], moved[end[inside] - 1] + 1
    places = moved[index]
    # Doubling: levels[k] ranks the stretches of 2**k words that fit the document or end with it.
    levels = [np.unique(word[inside], return_inverse=True)[1]]
    levels[0] = _ranks(own_doc, levels[0])
    step = 1
    while step < int(size.max()) and len(np.unique(levels[-1][places])) < len(places):
        levels.append(_ranks(levels[-1], _shifted(levels[-1], step, own_end)))
        step *= 2
    places = places[np.argsort(levels[-1][places], kind="stable")]
    common = np.zeros(len(places), np.int64)
    one, two = places[:-1].copy(), places[1:].copy()
    alike = own_doc[one] == own_doc[two]
    for k in range(len(levels) - 1, -1, -1):
        fits = alike.copy()
        safe_one, safe_two = np.minimum(one, len(own_doc) - 1), np.minimum(two, len(own_doc) - 1)
        # Equal ranks name equal stretches; those cut short by the end differ in length.
        fits &= (one < own_end[places[:-1]]) & (two < own_end[places[1:]]) & (levels[k][safe_one] == levels[k][safe_two])
        one, two = one + fits * (1 << k), two + fits * (1 << k)
        common[1:] += fits * (1 << k)
    common[common < root] = 0
    found = _pairs(places, common, own_left)
    if not found:
        return none
    back = np.flatnonzero(inside)
    pair = np.array(found, np.int64)
    start, period = back[pair[:, 0]], pair[:, 1] - pair[:, 0]
    length = pair[:, 2] + period
    good = (length >= least_words) & (length >= periods * period)
    start, length, period = start[good], length[good], period[good]
    # Before all children of an interval are in, a multiple of the period can be a neighbour.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    runs = np.stack([start[least], length[least], period[least]], axis=1)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _texts(raw: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, rows: int) -> pa.Array:
    """For each row the bytes of its words, joined by one space."""
    size = end - start + 1
    place = np.cumsum(size) - size
    if len(start):
        source = np.arange(int(size.sum())) + np.repeat(start - place, size)
        data = np.append(raw, 32)[source].astype(np.uint8)
        data[place + size - 1] = 32
        # The space behind the last word of a row goes.
        last = np.append(doc[1:] != doc[:-1], True)
        data = np.delete(data, (place + size - 1)[last])
    else:
        data = np.zeros(0, np.uint8)
    length = np.bincount(doc, weights=size, minlength=rows).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(length - (length > 0))]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), rows, [None, pa.py_buffer(at), pa.py_buffer(data)])


def _collapse(least_words: int, periods: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, at = utf8(batch.column("text"))
            start, end, doc = bytework.words(raw, at) if len(raw) else (np.zeros(0, np.int64),) * 3
            word = np.unique(bytework.word_prints(raw, start, end), return_inverse=True)[1] if len(start) else start
            runs = find_runs(word, doc, least_words, periods)
            edges = np.zeros(len(word) + 1, np.int64)
            np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
            np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
            stays = np.cumsum(edges)[:-1] == 0
            n_words = np.bincount(doc, minlength=batch.num_rows)
            first = np.cumsum(n_words) - n_words
            own = doc[runs[:, 0]]
            offsets = np.searchsorted(own, np.arange(batch.num_rows + 1)).astype(np.int32)
            found = pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - first[own]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], names=["start", "length", "period"]
            )
            yield pa.record_batch(
                [
                    batch.column("doc_id"), pa.array(n_words), pa.ListArray.from_arrays(pa.array(offsets), found),
                    _texts(raw, start[stays], end[stays], doc[stays], batch.num_rows),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return work


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, periods: int = PERIODS
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    A run is a stretch of words with least period q, at least ``least_words`` words and
    ``periods`` (three or more) times q long, that no neighbouring word extends. ``runs``
    are by start, then period, with word numbers from 0; ``collapsed`` is the text less
    what follows the first q words of a run, its words joined by one space.

    Words are what stands between blanks, tabs and line ends. A null or empty text has no
    words, no runs and an empty ``collapsed``. Rows are independent: repeated rows and null
    ids are rows like others, and other columns take no part. A text is worked on whole,
    about 60 bytes of arrays for each of its bytes.
    """
    return text_rows(docs, doc_id, text).mapInArrow(
        _collapse(least_words, periods), f"doc_id bigint, n_words bigint, runs array<struct<{_RUN}>>, collapsed string"
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of about every tenth document, by the checksum of its id, the words
    from some place on become periodic, joined by one space. Null ids are left alone."""
    rows = text_rows(docs)
    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = rows.withColumn("_g", F.when(check % 10 == 0, F.expr("div(crc32(cast(cast(doc_id as string) as binary)), 10)")))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    rows = rows.withColumn("_w", F.when(F.col("_g").isNotNull(), words))
    rows = rows.withColumn("_n", F.when(F.size("_w") > 0, F.size("_w")))
    rows = rows.withColumn("_a", (F.col("_g") % F.col("_n")).cast("int"))
    rows = rows.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    tail = F.slice("_w", F.col("_a") + 1, F.col("_p"))
    times = F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int")
    changed = F.concat(F.slice("_w", F.lit(1), F.col("_a")), F.slice(F.flatten(F.array_repeat(tail, times)), F.lit(1), F.col("_n") - F.col("_a")))
    text = F.when(F.col("_n").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))
