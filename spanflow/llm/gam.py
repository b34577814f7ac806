"""A generalised additive model with pairwise interactions, cyclically boosted.

Features are computed from every whole text. Each boosting round visits the features
in turn and adds to a feature's lookup table the leaves of a shallow tree on its bins;
then the strongest pairs are found on what is left over and get two-way tables in the
same manner. A score is a sum of table entries, so scoring is a gather for each table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanflow.llm import bytework
from spanflow.llm.common import held_out, slices, stage, text_rows, utf8

FEATURES = [
    "log_bytes", "log_words", "bytes_per_word", "distinct_words", "distinct_pairs", "repeated_next",
    "most_frequent", "upper", "digits", "symbols", "bars", "marks", "symbol_ends", "upper_words",
    "non_ascii", "lines_per_word", "longest_word", "one_letter_words", "repeated_lines",
]
FIT_ROWS = 20_000
_BINS = 32
_LINE = np.zeros(256, bool)
_LINE[10] = True


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def text_features(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text; an empty text is all zeros."""
    n = len(at) - 1
    bytes_ = np.diff(at).astype(float)
    start, end, owner = bytework.words(raw, at)
    prints = bytework.word_prints(raw, start, end)
    count = np.bincount(owner, minlength=n).astype(float)
    by_text = lambda w: np.bincount(owner, w, minlength=n)

    def of_bytes(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask)))
        return (sums[at[1:]] - sums[at[:-1]]).astype(float)

    def distinct(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values of each text, and the count of its most frequent one."""
        if not len(values):
            return np.zeros(n), np.zeros(n)
        order = np.lexsort((values, of))
        v, o = values[order], of[order]
        new = np.concatenate(([True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])))
        runs = np.diff(np.append(np.flatnonzero(new), len(v)))
        most = np.zeros(n)
        np.maximum.at(most, o[new], runs)
        return np.bincount(o[new], minlength=n).astype(float), most

    together = owner[1:] == owner[:-1]
    pairs = bytework.mix(prints[1:] * bytework.ODD[2] + prints[:-1])[together]
    pair_owner = owner[1:][together]
    kinds, most = distinct(prints, owner)
    pair_kinds, _ = distinct(pairs, pair_owner)
    same_next = np.bincount(pair_owner, (prints[1:] == prints[:-1])[together], minlength=n)
    upper = (raw >= 65) & (raw <= 90)
    lower = (raw >= 97) & (raw <= 122)
    digit = (raw >= 48) & (raw <= 57)
    symbol = (raw > 32) & (raw < 127) & ~upper & ~lower & ~digit
    plain = np.isin(raw, np.frombuffer(b".,;:'\"-()", np.uint8))
    upper_sums = np.concatenate(([0], np.cumsum(upper | (raw >= 128))))
    longest = np.zeros(n)
    np.maximum.at(longest, owner, (end - start).astype(float))
    line_start, line_end, line_owner = bytework.words(raw, at, _LINE)
    line_count = np.bincount(line_owner, minlength=n).astype(float)
    line_kinds, _ = distinct(bytework.word_prints(raw, line_start, line_end), line_owner)
    last = raw[end - 1] if len(end) else raw[:0]
    table = [
        np.log1p(bytes_), np.log1p(count), _share(bytes_, count), _share(kinds, count),
        _share(pair_kinds, count - 1), _share(same_next, count), _share(most, count),
        _share(of_bytes(upper), bytes_), _share(of_bytes(digit), bytes_),
        _share(of_bytes(symbol & ~plain), bytes_), _share(of_bytes(raw == 124), bytes_),
        _share(of_bytes((raw == 33) | (raw == 63)), bytes_),
        _share(by_text((symbol & ~plain)[end - 1]) if len(end) else np.zeros(n), count),
        _share(by_text(((upper_sums[end] - upper_sums[start]) == end - start) & (end - start > 1)), count),
        _share(of_bytes(raw >= 128), bytes_), _share(line_count, count), np.log1p(longest),
        _share(by_text((end - start == 1) & (last < 128)), count), 1 - _share(line_kinds, line_count) * (line_count > 0) - (line_count == 0),
    ]
    return np.stack(table, axis=1)


def feature_rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key_text`` (xxhash64 of the text) and ``features`` of every whole text."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = text_features(*utf8(batch.column("text")))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.reshape(-1)), len(FEATURES))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("key_text"), lists.cast(pa.list_(pa.float64()))],
                names=["doc_id", "key_text", "features"],
            )

    keyed = docs.withColumn("key_text", F.xxhash64("text"))
    return keyed.mapInArrow(compute, "doc_id bigint, key_text bigint, features array<double>")


class AdditiveModel:
    """Bin edges, one table for each feature, and two-way tables for pairs."""

    def __init__(self, rounds: int = 150, pair_rounds: int = 60, pairs: int = 8, rate: float = 0.1):
        self.rounds, self.pair_rounds, self.n_pairs, self.rate = rounds, pair_rounds, pairs, rate

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        """Labels are 0 and 1; with one label or no rows the score is a constant."""
        width = x.shape[1]
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, _BINS + 1)[1:-1])) if len(x) else np.zeros(0) for k in range(width)]
        self.tables = [np.zeros(_BINS) for _ in range(width)]
        self.pair_tables: dict[tuple[int, int], np.ndarray] = {}
        mean = (y.sum() + 0.5) / (len(y) + 1.0)
        self.bias = float(np.log(mean / (1 - mean)))
        if len(np.unique(y)) < 2:
            return self
        b = self.bins(x)
        raw = np.full(len(y), self.bias)
        for _ in range(self.rounds):
            for k in range(width):
                step = self._tree(*self._sums(b[:, k], y, raw, _BINS))
                self.tables[k] += step
                raw += step[b[:, k]]
        coarse = b // 4
        gains = []
        for i in range(width):
            for j in range(i):
                g, h = self._sums(coarse[:, i] * 8 + coarse[:, j], y, raw, 64)
                gains.append((float((g * g / (h + 1)).sum()), i, j))
        for _, i, j in sorted(gains, reverse=True)[: self.n_pairs]:
            self.pair_tables[i, j] = np.zeros((8, 8))
        for _ in range(self.pair_rounds):
            for (i, j), table in self.pair_tables.items():
                g, h = self._sums(coarse[:, i] * 8 + coarse[:, j], y, raw, 64)
                step = self._cross(g.reshape(8, 8), h.reshape(8, 8))
                table += step
                raw += step[coarse[:, i], coarse[:, j]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        raw = np.full(len(x), self.bias)
        for k, table in enumerate(self.tables):
            raw += table[b[:, k]]
        for (i, j), table in self.pair_tables.items():
            raw += table[b[:, i] // 4, b[:, j] // 4]
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))

    @staticmethod
    def _sums(key: np.ndarray, y: np.ndarray, raw: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        return np.bincount(key, y - p, size), np.bincount(key, p * (1 - p), size)

    def _leaf(self, g: float, h: float) -> float:
        return self.rate * g / (h + 1.0)

    def _tree(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Leaves of the best tree with two cuts at most, as an addition to the table."""
        out = np.zeros(len(g))
        spans = [(0, len(g))]
        for _ in range(2):
            best, cut = 1e-9, None
            for a, b in spans:
                if b - a < 2:
                    continue
                gs, hs = np.cumsum(g[a:b]), np.cumsum(h[a:b])
                left = gs[:-1] ** 2 / (hs[:-1] + 1)
                right = (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1)
                gain = left + right - gs[-1] ** 2 / (hs[-1] + 1)
                at = int(np.argmax(gain))
                if gain[at] > best:
                    best, cut = gain[at], (a, b, a + at + 1)
            if cut is None:
                break
            a, b, m = cut
            spans.remove((a, b))
            spans += [(a, m), (m, b)]
        for a, b in spans:
            out[a:b] = self._leaf(g[a:b].sum(), h[a:b].sum())
        return out

    def _cross(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Leaves of the best tree that cuts both features once."""
        gs, hs = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h))
        best, cut = -1.0, (4, 4)
        quarters = lambda s, i, j: (s[i, j], s[i, 8] - s[i, j], s[8, j] - s[i, j], s[8, 8] - s[i, 8] - s[8, j] + s[i, j])
        for i in range(1, 8):
            for j in range(1, 8):
                gain = sum(a * a / (b + 1) for a, b in zip(quarters(gs, i, j), quarters(hs, i, j), strict=True))
                if gain > best:
                    best, cut = gain, (i, j)
        i, j = cut
        leaves = [self._leaf(a, b) for a, b in zip(quarters(gs, i, j), quarters(hs, i, j), strict=True)]
        out = np.empty((8, 8))
        out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:] = leaves
        return out


def fit_quality(features: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> AdditiveModel:
    """Fits on at most ``fit_rows`` labelled rows that are not held out, the least by a
    hash of the id; a bound on the sample of a classifier, and on what the driver reads."""
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "quality in (0, 1)"
    )
    rows = (
        usable.where(~held_out(F.col("doc_id"), 5, 0)).distinct()
        .join(features, "doc_id")
        .select("features", "quality", F.xxhash64("doc_id").alias("h"), F.hash("features").alias("f"))
        .orderBy("h", "f", "quality")
        .limit(fit_rows)
        .toArrow()
    )
    x = np.array(rows.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
    return AdditiveModel().fit(x, np.array(rows.column("quality").to_pylist(), float))


def quality_scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    threshold: float = 0.3, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``doc_id, key_text, held_out, score, predicted`` for every row of ``docs``.

    A null or empty text scores as a text without words. A null id is not held out and
    never labelled. Without usable labels every score is 0.5. Equal texts get equal scores,
    very long ones one at a time; an id with several texts gets a row, and in the fit a
    labelled row, for each. Labels that contradict one another all count. Only the columns
    named are read, so others cannot clash.
    """
    features = stage(feature_rows(text_rows(docs, doc_id, text)), "features")
    model = fit_quality(features, labels, fit_rows)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("key_text"), pa.array(model.score(x))],
                names=["doc_id", "key_text", "score"],
            )

    scored = features.mapInArrow(apply, "doc_id bigint, key_text bigint, score double")
    return scored.select(
        "doc_id", "key_text", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
