"""Language identification by a convolutional network over bytes.

Filters of several widths run over the bytes of fixed-length windows; each keeps its
largest response, and a softmax layer turns these into a language. A filter's weights
are a table of bytes for each of its places, so that a convolution is a sum of table
rows and training touches only the places that won. Training is numpy on the driver,
over a sample of labelled texts whose size is a fixed parameter; scoring is batched
over all windows of every whole text, and a text's score is the softmax of its
windows' mean logits, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanflow.llm.common import held_out, slices, text_rows, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Labelled texts of each language to fit on, and windows of each.
FIT_TEXTS = 600
FIT_WINDOWS = 3
FIT_SLICES = 64


class ByteNetwork:
    def __init__(self, names: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.names, self.rng = names, rng
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        size = FILTERS * len(WIDTHS)
        self.weights = rng.normal(0, 0.3, (size, len(names))).astype(np.float32)
        self.bias = np.zeros(len(names), np.float32)
        self.filter_bias = np.zeros(size, np.float32)

    def pooled(self, x: np.ndarray, places: bool = False):
        """Largest response of every filter in every window, and where it was."""
        found, where = [], []
        for table in self.tables:
            width = len(table)
            span = x.shape[1] - width + 1
            response = table[0][x[:, :span]]
            for k in range(1, width):
                response += table[k][x[:, k : k + span]]
            if places:
                at = response.argmax(axis=1)
                where.append(at)
                found.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
            else:
                found.append(response.max(axis=1))
        return np.concatenate(found, axis=1), where

    def logits(self, x: np.ndarray) -> np.ndarray:
        raw, _ = self.pooled(x)
        return np.maximum(raw + self.filter_bias, 0) @ self.weights + self.bias

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, rate: float = 0.05, batch: int = 32) -> ByteNetwork:
        """Stochastic gradient steps with Adagrad scaling; windows are also cut short at random."""
        scale = [np.full(t.shape, 1e-4, np.float32) for t in (*self.tables, self.weights, self.bias, self.filter_bias)]
        for _ in range(epochs):
            order = self.rng.permutation(len(x))
            for first in range(0, len(x), batch):
                rows = order[first : first + batch]
                bx, by = x[rows].copy(), y[rows]
                cut = self.rng.integers(24, WINDOW, len(rows))
                shorter = self.rng.random(len(rows)) < 0.5
                bx[(np.arange(WINDOW) >= cut[:, None]) & shorter[:, None]] = 0
                raw, where = self.pooled(bx, places=True)
                hidden = np.maximum(raw + self.filter_bias, 0)
                z = hidden @ self.weights + self.bias
                z = np.exp(z - z.max(axis=1, keepdims=True))
                error = z / z.sum(axis=1, keepdims=True)
                error[np.arange(len(rows)), by] -= 1
                error /= len(rows)
                back = (error @ self.weights.T) * (hidden > 0)
                steps = [np.zeros_like(t) for t in self.tables]
                for n, (step, at) in enumerate(zip(steps, where, strict=True)):
                    own = back[:, n * FILTERS : (n + 1) * FILTERS]
                    for k in range(len(step)):
                        seen = np.take_along_axis(bx, at + k, axis=1)
                        np.add.at(step[k], (seen, np.arange(FILTERS)[None, :]), own)
                steps += [hidden.T @ error + 1e-4 * self.weights, error.sum(axis=0), back.sum(axis=0)]
                for value, step, sums in zip((*self.tables, self.weights, self.bias, self.filter_bias), steps, scale, strict=True):
                    sums += step * step
                    value -= rate * step / np.sqrt(sums)
        return self


def windows(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts, padded with zeros; their text, and how many bytes they hold."""
    sizes = np.diff(at)
    count = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), count)
    start = at[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    held = np.minimum(at[1:][owner] - start, WINDOW)
    place = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < held[:, None]
    padded = np.append(raw, np.uint8(0))
    return np.where(inside, padded[np.minimum(place, len(raw))], 0).astype(np.uint8), owner, held


def fit_languages(docs: DataFrame, fit_texts: int = FIT_TEXTS) -> ByteNetwork | None:
    """Fits on ``doc_id, text, lang`` of texts that are not held out: of each language the
    ``fit_texts`` least by a hash of their text, copies once, from each ``FIT_WINDOWS``
    windows at even distances. None without labelled texts.

    Every language is learned; the sample that comes to the driver, at most 3 KB for each
    text, grows with the number of languages and with nothing else.
    """
    usable = docs.where(~held_out(F.col("doc_id"), 4, 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    size = F.length("text")
    cuts = [F.substring("text", F.floor(size * k / FIT_WINDOWS).cast("int") + 1, F.lit(WINDOW)) for k in range(FIT_WINDOWS)]
    hashed = usable.select("lang", F.xxhash64("text").alias("h"), F.array_distinct(F.array(*cuts)).alias("cuts"))
    # Of each language and slice of hashes the least, then the least of these: a language
    # that most texts are in is ranked in many tasks, and each passes on a bounded number.
    some = hashed.dropDuplicates(["lang", "h"]).withColumn("slice", F.pmod("h", F.lit(FIT_SLICES)))
    for keys in (["lang", "slice"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy("h")
        some = some.withColumn("n", F.row_number().over(first)).where(F.col("n") <= fit_texts).drop("n")
    rows = some.orderBy("h", "lang").select("lang", "cuts").toArrow().to_pylist()
    names = sorted({row["lang"] for row in rows})
    if not names:
        return None
    number = {name: k for k, name in enumerate(names)}
    x, y = [], []
    for row in rows:
        for cut in row["cuts"]:
            data = cut.encode()[:WINDOW]
            if data:
                x.append(np.frombuffer(data.ljust(WINDOW, b"\0"), np.uint8))
                y.append(number[row["lang"]])
    return ByteNetwork(names).fit(np.stack(x), np.array(y))


def languages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fit_texts: int = FIT_TEXTS
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    A null text, or one without a letter, is ``und`` with score 0; so is every text where
    no labelled text could be learned from.
    """
    rows = text_rows(docs, doc_id, text)
    labelled = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"), docs[lang].cast("string").alias("lang"))
    network = fit_languages(labelled, fit_texts)
    flagged = rows.withColumn("lettered", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            if network is not None and lettered.any():
                own = batch.filter(pa.array(lettered))
                raw, at = utf8(own.column("text"))
                x, owner, held = windows(raw, at)
                z = np.concatenate([network.logits(x[k : k + 128]) for k in range(0, len(x), 128)])
                sums = np.stack([np.bincount(owner, z[:, c] * held, own.num_rows) for c in range(z.shape[1])], axis=1)
                mean = sums / np.diff(at)[:, None]
                p = np.exp(mean - mean.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                for row, k, c in zip(np.flatnonzero(lettered), range(len(best)), best, strict=True):
                    names[row], scores[row] = network.names[c], p[k, c]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"]
            )

    found = flagged.mapInArrow(predict, "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
