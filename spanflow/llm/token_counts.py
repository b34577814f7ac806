"""Exact token counts of whole texts, huge ones, of 16 KiB and more, by overlap resynchronisation.

A huge text is encoded in chunks that overlap. Each chunk's tokens come with their
character offsets. Two neighbours are spliced where a token begins at the same
character in both and the character before is white space: the tokenizer splits
there whatever stands before, so both encodings agree from that place on, which is
checked on the tokens that follow within the overlap. If no such place exists, or the
tokens differ, the overlap is widened until it does, at last to the whole text.

Texts that are not huge are cut at blanks, tabs and line ends, stable places by the
same argument, and each distinct piece of a batch is encoded once; a worker
remembers the counts of a fixed number of pieces. This needs a tokenizer that drops
white space, which is tested on the tokenizer when it is loaded; others encode whole texts.

A null text counts as empty: no bytes, no tokens. Special strings inside texts count as
the library handles them by default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanflow.llm import bytework
from spanflow.llm.byte_bpe import worker_cache
from spanflow.llm.common import slices, text_rows, utf8

#: Bytes from which on a text counts as huge; characters of a chunk, and of the first overlap.
HUGE = 16_384
CHUNK = 8_192
OVERLAP = 256
#: Tokens after a splice that both chunks must share, where the overlap has as many.
AGREE = 8
#: Pieces whose counts a worker remembers; further ones are encoded in each batch.
REMEMBERED = 500_000
BLANKS = " \t\n\x0b\x0c\r"


def load(path: str):
    """The worker's tokenizer, and whether it drops white space."""
    cache = worker_cache()
    if path not in cache:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
        drops = all(encode(f"Ab{s}cd") == encode("Ab") + encode("cd") and not encode(s) for s in (*BLANKS, " \n "))
        cache[path] = tokenizer, drops
    return cache[path]


def _boundary(text: str, left, right, start: int, end: int) -> tuple[int, int] | None:
    """Token numbers, in two encodings, of the first stable common start in [start, end)."""
    by_start = {right[k][0]: k for k in range(len(right) - 1, -1, -1)}  # several tokens can share a character
    for k, (a, _) in enumerate(left):
        if start < a < end and text[a - 1] in BLANKS and a in by_start:
            other = by_start[a]
            both = min(AGREE, len(left) - k - 1, len(right) - other)  # a chunk's last token may be cut off
            if both > 0 and left[k : k + both] == right[other : other + both]:
                return k, other
    return None


def encoded_in_chunks(text: str, offsets, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """The character spans of all tokens of ``text``. ``offsets`` encodes a string to its tokens' spans."""
    done: list[tuple[int, int]] = []
    left = offsets(text[:chunk])
    end = min(chunk, len(text))
    while end < len(text):
        wide = overlap
        while True:
            begin = max(0, end - wide)
            stop = min(len(text), end + chunk)
            right = [(a + begin, b + begin) for a, b in offsets(text[begin:stop])]
            if begin == 0:
                left, done = right, []
                break
            cut = _boundary(text, left, right, begin, end)
            if cut is not None:
                done += left[: cut[0]]
                left = right[cut[1] :]
                break
            if left and begin <= left[0][0] and done:  # the overlap spans the chunk: take up what was spliced off
                left, done = done + left, []
            wide *= 2
        end = stop
    return done + left


def _counts(texts: list[str], tokenizer) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", huge_bytes: int = HUGE) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row of ``docs``; texts of ``huge_bytes`` or
    more are encoded in chunks, which changes no count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already fill the cores
        tokenizer, drops = load(path)
        known: dict[int, int] = worker_cache().setdefault(f"counts of {path}", {})
        for batch in slices(batches):
            raw, at = utf8(batch.column("text"))
            sizes = np.diff(at)
            tokens = np.zeros(len(sizes), np.int64)
            huge = (sizes >= huge_bytes) & drops
            if not drops:
                rows = np.flatnonzero(~huge)
                tokens[rows] = _counts([raw[at[i] : at[i + 1]].tobytes().decode() for i in rows], tokenizer)
            else:
                start, end, owner = bytework.words(raw, at)
                small = ~huge[owner]
                start, end, owner = start[small], end[small], owner[small]
                prints, first, back = np.unique(bytework.word_prints(raw, start, end), return_index=True, return_inverse=True)
                listed = prints.tolist()
                new = [k for k, p in enumerate(listed) if p not in known]
                pieces = [raw[start[first[k]] : end[first[k]]].tobytes().decode() for k in new]
                fresh = dict(zip((listed[k] for k in new), _counts(pieces, tokenizer), strict=True))
                each = np.fromiter((fresh[p] if p in fresh else known[p] for p in listed), np.int64, len(listed))
                if len(known) < REMEMBERED:
                    known.update(fresh)
                tokens += np.bincount(owner, each[back], minlength=len(sizes)).astype(np.int64)
            for i in np.flatnonzero(huge):
                whole = raw[at[i] : at[i + 1]].tobytes().decode()
                tokens[i] = len(encoded_in_chunks(whole, lambda t: tokenizer.encode(t, add_special_tokens=False).offsets))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(sizes), pa.array(tokens)], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return text_rows(docs, doc_id, text).mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")


def with_limit(counts: DataFrame, limit: int = 2048) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
