"""Fast ids of a byte-level BPE vocabulary, built in a worker once from its JSON file."""

from __future__ import annotations

import json
import sys
import types

import numpy as np

#: The public pattern by which byte-level BPE splits a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def worker_cache() -> dict:
    """A store that lives as long as the worker process; task code is loaded anew for each task."""
    return vars(sys.modules.setdefault("_spanflow_worker_cache", types.ModuleType("_spanflow_worker_cache")))


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBpe:
    """Encodes as the ``tokenizers`` library does with this file, special strings included.

    In such a vocabulary the ids of merged pieces ascend in merge order, so that ids
    serve as merge ranks; a file for which that does not hold is refused.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        signs = _byte_of_sign()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(signs[c] for c in token): number
            for token, number in spec["model"]["vocab"].items()
            if token not in special
        }
        made = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ids = [spec["model"]["vocab"][a + b] for a, b in made]
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or ids != sorted(ids) or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE with ids in merge order")
        self._encoding = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._special = set(special)

    def ids(self, text: str) -> np.ndarray:
        return self._encoding.encode_to_numpy(text, allowed_special=self._special, disallowed_special=())


def byte_bpe(path: str) -> ByteBpe:
    cache = worker_cache()
    if path not in cache:
        cache[path] = ByteBpe(path)
    return cache[path]
