"""Documents with every odd case, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key_id string, key_text int, n_words string, kept string, _gone int"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def documents(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(n: int) -> list[str]:
        return [rng.choice(vocabulary) for _ in range(n)]

    texts: list[str | None] = [" ".join(prose(rng.randint(1, 160))) for _ in range(30)]
    base, passage = prose(130), " ".join(prose(90))
    texts += [" ".join(base)] * 3
    for _ in range(12):  # near copies, more and less near
        copy = list(base)
        for _ in range(rng.randint(1, 9)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    for _ in range(6):  # a passage that several documents share, in other surroundings
        texts.append("\n".join([" ".join(prose(rng.randint(0, 40))), passage, " ".join(prose(rng.randint(0, 40)))]))
    texts.append("\n".join([passage, passage, "end"]))
    texts += [None, "", "  \t\n ", "one", "Two words", "<|endoftext|> x", "日本語 " * 30, "ab " * 500, "z" * 900, "123 !!", "É" * 450]
    texts.append(" ".join(prose(9000)))  # very long
    rows = [(i, t, rng.choice(["en", "fr", None]), "s", len(t or ""), "k", 1, "n", "x", 2) for i, t in enumerate(texts)]
    rows += rows[:2] + rows[33:35]  # repeated rows
    rows += [(None, " ".join(base), "en", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return rows


class Sets:
    """Union by least member."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text: str | None, width: int) -> set:
    words = WORDS.findall((text or "").encode().lower())
    if len(words) >= width:
        return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
    return {tuple(words)} if words else set()


def covered(size: int, width: int, starts) -> list[bool]:
    hit = [False] * size
    for p in starts:
        hit[p : p + width] = [True] * width
    return hit
