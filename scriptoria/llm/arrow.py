"""Words, word hashes and runs of words over Arrow batches."""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: Fixed value: a word is a maximal run of letters or digits of any script, after lower-casing.
WORD = re.compile(r"[^\W_]+")


class WordHash(dict):
    """64-bit hash of a word, kept for words seen before; emptied when it grows past `most` words."""

    def __init__(self, most: int = 500_000):
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits (the finaliser of splitmix64, public domain)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_arrays(texts: list[str | None], cache: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts, number of words of each text)."""
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            w = WORD.findall(t.lower())
            counts[i] = len(w)
            flat.extend([cache[x] for x in w])
    return np.array(flat, np.uint64), counts


def runs(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of n consecutive words: (hash, text number, position of the first word in `words`)."""
    text = np.repeat(np.arange(len(counts)), counts)
    if len(words) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(3) + words[k : len(words) - n + 1 + k])
    at = np.flatnonzero(text[: len(h)] == text[n - 1 :])
    return h[at], text[at], at
