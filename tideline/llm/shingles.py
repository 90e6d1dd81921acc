"""Hashed word shingles of a batch of texts, as flat arrays."""

from __future__ import annotations

import hashlib

import numpy as np

from tideline.llm.common import FEWER_WORDS, CachedWords, kept

WORDS = 5
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def word_hash(word: bytes) -> bytes:
    return hashlib.blake2b(word, digest_size=8).digest()


def cached_hashes() -> CachedWords:
    return kept(("word hashes",), lambda: CachedWords(word_hash, FEWER_WORDS))


class Shingles:
    """Shingles of texts, end to end: ``owner`` (index of the text), ``place`` in it, ``hash``.

    Words are runs of anything but \\x20 and \\x09-\\x0D. A text with fewer words than a shingle
    is one shingle; one without words has none.
    """

    def __init__(self, texts: list[bytes], known: CachedWords, n: int = WORDS):
        split = [raw.split() for raw in texts]
        self.words = np.array([len(words) for words in split], dtype=np.int64)
        hashes = np.frombuffer(b"".join([b"".join(map(known.__getitem__, words)) for words in split]), dtype="<u8")
        count = np.where(self.words >= n, self.words - n + 1, np.minimum(self.words, 1))
        self.count = count
        self.owner = np.repeat(np.arange(len(texts)), count)
        self.place = np.arange(len(self.owner)) - np.repeat(np.cumsum(count) - count, count)
        first = np.repeat(np.cumsum(self.words) - self.words, count) + self.place
        padded = np.concatenate([hashes, np.zeros(n, dtype=np.uint64)])
        made = np.zeros(len(first), dtype=np.uint64)
        short = np.repeat(self.words, count)
        for j in range(n):
            step = (made ^ (made >> np.uint64(31))) * FACTOR + padded[first + j]
            made = np.where(j < short, step, made)
        self.hash = (made ^ (made >> np.uint64(33))) * FACTOR
