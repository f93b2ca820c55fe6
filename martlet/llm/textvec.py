"""Letters, words and hashed n-grams of a batch of texts as numpy arrays.

Texts are lower-cased and laid out as one array of code points with a break
after each; everything else is array arithmetic over the letters, so whole
texts of any length cost a few vector operations a character."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# Characters handled at once: bounds the working arrays, not the texts (a
# longer text forms a chunk of its own).
CHUNK_CHARS = 400_000


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool,
                       sys.maxunicode + 1)


def chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) runs of about CHUNK_CHARS characters."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK_CHARS:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


class Words:
    """The letter runs of a batch of texts.

    ``letters``: code points of all letters; ``at``: where they stand in the
    laid-out batch; ``codes``: the batch with non-letters as 0; ``starts``:
    index into ``letters`` of each word's first; ``doc``: text of each word.
    """

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        raw = np.frombuffer(("\0".join(["", *lowered, ""])).encode("utf-32-le", "replace"), "<u4")
        mask = _letter_table()[np.minimum(raw, sys.maxunicode)]
        self.codes = np.where(mask, raw, 0).astype(np.uint32)
        self.at = np.flatnonzero(mask)
        self.letters = self.codes[self.at]
        first = ~mask[self.at - 1]
        self.starts = np.flatnonzero(first)
        self.lengths = np.diff(np.append(self.starts, len(self.at)))
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered)))
        self.doc = np.searchsorted(ends, self.at[self.starts] - 1, side="right")

    def trigrams(self, bits: int) -> np.ndarray:
        """Hash of (previous, this, next) around every letter; breaks count as 0."""
        c = self.codes
        h = c[self.at - 1] * np.uint32(0x9E3779B1)
        h ^= c[self.at] * np.uint32(0x85EBCA77)
        h = (h << np.uint32(13)) | (h >> np.uint32(19))
        h ^= c[self.at + 1] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        return (h >> np.uint32(32 - bits)).astype(np.int64)

    def prefixes(self, length: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of the first ``length`` letters of every word that has
        more; with length 0, of every whole word."""
        if not len(self.starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.arange(len(self.at)) - np.repeat(self.starts, self.lengths)
        mixed = self.letters.astype(np.uint64) * _powers()[np.minimum(place, 255)]
        mixed ^= mixed >> np.uint64(29)
        if length:
            which = np.flatnonzero(self.lengths > length)
            mixed = np.where(place < length, mixed, np.uint64(0))
        else:
            which = np.arange(len(self.starts))
        h = np.add.reduceat(mixed, self.starts)[which] + np.uint64(length + 1)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return which, (h >> np.uint64(64 - bits)).astype(np.int64)


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    rng = np.random.default_rng(20250101)
    return rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
