"""Counting quotient filter over 64-bit fingerprints, as numpy arrays.

A fingerprint is split into a quotient (its high ``q`` bits) and a remainder
(the other ``64 - q``). The filter keeps, per quotient, the *run* of its
remainders in ascending order, each once with its count:

* ``occupied``: one bit per quotient, set where its run is not empty;
* ``run_ends``: one bit per stored remainder, set at the last of its run;
* ``remainders``: all runs one after another, quotients ascending;
* ``counts``: how often each remainder was inserted.

Nothing is lost in the encoding: quotient and remainder give the fingerprint
back, so filters of different sizes merge exactly, by one ordered pass over
their sorted remainders in which equal entries add their counts.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<BQ")  # quotient bits, stored remainders


def _merge_sorted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal keys."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


class QuotientFilter:
    """Sorted distinct fingerprints with counts, encoded as quotient runs."""

    def __init__(self, keys: np.ndarray | None = None, counts: np.ndarray | None = None):
        self.keys = np.zeros(0, np.uint64) if keys is None else keys
        self.counts = np.zeros(0, np.int64) if counts is None else counts

    @classmethod
    def build(cls, fingerprints: np.ndarray) -> QuotientFilter:
        keys, counts = np.unique(fingerprints.astype(np.uint64, copy=False), return_counts=True)
        return cls(keys, counts.astype(np.int64))

    def merge(self, *others: QuotientFilter) -> QuotientFilter:
        """The filter of all insertions, by merging sorted remainders."""
        parts = [self, *others]
        return QuotientFilter(*_merge_sorted(np.concatenate([p.keys for p in parts]),
                                             np.concatenate([p.counts for p in parts])))

    def to_bytes(self) -> bytes:
        n = len(self.keys)
        q = max(3, int(n * 4 // 3).bit_length())  # load of 3/4 at most
        quotients = (self.keys >> np.uint64(64 - q)).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotients] = True
        run_ends = np.ones(n, bool)
        if n:
            run_ends[:-1] = quotients[1:] != quotients[:-1]
        width = (64 - q + 7) // 8
        remainders = self.keys & np.uint64((1 << (64 - q)) - 1)
        body = remainders.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
        return b"".join((_HEAD.pack(q, n), np.packbits(occupied).tobytes(),
                         np.packbits(run_ends).tobytes(), body.tobytes(),
                         self.counts.astype("<i8").tobytes()))

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        q, n = _HEAD.unpack_from(data)
        at = _HEAD.size
        occupied = np.unpackbits(np.frombuffer(data, np.uint8, (1 << q) // 8, at)).astype(bool)
        at += (1 << q) // 8
        size = (n + 7) // 8
        run_ends = np.unpackbits(np.frombuffer(data, np.uint8, size, at))[:n].astype(bool)
        at += size
        width = (64 - q + 7) // 8
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
        at += n * width
        counts = np.frombuffer(data, "<i8", n, at).astype(np.int64)
        run = np.cumsum(run_ends) - run_ends  # which run each remainder lies in
        quotients = np.flatnonzero(occupied).astype(np.uint64)[run] if n else np.zeros(0, np.uint64)
        keys = (quotients << np.uint64(64 - q)) | wide.view("<u8").reshape(n).astype(np.uint64)
        return cls(keys, counts)
