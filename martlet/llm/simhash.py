"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Every whole text gets its 64-bit fingerprint: a bit is set if it is set in over half the
   XXH64 hashes of the text's word shingles. Equal fingerprints are one from here on.
2. Bits that are correlated over all fingerprints go into one partition, so that common
   values gather in few partitions and the others stay selective. There are as many
   partitions as fit bits for all fingerprints to differ in each.
3. If two fingerprints differ in at most ``distance`` bits, and thresholds t_i (-1 or more)
   add up to ``distance`` - partitions + 1, then in some partition they differ in at most
   t_i bits. Each fingerprint gets its own thresholds: a dynamic programme takes those of
   least cost, probes and estimated candidates. The estimates are distance histograms of
   all fingerprints over halves of the partitions (tables of at most 2^16 entries each),
   combined as if the halves were independent.
4. A fingerprint probes, per partition, every value within its threshold of its own; the
   probes meet the index (every fingerprint under its value of each partition) in a
   shuffled join, and candidates within ``distance`` bits are links.
5. Keys under which more than ``CROWDED`` fingerprints stand are counted exactly and neither
   probed nor indexed. Two linked fingerprints that miss one another through this both probe
   a crowded key. All fingerprints that do are linked by midpoints instead: each stands under
   itself and every value one or so bits away (half the distance, rounded up), so linked ones
   meet there, at most a ball of them under a value. Nothing is dropped, and no group of near
   copies costs its square.
6. Components of the links; each document gets the least id of its component.

Defined cases: a null, empty or blank text has fingerprint zero, linked like any other; with
fewer words than a shingle has, the whole sequence is one; a document with a null id is
returned with its component's least id (null if there is none) and gives none; repeated rows
stay; empty tables give an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import Stage, prepare
from martlet.llm.components import components

BITS = 64
WORDS, DISTANCE, SEED = 3, 2, 42
CROWDED = 1024  # fingerprints under one key; more are linked by midpoints
PROBE_COST = 8.0  # of a probe, in candidates
FEWEST_BITS = 16  # of a partition
SUB_BITS = 16  # most bits of a histogram

_ONE = np.uint64(1)


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint of a whole text, unsigned."""
    tokens = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)))) \
        if len(tokens) >= words else [b" ".join(tokens)]
    hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a very long text
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(words: int, seed: int):
    """mapInArrow: (doc_id, text) -> (doc_id, f)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = np.array([fingerprint(t, words, seed) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f.view(np.int64))],
                                             names=["doc_id", "f"])

    return run


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _bits(f: np.ndarray) -> np.ndarray:
    return np.unpackbits(f.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: f -> (bit, c0, c1, ...): in how many fingerprints both bits are set."""
    total = np.zeros((BITS, BITS))
    for batch in batches:
        bits = _bits(_unsigned(batch.column(0))).astype(float)
        total += bits.T @ bits
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(BITS, dtype=np.int32)), *map(pa.array, total.astype(np.int64).T)],
        names=["bit", *(f"c{i}" for i in range(BITS))])


def grouped_bits(together: np.ndarray, n: int, many: int) -> list[np.ndarray]:
    """Bits in ``many`` partitions: each starts with the free bit that is most correlated with
    the others and takes those most correlated with what it holds."""
    p = np.diag(together) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(together / n - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    free, out = list(range(BITS)), []
    for i in range(many):
        size = BITS // many + (i < BITS % many)
        own = [max(free, key=lambda b: (related[b, free].sum(), -b))]
        free.remove(own[0])
        while len(own) < size:
            own.append(max(free, key=lambda b: (related[b, own].sum(), -b)))
            free.remove(own[-1])
        out.append(np.array(sorted(own)))
    return out


def _value(f: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The given bits of each fingerprint as one number."""
    out = np.zeros(len(f), np.uint64)
    for i, b in enumerate(bits.tolist()):
        out |= ((f >> np.uint64(b)) & _ONE) << np.uint64(i)
    return out


@dataclass(frozen=True)
class Layout:
    """Partitions of the bits, and the histograms' parts of each."""

    parts: list[np.ndarray]

    @property
    def subs(self) -> list[tuple[int, np.ndarray]]:
        return [(i, sub) for i, part in enumerate(self.parts)
                for sub in np.array_split(part, math.ceil(len(part) / SUB_BITS) if len(part) > 1 else 1)]


def _histograms(layout: Layout):
    """mapInArrow: f -> (sub, value, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(1 << len(sub), np.int64) for _, sub in layout.subs]
        for batch in batches:
            f = _unsigned(batch.column(0))
            for counts, (_, sub) in zip(total, layout.subs):
                counts += np.bincount(_value(f, sub).astype(np.int64), minlength=len(counts))
        for i, counts in enumerate(total):
            own = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), i, np.int32)), pa.array(own), pa.array(counts[own])],
                names=["sub", "value", "n"])

    return run


def _at_distance(share: np.ndarray, bits: int, most: int) -> list[np.ndarray]:
    """Of each value, the share of fingerprints at exactly 0, 1, ... bits from it."""
    values = np.arange(1 << bits)
    out = []
    for d in range(most + 1):
        total = np.zeros(1 << bits)
        for flips in combinations(range(bits), d):
            total += share[values ^ sum(1 << b for b in flips)]
        out.append(total)
    return out


@dataclass(frozen=True)
class Estimates:
    """Estimated candidates and probes of each partition at each threshold."""

    layout: Layout
    tables: list[list[np.ndarray]]  # of each sub: shares by distance
    n: int
    distance: int

    def costs(self, f: np.ndarray, part: int) -> np.ndarray:
        """(fingerprint, threshold + 1): cost of thresholds -1, 0, 1, ..."""
        near = None
        for (i, sub), table in zip(self.layout.subs, self.tables):
            if i == part:
                at = _value(f, sub).astype(np.int64)
                own = np.stack([t[at] for t in table], axis=1)
                near = own if near is None else np.stack([
                    sum(near[:, a] * own[:, d - a] for a in range(d + 1))
                    for d in range(self.distance + 1)], axis=1)
        bits = len(self.layout.parts[part])
        probes = np.cumsum([math.comb(bits, d) for d in range(self.distance + 1)])
        inside = self.n * np.cumsum(near, axis=1) + PROBE_COST * probes
        return np.concatenate([np.zeros((len(f), 1)), inside], axis=1)

    def thresholds(self, f: np.ndarray) -> np.ndarray:
        """(fingerprint, partition): the thresholds of least cost, by dynamic programming."""
        many, steps = len(self.layout.parts), self.distance + 1  # thresholds + 1 add up to steps
        least = np.full((len(f), steps + 1), np.inf)
        least[:, 0] = 0
        chosen = np.zeros((many, len(f), steps + 1), np.int64)
        for part in range(many):
            cost = self.costs(f, part)
            ways = np.full((len(f), steps + 1, steps + 1), np.inf)  # total, taken here
            for taken in range(steps + 1):
                ways[:, taken:, taken] = least[:, :steps + 1 - taken] + cost[:, taken, None]
            chosen[part] = ways.argmin(axis=2)
            least = ways.min(axis=2)
        out, left = np.zeros((len(f), many), np.int64), np.full(len(f), steps)
        for part in reversed(range(many)):
            out[:, part] = chosen[part, np.arange(len(f)), left]
            left = left - out[:, part]
        return out - 1


def _keys(parts: list[np.ndarray], part: int, values: np.ndarray) -> np.ndarray:
    """Partition and value as one number: values have at most 32 bits."""
    return (values | np.uint64(part << 40)).view(np.int64)


def _indexed(layout: Layout):
    """mapInArrow: f -> (key, f) under each partition's value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = _unsigned(batch.column(0))
            for i, part in enumerate(layout.parts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_keys(layout.parts, i, _value(f, part))), batch.column(0)],
                    names=["key", "f"])

    return run


def _probing(estimates: Estimates):
    """mapInArrow: f -> (key, f) for every value that the fingerprint's thresholds reach."""
    parts = estimates.layout.parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = _unsigned(batch.column(0))
            thresholds = estimates.thresholds(f)
            for i, part in enumerate(parts):
                values = _value(f, part)
                for d in range(estimates.distance + 1):
                    who = np.flatnonzero(thresholds[:, i] >= d)
                    if not len(who):
                        continue
                    flips = np.array([sum(1 << b for b in x) for x in combinations(
                        range(len(part)), d)], np.uint64)
                    for at in range(0, len(who), max(1, 50_000 // len(flips))):
                        some = who[at:at + max(1, 50_000 // len(flips))]
                        near = (values[some][:, None] ^ flips[None, :]).ravel()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(_keys(parts, i, near)),
                             pa.array(np.repeat(f[some].view(np.int64), len(flips)))],
                            names=["key", "f"])

    return run


def _around(radius: int):
    """mapInArrow: f -> (middle, f) for every value at most ``radius`` bits away."""
    flips = np.array([sum(1 << b for b in x) for d in range(radius + 1)
                      for x in combinations(range(BITS), d)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = _unsigned(batch.column(0))
            for at in range(0, len(f), max(1, 100_000 // len(flips))):
                some = f[at:at + max(1, 100_000 // len(flips))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((some[:, None] ^ flips[None, :]).ravel().view(np.int64)),
                     pa.array(np.repeat(some.view(np.int64), len(flips)))], names=["middle", "f"])

    return run


def partitions_for(n: int, distance: int = DISTANCE) -> int:
    """As many partitions as leave enough bits in each to tell ``n`` fingerprints apart (from
    2, for wider keys than 32 bits would gain nothing, to one more than the distance needs)."""
    bits = max(FEWEST_BITS, math.ceil(math.log2(max(2, n))))
    return min(distance + 2, max(2, BITS // bits))


def _apart(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame, stage: Stage, distance: int = DISTANCE,
          crowded: int = CROWDED) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs at most ``distance`` bits apart.

    ``prints``: a staged table of distinct fingerprints, column ``f`` (long)."""
    spark = prints.sparkSession
    f = prints.select("f")
    rows = sorted(f.mapInArrow(_together, ", ".join(
        ["bit int", *(f"c{i} long" for i in range(BITS))])).groupBy("bit").agg(
            *(F.sum(f"c{i}") for i in range(BITS))).collect())
    n = prints.count()
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    together = np.array([r[1:] for r in rows], float)
    layout = Layout(grouped_bits(together, n, partitions_for(n, distance)))
    shares = [np.zeros(1 << len(sub)) for _, sub in layout.subs]
    for sub, value, count in f.mapInArrow(_histograms(layout), "sub int, value long, n long").groupBy(
            "sub", "value").agg(F.sum("n")).collect():  # at most 2^SUB_BITS rows a sub
        shares[sub][value] = count / n
    estimates = Estimates(layout, [_at_distance(s, len(sub), distance) for s, (_, sub) in zip(
        shares, layout.subs)], n, distance)
    index = stage.write(f.mapInArrow(_indexed(layout), "key long, f long"), "index")
    probes = stage.write(f.mapInArrow(_probing(estimates), "key long, f long"), "probes")
    full = stage.write(index.groupBy("key").agg(F.count("*").alias("n")).where(
        F.col("n") > crowded).select("key"), "crowded")
    found = _probed(probes.join(full, "key", "left_anti"), index.join(full, "key", "left_anti"),
                    distance)
    close = probes.join(full, "key", "left_semi").select("f").distinct()
    edges = stage.write(found.unionByName(_by_midpoints(close, distance)), "links")
    stage.release(index, probes, full)
    return edges


def _probed(probes: DataFrame, index: DataFrame, distance: int) -> DataFrame:
    """Candidates of the probes that are at most ``distance`` bits apart."""
    other = index.select("key", F.col("f").alias("g"))
    meets = (probes["key"] == other["key"]) & (F.col("f") != F.col("g")) & (
        _apart(F.col("f"), F.col("g")) <= distance)
    return probes.join(other, meets).select(
        F.least("f", "g").alias("a"), F.greatest("f", "g").alias("b")).distinct()


def _by_midpoints(close: DataFrame, distance: int) -> DataFrame:
    """Links of fingerprints that meet halfway; for an odd distance the pairs are verified."""
    half = (distance + 1) // 2
    placed = close.mapInArrow(_around(half), "middle long, f long")
    if distance % 2 == 0:  # all under one middle are at most 2 * half apart: a star is enough
        least = placed.groupBy("middle").agg(F.min("f").alias("a"), F.count("*").alias("n")).where("n > 1")
        return placed.join(least, "middle").where("f != a").select(
            F.least("a", "f").alias("a"), F.greatest("a", "f").alias("b")).distinct()
    return _probed(placed.withColumnRenamed("middle", "key"),
                   placed.withColumnRenamed("middle", "key"), distance)


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, seed: int = SEED,
                    crowded: int = CROWDED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    spark = prepare(docs.sparkSession)
    stage = Stage(spark, "simhash")
    rows = stage.write(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
    ).mapInArrow(_fingerprints(words, seed), "doc_id long, f long"), "fingerprints")
    prints = stage.write(rows.groupBy("f").agg(F.min("doc_id").alias("first")), "distinct")
    edges = links(prints, stage, distance, crowded)
    found = components(edges, stage).select(F.col("vertex").alias("f"), "component")
    named = prints.join(found, "f", "left").select(
        "f", "first", F.coalesce("component", "f").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    given = named.join(least, "component").select("f", "component_id")
    return rows.join(given, "f").select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")
