"""Near duplicates by an exact metric-space join on Jaccard distance.

A document is the set of its distinct shingles of ``words`` words; two link when
their Jaccard distance is at most r = 1 - ``similarity``. Jaccard distance is a
metric, so a pivot p bounds every other distance: ``|d(x,p) - d(y,p)| <= d(x,y)``.

0. *Classes.* Equal sets are one class, represented by its least doc_id.
1. *First regions.* Between documents without common wording all distances
   are 1 and no triangle inequality tells them apart, so regions are first
   drawn in projections: the shingle universe is cut into m parts by hash. A
   linked pair differs in at most ``(|x| + |y|) * r / (2 - r)`` shingles; with m
   above that, one projection of both is equal (distance 0). Equal projections form
   a region; m follows from geometric size classes, and a set near the upper
   end of its class also enters the next one's regions. Of a set's m projections all
   but t are equal to a partner's, t bounded by its own size, so the t + 1 first ones
   in a common order share one with the partner's and are enough. Regions of a single
   set fall away in one sorted exchange; those that a sample shows to be shared by
   many sets need none.
2. *Pivots.* Each region takes as pivots those of its leading members (at first
   all lead) that share most regions: ``PIVOTS``, or all of few enough (``SETTLE``). The distance of
   every member to them is taken between parity bits (``_parity``), folded to one width a region:
   it is a metric too and at most ``|x ^ p|``, so it rules most links out. The pairs it
   leaves are measured exactly from the shingle sets, which settles all pairs with a pivot.
3. *Voronoi cells.* A member's home is its nearest pivot by parity bits; it is replicated to
   every smaller pivot with ``d(x,p) <= d(x,home) + 2r``, r being the most differences that a link
   leaves x. By the triangle inequality a linked pair meets in the smaller home of the two. In a
   cell of at most ``SMALL`` members the pairs within each other's window, ``|d(x,p) - d(y,p)| <= r``,
   are compared at once by parity bits, and those that may link exactly, from their sets. Larger
   cells, and those with more than ``DENSE`` such pairs a member (unless their whole sets can be
   compared at once, ``SETS``), are divided further.
4. *Recursion.* Components are wanted, so only pairs that the links found so far do not
   show to be of one component are sought; cells and regions whose members are of one component
   are closed before their elements are named, so a group of near copies costs its size.
   Of such a pair at least one is not of the pivot's component, so outside its ball, and
   their differences to the pivot, a = x ^ p and b = y ^ p, must overlap:
   ``|a & b| = (|a| + |b| - |a ^ b|) / 2``. The likely rarest elements of the
   difference, as many as that bound demands, name the regions of the next
   round; the smaller difference of a pair needs few, in which it leads, and only
   pairs with a leading member are sought. Of these regions those of at most ``SMALL``
   members are compared at once, one of each that have the same members. What is rare in a cell is told by
   its centre, the majority of a small sample; the order has no bearing on the
   result. Regions only ever lose members, the pivots, so the recursion ends;
   regions that pivots settle entirely are not carried on.
5. *Components* of the links (``components``), joined back to all documents.

No step emits all pairs of a group: a region of g members costs g distances
a pivot. Parity bits come with the sketch; whole sets are made only for documents of pairs that
parity bits do not rule out and of cells that are divided further, and go when they have served.
The sketch's region keys are released once the first regions are drawn.

Defined cases: null texts and texts without words have an empty set and link
with nothing; fewer words than a shingle form one shingle; rows that share a
doc_id are one document with several texts; a null doc_id takes no part and
has a null component; an empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import Stage, prepare
from martlet.llm.components import components, contracted

WORDS, SIMILARITY = 3, 0.9
PIVOTS = 2
SETTLE = (6, 16)  # pivots that settle a small region, at first and later
SMALL = 8192  # members of a cell or region that one task compares by parity bits,
SMALL_BITS = 1 << 27  # which are so many at most
SETS = 128  # members whose whole sets one task compares
DENSE = 4  # pairs a member that parity bits may leave to be measured
SAMPLED = 15  # members whose majority is the centre of a cell
# A region with HOT sets among one in HOT_EVERY is shared for certain, and by many.
HOT, HOT_EVERY = 32, 256

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
SEEN = 1_000_000  # sets a task remembers in order not to emit them again


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    found = (text or "").encode().translate(_LOWER).split()  # splits at x20, x09-x0D
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = len(found) - words + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(words):
        mixed = _mix(mixed * _A + hashed[i:i + n] + _B)
    return np.unique(mixed)


@dataclass(frozen=True)
class Link:
    """What a least similarity p / q says of a linked pair, in whole numbers:
    ``|x & y| * q >= |x | y| * p`` is ``|x ^ y| * far <= (|x| + |y|) * near``, and
    neither set is larger than q / p times the other."""

    p: int
    q: int
    bounds: tuple[int, ...] = field(init=False, repr=False)  # of the size classes

    def __post_init__(self):
        # smaller sets link with equal sets only; a partner lies in the next class at most
        bounds = [-(-self.p // self.near)]
        while bounds[-1] < 1 << 40:
            bounds.append(max(bounds[-1] + 1, bounds[-1] * 14 // 10,
                              (bounds[-1] - 1) * self.q // self.p + 1))
        object.__setattr__(self, "bounds", tuple(bounds))

    @classmethod
    def at(cls, similarity: float) -> Link:
        if not 0 < similarity < 1:
            raise ValueError(f"a similarity between 0 and 1 is needed, not {similarity}")
        return cls(*Fraction(str(similarity)).as_integer_ratio())

    @property
    def far(self) -> int:
        return self.q + self.p

    @property
    def near(self) -> int:
        return self.q - self.p

    @property
    def radius(self) -> float:
        return self.near / self.q

    def most(self, n: int) -> int:
        """Differences that a set of n shingles has at most to one linked with it."""
        return n * self.near // self.p

    def scheme(self, k: int) -> tuple[int, int]:
        """(most differences of a pair, parts) of size class k."""
        most = 2 * (self.bounds[k + 1] - 1) * self.near // self.far
        return most, (most + 1) * 115 // 100 + 2


_DEFAULT = Link.at(SIMILARITY)


def projections(own: np.ndarray, link: Link = _DEFAULT) -> np.ndarray:
    """Region keys of a set: the first of its parts by its class's scheme, and by the next
    class's if a partner may lie there. Empty parts, which many sets share, come last."""
    n = len(own)
    if n < link.bounds[0]:
        return np.zeros(0, np.uint64)
    k = bisect_right(link.bounds, n) - 1
    out = []
    for scheme in (k, k + 1) if link.q * n >= link.p * link.bounds[k + 1] else (k,):
        most, parts = link.scheme(scheme)
        part = ((_mix(own + np.uint64(scheme)) >> np.uint64(32)) * np.uint64(parts)
                >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, part, _mix(own ^ _C))
        keys = _mix(sums + _mix(np.arange(parts, dtype=np.uint64) + np.uint64(scheme << 32)))
        empty = np.bincount(part, minlength=parts) == 0
        # all but so many parts are equal in a partner, so one of the first is in both
        differ = min(most, link.most(n), (n + link.bounds[scheme + 1] - 1) * link.near // link.far)
        out.append(keys[np.lexsort((keys, empty))[:differ + 1]])
    return np.concatenate(out)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sketch(words: int, link: Link):
    """mapInArrow: (doc_id, text) -> (doc_id, n, h1, h2, parity, regions)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, first, second, parity, regions = [], [], [], [], []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = shingles(text, words)
                digest = xxhash.xxh3_128_intdigest(own.tobytes())
                sizes.append(len(own))
                first.append(h1 := (digest >> 64) - (1 << 63))
                second.append((digest & ((1 << 64) - 1)) - (1 << 63))
                parity.append(None if doc_id is None else _parity(own))
                # copies of a set met before in this task add nothing to its regions, nor do
                # rows without an id, which take no part
                if doc_id is None or h1 in seen:
                    regions.append(None)
                    continue
                regions.append(_signed(projections(own, link)))
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(h1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(second, pa.int64()), pa.array(parity, pa.binary()),
                 pa.array(regions, pa.list_(pa.int64()))],
                names=["doc_id", "n", "h1", "h2", "parity", "regions"])

    return run


def _parity(own: np.ndarray) -> bytes:
    """One bit for each remainder of the elements: how many have it, odd or even. Every
    element that only one of two sets has turns one bit, so their bits differ in at most
    as many places as the sets do. The number of bits is a power of two, 2 to 4 an element."""
    bits = 1 << max(6, (2 * len(own)).bit_length())
    return np.packbits(np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1,
                       bitorder="little").tobytes()


def _folded(bits: bytes, size: int) -> np.ndarray:
    """Parity bits folded to so many bytes: those of the remainders by fewer."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, size // 8), axis=0)


def _apart(a: bytes, b: bytes, most: int | None = None) -> int:
    """The places in which two sets' parity bits differ, folded to the shorter ones' length,
    or to ``most`` bytes if that is less. At one length it is a metric."""
    size = min(len(a), len(b), most or len(a))
    return int(np.bitwise_count(_folded(a, size) ^ _folded(b, size)).sum())


def _sets(words: int):
    """mapInArrow: (x, text) -> (x, own): the shingle set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingles(t, words).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())],
                                             names=["x", "own"])

    return run


def _places(link: Link):
    """mapInArrow: (x, p, w, settled, seek, nx, np, px, pp) -> (x, p, w, settled, nx, np, d, may):
    the distance of parity bits at width w, and whether the pair is sought and they allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, may = [], []
            for w, seek, m, n, a, b in zip(*(batch.column(k).to_pylist() for k in (
                    "w", "seek", "nx", "np", "px", "pp"))):
                d.append(_apart(a, b, w // 8))
                may.append(seek and min(m, n) * link.q >= max(m, n) * link.p
                           and d[-1] * link.far <= (m + n) * link.near
                           and _apart(a, b) * link.far <= (m + n) * link.near)
            kept = batch.select(["x", "p", "w", "settled", "nx", "np"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(d, pa.int64()), pa.array(may, pa.bool_())],
                names=[*kept.schema.names, "d", "may"])

    return run


def _difference(a: bytes, b: bytes) -> np.ndarray:
    return np.setxor1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64),
                       assume_unique=True)


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (x, p, own, other) -> (x, p, nx, np, diff)."""
    for batch in batches:
        own, other = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        diff = [len(_difference(a, b)) for a, b in zip(own, other)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(a) // 8 for a in own], pa.int64()),
             pa.array([len(b) // 8 for b in other], pa.int64()), pa.array(diff, pa.int64())],
            names=["x", "p", "nx", "np", "diff"])


def _centre(table: pa.Table) -> pa.Table:
    """The elements that most of a cell's sampled members have, and the cell's pivot."""
    own = [np.frombuffer(x, np.uint64) for x in table.column("own").to_pylist()]
    elements, times = np.unique(np.concatenate(own), return_counts=True)
    return pa.table({**{k: table.column(k).slice(0, 1).combine_chunks() for k in ("cell", "p")},
                     "centre": pa.array([elements[2 * times > len(own)].tobytes()], pa.binary())})


def _compared(link: Link):
    """applyInArrow: one cell or region (cell, x, c, own) -> its links (x, p, nx, np, diff)."""

    def run(table: pa.Table) -> pa.Table:
        x, c = (table.column(k).to_numpy() for k in ("x", "c"))
        own = [np.frombuffer(o, np.uint64) for o in table.column("own").to_pylist()]
        n = np.array([len(o) for o in own])
        rows = []
        for i in range(len(x)):
            seek = np.arange(i + 1, len(x))
            seek = seek[(c[seek] != c[i]) & (np.minimum(n[seek], n[i]) * link.q >= np.maximum(n[seek], n[i]) * link.p)]
            for j in seek.tolist():
                diff = len(np.setxor1d(own[i], own[j], assume_unique=True))
                if diff * link.far <= (n[i] + n[j]) * link.near:
                    a, b = (i, j) if x[i] > x[j] else (j, i)
                    rows.append((x[a], x[b], n[a], n[b], diff))
        columns = list(zip(*rows)) or [()] * 5
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("x", "p", "nx", "np", "diff"), columns)})

    return run


def _candidates(link: Link):
    """applyInArrow: one cell or region (cell, x, c, d, nx, px) -> (cell, x, p) of the pairs whose
    parity bits allow a link; of one that has too many of them a row without a pair."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("d")
        x, c, d, n = (table.column(k).to_numpy() for k in ("x", "c", "d", "nx"))
        bits = table.column("px").to_pylist()
        size = min(map(len, bits))
        bits = np.stack([_folded(b, size) for b in bits])
        ends = np.searchsorted(d, d + n * link.near // link.p, "right")
        a, b, found = [], [], 0
        for i in range(len(x)):
            seek = np.arange(i + 1, ends[i])
            seek = seek[(c[seek] != c[i]) & (np.minimum(n[seek], n[i]) * link.q >= np.maximum(n[seek], n[i]) * link.p)]
            if not len(seek):
                continue
            differ = np.bitwise_count(bits[seek] ^ bits[i]).sum(axis=1, dtype=np.int64)
            seek = x[seek[differ * link.far <= (n[i] + n[seek]) * link.near]]
            a.append(np.maximum(seek, x[i]))
            b.append(np.minimum(seek, x[i]))
            found += len(seek)
            if found > DENSE * len(x):
                a, b = [pa.nulls(1, pa.int64())], [pa.nulls(1, pa.int64())]
                break
        pairs = [pa.chunked_array([pa.array(v, pa.int64()) for v in vs], pa.int64()) for vs in (a, b)]
        cell = pa.array(np.full(len(pairs[0]), table.column("cell")[0].as_py(), np.int64))
        return pa.table({"cell": cell, "x": pairs[0], "p": pairs[1]})

    return run


def _differences(link: Link):
    """mapInArrow: (cell, x, c, w, outer, own, other, centre) -> (cell, x, c, w, e, leads): the
    rarest elements of the difference to the pivot, as many as a link demands.

    Let a be the smaller difference of a linked pair and b the larger, t the most by
    which the two sets may differ. Their overlap is at least ``|a| - t/2`` and at least
    ``|b| - t``; and about half of ``|a|`` where b lies outside the pivot's ball, as it
    must if a lies inside. So the pair shares one of the first elements of a, few enough
    to be rare ones, in which a *leads* the region, with one of the first of b. The order
    of the elements only has to be the same for all members of a cell: first what pivot
    and centre lack, then what both have, last what one of them has and the other lacks,
    which most differences hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leads, elements = [], []
            for outer, a, b, c in zip(*(col.to_pylist() for col in batch.columns[4:])):
                delta, n, n_pivot = _difference(a, b), len(a) // 8, len(b) // 8
                size, most = len(delta), link.most(n)
                in_pivot = np.isin(delta, np.frombuffer(b, np.uint64), assume_unique=True)
                in_centre = np.isin(delta, np.frombuffer(c, np.uint64), assume_unique=True)
                rank = np.where(in_pivot != in_centre, 2, in_pivot)
                delta = _signed(delta[np.lexsort((delta, rank))])
                half = 1 if outer else -(-(link.far * size + link.near * (n_pivot - n) + 1)
                                         // (2 * link.far))
                smaller = max(0, size - max(1, half, size - most // 2) + 1)
                larger = max(0, size - max(1, half, size - most) + 1)
                elements.append(delta[:larger])
                leads.append(np.arange(len(elements[-1])) < smaller)
            sizes = [len(e) for e in elements]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.repeat(k.to_numpy(), sizes)) for k in batch.columns[:4]),
                 pa.array(np.concatenate([np.zeros(0, np.int64), *elements])),
                 pa.array(np.concatenate([np.zeros(0, bool), *leads]))],
                names=["cell", "x", "c", "w", "e", "leads"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over rows sorted by (region, h1): the distinct rows of regions with two
    or more different h1. Only the last row is held from batch to batch."""
    last, given = None, False  # the row before, and whether it was handed on
    for batch in batches:
        region, h1 = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if last is not None:
            region, h1 = np.append(last[0], region), np.append(last[1], h1)
        if not len(region):
            continue
        fresh = np.append(True, (region[1:] != region[:-1]) | (h1[1:] != h1[:-1]))
        region, h1 = region[fresh], h1[fresh]
        same = region[1:] == region[:-1]
        paired = np.append(False, same) | np.append(same, False)
        handed = paired.copy()
        if last is not None:
            handed[0] &= not given
            paired[0] |= given
        last, given = (region[-1:], h1[-1:]), bool(paired[-1])
        yield pa.RecordBatch.from_arrays([pa.array(region[handed]), pa.array(h1[handed])],
                                         names=["region", "h1"])


def _first_regions(sketch: DataFrame, classes: DataFrame, stage: Stage) -> DataFrame:
    """(region, x, w, leads, c): representatives of the sets that share a projection, with the
    width of their parity bits; all of them lead, and each is a component of its own."""

    def members(rows: DataFrame) -> DataFrame:
        return rows.where("doc_id IS NOT NULL").select(F.explode("regions").alias("region"), "h1")

    # h1 is a hash of the set, so its remainder draws distinct sets
    drawn = sketch.where(F.pmod("h1", F.lit(HOT_EVERY)) == 0)
    hot = stage.write(members(drawn).distinct().groupBy("region").agg(
        F.count("*").alias("n")).where(F.col("n") >= HOT).select("region"), "hot")
    every, kept = members(sketch), None
    if not hot.isEmpty():
        kept = every.join(hot, "region", "left_semi").distinct()
        every = every.join(hot, "region", "left_anti")
    cold = every.repartition("region").sortWithinPartitions("region", "h1").mapInArrow(
        _shared, "region long, h1 long")
    kept = cold if kept is None else cold.unionByName(kept)
    width = F.expr("shiftleft(1, greatest(6, length(bin(2 * n))))").cast("long")  # as _parity has it
    first = stage.write(kept.join(classes.select("h1", F.col("rep").alias("x"), width.alias("w")), "h1").groupBy(
        "region", "x").agg(F.min("w").alias("w")).select(
        "region", "x", "w", F.lit(True).alias("leads"), F.col("x").alias("c")), "regions")
    stage.release(hot)
    return first


def _pivots(members: DataFrame, settle: int) -> DataFrame:
    """(region, p, cp, settled, w): each region's pivots, of its leading members those that
    share most regions, and the width at which all its members' parity bits can be compared. ``settle`` of them settle a region with no more leading members
    (or one more member) at once; a larger one gets ``PIVOTS`` and is divided."""
    central = members.groupBy("x").agg(F.count("*").alias("shares"))
    order = Window.partitionBy("region").orderBy(F.desc("shares"), "x")
    sizes = members.groupBy("region").agg(
        F.count("*").alias("g"), F.count_if("leads").alias("leading"), F.min("w").alias("w")).select(
        "region", ((F.col("leading") <= settle) | (F.col("g") <= settle + 1)).alias("settled"), "w")
    ranked = members.where("leads").drop("w").join(central, "x").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= settle)
    return ranked.join(sizes, "region").where(F.col("settled") | (F.col("rank") <= PIVOTS)).select(
        "region", F.col("x").alias("p"), F.col("c").alias("cp"), "settled", "w")


def _linked(found: DataFrame, link: Link) -> DataFrame:
    return found.where(F.col("diff") * link.far <= (F.col("nx") + F.col("np")) * link.near).select(
        F.col("x").alias("a"), F.col("p").alias("b"))


def _joined(edges: DataFrame, labels: DataFrame | None, stage: Stage) -> DataFrame:
    """Names that the edges, and what was joined before, give their vertices: equal ones
    within one component only, which is all that the search asks of them."""
    if labels is not None:
        edges = edges.unionByName(labels.select(F.col("vertex").alias("a"), F.col("component").alias("b")))
    return contracted(edges, stage)


def _near(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """The members of each region beside its pivots."""
    return members.drop("w").join(pivots, "region").where("x != p")


@dataclass(frozen=True)
class _Source:
    """Where the search gets documents from: their texts, and (x, nx, px), sizes and parity bits."""

    rows: DataFrame
    brief: DataFrame
    words: int
    link: Link
    stage: Stage

    def sets(self, ids: DataFrame) -> DataFrame:
        """(x, own): the shingle sets of the documents in the first column of ``ids``."""
        asked = ids.toDF("doc_id").distinct()
        # repeated rows go before their sets are made, while they lie by id
        return self.stage.write(self.rows.join(asked, "doc_id", "left_semi").distinct().mapInArrow(
            _sets(self.words), "x long, own binary"), "sets")

    def measured(self, pairs: DataFrame) -> DataFrame:
        """(x, p, nx, np, diff) of the pairs (x, p), from their sets."""
        pairs = self.stage.write(pairs, "measured")
        own = self.sets(pairs.select(F.explode(F.array("x", "p"))))
        found = self.stage.write(pairs.join(own, "x").join(own.toDF("p", "other"), "p").select(
            "x", "p", "own", "other").mapInArrow(
                _distances, "x long, p long, nx long, np long, diff long"), "distances")
        self.stage.release(pairs, own)
        return found


def _placed(members: DataFrame, pivots: DataFrame, source: _Source) -> DataFrame:
    """(x, p, w, settled, nx, np, d, may): the pairs with a pivot that may link, and all of
    unsettled regions, at these regions' widths."""
    brief = source.brief
    # a pair of pivots is met once; one of a settled region only if it may join components
    pairs = _near(members, pivots).where("NOT settled OR c != cp").select(
        F.greatest("x", "p").alias("x"), F.least("x", "p").alias("p"), "w", "settled",
        (F.col("c") != F.col("cp")).alias("seek")).groupBy("x", "p", "w").agg(
        F.min("settled").alias("settled"), F.max("seek").alias("seek"))
    return source.stage.write(pairs.join(brief, "x").join(brief.toDF("p", "np", "pp"), "p").select(
        "x", "p", "w", "settled", "seek", "nx", "np", "px", "pp").mapInArrow(
            _places(source.link), "x long, p long, w long, settled boolean, nx long, np long, "
                                  "d long, may boolean").where("may OR NOT settled"), "placed")


def _at_once(groups: DataFrame, source: _Source) -> tuple[DataFrame, DataFrame]:
    """Of cells or regions (cell, x, c, d, w, g, ...): (distances of the pairs that may link in
    those compared at once, the rows of the others)."""
    stage, link = source.stage, source.link
    few = F.col("g") <= min(SETS, SMALL)
    fits = few | (F.col("g") <= SMALL) & (F.col("g") * F.col("w") <= SMALL_BITS)
    close = stage.write(groups.where(fits).select("cell", "x", "c", "d").join(source.brief, "x").groupBy(
        "cell").applyInArrow(_candidates(link), "cell long, x long, p long"), "close")
    found = source.measured(close.where("x IS NOT NULL").select("x", "p").distinct())
    dense = close.where("x IS NULL").select("cell")
    if dense.isEmpty():
        return found, groups.where(~fits)
    dense = groups.join(dense, "cell", "left_semi")
    own = source.sets(dense.where(few).select("x"))
    whole = stage.write(dense.where(few).join(own, "x").select("cell", "x", "c", "own").groupBy(
        "cell").applyInArrow(_compared(link), "x long, p long, nx long, np long, diff long"), "whole")
    stage.release(own)
    return found.unionByName(whole), groups.where(~fits).unionByName(dense.where(~few))


def _round(members: DataFrame, pivots: DataFrame, known: DataFrame | None, labels: DataFrame | None,
           pending: DataFrame | None, source: _Source
           ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """One level of the recursion: (distances found, names by the links so far as (vertex,
    component), distances found in cells, not yet among these, members of the next regions)."""
    stage, link, first = source.stage, source.link, known is None
    placed = _placed(members, pivots, source)
    asked = placed.where("may").select("x", "p").distinct()
    found = source.measured(asked if first else asked.join(known, ["x", "p"], "left_anti"))
    new = found if pending is None else found.unionByName(pending)
    labels = _joined(_linked(new, link), labels, stage)

    # Voronoi cells of the regions that their pivots do not settle
    sides = placed.select("x", "p", "w", F.col("nx").alias("n"), "d")
    both = sides.unionByName(placed.select(F.col("p").alias("x"), F.col("x").alias("p"), "w",
                                           F.col("np").alias("n"), "d"))
    chosen = pivots.select("region", F.col("p").alias("x"))
    unsettled = _near(members, pivots).where("NOT settled").select("region", "x", "p", "w").join(
        chosen, ["region", "x"], "left_anti")
    homed = unsettled.join(both, ["x", "p", "w"]).withColumn(
        "home", F.min(F.struct("d", "p")).over(Window.partitionBy("region", "x")))
    cell = F.xxhash64("p", "w") if first else F.xxhash64("region", "p")
    most = F.expr(f"n * {link.near} div {link.p}")
    cells = stage.write(homed.where(
        (F.col("p") <= F.col("home.p")) & (F.col("d") <= F.col("home.d") + 2 * most)).select(
        cell.alias("cell"), "x", "p", "w", "d").distinct(), "cells")
    of_x = labels.select(F.col("vertex").alias("x"), F.col("component").alias("c"))
    of_p = labels.select(F.col("vertex").alias("p"), F.col("component").alias("cp"))
    labelled = cells.join(of_x, "x", "left").join(of_p, "p", "left").select(
        "cell", "x", "p", "w", "d", F.coalesce("c", "x").alias("c"),
        (F.coalesce("c", "x") != F.coalesce("cp", "p")).alias("outer"))
    open_cells = labelled.groupBy("cell").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("g")).where("lo < hi").select("cell", "g")
    opened = stage.write(labelled.join(open_cells, "cell"), "open")
    settled, large = _at_once(opened, source)
    after = None if large.isEmpty() else _divided(stage.write(large, "large"), source)
    stage.release(pivots, placed, cells, opened)
    return found, labels, settled, after


def _divided(large: DataFrame, source: _Source) -> DataFrame:
    """(region, x, w, c, leads): the members of the next regions of cells (cell, x, p, w, c, outer)."""
    stage, link = source.stage, source.link
    sets = source.sets(large.select(F.explode(F.array("x", "p"))))
    own, other = sets, sets.toDF("p", "other")
    sampled = large.withColumn("rank", F.row_number().over(
        Window.partitionBy("cell").orderBy(F.xxhash64("x"), "x"))).where(F.col("rank") <= SAMPLED)
    centres = sampled.select("cell", "x", "p").join(own, "x").select("cell", "p", "own").groupBy(
        "cell").applyInArrow(_centre, "cell long, p long, centre binary")
    # a cell's pivot and centre meet before they are joined with its members
    centres = stage.write(centres.join(other, "p").select("cell", "other", "centre"), "centres")
    named = large.join(own, "x").join(centres, "cell").select(
        "cell", "x", "c", "w", "outer", "own", "other", "centre").mapInArrow(
            _differences(link), "cell long, x long, c long, w long, e long, leads boolean")
    regions = stage.write(named.select(F.xxhash64("cell", "e").alias("region"), "x", "c", "w", "leads"), "named")
    open_regions = regions.groupBy("region").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"), F.max("leads").alias("leads")).where(
        "lo < hi AND leads").select("region")
    after = stage.write(regions.join(open_regions, "region", "left_semi").groupBy(
        "region", "x", "c", "w").agg(F.max("leads").alias("leads")), "regions")
    stage.release(large, sets, centres, regions)
    return after


def _small_regions(members: DataFrame, source: _Source) -> tuple[DataFrame, DataFrame]:
    """(distances in the regions that are compared at once, members of the others)."""
    stage = source.stage
    hashed = [F.bit_xor(F.xxhash64("x", F.lit(seed))).alias(f"h{seed}") for seed in (1, 2)]
    regions = stage.write(members.groupBy("region").agg(
        F.count("*").alias("g"), F.min("x").alias("lo"), F.max("x").alias("hi"), *hashed), "sizes")
    # of those that have the same members one is compared, or divided
    once = regions.groupBy("g", "lo", "hi", "h1", "h2").agg(F.min("region").alias("region"))
    groups = stage.write(members.withColumnRenamed("region", "cell").join(
        once.select(F.col("region").alias("cell"), "g"), "cell").withColumn("d", F.lit(0).cast("long")), "groups")
    found, rest = _at_once(groups, source)
    large = stage.write(rest.withColumnRenamed("cell", "region").drop("g", "d"), "large")
    stage.release(regions, members, groups)
    return found, large


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``: components of links
    of that Jaccard similarity or more, over shingles of so many words."""
    link = Link.at(similarity)
    spark = prepare(docs.sparkSession)
    stage = Stage(spark, "jaccard-join")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    sketch = stage.write(rows.mapInArrow(
        _sketch(words, link),
        "doc_id long, n long, h1 long, h2 long, parity binary, regions array<long>"), "sketch")
    classes = stage.write(sketch.where("doc_id IS NOT NULL AND n > 0").groupBy("h1", "h2", "n").agg(
        F.min("doc_id").alias("rep")), "classes")
    members = _first_regions(sketch, classes, stage)
    wanted = members.select(F.col("x").alias("doc_id")).distinct()
    brief = stage.write(sketch.join(wanted, "doc_id", "left_semi").select(
        F.col("doc_id").alias("x"), F.col("n").alias("nx"), F.col("parity").alias("px")).distinct(), "brief")
    digests = stage.write(sketch.select("doc_id", "n", "h1", "h2"), "digests")
    stage.release(sketch)  # its region keys are its bulk
    source = _Source(rows, brief, words, link, stage)
    known = labels = pending = None
    while members is not None and not members.isEmpty():
        if known is not None:
            close, members = _small_regions(members, source)
            known, pending = known.unionByName(close), pending.unionByName(close)
            if members.isEmpty():
                break
        pivots = stage.write(_pivots(members, SETTLE[0] if known is None else SETTLE[1]), "pivots")
        found, labels, pending, after = _round(members, pivots, known, labels, pending, source)
        known = (found if known is None else known.unionByName(found)).unionByName(pending)
        stage.release(members)
        members = after
    links = classes.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)
    labels = components(links if known is None else _linked(known, link), stage)
    named = stage.write(classes.join(labels, classes["rep"] == labels["vertex"], "left").select(
        "h1", "h2", "n", F.coalesce("component", "rep").alias("component_id")), "named")
    stage.release_all_but(digests, named)  # the result reads these two
    return digests.join(named, ["h1", "h2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .otherwise(F.col("doc_id")).alias("component_id"))
