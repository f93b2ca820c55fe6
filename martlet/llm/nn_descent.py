"""Approximate nearest neighbours: NN-descent graph and greedy graph search.

*Vectors.* Nearness is the inner product. Vectors that are null, zero, hold a
null or non-finite component or have another length than most take no part.
Equal vectors form one node (named by its least id) with all their ids as
members, so a vector that a third of all rows share is one node. For the graph
a coordinate is added that gives all vectors one length; then the largest
inner product is the least angle.

*Start.* ``TREES`` projection trees, fitted on a bounded sample (``SAMPLE``
nodes), cut all nodes into blocks of about ``BLOCK``; a node's first neighbours
are its nearest in its blocks.

*Descent.* A node's neighbourhood is its list and the ``LIST`` nearest nodes that
list it. Neighbourhoods are gathered by block of nodes, together with one copy
of every vector the block needs (a Spark join), and neighbours of the same node
are compared with one another, where at least one is new since the last round.
Pairs that beat a node's worst neighbour are proposed to it, and each node keeps
the nearest ``LIST`` of old and proposed ones. Rounds end when less than
``SETTLED`` of the nearest ``TOP`` are new, or after ``ROUNDS``.

*Search.* A query keeps the best ``BEAM`` nodes found, at first the nearest among
``ENTRIES`` fixed entry nodes. In every step its ``EXPAND`` best unexpanded nodes
are joined with the graph, and their neighbours with the vectors, cell by cell;
it ends when all nodes kept are expanded. The best nodes are scored again in
double precision on the original vectors and unfolded to their members.

Lists are bounded by LIST and BEAM and groups by BLOCK, whatever the data; the
driver sees the sample, the entry nodes and counts only.

Defined cases: ties go to the smaller id; with fewer candidates than asked for,
all are returned; a query without a valid vector, or without a candidate, gets
no rows; an id is one vector, of several different ones the least, component by
component; an empty table gives an empty
result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import Stage, first_by_hash, prepare

LIST = 48
TREES = 6
BLOCK = 1024
SAMPLE = 16_384
ROUNDS = 5
TOP = 20
SETTLED = 0.08
GATHER = 16_384  # nodes of a block in a descent round
ENTRIES = 1024
BEAM = 112
EXPAND = 40
MOST_STEPS = 40

TASK = 2048  # nodes or queries that one task works on, about

_LISTS = "node long, ids array<long>, sims array<float>, fresh array<boolean>"
# many entries in one row: bucket of the owners, owner and neighbour of each entry
_PACKED = ("bucket long, owners array<long>, ids array<long>, sims array<float>, "
           "fresh array<boolean>")


@dataclass
class Index:
    nodes: DataFrame  # node, vec (bytes, with the added coordinate), block
    members: DataFrame  # node, vec_id: every valid id
    vectors: DataFrame  # node, original: the vector as given
    graph: DataFrame  # node, ids: neighbours both ways
    entry_ids: np.ndarray
    entry_vectors: np.ndarray
    length: int  # components of a vector
    stage: Stage


# -- array helpers ---------------------------------------------------------------

def _lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, sizes) of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(offsets)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors from a column of float32 bytes."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float32).reshape(len(values), -1)


def _list_array(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 4000) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that never split a run of equal first columns."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        whole = pa.Table.from_batches(held)
        keys = whole.column(0).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut:
            yield whole.slice(0, cut)
            held = whole.slice(cut).to_batches()
            size = sum(b.num_rows for b in held)
    if size:
        yield pa.Table.from_batches(held)


def _best(owner: np.ndarray, ids: np.ndarray, sims: np.ndarray, fresh: np.ndarray, most: int
          ) -> tuple[np.ndarray, ...]:
    """Each owner's ``most`` nearest, an id once (a known one before a fresh one);
    (owners, sizes, ids, sims, fresh)."""
    order = np.lexsort((fresh, ids, owner))
    owner, ids, sims, fresh = owner[order], ids[order], sims[order], fresh[order]
    once = np.concatenate(([True], (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1]))) \
        if len(owner) else np.zeros(0, bool)
    owner, ids, sims, fresh = owner[once], ids[once], sims[once], fresh[once]
    order = np.lexsort((ids, -sims, owner))
    owner, ids, sims, fresh = owner[order], ids[order], sims[order], fresh[order]
    owners, first = np.unique(owner, return_index=True)
    rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
    keep = rank < most
    sizes = np.add.reduceat(keep, first) if len(first) else np.zeros(0, int)
    return owners, sizes, ids[keep], sims[keep], fresh[keep]


def _list_batch(owners, sizes, ids, sims, fresh) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(owners, pa.int64()), _list_array(ids, sizes, pa.int64()),
         _list_array(sims.astype(np.float32), sizes, pa.float32()),
         _list_array(fresh, sizes, pa.bool_())], names=["node", "ids", "sims", "fresh"])


def _bucket(nodes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _pack(owners, ids, sims, fresh, buckets: int) -> pa.RecordBatch:
    """One row for every bucket of the owners."""
    at = _bucket(owners, buckets)
    order = np.argsort(at, kind="stable")
    own, sizes = np.unique(at, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(own, pa.int64()), _list_array(owners[order], sizes, pa.int64()),
         _list_array(ids[order], sizes, pa.int64()),
         _list_array(sims[order].astype(np.float32), sizes, pa.float32()),
         _list_array(fresh[order], sizes, pa.bool_())],
        names=["bucket", "owners", "ids", "sims", "fresh"])


def _tasks(count: int) -> int:
    return max(16, -(-count // TASK))


def _gathered(rows: DataFrame, key: str, tasks: int, *order: str) -> DataFrame:
    """Rows of one key together and in order, in at most ``tasks`` tasks."""
    return rows.repartition(key).coalesce(tasks).sortWithinPartitions(key, *order)


# -- vectors ---------------------------------------------------------------------

def _valid(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)


def valid_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, original) of the rows that take part, their own length not yet checked."""
    return table.select(F.col(id_col).cast("long").alias("vec_id"),
                        F.col(vec_col).alias("original")).where(
        F.col("vec_id").isNotNull() & F.coalesce(_valid(F.col("original")), F.lit(False)))


def _one_each(given: DataFrame, length: int) -> DataFrame:
    """(vec_id, original), one row per id: of several vectors of one id the least."""
    return given.where(F.size("original") == length).groupBy("vec_id").agg(
        F.min("original").alias("original"))


def _extended(longest: float):
    """mapInArrow: (node, original) -> (node, vec): with the length-giving coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, -1) / longest
            rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1, keepdims=True)))
            both = np.hstack([x, rest]).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in both], pa.binary())],
                names=["node", "vec"])

    return run


# -- projection trees ---------------------------------------------------------------

@dataclass
class _Tree:
    """Splits by a direction at its median; leaves are numbered."""
    directions: list[np.ndarray]
    cuts: list[float]
    below: list[tuple[int, int]]  # child: a split (>= 0) or ~leaf
    shares: list[float]  # of the sample, by leaf

    def leaf(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.directions else []
        while todo:
            split, rows = todo.pop()
            high = x[rows] @ self.directions[split] > self.cuts[split]
            for side, part in ((0, rows[~high]), (1, rows[high])):
                child = self.below[split][side]
                if child < 0:
                    out[part] = ~child
                elif len(part):
                    todo.append((child, part))
        return out


def _grow(sample: np.ndarray, leaf_share: float, rng: np.random.Generator) -> _Tree:
    tree = _Tree([], [], [], [])
    least = max(8, int(leaf_share * len(sample)))

    def add(rows: np.ndarray) -> int:
        if len(rows) <= least:
            tree.shares.append(len(rows) / max(1, len(sample)))
            return ~(len(tree.shares) - 1)
        a, b = rng.choice(len(rows), 2, replace=False)
        direction = sample[rows[a]] - sample[rows[b]]
        at = sample[rows] @ direction
        cut = float(np.median(at))
        low, high = rows[at <= cut], rows[at > cut]
        if not len(low) or not len(high):  # equal along this line: nothing to cut
            tree.shares.append(len(rows) / len(sample))
            return ~(len(tree.shares) - 1)
        me = len(tree.directions)
        tree.directions.append(direction)
        tree.cuts.append(cut)
        tree.below.append((0, 0))
        tree.below[me] = (add(low), add(high))
        return me

    if len(sample) > least:
        add(np.arange(len(sample)))
    if not tree.directions:
        return _Tree([], [], [], [1.0])
    return tree


def _blocks(trees: list[_Tree], count: int, block: int):
    """mapInArrow: (node, vec) -> (block, node, vec) of every tree. A leaf that must
    hold more than a block is dealt out by a hash of the node."""
    deals = [np.maximum(1, np.ceil(np.array(t.shares) * count / block / 1.5)).astype(np.int64)
             for t in trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            x = _matrix(batch.column(1))
            mixed = (nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for t, (tree, deal) in enumerate(zip(trees, deals)):
                leaf = tree.leaf(x)
                key = ((np.int64(t) << 58) | (leaf << 34)) + (mixed.astype(np.int64) % deal[leaf])
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0), batch.column(1)],
                                                 names=["block", "node", "vec"])

    return run


def _near(buckets: int):
    """mapInArrow over (block, node, vec) by block: the nearest of each node in its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            blocks = table.column("block").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
            for lo, hi in zip(starts, np.append(starts[1:], len(blocks))):
                yield from _nearest_in_block(table.slice(int(lo), int(hi - lo)), buckets)

    return run


def _nearest_in_block(table: pa.Table, buckets: int) -> Iterator[pa.RecordBatch]:
    nodes = table.column("node").to_numpy()
    x = _matrix(table.column("vec"))
    n, k = len(nodes), min(LIST, len(nodes) - 1)
    for lo in range(0, n, 1024):
        sims = x[lo:lo + 1024] @ x.T
        rows = np.arange(len(sims))
        sims[rows, rows + lo] = -np.inf
        near = np.argpartition(-sims, max(k - 1, 0), axis=1)[:, :k]
        yield _pack(np.repeat(nodes[lo:lo + 1024], k), nodes[near].ravel(),
                    np.take_along_axis(sims, near, 1).ravel(), np.ones(len(sims) * k, bool), buckets)


# -- descent -------------------------------------------------------------------------

def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over packed entries by bucket: one list a node, the nearest."""
    for table in _whole_groups(batches, 200):
        owners, sims, ids, fresh = (_lists(table.column(c))[0] for c in ("owners", "sims", "ids", "fresh"))
        yield _list_batch(*_best(owners, ids, sims, fresh.astype(bool), LIST))


def _known(buckets: int):
    """mapInArrow: lists -> packed entries, none of them fresh."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = _lists(batch.column(1))
            yield _pack(np.repeat(batch.column(0).to_numpy(), sizes), ids, _lists(batch.column(2))[0],
                        np.zeros(len(ids), bool), buckets)

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: lists -> (node, other, sim, fresh), one row an entry."""
    for batch in batches:
        ids, sizes = _lists(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(), sizes)), pa.array(ids),
             pa.array(_lists(batch.column(2))[0]), pa.array(_lists(batch.column(3))[0].astype(bool))],
            names=["node", "other", "sim", "fresh"])


def _compared(buckets: int):
    """mapInArrow by block over (block, node, other, fresh) and, with a null node, the
    vectors (block, other, vec, worst) -> packed proposals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, 1):
            blocks = table.column("block").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
            for lo, hi in zip(starts, np.append(starts[1:], len(blocks))):
                yield _compare(table.slice(int(lo), int(hi - lo)), buckets)

    return run


def _compare(table: pa.Table, buckets: int) -> pa.RecordBatch:
    """One block: its neighbourhoods' members compared with one another."""
    is_vector = pc.is_null(table.column("node"))
    vectors, hoods = table.filter(is_vector).sort_by("other"), table.filter(pc.invert(is_vector))
    ids = vectors.column("other").to_numpy()
    x, worst = _matrix(vectors.column("vec")), vectors.column("worst").to_numpy()
    node, other = hoods.column("node").to_numpy(), hoods.column("other").to_numpy()
    fresh = hoods.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
    order = np.lexsort((~fresh, other, node))  # both ways: the fresh entry counts
    node, other, fresh = node[order], other[order], fresh[order]
    once = np.concatenate(([True], (node[1:] != node[:-1]) | (other[1:] != other[:-1])))
    node, fresh = node[once], fresh[once]
    at = np.searchsorted(ids, other[once])
    _, first, sizes = np.unique(node, return_index=True, return_counts=True)
    found: list[tuple[np.ndarray, ...]] = []
    for lo in range(0, len(first), 128):
        f, s = first[lo:lo + 128], sizes[lo:lo + 128]
        width = int(s.max())
        place = np.arange(width)
        there = place < s[:, None]
        spot = np.where(there, f[:, None] + place, 0)
        hood = at[spot]
        new = fresh[spot] & there
        v = x[hood]
        sims = v @ v.transpose(0, 2, 1)
        pairs = there[:, :, None] & there[:, None, :] & (new[:, :, None] | new[:, None, :])
        pairs &= sims > worst[hood][:, :, None]
        pairs[:, place, place] = False
        g, i, j = np.nonzero(pairs)
        a, b = hood[g, i], hood[g, j]
        key, where = np.unique(a * len(ids) + b, return_index=True)
        found.append((key, sims[g, i, j][where]))
    key = np.concatenate([k for k, _ in found])
    sims = np.concatenate([s for _, s in found])
    owners, count, got, sims, _ = _best(key // len(ids), key % len(ids), sims,
                                        np.zeros(len(key), bool), LIST)
    return _pack(np.repeat(ids[owners], count), ids[got], sims, np.ones(len(got), bool), buckets)


def _merged(packed: DataFrame, count: int) -> DataFrame:
    return _gathered(packed, "bucket", _tasks(count)).mapInArrow(_merge, _LISTS)


def _reverse(graph: DataFrame) -> DataFrame:
    """(node, other, fresh): the LIST nearest nodes that list a node."""
    entries = graph.mapInArrow(_listed, "node long, other long, sim float, fresh boolean")
    order = Window.partitionBy("other").orderBy(F.desc("sim"), "node")
    return entries.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= LIST).select(F.col("other").alias("node"), F.col("node").alias("other"),
                                      "fresh")


def _descend(graph: DataFrame, nodes: DataFrame, count: int, stage: Stage) -> DataFrame:
    """The lists after one round of comparing neighbours of neighbours."""
    buckets = _tasks(count)
    forward = graph.mapInArrow(_listed, "node long, other long, sim float, fresh boolean").drop("sim")
    hoods = stage.write(forward.unionByName(_reverse(graph)).join(
        nodes.select("node", "block"), "node").select("block", "node", "other", "fresh"), "hoods")
    worst = graph.select(F.col("node").alias("other"), F.when(
        F.size("sims") >= LIST, F.array_min("sims")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    needed = hoods.select("block", "other").distinct().join(
        nodes.select(F.col("node").alias("other"), "vec").join(worst, "other"), "other")
    both = hoods.select("block", "node", "other", "fresh", F.lit(None).cast("binary").alias("vec"),
                        F.lit(None).cast("float").alias("worst")).unionByName(
        needed.select("block", F.lit(None).cast("long").alias("node"), "other",
                      F.lit(None).cast("boolean").alias("fresh"), "vec", "worst"))
    proposals = _gathered(both, "block", buckets).mapInArrow(_compared(buckets), _PACKED)
    known = graph.mapInArrow(_known(buckets), _PACKED)
    new = stage.write(_merged(known.unionByName(proposals), count), "lists")
    stage.release(hoods, graph)
    return new


def build(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> Index:
    """Index every valid vector of ``table``."""
    spark = prepare(table.sparkSession)
    stage = Stage(spark, "nn-descent")
    given = valid_vectors(table, id_col, vec_col)
    common = given.groupBy(F.size("original").alias("length")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "length").first()
    length = common["length"] if common else 0
    rows = stage.write(_one_each(given, length), "rows")
    vectors = stage.write(rows.groupBy("original").agg(F.min("vec_id").alias("node")), "vectors")
    members = stage.write(rows.join(vectors, "original").select("node", "vec_id"), "members")
    norm = F.sqrt(F.aggregate("original", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    count, longest = vectors.agg(F.count("*"), F.max(norm)).first()
    wide = stage.write(vectors.select("node", "original").mapInArrow(
        _extended((longest or 1.0) * (1 + 1e-9)), "node long, vec binary"), "wide")
    # at most SAMPLE and ENTRIES nodes, in the order of a hash
    drawn = first_by_hash(wide, "node", max(SAMPLE, ENTRIES), count).toArrow()
    sample = _matrix(drawn.column("vec")) if drawn.num_rows else np.zeros((0, 1), np.float32)
    rng = np.random.default_rng(5)
    trees = [_grow(sample[:SAMPLE], BLOCK / max(1, count), rng) for _ in range(TREES)]
    coarse = _grow(sample[:SAMPLE], GATHER / max(1, count), rng)
    nodes = stage.write(wide.mapInArrow(_blocks([coarse], count, GATHER),
                                        "block long, node long, vec binary"), "nodes")
    first = wide.mapInArrow(_blocks(trees, count, BLOCK), "block long, node long, vec binary")
    graph = stage.write(_merged(_gathered(first, "block", _tasks(count) * TREES).mapInArrow(
        _near(_tasks(count)), _PACKED), count), "lists")
    for _ in range(ROUNDS if count > 1 else 0):
        graph = _descend(graph, nodes, count, stage)
        changed = graph.agg(F.avg(F.aggregate(F.slice("fresh", 1, TOP), F.lit(0), lambda a, x: a
                                            + x.cast("int")) / F.lit(TOP))).first()[0]
        if (changed or 0.0) < SETTLED:
            break
    both = graph.mapInArrow(_listed, "node long, other long, sim float, fresh boolean").select(
        "node", "other").unionByName(_reverse(graph).select("node", "other"))
    adjacency = stage.write(both.groupBy("node").agg(F.collect_set("other").alias("ids")), "graph")
    stage.release(graph, wide, rows)
    return Index(nodes, members, vectors, adjacency,
                 drawn.column("node").to_numpy()[:ENTRIES], sample[:ENTRIES], length, stage)


# -- search ---------------------------------------------------------------------------

_BEAM = "q long, qvec binary, ids array<long>, sims array<float>, done array<boolean>"


def _enter(ids: np.ndarray, vectors: np.ndarray):
    """mapInArrow: (q, original) -> beams over the entry nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, -1)
            x = np.hstack([x, np.zeros((len(x), 1))]).astype(np.float32)
            sims = x @ vectors.T
            top = np.argsort(-sims, axis=1, kind="stable")[:, :BEAM]
            sizes = np.full(len(x), top.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()),
                 _list_array(ids[top].ravel(), sizes, pa.int64()),
                 _list_array(np.take_along_axis(sims, top, 1).ravel(), sizes, pa.float32()),
                 _list_array(np.zeros(top.size, bool), sizes, pa.bool_())],
                names=["q", "qvec", "ids", "sims", "done"])

    return run


def _frontier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: beams -> (node, q): the best nodes not expanded yet."""
    for batch in batches:
        q, out = batch.column(0).to_numpy(), []
        for row, (ids, done) in enumerate(zip(batch.column(2).to_pylist(),
                                              batch.column(4).to_pylist())):
            out += [(i, q[row]) for i, d in zip(ids, done) if not d][:EXPAND]
        columns = list(zip(*out)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         names=["node", "q"])


_ASKED = "cell long, q long, qvec binary, ids array<long>"


def _ask(cells: int):
    """mapInArrow over (q, qvec, ids) by q, its beam (with the vector) and the lists of
    its frontier -> (cell, q, qvec, ids): the neighbours not kept already, once each, by
    the cell that holds their vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, 2000):
            q = table.column("q").to_numpy()
            vecs = table.column("qvec").to_pylist()
            ids, sizes = _lists(table.column("ids"))
            ends = np.cumsum(sizes)
            starts = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
            rows = []
            for lo, hi in zip(starts, np.append(starts[1:], len(q))):
                beam = next(i for i in range(lo, hi) if vecs[i] is not None)
                kept = ids[ends[beam] - sizes[beam]:ends[beam]]
                found = np.setdiff1d(ids[ends[lo] - sizes[lo]:ends[hi - 1]], kept)
                cell = _bucket(found, cells)
                order = np.argsort(cell, kind="stable")
                own, first = np.unique(cell[order], return_index=True)
                rows += [(int(c), int(q[lo]), vecs[beam], part) for c, part in
                         zip(own, np.split(found[order], first[1:]))]
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["cell", "q", "qvec", "ids"])

    return run


def _celled(cells: int):
    """mapInArrow: (node, vec) -> (cell, q, qvec, ids): all vectors of a batch by cell, with
    a null q."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            cell = _bucket(nodes, cells)
            rows = [(int(c), None, x[cell == c].tobytes(), nodes[cell == c]) for c in np.unique(cell)]
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["cell", "q", "qvec", "ids"])

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow by cell, vectors first: the nodes asked for, scored; (q, ids, sims)."""
    cell, nodes, x, waiting = None, None, None, []
    for batch in batches:
        rows = []
        for own, q, vec, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    batch.column(2).to_pylist(), batch.column(3)):
            ids = ids.values.to_numpy()
            if own != cell:
                cell, nodes, waiting = own, None, []
            if q is None:  # the vectors of a cell come before the questions
                waiting.append((ids, np.frombuffer(vec, np.float32).reshape(len(ids), -1)))
                continue
            if nodes is None:
                nodes = np.concatenate([i for i, _ in waiting])
                order = np.argsort(nodes)
                nodes, x = nodes[order], np.concatenate([v for _, v in waiting])[order]
            sims = x[np.searchsorted(nodes, ids)] @ np.frombuffer(vec, np.float32)
            top = np.argsort(-sims, kind="stable")[:BEAM]
            rows.append((q, ids[top], sims[top]))
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float32())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["q", "ids", "sims"])


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over (q, qvec, ids, sims, done) sorted by q, the beam (with its
    vector) and the answers: the new beam. What was on the frontier is done."""
    for table in _whole_groups(batches):
        q = table.column("q").to_numpy()
        vecs = {k: v for k, v in zip(q, table.column("qvec").to_pylist()) if v is not None}
        ids, sizes = _lists(table.column("ids"))
        new = ~_lists(table.column("done"))[0].astype(bool)
        owners, sizes, ids, sims, new = _best(np.repeat(q, sizes), ids,
                                              _lists(table.column("sims"))[0], new, BEAM)
        yield pa.RecordBatch.from_arrays(
            [pa.array(owners), pa.array([vecs[k] for k in owners], pa.binary()),
             _list_array(ids, sizes, pa.int64()), _list_array(sims, sizes, pa.float32()),
             _list_array(~new, sizes, pa.bool_())], names=["q", "qvec", "ids", "sims", "done"])


def _mark(beam: DataFrame) -> DataFrame:
    """The beam with the frontier marked as done."""
    opened = F.transform("done", lambda d, i: F.size(F.filter(
        F.slice(F.col("done"), 1, i + 1), lambda x: ~x)))
    return beam.withColumn("done", F.zip_with("done", opened, lambda d, n: d | (n <= EXPAND)))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (q, node, left, right) -> (q, node, score) in double precision."""
    for batch in batches:
        left = np.array(batch.column(2).to_pylist(), np.float64).reshape(batch.num_rows, -1)
        right = np.array(batch.column(3).to_pylist(), np.float64).reshape(batch.num_rows, -1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array((left * right).sum(1))],
            names=["q", "node", "score"])


def search(index: Index, queries: DataFrame, k: int = TOP, id_col: str = "vec_id",
           vec_col: str = "embedding", exclude_self: bool = True) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for every valid query.

    ``exclude_self``: a query is no candidate of its own (queries come from the
    indexed table). ``k`` is at most BEAM / 2.
    """
    stage = index.stage
    asked = _one_each(valid_vectors(queries, id_col, vec_col), index.length)
    asked = stage.write(asked.select(F.col("vec_id").alias("q"), "original"), "queries")
    beam = stage.write(asked.mapInArrow(_enter(index.entry_ids, index.entry_vectors), _BEAM), "beam")
    count = index.nodes.count()
    cells = _tasks(count)
    tasks = _tasks(asked.count())
    held = stage.write(index.nodes.select("node", "vec").mapInArrow(_celled(cells), _ASKED), "cells")
    for _ in range(MOST_STEPS):
        frontier = beam.mapInArrow(_frontier, "node long, q long").join(index.graph, "node").select(
            "q", F.lit(None).cast("binary").alias("qvec"), "ids")
        wanted = _gathered(frontier.unionByName(beam.select("q", "qvec", "ids")), "q", tasks
                           ).mapInArrow(_ask(cells), _ASKED)
        answers = _gathered(held.unionByName(wanted), "cell", cells, "q").mapInArrow(
            _answer, "q long, ids array<long>, sims array<float>").select(
            "q", F.lit(None).cast("binary").alias("qvec"), "ids", "sims",
            F.transform("ids", lambda x: F.lit(False)).alias("done"))
        new = stage.write(_gathered(_mark(beam).unionByName(answers), "q", tasks).mapInArrow(
            _keep, _BEAM), "beam")
        stage.release(beam)
        beam = new
        if beam.where(F.exists("done", lambda d: ~d)).isEmpty():
            break
    near = beam.select("q", F.explode(F.slice("ids", 1, 2 * k + 1)).alias("node"))
    original = index.vectors.select("node", F.col("original").alias("right"))
    scored = near.join(original, "node").join(
        asked.select("q", F.col("original").alias("left")), "q").select(
        "q", "node", "left", "right").mapInArrow(_exact, "q long, node long, score double")
    # of a node's members at most the k + 1 least can be among the k nearest
    few = index.members.withColumn("place", F.row_number().over(
        Window.partitionBy("node").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    hits = scored.join(few, "node").where(
        F.col("q") != F.col("vec_id") if exclude_self else F.lit(True))
    ranked = hits.withColumn("rank", F.row_number().over(
        Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select(
        F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
