"""Lloyd's clustering of integer vectors, pruned by a LAESA pivot table.

1. Vectors with exactly ``dims`` finite components become integers, floor(scale * x).
   The start centroids are the ``k`` vectors whose ids hash lowest.
2. Pivots are start centroids far from one another (each the farthest from those chosen).
   The distances of every vector to all pivots are computed once and stored beside it:
   the pivot table, the only distances that a vector keeps.
3. Each round the centroids' distances to the pivots are computed (``k`` rows). By the
   triangle inequality, |d(vector, pivot) - d(centroid, pivot)| is never above the distance
   of vector and centroid. The centroid with the least such bound gets its exact distance
   first; those whose bound is above it cannot be nearest and are left out, the others get
   exact distances in 64-bit integers. Bounds give way by ``SLACK``, so rounding never
   leaves out a centroid that ties.
4. Tasks add up counts and sums per centroid; ``k`` rows reach the driver, which takes the
   exact floor of sum / count.

Defined cases: vectors that are null, have another number of components, or hold null or
non-finite ones take no part; components may reach ``MOST`` in size after scaling (distances
beyond do not fit a long, an error says so); a repeated row or id is a vector of its own;
null ids take part, hash after all others and are returned; with fewer than ``k`` vectors
each is a centroid; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import Stage, prepare

K, ROUNDS, DIMS, SCALE, SALT = 40, 5, 64, 256, "2:"
PIVOTS = 16
MOST = 1 << 28
SLACK = 1e-9


@dataclass(frozen=True)
class Clusters:
    """(vec_id, cluster, distance) of every vector, and the final centroids."""

    assigned: DataFrame
    centroids: list[list[int]]


def _usable(vector, dims: int):
    """Whether a vector takes part (a native condition)."""
    number = F.col(vector).cast("array<double>")
    return F.coalesce((F.size(number) == dims) & F.forall(
        number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def _integers(x: np.ndarray, scale: int) -> np.ndarray:
    whole = np.floor(scale * x)
    if np.abs(whole).max(initial=0) > MOST:
        raise ArithmeticError(f"a component is beyond {MOST} after scaling")
    return whole.astype("<i4")


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, exact."""
    diff = a - b
    return np.einsum("ij,ij->i", diff, diff)


def pivots(start: np.ndarray, many: int) -> np.ndarray:
    """Of the start centroids, the first and then always the farthest from those chosen."""
    chosen = [0]
    far = _squares(start, start[:1])
    while len(chosen) < many and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _squares(start, start[chosen[-1:]]))
    return start[chosen]


def _roots(vectors: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Distances of every vector to every row of ``to``."""
    return np.stack([np.sqrt(_squares(vectors, p[None]).astype(float)) for p in to], axis=1)


def _tabled(at: np.ndarray, scale: int):
    """mapInArrow: (vec_id, vector) -> (vec_id, v, pivots): integers and pivot distances."""
    dims = at.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            v = _integers(x.astype(float), scale)
            roots = _roots(v.astype(np.int64), at).astype("<f8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in v], pa.binary()),
                 pa.array([r.tobytes() for r in roots], pa.binary())],
                names=["vec_id", "v", "pivots"])

    return run


def nearest(vectors: np.ndarray, roots: np.ndarray, centroids: np.ndarray,
            centroid_roots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each vector, ties to the smaller number, and how
    many exact distances it took."""
    n, k = len(vectors), len(centroids)
    low = np.zeros((n, k))
    for p in range(roots.shape[1]):
        np.maximum(low, np.abs(roots[:, p, None] - centroid_roots[None, :, p]), out=low)
    guess = low.argmin(axis=1)
    upper = np.sqrt(_squares(vectors, centroids[guess]).astype(float))
    give = SLACK * (1 + upper + roots.max(axis=1) + centroid_roots.max())
    rows, cols = np.nonzero(low <= (upper + give)[:, None])
    exact = np.full((n, k), np.iinfo(np.int64).max)
    exact[rows, cols] = _squares(vectors[rows], centroids[cols])
    cluster = exact.argmin(axis=1)
    return cluster, exact[np.arange(n), cluster], len(rows) + n


def _read(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(b"".join(batch.column("v").to_pylist()), "<i4").reshape(-1, dims)
    roots = np.frombuffer(b"".join(batch.column("pivots").to_pylist()), "<f8")
    return v.astype(np.int64), roots.reshape(len(v), -1)


def _summed(centroids: np.ndarray, centroid_roots: np.ndarray):
    """mapInArrow: (v, pivots) -> (cluster, n, c0, c1, ...), one row a centroid and task."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            v, roots = _read(batch, dims)
            if len(v):
                cluster, _, _ = nearest(v, roots, centroids, centroid_roots)
                np.add.at(total, cluster, v)
                count += np.bincount(cluster, minlength=k)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.astype(np.int32)), pa.array(count[own]), *map(pa.array, total[own].T)],
            names=["cluster", "n", *(f"c{i}" for i in range(dims))])

    return run


def _assigned(centroids: np.ndarray, centroid_roots: np.ndarray):
    """mapInArrow: (vec_id, v, pivots) -> (vec_id, cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                v, roots = _read(batch, centroids.shape[1])
                cluster, distance, _ = nearest(v, roots, centroids, centroid_roots)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"])

    return run


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS,
            scale: int = SCALE, salt: str = SALT, many_pivots: int = PIVOTS,
            id_col: str = "vec_id", vector_col: str = "embedding") -> Clusters:
    """``rounds`` rounds of assignment and exact means, then one more assignment."""
    spark = prepare(vectors.sparkSession)
    stage = Stage(spark, "centroids")
    kept = vectors.where(_usable(vector_col, dims)).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"))
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(key.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    if not first:
        empty = spark.createDataFrame([], "vec_id long, cluster int, distance long")
        return Clusters(empty, [])
    now = _integers(np.array([r[0] for r in first], float), scale).astype(np.int64)
    at = pivots(now, many_pivots)
    table = stage.write(kept.mapInArrow(
        _tabled(at, scale), "vec_id long, v binary, pivots binary"), "pivots")
    sums = ", ".join(["cluster int", "n long", *(f"c{i} long" for i in range(dims))])
    for _ in range(rounds):
        new = now.copy()
        for row in table.select("v", "pivots").mapInArrow(_summed(now, _roots(now, at)), sums).groupBy(
                "cluster").agg(F.sum("n"), *(F.sum(f"c{i}") for i in range(dims))).collect():
            new[row[0]] = [total // row[1] for total in row[2:]]
        now = new
    assigned = stage.write(table.mapInArrow(
        _assigned(now, _roots(now, at)), "vec_id long, cluster int, distance long"), "assigned")
    stage.release(table)
    return Clusters(assigned, now.tolist())


def with_inertia(found: Clusters) -> DataFrame:
    """Every vector with its cluster's and the whole inertia and its centroid's digest."""
    inertia = dict(found.assigned.groupBy("cluster").agg(F.sum("distance")).collect())  # k rows
    whole = sum(inertia.values())
    per_cluster = found.assigned.sparkSession.createDataFrame(
        [(i, inertia.get(i, 0), whole, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
         for i, c in enumerate(found.centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
