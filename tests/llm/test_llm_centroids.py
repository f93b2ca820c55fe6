import hashlib
import math

import numpy as np
import pytest

from martlet.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance int"


def rows(n=300, dims=6, seed=3, spread=1.0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(8, dims)) * spread
    x = (middle[rng.integers(0, 8, n)] + rng.normal(size=(n, dims)) / 4).astype(np.float32)
    out = [(i, [float(v) for v in r], 1, "x", 2) for i, r in enumerate(x)]
    hot = [float(v) for v in x[0]]
    out += [(1000 + i, hot, None, None, None) for i in range(100)] + [out[5], (None, hot, 1, "", 0)]
    bad = [None, [], hot[:-1], [None, *hot[1:]], [math.nan, *hot[1:]], [math.inf, *hot[1:]]]
    return out + [(2000 + i, b, 1, "", 0) for i, b in enumerate(bad)]


def brute(data, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v], v) for i, v, *_ in data
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[2]))
    now = [r[1] for r in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(now))

    for _ in range(rounds):
        groups = [[] for _ in now]
        for _, v, _ in kept:
            groups[nearest(v)[1]].append(v)
        now = [[sum(c) // len(g) for c in zip(*g)] if g else old for g, old in zip(groups, now)]
    found = [(i, *nearest(v)[::-1]) for i, v, _ in kept]
    whole = sum(f[2] for f in found)
    each = {j: sum(f[2] for f in found if f[1] == j) for j in range(len(now))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(((i, j, d, each[j], whole, sha[j]) for i, j, d in found), key=str)


@pytest.mark.parametrize("k, many_pivots, spread", [(12, 4, 1.0), (12, 1, 0.0), (500, 3, 2.0)])
def test_equals_brute_force(spark, k, many_pivots, spread):
    data = rows(spread=spread)
    found = centroids.with_inertia(centroids.cluster(
        spark.createDataFrame(data, SCHEMA).repartition(3), k=k, rounds=3, dims=6, many_pivots=many_pivots))
    assert sorted(map(tuple, found.collect()), key=str) == brute(data, k, 3, 6)


def test_bounds_leave_out_only_what_cannot_be_nearest():
    rng = np.random.default_rng(1)
    v = rng.integers(-400, 400, (2000, 64)) // 60 * 20
    c = np.concatenate([v[:30], v[:5], rng.integers(-400, 400, (10, 64))])
    at = centroids.pivots(c[:30], 16)
    cluster, distance, _ = centroids.nearest(v, centroids._roots(v, at), c, centroids._roots(c, at))
    exact = ((v[:, None, :] - c[None]) ** 2).sum(2)
    assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    near = np.repeat(c[:20], 50, axis=0) + rng.integers(-2, 3, (1000, 64))
    many = centroids.nearest(near, centroids._roots(near, at), c, centroids._roots(c, at))[2]
    assert many < len(near) * len(c) / 4  # most centroids get no exact distance


def test_empty_and_too_large(spark):
    def run(data):
        return centroids.with_inertia(centroids.cluster(spark.createDataFrame(data, SCHEMA), dims=2)).collect()
    assert run([]) == [] and run([(1, None, 1, "", 0), (2, [1.0], 1, "", 0)]) == []
    with pytest.raises(Exception, match="beyond"):
        run([(1, [1e30, 0.0], 1, "", 0)])
