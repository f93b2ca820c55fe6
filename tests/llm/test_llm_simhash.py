import re
import tempfile
from itertools import product

import cases
import numpy as np
import pytest
import xxhash

from martlet.llm import simhash
from martlet.llm.common import Stage


def literal(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, distance):
    """Least member of each fingerprint's class, by comparing all pairs."""
    name = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a, b in product(prints, prints):
            if bin(a ^ b).count("1") <= distance and name[a] != name[b]:
                name[a] = name[b] = min(name[a], name[b])
                changed = True
    return name


def test_fingerprints():
    for text in cases.texts():
        assert simhash.fingerprint(text) == literal(text)


def test_equals_brute_force(spark):
    data = cases.rows()
    base = cases.words(cases.EN, 400, 7).split()
    for i in range(40):
        copy = base[:]
        copy[10 * i] = f"word{i}"
        data.append((500 + i, " ".join(copy), "en", "s", 1, "", 0, ""))
    data.append((1, None, None, None, None, None, None, None))
    data.append((None, " ".join(base), None, None, None, None, None, None))
    found = {}
    for r in simhash.near_duplicates(cases.frame(spark, data).repartition(3)).collect():
        found.setdefault((r["doc_id"], r["fingerprint"]), r["component_id"])
    prints = [literal(r[1]) for r in data]
    name = classes(sorted(set(prints)), 2)
    least = {}
    for r, p in zip(data, prints):
        if r[0] is not None:
            least[name[p]] = min(r[0], least.get(name[p], r[0]))
    assert found == {(r[0], f"{p:016x}"): least.get(name[p]) for r, p in zip(data, prints)}


def test_empty(spark):
    assert simhash.near_duplicates(cases.frame(spark, [])).collect() == []
    one = simhash.near_duplicates(cases.frame(spark, [(None, None, *[None] * 6)])).collect()
    assert [tuple(r) for r in one] == [(None, "0" * 16, None)]


@pytest.mark.parametrize("distance, crowded, n", [(2, 1024, 300), (2, 3, 300), (3, 4, 200), (1, 2, 200), (4, 1024, 200)])
def test_links_of_skewed_fingerprints(spark, distance, crowded, n):
    """Correlated bits, a dense ball around one value, and crowded keys."""
    rng = np.random.default_rng(distance * 100 + crowded)
    loose = rng.integers(0, 2**64, n, dtype=np.uint64)
    loose[n // 2:] &= np.uint64(0xFFFF0000FFFF)
    loose[n // 2:] |= (loose[n // 2:] & np.uint64(0xFFFF)) << np.uint64(48)
    ball = [int(loose[0])]
    for _ in range(150):
        ball.append(int(rng.choice(np.array(ball, np.uint64))) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    prints = sorted({int(x) for x in loose} | set(ball))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    stage = Stage(spark, "test")
    frame = stage.write(spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "f long, first long"), "f")
    edges = simhash.links(frame, stage, distance, crowded).collect()
    masked = {(a % 2**64, b % 2**64) for a, b in edges}
    assert all(bin(a ^ b).count("1") <= distance for a, b in masked)
    name = {p: p for p in prints}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x
    for a, b in masked:
        a, b = sorted((find(a), find(b)))
        name[b] = a
    assert {p: find(p) for p in prints} == classes(prints, distance)


def test_thresholds_cover(spark):
    """Every fingerprint's thresholds add up to distance - partitions + 1."""
    rng = np.random.default_rng(0)
    f = rng.integers(0, 2**64, 500, dtype=np.uint64)
    for many in (2, 3, 4):
        layout = simhash.Layout(list(np.array_split(np.arange(64), many)))
        tables = []
        for _, sub in layout.subs:
            share = np.bincount(simhash._value(f, sub).astype(int), minlength=1 << len(sub)) / 500
            tables.append(simhash._at_distance(share, len(sub), 2))
            assert abs(tables[-1][0].sum() - 1) < 1e-9
        estimates = simhash.Estimates(layout, tables, 10**9, 2)
        t = estimates.thresholds(f)
        assert (t.sum(axis=1) == 3 - many).all() and t.min() >= -1
        costs = np.stack([estimates.costs(f, i) for i in range(many)])
        least = min((sum(costs[i, 0, c] for i, c in enumerate(x)), x) for x in product(range(4), repeat=many) if sum(x) == 3)
        assert abs(sum(costs[i, 0, t[0, i] + 1] for i in range(many)) - least[0]) < 1e-6
