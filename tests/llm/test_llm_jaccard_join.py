import random
import re
import time
from pathlib import Path

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import jaccard_join
from martlet.llm.common import CLEANUP, Stage
from martlet.llm.components import components
from martlet.llm.jaccard_join import Link, near_duplicates, projections, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(zip(found, found[1:], found[2:])) if len(found) >= 3 else frozenset([tuple(found)])


def brute(rows):
    sets = {r[0]: shingle_set(r[1]) for r in rows if r[0] is not None}
    least = {i: i for i in sets}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                i, j = find(a), find(b)
                least[max(i, j)] = min(i, j)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows):
    got = near_duplicates(cases.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r


def test_awkward_rows(spark):
    check(spark, cases.rows())


def test_a_copy_without_id_ahead_of_a_linked_pair(spark):
    base = [f"word{i}" for i in range(80)]
    near = " ".join([*base[:40], "other", *base[41:]])
    rows = [(i, t, "en", "s", 1, "", 0, "") for i, t in ((None, " ".join(base)), (7, " ".join(base)), (3, near))]
    got = near_duplicates(cases.frame(spark, rows).coalesce(1)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"]) == [(3, 3), (7, 3)]


def test_empty(spark):
    assert near_duplicates(cases.frame(spark, [])).collect() == []


@pytest.mark.parametrize("seed, small", [(1, 128), (2, 4)])
def test_clusters_of_edited_copies(spark, monkeypatch, seed, small):
    """Groups of copies with up to six edits each, of many lengths: links and near misses.
    Where few members count as a small region, pivots divide the others again and again."""
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    rng = random.Random(seed)
    texts = []
    for group, size in enumerate((12, 25, 60, 150, 400)):
        base = [f"w{group}x{rng.randrange(400)}" for _ in range(size)]
        for _ in range(34 if size == 60 else 9):
            copy = base[:]
            for _ in range(rng.randrange(7)):
                copy[rng.randrange(size)] = f"e{rng.randrange(10**6) if rng.random() < .7 else 7}"
            if rng.random() < 0.3:
                copy = copy[:size - rng.randrange(1 + size // 10)]
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    check(spark, [(i, t, "en", "s", 1, "", 0, "") for i, t in enumerate(texts)])


def test_linked_sets_share_a_projection():
    rng = random.Random(3)
    for n in (9, 10, 17, 40, 300):
        for _ in range(40):
            a = {rng.getrandbits(64) for _ in range(n)}
            drop = rng.randrange(1 + n // 9)
            b = set(list(a)[drop:])
            while len(a & b) * 10 >= 9 * len(a | b) and rng.random() < 0.7:
                b.add(rng.getrandbits(64))
            if 100 * len(a & b) < 90 * len(a | b):
                continue
            import numpy as np
            x, y = (projections(np.array(sorted(s), np.uint64)) for s in (a, b))
            assert len(a) < 9 or len(b) < 9 or set(x.tolist()) & set(y.tolist()) or a == b


def test_shingles_follow_the_word_pattern():
    assert len(shingles("A b\x0bC d")) == 2 and (shingles("a b c") == shingles("A\tB\r\nC")).all()
    assert len(shingles("\x0b ")) == 0 == len(shingles(None)) and len(shingles("one")) == 1
    assert (shingles("a b") != shingles("ab")).all()


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    path = list(range(60))
    names = list(range(1000, 1060))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in path[:-1]] + [(5, i) for i in range(6, 40)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(components(df, Stage(spark, "t")).collect())
    assert {got[n] for n in names} == {1000} and got[5] == got[39] == 5 and len(got) == 95
    assert components(df.limit(0), Stage(spark, "t")).collect() == []


@pytest.mark.parametrize("similarity", [0.5, 0.7, 0.8, 0.85, 0.95])
def test_linked_sets_share_a_projection_at_any_similarity(similarity):
    rng = random.Random(5)
    link, percent = Link.at(similarity), round(100 * similarity)
    for n in (1, 2, 3, 4, 5, 6, 7, 9, 17, 40, 300):
        for _ in range(60):
            a = {rng.getrandbits(64) for _ in range(n)}
            b = set(list(a)[rng.randrange(1 + n * (100 - percent) // 100):])
            for _ in range(rng.randrange(1 + n * (100 - percent) // percent)):
                b.add(rng.getrandbits(64))
            if 100 * len(a & b) < percent * len(a | b) or a == b:
                continue
            x, y = (projections(np.array(sorted(s), np.uint64), link) for s in (a, b))
            assert set(x.tolist()) & set(y.tolist())


def test_similarity_outside_its_range_is_an_error():
    for similarity in (0, 1, 1.5):
        with pytest.raises(ValueError):
            Link.at(similarity)


def test_parity_bits_differ_in_at_most_as_many_places_as_the_sets():
    rng = np.random.default_rng(3)
    for n, m, common in ((0, 5, 0), (1, 1, 1), (40, 300, 30), (500, 520, 480), (700, 30, 30), (5000, 5100, 10)):
        shared, a, b = (rng.integers(0, 1 << 63, k).astype(np.uint64) for k in (common, n - common, m - common))
        x, y = np.unique(np.append(shared, a)), np.unique(np.append(shared, b))
        apart = jaccard_join._apart(jaccard_join._parity(x), jaccard_join._parity(y))
        differ = len(np.setxor1d(x, y))
        assert apart <= differ and (apart - differ) % 2 == 0
        if common == 10:  # unlike sets are told
            assert apart * 19 > len(x) + len(y)


def test_sets_are_made_for_measured_documents_only(spark, monkeypatch):
    # pairs too far apart to link, of which many share a region all the same, and a few links
    rows = []
    for k in range(30):
        base = [f"w{k}x{i}" for i in range(100)]
        far = [f"{w}y" if i % 20 == 10 else w for i, w in enumerate(base)]
        near = [f"{w}z" if i == 50 else w for i, w in enumerate(base)]
        texts = [base, far, near] if k % 6 == 0 else [base, far]
        rows += [(10 * k + j, " ".join(t), "en", "s", 1, "", 0, "") for j, t in enumerate(texts)]
    seen, at_distances = {}, []
    write = Stage.write

    def written(self, df, what):
        if what == "distances" and not at_distances:
            at_distances.extend(t for t in self._keep if id(t) in self._paths)
        back = write(self, df, what)
        if what in ("regions", "measured", "sets"):
            ids = [c for c in ("x", "p") if c in df.columns]
            seen.setdefault(what, {v for r in back.select(*ids).collect() for v in r})
        return back

    monkeypatch.setattr(Stage, "write", written)
    check(spark, rows)
    assert seen["sets"] == seen["measured"] < seen["regions"]
    # nor do the region keys of all documents lie on disk while the sets are shipped
    assert at_distances and not [t.columns for t in at_distances if "regions" in t.columns]


def _rows_written(monkeypatch):
    """Rows of the staged tables by name, as they are written."""
    seen, write = {}, Stage.write

    def written(self, df, what):
        back = write(self, df, what)
        seen.setdefault(what, []).append(back.count())
        return back

    monkeypatch.setattr(Stage, "write", written)
    return seen


def test_a_shared_passage_ships_no_sets(spark, monkeypatch):
    # 200 texts share a passage, so regions, but none links with another
    passage = [f"p{i}" for i in range(100)]
    rows = [(k, " ".join([*passage, *(f"w{k}x{i}" for i in range(30))]), "en", "s", 1, "", 0, "")
            for k in range(200)]
    near = " ".join([*passage, *(f"w7x{i}" for i in range(29)), "other"])
    seen = _rows_written(monkeypatch)
    check(spark, [*rows, (200, near, "en", "s", 1, "", 0, "")])
    assert seen["regions"][0] > 200  # every text is in some
    assert sum(seen["sets"]) == 2 and "centres" not in seen  # whole sets of the linked pair only


@pytest.mark.parametrize("dense, sets", [(0, 128), (0, 3)])
def test_cells_with_many_near_misses(spark, monkeypatch, dense, sets):
    """Cells in which parity bits leave too many pairs: compared by whole sets, or divided."""
    monkeypatch.setattr(jaccard_join, "DENSE", dense)
    monkeypatch.setattr(jaccard_join, "SETS", sets)
    monkeypatch.setattr(jaccard_join, "SETTLE", (2, 2))
    rng, texts = random.Random(11), []
    for group, size in enumerate((40, 90)):
        base = [f"w{group}x{i}" for i in range(size)]
        for _ in range(30):
            copy = base[:]
            for i in rng.sample(range(size), rng.randrange(1 + size // 25)):
                copy[i] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    seen = _rows_written(monkeypatch)
    check(spark, [(i, t, "en", "s", 1, "", 0, "") for i, t in enumerate(texts)])
    assert ("centres" if sets == 3 else "whole") in seen


def test_one_width_makes_parity_bits_a_metric():
    rng = np.random.default_rng(8)
    universe = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    bits = [jaccard_join._parity(np.unique(rng.choice(universe, n, replace=False)))
            for n in (40, 70, 150, 300, 600)]
    for a in bits:
        for b in bits:
            for c in bits:
                ab, bc, ac = (jaccard_join._apart(x, y, 16) for x, y in ((a, b), (b, c), (a, c)))
                assert abs(ab - bc) <= ac <= ab + bc


def test_staged_tables_leave_no_shuffle_files(spark):
    def files():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f.name for d in dirs for f in Path(d.toString()).rglob("shuffle_*.data")}

    rows, before = spark.range(1000).withColumn("k", F.expr("id % 7")), spark.conf.get(CLEANUP, None)
    kept = rows.groupBy("k").count()
    assert kept.count() == 7
    there = files()
    back = Stage(spark, "test").write(rows.repartition(3, "k").groupBy("id").count(), "counts")
    until = time.time() + 20
    while files() - there and time.time() < until:
        time.sleep(0.2)
    assert not files() - there
    assert (back.count(), kept.count(), spark.conf.get(CLEANUP, None)) == (1000, 7, before)
