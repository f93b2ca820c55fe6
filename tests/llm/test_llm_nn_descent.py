import numpy as np

from martlet.llm import nn_descent


def run(spark, rows, k=20, queries=None):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    index = nn_descent.build(table)
    asked = table.where("vec_id % 20 = 0") if queries is None else table.where(queries)
    return nn_descent.search(index, asked, k).collect()


def brute(rows, k=20):
    good = {i: np.asarray(v, np.float32).astype(float) for i, v, _ in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    return good, {q: sorted(((-float(good[q] @ good[i]), i) for i in good if i != q))[:k]
                  for q in good if q % 20 == 0}


def recall(spark, rows):
    good, want = brute(rows)
    got = run(spark, rows)
    found = {}
    for r in got:
        assert abs(r["score"] - good[r["query_id"]] @ good[r["vec_id"]]) < 1e-9
        found.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    hits = total = 0
    for q, near in want.items():
        own = sorted(found.get(q, []))
        assert [x[0] for x in own] == list(range(1, len(near) + 1))
        assert [x[1:] for x in own] == sorted(x[1:] for x in own)
        hits += len({x[2] for x in own} & {i for _, i in near})
        total += len(near)
    return hits / max(1, total)


def test_recall_on_clusters_and_noise(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((6, 24))
    x = [centres[i % 6] * (i % 3) + rng.standard_normal(24) for i in range(5000)]
    assert recall(spark, [(i, v.tolist(), "s") for i, v in enumerate(x)]) >= 0.95


def test_copies_invalid_vectors_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(8) * (1 + i % 4)).tolist(), "s") for i in range(300)]
    rows += [(i, [1.0] * 8, "s") for i in range(300, 460)]  # one vector, a third of all
    rows += [(460, None, "s"), (480, [0.0] * 8, "s"), (500, [1.0, None] + [0.0] * 6, "s"),
             (520, [float("nan")] * 8, "s"), (540, [float("inf")] * 8, "s"), (560, [1.0], "s"), (None, [2.0] * 8, "s"),
             rows[20]]
    good, _ = brute([r for r in rows if r[0] != 560])
    assert recall(spark, [r for r in rows if r[0] != 560]) == 1.0
    got = run(spark, rows)
    assert {r["query_id"] for r in got} == {q for q in good if q % 20 == 0}


def test_few_candidates(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0, 2.0], "s")]) == []
    got = run(spark, [(0, [1.0, 0.0], "s"), (1, [1.0, 0.0], "s"), (2, [0.5, 0.0], "s")])
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 1.0), (2, 2, 0.5)]


def test_an_id_with_several_vectors_is_the_least_one(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(6).tolist(), "s") for i in range(41)]
    twice = [(i, rng.standard_normal(6).tolist(), "s") for i in (0, 3, 20, 3, 40)]
    least = {}
    for i, v, s in rows + twice:
        v = np.asarray(v, np.float32).tolist()
        least[i] = min(least.get(i, v), v)
    for given in (rows + twice, twice + rows + rows):
        got = run(spark, given)
        _, want = brute([(i, v, "s") for i, v in least.items()])
        assert len(got) == sum(map(len, want.values()))
        for q, near in want.items():
            own = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
            assert [i for _, i in own] == [i for _, i in near]
