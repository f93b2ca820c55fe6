import math

import pytest
from pyspark.sql import functions as F

from martlet.operators import retention, sketches


def facts(spark, rows):
    return spark.createDataFrame([(f"o{i}", c, k) for i, (c, k) in enumerate(rows)],
                                 "order_id string, customer_id string, purchase_date_id long")


def key(month, day=1):
    return month * 1_000_000 + day * 10_000 + 1234


LIVES = {"a": [202301, 202302, 202312], "b": [202301], "c": [202303, 202303], "d": [202311], "e": [202401]}


def orders(spark):
    return facts(spark, [(c, key(m, i + 1)) for c, ms in LIVES.items() for i, m in enumerate(ms)]
                 + [(None, key(202305)), ("f", None)])


def test_grid_has_every_cell(spark):
    got = {(r["cohort_month"], r["months_since"]): (r["size"], r["customers"], r["rate"])
           for r in retention.retention_grid(orders(spark)).collect()}
    assert len(got) == 13 * 14 // 2  # 13 months, each up to the last
    assert got[202301, 0] == (2, 2, 1.0) and got[202301, 1] == (2, 1, 0.5) and got[202301, 11] == (2, 1, 0.5)
    assert got[202301, 5] == (2, 0, 0.0) and got[202302, 0] == (0, 0, None) and got[202303, 9] == (1, 0, 0.0)
    assert got[202401, 0] == (1, 1, 1.0) and (202401, 1) not in got and got[202312, 1] == (0, 0, None)


def test_survival_by_hand(spark):
    def m(x):
        return x // 100 * 12 + x % 100
    end, alive, lives = m(202401), retention.PARTS, []
    for ms in LIVES.values():
        lives.append((m(max(ms)) - m(min(ms)), end - m(max(ms)) >= retention.INACTIVE))
    expected = []
    for t in range(max(x for x, _ in lives) + 1):
        risk = sum(x >= t for x, _ in lives)
        d = sum(x == t and gone for x, gone in lives)
        alive = alive * (risk - d) // max(risk, 1)
        expected.append((t, risk, d, sum(x == t and not gone for x, gone in lives), alive))
    got = retention.retention_survival(orders(spark)).orderBy("months_since").collect()
    assert list(map(tuple, got)) == expected and expected[0][2] == 2 and expected[-1][4] < retention.PARTS


def test_no_orders(spark):
    none = facts(spark, [("x", None)])
    assert retention.retention_grid(none).collect() == [] and retention.retention_survival(none).collect() == []


def test_estimates_need_only_the_sketches(spark):
    rows = facts(spark, [(f"c{i % 3000}", key(202301 + i % 12)) for i in range(20000)])
    parts = sketches.month_sketches(rows)
    found = {r["window"]: r for r in sketches.distinct_estimates(parts).collect()}
    exact = {r["window"]: r for r in sketches.distinct_exact(rows).collect()}
    assert set(found) == set(exact) and len(exact) == 12 + 4 + 1 + 1
    for window, r in exact.items():
        assert found[window]["rows"] == r["rows"]
        for c in ("customers", "orders"):
            assert abs(found[window][c] - r[c]) <= 0.02 * r[c]


def test_drift_index(spark):
    base = spark.createDataFrame([(float(i % 1000), float(i % 3), None if i % 4 else 1.0) for i in range(20000)],
                                 "x double, few double, gaps double")
    columns = base.columns

    def statuses(other):
        return {r["column"]: (r["status"], r["stability_index"]) for r in sketches.drift(
            sketches.profile(base, columns), sketches.profile(other, columns)).collect()}
    same = statuses(base.repartition(7))
    assert all(s == "pass" and i < 0.01 for s, i in same.values())
    moved = statuses(base.selectExpr("x + 300 AS x", "IF(few = 2, 0, few) AS few", "coalesce(gaps, 1) AS gaps"))
    assert {c for c, (s, _) in moved.items() if s == "fail"} == {"x", "few", "gaps"}
    # by hand: the lowest three deciles are empty, the highest holds four
    tenth, least = 0.1, sketches.LEAST_SHARE
    by_hand = 3 * (tenth - least) * math.log(tenth / least) + 0.3 * math.log(4)
    assert moved["x"][1] == pytest.approx(by_hand, rel=0.1)
    halves = [sketches.profile(base.where(w), columns) for w in ("x < 200", "x >= 200")]
    merged = {r["column"]: r["status"] for r in sketches.drift(
        sketches.profile(base, columns), sketches.merged_profiles(halves[0].unionByName(halves[1]))).collect()}
    assert merged == dict.fromkeys(columns, "pass")
    empty = statuses(base.limit(0))
    assert empty["x"][0] == "fail" and statuses(base.select(
        F.lit(None).cast("double").alias("x"), "few", "gaps"))["x"][0] == "fail"
