import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.sources.evolving import EXACT, Change, EvolvingTable, Load, join_types, merged

LONG, DOUBLE, TEXT, BOOL, NONE = (
    T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.NullType())


def rows(table, *columns, **options):
    return sorted((tuple(r) for r in table.read(**options).select(*columns).collect()), key=str)


def test_types_form_a_lattice():
    every = [LONG, DOUBLE, TEXT, BOOL, NONE, T.DateType()]
    for a in every:
        assert join_types(a, a) == a and join_types(a, TEXT) == TEXT and join_types(NONE, a) == a
        for b in every:
            assert join_types(a, b) == join_types(b, a)
            for c in every:
                assert join_types(join_types(a, b), c) == join_types(a, join_types(b, c))
    assert join_types(LONG, DOUBLE) == DOUBLE and join_types(LONG, BOOL) == TEXT
    assert join_types(LONG, DOUBLE, exact=False) == TEXT
    assert join_types(T.IntegerType(), T.FloatType()) == DOUBLE


def test_the_order_of_loads_decides_no_type():
    one = Load(T.StructType().add("x", LONG), inexact=("x",))
    two = Load(T.StructType().add("X", DOUBLE))
    assert merged([one, two])["x"].dataType == merged([two, one])["X"].dataType == TEXT
    assert merged([Load(one.schema), two])["x"].dataType == DOUBLE


def test_columns_come_go_move_and_widen(spark, tmp_dir):
    t = EvolvingTable(spark, f"{tmp_dir}/t")
    assert t.read().columns == [] and t.read().count() == 0
    first = t.append(spark.createDataFrame([(1, "a", 10), (2, None, None)], "k long, s string, x long"))
    assert [c.kind for c in first] == ["added"] * 3
    second = t.append(spark.createDataFrame([(0.5, 3, True)], "x double, K long, extra boolean"))
    assert second == [
        Change("s", "missing", "string", "string"), Change("x", "widened", "bigint", "double"),
        Change("extra", "added", None, "boolean"), Change("x", "reordered", "1", "0"),
        Change("k", "reordered", "0", "1")]
    assert t.read().columns == ["k", "s", "x", "extra"]
    assert rows(t, "k", "s", "x", "extra") == [
        (1, "a", 10.0, None), (2, None, None, None), (3, None, 0.5, True)]
    assert rows(t, "k", "load", load_as="load") == [(1, 0), (2, 0), (3, 1)]
    t.append(spark.createDataFrame([("7b", "12")], "k string, x string"))
    # values are cast from what they arrived as
    assert rows(t, "k", "x") == [("1", "10"), ("2", None), ("3", "0.5"), ("7b", "12")]
    assert rows(t, "k", version=1) == [(1,), (2,)] and t.schema(2)["x"].dataType == DOUBLE


def test_longs_that_no_double_holds_become_text(spark, tmp_dir):
    t = EvolvingTable(spark, f"{tmp_dir}/t")
    t.append(spark.createDataFrame([(EXACT + 1,), (-5,), (None,)], "x long"))
    t.append(spark.createDataFrame([(1.5,), (float("nan"),)], "x double"))
    assert {r[0] for r in rows(t, "x")} == {"-5", "1.5", str(EXACT + 1), None, "NaN"}
    u = EvolvingTable(spark, f"{tmp_dir}/u")
    u.append(spark.createDataFrame([(EXACT,)], "x long"))
    u.append(spark.createDataFrame([(1.5,)], "x double"))
    assert rows(u, "x") == [(1.5,), (float(EXACT),)]
    u.append(spark.createDataFrame([(-EXACT - 1,)], "x long"))  # found out later
    assert {r[0] for r in rows(u, "x")} == {str(EXACT), "1.5", str(-EXACT - 1)}


def test_empty_loads_unknown_types_and_clashing_names(spark, tmp_dir):
    t = EvolvingTable(spark, f"{tmp_dir}/t")
    t.append(spark.createDataFrame([], "k long, a string"))
    assert t.read().columns == ["k", "a"] and t.read().count() == 0
    t.append(spark.range(2).select(F.col("id").alias("k"), F.lit(None).alias("b")))
    assert rows(t, "k", "a", "b") == [(0, None, None), (1, None, None)]
    t.append(spark.createDataFrame([(5, True)], "k long, b boolean"))
    assert rows(t, "k", "b") == [(0, None), (1, None), (5, True)]
    with pytest.raises(ValueError, match="case only: k"):
        t.append(spark.createDataFrame([(1, 2)], ["k", "b"]).toDF("k", "K"))
    assert t.tables.versions() == [1, 2, 3]
    # a load of the same rows again is kept, and an earlier version can be the newest
    t.append(spark.createDataFrame([(5, True)], "k long, b boolean"))
    assert t.read().count() == 4
    t.tables.rollback(3)
    assert t.read().count() == 3


def test_nothing_is_rewritten_and_scans_are_pruned(spark, tmp_dir):
    t = EvolvingTable(spark, f"{tmp_dir}/t")
    for x in (1, 2, 2.5, 3):
        t.append(spark.createDataFrame([(x, "s")], ["x", "s"]))
    first, last = t.tables.manifest(1), t.tables.manifest()
    assert first.tables["rows"].parts.items() <= last.tables["rows"].parts.items()
    plan = t.read().select("x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # longs and doubles
    assert "s:string" not in plan.replace(" ", "")
