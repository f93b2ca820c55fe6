"""Changed rows are sought where two sides differ only."""

from pyspark.sql import functions as F

from martlet.plans.star_versions import _differing, changed_rows


def test_equal_tables_send_no_row_to_the_comparison(spark):
    rows = spark.createDataFrame([(i, None if i % 3 else "x") for i in range(500)], "k long, v string")
    both = rows.withColumn("_n", F.lit(-1)).unionByName(rows.orderBy(F.desc("k")).withColumn("_n", F.lit(1)))
    assert _differing(both, ["k", "v"]).count() == 0
    assert changed_rows(rows, rows).count() == 0
    schema = "a string, b string"
    moved = changed_rows(spark.createDataFrame([("x", None), ("y", "z"), ("y", "z")], schema),
                         spark.createDataFrame([(None, "x"), ("y", "z")], schema))
    assert sorted(map(str, moved.collect())) == sorted(map(str, spark.createDataFrame(
        [("x", None), (None, "x"), ("y", "z")], schema).collect()))
