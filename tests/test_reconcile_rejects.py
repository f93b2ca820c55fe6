import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.sources.ingest import ingest_csv, read_rejects
from martlet.sources.reconcile import ROWS, differences, digest


def unequal(a, b):
    return {name for name, _, _, same in differences(digest(a), digest(b)) if not same}


def test_digests_are_of_multisets(spark):
    rows = [(i, f"v{i % 7}", None if i % 5 == 0 else i / 3) for i in range(500)]
    schema = "k long, v string, x double"
    a = spark.createDataFrame(rows, schema)
    assert unequal(a, a.repartition(7).orderBy(F.desc("v"))) == set()
    changed = [*rows[:100], (100, "other", rows[100][2]), *rows[101:]]
    assert unequal(a, spark.createDataFrame(changed, schema)) == {ROWS, "v"}
    swapped = [(1, "v2", rows[1][2]), *rows[2:], rows[0]]
    swapped[1] = (2, "v1", rows[2][2])
    assert unequal(a, spark.createDataFrame(swapped, schema)) == {ROWS}
    # a value that occurs twice, twice another: the xor cannot tell
    assert unequal(spark.createDataFrame([(1,), (1,), (3,)], "k long"),
                   spark.createDataFrame([(2,), (2,), (3,)], "k long")) == {ROWS, "k"}
    assert unequal(spark.createDataFrame([(None,), (1,)], "k long"),
                   spark.createDataFrame([(1,), (1,)], "k long")) == {ROWS, "k"}
    assert unequal(a.limit(0), a.limit(0)) == set() and ROWS in unequal(a, a.limit(0))
    assert unequal(a, a.drop("x")) == {ROWS, "x"}


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_load_reconciles_content(spark, tmp_dir):
    path = write(tmp_dir, "a.csv", "id,text\n1,x\n2,\n2,\n")
    res = ingest_csv(spark, path, f"{tmp_dir}/out", content=True)
    assert res.match and res.source_content == res.target_content and set(res.source_content) == {ROWS, "id", "text"}
    spark.createDataFrame([(1, "x"), (2, None), (3, None)], "id long, text string").write.mode(
        "overwrite").parquet(res.path)
    assert differences(res.source_content, digest(spark.read.parquet(res.path))) == [
        (ROWS, 3, 3, False), ("id", 3, 3, False), ("text", 3, 3, True)]


def test_rejects_are_kept_with_place_and_reason(spark, tmp_dir):
    text = 'id,note,n\n1,"a\nb",3\n2,x,4,"extra\nline",5\n3,short\n4,y,many\n5,z,NULL\n6,"say ""w""",7,8\n'
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()),
                           T.StructField("n", T.LongType())])
    path = write(tmp_dir, "r.csv", text)
    res = ingest_csv(spark, path, f"{tmp_dir}/out", schema=schema, rejects_dir=f"{tmp_dir}/rejects", content=True)
    assert sorted(map(tuple, spark.read.parquet(res.path).collect())) == [
        (1, "a\nb", 3), (3, "short", None), (5, "z", None)]
    assert (res.source_rows, res.target_rows, res.dropped_rows, res.match) == (3, 3, 3, True)
    got = read_rejects(spark, res.rejects).collect()
    assert [(r["reason"], r["record"]) for r in got] == [
        ("too many fields", '2,x,4,"extra\nline",5'), ("not a value of the column's type: n", "4,y,many"),
        ("too many fields", '6,"say ""w""",7,8')]
    assert all(r["file"].endswith("r.csv") and r["split_start"] == 0 and r["split_length"] == os.path.getsize(path)
               for r in got)
    # inferred types: only records that cannot be read are rejected
    loose = ingest_csv(spark, path, f"{tmp_dir}/out", table="loose", rejects_dir=f"{tmp_dir}/rejects")
    assert loose.dropped_rows == 2 and spark.read.parquet(loose.path).count() == 4
    assert read_rejects(spark, res.rejects, loose.rejects).count() == 5


def test_clean_and_empty_files_have_no_rejects(spark, tmp_dir):
    clean = ingest_csv(spark, write(tmp_dir, "c.csv", "id\n1\n"), f"{tmp_dir}/out", rejects_dir=f"{tmp_dir}/rejects")
    assert clean.match and read_rejects(spark, clean.rejects).collect() == []
    bad = ingest_csv(spark, write(tmp_dir, "c.csv", "id\n1,2\n"), f"{tmp_dir}/out", rejects_dir=f"{tmp_dir}/rejects")
    assert not bad.written and bad.dropped_rows == 1 and read_rejects(spark, bad.rejects).count() == 1
    assert spark.read.parquet(clean.path).count() == 1  # nothing to load: the table stays
