import os

import pytest
from pyspark.sql import types as T

from martlet.sources import csv as mcsv
from martlet.sources.ingest import (
    csv_file_name,
    ingest_csv,
    staging_name_for_file,
    staging_name_for_table,
)
from martlet.sources.jdbc import JdbcSource, as_text_columns
from martlet.sources.sinks import reconcile, write_table


def _write(tmp_dir, name, data: bytes):
    path = os.path.join(tmp_dir, name)
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_bom_header_names_and_types(spark, tmp_dir):
    path = _write(tmp_dir, "t.csv", "﻿Product Name,seller-zip,Price,flag,Count\n"
                  "a,1001,1.5,True,3\nb,,2,False,4\n".encode("utf-8"))
    r = mcsv.read_csv(spark, path)
    assert r.df.columns == ["product_name", "seller_zip", "price", "flag", "count"]
    types = {f.name: f.dataType for f in r.df.schema.fields}
    assert types == {"product_name": T.StringType(), "seller_zip": T.DoubleType(),
                     "price": T.DoubleType(), "flag": T.BooleanType(), "count": T.LongType()}
    assert [tuple(x) for x in r.df.orderBy("product_name").collect()] == [
        ("a", 1001.0, 1.5, True, 3), ("b", None, 2.0, False, 4)]


def test_quoted_file_newline_doubled_quote_and_null_tokens(spark, tmp_dir):
    data = ('"id","text","v"\n"1","line one\nline two","x"\n"2","say ""hi""","NULL"\n'
            '"3","","null"\n"4","NaN","y"\n').encode()
    r = mcsv.read_csv(spark, _write(tmp_dir, "q.csv", data))
    rows = {x.id: (x.text, x.v) for x in r.df.collect()}
    assert rows == {1: ("line one\nline two", "x"), 2: ('say "hi"', None), 3: (None, None),
                    4: (None, "y")}


def test_short_row_kept_long_row_dropped(spark, tmp_dir):
    data = b"a,b,c\n1,2,3\n4,5\n6,7,8,9\n"
    r = mcsv.read_csv(spark, _write(tmp_dir, "s.csv", data))
    assert sorted(tuple(x) for x in r.df.collect()) == [(1, 2.0, 3.0), (4, 5.0, None)]
    assert r.dropped_rows.first().dropped_rows == 1


def test_latin1_fallback(spark, tmp_dir):
    data = "city,n\nSão Paulo,1\nMaceió,2\n".encode("latin-1")
    r = mcsv.read_csv(spark, _write(tmp_dir, "l.csv", data))
    assert r.encoding == "ISO-8859-1"
    assert sorted(x.city for x in r.df.collect()) == ["Maceió", "São Paulo"]
    utf = mcsv.read_csv(spark, _write(tmp_dir, "u.csv", "city\nSão Paulo\n".encode()))
    assert utf.encoding == "UTF-8" and utf.df.first().city == "São Paulo"


def test_declared_schema(spark, tmp_dir):
    path = _write(tmp_dir, "d.csv", b"seller_id,seller_zip_code_prefix\ns1,01001\n")
    schema = T.StructType([T.StructField("seller_id", T.StringType()),
                           T.StructField("seller_zip_code_prefix", T.LongType())])
    assert tuple(mcsv.read_csv(spark, path, schema=schema).df.first()) == ("s1", 1001)


def test_ingest_job_and_empty_guard(spark, tmp_dir):
    out = os.path.join(tmp_dir, "staging")
    src = _write(tmp_dir, csv_file_name("sellers"), b"seller_id,seller_city\ns1,x\ns2,y\n")
    res = ingest_csv(spark, src, out)
    assert (res.table, res.written, res.source_rows, res.target_rows, res.match) == (
        "stg_sellers", True, 2, 2, True)
    empty = _write(tmp_dir, "empty_" + csv_file_name("sellers"), b"seller_id,seller_city\n")
    res2 = ingest_csv(spark, empty, out, table="stg_sellers")
    assert res2.written is False
    assert spark.read.parquet(res.path).count() == 2  # the old table survives


def test_names():
    assert staging_name_for_file(csv_file_name("order_items")) == "stg_order_items"
    assert staging_name_for_file("product_category_name_translation.csv") == \
        "stg_product_category_name_translation"
    assert staging_name_for_table("orders") == "stg_orders"
    assert mcsv.clean_column_name("Order Item-Id") == "order_item_id"


def test_write_table_skip_empty_and_reconcile(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(5)
    assert write_table(df, path)
    assert not write_table(spark.range(0), path)
    stored = spark.read.parquet(path)
    rec = reconcile(spark, {"t": (df, stored)}).first()
    assert (rec.source_rows, rec.target_rows, rec.match) == (5, 5, True)


def test_jdbc_options_and_text_staging(spark):
    src = JdbcSource("jdbc:postgresql://db/x", "orders", {"user": "u"}, "id", 0, 100, 4)
    o = src.options()
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4" and o["user"] == "u"
    with pytest.raises(ValueError):
        JdbcSource("u", "t", partition_column="id").options()
    df = spark.createDataFrame([(1, 2.5, None)], "ID int, Price double, note string")
    out = as_text_columns(df)
    assert out.columns == ["id", "price", "note"]
    assert all(isinstance(f.dataType, T.StringType) for f in out.schema.fields)
    assert tuple(out.first()) == ("1", "2.5", None)


def test_ingest_all_csv_sources(spark, tmp_dir):
    from martlet.plans.store import stored_staging
    from martlet.sources.ingest import CSV_TABLES, csv_file_name, ingest_all
    from tests.conftest import SF_SMALL

    staged = stored_staging(spark, SF_SMALL).as_tables()
    src = os.path.join(tmp_dir, "source")
    for t in CSV_TABLES:
        staged["stg_" + t].write.option("header", True).option("quoteAll", True).option("escape", '"').csv(
            os.path.join(src, csv_file_name(t)))
    results = ingest_all(spark, os.path.join(tmp_dir, "staging"), csv_dir=src)
    assert sorted(r.table for r in results) == sorted("stg_" + t for t in CSV_TABLES)
    for r in results:
        assert r.match and r.dropped_rows == 0
        assert r.target_rows == staged[r.table].count()
    sellers = spark.read.parquet(os.path.join(tmp_dir, "staging", "stg_sellers"))
    # inferred types: the numeric-looking ids become BIGINT, as a CSV type inference would
    assert dict(sellers.dtypes)["seller_zip_code_prefix"] == "bigint"


def test_single_line_mode_splits_and_reads_the_same(spark, tmp_dir):
    lines = ["id,name"] + [f"{i},n{i}" for i in range(2000)]
    path = _write(tmp_dir, "big.csv", ("\n".join(lines) + "\n").encode())
    a = mcsv.read_csv(spark, path).df
    b = mcsv.read_csv(spark, path, multi_line=False).df
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_odd_numbers_stay_text(spark, tmp_dir):
    data = b"gate,big,huge,sci,seat\n12F,12345678901234567890,1,1e3,1.\n7D,2,99999999999999999999.5,.5,-2\n"
    r = mcsv.read_csv(spark, _write(tmp_dir, "n.csv", data))
    types = {f.name: f.dataType for f in r.df.schema.fields}
    assert types["gate"] == T.StringType() and types["big"] == T.StringType()
    assert types["huge"] == types["sci"] == types["seat"] == T.DoubleType()
    assert [tuple(x)[:2] for x in r.df.orderBy("gate").collect()] == [
        ("12F", "12345678901234567890"), ("7D", "2")]


def test_a_legal_replacement_character_is_no_bad_byte(spark, tmp_dir):
    r = mcsv.read_csv(spark, _write(tmp_dir, "r.csv", "city,n\n\u00e9t\u00e9 \ufffd,1\n".encode()))
    assert r.encoding == "UTF-8" and r.df.first().city == "\u00e9t\u00e9 \ufffd"


def test_backslashes_and_quotes_survive(spark, tmp_dir):
    df = spark.createDataFrame([(1, 'a "b" \\c'), (2, "x\\"), (3, "two\nlines, \\n")], "id long, t string")
    path = os.path.join(tmp_dir, "q.csv")
    df.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    assert {tuple(x) for x in mcsv.read_csv(spark, path).df.collect()} == {tuple(x) for x in df.collect()}


def test_counts_come_from_the_write(spark, tmp_dir):
    src = _write(tmp_dir, "c.csv", b"a,b\n1,2\n3,4,5\n6,7\n")
    res = ingest_csv(spark, src, os.path.join(tmp_dir, "st"), table="stg_c")
    assert (res.source_rows, res.dropped_rows, res.target_rows, res.match) == (2, 1, 2, True)


def test_parallel_relational_load_reaches_the_source(monkeypatch, spark, tmp_dir):
    from martlet.sources import ingest
    seen = {}
    monkeypatch.setattr(ingest, "ingest_jdbc", lambda s, src, out: seen.setdefault(src.table, src.options()))
    part = dict([ingest.parse_partitions("orders:order_id:0:1000:8")])
    ingest.ingest_all(spark, tmp_dir, jdbc_url="jdbc:x", jdbc_partitions=part)
    assert seen["orders"]["numPartitions"] == "8" and "numPartitions" not in seen["customers"]
    with pytest.raises(ValueError):
        ingest.parse_partitions("nothing:a:0:1:2")
