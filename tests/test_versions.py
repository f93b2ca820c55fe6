import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from martlet.plans.mart import MART_TABLES, Mart
from martlet.plans.star_versions import StarVersions, changed_rows, staging_changes
from martlet.plans.store import stored_staging
from martlet.plans.warehouse import _before
from martlet.sources.versioned import Conflict, VersionedTables
from martlet.streaming.upsert import UpsertTable, incremental_upsert
from tests.conftest import SF_SMALL


def frame(spark, rows, schema="k long, v string"):
    return spark.createDataFrame(rows, schema)


def read(tables, manifest, name="t"):
    return sorted(map(tuple, tables.read(manifest, name).collect()), key=str)


def test_versions_switch_as_one(spark, tmp_dir):
    tables = VersionedTables(spark, tmp_dir)
    assert tables.versions() == [] and tables.manifest().tables == {}
    part = F.pmod("k", F.lit(2)).cast("string")
    first = tables.commit(tables.manifest(), {
        "t": tables.write("t", frame(spark, [(1, "a"), (2, "b")]), part),
        "u": tables.write("u", frame(spark, [(7, "x")]))})
    # a writer that fails after one of its two tables leaves readers with the first version
    half = tables.write("t", frame(spark, [(9, "z")]), part)
    assert tables.manifest() == first and read(tables, tables.manifest()) == [(1, "a"), (2, "b")]
    second = tables.commit(first, {"t": tables.write("t", frame(spark, [(3, "c")]), part)}, {"t": ["1"]})
    assert read(tables, second) == [(2, "b"), (3, "c")] and read(tables, first) == [(1, "a"), (2, "b")]
    assert second.tables["t"].parts["0"] == first.tables["t"].parts["0"]  # not copied
    assert second.tables["u"] == first.tables["u"]
    with pytest.raises(Conflict):  # started from the first version, too
        tables.commit(first, {"t": half})
    assert tables.versions() == [1, 2] and tables.manifest() == second
    with pytest.raises(ValueError, match="not replaced"):
        tables.commit(second, {"t": half}, {"t": ["0"]})
    assert read(tables, tables.rollback(1)) == [(1, "a"), (2, "b")]
    emptied = tables.commit(tables.manifest(), {"t": tables.write("t", frame(spark, []), part)}, {"t": ["0", "1"]})
    assert read(tables, emptied) == [] and tables.read(emptied, "t").columns == ["k", "v"]
    assert sorted(tables.register(first, "old_")) == ["old_t", "old_u"]
    assert spark.table("old_t").join(spark.table("old_u"), F.lit(True)).count() == 2


def test_expired_versions_keep_shared_folders(spark, tmp_dir):
    tables = VersionedTables(spark, tmp_dir)
    part = F.pmod("k", F.lit(2)).cast("string")
    now = tables.commit(tables.manifest(), {"t": tables.write("t", frame(spark, [(1, "a"), (2, "b")]), part)})
    for v in "cde":
        now = tables.commit(now, {"t": tables.write("t", frame(spark, [(1, v)]), part)}, {"t": ["1"]})
    assert tables.expire(keep=2) == [1, 2] and tables.versions() == [3, 4]
    assert read(tables, tables.manifest(3)) == [(1, "d"), (2, "b")] and read(tables, now) == [(1, "e"), (2, "b")]
    left = [d for d, _, files in os.walk(f"{tmp_dir}/data") if any(f.endswith(".parquet") for f in files)]
    assert len(left) == 3  # the shared part and the two newest


def star_rows(mart, name):
    return sorted((tuple(r) for r in mart.table(name).collect()), key=str)


def test_a_failed_build_keeps_one_star(spark, tmp_dir, monkeypatch):
    staging = stored_staging(spark, SF_SMALL)
    star = StarVersions(spark, tmp_dir)
    star.rebuild(replace(staging, orders=staging.orders.where("order_status = 'delivered'")))
    before = {t: star.mart().table(t).count() for t in MART_TABLES}
    write, calls = VersionedTables.write, []

    def failing(self, table, *args):
        if len(calls) == 4:
            raise OSError("disk is full")
        calls.append(table)
        return write(self, table, *args)

    monkeypatch.setattr(VersionedTables, "write", failing)
    with pytest.raises(OSError):
        star.rebuild(staging)
    monkeypatch.undo()
    assert len(calls) == 4 and {t: star.mart().table(t).count() for t in MART_TABLES} == before
    assert star.mart().fact_order_items.join(star.mart().fact_orders, "order_id", "left_anti").count() == 0


def test_a_maintained_star_equals_a_rebuilt_one(spark, tmp_dir):
    after = stored_staging(spark, SF_SMALL)
    before = _before(after)
    # deleted orders, dearer items, another payment and a null person as well
    k = F.col("order_id").cast("bigint")
    extra = spark.createDataFrame([("extra", "c-extra", "created", "1997-02-11 10:00:00", None, None, None,
                                    "1999-12-31 23:59:00")], after.orders.schema)
    before = replace(
        before, orders=before.orders.unionByName(extra),
        order_items=after.order_items.withColumn("price", F.when(k % 97 == 0, "1.00").otherwise(F.col("price"))),
        order_payments=after.order_payments.where(k % 89 != 0),
        sellers=after.sellers.where("seller_zip_code_prefix % 2 = 0"),
        customers=before.customers.unionByName(spark.createDataFrame(
            [("c-extra", None, "1", "x", "y")], after.customers.schema)))
    star = StarVersions(spark, tmp_dir)
    first = star.rebuild(before)
    assert {t: star_rows(star.mart(), t) for t in MART_TABLES} == {
        t: star_rows(Mart(before), t) for t in MART_TABLES}
    second = star.maintain(after, staging_changes(before, after))
    for t in MART_TABLES:
        assert star_rows(star.mart(), t) == star_rows(Mart(after), t), t
    for t in ("fact_orders", "fact_order_items", "dim_date", "dim_customers"):
        old, new = first.tables[t].parts, second.tables[t].parts
        rewritten = set(second.info["replaced"][t])
        same = set(new) - rewritten
        assert all(new[p] == old[p] for p in same) and all(new[p] != old.get(p) for p in set(new) & rewritten)
        if t != "dim_customers":
            assert same, t
    assert second.tables["dim_products"] == first.tables["dim_products"]
    # nothing changed: nothing is written
    third = star.maintain(after, staging_changes(after, after))
    assert third.tables == second.tables


def test_changed_rows_cancel_equal_ones(spark):
    old = frame(spark, [(1, "a"), (1, "a"), (2, None), (3, "c")])
    new = frame(spark, [(1, "a"), (2, None), (3, "d"), (4, "e")])
    got = sorted(map(tuple, changed_rows(old, new).collect()))
    assert got == [(1, "a"), (3, "c"), (3, "d"), (4, "e")]


CHANGES = "k long, v string, at string, gone boolean"


def test_upsert_newest_wins_in_any_order(spark, tmp_dir):
    waves = [
        [(1, "a", "2024-01-01", False), (2, "b", "2024-01-01", False), (None, "n", "2024-01-01", False)],
        [(1, "a2", "2024-01-03", False), (1, "a1", "2024-01-02", False), (2, None, "2024-01-05", True)],
        [(2, "late", "2024-01-04", False), (None, "m", "2024-01-02", False), (3, "c", None, False)],
        [(3, "c2", "2024-01-01", None), (1, "same", "2024-01-03", False), (4, "x", "2024-01-01", True)],
    ]
    expected = {(1, "same"), (None, "m"), (3, "c2")}
    for i, order in enumerate(((0, 1, 2, 3), (3, 2, 1, 0), (1, 3, 0, 2))):
        table = UpsertTable(spark, f"{tmp_dir}/{i}", "t", ["k"], buckets=4)
        for w in order:
            rows = frame(spark, waves[w], CHANGES).select("k", "v", F.col("at").alias("_at"), F.col("gone").alias("_g"))
            table.merge(rows, F.col("_at"), F.col("_g"))
            table.merge(rows, F.col("_at"), F.col("_g"))  # again: nothing changes
        assert {(r["k"], r["v"]) for r in table.rows().collect()} == expected


def test_upsert_touches_only_buckets_of_the_batch(spark, tmp_dir):
    table = UpsertTable(spark, tmp_dir, "t", ["k"], buckets=16)
    rows = frame(spark, [(i, str(i)) for i in range(400)])
    first = table.merge(rows, F.lit("2024-01-01"))
    second = table.merge(frame(spark, [(7, "new"), (900, "n")]), F.lit("2024-01-02"))
    touched = set(second.info["replaced"]["t"])
    assert 1 <= len(touched) <= 2
    for bucket, folder in first.tables["t"].parts.items():
        assert (second.tables["t"].parts[bucket] == folder) == (bucket not in touched)
    read = table.tables.read(first, "t", touched).inputFiles()  # what the merge had to read
    assert read and all(any(f"/part={b}/" in f for b in touched) for f in read)
    assert table.rows().count() == 401 and table.rows(1).count() == 400
    assert UpsertTable(spark, tmp_dir, "t", ["k"], buckets=3).merge(
        frame(spark, [(1, "z")]), F.lit("2024-01-03")).info["buckets"] == 16


def test_upsert_loses_no_change_in_a_race(spark, tmp_dir, monkeypatch):
    a, b = (UpsertTable(spark, tmp_dir, "t", ["k"], buckets=2) for _ in range(2))
    a.merge(frame(spark, [(1, "a")]), F.lit("2024-01-01"))
    commit, raced = VersionedTables.commit, []

    def late(self, *args, **options):
        if not raced:  # another writer is faster, once
            raced.append(1)
            b.merge(frame(spark, [(2, "b")]), F.lit("2024-01-02"))
        return commit(self, *args, **options)

    monkeypatch.setattr(VersionedTables, "commit", late)
    a.merge(frame(spark, [(3, "c")]), F.lit("2024-01-02"))
    assert sorted(map(tuple, a.rows().collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_upsert_stream_skips_committed_batches(spark, tmp_dir):
    table = UpsertTable(spark, f"{tmp_dir}/t", "t", ["k"], buckets=2)
    rows = frame(spark, [(1, "a", "2024-01-01", False)], CHANGES)
    rows.write.parquet(f"{tmp_dir}/in/w=1")
    def load():
        return incremental_upsert(spark, f"{tmp_dir}/in", rows.schema, table, F.col("at"), f"{tmp_dir}/ck",
                                  deleted=F.col("gone"), options={"recursiveFileLookup": "true"})
    assert load() == [1] and load() == []
    frame(spark, [(1, "b", "2024-01-02", False)], CHANGES).write.parquet(f"{tmp_dir}/in/w=2")
    assert load() == [2]
    same = table.merge(rows, F.col("at"), batch=(f"{tmp_dir}/ck", 1))  # as after a restart
    assert same.version == 2 and table.rows().first()["v"] == "b"
