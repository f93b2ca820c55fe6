import pytest
from pyspark.sql import functions as F

from martlet.operators.checks import test_report as full_report
from martlet.plans.delta_tests import DELTA, KEYS, DeltaTests
from martlet.plans.store import stored_mart
from martlet.plans.warehouse import STAR_TABLES, star_before
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def star(spark):
    mart = stored_mart(spark, SF_SMALL)
    return {name: getattr(mart, name) for name in STAR_TABLES}


def failures(report):
    return {r.test_name: r.failures for r in report.collect()}


def test_a_change_gives_the_full_report(spark, star, tmp_dir):
    before, added, removed = star_before(star)
    tests = DeltaTests(spark, tmp_dir, buckets=2)
    tests.build(before)
    old, new = failures(full_report(before)), failures(full_report(star))
    assert failures(tests.report()) == old
    assert old["relationships_fact_order_items_order_id"] > 0 == new["relationships_fact_order_items_order_id"]
    assert old["unique_dim_products_product_id"] > 0 and old["not_null_fact_order_items_product_id"] > 0
    tests.apply(added, removed)
    assert tests.report().dtypes == full_report(star).dtypes
    assert sorted(tests.report().collect()) == sorted(full_report(star).collect())
    # and back again: the rows that came go, those that went come
    tests.apply(removed, added)
    assert failures(tests.report()) == old and failures(tests.report(2)) == new
    tests.tables.rollback(2)
    assert failures(tests.report()) == new
    tests.apply(removed, added)
    assert failures(tests.report()) == old


def test_only_parts_with_changed_keys_are_read_and_written(spark, star, tmp_dir):
    tests = DeltaTests(spark, tmp_dir, buckets=4)
    tests.build(star)
    one = star["fact_orders"].orderBy("order_id").limit(1)
    month = str(one.first().purchase_date_id)[:6]
    tests.apply({"fact_orders": one})  # its order twice
    first, second = tests.tables.manifest(1), tests.tables.manifest(2)
    hit = set(second.tables[DELTA].parts)
    changed = {p for p, f in second.tables[KEYS].parts.items() if first.tables[KEYS].parts[p] != f}
    assert changed == hit == set(second.info["replaced"][KEYS]) and len(hit) < 12
    assert any(p.endswith(f"-{month}") for p in hit)
    read = tests.tables.read(first, KEYS, sorted(hit)).inputFiles()
    assert {f.split("/part=")[1].split("/")[0] for f in read} == hit
    assert failures(tests.report()) == failures(
        full_report(star | {"fact_orders": star["fact_orders"].unionByName(one)}))
    assert failures(tests.report())["unique_fact_orders_order_id"] == 1


def test_nulls_empty_changes_and_rows_that_are_not_there(spark, star, tmp_dir):
    tests = DeltaTests(spark, tmp_dir, buckets=4)
    tests.build(star)
    tests.apply({"dim_sellers": star["dim_sellers"].limit(0)})
    assert failures(tests.report()) == failures(full_report(star))
    none = star["fact_order_items"].limit(3)
    for name in none.columns:
        none = none.withColumn(name, F.lit(None).cast(none.schema[name].dataType))
    tests.apply({"fact_order_items": none})
    want = full_report(star | {"fact_order_items": star["fact_order_items"].unionByName(none)})
    assert failures(tests.report()) == failures(want)
    ghost = star["dim_sellers"].limit(1).withColumn("seller_id", F.lit("ghost"))
    with pytest.raises(ValueError, match="never added"):
        tests.apply({}, {"dim_sellers": ghost})
    assert max(tests.tables.versions()) == 3
    with pytest.raises(ValueError, match="needed"):
        tests.apply({}, {})
    empty = DeltaTests(spark, f"{tmp_dir}/empty", buckets=2)
    empty.build({name: t.limit(0) for name, t in star.items()})
    assert set(failures(empty.report()).values()) == {0}
    empty.apply(star)
    assert failures(empty.report()) == failures(full_report(star))
