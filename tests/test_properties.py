"""Property tests: CSV round trips of arbitrary text, minute keys of arbitrary times."""

import csv
import datetime as dt
import io
import os
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions.timekeys import minute_floor, minute_key, try_minute_key
from martlet.sources import csv as mcsv

CHARS = (st.characters(blacklist_categories=("Cs", "Cc"), blacklist_characters="﻿�")
         | st.sampled_from(['"', ",", "\n", " ", "'"]))
TEXT = st.lists(CHARS, max_size=12).map("".join)
SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(rows=st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=20))
def test_csv_round_trip(spark, tmp_dir, rows):
    buf = io.StringIO()
    w = csv.writer(buf, quoting=csv.QUOTE_MINIMAL, lineterminator="\n")
    w.writerow(["a", "b"])
    for i, r in enumerate(rows):
        w.writerow([str(i), *r])
    path = os.path.join(tmp_dir, f"{uuid.uuid4().hex}.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(buf.getvalue().replace("a,b\n", "id,a,b\n", 1))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "a", "b")])
    got = {r.id: (r.a, r.b) for r in mcsv.read_csv(spark, path, schema=schema, encoding="UTF-8").df.collect()}

    def expect(v):
        return None if v in mcsv.NULL_TOKENS else v
    assert got == {str(i): (expect(a), expect(b)) for i, (a, b) in enumerate(rows)}


@SLOW
@given(times=st.lists(st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 12, 31)),
                      min_size=1, max_size=30))
def test_minute_keys(spark, times):
    texts = [t.strftime("%Y-%m-%d %H:%M:%S") for t in times] + ["not a time", None]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    got = df.select("t", try_minute_key("t").alias("k"),
                    minute_floor(F.col("t").try_cast("timestamp_ntz")).alias("m")).collect()
    for r in got:
        if r.t is None or r.t == "not a time":
            assert r.k is None and r.m is None
        else:
            t = dt.datetime.strptime(r.t, "%Y-%m-%d %H:%M:%S")
            assert r.k == int(t.strftime("%Y%m%d%H%M"))
            assert r.m == t.replace(second=0)
    good = df.where(F.col("t").isNull() | (F.col("t") != "not a time"))
    assert {r.k for r in good.select(minute_key("t").alias("k")).collect()} == \
        {int(t.strftime("%Y%m%d%H%M")) for t in times} | {None}
