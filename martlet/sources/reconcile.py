"""Reconciliation by content: digests of a table that do not depend on its rows' order.

A digest is, per column, the number of NULLs, the xor of the values' 64-bit hashes and the
sum of 24 bits of each; and the same of whole rows. Equal multisets of values have equal
digests however they are ordered or split over tasks. A changed value shows in its column's
digest; values that changed places between rows leave every column's digest as it is and show
in the rows' digest. The xor alone would miss values that occur twice, the sum tells them.
Everything is one aggregate of fixed width, combined map-side, so a source's digest can be
observed while the source is written, in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "*"  # names the digest of whole rows
_SUMMED_BITS = (1 << 24) - 1  # sums stay within a long up to 5e11 rows
_PARTS = ("nulls", "xor", "sum")


def digest_columns(columns: list[str]) -> list[Column]:
    """The aggregates of a digest; ``digest_of`` reads them from their one row."""
    out = [F.count(F.lit(1)).alias("rows")]
    for i, names in enumerate([columns, *([c] for c in columns)]):
        h = F.xxhash64(*names)
        nulls = F.lit(0).cast("long") if i == 0 else F.count_if(F.col(names[0]).isNull())
        out += [nulls.alias(f"nulls_{i}") if i else F.sum(nulls).alias("nulls_0"),
                F.bit_xor(h).alias(f"xor_{i}"),
                F.sum(h.bitwiseAND(F.lit(_SUMMED_BITS))).alias(f"sum_{i}")]
    return out


def digest_of(row: dict, columns: list[str]) -> dict[str, tuple]:
    """name -> (rows, nulls, xor, sum), whole rows under ``ROWS``."""
    return {name: (row["rows"], *((row[f"{p}_{i}"] or 0) for p in _PARTS))
            for i, name in enumerate([ROWS, *columns])}


def digest(df: DataFrame) -> dict[str, tuple]:
    """The digest of a table: one pass, one row to the driver."""
    return digest_of(df.agg(*digest_columns(df.columns)).first().asDict(), df.columns)


def differences(source: dict[str, tuple], target: dict[str, tuple]) -> list[tuple[str, int, int, bool]]:
    """(name, source rows, target rows, content matches) of every column and of whole rows."""
    names = [*source, *(n for n in target if n not in source)]
    none = (0, None, None, None)
    return [(n, source.get(n, none)[0], target.get(n, none)[0], source.get(n) == target.get(n))
            for n in names]


def content_report(spark: SparkSession, pairs: dict[str, tuple[dict, dict]]) -> DataFrame:
    """(table, column, source_rows, target_rows, match) of (source, target) digests by name."""
    rows = [(table, *d) for table, (s, t) in pairs.items() for d in differences(s, t)]
    return spark.createDataFrame(
        rows, "table string, column string, source_rows long, target_rows long, match boolean")
