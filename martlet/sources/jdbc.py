"""Relational sources over JDBC.

A table is read in parallel by ``numPartitions`` range queries on a numeric
column (each executor opens its own connection), every column is staged as
text -- the relational loader's contract -- and the column order is the
table's own (the JDBC schema is in ordinal order). The row count is a
distributed aggregate, not a driver-side fetch.

No database or driver jar is available in the test environment; the option
building and the text staging are tested on ordinary DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class JdbcSource:
    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    num_partitions: int | None = None
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.table, "fetchsize": str(self.fetch_size)}
        opts.update(self.properties)
        if self.partition_column:
            if self.lower_bound is None or self.upper_bound is None or not self.num_partitions:
                raise ValueError("a partition column needs lower_bound, upper_bound and num_partitions")
            opts.update({
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower_bound),
                "upperBound": str(self.upper_bound),
                "numPartitions": str(self.num_partitions),
            })
        return opts


def as_text_columns(df: DataFrame) -> DataFrame:
    """Every column cast to text, names lower-cased, order kept."""
    return df.select(*[F.col(c).cast("string").alias(c.lower()) for c in df.columns])


def read_jdbc(spark: SparkSession, source: JdbcSource) -> DataFrame:
    reader = spark.read.format("jdbc")
    for k, v in source.options().items():
        reader = reader.option(k, v)
    return as_text_columns(reader.load())
