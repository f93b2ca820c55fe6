"""Exact duplicates by counting quotient filters and byte verification.

1. One native pass reads every whole text, replaces each run of white space
   by one space and writes a light table: id, 64-bit fingerprint, SHA-256.
2. Every task inserts its fingerprints into counting quotient filters, one
   per range of the fingerprint (``cqf``). The filters of a range merge
   losslessly, by sorted remainders; a fingerprint that a third of all rows
   share is one entry with a count in each, so no range is hot.
3. Fingerprints with a count above one route their documents, and only those,
   to byte verification: the normalised texts themselves are the grouping
   key, combined map-side, so a large group of copies reaches the exchange as
   one row a task and texts that merely share a fingerprint stay apart.
4. The verified groups are joined to the light table.

Defined cases: a null text counts as empty; empty texts are equal to one
another; the row with the smallest id of a group stays; a null id is never the
smallest unless all are null; a row that occurs twice is returned twice, and
both are ``kept`` or not alike; an empty table gives an empty result; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import Stage, prepare, whole_text
from martlet.llm.cqf import QuotientFilter

# Fingerprints that one merging task should hold.
RANGE_ROWS = 1 << 20
# A run of white space that is not already one space.
_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(whole_text(text), _RUN, " ")


def _filters(range_bits: int):
    """mapInArrow: fingerprints -> one filter per range of their high bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = QuotientFilter()
        waiting: list[QuotientFilter] = []
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            waiting.append(QuotientFilter.build(fps))
            if len(waiting) >= 64:
                whole, waiting = whole.merge(*waiting), []
        whole = whole.merge(*waiting)
        part = (whole.keys >> np.uint64(64 - range_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(part)]):
            one = QuotientFilter(whole.keys[lo:hi], whole.counts[lo:hi])
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(part[lo])], pa.int64()), pa.array([one.to_bytes()], pa.binary())],
                names=["part", "filter"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range: its filters merged; the fingerprints counted more than once."""
    whole = QuotientFilter()
    for batch in batches:
        whole = whole.merge(*(QuotientFilter.from_bytes(x.as_py()) for x in batch.column("filter")))
    often = whole.counts > 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(whole.keys[often].view(np.int64)), pa.array(whole.counts[often])],
        names=["fp", "copies"])


def repeated_fingerprints(light: DataFrame, rows: int) -> DataFrame:
    """(fp, copies) of the fingerprints that occur more than once in ``light``."""
    range_bits = max(6, int(rows // RANGE_ROWS).bit_length())
    built = light.select("fp").mapInArrow(_filters(range_bits), "part long, filter binary")
    return built.groupBy("part").applyInArrow(_merged, "fp long, copies long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = prepare(docs.sparkSession)
    stage = Stage(spark, "exact-dedup")
    text = normalised(F.col(text_col))
    # fingerprint and digest read the same normalised text
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("norm"))
    light = stage.write(source.select("doc_id", F.xxhash64("norm").alias("fp"),
                                      F.sha2("norm", 256).alias("sha")), "light")
    repeated = stage.write(repeated_fingerprints(light, light.count()), "repeated")
    routed = source.withColumn("fp", F.xxhash64("norm")).join(
        repeated.select("fp"), "fp", "left_semi")
    groups = routed.groupBy("norm").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    verified = stage.write(groups.select(F.sha2("norm", 256).alias("sha"), "keep_id",
                                         "group_size"), "verified")
    joined = light.join(verified, "sha", "left")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))
