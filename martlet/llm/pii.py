"""Personal data replaced by surrogates over a whole corpus.

1. A cheap native pattern sets aside texts that cannot hold an entity; they
   pass unchanged and are not shuffled.
2. Tasks list the distinct entities of each remaining text (``surrogates``).
   Texts are known by their digest, so copies list theirs once.
3. The distinct entities of the corpus get keyed surrogates of their kind and
   shape. Collision checks run over that table: a surrogate must differ from
   every real value of its kind in the corpus and from every other surrogate.
   Entities that collide (of equal surrogates, all but the least) draw again,
   until none does: so distinct entities stay distinct, and one entity has one
   surrogate everywhere.
4. Each text's entities are joined with their surrogates and written back into
   its forms. The shuffled texts are only those that may hold entities.

Defined cases: null and empty texts are returned as they are with no entities;
repeated rows are treated alike; a text without entities is returned byte for
byte; an empty table gives an empty result; columns named in ``keep`` are
returned unchanged whatever their names, others are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm import surrogates as s
from martlet.llm.common import Stage, extended, prepare

# Draws before a kind is declared too crowded (an error). From ``surrogates.WIDEN`` draws on,
# private addresses, names, emails and secrets have wider targets; the fixed formats do not.
MOST_ATTEMPTS = 100


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (digest, text) -> (digest, kind, canon), each once a text."""
    for batch in batches:
        rows = []
        for digest, text in zip(*(c.to_pylist() for c in batch.columns)):
            rows += [(digest, kind, canon) for kind, canon in sorted(
                {(m.kind, m.entity) for m in s.find(text or "")})]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns],
                                         names=["digest", "kind", "canon"])


def _draw(key: bytes):
    """mapInArrow: (kind, canon, attempt) -> with the surrogate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [s.surrogate(k, c, key, a) for k, c, a in
                     zip(*(x.to_pylist() for x in batch.columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.string())],
                                             names=["kind", "canon", "attempt", "surrogate"])

    return run


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (row, text, given) -> (row, text, n_entities)."""
    for batch in batches:
        texts, counts = [], []
        for text, given in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if given:
                text, n = s.replace(text, {(g["kind"], g["canon"]): g["surrogate"] for g in given})
            else:
                n = 0
            texts.append(text)
            counts.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
            names=["row", "text", "n_entities"])


def assign(entities: DataFrame, key: bytes, stage: Stage) -> DataFrame:
    """(kind, canon, surrogate) of distinct (kind, canon), free of collisions."""
    drawn_schema = "kind string, canon string, attempt int, surrogate string"
    real = entities.select("kind", F.col("canon").alias("surrogate"))
    now = stage.write(entities.select("kind", "canon", F.lit(0).alias("attempt")).mapInArrow(
        _draw(key), drawn_schema), "drawn")
    for _ in range(MOST_ATTEMPTS):
        hit = now.join(real, ["kind", "surrogate"], "left_semi").select("kind", "canon")
        shared = now.groupBy("kind", "surrogate").agg(
            F.min("canon").alias("first"), F.count("*").alias("n")).where("n > 1")
        lost = now.join(shared, ["kind", "surrogate"]).where("canon != first").select(
            "kind", "canon")
        again = stage.write(hit.unionByName(lost).distinct(), "again")
        if again.isEmpty():
            return now.select("kind", "canon", "surrogate")
        redrawn = now.join(again, ["kind", "canon"], "left_semi").select(
            "kind", "canon", (F.col("attempt") + 1).alias("attempt")).mapInArrow(
                _draw(key), drawn_schema)
        new = stage.write(now.join(again, ["kind", "canon"], "left_anti").select(
            "kind", "canon", "attempt", "surrogate").unionByName(redrawn), "drawn")
        stage.release(now, again)
        now = new
    raise RuntimeError(f"surrogates still collide after {MOST_ATTEMPTS} draws")


def _maybe(text: Column) -> Column:
    """Whether a text may hold an entity. The pattern is slow; it only sees texts that pass
    a test it implies."""
    lowered = F.lower(text)
    likely = text.rlike("[0-9@]")
    for part in s.MAYBE_PARTS:
        likely = likely | text.contains(part)
    for part in s.MAYBE_LOWER:
        likely = likely | lowered.contains(part)
    return likely & text.rlike(s.MAYBE)


def replace_pii(docs: DataFrame, key: bytes, keep: list[str] | None = None,
                text_col: str = "text", count_col: str = "n_entities") -> DataFrame:
    """The ``keep`` columns, the text with surrogates and its number of entities of
    every row."""
    spark = prepare(docs.sparkSession)
    stage = Stage(spark, "pii")
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"),
                       F.col(text_col).cast("string").alias("text"))
    maybe = F.coalesce(_maybe(F.col("text")), F.lit(False))
    # staged: three plans read these rows, and the pattern costs more than all else
    dirty = stage.write(rows.where(maybe).withColumn("digest", F.sha2("text", 256)), "dirty")
    found = stage.write(dirty.select("digest", "text").mapInArrow(
        _found, "digest string, kind string, canon string").distinct(), "found")
    given = assign(found.select("kind", "canon").distinct(), key, stage)
    by_text = found.join(given, ["kind", "canon"]).groupBy("digest").agg(
        F.collect_list(F.struct("kind", "canon", "surrogate")).alias("given"))
    # entities of one text: bounded by the text
    written = dirty.join(by_text, "digest", "left").select("row", "text", "given").mapInArrow(
        _written, extended(rows.schema, "n_entities long"))
    whole = rows.where(~maybe).withColumn("n_entities", F.lit(0).cast("long"))
    return whole.unionByName(written).select(
        "row.*", F.col("text").alias(text_col), F.col("n_entities").alias(count_col))
