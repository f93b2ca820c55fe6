"""Corpus pipeline: language, exact and near duplicates, personal data, packing.

Every stage takes what the one before kept, as Parquet, and all but the last
return the columns of ``documents``:

1. ``language_id`` drops documents in which no language can be told (no text
   or no letter; only these where no row has a language to learn);
2. ``exact_dedup`` keeps the row with the smallest id of every group of equal
   texts, and of a repeated row one;
3. ``jaccard_join`` keeps the smallest id of every component of near duplicates:
   shingles of ``NEAR_WORDS`` words, Jaccard similarity ``NEAR_SIMILARITY`` or more;
4. ``pii_surrogates`` replaces personal data, in place;
5. ``curve_packing`` returns the pieces of packed sequences with their ids.

A null id passes the stages that go by ids unless its text is a copy.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import exact_dedup, jaccard_join, language, packing, pii
from martlet.llm.common import Stage, table
from martlet.llm.queries import PII_KEY, tokenizer_file

# The near-duplicate stage's own rule; op2's query has another contract.
NEAR_WORDS, NEAR_SIMILARITY = 5, 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(language.training_rows(docs))
    if not model.languages:  # nothing to learn from: one language, that of any letter
        model = language.Model(["any"], np.zeros((1, language.BUCKETS), np.float32))
    found = language.predict(docs, model, keep=docs.columns)
    return found.where(F.col("lang_pred") != language.UNKNOWN).select("row.*")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # ids in a struct, so that null equals null
    verdicts = exact_dedup.exact_dedup(docs).where("kept").select(
        F.struct("doc_id").alias("key"), F.col("text_sha256").alias("sha")).distinct()
    rows = docs.select(F.struct(F.col("doc_id")).alias("key"),
                       F.sha2(exact_dedup.normalised(F.col("text")), 256).alias("sha"),
                       F.struct(*docs.columns).alias("row"))
    same = (rows["key"] == verdicts["key"]) & (rows["sha"] == verdicts["sha"])
    kept = rows.join(verdicts, same, "left_semi").dropDuplicates(["key", "sha"])
    return kept.select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(docs, words=NEAR_WORDS, similarity=NEAR_SIMILARITY)
    dropped = found.where("doc_id != component_id").select(
        F.col("doc_id").alias("__dropped")).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col("__dropped"), "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c != "text"]
    return pii.replace_pii(docs, PII_KEY, keep=others, count_col="__mentions").select(
        *docs.columns)


def curve_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("jaccard_join", near_duplicates),
    ("pii_surrogates", personal_data),
    ("curve_packing", curve_packing),
]

# Learned languages, keyed surrogates and token ids are beyond SQL; the tests
# hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the packed pieces."""
    written = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, written.write(stage(spark, docs, sf_dir), name)
        written.release(before)
    return docs


QUERIES = {"pipeline": run}
QUERIES_SQL = {"pipeline": ORACLE_SQL}
