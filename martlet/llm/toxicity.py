"""Toxicity by non-negative positive-unlabelled learning.

*Data.* Confirmed toxic rows (positives) and unlabelled text. Both are bounded
samples chosen by a hash of the id: ``POSITIVES`` and ``UNLABELLED`` rows.
Labels of clean rows are not used for fitting; together with the toxic ones
they only estimate the class prior (share of toxic rows among labelled ones,
``PRIOR`` where nothing else is labelled).

*Features.* Presence of whole words and of word beginnings (3 to 6 letters),
hashed to ``BUCKETS``. Tasks count in how many positive and unlabelled texts
a feature occurs; the ``FEATURES`` with the strongest association enter.

*Risk.* With prior p, a linear score g and a sigmoid loss l, the classifier
minimises ``p E_pos[l(g)] + max(0, E_unl[l(-g)] - p E_pos[l(-g)])``: the
second term is the risk on clean text, corrected for the toxic share of the
unlabelled sample and kept from falling below zero by overfitting (a step
that would push it below zero ascends it instead). Trained with numpy.

Scoring runs row by row over whole texts; nothing is shuffled.

Defined cases: null and empty texts have no features and get the
intercept's score; without positives every text scores 0; a label row whose
document is missing, a null label or a null id is ignored, repeated label rows
count once; an empty table gives an empty result; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import Stage, extended, first_by_hash, fold, prepare
from martlet.llm.textvec import Words, chunks

BITS = 20
BUCKETS = 1 << BITS
PREFIXES = (0, 3, 4, 5, 6)
POSITIVES = 4_000
UNLABELLED = 16_000
FEATURES = 4_096
LEAST_Z = 4.0
PRIOR = 0.1
STEPS = 300
RATE = 0.05
L2 = 1e-5

_STEPS = 1_000_000


@dataclass
class Model:
    features: np.ndarray  # sorted hashed features that entered
    weights: np.ndarray
    intercept: float
    prior: float


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once, by text."""
    docs, feats = [], []
    for first, part in chunks(texts):
        words = Words(part)
        if not len(words.starts):
            continue
        keys = [(words.doc[which].astype(np.int64) << BITS) | hashes
                for which, hashes in (words.prefixes(n, BITS) for n in PREFIXES)]
        keys = np.unique(np.concatenate(keys))
        docs.append((keys >> BITS) + first)
        feats.append(keys & (BUCKETS - 1))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(docs), np.concatenate(feats)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(positive, text) -> (feature, positive texts, unlabelled texts) of the task."""
    sums = np.zeros((2, BUCKETS), np.int32)
    for batch in batches:
        kinds = np.array(batch.column(0).to_pylist(), np.int64)
        docs, feats = presence([t or "" for t in batch.column(1).to_pylist()])
        for kind in (0, 1):
            sums[kind] += np.bincount(feats[kinds[docs] == kind], minlength=BUCKETS).astype(np.int32)
    hit = np.flatnonzero(sums.any(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(hit.astype(np.int32)), pa.array(sums[1][hit]), pa.array(sums[0][hit])],
        names=["feature", "pos", "unl"])


def _rows(features: np.ndarray):
    """mapInArrow: (positive, text) -> (positive, places of its features among ``features``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, places = _places([t or "" for t in batch.column(1).to_pylist()], features)
            split = np.split(places, np.searchsorted(docs, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.astype(np.int32) for x in split],
                                           pa.list_(pa.int32()))], names=["positive", "places"])

    return run


def _places(texts: list[str], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    docs, feats = presence(texts)
    if not len(features):
        return docs[:0], feats[:0]
    at = np.minimum(np.searchsorted(features, feats), len(features) - 1)
    hit = features[at] == feats
    return docs[hit], at[hit]


def _associated(counted: DataFrame, pos: int, unl: int) -> np.ndarray:
    """The features whose presence differs most between positives and unlabelled."""
    p, q = F.col("pos") / F.lit(max(pos, 1)), F.col("unl") / F.lit(max(unl, 1))
    # the mean of both shares, a little raised so that single hits prove nothing
    base = (F.col("pos") + F.col("unl") + 1) / F.lit(pos + unl + 2)
    z = (p - q) / F.sqrt(base * (1 - base) * F.lit(1 / max(pos, 1) + 1 / max(unl, 1)))
    top = counted.select("feature", F.abs(z).alias("z")).where(F.col("z") >= LEAST_Z).orderBy(
        F.desc("z"), "feature").limit(FEATURES).collect()
    return np.array(sorted(r["feature"] for r in top), np.int64)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_nnpu(rows: list[np.ndarray], positive: np.ndarray, features: int, prior: float
             ) -> tuple[np.ndarray, float]:
    """Weights and intercept of the linear score; rows of feature places."""
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    place = np.concatenate(rows) if len(doc) else np.zeros(0, np.int64)
    w, b = np.zeros(features), np.log(prior / (1 - prior))
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    n_pos, n_unl = positive.sum(), (~positive).sum()
    for step in range(1, STEPS + 1):
        z = np.bincount(doc, w[place], minlength=len(rows)) + b
        s = _sigmoid(z)  # sigmoid loss of a clean text; 1 - s that of a toxic one
        slope = s * (1 - s)
        clean_risk = s[~positive].mean() - prior * s[positive].mean()
        toward_clean = np.where(positive, -prior / n_pos, 1 / n_unl) * slope
        if clean_risk >= 0:
            grad = np.where(positive, -prior / n_pos, 0.0) * slope + toward_clean
        else:
            grad = -toward_clean
        full = np.append(np.bincount(place, grad[doc], minlength=features) + L2 * w, grad.sum())
        m = 0.9 * m + 0.1 * full
        v = 0.999 * v + 0.001 * full * full
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          toxic_col: str = "toxic") -> Model:
    """Fit on ``docs`` (any row counts as unlabelled) and confirmed toxic ``labels``."""
    spark = prepare(docs.sparkSession)
    stage = Stage(spark, "toxicity")
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(toxic_col).alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IS NOT NULL").distinct()
    known, toxic = marks.agg(F.count("*"), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0))
                             ).first()
    prior = min(0.5, max(0.001, toxic / known)) if 0 < toxic < known else PRIOR
    # at most POSITIVES ids: bounded, so it may be broadcast
    positives = first_by_hash(marks.where("toxic = 1").select("doc_id"), "doc_id", POSITIVES, toxic)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    share = int(min(1.0, UNLABELLED / max(1, docs.count())) * _STEPS)
    sample = stage.write(
        rows.join(F.broadcast(positives), "doc_id", "left_semi").select(
            F.lit(1).alias("positive"), "text").unionByName(
            rows.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(_STEPS)) < share).select(
                F.lit(0).alias("positive"), "text")), "sample")
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(
        F.count("*").alias("n")).collect()}
    pos, unl = sizes.get(1, 0), sizes.get(0, 0)
    none = Model(np.zeros(0, np.int64), np.zeros(0), -30.0, prior)
    if not pos or not unl:
        return none
    counted = sample.mapInArrow(_count, "feature int, pos int, unl int").groupBy("feature").agg(
        F.sum("pos").alias("pos"), F.sum("unl").alias("unl"))
    features = _associated(counted, pos, unl)
    if not len(features):
        return none
    found = sample.mapInArrow(_rows(features), "positive int, places array<int>").toArrow()
    places = found.column("places").combine_chunks()
    flat = places.flatten().to_numpy().astype(np.int64)
    ends = np.cumsum([len(x) for x in places])
    w, b = fit_nnpu(np.split(flat, ends[:-1]), found.column("positive").to_numpy() == 1,
                    len(features), prior)
    stage.release(sample)
    return Model(features, w, b, prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
          ) -> DataFrame:
    """doc_id, score, predicted for every row of ``docs``."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, places = _places([t or "" for t in batch.column(1).to_pylist()], model.features)
            z = np.bincount(docs_, model.weights[places], minlength=batch.num_rows)
            p = _sigmoid(z + model.intercept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, extended(rows.select("doc_id").schema,
                                         "score double, predicted int"))


def training_rows(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return rows.where(fold(F.col(id_col), 5) != 0)
