"""Language identification as mixture inference.

*Training.* Letter trigrams (lower-cased, hashed to ``BUCKETS``) are counted
per language over a bounded sample of labelled rows: of each language about
``SAMPLE`` rows, chosen by a hash of the id. The counts give smoothed n-gram
likelihoods, a table of languages x BUCKETS.

*Prediction.* A text's words are drawn from a mixture of languages. The
likelihood of a word under a language is the product of its trigrams';
expectation-maximisation estimates the proportions. The language set is
chosen by penalised likelihood: starting from all languages, the one with the
least proportion is dropped and the rest re-estimated, down to one; the set
with the best ``log likelihood - PENALTY/2 * (size - 1) * log(words)`` wins.
The prediction is the language with the largest proportion (ties: the first
in the order of names), the score its proportion.

Prediction is row by row over whole texts, nothing is shuffled.

Defined cases: null, empty or letterless texts are ``und`` with score 0 and
no languages; so is every text where no labelled row exists; rows with a null
language are not trained on; repeated rows get equal results; an empty table
gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import extended, fold, prepare
from martlet.llm.textvec import Words, chunks

BITS = 16
BUCKETS = 1 << BITS
SAMPLE = 3000  # labelled rows of a language, about
SMOOTHING = 0.2
PENALTY = 6.0
ROUNDS = (6, 4)  # EM steps over all languages, and after each drop
UNKNOWN = "und"

_STEPS = 1_000_000


@dataclass
class Model:
    languages: list[str]
    log_prob: np.ndarray  # float32 [languages, BUCKETS]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, bucket, n), summed over the task."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            own = [t or "" for t, x in zip(texts, langs) if x == lang]
            sums = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for _, part in chunks(own):
                sums += np.bincount(Words(part).trigrams(BITS), minlength=BUCKETS)
    for lang, sums in counts.items():
        hit = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(hit), pa.string()), pa.array(hit.astype(np.int32)),
             pa.array(sums[hit])], names=["lang", "bucket", "n"])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit on the labelled rows (null languages are left out)."""
    prepare(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                           F.pmod(F.xxhash64(F.col(id_col)), F.lit(_STEPS)).alias("draw")
                           ).where("lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, BUCKETS), np.float32))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                           for x in (lang, int(min(1.0, sample / n) * _STEPS))])
    drawn = rows.where(F.col("draw") < F.element_at(share, F.col("lang"))).select("lang", "text")
    counted = drawn.mapInArrow(_count, "lang string, bucket int, n long").groupBy(
        "lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    languages = sorted(sizes)
    counts = np.zeros((len(languages), BUCKETS))
    place = {lang: i for i, lang in enumerate(languages)}
    counts[[place[x] for x in counted["lang"]], counted["bucket"]] = counted["n"]
    counts += SMOOTHING
    return Model(languages, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32))


def _em(lik: np.ndarray, doc: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
        share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM steps from ``share`` [languages, texts]; (shares, sum of log likelihoods)."""
    for _ in range(rounds):
        joint = share[:, doc]
        joint *= lik
        joint /= joint.sum(0)
        share = np.add.reduceat(joint, starts, axis=1) / sizes
    joint = share[:, doc]
    joint *= lik
    fit = np.add.reduceat(np.log(np.maximum(joint.sum(0), 1e-37)).astype(np.float64), starts)
    return share, fit


def mixtures(texts: list[str], log_prob: np.ndarray) -> np.ndarray:
    """Proportions [texts, languages] of each text; rows of zeros where there is no letter."""
    out = np.zeros((len(texts), len(log_prob)))
    if not len(log_prob):
        return out
    for first, part in chunks(texts):
        words = Words(part)
        if not len(words.starts):
            continue
        ll = np.add.reduceat(log_prob[:, words.trigrams(BITS)], words.starts, axis=1)
        # below e^-25 of the best language, a word tells nothing more
        lik = np.exp(np.maximum(ll - ll.max(0), -25.0))
        starts = np.flatnonzero(np.concatenate(([True], words.doc[1:] != words.doc[:-1])))
        sizes = np.diff(np.append(starts, len(words.doc))).astype(np.float32)
        doc = np.repeat(np.arange(len(starts)), sizes.astype(np.int64))
        n, texts_here = len(log_prob), len(starts)
        share = np.full((n, texts_here), 1.0 / n, np.float32)
        share, fit = _em(lik, doc, starts, sizes, share, ROUNDS[0])
        best, best_fit = share.copy(), fit - 0.5 * PENALTY * (n - 1) * np.log(sizes)
        alive = np.ones((n, texts_here), bool)
        for size in range(n - 1, 0, -1):
            # drop the least; of equal ones the last by name
            least = n - 1 - np.where(alive, share, 2.0)[::-1].argmin(0)
            alive[least, np.arange(texts_here)] = False
            share = np.where(alive, np.maximum(share, 1e-6), 0.0).astype(np.float32)
            share /= share.sum(0)
            share, fit = _em(lik, doc, starts, sizes, share, ROUNDS[1] if size > 1 else 0)
            fit = fit - 0.5 * PENALTY * (size - 1) * np.log(sizes)
            better = fit > best_fit
            best[:, better], best_fit = share[:, better], np.maximum(fit, best_fit)
        out[first + words.doc[starts]] = best.T
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """doc_id (or a struct ``row`` of the input columns named in ``keep``), lang_pred,
    score, languages, proportions (the set by falling proportion)."""
    prepare(docs.sparkSession)
    text = F.col(text_col).cast("string").alias("__text")
    if keep:  # the row travels along; its text is not sent twice
        inner = docs.select(F.struct(*[F.col(c) for c in keep]).alias("__row"),
                            *([] if text_col in keep else [text]))
    else:
        inner = docs.select(F.col(id_col).alias("doc_id"), text)
    inside = bool(keep) and text_col in keep
    names, log_prob = model.languages, model.log_prob

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0).field(text_col) if inside else batch.column(1)
            share = mixtures([t or "" for t in column.to_pylist()], log_prob)
            order = np.argsort(-share, axis=1, kind="stable") if len(names) else share.astype(int)
            langs = [[names[j] for j in o if s[j] > 0] for o, s in zip(order, share)]
            parts = [[float(s[j]) for j in o if s[j] > 0] for o, s in zip(order, share)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] if x else UNKNOWN for x in langs], pa.string()),
                 pa.array([min(1.0, x[0]) if x else 0.0 for x in parts], pa.float64()),
                 pa.array(langs, pa.list_(pa.string())),
                 pa.array(parts, pa.list_(pa.float64()))],
                names=[batch.schema.names[0], "lang_pred", "score", "languages", "proportions"])

    schema = extended(inner.drop("__text").schema, "lang_pred string, score double, "
                      "languages array<string>, proportions array<double>")
    out = inner.mapInArrow(run, schema)
    if not keep:
        return out
    return out.withColumnRenamed("__row", "row")


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return docs.where(fold(F.col(id_col), 4) != 2)
