"""Quality by co-training of two views.

*Views.* The text view sees how a text is written: shares of pairs and hashed
triples of character classes (letters by case, digits, spaces, line breaks,
each common mark). The page view sees what is known about the page without
reading it: source, language, recorded length, and its layout (lines, their
lengths, repeated and blank lines, bytes a character).

*Co-training.* From a bounded sample of labelled rows (``LABELLED``) each view
trains a logistic classifier (numpy). Over ``ROUNDS`` rounds both score a
bounded pool of unlabelled rows (``POOL``); each hands the rows it is surest of
(``HANDED`` of the pool at either end, if at least ``SURE``) with its label to
the *other* view, which trains again, unless that view is sure of the opposite.

*Combination.* On labelled rows that neither view trained on, each view's score
is calibrated and the two calibrated views are weighed by one more logistic
fit. All rows are then scored over whole texts, row by row; nothing is shuffled.

Defined cases: null and empty texts and null metadata have features of their
own and are scored like others; without labelled rows of both kinds every row
scores the share of good rows among labelled ones (1 without any); label rows
without a document, with nulls or repeated are ignored; repeated rows get
equal scores; an empty table gives an empty result; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import Stage, extended, first_by_hash, fold, prepare
from martlet.llm.textvec import chunks

LABELLED = 6_000
POOL = 6_000
ROUNDS = 3
HANDED = 0.05
SURE = 0.9
HELD_BACK = 0.3  # of the labelled rows, for calibration

CLASSES = 32
TRIPLES = 1024
TEXT_DIM = CLASSES * CLASSES + TRIPLES
SOURCES, LANGS = 64, 16
PAGE_DIM = 10 + SOURCES + LANGS
STEPS = (200, 60)  # of a first fit, and of one that goes on from the last
RATE = 0.05
L2 = 1e-4
_DRAWS = 1_000_000

_MARKS = ".,;:!?'\"-()[]{}<>|/\\#$%&*+=@_~"


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Class of every code point up to U+2FFF; others are 'other letter or sign'."""
    table = np.zeros(0x3000, np.uint8)
    for c in range(len(table)):
        ch = chr(c)
        if ch in "\n\r":
            table[c] = 1
        elif ch.isspace():
            table[c] = 2
        elif ch.islower():
            table[c] = 3
        elif ch.isupper():
            table[c] = 4
        elif ch.isalpha():
            table[c] = 5
        elif ch.isdigit():
            table[c] = 6
        else:
            table[c] = 7
    for i, ch in enumerate(_MARKS):
        table[ord(ch)] = 8 + i % (CLASSES - 8)
    return table


def text_view(texts: list[str]) -> np.ndarray:
    """[texts, TEXT_DIM]: square roots of the shares of class pairs and triples."""
    out = np.zeros((len(texts), TEXT_DIM), np.float32)
    table = _class_table()
    for first, part in chunks(texts):
        raw = np.frombuffer("\0".join([*part, ""]).encode("utf-32-le", "replace"), "<u4")
        codes = table[np.minimum(raw, len(table) - 1)].astype(np.int64)
        ends = np.cumsum([len(t) + 1 for t in part])
        doc = np.repeat(np.arange(len(part)), np.diff(np.concatenate(([0], ends))))
        pair = codes[:-1] * CLASSES + codes[1:]
        triple = ((pair[:-1] * CLASSES + codes[2:]) * 0x9E3779B1 >> 7) % TRIPLES
        n = len(part)
        pairs = np.bincount(doc[1:] * CLASSES**2 + pair, minlength=n * CLASSES**2)
        triples = np.bincount(doc[2:] * TRIPLES + triple, minlength=n * TRIPLES)
        both = np.hstack([pairs[:n * CLASSES**2].reshape(n, -1), triples[:n * TRIPLES].reshape(n, -1)])
        size = np.maximum(1, [len(t) for t in part])[:, None]
        out[first:first + n] = np.sqrt(both / size)
    return out


def _slot(value: str | None, slots: int) -> int:
    """0 for null, else a hashed place behind it."""
    return 0 if value is None else 1 + zlib.crc32(value.encode()) % (slots - 1)


def page_view(texts: list[str | None], sources: list[str | None], langs: list[str | None],
              recorded: list[int | None]) -> np.ndarray:
    """[rows, PAGE_DIM]: metadata and layout."""
    out = np.zeros((len(texts), PAGE_DIM), np.float32)
    for i, (text, source, lang, chars) in enumerate(zip(texts, sources, langs, recorded)):
        lines = (text or "").split("\n")
        n = len(text or "")
        longest = max(map(len, lines))
        out[i, :10] = (
            text is None, chars is None, np.log1p(max(0, chars or 0)) / 12, np.log1p(n) / 12,
            np.log1p(len(lines)) / 8, np.log1p(n / len(lines)) / 8, np.log1p(longest) / 10,
            1 - len(set(lines)) / len(lines), sum(not x.strip() for x in lines) / len(lines),
            len((text or "").encode()) / max(1, n) - 1)
        out[i, 10 + _slot(source, SOURCES)] = 1
        out[i, 10 + SOURCES + _slot(lang, LANGS)] = 1
    return out


@dataclass
class Linear:
    weights: np.ndarray
    intercept: float
    mean: np.ndarray
    scale: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.intercept


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, start: Linear | None = None, l2: float = L2) -> Linear:
    """Logistic regression by full-batch Adam on standardised columns."""
    mean, scale = (x.mean(0), x.std(0) + 0.02) if start is None else (start.mean, start.scale)
    z = ((x - mean) / scale).astype(np.float32)
    y = y.astype(np.float32)
    w, b = (np.zeros(x.shape[1], np.float32), 0.0) if start is None else (
        start.weights, start.intercept)
    m, v = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    for step in range(1, STEPS[start is not None] + 1):
        error = (_sigmoid(z @ w + np.float32(b)) - y) / np.float32(len(y))
        grad = np.append(error @ z + l2 * w, error.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return Linear(w, float(b), mean, scale)


@dataclass
class Model:
    views: list[Linear]  # text, page
    calibration: list[Linear]
    combined: Linear | None
    constant: float

    def score(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        if self.combined is None:
            return np.full(len(text), self.constant)
        return _sigmoid(self.combined.logit(self._calibrated([text, page])))

    def _calibrated(self, views: list[np.ndarray]) -> np.ndarray:
        return np.column_stack([c.logit(v.logit(x)[:, None])
                                for v, c, x in zip(self.views, self.calibration, views)])


def co_train(labelled: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray]) -> Model:
    """``labelled`` and ``pool``: the two views' matrices."""
    share = float(y.mean()) if len(y) else 1.0
    held = np.zeros(len(y), bool)
    rng = np.random.default_rng(3)
    for kind in (0, 1):  # hold back of each kind, at least one kept and one held
        rows = rng.permutation(np.flatnonzero(y == kind))
        if len(rows) < 2:
            return Model([], [], None, share)
        held[rows[:max(1, int(HELD_BACK * len(rows)))]] = True
    own = [(x[~held], y[~held]) for x in labelled]
    free = np.ones(len(pool[0]), bool)
    views = [fit(*o) for o in own]
    for _ in range(ROUNDS):
        most = max(1, int(HANDED * len(pool[0])))
        if not free.any():
            break
        handed = []
        seen = [_sigmoid(view.logit(x)) for view, x in zip(views, pool)]
        for mine, other in (seen, seen[::-1]):
            p = np.where(free, mine, 0.5)
            good = np.argsort(-p, kind="stable")[:most]
            bad = np.argsort(p, kind="stable")[:most]
            # a label the receiver is sure to contradict would only mislead it
            handed.append((good[(p[good] >= SURE) & (other[good] >= 0.5)],
                           bad[(p[bad] <= 1 - SURE) & (other[bad] <= SURE)]))
        for me, (good, bad) in ((1, handed[0]), (0, handed[1])):
            x, labels = own[me]
            own[me] = (np.vstack([x, pool[me][good], pool[me][bad]]),
                       np.concatenate([labels, np.ones(len(good)), np.zeros(len(bad))]))
        for good, bad in handed:
            free[good] = free[bad] = False
        views = [fit(*o, start=v) for o, v in zip(own, views)]
    calibration = [fit(v.logit(x[held])[:, None], y[held]) for v, x in zip(views, labelled)]
    model = Model(views, calibration, None, share)
    model.combined = fit(model._calibrated([x[held] for x in labelled]), y[held])
    return model


def _rows(docs: DataFrame, id_col: str, text_col: str, meta: tuple[str, str, str],
          extra: list[Column]) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), *extra, F.col(text_col).cast("string").alias("text"),
        *[F.col(c).cast(t).alias(n) for c, t, n in zip(meta, ("string", "string", "long"),
                                                       ("source", "lang", "chars"))])


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Both views of a batch that ends in text, source, lang, chars."""
    text, source, lang, chars = (batch.column(i).to_pylist() for i in range(-4, 0))
    return text_view([t or "" for t in text]), page_view(text, source, lang, chars)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (doc_id, label, ...) -> (label, text view, page view)."""
    for batch in batches:
        views = [[r.tobytes() for r in v] for v in _views(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), *[pa.array(v, pa.binary()) for v in views]],
            names=["label", "text_view", "page_view"])


META = ("source", "lang", "n_chars")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          meta: tuple[str, str, str] = META, label_col: str = "quality") -> Model:
    """Fit on ``labels`` (doc_id, 0 or 1) and unlabelled rows of ``docs``."""
    spark = prepare(docs.sparkSession)
    stage = Stage(spark, "quality")
    # at most LABELLED ids: bounded, so they may be broadcast
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")
                          ).where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").select(
        "doc_id", "label")
    marks = first_by_hash(marks, "doc_id", LABELLED, labels.count())
    share = int(min(1.0, POOL / max(1, docs.count())) * _DRAWS)
    rows = _rows(docs, id_col, text_col, meta, [])
    tail = ["text", "source", "lang", "chars"]
    labelled = rows.join(F.broadcast(marks), "doc_id").select("doc_id", "label", *tail)
    pool = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(_DRAWS)) < share).select(
        "doc_id", F.lit(-1).alias("label"), *tail)
    sample = stage.write(labelled.unionByName(pool).mapInArrow(
        _featured, "label int, text_view binary, page_view binary"), "sample")
    got = sample.toArrow()
    kinds = got.column("label").to_numpy()
    views = [np.frombuffer(b"".join(got.column(c).to_pylist()), np.float32).reshape(len(kinds), d)
             for c, d in (("text_view", TEXT_DIM), ("page_view", PAGE_DIM))]
    # the same order at any parallelism
    order = np.lexsort((views[1][:, 5], views[1][:, 3], views[0][:, :CLASSES].sum(1), kinds))
    views, kinds = [v[order] for v in views], kinds[order]
    known = kinds >= 0
    stage.release(sample)
    return co_train([v[known] for v in views], kinds[known].astype(float), [v[~known] for v in views])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          meta: tuple[str, str, str] = META) -> DataFrame:
    """doc_id, score (of being good), predicted for every row of ``docs``."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.score(*_views(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p.astype(np.float64)),
                 pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    rows = _rows(docs, id_col, text_col, meta, [])
    return rows.mapInArrow(run, extended(rows.select("doc_id").schema,
                                         "score double, predicted int"))


def training_rows(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return rows.where(fold(F.col(id_col), 5) != 0)
