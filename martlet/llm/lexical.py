"""Ranked lexical search by dense blocked matrix products.

1. The items (the query texts) are dealt into blocks of at most ``ITEM_BYTES`` of
   text; a block's vocabulary is what a task has to hold of them.
2. One pass over the documents cuts every whole text into terms and keeps, of each
   document, its length and its counts of the block's terms. From that staged table
   come the corpus figures: documents with terms, all their terms, and in how many
   documents each term of the block stands.
3. Items are grouped into tiles whose joint vocabulary fits ``WIDTH`` columns (a longer
   item takes several column tiles). Tasks turn batches of documents into dense tiles
   of impacts and multiply them with the tiles of item weights in float64. A weight is
   split into digits below 2^22 and an impact lies below 2^20, so the sum of ``WIDTH`` =
   2^11 products stays below 2^53 and is exact; the digits are added up in 64-bit integers.
4. A task keeps each item's best rows so far. A row enters when its score reaches the
   last one kept, so that of equal scores the smaller ids win wherever they stand. The
   tasks' rows are ranked in two steps, by item and salt and then by item.

Terms, weights and impacts are those of the contract of the registered query: terms are
runs of ASCII letters and digits and of all other characters outside ASCII, and only A-Z
is lower-cased.

Defined cases: null texts have no terms; documents without terms are no documents of the
statistics and are never found; every row is a document of its own, also with a repeated or
a null id (null ids come last among equal scores); of several rows with one item id the
least text is the item; an item without terms, or of which no document has one, returns
nothing; empty tables give an empty result; other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import Stage, prepare, whole_text

ITEM_BYTES = 512 * 1024  # text of one block of items
WIDTH = 1 << 11  # columns of a tile
DIGIT = 22  # bits of a weight's digits
TILE_ITEMS = 256
SALTS = 64

_KEPT = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included."""
    return raw.translate(_TERMS).split()


@dataclass(frozen=True)
class Block:
    """Items of one pass: ids, and the counts of their terms as (item, term, count)."""

    ids: list[int | None]
    vocabulary: dict[bytes, int]
    counts: np.ndarray  # (entries, 3) int64, by item

    @staticmethod
    def of(rows: list[tuple[int | None, str]]) -> Block:
        vocabulary: dict[bytes, int] = {}
        counts = [(i, vocabulary.setdefault(term, len(vocabulary)), n)
                  for i, (_, text) in enumerate(rows)
                  for term, n in Counter(terms(text.encode())).items()]
        return Block([r[0] for r in rows], vocabulary,
                     np.array(counts, np.int64).reshape(-1, 3))


@dataclass(frozen=True)
class Tile:
    """Some items, one run of their columns, and the weights as digits."""

    items: np.ndarray
    columns: np.ndarray
    entries: np.ndarray  # (row, column, weight)

    def digits(self) -> list[np.ndarray]:
        out, rest = [], self.entries[:, 2].copy()
        while rest.any() or not out:
            dense = np.zeros((len(self.items), len(self.columns)))
            dense[self.entries[:, 0], self.entries[:, 1]] = rest & ((1 << DIGIT) - 1)
            out.append(dense)
            rest >>= DIGIT
        return out


def _tiles(block: Block, weights: np.ndarray) -> list[list[Tile]]:
    """Groups of items, each with the tiles of its columns."""
    starts = np.searchsorted(block.counts[:, 0], np.arange(len(block.ids) + 1))
    groups, now, columns = [], [], set()
    for item in range(len(block.ids)):
        own = set(block.counts[starts[item]:starts[item + 1], 1].tolist())
        if not own:
            continue
        if now and (len(columns | own) > WIDTH or len(now) == TILE_ITEMS):
            groups.append((now, columns))
            now, columns = [], set()
        now, columns = [*now, item], columns | own
    groups += [(now, columns)] if now else []
    out = []
    for items, columns in groups:
        rows, all_columns = np.array(items), np.array(sorted(columns))
        entries = block.counts[np.isin(block.counts[:, 0], rows)]
        tiles = []
        for at in range(0, len(all_columns), WIDTH):
            part = all_columns[at:at + WIDTH]
            own = entries[np.isin(entries[:, 1], part)]
            tiles.append(Tile(rows, part, np.stack([
                np.searchsorted(rows, own[:, 0]), np.searchsorted(part, own[:, 1]),
                own[:, 2] * weights[own[:, 1]]], axis=1)))
        out.append(tiles)
    return out


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of at most ITEM_BYTES of text, or of one item."""
    hashed = items.withColumn("h", F.xxhash64("item_id", "text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    modulus = 1 << max(0, math.ceil(math.log2(max(1, total) / ITEM_BYTES)))
    todo = [(modulus, r) for r in range(modulus)]
    while todo:
        modulus, r = todo.pop()
        block = hashed.where(F.pmod("h", F.lit(modulus)) == r)
        n, size = block.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
        if n > 1 and size > ITEM_BYTES:
            todo += [(2 * modulus, r), (2 * modulus, r + modulus)]
        elif n:
            yield [(i, t) for i, t in block.select("item_id", "text").collect()]


def _counted(vocabulary: dict[bytes, int]):
    """mapInArrow: (doc_id, text) -> (doc_id, n, terms, counts) of documents with terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(),
                                batch.column(1).cast(pa.binary()).to_pylist()):
                words = terms(raw or b"")
                if words:
                    found = np.array(list(map(get, words, repeat(-1))), np.int32)
                    own, counts = np.unique(found[found >= 0], return_counts=True)
                    rows.append((doc, len(words), own.astype("<i4").tobytes(),
                                 counts.astype("<i8").tobytes()))
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                names=["doc_id", "n", "terms", "counts"])

    return run


def _figures(size: int):
    """mapInArrow: (n, terms) -> (what, amount): documents holding each term; at ``size``
    the documents, at ``size`` + 1 all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, np.int64)
        for batch in batches:
            total[size] += len(batch)
            total[size + 1] += int(np.sum(batch.column(0).to_numpy(zero_copy_only=False)))
            own = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4")
            total[:size] += np.bincount(own, minlength=size)[:size]
        what = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(what), pa.array(total[what])],
                                         names=["what", "amount"])

    return run


class _Best:
    """The ``k`` best rows of each item of a tile seen so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)  # a row must reach this
        self.rows = [(np.zeros(0, np.int64),) * 3 for _ in range(items)]  # -score, null id, id

    def add(self, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        reach = scores >= self.least[:, None]
        for i in np.flatnonzero(reach.any(axis=1)):
            new = np.flatnonzero(reach[i])
            parts = [np.concatenate(x) for x in zip(
                self.rows[i], (-scores[i, new], missing[new], ids[new]))]
            first = np.lexsort(parts[::-1])[:self.k]
            self.rows[i] = tuple(p[first] for p in parts)
            if len(first) == self.k:
                self.least[i] = -self.rows[i][0][-1]


def _searched(block: Block, groups: list[list[Tile]], documents: int, length: int, k: int):
    """mapInArrow: (doc_id, n, terms, counts) -> (item_id, doc_id, score), the task's best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [[t.digits() for t in tiles] for tiles in groups]
        best = [_Best(len(tiles[0].items), k) for tiles in groups]
        for batch in batches:
            docs, ns, owns, counts = batch.columns
            missing = np.array([not d.is_valid for d in docs], np.int64)
            ids = docs.fill_null(0).to_numpy(zero_copy_only=False)
            m = np.array([75 + 25 * n * documents // length for n in ns.to_pylist()], np.int64)
            owns = owns.to_pylist()
            of = np.repeat(np.arange(len(docs)), [len(x) // 4 for x in owns])
            own = np.frombuffer(b"".join(owns), "<i4")
            tf = np.frombuffer(b"".join(counts.to_pylist()), "<i8")
            order = np.argsort(own, kind="stable")
            impact = ((1_000_000_000 * tf) // (1000 * tf + 12 * m[of]))[order].astype(float)
            own, of = own[order], of[order]
            for tiles, digits, top in zip(groups, weights, best):
                scores = np.zeros((len(tiles[0].items), len(docs)), np.int64)
                for tile, dense in zip(tiles, digits):
                    lo = np.searchsorted(own, tile.columns)
                    n = np.searchsorted(own, tile.columns, "right") - lo
                    column = np.repeat(np.arange(len(lo)), n)
                    at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
                    impacts = np.zeros((len(tile.columns), len(docs)))
                    impacts[column, of[at]] = impact[at]
                    for d, digit in enumerate(dense):
                        scores += (digit @ impacts).astype(np.int64) << (DIGIT * d)
                top.add(scores, missing, ids)
        out: list[tuple] = []
        for tiles, top in zip(groups, best):
            for item, (scores, missing, ids) in zip(tiles[0].items, top.rows):
                out += [(block.ids[item], None if gone else i, -s) for s, gone, i in zip(
                    scores.tolist(), missing.tolist(), ids.tolist())]
        columns = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         names=["item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id",
           item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents of the whole table."""
    spark = prepare(docs.sparkSession)
    stage = Stage(spark, "lexical")
    asked = stage.write(items.select(
        F.col(item_id).cast("long").alias("item_id"), whole_text(F.col(text)).alias("text"),
    ).groupBy("item_id").agg(F.min("text").alias("text")), "items")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                        F.col(text).cast("string").alias("text"))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for rows in _item_blocks(asked):
        block = Block.of(rows)
        size = len(block.vocabulary)
        counted = stage.write(texts.mapInArrow(
            _counted(block.vocabulary), "doc_id long, n long, terms binary, counts binary"), "counted")
        # one row a term of the block: bounded by ITEM_BYTES
        figures = {w: int(a) for w, a in counted.select("n", "terms").mapInArrow(
            _figures(size), "what long, amount long").groupBy("what").agg(F.sum("amount")).collect()}
        documents, length = figures.get(size, 0), figures.get(size + 1, 0)
        weights = np.array([math.floor(1000 * math.log(
            (2 * documents + 2) / (2 * figures.get(t, 0) + 1))) for t in range(size)], np.int64)
        best = stage.write(counted.mapInArrow(
            _searched(block, _tiles(block, weights), documents, length, k),
            found.schema).withColumn("salt", F.spark_partition_id() % SALTS), "best")
        stage.release(counted)
        found = found.unionByName(_first(best, ["item_id", "salt"], k).drop("salt", "rank"))
    return _first(found, ["item_id"], k).select("item_id", "rank", "doc_id", "score")


def _first(rows: DataFrame, key: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
