"""Packing along a space-filling curve.

1. Every whole text is tokenized once; its token ids are hashed into a vector
   of ``HASHED`` signed counts, scaled to unit length and projected to ``DIMS``
   fixed random directions. Ids and coordinates are written out once.
2. Coordinates are standardised by their corpus means and deviations, laid on
   a grid and turned into a Hilbert key, so that documents of similar wording
   stand close on one line.
3. The light rows (key, id, length) are range-partitioned by key and id: a
   block of equal keys, as of many copies, is split by the id. Each range sums
   up its lengths; the ranges' totals (one small row each) give every document
   its position on the endless line of tokens.
4. The line is cut every ``length`` tokens: neighbours share sequences, and only
   the last sequence of the corpus is not full. Ids meet positions in one join
   on the row.

Defined cases: a null text counts as empty and an empty one has the end token
only; a text longer than a sequence spans several; a null id is packed like
any other; repeated rows are packed each; an empty table gives an empty
result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import Stage, extended, prepare
from martlet.llm.tokens import token_ids

LENGTH = 2048
END_ID = 1
HASHED = 256
DIMS = 4
BITS = 12  # grid cells a dimension: 2**BITS

_SEED = 11


def _projection(vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per id its bucket and sign; per bucket its place in DIMS dimensions."""
    rng = np.random.default_rng(_SEED)
    bucket = rng.integers(0, HASHED, vocabulary)
    sign = rng.choice(np.array([-1.0, 1.0]), vocabulary)
    return bucket, sign, rng.standard_normal((HASHED, DIMS))


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of grid cells [n, dims] (Skilling's transform)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess turns, from the coarsest bit down
        low = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _tokenize(path: str, end_id: int | None):
    """mapInArrow: (row, doc_id, text) -> (row, doc_id, tokens, place, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = token_ids(path)
        bucket, sign, spread = _projection(coder.tokenizer.get_vocab_size())
        end = b"" if end_id is None else np.array([end_id], coder.width).tobytes()
        for batch in batches:
            coded = coder.encode([t or "" for t in batch.column(2).to_pylist()])
            vectors = np.zeros((len(coded), HASHED))
            for i, raw in enumerate(coded):
                ids = np.frombuffer(raw, coder.width)
                vectors[i] = np.bincount(bucket[ids], sign[ids], HASHED)
            norm = np.linalg.norm(vectors, axis=1, keepdims=True)
            place = (vectors / np.maximum(norm, 1e-12)) @ spread
            whole = [raw + end for raw in coded]
            width = np.dtype(coder.width).itemsize
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([len(x) // width for x in whole], pa.int64()),
                 pa.FixedSizeListArray.from_arrays(pa.array(place.ravel()), DIMS).cast(
                     pa.list_(pa.float64())),
                 pa.array(whole, pa.binary())],
                names=["row", "doc_id", "tokens", "place", "ids"])

    return run


def _keys(mean: np.ndarray, deviation: np.ndarray):
    """mapInArrow: (row, doc_id, tokens, place) -> (row, doc_id, tokens, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.array(batch.column(3).to_pylist(), float).reshape(-1, DIMS)
            level = 0.5 * (1 + np.tanh(0.8 * (place - mean) / deviation))  # about even
            cells = np.minimum((level * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(hilbert_key(cells, BITS))],
                names=["row", "doc_id", "tokens", "key"])

    return run


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over one sorted range: (row, tokens, range) -> with the tokens before."""
    before = 0
    for batch in batches:
        tokens = batch.column(1).to_numpy()
        ends = np.cumsum(tokens) + before
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(ends - tokens)], names=["row", "tokens", "range", "before"])
        before = int(ends[-1]) if len(ends) else before


def _cut(width: str, length: int):
    """mapInArrow: (doc_id, ids, position) -> pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, raw, position in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(raw, width).astype("<u4")
                at = 0
                while at < len(ids):
                    offset = (position + at) % length
                    size = min(length - offset, len(ids) - at)
                    piece = ids[at:at + size].tobytes()
                    rows.append((doc, at, size, zlib.crc32(piece), len(ids),
                                 (position + at) // length, offset, piece))
                    at += size
            columns = list(zip(*rows)) or [()] * 8
            kinds = [batch.schema.field(0).type, *[pa.int64()] * 6, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                       "offset", "ids"])

    return run


def curve_order(tokens: DataFrame) -> DataFrame:
    """(row, tokens, range, before) of (row, doc_id, tokens, place), by Hilbert key."""
    spark = tokens.sparkSession
    at = [F.get("place", F.lit(i)) for i in range(DIMS)]
    stats = tokens.agg(*[F.avg(x) for x in at], *[F.stddev_pop(x) for x in at]).first()
    mean = np.array([x or 0.0 for x in stats[:DIMS]])
    deviation = np.array([x or 1.0 for x in stats[DIMS:]])
    slim = tokens.select("row", "doc_id", "tokens", "place")
    keyed = slim.mapInArrow(_keys(mean, deviation), extended(slim.drop("place").schema,
                                                               "key long"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    line = keyed.repartitionByRange(parts, "key", "doc_id", "row").sortWithinPartitions(
        "key", "doc_id", "row").select("row", "tokens", F.spark_partition_id().alias("range"))
    return line.mapInArrow(_running, extended(line.schema, "before long"))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH, end_id: int | None = END_ID) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, ids (little-endian unsigned 32-bit)."""
    spark = prepare(docs.sparkSession)
    stage = Stage(spark, "packing")
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokens = stage.write(rows.mapInArrow(
        _tokenize(tokenizer, end_id), extended(rows.drop("text").schema, (
            "tokens long, place array<double>, ids binary"))), "tokens")
    order = stage.write(curve_order(tokens), "order")
    # one row per range: as many as shuffle partitions, whatever the corpus
    totals = order.groupBy("range").agg(F.sum("tokens").alias("n")).collect()
    offsets, total = {}, 0
    for part, n in sorted((r["range"], r["n"]) for r in totals):
        offsets[part] = total
        total += n
    shift = spark.createDataFrame(list(offsets.items()), "range int, shift long")
    placed = order.join(F.broadcast(shift), "range").select(
        "row", (F.col("before") + F.col("shift")).alias("position"))
    pieces = tokens.select("row", "doc_id", "ids").join(placed, "row").select(
        "doc_id", "ids", "position")
    width = token_ids(tokenizer).width
    kind = rows.schema["doc_id"].dataType.simpleString()
    return pieces.mapInArrow(_cut(width, length), (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, ids binary"))


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, used, ids): each sequence's ids in order. It is padded to
    ``length`` unless what is used is a power of two. A sequence has at most
    ``length`` tokens, so a group is bounded."""
    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), "<u4").astype(np.int64)
        used = len(ids)
        if used & (used - 1):
            ids = np.append(ids, np.full(length - used, pad_id, np.int64))
        return pa.table({"sequence_id": table.column("sequence_id").slice(0, 1).combine_chunks(),
                         "used": pa.array([used]), "ids": pa.array([ids], pa.list_(pa.int64()))})

    return pieces.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(
        join, "sequence_id long, used long, ids array<long>")
