"""SentencePiece encoding and decoding of documents (``piece_model``).

Each task rebuilds the model once from its file and encodes its texts in
batches; every whole text is checked against the SentencePiece library (the
same ids) and against its own decoding. Row by row, nothing is shuffled.

Defined cases: null and empty texts have no ids (and are equal to their
decoding); repeated rows get equal results; an empty table gives an empty
result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import extended, prepare
from martlet.llm.piece_model import Backend

_loaded: dict[str, tuple] = {}


def load(path: str) -> tuple:
    """(backend, the library's processor) of a model file, once a worker."""
    if path not in _loaded:
        import sentencepiece

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")  # batches are multithreaded
        with open(path, "rb") as f:
            _loaded[path] = (Backend(f.read()),
                             sentencepiece.SentencePieceProcessor(model_file=path))
    return _loaded[path]


def _lists(ids: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat.astype(np.int32)))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of little-endian unsigned 32-bit ids), parity (the
    library gives the same ids), round_trip (they decode to the normalised text) and,
    unless left out, ids."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend, library = load(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = backend.encode(texts)
            same = [a.tolist() == b for a, b in zip(ids, library.encode(texts, num_threads=1))]
            back = [t == x or backend.normalise(t) == backend.normalise(x)
                    for t, x in zip(texts, backend.decode(ids))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, ids), pa.int64()),
                 pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                 pa.array(same, pa.bool_()), pa.array(back, pa.bool_()),
                 *([_lists(ids)] if with_ids else [])],
                names=["doc_id", "n_ids", "ids_crc32", "parity", "round_trip",
                       *(["ids"] if with_ids else [])])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, extended(
        rows.drop("text").schema, "n_ids long, ids_crc32 long, parity boolean, round_trip boolean"
        + (", ids array<int>" if with_ids else "")))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text of (doc_id, ids); null ids are an empty text."""
    prepare(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend, _ = load(model)
        for batch in batches:
            texts = backend.decode([np.array(i or [], np.int64) for i in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, extended(rows.drop("ids").schema, "text string"))
