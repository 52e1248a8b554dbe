"""Packing by concatenation and cutting: documents end to end, cut into windows of one length.

Pass one encodes each document once and writes, per task, the ids and the running number of tokens within the task.
The tasks' totals are summed up to offsets in two levels, so a document's global place is its task's offset plus its
place in the task; no document moves between machines. Pass two cuts what lies on a window's edge. Each window is full but
the last, so nothing but that one is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from parcelmart.llm.common import ROW_BYTES, running_offsets, stored, table, text_batches
from parcelmart.llm.tokens import ID_TYPE, public_path, word_tokenizer

SEQUENCE = 2048
END_ID = 1
TOKENIZED = "doc_id bigint, task bigint, place bigint, doc_tokens bigint, ids binary"
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, continued boolean, continues boolean, sequence_tokens bigint, padded_to bigint"
)


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def padded_length(tokens: int, sequence: int = SEQUENCE) -> int:
    """Length a window of so many tokens is padded to: the full length, except that a power of two stays as it is."""
    return tokens if tokens & (tokens - 1) == 0 else sequence


def tokenized(docs: DataFrame, path: str, end_id: int | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its ids (little-endian unsigned, 16 bits where the vocabulary allows), its scan task and
    the number of tokens before it in that task. A NULL text counts as empty; ``end_id`` (if any) is put at the end."""
    schema = to_arrow_schema(schema_of(TOKENIZED))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, place, tokenizer = TaskContext.get().partitionId(), 0, word_tokenizer(path)
        tail = b"" if end_id is None else np.array([end_id], tokenizer.type).tobytes()
        for batch in text_batches(batches, ROW_BYTES):
            encoded = [ids + tail for ids in tokenizer.encode_all(batch.column(1).to_pylist())]
            sizes = np.array([len(ids) // tokenizer.type.itemsize for ids in encoded], np.int64)
            places = place + np.cumsum(sizes) - sizes
            place += int(sizes.sum())
            columns = [batch.column(0), np.full(len(sizes), task), places, sizes, encoded]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(encode, TOKENIZED)


def cut(encoded: DataFrame, path: str, total: int, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of documents that know their global start (``first``), one row per piece."""
    ddl = PIECES + (", ids binary" if with_ids else "")
    schema = to_arrow_schema(schema_of(ddl))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        narrow = word_tokenizer(path).type
        for batch in text_batches(batches, ROW_BYTES):
            rows = []
            for doc_id, first, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = np.frombuffer(raw, narrow).astype(ID_TYPE)
                start, size = 0, len(ids)
                while start < size:
                    window, offset = divmod(first + start, sequence)
                    length = min(size - start, sequence - offset)
                    held = min(sequence, total - window * sequence)
                    piece = ids[start : start + length].tobytes()
                    row = (doc_id, start, length, zlib.crc32(piece), size, window, offset, start > 0, start + length < size)
                    rows.append((*row, held, padded_length(held, sequence), *([piece] if with_ids else [])))
                    start += length
            columns = list(zip(*rows)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return encoded.select("doc_id", "first", "ids").mapInArrow(pieces, ddl)


def pack(
    docs: DataFrame,
    path: str,
    end_id: int | None = END_ID,
    sequence: int = SEQUENCE,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Documents packed into windows of ``sequence`` tokens; one row per piece of a document.

    ``start`` counts the document's tokens before the piece, ``offset`` the window's. ``continued`` and ``continues``
    are the boundary records: the document began in an earlier window, or goes on in the next. ``sequence_tokens`` and
    ``padded_to`` give a window's filling and padded length; ``with_ids`` adds the ids (little-endian unsigned 32 bits).

    Order follows the scan of the input. A NULL or empty text is its end mark alone (nothing without ``end_id``); rows
    are never merged, so repeated rows and NULL ids are packed as they stand. Other columns are not read.
    """
    encoded = stored(tokenized(docs, path, end_id, doc_id, text), "tokens")
    totals = encoded.groupBy("task").agg(F.sum("doc_tokens").alias("tokens"))
    offsets = stored(running_offsets(totals, "task", "tokens", "before"), "offsets")
    total = encoded.agg(F.coalesce(F.sum("doc_tokens"), F.lit(0)).alias("n")).first()["n"]
    # One row per task of the scan: a few bytes for each 128 MB of input.
    placed = encoded.join(F.broadcast(offsets), "task").withColumn("first", F.col("before") + F.col("place"))
    return cut(placed, path, total, sequence, with_ids)


def op8_concat_and_cut(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))
