"""Token ids as packed matrices: best-fit-decreasing packing with a segment tree over capacities.

Every scan task takes its documents in blocks, sorts their lengths in falling order and puts each into the row with the least
room that still fits; a segment tree over the possible capacities finds that row in a few steps. A document longer than a row
is cut into full rows and a rest, so no id is lost. Rows are written as fixed-width binary, with the cumulative lengths
of their segments and the places where positions start anew. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from parcelmart.llm.common import table, text_batches
from parcelmart.llm.packing import END_ID, SEQUENCE
from parcelmart.llm.tokens import public_path, word_tokenizer

BLOCK_BYTES = 16 << 20
PAD_ID = 0
MATRIX = (
    "sequence_id bigint, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, doc_starts array<bigint>"
)


class CapacityTree:
    """Open rows by their room, 1 to ``most``; finds the least room of at least a length."""

    def __init__(self, most: int) -> None:
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, row: int) -> None:
        if room <= 0:
            return
        self.rows[room].append(row)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """A row with the least room that fits, taken out; its room and number, or None."""
        node = length + self.size
        if not self.count[node]:
            # Up to the first right neighbour that has rows, then down along its left side.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not self.count[node]:
                    node += 1
        room = node - self.size
        row = self.rows[room].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, row


def best_fit_decreasing(lengths: Sequence[int], row_length: int) -> list[list[tuple[int, int, int]]]:
    """Rows of (item, start, length): items longer than a row fill rows of their own, their rests are packed with the
    others. Equal lengths keep their order; empty items are in no row."""
    rows: list[list[tuple[int, int, int]]] = []
    rests = []
    for item, length in enumerate(lengths):
        full = length // row_length * row_length
        rows += [[(item, start, row_length)] for start in range(0, full, row_length)]
        if length > full:
            rests.append((full - length, item, full))
    tree = CapacityTree(row_length)
    for negative, item, start in sorted(rests):
        length = -negative
        found = tree.take(length)
        room, row = found if found else (row_length, len(rows))
        if not found:
            rows.append([])
        rows[row].append((item, start, length))
        tree.add(room - length, row)
    return rows


def position_ids(cu_seqlens: Sequence[int], row_length: int) -> np.ndarray:
    """Positions of a row, from 0 in each of its segments; padding has 0."""
    out = np.zeros(row_length, np.int32)
    for start, end in zip(cu_seqlens, cu_seqlens[1:]):
        out[start:end] = np.arange(end - start)
    return out


def token_matrix(
    docs: DataFrame,
    path: str,
    end_id: int | None = END_ID,
    row_length: int = SEQUENCE,
    pad_id: int = PAD_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rows of ``row_length`` ids (little-endian unsigned, 16 bits where the vocabulary allows), padded with ``pad_id``.

    ``n_tokens`` counts ids before the padding; ``cu_seqlens`` are the ends of the segments from 0 on, and
    ``position_resets`` where they start; ``doc_ids`` and ``doc_starts`` tell each segment's document and its tokens before
    it. ``sequence_id`` is unique and rises within a task of the scan. A NULL or empty text is its end mark alone
    (nothing without ``end_id``). Repeated rows are packed as they stand, NULL ids kept; other columns are not read.
    """
    schema = to_arrow_schema(_parse_datatype_string(MATRIX))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = word_tokenizer(path)
        narrow = tokenizer.type
        number = TaskContext.get().partitionId() << 33
        tail = b"" if end_id is None else np.array([end_id], narrow).tobytes()
        for batch in text_batches(batches, BLOCK_BYTES):
            names = batch.column(0).to_pylist()
            ids = [np.frombuffer(x + tail, narrow) for x in tokenizer.encode_all(batch.column(1).to_pylist())]
            rows = best_fit_decreasing([len(x) for x in ids], row_length)
            matrix = np.full((len(rows), row_length), pad_id, narrow)
            ends = []
            for k, row in enumerate(rows):
                at, cumulative = 0, [0]
                for item, start, length in row:
                    matrix[k, at : at + length] = ids[item][start : start + length]
                    at += length
                    cumulative.append(at)
                ends.append(cumulative)
            columns = [
                range(number, number + len(rows)),
                [e[-1] for e in ends],
                [row.tobytes() for row in matrix],
                ends,
                [e[:-1] for e in ends],
                [[names[item] for item, _, _ in row] for row in rows],
                [[start for _, start, _ in row] for row in rows],
            ]
            number += len(rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, MATRIX)


def op7_best_fit_matrix(spark, sf_dir: str) -> DataFrame:
    return token_matrix(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))
