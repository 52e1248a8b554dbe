"""Exact top-k search by inner product with MaxScore.

The terms of a query are the dimensions with their weights, the posting list of a dimension is its column in a block of
rows. Within a block each term of a query has a bound: the most it can add to any row's score. Terms with the lowest
bounds are non-essential as long as their bounds together stay below a share of the query's threshold, which is its k-th
best score so far. All rows are scored on the essential terms; the other terms are probed only for rows whose partial
score plus the bounds still left beats the threshold.

Rows are numbered and dealt into cells, one per chunk of rows and block of queries. A cell holds its queries, their best
rows so far and one block of rows at a time, however many rows stream through it. The best of all cells are merged last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from parcelmart.llm.common import running_offsets, stored, table

# Queries of a cell, and those scored together; rows of a cell at most and at least; rows of a block, the first and later.
QUERY_ROWS = 4096
QUERY_BATCH = 512
MOST_ROWS, LEAST_ROWS = 4_000_000, 2048
FIRST_BLOCK, BLOCK_ROWS = 256, 4096
# Share of the threshold that non-essential terms may hold together, and steps in which they are probed.
SHARE = 0.5
STEPS = 3
LONG = 2**63 - 1
QUANTISED = "vec_id bigint, task bigint, place bigint, is_query boolean, query_place bigint, wide boolean, vec binary"
BEST = "query bigint, query_id bigint, vec_id bigint, row bigint, score bigint"


def quantised(vectors: DataFrame, is_query: Column, scale: float, vec_id: str, embedding: str) -> DataFrame:
    """Rows with whole-number components ``floor(scale * x)`` (16 bits each where they fit, else doubles) and their
    places in their task, among all rows and among queries. Rows with a NULL or non-finite component are left out."""
    schema = to_arrow_schema(_parse_datatype_string(QUANTISED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, place, asked = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            rows = []
            for key, vector, query in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if not vector.is_valid or vector.values.null_count:
                    continue
                with np.errstate(over="ignore"):
                    whole = np.floor(scale * vector.values.to_numpy(zero_copy_only=False))
                if not np.isfinite(whole).all():
                    continue
                wide = bool(len(whole)) and float(np.abs(whole).max()) > 32767
                raw = whole.astype("<f8" if wide else "<i2").tobytes()
                rows.append((key, task, place, query, asked, wide, raw))
                place, asked = place + 1, asked + query
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    query = F.coalesce(is_query, F.lit(False)).alias("is_query")
    # The components are doubles before they are scaled, whatever their type.
    source = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec"), query
    )
    return source.mapInArrow(run, QUANTISED)


def matrix(raws: list[bytes], wides: list[bool], width: int) -> np.ndarray:
    """Vectors as rows of doubles; a component past a vector's end is no term, so zero."""
    out = np.zeros((len(raws), width))
    for i, (raw, wide) in enumerate(zip(raws, wides)):
        values = np.frombuffer(raw, "<f8" if wide else "<i2")
        out[i, : len(values)] = values
    return out


class Search:
    """The best ``k`` rows of each query among the rows seen so far; rows come by ascending id."""

    def __init__(self, numbers, ids, vectors: np.ndarray, k: int) -> None:
        self.numbers, self.ids, self.vectors, self.k = np.asarray(numbers, np.int64), ids, vectors, k
        n = len(ids)
        self.scores = np.full((n, k), -np.inf)
        self.rows = np.full((n, k), -1, np.int64)
        self.keys: dict[int, int | None] = {}
        self.probed = 0

    def add(self, keys: list, rows: np.ndarray, block: np.ndarray) -> None:
        """Score a block of rows against all queries."""
        width = max(block.shape[1], self.vectors.shape[1])
        block, queries = widened(block, width), widened(self.vectors, width)
        self.vectors = queries
        reach = float(np.abs(queries).max(initial=0)) * float(np.abs(block).max(initial=0)) * max(width, 1)
        kind = np.float32 if reach < 2**24 else np.float64 if reach < 2**53 else object
        if kind is object:
            block, queries = whole_numbers(block), whole_numbers(queries)
        else:
            block, queries = block.astype(kind), queries.astype(kind)
        low, high = block.min(axis=0), block.max(axis=0)
        for start in range(0, len(queries), QUERY_BATCH):
            part = slice(start, start + QUERY_BATCH)
            at, place, score = self.competitive(queries[part], block, np.maximum(queries[part] * low, queries[part] * high), part)
            other = self.numbers[part][at] != rows[place]
            self.merge(start, at[other], rows[place[other]], score[other])
        held = set(self.rows.ravel().tolist())
        self.keys = {r: key for r, key in self.keys.items() if r in held}
        self.keys |= {int(r): key for r, key in zip(rows, keys) if int(r) in held}

    def competitive(self, queries, block, bounds, part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of all pairs that beat the query's threshold. A tie does not: earlier ids go first."""
        floor = self.scores[part, -1]
        order = np.argsort(bounds, axis=1, kind="stable")
        left = np.cumsum(np.take_along_axis(bounds, order, axis=1), axis=1)
        # Non-essential: the longest run of lowest bounds within the share. None while there is no threshold.
        allowed = np.where(np.isfinite(floor), np.minimum(floor, floor * SHARE), -np.inf)
        n_other = (np.maximum.accumulate(left, axis=1) <= allowed[:, None]).sum(axis=1)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), axis=1)
        partial = np.where(rank >= n_other[:, None], queries, 0 * queries) @ block.T
        rest = np.where(n_other > 0, np.take_along_axis(left, np.maximum(n_other - 1, 0)[:, None], 1)[:, 0], 0) if order.shape[1] else 0 * floor
        at, place = np.nonzero((partial + rest[:, None]) > floor[:, None])
        score = partial[at, place]
        # The other terms, the highest bounds first, for what is still competitive.
        for step in range(STEPS, 0, -1):
            low, high = (n_other * (step - 1)) // STEPS, (n_other * step) // STEPS
            mask = (rank >= low[:, None]) & (rank < high[:, None])
            for begin in range(0, len(at), 1 << 16):
                cut = slice(begin, begin + (1 << 16))
                weights = np.where(mask[at[cut]], queries[at[cut]], 0)
                score[cut] += (weights * block[place[cut]]).sum(axis=1)
            self.probed += len(at)
            rest = np.where(low > 0, np.take_along_axis(left, np.maximum(low - 1, 0)[:, None], 1)[:, 0], 0) if order.shape[1] else 0 * floor
            still = score + rest[at] > floor[at]
            at, place, score = at[still], place[still], score[still]
        return at, place, score

    def merge(self, start: int, at: np.ndarray, rows: np.ndarray, score: np.ndarray) -> None:
        """Keep the best of old and new; the sort is stable, so among equal scores what came first stays first."""
        if not len(at):
            return
        hit = np.unique(at)
        owner = np.concatenate([np.repeat(hit, self.k), at])
        scores = np.concatenate([self.scores[start + hit].ravel(), score.astype(float) if score.dtype != object else score])
        found = np.concatenate([self.rows[start + hit].ravel(), rows])
        order = np.argsort(-scores, kind="stable")
        order = order[np.argsort(owner[order], kind="stable")]
        first = np.searchsorted(owner[order], hit)
        best = order[(first[:, None] + np.arange(self.k))]
        if scores.dtype == object and self.scores.dtype != object:
            self.scores = self.scores.astype(object)
        self.scores[start + hit], self.rows[start + hit] = scores[best], found[best]

    def results(self) -> list[tuple]:
        return [
            (int(self.numbers[i]), self.ids[i], self.keys[int(r)], int(r), max(-LONG - 1, min(LONG, int(s))))
            for i in range(len(self.ids))
            for s, r in zip(self.scores[i], self.rows[i])
            if r >= 0
        ]


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) if rows.shape[1] < width else rows


def whole_numbers(rows: np.ndarray) -> np.ndarray:
    """Python integers, for components whose products leave the exact range of doubles."""
    return np.array([[int(x) for x in row] for row in rows], object).reshape(rows.shape)


def search_cells(cells: DataFrame, k: int) -> DataFrame:
    """The best rows of each query within each cell; ``cells`` has the queries of a cell before its rows, by id."""
    schema = to_arrow_schema(_parse_datatype_string(BEST))

    def emit(search: Search | None) -> Iterator[pa.RecordBatch]:
        if search is not None and (found := search.results()):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*found), schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asked, search, size = None, [], None, FIRST_BLOCK
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                if numbers[start] != cell:
                    yield from emit(search)
                    cell, asked, search, size = numbers[start], [], None, FIRST_BLOCK
                part = batch.slice(start, stop - start)
                is_row = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                n_asked = int((~is_row).sum())
                columns = [c.to_pylist() for c in part.columns[2:]]
                asked += list(zip(*(c[:n_asked] for c in columns)))
                begin = n_asked
                while begin < len(is_row):
                    if search is None:
                        ids, rows, wides, raws = zip(*asked) if asked else ((), (), (), ())
                        search = Search(rows, ids, matrix(raws, wides, longest(raws, wides)), k)
                        asked = []
                    ids, rows, wides, raws = (c[begin : begin + size] for c in columns)
                    search.add(ids, np.array(rows, np.int64), matrix(raws, wides, longest(raws, wides)))
                    begin, size = begin + size, min(2 * size, BLOCK_ROWS)
        yield from emit(search)

    return cells.select("cell", "is_row", "vec_id", "row", "wide", "vec").mapInArrow(run, BEST)


def longest(raws, wides) -> int:
    return max((len(r) // (8 if w else 2) for r, w in zip(raws, wides)), default=0)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` rows with the highest inner product for each row for which ``is_query`` holds, the row itself excepted:
    query_id, rank (from 1), vec_id, score.

    Components become ``floor(scale * x)``. Ties go to the smaller id, NULL ids last. A row whose vector is NULL or holds a NULL or
    non-finite component takes no part; an empty vector scores 0, and so does each component one of two vectors lacks.
    A repeated id is several rows: each is a candidate for the others, and each is a query of its own. Scores beyond 64
    bits are given as the nearest 64-bit number. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, is_query, scale, vec_id, embedding), "quantised")
    per_task = rows.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("n_asked"))
    before = running_offsets(per_task, "task", "n", "rows_before")
    asked_before = running_offsets(per_task, "task", "n_asked", "asked_before")
    # One row per task of the scan.
    numbered = rows.join(F.broadcast(before), "task").join(F.broadcast(asked_before), "task")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    parallel = spark.sparkContext.defaultParallelism
    chunk_rows = min(MOST_ROWS, max(LEAST_ROWS, -(-n // (2 * parallel))))
    chunks, blocks = max(1, -(-n // chunk_rows)), max(1, -(-asked // QUERY_ROWS))
    row = (F.col("rows_before") + F.col("place")).alias("row")
    placed = numbered.select(
        "vec_id", row, "is_query", (F.col("asked_before") + F.col("query_place")).alias("number"), "wide", "vec"
    )
    # Evenly filled chunks and blocks; each row meets each block of queries once.
    spread = lambda number, parts, total: F.floor(number * parts / max(total, 1))
    all_of = lambda parts: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint")))
    queries = placed.filter("is_query").select(
        "*", spread(F.col("number"), blocks, asked).alias("block"), all_of(chunks).alias("chunk"), F.lit(False).alias("is_row")
    )
    found = placed.select(
        "*", all_of(blocks).alias("block"), spread(F.col("row"), chunks, n).alias("chunk"), F.lit(True).alias("is_row")
    )
    cells = found.unionByName(queries).withColumn("cell", F.col("block") * chunks + F.col("chunk"))
    dealt = cells.repartitionById(chunks * blocks, F.col("cell").cast("int"))
    ordered = dealt.sortWithinPartitions("cell", "is_row", F.col("vec_id").asc_nulls_last(), "row")
    best = search_cells(ordered, k)
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    ranked = best.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op13_maxscore(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


# floor(64 * x) of a single-precision x is exact as a double.
OP13_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
