"""Helpers shared by the operators: tables, stored intermediate results, running offsets."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from functools import lru_cache, wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelmart.session import fresh_dir

# Rows per block of the second level of a running sum.
BLOCK = 4096
# Bytes a batch of whole rows may hold that goes to Python and back.
ROW_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written to the shared work folder and read back.

    It cuts the lineage: a lost executor costs a re-read, and rows that depend on task order are fixed once written.
    The files stay until the folder is emptied, since the frame that is returned is read lazily.
    """
    path = fresh_dir(df.sparkSession, f"llm-{name}")
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_offsets(totals: DataFrame, key: str, size: str, offset: str) -> DataFrame:
    """``key`` and the sum of ``size`` over all smaller keys; ``key`` holds whole numbers from 0, each at most once.

    Two levels: sums within blocks of neighbouring keys in parallel, then over the blocks. Meant for one row per task
    of an earlier stage, so that the second level sees one row per ``BLOCK`` tasks.
    """
    block = F.floor(F.col(key) / BLOCK)
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy(block.alias("_block")).agg(F.sum(size).alias("_sum"))
    starts = blocks.select("_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    rows = totals.select(key, size, block.alias("_block"))
    summed = rows.select(key, "_block", F.coalesce(F.sum(size).over(inside), F.lit(0)).alias("_inside"))
    return summed.join(starts, "_block").select(key, (F.col("_start") + F.col("_inside")).cast("bigint").alias(offset))


def text_batches(batches: Iterator[pa.RecordBatch], max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the columns of each hold about ``max_bytes``, one row at least."""
    for batch in batches:
        if batch.num_rows:
            step = max(1, batch.num_rows * max_bytes // max(1, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                yield batch.slice(start, step)


@lru_cache(maxsize=None)
def _shipped(context) -> None:
    folder = tempfile.mkdtemp(prefix="parcelmart-")
    root = Path(__file__).resolve().parents[2]
    context.addPyFile(shutil.make_archive(f"{folder}/parcelmart-code", "zip", root, "parcelmart"))


def with_code(query):
    """``query`` with this package's code sent to the executors, for clusters whose workers do not have it installed."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _shipped(spark.sparkContext)
        return query(spark, sf_dir)

    return run
