"""Which months an order's facts lie in, kept in buckets of orders, so a load finds and rewrites only what it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.sources.warehouse import Part, delivery_month, read_parts

# Facts a bucket stands for on average; the number of buckets is a power of two.
FACTS_PER_BUCKET = 4_000_000


def buckets_for(facts: int) -> int:
    """Number of buckets for so many facts."""
    return 1 << max(0, -(-facts // FACTS_PER_BUCKET) - 1).bit_length()


def bucket_of(buckets: int, key: str = "order_id") -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(buckets)).cast("int").alias("bucket")


def months_of_orders(facts: DataFrame) -> DataFrame:
    """Order, delivery month and newest change date of facts that carry ``updated_at``; a huge order is one row per task
    before anything is shuffled."""
    rows = facts.select("order_id", delivery_month(), F.col("updated_at").alias("changed"))
    return rows.groupBy("order_id", "delivery_month").agg(F.max("changed").alias("changed"))


def parts_with(parts: Sequence[Part], rows: DataFrame, buckets: int, key: str = "order_id") -> list[Part]:
    """The parts of a table in buckets that can hold any key of ``rows``."""
    if not parts:
        return []
    hit = {r["bucket"] for r in rows.select(bucket_of(buckets, key)).distinct().collect()}  # at most one row per bucket
    return [p for p in parts if p.piece in hit]


def months_with(spark: SparkSession, path: str, index: Sequence[Part], orders: DataFrame, buckets: int) -> set[int]:
    """Months the orders have facts in, read from their buckets alone."""
    known = read_parts(spark, path, "order_index", parts_with(index, orders, buckets))
    months = known.join(orders, "order_id", "left_semi").select("delivery_month").dropna().distinct()
    return {r["delivery_month"] for r in months.collect()}  # at most one row per calendar month
