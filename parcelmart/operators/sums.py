"""Sums of facts kept per month and key, and facts replaced by them where they tell enough."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.numeric import MONEY_SUM
from parcelmart.sources.warehouse import SUMS, Warehouse


def summed(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Amount, quantity and number of facts per ``keys``."""
    return facts.groupBy(*keys).agg(
        F.sum("total_price").cast(MONEY_SUM).alias("total_price"),
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.count(F.lit(1)).alias("items"),
    )


def facts_or_sums(wh: Warehouse, *keys: str) -> DataFrame:
    """The facts, or kept sums of them per at least ``keys``; either way with amount, quantity and ``items`` to add up."""
    kept = [name for name, columns in SUMS.items() if wh.has_sums(name) and set(keys) <= set(columns)]
    if kept:
        return wh[min(kept, key=lambda name: len(SUMS[name]))]
    return wh["fact_orders"].withColumn("items", F.lit(1).cast("bigint"))


def monthly_sums(wh: Warehouse, name: str, year: int | None = None, month: int | None = None) -> tuple[DataFrame, list] | None:
    """Kept sums with the columns ``year`` and ``month`` of their delivery, of one year or month if asked for, and the
    dimensions still to be joined for that: none. None where the sums are not kept.

    Every delivery day of a stored warehouse is in its date dimension, so only facts without a day have to be left out.
    """
    if not wh.has_sums(name):
        return None
    rows, at = wh[name], F.col("delivery_month")
    rows = rows.filter(at > 0 if year is None else at.between(year * 100, year * 100 + 99))
    if month is not None:
        rows = rows.filter(at % 100 == month)
    return rows.withColumns({"year": F.floor(at / 100).cast("int"), "month": (at % 100).cast("int")}), []
