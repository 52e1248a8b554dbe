"""Ranking without a one-task window, and the windows that stay within a bounded group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.functions.numeric import percent_of

# Values that share their upper bits are ranked together: at most 2^20 distinct values per group.
_LOW_BITS = 20


def global_rank(df: DataFrame, measure: str, rank: str = "rank", count: str | None = None) -> DataFrame:
    """``RANK() OVER (ORDER BY measure DESC)`` over all rows, and optionally the number of ranked rows.

    A window without partitions would sort every row in one task. Here the rows are first counted per distinct value,
    then positions are running sums on two levels: over the values' upper bits (for whole numbers >= 0 with sum S there
    are at most sqrt(2 S / 2^20) of them) and, within each of those, over at most 2^20 values. Rows with many ties
    collapse in the first count. ``measure`` must be a whole number and not NULL.
    """
    value, upper = F.col("_value"), F.col("_upper")
    per_value = (
        df.groupBy(F.col(measure).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upper", F.shiftright(value.cast("bigint"), _LOW_BITS))
        .filter(upper.isNotNull())  # stated here, so both uses below share one exchange
    )
    above = Window.orderBy(upper.desc()).rowsBetween(Window.unboundedPreceding, -1)
    per_upper = (
        per_value.groupBy("_upper")
        .agg(F.sum("_n").alias("_m"))
        .select(
            "_upper",
            F.coalesce(F.sum("_m").over(above), F.lit(0)).alias("_before"),
            F.sum("_m").over(Window.partitionBy()).alias("_total"),
        )
    )
    within = Window.partitionBy("_upper").orderBy(value.desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        per_value.withColumn("_earlier", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .join(per_upper, "_upper")
        .select(
            F.col("_value").alias(measure),
            (F.col("_before") + F.col("_earlier") + 1).cast("bigint").alias(rank),
            *([F.col("_total").cast("bigint").alias(count)] if count else []),
        )
    )
    return df.join(ranks, measure)


def percent_rank_pct(df: DataFrame, measure: str, out: str) -> DataFrame:
    """``PERCENT_RANK() OVER (ORDER BY measure DESC) * 100`` rounded to two decimals; 0 for a single row."""
    ranked = global_rank(df, measure, rank="_rank", count="_rows")
    pct = F.coalesce(percent_of(F.col("_rank") - 1, F.col("_rows") - 1), F.lit(0).cast("decimal(38,2)"))
    return ranked.withColumn(out, pct).drop("_rank", "_rows")


def trailing_rows(part: Sequence[str], order: Sequence[str | Column], rows: int):
    """Window of the current row and the ``rows - 1`` before it."""
    return Window.partitionBy(*part).orderBy(*order).rowsBetween(1 - rows, Window.currentRow)


def previous_value(measure: str, part: Sequence[str], order: Sequence[str | Column]) -> Column:
    """The measure of the preceding row of the same group, NULL for the first."""
    return F.lag(measure).over(Window.partitionBy(*part).orderBy(*order))
