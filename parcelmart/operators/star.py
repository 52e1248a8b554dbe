"""Grouping the fact by dimension attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.numeric import MONEY_SUM, percent_of
from parcelmart.operators.key_filter import filter_words, may_match
from parcelmart.sources.warehouse import Warehouse

# Dimension key column -> fact column that refers to it.
FACT_KEYS = {
    "dim_product": ("product_id", "product_id"),
    "dim_user": ("user_id", "user_id"),
    "dim_rider": ("rider_id", "rider_id"),
    "dim_date": ("date_id", "delivery_date_id"),
}


@dataclass(frozen=True)
class Dim:
    """A dimension to join: the attributes wanted from it and the equality filters on it (None = no filter).

    An attribute may be an expression; it is then computed once per dimension row and not per fact.
    """

    table: str
    attrs: Sequence[str | Column] = ()
    equals: Mapping[str, object] | None = None

    @property
    def fact_key(self) -> str:
        return FACT_KEYS[self.table][1]

    @property
    def filtered(self) -> bool:
        return any(value is not None for value in (self.equals or {}).values())

    def frame(self, wh: Warehouse) -> DataFrame:
        rows = opt_filter(wh[self.table], **(self.equals or {}))
        return rows.select(F.col(FACT_KEYS[self.table][0]).alias(self.fact_key), *self.attrs)


def opt_filter(df: DataFrame, **equals: object) -> DataFrame:
    """Equality filters; a None value means no filter on that column."""
    for name, value in equals.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def _prune(facts: DataFrame, months: Column) -> DataFrame:
    """Keep the month partitions of stored facts that can match; facts computed on the fly have none."""
    return facts.filter(months) if "delivery_month" in facts.columns else facts


def date_id_between(facts: DataFrame, start: int, end: int) -> DataFrame:
    """Facts delivered from ``start`` to ``end`` (yyyymmdd, inclusive)."""
    in_range = facts.filter(F.col("delivery_date_id").between(start, end))
    return _prune(in_range, F.col("delivery_month").between(start // 100, end // 100))


def facts_between(wh: Warehouse, start: int, end: int) -> DataFrame:
    """The warehouse's facts delivered from ``start`` to ``end`` (yyyymmdd, inclusive)."""
    return date_id_between(wh.facts_between(start, end), start, end)


def facts_of(wh: Warehouse, year: int | None, month: int | None = None) -> DataFrame:
    """The warehouse's facts of a year, of one month of it, or of one month of every year."""
    return delivered_in(wh["fact_orders"], year, month) if year is None else facts_between(wh, *_days(year, month))


def _days(year: int, month: int | None) -> tuple[int, int]:
    first, last = (month, month) if month is not None else (1, 12)
    return year * 10000 + first * 100, year * 10000 + last * 100 + 99


def delivered_in(facts: DataFrame, year: int | None, month: int | None = None) -> DataFrame:
    """Facts of a year, of one month of it, or of one month of every year."""
    if year is not None:
        return date_id_between(facts, *_days(year, month))
    if month is not None:
        in_month = facts.filter(F.floor(F.col("delivery_date_id") / 100) % 100 == month)
        return _prune(in_month, F.col("delivery_month") % 100 == month)
    return facts


def star_sum(
    wh: Warehouse, facts: DataFrame, dims: Sequence[Dim], keys: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """``sums`` of the facts that match every dimension, per ``keys`` (fact columns and dimension attributes).

    Dimensions known to be small are broadcast. Where a filtered one is not, its keys go to the facts as a bit filter, so
    facts that cannot match are dropped before anything is shuffled, and it is joined before the unfiltered ones. Before
    the last big dimension the facts are summed per its key: the shuffle then carries one row per key combination and
    task, and a user, product or rider holding a large part of the facts is no longer heavier than its distinct
    combinations. Earlier that would not help: facts hardly share the keys of two big dimensions. A join partition that is
    still too heavy is split by adaptive execution: nothing after the join needs its layout.
    """
    near = [d for d in dims if wh.is_small(d.table)]
    far = sorted((d for d in dims if not wh.is_small(d.table)), key=lambda d: not d.filtered)
    carried = dict.fromkeys([*(k for k in keys if k in facts.columns), *(d.fact_key for d in dims)])
    for dim in far:
        if dim.filtered:
            facts = facts.filter(may_match(dim.frame(wh), dim.fact_key, filter_words(wh.sizes.get(dim.table))))
    rows = facts.select(*carried, *[expr.alias(name) for name, expr in sums.items()])
    # One type per kind of sum, however many steps it is added up in.
    kinds = {name: MONEY_SUM if rows.schema[name].dataType.typeName() == "decimal" else "bigint" for name in sums}
    totals = [F.sum(name).cast(kind).alias(name) for name, kind in kinds.items()]
    for dim in near:
        rows = rows.join(F.broadcast(dim.frame(wh)), dim.fact_key)
    for dim in far:
        if dim is far[-1]:
            ready = dict.fromkeys([*(k for k in keys if k in rows.columns), dim.fact_key])
            rows = rows.groupBy(*ready).agg(*totals)
        rows = rows.join(dim.frame(wh), dim.fact_key)
    return rows.groupBy(*keys).agg(*totals)


def _with_total_row(df: DataFrame) -> DataFrame:
    """``df`` marked by ``_real``, and one row of NULLs: the grand total exists even when there is nothing to total."""
    marked = df.withColumn("_real", F.lit(1))
    nothing = df.sparkSession.range(0, 1, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in marked.schema])
    return marked.unionByName(nothing)


def _labelled(rolled: DataFrame, keys: Sequence[str], labels: Mapping[str, str], gid: str) -> DataFrame:
    """Real rows and the grand total, with subtotal labels put on by grouping level."""
    rolled = rolled.filter((F.col("_n") > 0) | (F.col(gid) == 2 ** len(keys) - 1)).drop("_n")
    measures = [c for c in rolled.columns if c not in (*keys, gid)]
    shown = []
    for i, key in enumerate(keys):
        if key in labels:
            in_total = F.getbit(F.col(gid), F.lit(len(keys) - 1 - i)) == 1
            shown.append(F.when(in_total, F.lit(labels[key])).otherwise(F.col(key)).alias(key))
        else:
            shown.append(F.col(key))
    return rolled.select(*shown, *measures, gid)


def rollup_labelled(
    df: DataFrame, keys: Sequence[str], labels: Mapping[str, str], aggs: Sequence[Column], gid: str = "gid"
) -> DataFrame:
    """Rollup with subtotal labels put on by grouping level, so a NULL in the data never looks like a subtotal.

    ``gid`` is the grouping id: 0 for leaf rows, all ones for the grand total. Keys without a label stay NULL.
    """
    level = F.grouping_id().cast("int").alias(gid)
    rolled = _with_total_row(df).rollup(*keys).agg(level, F.count("_real").alias("_n"), *aggs)
    return _labelled(rolled, keys, labels, gid)


def rollup_distinct(
    df: DataFrame,
    keys: Sequence[str],
    labels: Mapping[str, str],
    sums: Sequence[str],
    distinct: str,
    out: str,
    gid: str = "gid",
) -> DataFrame:
    """``rollup_labelled`` with the total of every column of ``sums`` and the exact number of distinct ``distinct`` values
    (whole numbers) on each level.

    The values of a leaf become bitmaps first, one per 32,768 neighbouring numbers, and the levels merge bitmaps: what a
    rollup copies for each of its levels is one row per leaf and bitmap, not one per leaf and value. Meant for keys that
    are handed out densely; numbers far apart have a bitmap of 4 KB each.
    """
    bucket = F.bitmap_bucket_number(F.col(distinct)).alias("_bucket")
    leaves = df.groupBy(*keys, bucket).agg(
        *[F.sum(name).alias(name) for name in sums],
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(distinct))).alias("_bits"),
    )
    levels = [[*keys[: len(keys) - i], "_bucket"] for i in range(len(keys) + 1)]
    merged = _with_total_row(leaves).groupingSets(levels, *keys, "_bucket").agg(
        # The bucket is a key on every level, so its bit, the last, is always 0.
        F.shiftright(F.grouping_id(), 1).cast("int").alias(gid),
        F.count("_real").alias("_n"),
        *[F.sum(name).alias(name) for name in sums],
        F.bitmap_or_agg("_bits").alias("_bits"),
    )
    rolled = merged.groupBy(*keys, gid).agg(
        F.sum("_n").alias("_n"),
        *[F.sum(name).alias(name) for name in sums],
        F.coalesce(F.sum(F.when(F.col("_n") > 0, F.bitmap_count("_bits"))), F.lit(0)).cast("bigint").alias(out),
    )
    return _labelled(rolled, keys, labels, gid)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of an order that has no ties left."""
    return df.orderBy(*order).limit(k)


def share_of_total(df: DataFrame, key: str, measure: str, out: str = "percent") -> DataFrame:
    """Sum per key and its percentage of the grand sum, rounded to two decimals."""
    per_key = df.groupBy(key).agg(F.sum(measure).alias(measure))
    total = df.agg(F.sum(measure)).scalar()
    return per_key.select(key, measure, percent_of(F.col(measure), total).alias(out), total.alias("grand_total"))


def extremes(df: DataFrame, measure: str, label: str, within: Sequence[str] = ()) -> DataFrame:
    """One row: label and value of the highest and of the lowest row, and the columns ``within`` of either.

    Ties go to the smallest label, then to the smallest values of ``within``.
    """
    value, names = F.col(measure), [F.col(label).alias("l"), *within]
    return df.filter(value.isNotNull()).agg(
        F.min(F.struct((-value).alias("v"), *names)).alias("hi"),
        F.min(F.struct(value.alias("v"), *names)).alias("lo"),
    ).select(
        F.col("hi.l").alias("highest"),
        (-F.col("hi.v")).alias("highest_value"),
        F.col("lo.l").alias("lowest"),
        F.col("lo.v").alias("lowest_value"),
        *[F.col(f"{side}.{c}").alias(f"{name}_{c}") for side, name in (("hi", "highest"), ("lo", "lowest")) for c in within],
    )
