"""Report views over the query results: level slices, shares, top lists, pivots, highs and lows.

Frames called ``q2``, ``q6`` and ``q8`` are rollup results with their grouping id (``with_gid=True``); subtotals are
told by it and never by a NULL or a label in the data. Display ties are broken by name, so every view is repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.functions.calendar import month_start, period_label
from parcelmart.functions.clean import normalize_category
from parcelmart.functions.numeric import MONEY_SUM, money_text
from parcelmart.operators.star import extremes, opt_filter, share_of_total, top_k
from parcelmart.plans.queries import (
    TOTAL_LABELS,
    revenue_leaves,
    revenue_measures,
    revenue_rollup,
    revenue_rollup_filtered,
)
from parcelmart.sources.warehouse import Warehouse

# The value column a metric shows, the label of country totals, and how many rows charts show.
METRICS = {"total": "total_revenue", "aov": "average_order_value"}
COUNTRY_TOTAL = "Total"
TOP_PLACES = 10
TOP_RIDERS = 20

LEAF, BY_CITY, BY_COUNTRY, ALL = 0, 1, 3, 7


def _level(df: DataFrame, gid: int) -> DataFrame:
    return df.filter(F.col("gid") == gid)


def _normalized(category: str | None) -> Column | None:
    return None if category is None else normalize_category(F.lit(category))


# Customers


def customers_by_country(q2: DataFrame) -> DataFrame:
    """Customers per country."""
    return _level(q2, 1).filter(F.col("country").isNotNull()).select("country", "total_customers")


def customers_listing(q2: DataFrame) -> DataFrame:
    """Countries with their cities, biggest first; the country row is called 'Total'."""
    city = F.when(F.col("gid") == 1, F.lit(COUNTRY_TOTAL)).otherwise(F.col("city")).alias("city")
    rows = q2.filter(F.col("gid") < 3).select("country", city, "total_customers")
    return rows.orderBy(F.col("country").asc_nulls_last(), F.col("total_customers").desc(), "city")


def with_iso_code(df: DataFrame, iso_codes: DataFrame) -> DataFrame:
    """``df`` with the ``iso_alpha`` code of its country, from a lookup of ``country_name`` and ``iso_alpha``.

    Names match regardless of case and blanks; a country without an entry gets NULL.
    """

    def plain(col: Column) -> Column:
        return F.lower(F.regexp_replace(col, r"\s+", ""))

    lookup = iso_codes.groupBy(plain(F.col("country_name")).alias("_name")).agg(F.min("iso_alpha").alias("iso_alpha"))
    return df.withColumn("_name", plain(F.col("country"))).join(lookup, "_name", "left").drop("_name")


def city_detail(q2: DataFrame, country: str) -> DataFrame:
    """Customers per city of one country, biggest first."""
    rows = _level(q2, LEAF).filter((F.col("country") == country) & F.col("city").isNotNull())
    return rows.select("city", "total_customers").orderBy(F.col("total_customers").desc(), "city")


# Products, sales and revenue


def top_products_view(q3: DataFrame, n: int = 10) -> DataFrame:
    """The best ``n`` products, lowest first for a horizontal chart."""
    best = top_k(q3, [F.col("total_sales").desc(), F.col("product_name"), F.col("category")], n)
    return best.orderBy("total_sales", F.col("product_name").desc(), F.col("category").desc())


def sales_series(q4: DataFrame, average: str = "moving_avg_3_month") -> DataFrame:
    """Sales and moving average as one long series: date, country, measure, value."""
    typed = q4.select(
        month_start(F.col("year"), F.col("month")).alias("date"),
        "country",
        *[F.col(c).cast(MONEY_SUM).alias(c) for c in ("total_sales", average)],
    )
    series = typed.unpivot(["date", "country"], ["total_sales", average], "measure", "value")
    return series.orderBy("date", F.col("country").asc_nulls_last(), "measure")


def revenue_series(q1: DataFrame) -> DataFrame:
    """Revenue and units per period for a combined chart."""
    return q1.select("period", F.col("revenue").cast("double"), F.col("units_sold").cast("bigint")).orderBy("period")


# Deliveries and riders


def rider_leaderboard(q5: DataFrame, n: int = TOP_RIDERS) -> DataFrame:
    """The first ``n`` riders of the ranking."""
    return top_k(q5, [F.col("delivery_rank"), F.col("country").asc_nulls_last(), F.col("rider_id")], n)


def vehicle_series(q6: DataFrame) -> DataFrame:
    """Deliveries per period and vehicle type, in time order."""
    rows = _level(q6, LEAF).filter(F.col("year").isNotNull() & F.col("vehicle_type").isNotNull())
    period = period_label(F.col("year"), F.col("month")).alias("period")
    return rows.select("year", "month", "vehicle_type", period, "total_deliveries").orderBy(
        "year", F.coalesce("month", F.lit(0)), "vehicle_type"
    )


def vehicle_share(q6: DataFrame) -> DataFrame:
    """Deliveries and share of all deliveries per vehicle type, biggest first, with the grand total."""
    rows = _level(q6, LEAF).filter(F.col("year").isNotNull() & F.col("vehicle_type").isNotNull())
    return share_of_total(rows, "vehicle_type", "total_deliveries").orderBy(
        F.col("total_deliveries").desc(), "vehicle_type"
    )


def country_options(q8: DataFrame, always: str | None = None) -> DataFrame:
    """Sorted country names of a revenue rollup, plus one that is always offered."""
    names = _level(q8, BY_COUNTRY).select("country").dropna()
    if always is not None:
        names = names.union(names.sparkSession.range(0, 1, 1, 1).select(F.lit(always)))
    return names.distinct().orderBy("country")


def rider_table(q7: DataFrame) -> DataFrame:
    """Riders by sales, best first."""
    return q7.orderBy(F.col("total_sales").desc(), "rider_id")


def rider_kpis(q7: DataFrame) -> DataFrame:
    """One row: the rider with the highest sales and the one with the best growth; ties go to the higher sales."""
    tie = [(-F.col("total_sales")).alias("t"), F.col("rider_id").alias("r")]
    by_growth = F.struct((-F.col("sales_growth_pct")).alias("g"), *tie)
    best = q7.agg(
        F.min(F.struct(*tie)).alias("sales"),
        F.min(F.when(F.col("sales_growth_pct").isNotNull(), by_growth)).alias("growth"),
    )
    return best.select(
        F.col("sales.r").alias("top_rider"),
        (-F.col("sales.t")).alias("top_sales"),
        F.col("growth.r").alias("best_growth_rider"),
        (-F.col("growth.g")).alias("best_growth_pct"),
    )


# Revenue drill-down


def drilldown(
    wh: Warehouse,
    metric: str = "total",
    year: int = 2025,
    country: str | None = None,
    city: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """The rollup behind a drill-down: totals, or the one with averages; with its grouping id.

    When a category has no leaf row in the scope, the scope is shown without it.
    """
    rollup = revenue_rollup if metric == "total" else revenue_rollup_filtered
    if category is not None and revenue_leaves(wh, year, country, city, category).isEmpty():
        category = None
    return rollup(wh, year, country, city, category, with_gid=True)


def drill_options(
    rows: DataFrame, country: str | None = None, city: str | None = None, category: str | None = None
) -> DataFrame:
    """Choices for the next step as (kind, value): countries, cities of the country, categories of the scope.

    A choice already made stays listed even where the current rows do not have it.
    """
    leaves = _level(rows, LEAF)
    of_category = opt_filter(leaves, category=_normalized(category))
    lists = [of_category.select(F.lit("country").alias("kind"), F.col("country").alias("value"))]
    if country is not None:
        cities = of_category.filter(F.col("country") == country)
        lists.append(cities.select(F.lit("city").alias("kind"), F.col("city").alias("value")))
    scope = opt_filter(leaves, country=country, city=city if country is not None else None)
    lists.append(scope.select(F.lit("category").alias("kind"), F.col("category").alias("value")))
    one = rows.sparkSession.range(0, 1, 1, 1)
    chosen = [("country", country), ("city", city if country is not None else None)]
    lists += [one.select(F.lit(kind).alias("kind"), F.lit(v).alias("value")) for kind, v in chosen if v is not None]
    options = lists[0]
    for more in lists[1:]:
        options = options.unionByName(more)
    return options.dropna().distinct().orderBy("kind", "value")


def _best_first(rows: DataFrame, metric: str, name: str, top: int | None) -> DataFrame:
    order = [F.col(METRICS[metric]).desc_nulls_last(), F.col(name).asc_nulls_last()]
    return rows.orderBy(*order) if top is None else top_k(rows, order, top)


def country_view(
    wh: Warehouse, year: int = 2025, category: str | None = None, metric: str = "total", top: int | None = None
) -> DataFrame:
    """Countries by value, best first; ``top`` keeps the first ones for a chart.

    With a category, riders and averages are taken from the facts of that category: the rollup has no such level.
    """
    label = F.lit(TOTAL_LABELS["category"]) if category is None else _normalized(category)
    per_country = revenue_leaves(wh, year, None, None, category).groupBy("country").agg(*revenue_measures())
    rows = per_country.select("country", label.alias("category"), *per_country.columns[1:])
    return _best_first(rows, metric, "country", top)


def city_totals(rows: DataFrame, country: str, category: str | None = None) -> DataFrame:
    """Cities of one country with their totals: all categories, or one."""
    if category is None:
        cities = _level(rows, BY_CITY)
    else:
        cities = opt_filter(_level(rows, LEAF), category=_normalized(category))
    return cities.filter((F.col("country") == country) & F.col("city").isNotNull())


def city_view(
    rows: DataFrame, country: str, category: str | None = None, metric: str = "total", top: int | None = TOP_PLACES
) -> DataFrame:
    """Category rows of the best cities of a country, in the order of the cities, then by value."""
    value = METRICS[metric]
    best = _best_first(city_totals(rows, country, category), metric, "city", top)
    order = Window.partitionBy("country").orderBy(F.col(value).desc_nulls_last(), "city")
    ranked = best.select("city", F.row_number().over(order).cast("bigint").alias("city_rank"))
    detail = opt_filter(_level(rows, LEAF), country=country, category=_normalized(category))
    joined = detail.drop("gid").join(ranked, "city")
    return joined.orderBy("city_rank", F.col(value).desc_nulls_last(), F.col("category").asc_nulls_last())


def category_view(
    rows: DataFrame,
    country: str,
    city: str,
    category: str | None = None,
    metric: str = "total",
    top: int | None = TOP_PLACES,
) -> DataFrame:
    """Categories of one city by value, best first."""
    leaves = opt_filter(_level(rows, LEAF), country=country, city=city, category=_normalized(category))
    return _best_first(leaves.drop("gid"), metric, "category", top)


def city_category_matrix(
    view: DataFrame, metric: str = "total", categories: Sequence[str] | None = None
) -> DataFrame:
    """Cities of a ``city_view`` as rows, its categories as sorted columns, 0 where there is no value."""
    value = F.coalesce(F.first(METRICS[metric]).cast("double"), F.lit(0.0))
    named = view.filter(F.col("category").isNotNull())
    wide = named.groupBy("city_rank", "city").pivot("category", list(categories) if categories else None).agg(value)
    return wide.fillna(0.0).orderBy("city_rank")


def high_low(view: DataFrame, label: str, metric: str = "total", within: Sequence[str] = ()) -> DataFrame:
    """Highest and lowest row of a view, by its country, city or category column.

    ``within`` adds columns of these rows, as the city the highest and the lowest category are in.
    """
    return extremes(view, METRICS[metric], label, within)


def drill_table(view: DataFrame, level: str, metric: str = "total") -> DataFrame:
    """Table columns of a drill level ('country', 'city' or 'category') with formatted amounts."""
    names = {"country": ["country", "category"], "city": ["city", "category"], "category": ["category"]}[level]
    riders = F.coalesce(F.col("unique_riders").cast("string"), F.lit("")).alias("unique_riders")
    value = METRICS[metric]
    return view.select(*names, money_text(F.col(value)).alias(value), riders)
