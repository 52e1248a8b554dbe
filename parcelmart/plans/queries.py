"""The nine analytical queries.

All of them count and sum *order items*: a "delivery" is one item, and an "average order value" is the average item
value. A parameter left at None means no filter. Category parameters are normalised like the stored categories.
Amounts are exact decimals. Result order puts NULL last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.calendar import date_text_to_id, period_of_date_id, prev_quarter, quarter_label
from parcelmart.functions.clean import normalize_category
from parcelmart.functions.numeric import MONEY_SUM, cents, growth_pct, rounded_mean
from parcelmart.operators.ranking import global_rank, percent_rank_pct, trailing_rows
from parcelmart.operators.star import (
    Dim,
    date_id_between,
    facts_between,
    facts_of,
    rollup_distinct,
    rollup_labelled,
    star_sum,
    top_k,
)
from parcelmart.operators.sums import facts_or_sums, monthly_sums
from parcelmart.sources.warehouse import Warehouse

# The labels of subtotal rows in the revenue rollups.
TOTAL_LABELS = {"country": "Grand Total", "city": "All Cities", "category": "All Categories"}
PLACE_KEYS = ("country", "city", "category")


def _sorted(df: DataFrame, *names: str) -> DataFrame:
    return df.orderBy(*[F.col(n).asc_nulls_last() for n in names])


def _category(value: str | None) -> Column | None:
    return None if value is None else normalize_category(F.lit(value))


def revenue_by_period(
    wh: Warehouse,
    start: str = "2024-01-01",
    end: str = "2024-12-31",
    category: str | None = None,
    granularity: str = "month",
) -> DataFrame:
    """Revenue and units per year, month or day of a date range; an unknown granularity gives one NULL period."""
    facts = facts_or_sums(wh, "delivery_date_id", "product_id")
    facts = date_id_between(facts, date_text_to_id(start), date_text_to_id(end))
    period = period_of_date_id(F.col("date_id"), granularity).alias("period")
    dims = [Dim("dim_date", [period]), Dim("dim_product", equals={"category": _category(category)})]
    sums = {"revenue": F.col("total_price"), "units_sold": F.col("quantity").cast("bigint")}
    return _sorted(star_sum(wh, facts, dims, ["period"], sums), "period")


def customer_distribution(wh: Warehouse, with_gid: bool = False) -> DataFrame:
    """Customers per country and city with country subtotals and the grand total.

    User ids are unique in the dimension, so each level adds up the counts of the level below and no user row is
    shuffled or expanded. ``gid`` tells subtotals (1: country, 3: all) from cities that are NULL in the data.
    """
    per_city = wh["dim_user"].groupBy("country", "city").agg(F.count("user_id").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("total_customers")
    rolled = rollup_labelled(per_city, ["country", "city"], {}, [total])
    return rolled if with_gid else rolled.drop("gid")


def top_products(
    wh: Warehouse, n: int = 10, country: str | None = None, city: str | None = None, category: str | None = None
) -> DataFrame:
    """The ``n`` products (by name and category) with the highest revenue; ties by name, then category."""
    dims = [
        Dim("dim_product", ["name", "category"], {"category": _category(category)}),
        Dim("dim_user", equals={"country": country, "city": city}),
    ]
    sums = {"total_quantity_sold": F.col("quantity").cast("bigint"), "total_sales": F.col("total_price")}
    products = star_sum(wh, wh["fact_orders"], dims, ["name", "category"], sums)
    named = products.withColumnRenamed("name", "product_name")
    order = [F.col("total_sales").desc(), F.col("product_name").asc_nulls_last(), F.col("category").asc_nulls_last()]
    return top_k(named, order, n)


def sales_moving_average(wh: Warehouse, country: str | None = None, periods: int = 3) -> DataFrame:
    """Monthly sales per country and the mean of the last ``periods`` monthly rows (months without sales are no rows)."""
    rows, dims = monthly_sums(wh, "sums_user") or (wh["fact_orders"], [Dim("dim_date", ["year", "month"])])
    dims = [*dims, Dim("dim_user", ["country"], {"country": country})]
    monthly = star_sum(wh, rows, dims, ["year", "month", "country"], {"total_sales": F.col("total_price")})
    recent = trailing_rows(["country"], ["year", "month"], periods)
    mean = rounded_mean(F.sum("total_sales").over(recent), F.count("total_sales").over(recent))
    return _sorted(monthly.withColumn(f"moving_avg_{periods}_month", mean), "year", "month", "country")


def rider_ranking(wh: Warehouse, country: str | None = None) -> DataFrame:
    """Riders ranked by deliveries: within one country, or all (country, rider) pairs in one ranking."""
    dims = [Dim("dim_rider", ["courier_name"]), Dim("dim_user", ["country"], {"country": country})]
    keys = ["country", "rider_id", "courier_name"]
    riders = star_sum(wh, wh["fact_orders"], dims, keys, {"total_deliveries": F.lit(1).cast("bigint")})
    ranked = global_rank(riders, "total_deliveries", rank="delivery_rank")
    columns = [*keys, "total_deliveries", "delivery_rank"]
    return _sorted(ranked.select(*columns), "delivery_rank", "country", "rider_id")


def vehicle_deliveries(
    wh: Warehouse, year: int | None = None, month: int | None = None, with_gid: bool = False
) -> DataFrame:
    """Deliveries per year, month and vehicle type with subtotals; summed before the rollup expands anything."""
    kept, keys = monthly_sums(wh, "sums_rider", year, month), ["year", "month", "vehicle_type"]
    if kept:
        rows, dims, items = *kept, F.col("items")
    else:
        rows, items = facts_of(wh, year, month), F.lit(1).cast("bigint")
        dims = [Dim("dim_date", ["year", "month"], {"year": year, "month": month})]
    leaf = star_sum(wh, rows, [*dims, Dim("dim_rider", ["vehicle_type"])], keys, {"n": items})
    total = F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("total_deliveries")
    rolled = rollup_labelled(leaf, keys, {}, [total])
    return _sorted(rolled if with_gid else rolled.drop("gid"), *keys)


def top_percentile_riders(
    wh: Warehouse, year: int = 2025, quarter: int = 1, country: str = "Philippines", percentile: float = 10
) -> DataFrame:
    """Riders of one country and quarter within the best ``percentile`` % by sales, with growth over the last quarter.

    Riders are not joined to their dimension, so the "no rider" key can take part. Both quarters are summed side by
    side in one grouping; a rider needs sales rows in the asked quarter to be listed.
    """
    last_year, last_quarter = prev_quarter(year, quarter)
    first_id, end_id = last_year * 10000 + last_quarter * 300 - 200, year * 10000 + quarter * 300 + 99
    dates = Dim("dim_date", ["year", "quarter"])
    users = Dim("dim_user", ["country"], {"country": country})
    facts = facts_between(wh, first_id, end_id)
    keys = ["country", "rider_id", "year", "quarter", "user_id"]
    sums = {"sales": F.col("total_price")}
    per_user = star_sum(wh, facts, [dates, users], keys, sums)
    current = (F.col("year") == year) & (F.col("quarter") == quarter)
    per_rider = per_user.groupBy("country", "rider_id").agg(
        F.sum(F.when(current, F.col("sales"))).alias("total_sales"),
        F.sum(F.when(~current, F.col("sales"))).alias("prev_quarter_sales"),
        F.count_if(current).alias("customers_served"),
    )
    listed = per_rider.filter(F.col("customers_served") > 0).withColumn("sales_cents", cents(F.col("total_sales")))
    # Ranking uses the riders twice; both uses share the exchange that sums them up.
    ranked = percent_rank_pct(listed, "sales_cents", "sales_percentile")
    result = ranked.filter(F.col("sales_percentile") <= percentile).select(
        "country",
        quarter_label(F.lit(year), F.lit(quarter)).alias("period"),
        "rider_id",
        "total_sales",
        "prev_quarter_sales",
        growth_pct(F.col("total_sales"), F.col("prev_quarter_sales")).alias("sales_growth_pct"),
        "customers_served",
        "sales_percentile",
    )
    return result.orderBy("country", F.col("total_sales").desc(), "rider_id")


def revenue_leaves(
    wh: Warehouse, year: int, country: str | None, city: str | None, category: str | None
) -> DataFrame:
    """Revenue and items per place, category and rider: everything the revenue rollups need, and far fewer rows."""
    dims = [
        Dim("dim_date", equals={"year": year}),
        Dim("dim_rider"),
        Dim("dim_product", ["category"], {"category": _category(category)}),
        Dim("dim_user", ["country", "city"], {"country": country, "city": city}),
    ]
    sums = {"revenue": F.col("total_price"), "items": F.lit(1).cast("bigint")}
    return star_sum(wh, facts_of(wh, year), dims, [*PLACE_KEYS, "rider_id"], sums)


def revenue_measures() -> list[Column]:
    """Revenue, distinct riders and average item value over rows of ``revenue_leaves``."""
    revenue, items = F.sum("revenue"), F.sum("items")
    average = revenue.cast("double") / F.nullif(items, F.lit(0)).cast("double")
    return [
        revenue.cast(MONEY_SUM).alias("total_revenue"),
        F.count_distinct("rider_id").alias("unique_riders"),
        average.alias("average_order_value"),
    ]


def _revenue_rollup(leaves: DataFrame) -> DataFrame:
    rolled = rollup_distinct(leaves, PLACE_KEYS, TOTAL_LABELS, ["revenue", "items"], "rider_id", "unique_riders")
    average = F.col("revenue").cast("double") / F.nullif(F.col("items"), F.lit(0)).cast("double")
    return rolled.select(
        *PLACE_KEYS, F.col("revenue").cast(MONEY_SUM).alias("total_revenue"), "unique_riders",
        average.alias("average_order_value"), "gid",
    )


def revenue_rollup(
    wh: Warehouse,
    year: int = 2025,
    country: str | None = None,
    city: str | None = None,
    category: str | None = None,
    with_gid: bool = False,
) -> DataFrame:
    """Revenue and riders by country, city and category of a year; filters apply to the *result* rows.

    A result row shows a filtered column only on the levels where it is not totalled, and its content is fixed by its
    keys. So the filters are put on the facts, and the levels that total a filtered column are left out.
    """
    rolled = _revenue_rollup(revenue_leaves(wh, year, country, city, category)).drop("average_order_value")
    if category is not None:
        rolled = rolled.filter(F.col("gid") == 0)
    elif city is not None:
        rolled = rolled.filter(F.col("gid") <= 1)
    elif country is not None:
        rolled = rolled.filter(F.col("gid") <= 3)
    return _sorted(rolled if with_gid else rolled.drop("gid"), *PLACE_KEYS)


def revenue_rollup_filtered(
    wh: Warehouse,
    year: int = 2025,
    country: str | None = None,
    city: str | None = None,
    category: str | None = None,
    with_gid: bool = False,
) -> DataFrame:
    """The same with the average item value; filters apply to the *facts*, so every level totals the filtered rows."""
    rolled = _revenue_rollup(revenue_leaves(wh, year, country, city, category))
    return _sorted(rolled if with_gid else rolled.drop("gid"), *PLACE_KEYS)
