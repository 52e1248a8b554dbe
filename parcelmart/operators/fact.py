"""The order-item fact: one row per item of an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from parcelmart.functions.calendar import date_id
from parcelmart.functions.clean import latest_of, once, parse_mixed_date, to_utc_ts
from parcelmart.functions.numeric import MONEY

# What a missing rider, quantity or price is stored as.
DEFAULTS = {"rider_id": -1, "quantity": 0, "unit_price": 0, "total_price": 0}
REQUIRED_KEYS = ("order_id", "product_id", "user_id")
FACT_COLUMNS = (
    "order_id",
    "product_id",
    "user_id",
    "rider_id",
    "delivery_date_id",
    "quantity",
    "unit_price",
    "total_price",
)


def _item_columns() -> list[Column]:
    return [
        F.col("ProductId").cast("bigint").alias("product_id"),
        F.col("quantity").cast("int").alias("quantity"),
        to_utc_ts(F.col("updatedAt")).alias("item_updated"),
    ]


def delivery_day_id() -> Column:
    """Day id (yyyymmdd) of an order's delivery date."""
    return once(parse_mixed_date(F.col("deliveryDate")), date_id)


def _order_columns() -> list[Column]:
    return [
        F.col("id").cast("bigint").alias("order_id"),
        F.col("userId").cast("bigint").alias("user_id"),
        F.col("deliveryRiderId").cast("bigint").alias("rider_id"),
        delivery_day_id().alias("delivery_date_id"),
        to_utc_ts(F.col("updatedAt")).alias("order_updated"),
    ]


def _priced(item_rows: DataFrame, products: DataFrame) -> DataFrame:
    prices = products.select(
        F.col("id").cast("bigint").alias("product_id"), F.col("price").cast(MONEY).alias("unit_price")
    )
    return item_rows.join(prices, "product_id", "left")


def _measured(rows: DataFrame) -> DataFrame:
    return rows.select(
        "order_id",
        "product_id",
        "user_id",
        "rider_id",
        "delivery_date_id",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).cast(MONEY).alias("total_price"),
        latest_of(F.col("order_updated"), F.col("item_updated")).alias("updated_at"),
    )


def joined_items(items: DataFrame, orders: DataFrame, products: DataFrame, how: str = "left") -> DataFrame:
    """Every order item with its order and the current product price, before any default is filled in; with ``how``
    "inner" only items of the ``orders``.

    The product join comes first: it is a broadcast whenever products are small, so only the order join shuffles.
    """
    item_rows = items.select(F.col("OrderId").cast("bigint").alias("order_id"), *_item_columns())
    return _measured(_priced(item_rows, products).join(orders.select(*_order_columns()), "order_id", how))


def nested_items(orders: DataFrame, products: DataFrame) -> DataFrame:
    """The rows of ``joined_items`` for orders, one row each, that come with their ``items`` as an array: an item has its
    order at hand, so nothing is joined or shuffled for that."""
    item_rows = orders.select(*_order_columns(), F.explode("items").alias("item")).select("*", "item.*").drop("item")
    order_names = ("order_id", "user_id", "rider_id", "delivery_date_id", "order_updated")
    return _measured(_priced(item_rows.select(*order_names, *_item_columns()), products))


def quality_counts() -> list[Column]:
    """Data-quality counts over joined items: all of them, and those that miss a key or a price."""
    missing = ("product_id", "user_id", "rider_id", "delivery_date_id", "unit_price")
    return [
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in missing],
    ]


def fact_rows(
    items: DataFrame, orders: DataFrame, products: DataFrame, seen: Observation | None = None, how: str = "left"
) -> DataFrame:
    """Fact rows plus ``updated_at``, without the surrogate key.

    Items without a product, an order or its user cannot be keyed and stay out; ``seen`` gets the quality counts of
    all joined items when the rows are first computed.
    """
    return keyed_rows(joined_items(items, orders, products, how), seen)


def keyed_rows(rows: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Joined items as fact rows; see ``fact_rows``."""
    if seen is not None:
        rows = rows.observe(seen, *quality_counts())
    for key in REQUIRED_KEYS:
        rows = rows.filter(F.col(key).isNotNull())
    return rows.select(
        *[
            F.coalesce(F.col(c), F.lit(DEFAULTS[c]).cast(rows.schema[c].dataType)).alias(c) if c in DEFAULTS else c
            for c in rows.columns
        ]
    )


def fact_quality(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row of data-quality counts, taken before defaults are filled in."""
    return joined_items(items, orders, products).agg(*quality_counts())
