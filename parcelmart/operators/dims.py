"""Dimension builders. Each returns its columns plus ``updatedAt``, which loading uses and then drops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.calendar import calendar_attrs
from parcelmart.functions.clean import latest_of, normalize_category, normalize_gender, parse_mixed_date, to_utc_ts


def dedup(df: DataFrame, key: str, newest_by: str = "updatedAt") -> DataFrame:
    """One row per key: the newest, ties broken by the other columns in order.

    A maximum over a struct rather than a ranked window: copies collapse before the shuffle, so a key that holds a
    large part of the rows costs one partial row per task.
    """
    rest = [c for c in df.columns if c not in (key, newest_by)]
    best = F.max(F.struct(newest_by, *rest)).alias("best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"best.{c}").alias(c) for c in df.columns if c != key])


def dim_product(products: DataFrame) -> DataFrame:
    """Products with the normalised category."""
    cleaned = products.select(
        F.col("id").cast("bigint").alias("product_id"),
        F.col("name").cast("string").alias("name"),
        normalize_category(F.col("category")).alias("category"),
        F.col("price").cast("decimal(18,2)").alias("current_price"),
        to_utc_ts(F.col("updatedAt")).alias("updatedAt"),
    )
    return dedup(cleaned, "product_id")


def dim_user(users: DataFrame) -> DataFrame:
    """Users with normalised gender and a parsed date of birth."""
    cleaned = users.select(
        F.col("id").cast("bigint").alias("user_id"),
        F.col("city").cast("string").alias("city"),
        F.col("country").cast("string").alias("country"),
        normalize_gender(F.col("gender")).alias("gender"),
        parse_mixed_date(F.col("dateOfBirth")).alias("date_of_birth"),
        to_utc_ts(F.col("updatedAt")).alias("updatedAt"),
    )
    return dedup(cleaned, "user_id")


def dim_rider(riders: DataFrame, couriers: DataFrame) -> DataFrame:
    """Riders with the name of their courier company; changed when either side changed."""
    left = riders.select(
        F.col("id").cast("bigint").alias("rider_id"),
        F.col("vehicleType").cast("string").alias("vehicle_type"),
        F.col("gender").cast("string").alias("gender"),
        F.col("courierId").cast("bigint").alias("courier_id"),
        to_utc_ts(F.col("updatedAt")).alias("rider_updated"),
    )
    right = couriers.select(
        F.col("id").cast("bigint").alias("courier_id"),
        F.col("courier_name").cast("string").alias("courier_name"),
        to_utc_ts(F.col("updatedAt")).alias("courier_updated"),
    )
    joined = left.join(right, "courier_id", "left").select(
        "rider_id",
        "vehicle_type",
        "courier_name",
        "gender",
        latest_of(F.col("rider_updated"), F.col("courier_updated")).alias("updatedAt"),
    )
    return dedup(joined, "rider_id")


def delivery_days(orders: DataFrame) -> DataFrame:
    """Distinct calendar days deliveries were asked for; at most one row per day, whatever the number of orders."""
    days = orders.select(parse_mixed_date(F.col("deliveryDate")).alias("day")).distinct()
    return days.filter(F.col("day").isNotNull())


def dim_date(orders: DataFrame) -> DataFrame:
    """Calendar rows of the days present in the orders; days without a delivery are not filled in."""
    return delivery_days(orders).select(*calendar_attrs(F.col("day")))
