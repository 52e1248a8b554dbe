"""A small hand-made source, for cases the test tables do not have."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from parcelmart.sources.tables import Source

SCHEMAS = {
    "orders": "id bigint, orderNumber string, userId bigint, deliveryDate string, deliveryRiderId bigint, "
    "createdAt timestamp, updatedAt timestamp",
    "order_items": "OrderId bigint, ProductId bigint, quantity int, notes string, createdAt timestamp, updatedAt timestamp",
    "products": "id bigint, productCode string, category string, description string, name string, price decimal(18,2), "
    "createdAt timestamp, updatedAt timestamp",
    "users": "id bigint, city string, country string, gender string, dateOfBirth string, updatedAt timestamp",
    "riders": "id bigint, vehicleType string, courierId bigint, gender string, updatedAt timestamp",
    "couriers": "id bigint, name string, createdAt timestamp, updatedAt timestamp",
}


def at(day: int) -> datetime:
    """Midnight UTC of a day of 2024."""
    return datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(days=day - 1)


def order(key, user=1, day="2024-01-05", rider=1, changed=1):
    return (key, f"N{key}", user, day, rider, at(1), at(changed))


def item(order_id, product=1, quantity=1, changed=1):
    return (order_id, product, quantity, "", at(1), at(changed))


def product(key, price="10.00", category="Bags", changed=1, name=None):
    from decimal import Decimal

    return (key, f"C{key}", category, "", name or f"product {key}", Decimal(price), at(1), at(changed))


def user(key, city="Rome", country="Italy", changed=1):
    return (key, city, country, "f", "1/5/1990", at(changed))


def rider(key, courier=1, vehicle="Bike", changed=1):
    return (key, vehicle, courier, "male", at(changed))


def courier(key, name="Fast", changed=1):
    return (key, name, at(1), at(changed))


BASE = {
    "orders": [order(1), order(2, day="1/6/2024"), order(3, day="2024-02-07 10:30:00", rider=None)],
    "order_items": [item(1), item(1, 2, 3), item(1, 2, 5), item(2, 1, 2), item(3, 2, 1)],
    "products": [product(1), product(2, "2.50", "Toys")],
    "users": [user(1), user(2, "Oslo", "Norway")],
    "riders": [rider(1)],
    "couriers": [courier(1)],
}


def make_source(spark: SparkSession, **tables: list) -> Source:
    """The base tables with some of them replaced."""
    content = {**BASE, **tables}

    def load(name: str) -> DataFrame:
        return spark.createDataFrame(content[name], SCHEMAS[name])

    return load
