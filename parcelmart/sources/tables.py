"""The six operational source tables.

A *source* is any callable ``name -> DataFrame``. ``parquet_source`` and ``jdbc_source`` build the two usual ones;
tests pass their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Source = Callable[[str], DataFrame]

# The source columns each table is read with. Personal data of users is left out on purpose.
SOURCE_COLUMNS = {
    "orders": ["id", "orderNumber", "userId", "deliveryDate", "deliveryRiderId", "createdAt", "updatedAt"],
    "order_items": ["OrderId", "ProductId", "quantity", "notes", "createdAt", "updatedAt"],
    "products": ["id", "productCode", "category", "description", "name", "price", "createdAt", "updatedAt"],
    "users": ["id", "city", "country", "gender", "dateOfBirth", "updatedAt"],
    "riders": ["id", "vehicleType", "courierId", "gender", "updatedAt"],
    "couriers": ["id", "name", "createdAt", "updatedAt"],
}
RENAMED = {"couriers": {"name": "courier_name"}}

# Table names used by a relational source, and the numeric column its parallel read is split on.
JDBC_TABLES = {
    "orders": ("Orders", "id"),
    "order_items": ("OrderItems", "OrderId"),
    "products": ("Products", "id"),
    "users": ("Users", "id"),
    "riders": ("Riders", "id"),
    "couriers": ("Couriers", "id"),
}


def read_source(name: str, source: Source) -> DataFrame:
    """One source table with its fixed columns; filters put on it later reach the scan."""
    renamed = RENAMED.get(name, {})
    return source(name).select(*[F.col(c).alias(renamed.get(c, c)) for c in SOURCE_COLUMNS[name]])


def parquet_source(spark: SparkSession, path: str) -> Source:
    """Source tables as Parquet folders below ``path``."""
    return lambda name: spark.read.parquet(f"{path}/{name}")


def jdbc_source(spark: SparkSession, url: str, num_partitions: int = 64, **options: str) -> Source:
    """Source tables of a relational database, each read by ``num_partitions`` range queries in parallel.

    Column selection and ``updatedAt`` filters are pushed into the generated SELECTs by Spark.
    """

    def bounds(table: str, column: str) -> tuple[int, int]:
        query = f"SELECT min({column}) AS lo, max({column}) AS hi FROM {table}"
        row = spark.read.format("jdbc").options(url=url, query=query, **options).load().first()
        return int(row[0] or 0), int(row[1] or 0)

    def load(name: str) -> DataFrame:
        table, column = JDBC_TABLES[name]
        lo, hi = bounds(table, column)
        reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
        return reader.options(
            partitionColumn=column, lowerBound=str(lo), upperBound=str(hi + 1), numPartitions=str(num_partitions)
        ).load()

    return load
