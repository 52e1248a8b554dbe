"""The generated test tables mapped onto the six source tables.

The mappings are plain SQL that Spark and a SQL check engine both run unchanged; ``{name}`` stands for a table. Dirty
values (case, blanks, mixed date formats, unknown genders, missing riders) are put in so the cleaning rules have work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelmart.sources.tables import Source

_NOUN = "split_part(p_name, ' ', 2)"
_DOB = "(DATE '1960-01-01' + CAST(c_custkey * 7 % 15000 AS INT))"
_DELIVERY = "(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 AS INT))"


def _as_mdy(day: str) -> str:
    return f"concat(month({day}), '/', day({day}), '/', year({day}))"


SOURCE_SQL = {
    "products": f"""
        SELECT p_partkey AS id, p_brand AS "productCode",
               CASE p_partkey % 4 WHEN 0 THEN concat(' ', upper({_NOUN}), 'S ') WHEN 1 THEN concat({_NOUN}, 's')
                                  WHEN 2 THEN {_NOUN} ELSE p_type END AS category,
               p_type AS description, p_name AS name, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
               CAST(DATE '1995-01-01' AS TIMESTAMP) AS "createdAt",
               CAST(DATE '1995-01-01' + CAST(p_partkey % 2400 AS INT) AS TIMESTAMP) AS "updatedAt"
        FROM {{part}}""",
    "users": f"""
        SELECT c_custkey AS id, n_name AS city, r_name AS country,
               CASE c_custkey % 6 WHEN 0 THEN 'F' WHEN 1 THEN ' female ' WHEN 2 THEN 'M' WHEN 3 THEN 'Male'
                                  WHEN 4 THEN 'unknown' ELSE NULL END AS gender,
               CASE c_custkey % 4 WHEN 0 THEN CAST({_DOB} AS STRING) WHEN 1 THEN {_as_mdy(_DOB)}
                                  WHEN 2 THEN concat(CAST({_DOB} AS STRING), ' 10:30:00')
                                  ELSE '13/45/2024' END AS "dateOfBirth",
               CAST(DATE '1995-01-01' + CAST(c_custkey % 2400 AS INT) AS TIMESTAMP) AS "updatedAt"
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey""",
    "couriers": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(DATE '1995-01-01' AS TIMESTAMP) AS "createdAt",
               CAST(DATE '1995-01-01' + CAST(n_nationkey * 90 AS INT) AS TIMESTAMP) AS "updatedAt"
        FROM {nation}""",
    "riders": """
        SELECT s_suppkey AS id,
               CASE s_suppkey % 4 WHEN 0 THEN 'Bike' WHEN 1 THEN 'Motorbike' WHEN 2 THEN 'Car'
                                  ELSE 'Truck' END AS "vehicleType",
               CAST(s_nationkey AS BIGINT) AS "courierId",
               CASE s_suppkey % 2 WHEN 0 THEN 'male' ELSE 'female' END AS gender,
               CAST(DATE '1995-01-01' + CAST(s_suppkey * 20 % 2400 AS INT) AS TIMESTAMP) AS "updatedAt"
        FROM {supplier}""",
    "orders": f"""
        SELECT o_orderkey AS id, concat('N', CAST(o_orderkey AS STRING)) AS "orderNumber", o_custkey AS "userId",
               CASE o_orderkey % 3 WHEN 0 THEN CAST({_DELIVERY} AS STRING) WHEN 1 THEN {_as_mdy(_DELIVERY)}
                                   ELSE concat(CAST({_DELIVERY} AS STRING), ' 10:30:00') END AS "deliveryDate",
               CASE WHEN o_orderkey % 50 = 0 THEN NULL
                    ELSE (o_orderkey * 31 + o_custkey) % (SELECT count(*) FROM {{supplier}}) END AS "deliveryRiderId",
               CAST(o_orderdate AS TIMESTAMP) AS "createdAt", CAST(o_orderdate AS TIMESTAMP) AS "updatedAt"
        FROM {{orders}}""",
    "order_items": """
        SELECT l_orderkey AS "OrderId", l_partkey AS "ProductId", CAST(l_quantity AS INT) AS quantity,
               l_returnflag AS notes, CAST(l_shipdate AS TIMESTAMP) AS "createdAt",
               CAST(l_shipdate AS TIMESTAMP) AS "updatedAt"
        FROM {lineitem}""",
}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def mapped_source(spark: SparkSession, sf_dir: str) -> Source:
    """Source over the Parquet files of one scale-factor folder."""
    files = {name: f"parquet.`{sf_dir}/{name}.parquet`" for name in BASE_TABLES}

    def load(name: str) -> DataFrame:
        return spark.sql(SOURCE_SQL[name].replace('"', "`").format(**files))

    return load
