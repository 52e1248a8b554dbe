"""The star schema: table layouts, the run log, and reading a committed snapshot.

Layout below the warehouse folder::

    etl_runs/<version>.json                              one row per successful load, created last (the commit)
    dim_*/v=<version>-<load>/                            one complete dimension
    fact_orders/v=<version>-<load>/delivery_month=<yyyymm>/ one complete month of facts
    sums_*/v=<version>-<load>/delivery_month=<yyyymm>/   the sums of a month's facts per some of their keys
    order_index/v=<version>-<load>/bucket=<n>/           the months of a bucket of orders, and when they last changed
    state_*/v=<version>-<load>/bucket=<n>/               newest source rows, in a warehouse kept by change files

A run-log row names every part that belongs to it. A load writes new parts beside the old ones, so running readers keep
their files, a failed load leaves nothing visible, and a load rewrites only the months it touches. A version's row can
be created once: of two loads that start from one version, the later one fails and leaves nothing visible either.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.functions.numeric import MONEY_SUM
from parcelmart.sources.commits import write_new

SCHEMAS = {
    "dim_product": "product_id bigint, name string, category string, current_price decimal(18,2)",
    "dim_user": "user_id bigint, city string, country string, gender string, date_of_birth date",
    "dim_rider": "rider_id bigint, vehicle_type string, courier_name string, gender string",
    "dim_date": "date_id int, year int, quarter int, month int, day int, day_of_week int, is_weekend boolean",
    "fact_orders": (
        "fact_id bigint, order_id bigint, product_id bigint, user_id bigint, rider_id bigint, delivery_date_id int, "
        "quantity int, unit_price decimal(18,2), total_price decimal(18,2)"
    ),
}
QUALITY_COLUMNS = (
    "total_rows",
    "missing_product_id",
    "missing_user_id",
    "missing_rider_id",
    "missing_delivery_date_id",
    "missing_unit_price",
)
RUNS_SCHEMA = (
    "version bigint, run_date timestamp, last_fact_id bigint, order_buckets int, feeds map<string,bigint>, "
    "parts array<struct<table:string, piece:int, version:bigint, load:string, bytes:bigint>>, "
    f"quality struct<{', '.join(f'{c}:bigint' for c in QUALITY_COLUMNS)}>"
)
DIMENSIONS = ("dim_product", "dim_user", "dim_rider", "dim_date")
# Sums of facts kept per month: the fact columns they are grouped by.
SUMS = {
    "sums_user": ("delivery_month", "user_id"),
    "sums_rider": ("delivery_month", "rider_id"),
    "sums_product": ("delivery_month", "delivery_date_id", "product_id"),
}
_KEY_TYPES = {"delivery_date_id": "int"}
_SUM_SCHEMAS = {
    name: ", ".join(
        [f"{k} {_KEY_TYPES.get(k, 'bigint')}" for k in keys if k != "delivery_month"]
        + [f"total_price {MONEY_SUM}", "quantity bigint", "items bigint"]
    )
    for name, keys in SUMS.items()
}
INDEX_SCHEMA = "order_id bigint, delivery_month int, changed timestamp"
# Columns of change rows by source table; an order comes with its items.
CHANGES = {
    "products": {"id": "bigint", "category": "string", "name": "string", "price": "decimal(18,2)", "updatedAt": "timestamp"},
    "users": dict.fromkeys(["id", "city", "country", "gender", "dateOfBirth", "updatedAt"], "string")
    | {"id": "bigint", "updatedAt": "timestamp"},
    "riders": {"id": "bigint", "vehicleType": "string", "courierId": "bigint", "gender": "string", "updatedAt": "timestamp"},
    "couriers": {"id": "bigint", "name": "string", "updatedAt": "timestamp"},
    "orders": {
        "id": "bigint",
        "userId": "bigint",
        "deliveryDate": "string",
        "deliveryRiderId": "bigint",
        "updatedAt": "timestamp",
        "items": "array<struct<ProductId:bigint,quantity:int,updatedAt:timestamp>>",
    },
}
# Rows that a warehouse kept by changes remembers; orders wait there as long as a product of theirs is unknown.
STATE_SCHEMAS = {f"state_{name}": ", ".join(f"{c} {kind}" for c, kind in cs.items()) for name, cs in CHANGES.items()}
STATE_SCHEMAS["state_orders"] += ", changed timestamp"
# Tables stored in pieces, their columns and the column that tells the pieces apart.
PIECES = {
    "fact_orders": (SCHEMAS["fact_orders"], "delivery_month"),
    **{name: (schema, "delivery_month") for name, schema in _SUM_SCHEMAS.items()},
    "order_index": (INDEX_SCHEMA, "bucket"),
    **{name: (schema, "bucket") for name, schema in STATE_SCHEMAS.items()},
}
KEYS = {"dim_product": "product_id", "dim_user": "user_id", "dim_rider": "rider_id", "dim_date": "date_id"}

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# A dimension is broadcast up to this many bytes, counted as a hash table's rows.
BROADCAST_BYTES = 64 * 1024 * 1024


def delivery_month() -> Column:
    """Partition value of a fact: yyyymm of the delivery, 0 where it has no date."""
    return F.coalesce(F.floor(F.col("delivery_date_id") / 100), F.lit(0)).cast("int").alias("delivery_month")


@dataclass(frozen=True)
class Part:
    """One piece of a warehouse table as one load wrote it; ``piece`` is a month or bucket, None for a whole table."""

    table: str
    piece: int | None
    version: int
    load: str = ""
    bytes: int | None = None

    @property
    def month(self) -> int | None:
        return self.piece

    @property
    def folder(self) -> str:
        """Place of the part's version below the warehouse folder."""
        return f"{self.table}/v={self.version}-{self.load}"


@dataclass(frozen=True)
class Commit:
    """What the run log says of one load; version 0 stands for no load yet."""

    version: int = 0
    run_date: datetime | None = None
    last_fact_id: int = 0
    order_buckets: int = 0
    feeds: Mapping[str, int] = field(default_factory=dict)
    parts: Sequence[Part] = ()

    def of(self, table: str) -> list[Part]:
        return [p for p in self.parts if p.table == table]


class LoadConflict(RuntimeError):
    """Another load has committed the version this one was to become."""


class Warehouse:
    """The warehouse tables, each built when it is first asked for, and the sizes in bytes known for some of them.

    ``sums`` are kept sums of the facts; a warehouse that was not stored has none. ``facts_between`` builds the facts of a
    range of days where that takes less than building all.
    """

    def __init__(
        self,
        loaders: Mapping[str, Callable[[], DataFrame]],
        sizes: Mapping[str, int] | None = None,
        sums: Mapping[str, Callable[[], DataFrame]] | None = None,
        facts_between: Callable[[int, int], DataFrame] | None = None,
    ) -> None:
        self._loaders = dict(loaders)
        self._sums = dict(sums or {})
        self._tables: dict[str, DataFrame] = {}
        self._facts_between = facts_between
        self.sizes = dict(sizes or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = (self._loaders.get(name) or self._sums[name])()
        return self._tables[name]

    def facts_between(self, start: int, end: int) -> DataFrame:
        """Facts with all those delivered from ``start`` to ``end`` (yyyymmdd, inclusive) among them."""
        return self._facts_between(start, end) if self._facts_between else self["fact_orders"]

    def has_sums(self, name: str) -> bool:
        """Whether the sums ``name`` are kept."""
        return name in self._sums

    def __iter__(self) -> Iterator[str]:
        return iter(self._loaders)

    def is_small(self, name: str) -> bool:
        """Whether the table is proven to be small enough to broadcast; dates are: a day takes 100 bytes, and the years
        that dates may have hold 214,000."""
        return name == "dim_date" or self.sizes.get(name, BROADCAST_BYTES + 1) <= BROADCAST_BYTES

    def create_views(self) -> None:
        """Register every table as a temporary view under its own name."""
        for name in self:
            self[name].createOrReplaceTempView(name)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log; empty before the first load."""
    try:
        return spark.read.schema(RUNS_SCHEMA).json(f"{path}/etl_runs")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUNS_SCHEMA)


def create_run_log(spark: SparkSession, path: str) -> None:
    """An empty run log, unless there is one."""
    spark.createDataFrame([], RUNS_SCHEMA).write.mode("ignore").json(f"{path}/etl_runs")


def write_commit(spark: SparkSession, path: str, commit: Commit, quality: Mapping[str, int] | None) -> None:
    """Create a load's row of the run log, which makes the load visible; raises ``LoadConflict`` if its version is taken."""
    row = {
        "version": commit.version,
        "run_date": commit.run_date.isoformat(timespec="microseconds"),
        "last_fact_id": commit.last_fact_id,
        "order_buckets": commit.order_buckets,
        "feeds": dict(commit.feeds),
        "parts": [vars(p) for p in commit.parts],
        "quality": {c: quality[c] for c in QUALITY_COLUMNS} if quality else None,
    }
    if not write_new(spark, f"{path}/etl_runs/{commit.version:012d}.json", json.dumps(row) + "\n"):
        raise LoadConflict(f"version {commit.version} of {path} has been committed by another load")


def last_run(runs_df: DataFrame) -> DataFrame:
    """Date of the last successful load, in one row (NULL when there was none)."""
    return runs_df.agg(F.max("run_date").alias("run_date"))


def last_commit(spark: SparkSession, path: str, version: int | None = None) -> Commit:
    """The last committed load, or that of a version.

    Versions order the loads, not the clock, so a clock that was set back hides nothing.
    """
    log = runs(spark, path) if version is None else runs(spark, path).filter(F.col("version") == version)
    micros = F.unix_micros("run_date").alias("micros")
    row = log.agg(F.max_by(F.struct("*", micros), "version").alias("newest")).first()["newest"]
    if row is None:
        return Commit()
    date = EPOCH + timedelta(microseconds=row["micros"])
    parts = tuple(Part(*p) for p in row["parts"])
    return Commit(row["version"], date, row["last_fact_id"], row["order_buckets"], row["feeds"] or {}, parts)


def latest_parts(spark: SparkSession, path: str) -> tuple[list[Part], int]:
    """The parts of the last committed snapshot and the highest fact key handed out so far."""
    commit = last_commit(spark, path)
    return list(commit.parts), commit.last_fact_id


def read_parts(spark: SparkSession, path: str, table: str, parts: Sequence[Part]) -> DataFrame:
    """The table made of the given parts, one in pieces with the column that tells them apart."""
    parts = [p for p in parts if p.table == table]
    if table not in PIECES:
        if not parts:
            return spark.createDataFrame([], SCHEMAS[table])
        return spark.read.schema(SCHEMAS[table]).parquet(*[f"{path}/{p.folder}" for p in parts])
    columns, key = PIECES[table]
    schema = f"{columns}, v string, {key} int"
    if not parts:
        return spark.createDataFrame([], schema).drop("v")
    folders = [f"{path}/{p.folder}/{key}={p.piece}" for p in parts]
    return spark.read.schema(schema).option("basePath", f"{path}/{table}").parquet(*folders).drop("v")


def warehouse(spark: SparkSession, path: str, version: int | None = None) -> Warehouse:
    """The last committed snapshot of a warehouse folder, or that of a version."""
    parts = last_commit(spark, path, version).parts
    loaders = {name: partial(read_parts, spark, path, name, parts) for name in SCHEMAS}
    sums = {name: partial(read_parts, spark, path, name, parts) for name in SUMS}
    sizes = {p.table: p.bytes for p in parts if p.piece is None and p.bytes is not None}
    return Warehouse(loaders, sizes, sums)
