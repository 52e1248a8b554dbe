"""The load from change rows: the rows themselves are applied, and no source table is read.

A change row holds, in one column per source table, the new state of a product, user, rider, courier or order; an order
comes with all of its current items. Rows may come in any order and more than once: the newest state of a key wins, told
by its dates, and what is older than what the warehouse knows is left out. A batch that was committed before is skipped.

What a later batch needs is kept beside the warehouse tables, in buckets by key, of which a batch reads and rewrites those
its keys fall into: the newest dimension rows, the date each order last changed (in the order index), and orders that
hold a product not seen yet, whose facts are written again when it comes.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from parcelmart.operators import load
from parcelmart.operators.dims import dedup
from parcelmart.operators.fact import keyed_rows, nested_items
from parcelmart.operators.order_index import bucket_of, parts_with
from parcelmart.plans import etl
from parcelmart.session import work_table
from parcelmart.sources.tables import SOURCE_COLUMNS, Source
from parcelmart.sources.warehouse import CHANGES, Part, Warehouse, warehouse

BUCKETS = 32
# Tables of the dimensions; orders are kept in another way.
STATED = ("products", "users", "riders", "couriers")
CHANGE_TYPES = {t: f"struct<{', '.join(f'{c}:{kind}' for c, kind in columns.items())}>" for t, columns in CHANGES.items()}
CHANGES_SCHEMA = ", ".join(f"{table} {kind}" for table, kind in CHANGE_TYPES.items())


def changes_of(source: Source) -> DataFrame:
    """Every row of a source as a change row; orders with all of their items."""
    # Dealt first: lists of few items each save nothing before the shuffle, but would be sorted in whole scan tasks.
    items = source("order_items").repartition("OrderId").groupBy(F.col("OrderId").alias("id")).agg(
        F.collect_list(F.struct("ProductId", "quantity", "updatedAt")).alias("items")
    )
    tables = {name: source(name) for name in STATED} | {"orders": source("orders").join(items, "id", "left")}

    def rows_of(table: str) -> DataFrame:
        row = F.struct(*CHANGES[table]).cast(CHANGE_TYPES[table])
        return tables[table].select(
            *[(row if name == table else F.lit(None).cast(kind)).alias(name) for name, kind in CHANGE_TYPES.items()]
        )

    return reduce(DataFrame.unionByName, map(rows_of, CHANGE_TYPES))


def apply_changes(
    changes: DataFrame, path: str, batch: int | None = None, feed: str = "changes", now: datetime | None = None
) -> Warehouse:
    """Apply a batch of change rows to the warehouse and commit a new snapshot.

    ``batch`` numbers the batches of a ``feed``; one that is not above the last committed number has been applied before
    and changes nothing. Rows without a key are left out. Of two states of a dimension row with one date the greater one
    wins, whenever it comes; of two states of an order with one date the first to come stays. The newest state of a key
    without any date is taken if the key is new. A warehouse is kept either by changes or by loads from a source.
    """
    spark = changes.sparkSession
    run = etl.start_load(spark, path)
    last = run.old.feeds.get(feed, -1)
    if batch is not None and batch <= last:
        return warehouse(spark, path)
    if run.old.version and not run.old.feeds:
        raise ValueError(f"{path} is kept by loads from a source; changes would not know what is older than its rows")
    with ExitStack() as held:
        hold = lambda df, name: held.enter_context(work_table(df, name))
        rows = hold(changes, "changes")
        fresh = {t: hold(_states(rows, t), f"fresh-{t}") for t in STATED}
        state = dict(zip(STATED, etl.side_by_side(spark, [partial(_merge, run, t, fresh[t]) for t in STATED])))
        events, reapplied = _due_orders(run, rows, state, fresh["products"])
        due = hold(events.unionByName(reapplied), "due")
        dims = [partial(_dimension, run, name, fresh, state) for name in ("dim_product", "dim_user", "dim_rider")]
        dims.append(partial(etl.add_dates, run, due))
        facts = partial(_facts, run, due, state["products"])
        (found, quality), waiting, *dim_parts = etl.side_by_side(
            spark, [facts, partial(_waiting, run, due, state["products"]), *dims]
        )
        parts = [*(p for p in dim_parts if p), *found.parts, *waiting, *(p for parts in state.values() for p in parts)]
        feeds = {**run.old.feeds, feed: last + 1 if batch is None else batch}
        load.record_run(spark, path, run.commit(run.date(now), parts, feeds=feeds, **found.numbers), quality)
    return warehouse(spark, path)


def _states(rows: DataFrame, table: str) -> DataFrame:
    """The newest state of each key among the changes of a table."""
    found = rows.filter(F.col(table).isNotNull()).select(f"{table}.*")
    return dedup(found.filter(F.col("id").isNotNull()), "id")


def _merge(run: etl.Load, table: str, fresh: DataFrame) -> list[Part]:
    """Parts of a table's state with the fresh rows in it where they are newer; only their buckets are rewritten."""
    name = f"state_{table}"
    old = run.old.of(name)
    if fresh.isEmpty():
        return old
    hit = parts_with(old, fresh, BUCKETS, "id")
    merged = dedup(run.read(name, hit).select(*fresh.columns).unionByName(fresh), "id")
    return [*(p for p in old if p not in hit), *_write_buckets(run, merged, name)]


def _write_buckets(run: etl.Load, rows: DataFrame, name: str) -> list[Part]:
    dealt = rows.withColumn("bucket", bucket_of(BUCKETS, "id")).repartition(BUCKETS, "bucket")
    _, pieces = load.write_pieces(dealt, run.folder(name), "bucket")
    return [run.part(name, b) for b in sorted(pieces)]


def _dimension(run: etl.Load, name: str, fresh: dict[str, DataFrame], state: dict[str, list[Part]]) -> Part | None:
    """The part of a dimension after its changed keys were built again from their newest states."""
    table = {"dim_product": "products", "dim_user": "users", "dim_rider": "riders"}[name]
    if fresh[table].isEmpty() and (table != "riders" or fresh["couriers"].isEmpty()):
        return (run.old.of(name) or [None])[0]
    ids = fresh[table].select("id")
    if table == "riders":
        # A courier's name stands in all of its riders.
        moved = fresh["couriers"].select(F.col("id").alias("courierId"))
        ids = ids.union(run.read("state_riders", state["riders"]).join(moved, "courierId", "left_semi").select("id")).distinct()
    parts = state[table] if table == "riders" else parts_with(state[table], ids, BUCKETS, "id")
    rows = {table: run.read(f"state_{table}", parts).join(ids, "id", "left_semi")}
    rows["couriers"] = run.read("state_couriers", state["couriers"])

    def source(asked: str) -> DataFrame:
        missing = [c for c in SOURCE_COLUMNS[asked] if c not in rows[asked].columns]
        return rows[asked].select("*", *[F.lit(None).cast("string").alias(c) for c in missing])

    with work_table(etl.dimensions(source)[name](), name) as found:
        return etl.replace_rows(run, name, found)


def _due_orders(
    run: etl.Load, rows: DataFrame, state: dict[str, list[Part]], products: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Orders whose newest change is newer than what the warehouse has, and waiting orders a product of which has come."""
    items_changed = F.array_max(F.transform("items", lambda i: i["updatedAt"]))
    changed = F.greatest(F.col("updatedAt"), items_changed).alias("changed")
    events = rows.filter(F.col("orders").isNotNull()).select("orders.*").select("*", changed)
    # Dealt first: orders with their items are wide, and would be sorted in whole scan tasks and again after the shuffle.
    events = dedup(events.filter(F.col("id").isNotNull()).repartition("id"), "id", "changed")
    index = parts_with(run.old.of("order_index"), events, run.old.order_buckets, "id")
    known = run.read("order_index", index).groupBy(F.col("order_id").alias("id")).agg(
        F.max("changed").alias("last"), F.lit(True).alias("known")
    )
    newer = F.col("known").isNull() | (F.col("changed") > F.col("last")) | (F.col("last").isNull() & F.col("changed").isNotNull())
    fresh = events.join(known, "id", "left").filter(newer).select(*events.columns)
    waiting = run.read("state_orders").select(*events.columns)
    come = waiting.select("id", F.explode("items.ProductId").alias("ProductId")).join(
        products.select(F.col("id").alias("ProductId")), "ProductId", "left_semi"
    )
    again = waiting.join(come.select("id").distinct(), "id", "left_semi").join(fresh.select("id"), "id", "left_anti")
    return fresh, again


def _items(orders: DataFrame) -> DataFrame:
    """The items of orders as a table of their own."""
    return orders.select(F.col("id").alias("OrderId"), F.inline("items"))


def _known_products(run: etl.Load, items: DataFrame, products: Sequence[Part]) -> DataFrame:
    """Newest states of products in the buckets of those that the items name."""
    ids = items.select(F.col("ProductId").alias("id")).dropna().distinct()
    return run.read("state_products", parts_with(products, ids, BUCKETS, "id"))


def _facts(run: etl.Load, due: DataFrame, products: Sequence[Part]) -> tuple[etl.FactParts, dict | None]:
    n = due.count()
    if not n:
        return etl.kept_facts(run), None
    items, seen = _items(due), Observation()
    facts = keyed_rows(nested_items(due, _known_products(run, items, products)), seen)
    ids = etl.few(due.select(F.col("id").alias("order_id")), n)
    stamps = due.select(F.col("id").alias("order_id"), "changed")
    return etl.write_facts(run, facts, ids if run.old.of("order_index") else None, stamps), seen.get


def _waiting(run: etl.Load, due: DataFrame, products: Sequence[Part]) -> list[Part]:
    """Parts with the orders that wait for a product: those that did and were not applied, and those applied without one."""
    old = run.old.of("state_orders")
    if due.isEmpty():
        return old
    items = _items(due).dropna(subset="ProductId")
    known = _known_products(run, items, products).select(F.col("id").alias("ProductId"))
    lacking = items.join(known, "ProductId", "left_anti").select(F.col("OrderId").alias("id")).distinct()
    still = run.read("state_orders").select(*due.columns).join(due.select("id"), "id", "left_anti")
    rows = still.unionByName(due.join(lacking, "id", "left_semi"))
    return _write_buckets(run, rows, "state_orders")
