"""The load job: source tables -> cleaned dimensions and fact -> a new warehouse snapshot."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelmart.operators import load
from parcelmart.operators.dims import dedup, dim_date, dim_product, dim_rider, dim_user
from parcelmart.operators.fact import FACT_COLUMNS, delivery_day_id, fact_rows
from parcelmart.operators.key_filter import MOST_WORDS, may_match
from parcelmart.operators.order_index import bucket_of, buckets_for, months_of_orders, months_with, parts_with
from parcelmart.operators.sums import summed
from parcelmart.session import work_table
from parcelmart.sources.tables import Source, read_source
from parcelmart.sources.warehouse import (
    EPOCH,
    KEYS,
    SUMS,
    Commit,
    Part,
    Warehouse,
    last_commit,
    read_parts,
    warehouse,
)

# Touched orders that are broadcast at most, at some 60 bytes each.
BROADCAST_ORDERS = 1_000_000
# Words of the bit filter that tells items of the orders asked for: 8 MB, which four million orders fill by a sixteenth.
ORDER_WORDS = MOST_WORDS
# Kept sums with hardly fewer rows than there are facts.
NEARLY_UNIQUE = ("sums_product",)


@dataclass(frozen=True)
class Load:
    """One run of a load: the commit it starts from, and the name its parts get. No two loads write to one folder."""

    spark: SparkSession
    path: str
    old: Commit
    name: str

    def part(self, table: str, piece: int | None = None, size: int | None = None) -> Part:
        return Part(table, piece, self.old.version + 1, self.name, size)

    def folder(self, table: str) -> str:
        return f"{self.path}/{self.part(table).folder}"

    def read(self, table: str, parts: Sequence[Part] | None = None) -> DataFrame:
        """A table of the snapshot the load starts from, or some parts of it."""
        return read_parts(self.spark, self.path, table, self.old.of(table) if parts is None else parts)

    def date(self, now: datetime | None) -> datetime:
        """Date of the run: now, or just past the last run if the clock is behind it."""
        now = now or datetime.now(timezone.utc)
        return now if self.old.run_date is None else max(now, self.old.run_date + timedelta(microseconds=1))

    def commit(self, run_date: datetime, parts: Sequence[Part], **changes: object) -> Commit:
        return replace(self.old, version=self.old.version + 1, run_date=run_date, parts=tuple(parts), **changes)


def start_load(spark: SparkSession, path: str) -> Load:
    """A load that starts from the last committed snapshot."""
    return Load(spark, path, last_commit(spark, path), uuid.uuid4().hex[:12])


def side_by_side(spark: SparkSession, runs: Sequence[Callable[[], object]]) -> list:
    """Results of several runs whose jobs share the cluster instead of queueing."""
    with ThreadPoolExecutor(len(runs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(run)) for run in runs]]


def dimensions(source: Source) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the dimensions that carry a change date."""
    return {
        "dim_product": lambda: dim_product(read_source("products", source)),
        "dim_user": lambda: dim_user(read_source("users", source)),
        "dim_rider": lambda: dim_rider(read_source("riders", source), read_source("couriers", source)),
    }


def source_facts(source: Source) -> DataFrame:
    """Fact rows of the whole source."""
    return fact_rows(*(read_source(name, source) for name in ("order_items", "orders", "products")))


def source_facts_between(source: Source, start: int, end: int) -> DataFrame:
    """Fact rows of the orders delivered from ``start`` to ``end`` (yyyymmdd, inclusive).

    The orders are told first, and a bit filter of their ids keeps the items of nearly all others off both joins.
    """
    items, orders, products = (read_source(name, source) for name in ("order_items", "orders", "products"))
    orders = orders.filter(delivery_day_id().between(start, end))
    items = items.filter(may_match(orders.select(F.col("id").alias("OrderId")), "OrderId", ORDER_WORDS))
    return fact_rows(items, orders, products, how="inner")


def derived_warehouse(source: Source) -> Warehouse:
    """The warehouse computed from the source tables on the fly, with nothing written.

    Facts have no surrogate key here; no query needs it.
    """
    stamped = {**dimensions(source), "fact_orders": lambda: source_facts(source)}
    loaders = {name: lambda build=build: load.drop_control(build()) for name, build in stamped.items()}
    between = lambda start, end: load.drop_control(source_facts_between(source, start, end))
    return Warehouse({**loaders, "dim_date": lambda: dim_date(read_source("orders", source))}, facts_between=between)


def watermark(runs_df: DataFrame) -> DataFrame:
    """Date from which changes are loaded: that of the last run, 1970-01-01 before the first one."""
    return runs_df.agg(F.coalesce(F.max("run_date"), F.lit(EPOCH)).alias("run_date"))


def touched_orders(items: DataFrame, orders: DataFrame, since: datetime) -> DataFrame:
    """Ids of orders that changed or have a changed item; the date filters are pushed to the source."""
    changed = [order_ids(load.changed_since(rows, since), key) for rows, key in ((orders, "id"), (items, "OrderId"))]
    return changed[0].union(changed[1]).dropna().distinct()


def undated_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Ids of orders without a change date, or with an item without one."""
    undated = [order_ids(load.undated(rows), key) for rows, key in ((orders, "id"), (items, "OrderId"))]
    return undated[0].union(undated[1]).dropna().distinct()


def order_ids(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("bigint").alias("order_id"))


def run_etl(spark: SparkSession, source: Source, path: str, now: datetime | None = None) -> Warehouse:
    """Load everything changed since the last run and commit a new snapshot.

    The first load takes all rows. Later loads replace what changed and add undated keys the target does not have; what
    is gone from the source stays. The run is dated before anything is read, so a change made while it runs is picked up
    by the next one; a date that is not after the last run's is moved just past it. A price change alone does not touch
    facts: they keep the price of their load. Of two loads that run at once, one raises ``LoadConflict`` and shows nothing.
    """
    run = start_load(spark, path)
    if run.old.feeds:
        raise ValueError(f"{path} is kept by change files; a load from a source would not know their dates")
    since, run_date = run.old.run_date, run.date(now)
    # The tables do not depend on each other.
    loads: list[Callable] = [partial(_load_facts, run, source, since)]
    loads += [partial(_load_dimension, run, name, source, since) for name in dimensions(source)]
    loads.append(partial(_load_dates, run, read_source("orders", source), since))
    (facts, quality), *others = side_by_side(spark, loads)
    parts = [*(p for p in others if p), *facts.parts]
    load.record_run(spark, path, run.commit(run_date, parts, **facts.numbers), quality)
    return warehouse(spark, path)


def changed_source(source: Source, name: str, since: datetime) -> Source:
    """``source`` with the tables of a dimension cut to rows of changed keys, by filters that reach the scan.

    The newest row of a key is also the newest of its changed rows, so nothing else of them is needed.
    """
    if name != "dim_rider":
        return lambda table: load.changed_since(source(table), since)
    riders, couriers = source("riders"), source("couriers")
    moved = load.changed_since(couriers, since).select(F.col("id").alias("courierId"))
    touched = load.changed_since(riders, since).select("id").union(riders.join(moved, "courierId", "left_semi").select("id"))
    cut = riders.join(touched.distinct(), "id", "left_semi")
    return lambda table: cut if table == "riders" else source(table)


def undated_source(source: Source) -> Source:
    """``source`` with the tables of a dimension cut to rows without a change date; couriers stay, as riders need theirs."""
    return lambda table: source(table) if table == "couriers" else load.undated(source(table))


def _load_dimension(run: Load, name: str, source: Source, since: datetime | None) -> Part | None:
    old = run.old.of(name)
    if not old or since is None:
        rows = load.drop_control(dimensions(source)[name]())
        return run.part(name, size=load.write_table(rows, run.folder(name)))
    target, key = run.read(name), KEYS[name]
    fresh = dimensions(changed_source(source, name, since))[name]()
    unknown = load.new_rows(target, dimensions(undated_source(source))[name](), key)
    with work_table(dedup(fresh.unionByName(unknown), key), name) as found:
        return replace_rows(run, name, found)


def replace_rows(run: Load, name: str, found: DataFrame) -> Part:
    """The part of a dimension with the rows of ``found`` in place of those of the same keys."""
    old = run.old.of(name)
    if old and found.isEmpty():
        return old[0]
    rows = load.upsert(run.read(name), found, KEYS[name]) if old else load.drop_control(found)
    return run.part(name, size=load.write_table(rows, run.folder(name)))


def _load_dates(run: Load, orders: DataFrame, since: datetime | None) -> Part:
    if since is None:
        return add_dates(run, orders)
    return add_dates(run, orders.filter(load.changed(orders, since) | load.change_date(orders).isNull()))


def add_dates(run: Load, orders: DataFrame) -> Part:
    """The part of the date dimension with the delivery days of ``orders`` in it."""
    days, old = dim_date(orders), run.old.of("dim_date")
    if old:
        target = run.read("dim_date")
        if load.new_rows(target, days, "date_id").isEmpty():
            return old[0]
        days = load.insert_new(target, days, "date_id")
    return run.part("dim_date", size=load.write_table(days, run.folder("dim_date")))


@dataclass(frozen=True)
class FactParts:
    """Parts of facts, their sums and the order index after a load, and the commit's numbers that follow from them."""

    parts: list[Part]
    numbers: dict[str, int]


def _load_facts(run: Load, source: Source, since: datetime | None) -> tuple[FactParts, dict | None]:
    """Replace the facts of every touched order, rewriting only the months these facts are or were in."""
    items, orders, products = (read_source(t, source) for t in ("order_items", "orders", "products"))
    seen = Observation()
    if since is None:
        return write_facts(run, fact_rows(items, orders, products, seen)), seen.get
    with work_table(undated_orders(items, orders), "undated") as undated:
        touched = touched_orders(items, orders, since)
        if not undated.isEmpty():
            hit = parts_with(run.old.of("order_index"), undated, run.old.order_buckets)
            known = run.read("order_index", hit).filter(F.col("delivery_month").isNotNull())
            touched = touched.union(load.new_rows(known, undated, "order_id")).distinct()
        with work_table(touched, "touched") as ids:
            n = ids.count()
            if not n:
                return kept_facts(run), None
            keyed_orders = orders.withColumn("order_id", F.col("id").cast("bigint"))
            if n > BROADCAST_ORDERS:
                # Every touched order, with its columns if it is there: items are shuffled once, to these.
                hit_orders = ids.join(keyed_orders, "order_id", "left").withColumn("id", F.col("order_id")).drop("order_id")
                with work_table(hit_orders, "touched-orders") as found:
                    return write_facts(run, fact_rows(items, found, products, seen, "inner"), ids), seen.get
            ids = F.broadcast(ids)
            hit_items = items.withColumn("order_id", F.col("OrderId").cast("bigint")).join(ids, "order_id", "left_semi")
            hit_orders = keyed_orders.join(ids, "order_id", "left_semi")
            return write_facts(run, fact_rows(hit_items, hit_orders, products, seen), ids), seen.get


def few(orders: DataFrame, n: int) -> DataFrame:
    """Few touched orders are sent to the tables, many are joined by a shuffle."""
    return F.broadcast(orders) if n <= BROADCAST_ORDERS else orders


def kept_facts(run: Load) -> FactParts:
    """Facts, sums and index as they were."""
    return FactParts([p for p in run.old.parts if p.table in ("fact_orders", "order_index", *SUMS)], {})


def write_facts(
    run: Load, fresh: DataFrame, replaced: DataFrame | None = None, stamps: DataFrame | None = None
) -> FactParts:
    """Write ``fresh`` facts (with ``updated_at``) and put them in place of those of the ``replaced`` orders.

    Months that get or lose a fact are written anew with the facts they keep, and so are their sums; the index tells
    which months these are, so no other month is read. Without ``replaced`` nothing was there before. ``stamps`` (order_id,
    changed) are put into the index for orders that have no facts, too.
    """
    old, index = run.old.of("fact_orders"), run.old.of("order_index")
    stale = set()
    if replaced is not None:
        stale = months_with(run.spark, run.path, index, replaced, run.old.order_buckets)
    folder = run.folder("fact_orders")
    # Written as they come, which fixes them: numbers and index are taken from the same rows.
    with work_table(fresh.select(*FACT_COLUMNS, "updated_at"), "fact-rows") as fixed:
        n = fixed.count()
        number = partial(load.number_facts, fixed, n, folder, run.old.last_fact_id + 1)
        buckets = buckets_for(run.old.last_fact_id + n)
        (_, months), index = side_by_side(run.spark, [number, partial(_write_index, run, fixed, replaced, buckets, stamps)])
    again = [p for p in old if p.piece in stale | months]
    if again:
        kept = run.read("fact_orders", again).join(replaced, "order_id", "left_anti")
        order = ["delivery_month", "order_id", "fact_id"]
        tasks = load.sorting_tasks(kept, run.read("fact_orders", again).count())
        placed = kept.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        months = months | load.write_months(placed, folder, "append")[1]
    gone = {p.piece for p in again} | months
    written = [run.part("fact_orders", m) for m in sorted(months)]
    sums = side_by_side(run.spark, [partial(_write_sums, run, name, written, gone) for name in SUMS])
    parts = [*(p for p in old if p.piece not in gone), *written, *index, *(p for parts in sums for p in parts)]
    return FactParts(parts, {"last_fact_id": run.old.last_fact_id + n, "order_buckets": buckets})


def _write_index(
    run: Load, fixed: DataFrame, replaced: DataFrame | None, buckets: int, stamps: DataFrame | None
) -> list[Part]:
    """Parts of the index after the replaced orders got the months of their new facts; only their buckets are rewritten,
    or all when the number of buckets has grown."""
    index, rows, hit = run.old.of("order_index"), months_of_orders(fixed), []
    if stamps is not None:
        rows = stamps.join(rows.drop("changed"), "order_id", "left").select("order_id", "delivery_month", "changed")
    if replaced is not None:
        hit = parts_with(index, replaced, buckets) if buckets == run.old.order_buckets else index
        before = run.read("order_index", hit).join(replaced, "order_id", "left_anti")
        rows = before.select(*rows.columns).unionByName(rows)
    dealt = rows.withColumn("bucket", bucket_of(buckets)).repartition(buckets, "bucket")
    _, pieces = load.write_pieces(dealt, run.folder("order_index"), "bucket")
    return [*(p for p in index if p not in hit), *(run.part("order_index", b) for b in sorted(pieces))]


def _write_sums(run: Load, name: str, written: list[Part], gone: set[int]) -> list[Part]:
    """Parts of kept sums after the facts of the ``written`` months took the place of those that are ``gone``."""
    kept = [p for p in run.old.of(name) if p.piece not in gone]
    if not written:
        return kept
    facts = read_parts(run.spark, run.path, "fact_orders", written)
    n, unique = facts.count(), name in NEARLY_UNIQUE
    files = -(-n // ((load.SORTED_PER_TASK if unique else load.FACTS_PER_TASK) * len(written)))
    salt = F.pmod(F.xxhash64(*SUMS[name]), F.lit(max(1, files))).alias("salt")
    if unique:
        # Summing before the shuffle would hold nearly every fact in a hash table; one shuffle places and sums them, in
        # tasks of a number that is not made smaller by their bytes, as a sum takes many times those in memory.
        dealt = facts.select(*SUMS[name], "total_price", "quantity", salt)
        dealt = dealt.repartition(load.sorting_tasks(facts, n), "delivery_month", "salt")
        rows = summed(dealt, [*SUMS[name], "salt"]).drop("salt")
    else:
        rows = summed(facts, SUMS[name]).repartition("delivery_month", salt)
    _, pieces = load.write_pieces(rows, run.folder(name), "delivery_month")
    return [*kept, *(run.part(name, m) for m in sorted(pieces))]
