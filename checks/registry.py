"""Every operator as a query ``(spark, sf_dir) -> DataFrame`` over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelmart.functions import calendar as cal
from parcelmart.functions import clean, numeric
from parcelmart.operators import dims, fact, load
from parcelmart.operators.key_filter import may_match
from parcelmart.operators.ranking import global_rank, percent_rank_pct, previous_value, trailing_rows
from parcelmart.operators.star import (
    Dim,
    date_id_between,
    delivered_in,
    extremes,
    opt_filter,
    rollup_distinct,
    rollup_labelled,
    share_of_total,
    star_sum,
    top_k,
)
from parcelmart.plans import etl, queries, reports, upkeep
from parcelmart.plans.changes import apply_changes, changes_of
from parcelmart.session import fresh_dir, prepare, work_table
from parcelmart.sources import warehouse as store
from parcelmart.sources.tables import Source, read_source
from parcelmart.sources.testdata import mapped_source
from parcelmart.sources.warehouse import Warehouse

WATERMARK = datetime(1998, 1, 1, tzinfo=timezone.utc)
SECOND_RUN = datetime(2002, 1, 1, tzinfo=timezone.utc)


class Context:
    """The tables of one scale-factor folder in the forms the queries need; nothing is computed before it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.table = lru_cache(maxsize=None)(lambda name: read_source(name, self.source))

    @cached_property
    def source(self) -> Source:
        return lru_cache(maxsize=None)(mapped_source(self.spark, self.sf_dir))

    @cached_property
    def wh(self) -> Warehouse:
        """The warehouse as one lazy plan over the test tables."""
        return etl.derived_warehouse(self.source)

    @cached_property
    def path(self) -> str:
        """A stored warehouse loaded in two runs: the source as of the watermark, then the whole source as of its newest change."""
        path = fresh_dir(self.spark, "warehouse")
        early = lambda name: self.source(name).filter(F.col("updatedAt") <= F.lit(WATERMARK))
        etl.run_etl(self.spark, early, path, WATERMARK)
        micros = self.source("order_items").agg(F.unix_micros(F.max("updatedAt"))).first()[0]
        etl.run_etl(self.spark, self.source, path, etl.EPOCH + timedelta(microseconds=micros))
        return path

    def facts_after(self, first: Source, second: Source) -> DataFrame:
        """Stored facts after a load of one source and then of another."""
        path = fresh_dir(self.spark, "warehouse")
        etl.run_etl(self.spark, first, path, WATERMARK)
        return etl.run_etl(self.spark, second, path, SECOND_RUN)["fact_orders"].select(*fact.FACT_COLUMNS)

    @cached_property
    def fed(self) -> Warehouse:
        """A warehouse kept by change rows: in three batches, some rows early, some late, older states after newer ones, and
        batches that come again."""
        path = fresh_dir(self.spark, "warehouse")
        with work_table(changes_of(self.source), "changes") as rows:
            key = F.coalesce(*[F.col(f"{t}.id") for t in store.CHANGES])
            late = F.col("products").isNotNull() & (key % 5 == 0)
            batches = [rows.filter((key % 3 == 0) & ~late), _older(rows).unionByName(rows.filter((key % 3 == 1) & ~late))]
            batches.append(rows)
            for n, batch in enumerate(batches):
                apply_changes(batch, path, n)
                fed = apply_changes(batches[0], path, n)
        return fed

    @cached_property
    def loaded(self) -> Warehouse:
        return store.warehouse(self.spark, self.path)

    @cached_property
    def facts(self) -> DataFrame:
        return etl.source_facts(self.source)

    @cached_property
    def items(self) -> DataFrame:
        return fact.joined_items(self.table("order_items"), self.table("orders"), self.table("products"))


@lru_cache(maxsize=None)
def context(spark: SparkSession, sf_dir: str) -> Context:
    """One context per session and folder, so tables are resolved and the stored warehouse is loaded once."""
    return Context(prepare(spark), sf_dir)


def _older(rows: DataFrame) -> DataFrame:
    """Orders and users as they may have been years before: one item, another user, another city."""
    before = lambda t: F.col(t).withField("updatedAt", F.col(f"{t}.updatedAt") - F.expr("INTERVAL 3000 DAYS"))
    undated = lambda i: i.withField("updatedAt", F.lit(None).cast("timestamp"))
    orders = before("orders").withField("items", F.transform(F.slice("orders.items", 1, 1), undated))
    changed = {"orders": orders.withField("userId", F.lit(1).cast("bigint")), "users": before("users").withField("city", F.lit("Old"))}
    return rows.withColumns(changed).filter("orders IS NOT NULL OR users IS NOT NULL")


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text, so two engines' results can be compared by value."""
    plain = {"decimal": "double", "date": "string", "timestamp": "string", "timestamp_ntz": "string"}
    kinds = {f.name: plain.get(f.dataType.typeName()) for f in df.schema.fields}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if kinds[c] else F.col(c) for c in df.columns])


Q2 = lambda c: queries.customer_distribution(c.wh, with_gid=True)
Q6 = lambda c: queries.vehicle_deliveries(c.wh, with_gid=True)
Q7 = lambda c, **k: queries.top_percentile_riders(c.wh, **{"year": 1998, "quarter": 2, "country": "ASIA", **k})
DRILL = lambda c, **k: reports.drilldown(c.wh, **{"year": 1998, **k})

SCANS: dict[str, Callable[[Context], DataFrame]] = {
    "s1_orders": lambda c: c.table("orders"),
    "s2_order_items": lambda c: c.table("order_items"),
    "s3_products": lambda c: c.table("products"),
    "s4_users": lambda c: c.table("users"),
    "s5_riders": lambda c: c.table("riders"),
    "s6_couriers": lambda c: c.table("couriers"),
    "s7_last_run": lambda c: store.last_run(store.runs(c.spark, c.path)),
    "s8_warehouse_fact": lambda c: c.loaded["fact_orders"].select(*fact.FACT_COLUMNS),
    "s8_warehouse_q1": lambda c: queries.revenue_by_period(c.loaded, "1998-01-01", "1998-12-31"),
    "s8_warehouse_q2": lambda c: queries.customer_distribution(c.loaded),
    "s8_warehouse_q3": lambda c: queries.top_products(c.loaded, 5, "ASIA"),
    "s8_warehouse_q4": lambda c: queries.sales_moving_average(c.loaded),
    "s8_warehouse_q5": lambda c: queries.rider_ranking(c.loaded),
    "s8_warehouse_q6": lambda c: queries.vehicle_deliveries(c.loaded, None, 10),
    "s8_warehouse_q7": lambda c: queries.top_percentile_riders(c.loaded, 1998, 1, "ASIA", 25),
    "s8_warehouse_q8": lambda c: queries.revenue_rollup(c.loaded, 1998, "ASIA", "NATION_2"),
    "s8_warehouse_q9": lambda c: queries.revenue_rollup_filtered(c.loaded, 1998),
    "s9_date_keys": lambda c: c.loaded["dim_date"].select("date_id"),
}


def _upsert(c: Context) -> DataFrame:
    """Products as of the watermark with outdated prices, then everything changed since."""
    rows = dims.dim_product(c.table("products"))
    target = load.drop_control(rows).withColumn("current_price", (F.col("current_price") + 1).cast("decimal(18,2)"))
    return load.upsert(target, load.changed_since(rows, WATERMARK), "product_id")


def _insert_dates(c: Context) -> DataFrame:
    """Days of the orders up to the watermark, marked by a wrong weekend flag that must survive, then all days."""
    early = c.table("orders").filter(F.col("updatedAt") <= F.lit(WATERMARK))
    target = dims.dim_date(early).withColumn("is_weekend", ~F.col("is_weekend"))
    return load.insert_new(target, dims.dim_date(c.table("orders")), "date_id")


def _replace_orders(c: Context) -> DataFrame:
    """All facts with outdated quantities; orders with any change get all their current items back."""
    outdated = load.drop_control(c.facts).withColumn("quantity", F.col("quantity") + 100)
    return load.replace_by_group(outdated, c.facts, load.changed_since(c.facts, WATERMARK, "updated_at"), "order_id")


def _written(c: Context, df: DataFrame) -> DataFrame:
    path = fresh_dir(c.spark, "table")
    load.write_table(df, path)
    return c.spark.read.schema(df.schema).parquet(path)


def _numbered(c: Context) -> DataFrame:
    path = fresh_dir(c.spark, "numbered")
    load.write_numbered_facts(c.facts, path, 1)
    return c.spark.read.parquet(path).drop("delivery_month")


LATER_CHANGE = datetime(2001, 6, 1, tzinfo=timezone.utc)


def _changed(c: Context, edits: dict[str, Callable[[DataFrame], DataFrame]]) -> Source:
    """The source with some tables edited."""
    return lambda name: edits[name](c.source(name)) if name in edits else c.source(name)


def _removed_rows(c: Context) -> DataFrame:
    """A second source that lacks customers and orders and has all others changed: nothing may be lost."""
    touch = lambda df: df.withColumn("updatedAt", F.lit(LATER_CHANGE))
    edits = {
        "users": lambda df: touch(df.filter("id % 7 <> 0")),
        "orders": lambda df: touch(df.filter("id % 5 <> 0")),
        "order_items": lambda df: touch(df.filter("OrderId % 5 <> 0")),
    }
    return c.facts_after(c.source, _changed(c, edits))


def _no_change_date(c: Context) -> DataFrame:
    """Orders without a change date, first missing and then there."""
    undated = lambda df: df.withColumn("updatedAt", F.when(F.col("id") % 4 != 0, F.col("updatedAt")))
    first = _changed(c, {"orders": lambda df: df.filter("id % 4 <> 0")})
    return c.facts_after(first, _changed(c, {"orders": undated}))


def _lost_keys(c: Context) -> DataFrame:
    """Changed orders that lose their user, and changed items that lose their product."""
    edits = {
        "orders": lambda df: df.withColumns(
            {
                "userId": F.when(F.col("id") % 6 != 0, F.col("userId")),
                "updatedAt": F.when(F.col("id") % 6 != 0, F.col("updatedAt")).otherwise(F.lit(LATER_CHANGE)),
            }
        ),
        "order_items": lambda df: df.withColumns(
            {
                "ProductId": F.when(F.expr("OrderId % 10 <> 1 OR quantity % 2 <> 0"), F.col("ProductId")),
                "updatedAt": F.when(F.expr("OrderId % 10 <> 1 OR quantity % 2 <> 0"), F.col("updatedAt")).otherwise(F.lit(LATER_CHANGE)),
            }
        ),
    }
    return c.facts_after(c.source, _changed(c, edits))


def _text_dates(c: Context) -> DataFrame:
    """Change dates of orders as text, some unreadable; in the second load orders lose their user."""
    text = lambda col: F.when(F.col("id") % 7 == 0, "no date").otherwise(col.cast("string"))
    first = lambda df: df.withColumn("updatedAt", text(F.col("updatedAt")))
    lost = F.expr("id % 9 = 0 AND id % 7 <> 0")
    second = lambda df: df.withColumns(
        {
            "userId": F.when(~lost, F.col("userId")),
            "updatedAt": F.when(lost, F.lit(LATER_CHANGE).cast("string")).otherwise(text(F.col("updatedAt"))),
        }
    )
    return c.facts_after(_changed(c, {"orders": first}), _changed(c, {"orders": second}))


def _one_winner(c: Context) -> DataFrame:
    """Of two loads that start from one version the second to commit fails; the run log afterwards."""
    path = fresh_dir(c.spark, "warehouse")
    late = etl.start_load(c.spark, path)
    etl.run_etl(c.spark, c.source, path, SECOND_RUN)
    outcome = "committed"
    try:
        load.record_run(c.spark, path, late.commit(SECOND_RUN, [], last_fact_id=0), None)
    except store.LoadConflict:
        outcome = "refused"
    return store.runs(c.spark, path).select("version", "last_fact_id", F.lit(outcome).alias("second"))


def _compacted(c: Context) -> DataFrame:
    """Facts with their keys after the months were merged, and the version before was deleted."""
    path = fresh_dir(c.spark, "warehouse")
    etl.run_etl(c.spark, c.source, path, SECOND_RUN)
    upkeep.compact(c.spark, path)
    upkeep.expire(c.spark, path, 1)
    return store.warehouse(c.spark, path)["fact_orders"].drop("delivery_month")


def _order_months(c: Context) -> DataFrame:
    parts = store.last_commit(c.spark, c.path).of("order_index")
    return store.read_parts(c.spark, c.path, "order_index", parts).select("order_id", "delivery_month")


def _kept_sums(name: str) -> Callable[[Context], DataFrame]:
    return lambda c: c.loaded[name]


def _load_quality(c: Context) -> DataFrame:
    """Quality counts a load has put in its run-log row."""
    path = fresh_dir(c.spark, "warehouse")
    etl.run_etl(c.spark, c.source, path, SECOND_RUN)
    return store.runs(c.spark, path).select("quality.*")


def _rewritten_dates(c: Context) -> DataFrame:
    """Delivery dates written in the fallback formats."""
    day, key = clean.parse_mixed_date(F.col("deliveryDate")), F.col("id") % 4
    text = F.date_format(day, "MMM d, yyyy")
    for i, form in enumerate(["yyyyMMdd", "MMMM d, yyyy", "d MMM yyyy"]):
        text = F.when(key == i, F.date_format(day, form)).otherwise(text)
    return c.table("orders").select("id", clean.parse_mixed_date(text).alias("day"))


def _trailing_digits(c: Context) -> DataFrame:
    """Slashed dates with a digit too many, which are no dates."""
    text = F.when(F.col("deliveryDate").contains("/"), F.concat("deliveryDate", F.lit("1"))).otherwise(F.col("deliveryDate"))
    return c.table("orders").select("id", clean.parse_mixed_date(text).alias("day"))


def _wrapped(left: str, name: str, right: str) -> Column:
    return F.concat(F.lit(left), F.col(name), F.lit(right))


def _first_watermark(c: Context) -> DataFrame:
    path = fresh_dir(c.spark, "warehouse")
    store.create_run_log(c.spark, path)
    first = etl.watermark(store.runs(c.spark, path)).first()["run_date"]
    orders = load.changed_since(c.table("orders"), first)
    return orders.agg(F.lit(first).alias("run_date"), F.count(F.lit(1)).alias("n_changed"))


def _dirty_text(c: Context) -> DataFrame:
    """User cities with blanks around them and null tokens between them."""
    city = F.concat(F.lit("  "), F.col("city"), F.lit(" "))
    tokens = F.when(F.col("id") % 5 == 0, " nan ").when(F.col("id") % 5 == 1, "None").when(F.col("id") % 5 == 2, "")
    dirty = F.coalesce(tokens, F.when(F.col("id") % 5 == 3, F.lit("NaT")), city)
    return c.table("users").select("id", clean.clean_text(dirty).alias("city"))


def _dirty_times(c: Context) -> DataFrame:
    """Change times of orders as text, some of them broken."""
    text = F.when(F.col("id") % 7 == 0, "not a time").otherwise(F.col("updatedAt").cast("string"))
    return c.table("orders").select("id", clean.to_utc_ts(text).alias("updated"))


def _fact_step(*names: str) -> Callable[[Context], DataFrame]:
    return lambda c: c.items.select(*names)


TRANSFORMS: dict[str, Callable[[Context], DataFrame]] = {
    "t1_dim_product": lambda c: dims.dim_product(c.table("products")),
    "t2_projection": lambda c: c.table("riders").select(
        F.col("id").alias("rider_id"), F.col("vehicleType").alias("vehicle_type"), F.col("courierId").alias("courier_id")
    ),
    "t3_category": lambda c: c.table("products").select(
        "id", "category", clean.normalize_category(F.col("category")).alias("normalized")
    ),
    "t4_singular": lambda c: c.table("products").select(
        "id", clean.singularize(F.lower(F.trim("category"))).alias("singular")
    ),
    "t5_dedup": lambda c: dims.dedup(c.table("orders").select("userId", "id", "deliveryDate", "updatedAt"), "userId"),
    "t6_timestamps": _dirty_times,
    "t7_dim_user": lambda c: dims.dim_user(c.table("users")),
    "t8_gender": lambda c: c.table("users").select("id", clean.normalize_gender(F.col("gender")).alias("gender")),
    "t3_white_space": lambda c: c.table("products").select(
        "id", clean.normalize_category(_wrapped("\u00a0\t", "category", "\u2003\n")).alias("normalized")
    ),
    "t8_white_space": lambda c: c.table("users").select(
        "id", clean.normalize_gender(_wrapped("\t", "gender", "\r\n")).alias("gender")
    ),
    "t9_clean_text": _dirty_text,
    "t10_more_formats": _rewritten_dates,
    "t10_trailing_digits": _trailing_digits,
    "t10_delivery_date": lambda c: c.table("orders").select(
        "id", "deliveryDate", clean.parse_mixed_date(F.col("deliveryDate")).alias("day")
    ),
    "t10_birth_date": lambda c: c.table("users").select(
        "id", "dateOfBirth", clean.parse_mixed_date(F.col("dateOfBirth")).alias("day")
    ),
    "t11_date_of_birth": lambda c: c.wh["dim_user"].select("user_id", "date_of_birth"),
    "t12_dim_rider": lambda c: dims.dim_rider(c.table("riders"), c.table("couriers")),
    "t13_latest": lambda c: dims.dim_rider(c.table("riders"), c.table("couriers")).select("rider_id", "updatedAt"),
    "t14_dim_date": lambda c: dims.dim_date(c.table("orders")),
    "t15_calendar": lambda c: c.table("orders").select(
        F.col("id").alias("order_id"), *cal.calendar_attrs(F.col("updatedAt").cast("date"))
    ),
    "t16_days": lambda c: dims.delivery_days(c.table("orders")),
    "t17_items_orders": _fact_step("order_id", "product_id", "user_id", "rider_id", "quantity", "updated_at"),
    "t18_price": _fact_step("order_id", "product_id", "unit_price"),
    "t19_date_id": _fact_step("order_id", "product_id", "delivery_date_id"),
    "t20_measures": _fact_step("order_id", "product_id", "quantity", "unit_price", "total_price"),
    "t21_fact_id": _numbered,
    "t22_fact_columns": lambda c: c.items.select(*fact.FACT_COLUMNS, "updated_at"),
    "t23_defaults": lambda c: c.facts.select("order_id", *fact.DEFAULTS),
    "t24_fact": lambda c: c.facts,
    "t25_quality": lambda c: fact.fact_quality(c.table("order_items"), c.table("orders"), c.table("products")),
}

LOADS: dict[str, Callable[[Context], DataFrame]] = {
    "ld1_changed_since": lambda c: load.changed_since(c.table("order_items"), WATERMARK),
    "ld2_load_mode": lambda c: load.change_counts(dims.dim_product(c.table("products")), WATERMARK),
    "ld2_load_mode_full": lambda c: load.change_counts(dims.dim_user(c.table("users")), etl.EPOCH),
    "ld2_load_mode_none": lambda c: load.change_counts(c.facts, SECOND_RUN, "updated_at"),
    "ld3_upsert": _upsert,
    "ld4_full_refresh": lambda c: _written(c, load.drop_control(dims.dim_user(c.table("users")))),
    "ld5_drop_control": lambda c: load.drop_control(dims.dim_rider(c.table("riders"), c.table("couriers"))),
    "ld6_insert_new": _insert_dates,
    "ld7_replace_orders": _replace_orders,
    "ld8_touched_orders": lambda c: load.touched_keys(load.changed_since(c.facts, WATERMARK, "updated_at"), "order_id"),
    "ld9_bulk_write": lambda c: _written(c, c.facts),
    "ld10_run_log": lambda c: store.runs(c.spark, c.path).select("run_date"),
    "ld11_watermark": lambda c: etl.watermark(store.runs(c.spark, c.path)),
    "ld11_watermark_first": _first_watermark,
    "ld12_fact_orders": lambda c: c.loaded["fact_orders"].select(*fact.FACT_COLUMNS),
    "ld12_fact_ids": lambda c: c.loaded["fact_orders"].agg(
        F.count("fact_id").alias("facts"), F.count_distinct("fact_id").alias("ids")
    ),
    "ld12_dim_product": lambda c: c.loaded["dim_product"],
    "ld12_dim_user": lambda c: c.loaded["dim_user"],
    "ld12_dim_rider": lambda c: c.loaded["dim_rider"],
    "ld12_dim_date": lambda c: c.loaded["dim_date"],
    "ld12_removed_rows": _removed_rows,
    "ld12_no_change_date": _no_change_date,
    "ld12_lost_keys": _lost_keys,
    "ld12_quality": _load_quality,
    "ld1_text_dates": _text_dates,
    "ld10_one_winner": _one_winner,
    "ld8_order_months": _order_months,
    "ld9_compacted": _compacted,
    "ld12_sums_user": _kept_sums("sums_user"),
    "ld12_sums_rider": _kept_sums("sums_rider"),
    "ld12_sums_product": _kept_sums("sums_product"),
    "ld7_change_rows": lambda c: c.fed["fact_orders"].select(*fact.FACT_COLUMNS),
    "ld3_change_rows": lambda c: c.fed["dim_user"],
    "ld3_change_rows_riders": lambda c: c.fed["dim_rider"],
    "ld6_change_rows": lambda c: c.fed["dim_date"],
}

YEAR_1998 = ("1998-01-01", "1998-12-31")
ALL_YEARS = ("1995-01-01", "2001-12-31")
# The normalised categories of the test tables, as the columns of the matrix.
CATEGORIES = (
    "anvil", "bolt", "economy", "gear", "gizmo", "large", "medium", "plate", "plates", "promo", "ring", "rod", "small",
    "standard", "widget",
)
PLACE = {"country": "ASIA", "city": "NATION_2"}

ANALYTICS: dict[str, Callable[[Context], DataFrame]] = {
    "q1": lambda c: queries.revenue_by_period(c.wh, *YEAR_1998),
    "q1_day_category": lambda c: queries.revenue_by_period(c.wh, *YEAR_1998, "Rings", "day"),
    "q1_year": lambda c: queries.revenue_by_period(c.wh, *ALL_YEARS, granularity="year"),
    "q1_unknown_granularity": lambda c: queries.revenue_by_period(c.wh, *ALL_YEARS, granularity="week"),
    "q2": lambda c: queries.customer_distribution(c.wh),
    "q3": lambda c: queries.top_products(c.wh, 10),
    "q3_country": lambda c: queries.top_products(c.wh, 5, "ASIA"),
    "q3_city_category": lambda c: queries.top_products(c.wh, 5, **PLACE, category="ring"),
    "q4": lambda c: queries.sales_moving_average(c.wh),
    "q4_country": lambda c: queries.sales_moving_average(c.wh, "ASIA"),
    "q5": lambda c: queries.rider_ranking(c.wh),
    "q5_country": lambda c: queries.rider_ranking(c.wh, "ASIA"),
    "q6": lambda c: queries.vehicle_deliveries(c.wh),
    "q6_year": lambda c: queries.vehicle_deliveries(c.wh, 1998),
    "q6_year_month": lambda c: queries.vehicle_deliveries(c.wh, 1998, 10),
    "q6_month": lambda c: queries.vehicle_deliveries(c.wh, None, 10),
    "q7": lambda c: Q7(c, percentile=10),
    "q7_first_quarter": lambda c: Q7(c, quarter=1, percentile=25),
    "q7_no_previous": lambda c: Q7(c, year=1995, quarter=1, percentile=50),
    "q7_all_riders": lambda c: Q7(c, percentile=100),
    "q8": lambda c: queries.revenue_rollup(c.wh, 1998),
    "q8_country": lambda c: queries.revenue_rollup(c.wh, 1998, "ASIA"),
    "q8_city": lambda c: queries.revenue_rollup(c.wh, 1998, **PLACE),
    "q8_city_category": lambda c: queries.revenue_rollup(c.wh, 1998, **PLACE, category="RING"),
    "q8_category": lambda c: queries.revenue_rollup(c.wh, 1998, category="Rings"),
    "q8_no_data": lambda c: queries.revenue_rollup(c.wh, 2030),
    "q9": lambda c: queries.revenue_rollup_filtered(c.wh, 1998),
    "q9_country": lambda c: queries.revenue_rollup_filtered(c.wh, 1998, "ASIA"),
    "q9_city": lambda c: queries.revenue_rollup_filtered(c.wh, 1998, **PLACE),
    "q9_city_category": lambda c: queries.revenue_rollup_filtered(c.wh, 1998, **PLACE, category="RING"),
    "q9_category": lambda c: queries.revenue_rollup_filtered(c.wh, 1998, category="Rings"),
    "q9_no_data": lambda c: queries.revenue_rollup_filtered(c.wh, 2030),
}


def _iso_codes(c: Context) -> DataFrame:
    """A code per region name, the countries of these tables; one region is left out."""
    regions = c.spark.read.parquet(f"{c.sf_dir}/region.parquet").filter("r_name <> 'EUROPE'")
    return regions.select(F.lower("r_name").alias("country_name"), F.upper(F.substring("r_name", 1, 3)).alias("iso_alpha"))


def _city_view(c: Context, metric: str = "total", category: str | None = None, top: int | None = 3) -> DataFrame:
    return reports.city_view(DRILL(c, metric=metric, country="ASIA", category=category), "ASIA", category, metric, top)


REPORTS: dict[str, Callable[[Context], DataFrame]] = {
    "r1_customers_by_country": lambda c: reports.customers_by_country(Q2(c)),
    "r2_customers_listing": lambda c: reports.customers_listing(Q2(c)),
    "r3_iso_codes": lambda c: reports.with_iso_code(reports.customers_by_country(Q2(c)), _iso_codes(c)),
    "r4_city_detail": lambda c: reports.city_detail(Q2(c), "ASIA"),
    "r5_top_products_view": lambda c: reports.top_products_view(queries.top_products(c.wh, 20), 10),
    "r6_sales_series": lambda c: reports.sales_series(queries.sales_moving_average(c.wh)),
    "r7_rider_leaderboard": lambda c: reports.rider_leaderboard(queries.rider_ranking(c.wh)),
    "r8_vehicle_series": lambda c: reports.vehicle_series(Q6(c)),
    "r9_vehicle_share": lambda c: reports.vehicle_share(Q6(c)),
    "r10_country_options": lambda c: reports.country_options(
        queries.revenue_rollup(c.wh, 1998, with_gid=True), "Philippines"
    ),
    "r11_rider_kpis": lambda c: reports.rider_kpis(Q7(c, percentile=50)),
    "r12_rider_table": lambda c: reports.rider_table(Q7(c, percentile=50)),
    "r13_revenue_series": lambda c: reports.revenue_series(queries.revenue_by_period(c.wh, *YEAR_1998)),
    "r14_drilldown_total": lambda c: DRILL(c, metric="total", country="ASIA"),
    "r14_drilldown_average": lambda c: DRILL(c, metric="aov", country="ASIA"),
    "r15_fallback": lambda c: DRILL(c, metric="total", country="ASIA", category="no such category"),
    "r16_options": lambda c: reports.drill_options(DRILL(c)),
    "r16_options_city": lambda c: reports.drill_options(DRILL(c, country="ASIA"), "ASIA", "NATION_2"),
    "r17_countries": lambda c: reports.country_view(c.wh, 1998),
    "r17_countries_category": lambda c: reports.country_view(c.wh, 1998, "Rings", "aov", 3),
    "r18_cities": _city_view,
    "r18_cities_average": lambda c: _city_view(c, "aov", "ring"),
    "r19_categories": lambda c: reports.category_view(DRILL(c, **PLACE), **PLACE),
    "r20_matrix": lambda c: reports.city_category_matrix(_city_view(c), categories=CATEGORIES),
    "r21_country_extremes": lambda c: reports.high_low(reports.country_view(c.wh, 1998), "country"),
    "r21_city_extremes": lambda c: reports.high_low(reports.city_totals(DRILL(c, country="ASIA"), "ASIA"), "city"),
    "r21_category_extremes": lambda c: reports.high_low(
        reports.category_view(DRILL(c, **PLACE), **PLACE, top=None), "category"
    ),
    "r21_city_category_extremes": lambda c: reports.high_low(_city_view(c, top=None), "category", within=["city"]),
    "r22_table": lambda c: reports.drill_table(_city_view(c, top=None), "city"),
    "r22_country_table": lambda c: reports.drill_table(reports.country_view(c.wh, 1998), "country"),
}



def _keyed(c: Context) -> DataFrame:
    """Facts with the columns the single joins are shown on."""
    return c.wh["fact_orders"].select("order_id", *fact.REQUIRED_KEYS[1:], "rider_id", "delivery_date_id", "total_price")


def _joined(table: str, *attrs: str) -> Callable[[Context], DataFrame]:
    dim = Dim(table, attrs)
    return lambda c: _keyed(c).join(dim.frame(c.wh), dim.fact_key).select("order_id", dim.fact_key, *attrs)


def _sums(c: Context, dims_: list[Dim], keys: list[str], **sums: Column) -> DataFrame:
    return star_sum(c.wh, c.wh["fact_orders"], dims_, keys, sums or {"sales": F.col("total_price")})


def _two_quarters(c: Context) -> DataFrame:
    """Days of a quarter and of the one before it, across the turn of a year."""
    last_year, last_quarter = cal.prev_quarter(1998, 1)
    asked = (F.col("year") == 1998) & (F.col("quarter") == 1)
    before = (F.col("year") == last_year) & (F.col("quarter") == last_quarter)
    return c.wh["dim_date"].filter(asked | before).select("date_id", "year", "quarter")


def _city_sales(c: Context) -> DataFrame:
    return _sums(c, [Dim("dim_user", ["country", "city"])], ["country", "city"])


def _quarterly(c: Context) -> DataFrame:
    """Sales per rider and quarter with those of the rider's quarter before; a rider has few quarters."""
    rows = _sums(c, [Dim("dim_date", ["year", "quarter"])], ["rider_id", "year", "quarter"])
    return rows.withColumn("prev_sales", previous_value("sales", ["rider_id"], ["year", "quarter"]))


def _months(c: Context) -> DataFrame:
    return _sums(c, [Dim("dim_date", ["year", "month"])], ["year", "month"])


def _by_price(c: Context) -> DataFrame:
    return c.wh["dim_product"].withColumn("cents", numeric.cents(F.col("current_price")))


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _late_customers(c: Context) -> DataFrame:
    late = c.table("orders").filter(F.col("updatedAt") >= F.lit(WATERMARK))
    return late.select(F.col("userId").alias("user_id"))


_PLACES = Dim("dim_user", ["country", "city"])


def _matching(c: Context, equals: dict[str, str]) -> DataFrame:
    """Facts of some users: the filter on their keys first, then the exact join."""
    users = Dim("dim_user", equals=equals).frame(c.wh)
    return _keyed(c).filter(may_match(users, "user_id")).join(users, "user_id", "left_semi").select("order_id", "user_id")

BLOCKS: dict[str, Callable[[Context], DataFrame]] = {
    "p1_optional_filter": lambda c: opt_filter(c.wh["dim_user"], country="ASIA", city=None).select("user_id", "country"),
    "p2_date_range": lambda c: date_id_between(_keyed(c), 19980101, 19980331).select("order_id", "delivery_date_id"),
    "p3_two_quarters": _two_quarters,
    "p4_equality": lambda c: delivered_in(_keyed(c), 1998, 10).select("order_id", "delivery_date_id"),
    "p5_having": lambda c: _city_sales(c).filter(F.col("country") == "ASIA"),
    "p6_window_filter": lambda c: global_rank(
        _sums(c, [], ["rider_id"], deliveries=_one()), "deliveries"
    ).filter(F.col("rank") <= 10),
    "p7_relabel": lambda c: rollup_labelled(
        _city_sales(c), ["country", "city"], queries.TOTAL_LABELS, [F.sum("sales").cast("double").alias("sales")]
    ),
    "j1_fact_product": _joined("dim_product", "name", "category"),
    "j2_fact_date": _joined("dim_date", "year", "month", "day"),
    "j3_fact_user": _joined("dim_user", "country", "city"),
    "j4_fact_rider": _joined("dim_rider", "vehicle_type", "courier_name"),
    "j5_left_join": lambda c: _keyed(c).join(Dim("dim_rider", ["courier_name"]).frame(c.wh), "rider_id", "left").select(
        "order_id", "rider_id", "courier_name"
    ),
    "j6_anti_join": lambda c: c.wh["dim_user"].join(_late_customers(c), "user_id", "left_anti").select("user_id"),
    "j3_key_filter": lambda c: _matching(c, {"country": "ASIA"}),
    "j7_semi_join": lambda c: c.wh["dim_user"].join(_late_customers(c), "user_id", "left_semi").select("user_id"),
    "g1_sum": lambda c: _sums(c, [], ["product_id"], sales=F.col("total_price"), units=F.col("quantity").cast("bigint")),
    "g2_count": lambda c: _sums(c, [Dim("dim_rider", ["vehicle_type"])], ["vehicle_type"], deliveries=_one()),
    "g3_count_distinct": lambda c: _sums(c, [_PLACES], ["country", "rider_id"])
    .groupBy("country").agg(F.count("rider_id").alias("riders")),
    "g4_average": lambda c: _sums(c, [_PLACES], ["city"], sales=F.col("total_price"), n=_one()).select(
        "city", numeric.rounded_mean(F.col("sales"), F.col("n")).alias("average")
    ),
    "g5_group_by": lambda c: _sums(c, [_PLACES, Dim("dim_product", ["category"])], ["country", "category"]),
    "g6_rollup_two": lambda c: rollup_labelled(_city_sales(c), ["country", "city"], {}, [F.sum("sales").alias("sales")]),
    "g6_rollup_three": lambda c: rollup_labelled(
        _sums(c, [_PLACES, Dim("dim_product", ["category"])], list(queries.PLACE_KEYS)), queries.PLACE_KEYS, {},
        [F.sum("sales").alias("sales")],
    ),
    "g6_rollup_distinct": lambda c: rollup_distinct(
        _sums(c, [_PLACES], ["country", "city", "rider_id"]), ["country", "city"], {}, ["sales"], "rider_id", "riders"
    ),
    "g7_period_group": lambda c: _sums(
        c, [Dim("dim_date", [cal.period_of_date_id(F.col("date_id"), "month").alias("period")])], ["period"]
    ),
    "g8_extremes": lambda c: extremes(_city_sales(c), "sales", "city"),
    "g9_share": lambda c: share_of_total(
        _sums(c, [Dim("dim_rider", ["courier_name"])], ["courier_name"], deliveries=_one()), "courier_name", "deliveries"
    ),
    "g10_distinct": lambda c: c.wh["dim_product"].select("category").distinct(),
    "w1_moving_average": lambda c: _months(c).select(
        "year", "month", F.sum("sales").over(trailing_rows([], ["year", "month"], 3)).alias("last_three")
    ),
    "w2_rank": lambda c: global_rank(_by_price(c), "cents", "rank").select("product_id", "rank"),
    "w3_lag": _quarterly,
    "w4_growth": lambda c: _quarterly(c).select(
        "rider_id", "year", "quarter", numeric.growth_pct(F.col("sales"), F.col("prev_sales")).alias("growth")
    ),
    "w5_percent_rank": lambda c: percent_rank_pct(_by_price(c), "cents", "percentile").select("product_id", "percentile"),
    "w6_row_number": lambda c: _city_sales(c).select(
        "country", "city",
        F.row_number().over(Window.partitionBy("country").orderBy(F.col("sales").desc(), "city")).cast("bigint").alias("pos"),
    ),
    "o1_sort": lambda c: c.wh["dim_user"].select("user_id", "gender").orderBy(F.col("gender").asc_nulls_last(), "user_id"),
    "o2_top_n": lambda c: top_k(_sums(c, [], ["product_id"]), [F.col("sales").desc(), F.col("product_id")], 25),
    "o3_latest": lambda c: c.table("orders").agg(F.max("updatedAt").alias("latest")),
    "o4_head": lambda c: top_k(_sums(c, [], ["user_id"]), [F.col("sales").desc(), F.col("user_id")], 20).orderBy("sales"),
    "f1_period_text": lambda c: c.wh["dim_date"].select(
        "date_id", *[cal.period_of_date_id(F.col("date_id"), g).alias(f"per_{g}") for g in cal.PERIOD_FORMATS]
    ),
    "f2_case": lambda c: c.wh["dim_date"].select(
        "date_id", F.when(F.col("is_weekend"), "weekend").otherwise("week").alias("kind")
    ),
    "f3_null_handling": lambda c: c.wh["dim_user"].select(
        "user_id", F.coalesce("gender", F.lit("?")).alias("known"), F.nullif("gender", F.lit("M")).alias("not_m")
    ),
    "f4_round": lambda c: c.wh["dim_product"].select(
        "product_id", F.round(F.col("current_price") / 3, 2).cast("decimal(18,2)").alias("third")
    ),
    "f5_quarter_label": lambda c: c.wh["dim_date"].select(
        "date_id", cal.quarter_label(F.col("year"), F.col("quarter")).alias("label")
    ),
    "f6_cast": lambda c: c.table("orders").select("id", F.substring("orderNumber", 2, 20).cast("bigint").alias("number")),
    "f7_text": lambda c: c.table("products").select(
        "id", F.upper(F.trim("category")).alias("upper"), F.col("name").rlike("^s.*g$").alias("matches"),
        F.col("name").endswith("ring").alias("ring"), F.substring("name", 1, 3).alias("start"),
    ),
    "f8_date_parts": lambda c: c.wh["dim_date"].select("date_id", "year", "quarter", "month", "day"),
    "f9_date_text_to_id": lambda c: c.wh["dim_date"].filter(F.col("date_id") >= cal.date_text_to_id("2000-01-01")).select("date_id"),
    "f10_prev_quarter": lambda c: c.wh["dim_date"].filter(
        (F.col("year") == cal.prev_quarter(1999, 1)[0]) & (F.col("quarter") == cal.prev_quarter(1999, 1)[1])
    ).select("date_id"),
    "f11_period_label": lambda c: rollup_labelled(_months(c), ["year", "month"], {}, [F.sum("sales").alias("sales")])
    .filter(F.col("year").isNotNull())
    .select(cal.period_label(F.col("year"), F.col("month")).alias("period"), "sales"),
    "f12_month_start": lambda c: _months(c).select(cal.month_start(F.col("year"), F.col("month")).alias("start"), "sales"),
    "f13_to_number": lambda c: c.table("orders").select(
        "id", numeric.to_number(F.substring("deliveryDate", 1, 4)).alias("number"),
        numeric.to_number(F.substring("deliveryDate", 1, 4), 0.0).alias("number_or_0"),
    ),
    "f14_money_text": lambda c: _sums(c, [], ["product_id"]).select("product_id", numeric.money_text(F.col("sales")).alias("amount")),
}

ALL = {**SCANS, **TRANSFORMS, **LOADS, **ANALYTICS, **REPORTS, **BLOCKS}


def _runner(build: Callable[[Context], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparable(build(context(spark, sf_dir)))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    return {name: _runner(build) for name, build in ALL.items()}
