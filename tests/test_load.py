from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from parcelmart.operators import dims, load
from parcelmart.operators.fact import FACT_COLUMNS, fact_quality, fact_rows
from parcelmart.plans import etl
from parcelmart.sources import warehouse as store
from parcelmart.sources.tables import read_source
from parcelmart.sources.testdata import mapped_source
from tests.conftest import SMALL
from tests.fixture import BASE, at, courier, item, make_source, order, product, user
from tests.helpers import frame_rows, values


def loaded(spark, path, source, day):
    return etl.run_etl(spark, source, str(path), at(day))


def fact_values(wh):
    return sorted(values(wh["fact_orders"], "order_id", "product_id", "quantity"))


def test_full_load(spark, tmp_path):
    wh = loaded(spark, tmp_path, make_source(spark), 10)
    assert fact_values(wh) == [(1, 1, 1), (1, 2, 3), (1, 2, 5), (2, 1, 2), (3, 2, 1)]
    assert sorted(r[0] for r in values(wh["fact_orders"], "fact_id")) == [1, 2, 3, 4, 5]
    assert sorted(values(wh["dim_date"], "date_id")) == [(20240105,), (20240106,), (20240207,)]
    assert values(wh["fact_orders"].filter("order_id = 3"), "rider_id", "delivery_month") == [(-1, 202402)]
    assert values(wh["dim_user"].filter("user_id = 1"), "gender", F.col("date_of_birth").cast("string")) == [
        ("F", "1990-01-05")
    ]


def test_a_changed_item_brings_back_all_items_of_its_order(spark, tmp_path):
    loaded(spark, tmp_path, make_source(spark), 10)
    items = [item(1, 1, 7, changed=11), item(1, 2, 3), item(1, 2, 5), item(2, 1, 2), item(3, 2, 1)]
    wh = loaded(spark, tmp_path, make_source(spark, order_items=items), 20)
    assert fact_values(wh) == [(1, 1, 7), (1, 2, 3), (1, 2, 5), (2, 1, 2), (3, 2, 1)]
    ids = [r[0] for r in values(wh["fact_orders"], "fact_id")]
    assert len(set(ids)) == 5 and max(ids) == 8


def test_only_touched_months_are_rewritten(spark, tmp_path):
    loaded(spark, tmp_path, make_source(spark), 10)
    items = [*BASE["order_items"], item(3, 1, 9, changed=11)]
    loaded(spark, tmp_path, make_source(spark, order_items=items), 20)
    parts, last_id = store.latest_parts(spark, str(tmp_path))
    versions = {p.month: p.version for p in parts if p.table == "fact_orders"}
    assert versions == {202401: 1, 202402: 2}
    assert last_id == 7


def test_a_moved_delivery_leaves_its_old_month(spark, tmp_path):
    loaded(spark, tmp_path, make_source(spark), 10)
    orders = [order(1), order(2, day="2024-03-06", changed=11), order(3, day="2024-02-07 10:30:00", rider=None)]
    wh = loaded(spark, tmp_path, make_source(spark, orders=orders), 20)
    months = sorted(values(wh["fact_orders"], "order_id", "delivery_month"))
    assert months == [(1, 202401), (1, 202401), (1, 202401), (2, 202403), (3, 202402)]
    assert (20240306,) in values(wh["dim_date"], "date_id") and (20240106,) in values(wh["dim_date"], "date_id")


def test_the_last_facts_of_a_month_can_leave_it(spark, tmp_path):
    loaded(spark, tmp_path, make_source(spark), 10)
    orders = [order(1), order(2, day="1/6/2024"), order(3, day="2024-01-07", changed=11)]
    wh = loaded(spark, tmp_path, make_source(spark, orders=orders), 20)
    assert {r[0] for r in values(wh["fact_orders"], "delivery_month")} == {202401}
    assert wh["fact_orders"].count() == 5


def test_nothing_changed_keeps_every_part(spark, tmp_path):
    first = loaded(spark, tmp_path, make_source(spark), 10)
    before = frame_rows(first["fact_orders"])
    parts, _ = store.latest_parts(spark, str(tmp_path))
    wh = loaded(spark, tmp_path, make_source(spark), 20)
    assert frame_rows(wh["fact_orders"]) == before
    assert store.latest_parts(spark, str(tmp_path))[0] == parts
    assert store.runs(spark, str(tmp_path)).count() == 2


def test_what_is_gone_from_the_source_stays(spark, tmp_path):
    """Whatever the share of changed rows: all remaining ones here."""
    loaded(spark, tmp_path, make_source(spark), 10)
    source = make_source(spark, orders=[order(1, changed=11)], order_items=[item(1)], users=[user(1, "Bari", changed=11)])
    wh = loaded(spark, tmp_path, source, 20)
    assert fact_values(wh) == [(1, 1, 1), (2, 1, 2), (3, 2, 1)]
    assert sorted(values(wh["dim_user"], "user_id", "city")) == [(1, "Bari"), (2, "Oslo")]


def test_rows_without_a_change_date_are_loaded(spark, tmp_path):
    undated = {"users": [(*user(1)[:-1], None), user(2)], "orders": [(*order(1)[:-1], None), order(2), order(3)]}
    wh = loaded(spark, tmp_path / "first", make_source(spark, **undated), 10)
    assert {r[0] for r in values(wh["dim_user"], "user_id")} == {1, 2} and wh["fact_orders"].count() == 5
    loaded(spark, tmp_path / "later", make_source(spark, users=[user(2)], orders=[order(2), order(3)]), 10)
    wh = loaded(spark, tmp_path / "later", make_source(spark, **undated), 20)
    assert {r[0] for r in values(wh["dim_user"], "user_id")} == {1, 2} and wh["fact_orders"].count() == 5


def test_facts_that_lose_a_key_leave(spark, tmp_path):
    loaded(spark, tmp_path, make_source(spark), 10)
    orders = [order(1), order(2, user=None, day="1/6/2024", changed=11), order(3, day="2024-02-07 10:30:00", rider=None)]
    items = [item(1), item(1, None, 3, changed=11), item(1, 2, 5), item(2, 1, 2), item(3, None, 1, changed=11)]
    source = make_source(spark, orders=orders, order_items=items)
    wh = loaded(spark, tmp_path, source, 20)
    assert fact_values(wh) == [(1, 1, 1), (1, 2, 5)]
    quality = store.runs(spark, str(tmp_path)).orderBy(F.col("version").desc()).first()["quality"]
    assert (quality["total_rows"], quality["missing_product_id"], quality["missing_user_id"]) == (5, 2, 1)


def test_a_clock_set_back_hides_nothing(spark, tmp_path):
    loaded(spark, tmp_path, make_source(spark), 20)
    wh = loaded(spark, tmp_path, make_source(spark, order_items=[*BASE["order_items"], item(3, 1, 9, changed=25)]), 15)
    assert wh["fact_orders"].count() == 6
    runs = store.runs(spark, str(tmp_path)).orderBy("version").collect()
    assert [r["version"] for r in runs] == [1, 2] and runs[0]["run_date"] < runs[1]["run_date"]
    assert loaded(spark, tmp_path, make_source(spark), 30)["fact_orders"].count() == 6


def test_incremental_filters_reach_the_source(spark, tmp_path):
    source = mapped_source(spark, SMALL)
    for name in ("dim_product", "dim_user"):
        plan = etl.dimensions(etl.changed_source(source, name, at(5)))[name]()._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [" in plan and "PushedFilters: []" not in plan


def test_numbering_twice_gives_the_same_ids(spark, tmp_path):
    rows = [item(1, 1, 1) for _ in range(300)] + [item(2, 2, k % 5) for k in range(300)]
    facts = etl.source_facts(make_source(spark, order_items=rows)).repartition(5)
    facts.write.parquet(str(tmp_path / "rows"))
    for run in ("a", "b"):
        load.write_numbered_facts(spark.read.parquet(str(tmp_path / "rows")), str(tmp_path / run), 1)
    a, b = (frame_rows(spark.read.parquet(str(tmp_path / run))) for run in ("a", "b"))
    assert a == b


def test_a_price_change_alone_leaves_facts_as_loaded(spark, tmp_path):
    loaded(spark, tmp_path, make_source(spark), 10)
    wh = loaded(spark, tmp_path, make_source(spark, products=[product(1, "99.00", changed=11), product(2, "2.50", "Toys")]), 20)
    prices = {r[0]: str(r[1]) for r in values(wh["dim_product"], "product_id", "current_price")}
    assert prices == {1: "99.00", 2: "2.50"}
    assert {str(r[0]) for r in values(wh["fact_orders"].filter("product_id = 1"), "unit_price")} == {"10.00"}


def test_a_renamed_courier_updates_its_riders(spark, tmp_path):
    loaded(spark, tmp_path, make_source(spark), 10)
    wh = loaded(spark, tmp_path, make_source(spark, couriers=[courier(1, "Faster", changed=11)]), 20)
    assert values(wh["dim_rider"], "rider_id", "courier_name") == [(1, "Faster")]


def test_a_failed_load_shows_nothing(spark, tmp_path, monkeypatch):
    before = frame_rows(loaded(spark, tmp_path, make_source(spark), 10)["fact_orders"])
    items = [*BASE["order_items"], item(3, 1, 9, changed=11)]
    with monkeypatch.context() as patch:
        patch.setattr(load, "record_run", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            loaded(spark, tmp_path, make_source(spark, order_items=items), 20)
    assert frame_rows(store.warehouse(spark, str(tmp_path))["fact_orders"]) == before
    assert loaded(spark, tmp_path, make_source(spark, order_items=items), 21)["fact_orders"].count() == 6


def test_two_halves_equal_one_full_load(spark, tmp_path):
    source = mapped_source(spark, SMALL)
    whole = etl.run_etl(spark, source, str(tmp_path / "whole"), at(1))
    wm = spark.sql("SELECT TIMESTAMP '1998-01-01'").first()[0]
    # Prices are kept as loaded, so the halves share one product table.
    early = lambda name: source(name) if name == "products" else source(name).filter(F.col("updatedAt") <= F.lit(wm))
    etl.run_etl(spark, early, str(tmp_path / "halves"), wm)
    halves = etl.run_etl(spark, source, str(tmp_path / "halves"), at(1))
    for name in store.SCHEMAS:
        columns = list(FACT_COLUMNS) if name == "fact_orders" else whole[name].columns
        assert frame_rows(halves[name].select(columns)) == frame_rows(whole[name].select(columns)), name
    ids = [r[0] for r in values(halves["fact_orders"], "fact_id")]
    assert len(set(ids)) == len(ids)


def test_items_without_order_or_product_are_counted_and_kept_out(spark):
    source = make_source(spark, order_items=[item(1), item(99), item(1, None), item(1, 77)])
    tables = [read_source(t, source) for t in ("order_items", "orders", "products")]
    quality = fact_quality(*tables).first()
    assert quality["total_rows"] == 4
    assert (quality["missing_product_id"], quality["missing_user_id"], quality["missing_unit_price"]) == (1, 1, 2)
    rows = fact_rows(*tables)
    assert sorted(values(rows, "order_id", "product_id", F.col("total_price").cast("string"))) == [
        (1, 1, "10.00"),
        (1, 77, "0.00"),
    ]


def test_numbering_of_one_huge_order_with_identical_items(spark, tmp_path):
    pick = random.Random(3)
    rows = [item(1, 1, 1) for _ in range(700)] + [item(pick.choice([1, 2]), 2, pick.randrange(9)) for _ in range(900)]
    source = make_source(spark, order_items=rows)
    facts = etl.source_facts(source).repartition(4)
    n, months = load.write_numbered_facts(facts, str(tmp_path / "f"), 101)
    assert (n, months) == (1600, {202401})
    stored = spark.read.parquet(str(tmp_path / "f"))
    assert sorted(r[0] for r in values(stored, "fact_id")) == list(range(101, 1701))
    assert frame_rows(stored.select(*FACT_COLUMNS)) == frame_rows(facts.select(*FACT_COLUMNS))
    ordered = [tuple(r) for r in stored.orderBy("fact_id").select(*FACT_COLUMNS).collect()]
    assert ordered == sorted(ordered)


def test_dedup_keeps_the_newest(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 3), (2, "d", None)], "k int, v string, updatedAt int")
    assert sorted(values(dims.dedup(df, "k"), "k", "v", "updatedAt")) == [(1, "c", 3), (2, "d", None)]


def test_watermark_is_strict_and_skips_rows_without_a_date(spark):
    df = spark.createDataFrame([(1, at(1)), (2, at(2)), (3, None)], "k int, updatedAt timestamp")
    assert values(load.changed_since(df, at(1)), "k") == [(2,)]
    assert load.changed_since(df, None).count() == 3
    modes = [load.change_counts(df, ts).first()["mode"] for ts in (at(5), at(1), None)]
    assert modes == ["none", "incremental", "full"]


def test_jdbc_reads_are_split(spark, monkeypatch):
    """The options of a relational read; the reader is replaced, as no database may be started here."""
    from pyspark.sql import DataFrameReader

    from parcelmart.sources.tables import jdbc_source

    seen = []

    def fake_load(self, *args, **kwargs):
        query = dict(seen[-1]).get("query")
        return spark.sql("SELECT 3 AS lo, 900 AS hi") if query else spark.range(1)

    def fake_options(self, **options):
        seen.append({**(seen[-1] if seen and "query" not in seen[-1] else {}), **options})
        return self

    monkeypatch.setattr(DataFrameReader, "options", fake_options)
    monkeypatch.setattr(DataFrameReader, "load", fake_load)
    jdbc_source(spark, "jdbc:x", 8, user="u")("order_items")
    assert seen[0]["query"] == "SELECT min(OrderId) AS lo, max(OrderId) AS hi FROM OrderItems"
    final = seen[-1]
    assert (final["partitionColumn"], final["lowerBound"], final["upperBound"]) == ("OrderId", "3", "901")
    assert (final["numPartitions"], final["dbtable"]) == ("8", "OrderItems")
