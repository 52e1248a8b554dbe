"""Steps of a load that must not shuffle, sort or sum more than the job asks for, told by their plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmart.operators import load
from parcelmart.operators.fact import FACT_COLUMNS, delivery_day_id, fact_rows, joined_items, keyed_rows, nested_items
from parcelmart.operators.star import date_id_between
from parcelmart.plans import etl
from parcelmart.plans.changes import changes_of
from parcelmart.sources import warehouse as store
from parcelmart.sources.tables import read_source
from tests.fixture import at, item, make_source, order
from tests.helpers import frame_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_of_change_rows_need_no_join_with_orders(spark):
    rows = [item(1), item(1), item(2, 77), item(2, None), item(3, 2, 4)]
    source = make_source(spark, order_items=rows, orders=[order(1), order(2, user=None), order(3), order(4)])
    orders = changes_of(source).filter("orders IS NOT NULL").select("orders.*")
    tables = [read_source(t, source) for t in ("order_items", "orders", "products")]
    got = nested_items(orders, tables[2])
    assert frame_rows(got) == frame_rows(joined_items(*tables))
    assert frame_rows(keyed_rows(got)) == frame_rows(fact_rows(*tables))
    stored = orders.localCheckpoint()
    assert plan(nested_items(stored, tables[2])).count("Join") == 1


def test_orders_with_items_are_dealt_before_their_items_are_collected(spark):
    lines = [x for x in plan(changes_of(make_source(spark))).splitlines() if "Exchange" in x or "collect_list" in x]
    collected = [i for i, x in enumerate(lines) if "collect_list" in x]
    assert len(collected) >= 2 and not any("Exchange" in x for x in lines[collected[0] : collected[-1]])


def test_sums_per_day_and_product_are_shuffled_once(spark, tmp_path, monkeypatch):
    seen, write = {}, load.write_pieces
    monkeypatch.setattr(load, "write_pieces", lambda rows, path, *a: seen.update({path: plan(rows)}) or write(rows, path, *a))
    rows = [item(1, 1, 2)] * 40 + [item(2, 1, 3), item(2, 2, 5), item(3, None)]
    wh = etl.run_etl(spark, make_source(spark, order_items=rows), str(tmp_path), at(10))
    found = next(p for path, p in seen.items() if "sums_product" in path)
    assert found.count("Exchange") == 1
    facts = wh["fact_orders"].withColumn("delivery_month", F.floor(F.col("delivery_date_id") / 100).cast("int"))
    keys = store.SUMS["sums_product"]
    summed = facts.groupBy(*keys).agg(F.sum("total_price").alias("total_price"), F.sum("quantity").alias("quantity"), F.count("*").alias("items"))
    assert frame_rows(wh["sums_product"].select(summed.columns)) == frame_rows(summed)


def test_many_touched_orders_meet_their_items_in_one_join(spark, tmp_path, monkeypatch):
    kept, joins = {}, []
    write = etl.write_facts
    monkeypatch.setattr(etl, "write_facts", lambda run, fresh, *a: joins.append(plan(fresh).count("Join")) or write(run, fresh, *a))
    for name, most in (("few", 1_000_000), ("many", 0)):
        monkeypatch.setattr(etl, "BROADCAST_ORDERS", most)
        path = str(tmp_path / name)
        etl.run_etl(spark, make_source(spark, order_items=[item(1), item(2), item(3)]), path, at(10))
        # Order 9 comes with items and without its row, order 2 loses its user, an item comes without a product, a row twice.
        changed = [item(1, 2, 4, changed=11), item(9, 1, 1, changed=11), item(2, 1, 1, changed=11), item(2, None, 1, changed=11)]
        orders = [order(1), order(1), order(2, user=None, changed=11), order(3), order(4, changed=11)]
        wh = etl.run_etl(spark, make_source(spark, order_items=[*changed, item(3, 1, 8)], orders=orders), path, at(20))
        quality = store.runs(spark, path).orderBy("version").collect()[-1]["quality"]
        kept[name] = frame_rows(wh["fact_orders"].select(*FACT_COLUMNS)), quality
    assert kept["many"] == kept["few"]
    assert joins[-1] == 2 and joins[1] == 4


def test_the_tie_of_numbering_moves_no_text(spark, tmp_path, monkeypatch):
    seen = {}
    hold = load.work_table
    monkeypatch.setattr(load, "work_table", lambda df, name: seen.update({name: plan(df)}) or hold(df, name))
    facts = etl.source_facts(make_source(spark, order_items=[item(1, 1, 1) for _ in range(50)]))
    assert load.write_numbered_facts(facts.repartition(3), str(tmp_path / "f"), 1)[0] == 50
    assert "file_name" not in seen["facts"]
    ids = [r[0] for r in spark.read.parquet(str(tmp_path / "f")).select("fact_id").collect()]
    assert sorted(ids) == list(range(1, 51))


def test_a_date_is_parsed_once_for_a_filter_on_its_id(spark):
    rows = spark.createDataFrame([("1/2/2024",), ("2024-02-01",), ("x",), (None,)], "deliveryDate string")
    found = rows.select(delivery_day_id().alias("id")).filter(F.col("id").between(20240101, 20240131))
    assert plan(found).count("MMMM d, yyyy") <= 6  # each of the formats has two, and two uses of the id and the result are left
    assert [r[0] for r in found.collect()] == [20240102]


def test_items_of_other_days_are_kept_off_the_joins(spark):
    orders = [order(1), order(1), order(2, user=None), order(3, day="2024-05-01"), order(4, day=None)]
    items = [item(1), item(1), item(2), item(3), item(3, None), item(4), item(9), item(None)]
    wh = etl.derived_warehouse(make_source(spark, order_items=items, orders=orders))
    for start, end in ((20240501, 20240531), (20200101, 20301231), (19990101, 19991231)):
        got, want = wh.facts_between(start, end), date_id_between(wh["fact_orders"], start, end)
        assert frame_rows(got) == frame_rows(want)
        assert "getbit" in plan(got).lower() and plan(got).count("Join") == plan(want).count("Join")
    assert frame_rows(wh.facts_between(20240501, 20240531))
