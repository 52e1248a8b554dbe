"""Change rows applied in batches against one full load."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelmart.operators.fact import FACT_COLUMNS
from parcelmart.plans import etl, queries
from parcelmart.plans.changes import CHANGES_SCHEMA, apply_changes, changes_of
from parcelmart.sources import warehouse as store
from parcelmart.sources.testdata import mapped_source
from parcelmart.streaming.follow import change_files, follow_changes
from tests.conftest import SMALL
from tests.fixture import BASE, at, courier, item, make_source, order, product, rider, user
from tests.helpers import frame_rows, values


def changes(spark, **tables):
    """The given rows as change rows, nothing else."""
    return changes_of(make_source(spark, **{**dict.fromkeys(BASE, []), **tables}))


def test_batches_out_of_order_and_repeated_equal_one_full_load(spark, tmp_path):
    source = mapped_source(spark, SMALL)
    whole = etl.run_etl(spark, source, str(tmp_path / "whole"), at(1))
    rows = changes_of(source)
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.schema(CHANGES_SCHEMA).parquet(str(tmp_path / "rows"))
    key = F.coalesce(*[F.col(f"{t}.id") for t in store.CHANGES])
    # What orders and users looked like before their last change comes late, and some products come after their orders.
    shifted = [F.col(t).withField("updatedAt", F.col(f"{t}.updatedAt") - F.expr("INTERVAL 3000 DAYS")) for t in ("orders", "users")]
    old = rows.withColumn("orders", shifted[0].withField("items", F.slice("orders.items", 1, 1)).withField("userId", F.lit(1).cast("bigint")))
    old = old.withColumn("orders", F.col("orders").withField("items", F.transform("orders.items", lambda i: i.withField("updatedAt", F.lit(None).cast("timestamp")))))
    old = old.withColumn("users", shifted[1].withField("city", F.lit("Old Town"))).filter("orders IS NOT NULL OR users IS NOT NULL")
    late = F.col("products").isNotNull() & (key % 5 == 0)
    batches = [rows.filter((key % 3 == 0) & ~late), old.unionByName(rows.filter(key % 3 == 1).filter(~late)), rows.filter(key % 2 == 0), rows]
    path = str(tmp_path / "fed")
    for n, batch in enumerate(batches):
        apply_changes(batch, path, n)
        fed = apply_changes(batches[0], path, n)  # a number that was committed
    for name in store.SCHEMAS:
        columns = list(FACT_COLUMNS) if name == "fact_orders" else whole[name].columns
        assert frame_rows(fed[name].select(columns)) == frame_rows(whole[name].select(columns)), name
    ids = [r[0] for r in values(fed["fact_orders"], "fact_id")]
    assert len(set(ids)) == len(ids)
    assert frame_rows(queries.sales_moving_average(fed)) == frame_rows(queries.sales_moving_average(whole))
    log = store.runs(spark, path).orderBy("version").collect()
    assert [r["feeds"]["changes"] for r in log] == [0, 1, 2, 3]


def test_an_order_waits_for_its_product_and_older_states_change_nothing(spark, tmp_path):
    path = str(tmp_path)
    wh = apply_changes(changes(spark, orders=[order(1, changed=5)], order_items=[item(1, 7, 2, changed=5)]), path, 0)
    assert [str(r[0]) for r in values(wh["fact_orders"], "total_price")] == ["0.00"]
    wh = apply_changes(changes(spark, products=[product(7, "3.00")]), path, 1)
    assert [str(r[0]) for r in values(wh["fact_orders"], "total_price")] == ["6.00"]
    # A price change alone leaves facts as loaded, and an older state of the order or product is left out.
    stale = {"orders": [order(1, changed=4)], "order_items": [item(1, 7, 9, changed=3)], "products": [product(7, "1.00", changed=0)]}
    wh = apply_changes(changes(spark, **stale), path, 2)
    wh = apply_changes(changes(spark, products=[product(7, "9.00", changed=8)]), path, 3)
    assert [str(r[0]) for r in values(wh["fact_orders"], "total_price")] == ["6.00"]
    assert [str(r[0]) for r in values(wh["dim_product"], "current_price")] == ["9.00"]
    assert read_state(spark, path, "state_orders").count() == 0


def read_state(spark, path, name):
    return store.read_parts(spark, path, name, store.last_commit(spark, path).of(name))


def test_moved_and_emptied_orders_and_renamed_couriers(spark, tmp_path):
    path = str(tmp_path)
    apply_changes(changes_of(make_source(spark)), path, 0)
    orders = [order(2, day="2024-03-06", changed=9), order(3, user=None, day="2024-02-07", changed=9)]
    items = [item(2, 1, 2), item(3, 2, 1)]
    wh = apply_changes(changes(spark, orders=orders, order_items=items, couriers=[courier(1, "Faster", changed=9)]), path, 1)
    assert sorted(values(wh["fact_orders"], "order_id", "delivery_month"))[-2:] == [(1, 202401), (2, 202403)]
    assert values(wh["dim_rider"], "rider_id", "courier_name") == [(1, "Faster")]
    # Order 3 has no facts now, but its date is known.
    again = changes(spark, orders=[order(3, day="2024-02-07", changed=8)], order_items=[item(3, 2, 1)])
    assert apply_changes(again, path, 2)["fact_orders"].filter("order_id = 3").count() == 0


def test_only_touched_months_and_buckets_are_written(spark, tmp_path):
    path = str(tmp_path)
    apply_changes(changes_of(make_source(spark)), path, 0)
    before = store.last_commit(spark, path)
    apply_changes(changes(spark, orders=[order(3, day="2024-02-07", changed=9)], order_items=[item(3, 1, 4)]), path, 1)
    after = store.last_commit(spark, path)
    written = {(p.table, p.piece) for p in after.parts if p.version == 2}
    assert ("fact_orders", 202402) in written and ("fact_orders", 202401) not in written
    assert not {t for t, _ in written if t.startswith(("dim_product", "dim_user", "state_p", "state_u", "state_r"))}
    assert {p for p in before.parts if p.table in ("state_users", "dim_user")} <= set(after.parts)


def test_empty_batches_rows_without_keys_and_mixed_ways(spark, tmp_path):
    path = str(tmp_path / "fed")
    wh = apply_changes(spark.createDataFrame([], CHANGES_SCHEMA), path)
    assert all(wh[name].count() == 0 for name in store.SCHEMAS)
    nothing = changes(spark, users=[user(None)], orders=[order(None)], riders=[rider(None)], products=[product(None)])
    assert apply_changes(nothing, path)["dim_user"].count() == 0
    with pytest.raises(ValueError):
        etl.run_etl(spark, make_source(spark), path)
    etl.run_etl(spark, make_source(spark), str(tmp_path / "loaded"))
    with pytest.raises(ValueError):
        apply_changes(nothing, str(tmp_path / "loaded"))


def test_stream_of_change_files(spark, tmp_path):
    news, path, checkpoint = (str(tmp_path / name) for name in ("news", "warehouse", "checkpoint"))
    changes_of(make_source(spark)).coalesce(1).write.mode("append").parquet(news)
    follow_changes(change_files(spark, news, 1), path, checkpoint).awaitTermination()
    changes(spark, orders=[order(2, day="1/6/2024", changed=9)], order_items=[item(2, 1, 8)]).coalesce(1).write.mode("append").parquet(news)
    follow_changes(change_files(spark, news, 1), path, checkpoint).awaitTermination()
    facts = store.warehouse(spark, path)["fact_orders"]
    assert sorted(values(facts, "order_id", "quantity")) == [(1, 1), (1, 3), (1, 5), (2, 8), (3, 1)]
    assert store.last_commit(spark, path).feeds == {"changes": 1}
