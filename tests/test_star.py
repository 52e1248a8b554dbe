"""Big dimensions: what is shuffled, and sums and bitmaps in place of rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelmart.operators.key_filter import MOST_WORDS, filter_words, may_match
from parcelmart.operators.star import Dim, rollup_distinct, rollup_labelled, star_sum
from parcelmart.plans import etl, queries
from parcelmart.sources.warehouse import Warehouse
from tests.fixture import BASE, at, item, make_source, order, rider, user
from tests.helpers import frame_rows, values

PLACES = [("Italy", "Rome"), ("Norway", "Oslo"), ("Ghana", "Accra"), (None, "Nowhere"), ("Italy", None)]


def source(spark, **more):
    tables = {
        "users": [user(i, PLACES[i % 5][1], PLACES[i % 5][0]) for i in range(400)],
        "riders": [rider(i, vehicle=f"V{i % 3}") for i in (*range(1, 40), 40_000, 70_001)],
        "orders": [order(i, user=i % 400, rider=(40_000, 70_001, None, i % 40)[i % 4], day=f"2024-0{1 + i % 6}-11") for i in range(1200)],
        "order_items": [item(i % 1200, 1 + i % 2, i % 7) for i in range(3000)],
    }
    return make_source(spark, **{**tables, **more})


@pytest.fixture(scope="module")
def far(spark) -> Warehouse:
    return etl.derived_warehouse(source(spark))


def test_only_facts_that_match_a_filtered_dimension_are_shuffled(spark, far):
    facts = far["fact_orders"]
    italy = Dim("dim_user", ["country"], {"country": "Italy"})
    passed = facts.filter(may_match(italy.frame(far), "user_id", filter_words(None)))
    exact = facts.join(italy.frame(far), "user_id", "left_semi")
    assert exact.count() <= passed.count() <= 1.05 * exact.count() < 0.5 * facts.count()
    assert frame_rows(passed.join(italy.frame(far), "user_id", "left_semi")) == frame_rows(exact)
    plan = star_sum(far, facts, [Dim("dim_product", ["category"]), italy], ["category"], {"sales": F.col("total_price")})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.split("\n") if "Join Inner" in line]
    # The filtered dimension is joined first, so lower in the plan, and the filter stands below both joins.
    assert "product_id" in joins[0] and "user_id" in joins[1]
    assert text.index("getbit") > text.index(joins[1].strip())


def test_filter_sizes_are_bounded():
    assert [filter_words(n) for n in (0, 40_000_000, 1 << 50)] == [1 << 12, 1 << 17, MOST_WORDS]


def test_distinct_riders_by_bitmaps(spark, far):
    keys = ["country", "city"]
    rows = star_sum(far, far["fact_orders"], [Dim("dim_user", keys)], [*keys, "rider_id"], {"sales": F.col("total_price")})
    got = rollup_distinct(rows, keys, {"city": "All"}, ["sales"], "rider_id", "riders")
    want = rollup_labelled(rows, keys, {"city": "All"}, [F.sum("sales").alias("sales"), F.count_distinct("rider_id").alias("riders")])
    assert frame_rows(got.select(want.columns)) == frame_rows(want)
    expand = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Expand" in x]
    assert expand and not any("rider_id" in x for x in expand)


def without_sums(wh: Warehouse) -> Warehouse:
    return Warehouse({name: (lambda name=name: wh[name]) for name in wh}, wh.sizes)


CASES = {
    "q1": lambda wh: queries.revenue_by_period(wh, "2024-01-01", "2024-12-31", "Toys", "month"),
    "q4": lambda wh: queries.sales_moving_average(wh),
    "q4_country": lambda wh: queries.sales_moving_average(wh, "Italy"),
    "q6": lambda wh: queries.vehicle_deliveries(wh),
    "q6_year": lambda wh: queries.vehicle_deliveries(wh, 2024),
    "q6_month": lambda wh: queries.vehicle_deliveries(wh, None, 3),
    "q6_year_month": lambda wh: queries.vehicle_deliveries(wh, 2024, 3),
}


def check_sums(wh):
    for name, case in CASES.items():
        kept, facts = case(wh), case(without_sums(wh))
        assert kept.schema == facts.schema and frame_rows(kept) == frame_rows(facts), name
        assert not any("fact_orders" in f for f in kept.inputFiles()), name


def test_kept_sums_equal_facts_after_every_kind_of_load(spark, tmp_path):
    path = str(tmp_path)
    check_sums(etl.run_etl(spark, source(spark), path, at(200)))
    moved = [order(i, user=i % 400, rider=1, day=None if i % 2 else "2025-02-03", changed=210) for i in range(40)]
    orders = [*moved, *[order(i, user=i % 400, rider=i % 40, day=f"2024-0{1 + i % 6}-11") for i in range(40, 1200)]]
    users = [user(i, "Oslo", "Norway", changed=210) for i in range(100)]
    check_sums(etl.run_etl(spark, source(spark, orders=orders, users=users), path, at(220)))
    lost = [order(i, user=None, changed=230) for i in range(1200)]
    emptied = etl.run_etl(spark, source(spark, orders=lost), path, at(240))
    assert emptied["fact_orders"].count() == 0 and emptied["sums_user"].count() == 0
    check_sums(emptied)


def test_a_small_load_reads_and_writes_only_its_months(spark, tmp_path):
    """Whose files are read is told by taking the others away."""
    import shutil

    path = str(tmp_path)
    etl.run_etl(spark, make_source(spark), path, at(10))
    (january,) = tmp_path.glob("fact_orders/*/delivery_month=202401")
    shutil.move(january, tmp_path / "away")
    wh = etl.run_etl(spark, make_source(spark, order_items=[*BASE["order_items"], item(3, 1, 9, changed=11)]), path, at(20))
    shutil.move(tmp_path / "away", january)
    assert sorted(values(wh["fact_orders"], "order_id", "quantity")) == [(1, 1), (1, 3), (1, 5), (2, 2), (3, 1), (3, 9)]
