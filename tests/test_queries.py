"""Properties of the queries beyond their check SQL."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest

from parcelmart.plans import etl, queries, reports
from parcelmart.sources.testdata import mapped_source
from parcelmart.sources.warehouse import Warehouse
from tests.conftest import SMALL
from tests.fixture import at, item, make_source, order, user
from tests.helpers import frame_rows, values

CASES = {
    "q1": lambda wh: queries.revenue_by_period(wh, "1998-01-01", "1998-12-31", "Rings", "day"),
    "q3": lambda wh: queries.top_products(wh, 10, "ASIA"),
    "q4": lambda wh: queries.sales_moving_average(wh),
    "q5": lambda wh: queries.rider_ranking(wh),
    "q6": lambda wh: queries.vehicle_deliveries(wh, 1998),
    "q7": lambda wh: queries.top_percentile_riders(wh, 1998, 2, "ASIA", 100),
    "q8": lambda wh: queries.revenue_rollup(wh, 1998, "ASIA"),
    "q9": lambda wh: queries.revenue_rollup_filtered(wh, 1998),
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory) -> Warehouse:
    path = str(tmp_path_factory.mktemp("warehouse"))
    return etl.run_etl(spark, mapped_source(spark, SMALL), path, at(1))


@pytest.fixture(scope="module")
def big_dims(stored) -> Warehouse:
    """The same warehouse with no dimension known to be small."""
    return Warehouse({name: (lambda name=name: stored[name]) for name in stored})


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", CASES)
def test_broadcast_and_summed_shapes_agree(stored, big_dims, name):
    assert frame_rows(CASES[name](stored)) == frame_rows(CASES[name](big_dims))


@pytest.mark.parametrize("name", CASES)
def test_result_types_do_not_depend_on_sizes(stored, big_dims, name):
    assert CASES[name](stored).schema == CASES[name](big_dims).schema


def test_percentiles_run_nothing_while_planned(spark, stored):
    spark.sparkContext.setJobGroup("planning-q7", "")
    CASES["q7"](stored)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning-q7")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_facts_are_summed_before_a_big_dimension_is_joined(spark, big_dims):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = CASES["q3"](big_dims)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
    last_join, scan = plan.index("SortMergeJoin"), plan.index("total_price")
    assert plan.rindex("partial_sum") > last_join and scan > last_join


@pytest.mark.parametrize("name", CASES)
def test_plans_stay_in_the_engine(stored, name):
    plan = plan_of(CASES[name](stored))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_year_filters_prune_months_and_columns(stored):
    plan = plan_of(CASES["q9"](stored))
    assert re.search(r"PartitionFilters: \[isnotnull\(delivery_month#\d+\), \(delivery_month#\d+ >= 199801\)", plan)
    assert "fact_id" not in plan.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0].split("Relation")[0]


def test_rollups_add_up(stored):
    rolled = queries.revenue_rollup(stored, 1998, with_gid=True).collect()
    totals = {gid: sum(r["total_revenue"] for r in rolled if r["gid"] == gid) for gid in (0, 1, 3, 7)}
    assert len(set(totals.values())) == 1
    filtered = queries.revenue_rollup_filtered(stored, 1998).drop("average_order_value")
    assert frame_rows(filtered) == frame_rows(queries.revenue_rollup(stored, 1998))


def test_percentiles_are_percentages(stored):
    got = [r["sales_percentile"] for r in CASES["q7"](stored).collect()]
    assert min(got) == 0 and max(got) <= 100


def small(spark, **tables) -> Warehouse:
    return etl.derived_warehouse(make_source(spark, **tables))


def test_a_null_city_is_not_a_subtotal(spark):
    wh = small(spark, users=[user(1, None), user(2, "Rome"), user(3, None, None)])
    got = queries.customer_distribution(wh, with_gid=True)
    assert sorted(values(got, "country", "city", "total_customers", "gid"), key=str) == sorted(
        [("Italy", None, 1, 0), ("Italy", "Rome", 1, 0), (None, None, 1, 0), ("Italy", None, 2, 1), (None, None, 1, 1),
         (None, None, 3, 3)],
        key=str,
    )
    assert values(reports.customers_by_country(got), "country", "total_customers") == [("Italy", 2)]
    listing = values(reports.customers_listing(got), "country", "city", "total_customers")
    assert ("Italy", "Total", 2) in listing and ("Italy", None, 1) in listing
    revenue = queries.revenue_rollup(small(spark, users=[user(1, None)]), 2024, with_gid=True)
    assert [r["city"] for r in revenue.filter("gid = 1").collect()] == [None]
    assert [r["city"] for r in revenue.filter("gid = 3").collect()] == ["All Cities"]


def test_category_parameters_are_normalised(spark):
    wh = small(spark)
    for text in ("Bags", "BAG", " bag "):
        assert queries.top_products(wh, 10, category=text).count() == 1
        assert queries.revenue_rollup(wh, 2024, category=text).count() == 1


def test_moving_average_counts_rows_not_months(spark):
    days = ["2024-01-05", "2024-02-05", "2024-06-05", "2024-07-05"]
    wh = small(spark, orders=[order(i, day=d) for i, d in enumerate(days)], order_items=[item(i, 1, 10 ** i) for i in range(4)])
    got = [str(r[0]) for r in queries.sales_moving_average(wh).select("moving_avg_3_month").collect()]
    assert got == ["10.00", "55.00", "370.00", "3700.00"]


def test_growth_and_missing_quarters(spark):
    orders = [order(1, day="2023-12-31", rider=1), order(2, day="2024-01-01", rider=1), order(3, day="2024-02-01", rider=2),
              order(4, day="2023-11-01", rider=3), order(5, user=2, day="2024-03-31", rider=None)]
    wh = small(spark, orders=orders, order_items=[item(i, 1, i) for i in range(1, 6)], users=[user(1), user(2)])
    got = queries.top_percentile_riders(wh, 2024, 1, "Italy", 100)
    assert values(got, "period", "rider_id", "total_sales", "prev_quarter_sales", "sales_growth_pct", "sales_percentile") == [
        ("2024-Q1", -1, Decimal("50.00"), None, None, Decimal("0.00")),
        ("2024-Q1", 2, Decimal("30.00"), None, None, Decimal("50.00")),
        ("2024-Q1", 1, Decimal("20.00"), Decimal("10.00"), Decimal("100.00"), Decimal("100.00")),
    ]


def test_an_empty_selection_keeps_its_grand_total(spark):
    wh = small(spark)
    got = [tuple(r) for r in queries.vehicle_deliveries(wh, 1999).collect()]
    assert got == [(None, None, None, 0)]
    assert queries.revenue_rollup(wh, 1999, "Italy").count() == 0


def test_matrix_columns_come_from_the_data(spark):
    wh = small(spark)
    view = reports.city_view(reports.drilldown(wh, year=2024, country="Italy"), "Italy")
    assert reports.city_category_matrix(view).columns == ["city_rank", "city", "bag", "toy"]


def test_views_can_be_queried_by_name(spark, stored):
    stored.create_views()
    assert spark.sql("SELECT count(*) FROM fact_orders JOIN dim_date ON delivery_date_id = date_id").first()[0] > 0
