"""Compaction and expiry keep facts, keys and the versions asked for."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from parcelmart.operators import load
from parcelmart.plans import etl
from parcelmart.plans.upkeep import compact, expire
from parcelmart.sources import warehouse as store
from tests.fixture import BASE, at, item, make_source
from tests.helpers import frame_rows, values


def test_compaction_and_expiry(spark, tmp_path):
    path, items = str(tmp_path), BASE["order_items"]
    for day in (10, 20, 30):
        items = [*items, item(3, 1, day, changed=day - 5)]
        wh = etl.run_etl(spark, make_source(spark, order_items=items), path, at(day))
    # February was written by every load; its last version is given a second file.
    february = next(p for p in store.last_commit(spark, path).of("fact_orders") if p.month == 202402)
    rows = wh["fact_orders"].filter("delivery_month = 202402").drop("delivery_month")
    folder = f"{path}/{february.folder}/delivery_month=202402"
    rows.repartition(3).write.mode("append").parquet(f"{path}-copy")
    before = frame_rows(wh["fact_orders"])
    spark.read.parquet(f"{path}-copy").repartition(3).write.mode("overwrite").parquet(folder)
    assert frame_rows(store.warehouse(spark, path)["fact_orders"]) == before
    after = compact(spark, path)
    assert frame_rows(after["fact_orders"]) == before
    commit = store.last_commit(spark, path)
    assert commit.version == 4 and commit.run_date == at(30)
    (part,) = [p for p in commit.of("fact_orders") if p.month == 202402]
    assert part.version == 4 and len(list((tmp_path / part.folder / "delivery_month=202402").glob("*.parquet"))) == 1
    assert compact(spark, path) and store.last_commit(spark, path).version == 4
    third = frame_rows(store.warehouse(spark, path, 3)["fact_orders"])
    (tmp_path / "dim_user" / "v=9-running").mkdir()
    assert expire(spark, path, 2) > 0 and expire(spark, path, 2) == 0
    assert (tmp_path / "dim_user" / "v=9-running").exists()
    assert frame_rows(store.warehouse(spark, path, 3)["fact_orders"]) == third == before
    with pytest.raises(AnalysisException):
        store.warehouse(spark, path, 1)["fact_orders"].count()
    wh = etl.run_etl(spark, make_source(spark, order_items=[*items, item(1, 1, 77, changed=35)]), path, at(40))
    assert (1, 77) in values(wh["fact_orders"], "order_id", "quantity") and wh["fact_orders"].count() == 9


def test_of_two_loads_from_one_version_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    etl.run_etl(spark, make_source(spark), path, at(10))
    items, commit = [*BASE["order_items"], item(3, 1, 9, changed=11)], load.record_run

    def late(*args):
        monkeypatch.setattr(load, "record_run", commit)
        etl.run_etl(spark, make_source(spark, order_items=items), path, at(20))
        commit(*args)

    monkeypatch.setattr(load, "record_run", late)
    with pytest.raises(store.LoadConflict):
        etl.run_etl(spark, make_source(spark, order_items=[*BASE["order_items"], item(2, 2, 5, changed=11)]), path, at(20))
    wh = store.warehouse(spark, path)
    assert wh["fact_orders"].count() == 6 and (2, 5) not in values(wh["fact_orders"], "order_id", "quantity")
    assert store.runs(spark, path).count() == 2
