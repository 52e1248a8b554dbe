from __future__ import annotations

from parcelmart.sources import warehouse as store
from parcelmart.streaming.follow import load_on_change
from tests.fixture import BASE, SCHEMAS, item, make_source
from tests.helpers import values


def test_each_arrival_loads_what_changed(spark, tmp_path):
    news, path, checkpoint = (str(tmp_path / name) for name in ("news", "warehouse", "checkpoint"))

    def arrive(items, source_items):
        spark.createDataFrame(items, SCHEMAS["order_items"]).coalesce(1).write.mode("append").parquet(news)
        changes = spark.readStream.schema(SCHEMAS["order_items"]).parquet(news)
        load_on_change(changes, make_source(spark, order_items=source_items), path, checkpoint).awaitTermination()
        return sorted(values(store.warehouse(spark, path)["fact_orders"], "order_id", "product_id", "quantity"))

    assert len(arrive(BASE["order_items"], BASE["order_items"])) == 5
    late = item(3, 1, 9, changed=366 * 10)
    assert arrive([late], [*BASE["order_items"], late])[-2:] == [(3, 1, 9), (3, 2, 1)]
    assert store.runs(spark, path).count() == 2
