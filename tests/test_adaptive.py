"""The plans that ship: adaptive execution and code generation on, as in production."""

from __future__ import annotations

import pytest

from parcelmart.plans import etl
from parcelmart.session import ADAPTIVE_CONF
from parcelmart.sources.warehouse import Warehouse
from tests.fixture import at, item, make_source
from tests.helpers import frame_rows
from tests.test_queries import CASES

PRODUCTION = {
    **ADAPTIVE_CONF,
    "spark.sql.codegen.wholeStage": "true",
    "spark.sql.codegen.factoryMode": "FALLBACK",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture(scope="module", autouse=True)
def production(spark):
    before = {key: spark.conf.get(key, None) for key in PRODUCTION}
    for key, value in PRODUCTION.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_load_and_queries_on_skewed_facts(spark, tmp_path):
    """One order and product with nearly all items; dimensions near and far give the same rows and types."""
    items = [item(1, 1, k % 3) for k in range(2000)] + [item(2, 2), item(3, 2)]
    near = etl.run_etl(spark, make_source(spark, order_items=items), str(tmp_path), at(10))
    assert near["fact_orders"].count() == 2002
    far = Warehouse({name: (lambda name=name: near[name]) for name in near})
    for name in ("q3", "q4", "q5", "q9"):
        a, b = CASES[name](near), CASES[name](far)
        assert a.schema == b.schema and frame_rows(a) == frame_rows(b), name
    more = etl.run_etl(spark, make_source(spark, order_items=[*items, item(2, 1, 5, changed=11)]), str(tmp_path), at(20))
    assert more["fact_orders"].count() == 2003
