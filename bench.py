"""Times the load job and the nine queries and prints one JSON line.

The load is timed on its second run, into a new warehouse. The queries run on that warehouse; each is timed as the best
of three runs with its result fully computed and thrown away, after one untimed run of all queries. The cases named
``far`` run with no dimension known to be small and no kept sums; they are not part of the total.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from parcelmart.plans import etl, queries
from parcelmart.session import ADAPTIVE_CONF, RESULT_CONF
from parcelmart.sources.testdata import mapped_source
from parcelmart.sources.warehouse import Warehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("parcelmart-bench")
    local = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**RESULT_CONF, **ADAPTIVE_CONF, **local}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    source = mapped_source(spark, SF_DIR)
    path = tempfile.mkdtemp(prefix="run-")
    etl.run_etl(spark, source, tempfile.mkdtemp(prefix="run-"))
    seconds = {"etl_full_load": timed(lambda: etl.run_etl(spark, source, path))}
    wh = etl.warehouse(spark, path)
    cases = {
        "q1": lambda: queries.revenue_by_period(wh, "1998-01-01", "1998-12-31", "Rings", "month"),
        "q2": lambda: queries.customer_distribution(wh),
        "q3": lambda: queries.top_products(wh, 10),
        "q4": lambda: queries.sales_moving_average(wh, "ASIA"),
        "q5": lambda: queries.rider_ranking(wh, "ASIA"),
        "q6": lambda: queries.vehicle_deliveries(wh, 1998, 10),
        "q7": lambda: queries.top_percentile_riders(wh, 1998, 4, "ASIA", 90),
        "q8": lambda: queries.revenue_rollup(wh, 1998, "ASIA", "NATION_2"),
        "q9": lambda: queries.revenue_rollup_filtered(wh, 1998),
    }
    far = Warehouse({name: (lambda name=name: wh[name]) for name in wh})
    cases |= {
        "q3_far": lambda: queries.top_products(far, 10, "ASIA"),
        "q8_far": lambda: queries.revenue_rollup(far, 1998, "ASIA", "NATION_2"),
        "q9_far": lambda: queries.revenue_rollup_filtered(far, 1998, "ASIA"),
    }
    results = {name: (lambda build=build: build().write.format("noop").mode("overwrite").save()) for name, build in cases.items()}
    for run in results.values():
        run()
    for name, run in results.items():
        seconds[name] = min(timed(run) for _ in range(RUNS))
    line = {
        "metric": "total seconds, full load plus Q1-Q9",
        "value": round(sum(value for name, value in seconds.items() if not name.endswith("far")), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
