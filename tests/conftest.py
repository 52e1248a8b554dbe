from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import SparkSession

from parcelmart.session import RESULT_CONF
from parcelmart.sources.testdata import BASE_TABLES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    builder = SparkSession.builder.master("local[8]").appName("parcelmart-tests")
    local = {
        "spark.sql.shuffle.partitions": "2",
        "spark.ui.enabled": "false",
        "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false",
        # The whole suite runs in this one session.
        "spark.driver.memory": "4g",
        "spark.sql.ui.retainedExecutions": "10",
        "spark.ui.retainedJobs": "10",
        "spark.ui.retainedStages": "10",
        "spark.ui.retainedTasks": "100",
        # On these tiny inputs compiling code and re-planning between stages take longer than the work itself; the
        # bench and the driver's checks run with both.
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    }
    for key, value in {**RESULT_CONF, **local}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection
