"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from parcelmart.sources.commits import delete_folder

# Settings results depend on.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# Spark's defaults the plans count on: heavy join partitions are split, and joins are re-planned by actual sizes.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_work_dirs: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session built elsewhere."""
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's checkpoint folder.

    A temporary folder is only used by a local session, where driver and executors share one machine.
    """
    shared = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(_CHECKPOINT_DIR)
    if shared:
        return f"{shared.rstrip('/')}/parcelmart"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_work_dirs:
        _local_work_dirs[app] = tempfile.mkdtemp(prefix="parcelmart-")
    return _local_work_dirs[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def work_table(df: DataFrame, name: str, *partition_by: str) -> Iterator[DataFrame]:
    """``df`` written to the work folder and read back, so a lost executor costs a re-read and not a recomputation.

    On exit the table is deleted; use it only for what ends inside the block.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)
