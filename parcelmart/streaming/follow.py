"""Loads from a stream: started by arriving news instead of a clock, or made of the arriving changes themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from parcelmart.plans.changes import CHANGES_SCHEMA, apply_changes
from parcelmart.plans.etl import run_etl
from parcelmart.sources.tables import Source


def load_on_change(
    changes: DataFrame, source: Source, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Run the incremental load once per micro-batch of ``changes``, a stream that tells when the source has news.

    The rows of the stream are not loaded themselves: a load takes what changed since the last committed run, so a batch
    that is delivered twice loads nothing twice. Without ``every`` the stream ends when all waiting news is handled.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            run_etl(batch.sparkSession, source, path)

    writer = changes.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def change_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The stream of change rows in the Parquet files of a folder."""
    return spark.readStream.schema(CHANGES_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def follow_changes(
    changes: DataFrame, path: str, checkpoint: str, feed: str = "changes", every: str | None = None
) -> StreamingQuery:
    """Apply a stream of change rows to a warehouse, one commit per micro-batch.

    The commit holds the batch's number, so a batch that is delivered again after a failure is skipped. A feed belongs to
    one checkpoint folder, which numbers its batches. Without ``every`` the stream ends when all waiting rows are applied.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_changes(batch, path, batch_id, feed)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()
