"""Incremental maintenance of warehouse tables. Keys are compared by joins; none is ever collected."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from parcelmart.functions.clean import to_utc_ts
from parcelmart.operators.fact import FACT_COLUMNS
from parcelmart.session import work_table
from parcelmart.sources.warehouse import Commit, delivery_month, write_commit

# Columns that steer a load and are not stored.
CONTROL_COLUMNS = ("updatedAt", "updated_at")
# Bytes a row takes in a hash table besides its columns.
ROW_OVERHEAD = 48
# Facts per file of their sums, and per task that sorts them: few enough to be sorted in memory.
FACTS_PER_TASK = 2_000_000
SORTED_PER_TASK = 500_000


def change_date(df: DataFrame, col: str = "updatedAt") -> Column:
    """Date a row changed. A column of dates stays as it is, so filters on it reach the scan; text that cannot be read
    is no date."""
    return to_utc_ts(F.col(col)) if df.schema[col].dataType.typeName() == "string" else F.col(col)


def changed(df: DataFrame, ts: datetime | None, col: str = "updatedAt") -> Column:
    """Predicate: changed strictly after ``ts`` (None = always true); a row without a date never passes."""
    return F.lit(True) if ts is None else change_date(df, col) > F.lit(ts)


def changed_since(df: DataFrame, ts: datetime | None, col: str = "updatedAt") -> DataFrame:
    """Rows changed after ``ts``; the filter reaches the scan."""
    return df.filter(changed(df, ts, col))


def undated(df: DataFrame, col: str = "updatedAt") -> DataFrame:
    """Rows without a date they changed at."""
    return df.filter(change_date(df, col).isNull())


def load_mode(n_changed: Column, n_all: Column) -> Column:
    """'none' when nothing changed, 'full' when every row did, else 'incremental'. It reports; no load depends on it."""
    return F.when(n_changed == 0, "none").when(n_changed < n_all, "incremental").otherwise("full")


def change_counts(df: DataFrame, ts: datetime | None, col: str = "updatedAt") -> DataFrame:
    """One row: number of changed rows, of all rows, and the load mode that follows."""
    counts = df.agg(F.count_if(changed(df, ts, col)).alias("n_changed"), F.count(F.lit(1)).alias("n_all"))
    return counts.withColumn("mode", load_mode(F.col("n_changed"), F.col("n_all")))


def drop_control(df: DataFrame) -> DataFrame:
    """Without the columns that only steer the load."""
    return df.drop(*CONTROL_COLUMNS)


def upsert(target: DataFrame, changed_rows: DataFrame, key: str) -> DataFrame:
    """Target with the changed rows replaced or added."""
    kept = target.join(changed_rows.select(key), key, "left_anti")
    return kept.unionByName(drop_control(changed_rows))


def new_rows(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key the target does not have yet."""
    return rows.join(target.select(key), key, "left_anti")


def insert_new(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Target plus the rows it does not have yet; existing rows stay as they are."""
    return target.unionByName(drop_control(new_rows(target, rows, key)))


def touched_keys(changed_rows: DataFrame, key: str) -> DataFrame:
    """Distinct group keys of the changed rows."""
    return changed_rows.select(key).distinct()


def replace_by_group(target: DataFrame, current: DataFrame, changed_rows: DataFrame, key: str) -> DataFrame:
    """Target with every group that has a changed row replaced by all current rows of that group."""
    touched = touched_keys(changed_rows, key)
    kept = target.join(touched, key, "left_anti")
    return kept.unionByName(drop_control(current.join(touched, key, "left_semi")))


def write_table(df: DataFrame, path: str) -> int:
    """Write a table in parallel tasks and return what its rows take in a hash table, in bytes, taken while writing."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    fixed = 8 * (len(df.columns) - len(texts))
    row_bytes = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(fixed + ROW_OVERHEAD))
    seen = Observation()
    df.observe(seen, F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).write.mode("overwrite").parquet(path)
    return int(seen.get["bytes"])


def write_pieces(rows: DataFrame, path: str, key: str, mode: str = "overwrite") -> tuple[int, set[int]]:
    """Write rows partitioned by ``key``; returns how many and which pieces there are, counted while writing."""
    seen = Observation()
    pieces = F.collect_set(key).alias("pieces")  # at most one value per calendar month or bucket
    writer = rows.observe(seen, F.count(F.lit(1)).alias("n"), pieces).write.mode(mode)
    writer.option("partitionOverwriteMode", "static").partitionBy(key).parquet(path)
    return int(seen.get["n"]), set(seen.get["pieces"])


def write_months(facts: DataFrame, path: str, mode: str) -> tuple[int, set[int]]:
    """Write facts partitioned by delivery month; returns how many and in which months."""
    return write_pieces(facts, path, "delivery_month", mode)


def sorting_tasks(df: DataFrame, rows: int) -> int:
    """Tasks to sort so many facts in: all cores for as few as 10,000 facts each, more beyond ``SORTED_PER_TASK`` each."""
    return max(min(df.sparkSession.sparkContext.defaultParallelism, rows // 10_000 + 1), -(-rows // SORTED_PER_TASK))


def write_numbered_facts(rows: DataFrame, path: str, first_id: int) -> tuple[int, set[int]]:
    """Write facts with keys ``first_id, first_id + 1, ...``, partitioned by delivery month; returns count and months.

    The rows are written once as they come, which fixes them; see ``number_facts``.
    """
    with work_table(rows.select(*FACT_COLUMNS), "fact-rows") as fixed:
        return number_facts(fixed, fixed.count(), path, first_id)


def number_facts(fixed: DataFrame, n: int, path: str, first_id: int) -> tuple[int, set[int]]:
    """Write ``n`` stored facts with keys ``first_id, first_id + 1, ...``, partitioned by delivery month.

    Keys follow the order month, order, then the other columns. The tie among identical rows is their place in their
    file; rows that share it too are the same in all that is stored, so repeating a task cannot change a position. One
    range shuffle on the columns and the tie serves three ends: even files, few files per month, and positions to number
    by; neither a huge order nor a mass of copies ends up in one task. The key is the number of rows in the sorted files
    before plus the position in the file.
    """
    order = ["delivery_month", *FACT_COLUMNS]
    file, row = F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    placed = fixed.select(*FACT_COLUMNS, delivery_month(), row)
    ranged = placed.repartitionByRange(sorting_tasks(fixed, n), *order, "_row")
    ordered = ranged.sortWithinPartitions(*order, "_row").drop("_row")
    with work_table(ordered, "facts") as stored:
        located = stored.select("*", file, row)
        per_file = located.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
        # One row per file, so per task of the range shuffle: one for each half a million facts.
        earlier = Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_file.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        fact_id = (F.col("_before") + F.col("_row") + first_id).cast("bigint").alias("fact_id")
        numbered = located.join(F.broadcast(offsets), "_file").select(fact_id, *FACT_COLUMNS, "delivery_month")
        return write_months(numbered, path, "overwrite")


def record_run(spark: SparkSession, path: str, commit: Commit, quality: Mapping[str, int] | None) -> None:
    """Add a load's row to the run log; this commits the load, unless its version has been committed meanwhile."""
    write_commit(spark, path, commit, quality)
