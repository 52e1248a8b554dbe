"""Upkeep of a stored warehouse: months of many small files are merged, and what no kept version needs is deleted."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from parcelmart.operators import load
from parcelmart.plans import etl
from parcelmart.sources.commits import delete_folder, folders
from parcelmart.sources.warehouse import PIECES, SCHEMAS, Warehouse, last_commit, warehouse

# Files per file needed from which a month is written anew.
FILES_TOO_MANY = 2


def compact(spark: SparkSession, path: str) -> Warehouse:
    """Write every month that has too many files anew, in files of ``FACTS_PER_TASK`` facts, and commit a new version.

    Facts and their keys stay as they are, and so do all other tables. The date of the last load stays too, so the next
    load misses nothing. A load that commits meanwhile wins: the compaction raises ``LoadConflict`` and shows nothing.
    """
    run = etl.start_load(spark, path)
    facts, old = run.read("fact_orders"), run.old.of("fact_orders")
    files = facts.select("delivery_month", F.input_file_name().alias("file")).groupBy("delivery_month").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files")
    )
    needed = F.ceil(F.col("n") / load.FACTS_PER_TASK)
    many = files.filter(F.col("files") >= FILES_TOO_MANY * needed).collect()  # at most one row per calendar month
    again = [p for p in old if p.piece in {r["delivery_month"] for r in many}]
    if not again:
        return warehouse(spark, path)
    order = ["delivery_month", "order_id", "fact_id"]
    tasks = max(len(many), sum(-(-r["n"] // load.FACTS_PER_TASK) for r in many))
    months = run.read("fact_orders", again).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    _, written = load.write_months(months, run.folder("fact_orders"), "overwrite")
    parts = [*(p for p in run.old.parts if p not in again), *(run.part("fact_orders", m) for m in sorted(written))]
    load.record_run(spark, path, run.commit(run.old.run_date, parts), None)
    return warehouse(spark, path)


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the parts that none of the newest ``keep`` versions names, and what failed loads have left; returns how
    many folders went. Kept versions can be read as before. Folders of a load that is still running stay."""
    last = last_commit(spark, path).version
    kept = [last_commit(spark, path, v) for v in range(max(1, last - keep + 1), last + 1)]
    parts = [p for commit in kept for p in commit.parts]
    wholes, gone = {p.folder for p in parts}, 0
    pieces = {f"{p.folder}/{PIECES[p.table][1]}={p.piece}" for p in parts if p.table in PIECES}
    for table in [*SCHEMAS, *(t for t in PIECES if t not in SCHEMAS)]:
        for name in folders(spark, f"{path}/{table}"):
            folder = f"{table}/{name}"
            if int(name.removeprefix("v=").split("-")[0]) > last:
                continue
            if folder not in wholes:
                gone += delete_folder(spark, f"{path}/{folder}")
            elif table in PIECES:
                for piece in folders(spark, f"{path}/{folder}"):
                    if f"{folder}/{piece}" not in pieces:
                        gone += delete_folder(spark, f"{path}/{folder}/{piece}")
    return gone
