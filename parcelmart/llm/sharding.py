"""Sharding by fixed virtual slots: records hash to one of some thousands of slots, and slots are dealt to shards.

Only the slots' sizes are gathered: a fixed number of rows whatever the input. The map from slot to shard is a small
table with a version. To rebalance, the map is edited: a few slots move, and a record's slot never changes.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelmart.llm.common import table
from parcelmart.session import fresh_dir

SLOTS = 8192
SHARDS = 16
MAP_SCHEMA = "version int, virtual_slot int, shard int, slot_bytes bigint, slot_rows bigint"


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a record: its key alone decides, at every input size and number of shards."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(slots)).cast("int")


def slot_sizes(sized: DataFrame) -> DataFrame:
    """Bytes and rows of every slot that has a row."""
    return sized.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count(F.lit(1)).alias("slot_rows"))


def deal(sizes: Mapping[int, int], shards: int) -> dict[int, int]:
    """First map: slots by falling size, each to the shard that has least so far."""
    load = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(sizes, key=lambda s: (-sizes[s], s)):
        held, shard = heapq.heappop(load)
        out[slot] = shard
        heapq.heappush(load, (held + sizes[slot], shard))
    return out


def rebalance(current: Mapping[int, int], sizes: Mapping[int, int], shards: int) -> dict[int, int]:
    """The map edited for new sizes or another number of shards, moving few slots.

    Slots without a shard, or of a shard that is gone, go to the emptiest. Then slots move from the fullest shard to the
    emptiest as long as that lowers the fuller of the two. An added shard starts empty, so it only receives.
    """
    load = dict.fromkeys(range(shards), 0)
    members: dict[int, set[int]] = {s: set() for s in load}
    out = {}
    homeless = []
    for slot in sorted(sizes):
        shard = current.get(slot)
        if shard in load:
            out[slot] = shard
            load[shard] += sizes[slot]
            members[shard].add(slot)
        else:
            homeless.append(slot)
    for slot in sorted(homeless, key=lambda s: (-sizes[s], s)):
        shard = min(load, key=lambda s: (load[s], s))
        out[slot] = shard
        load[shard] += sizes[slot]
        members[shard].add(slot)
    for _ in range(len(sizes)):
        full, empty = max(load, key=lambda s: (load[s], -s)), min(load, key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        fits = [s for s in members[full] if 0 < sizes[s] < gap]
        if not fits:
            break
        slot = min(fits, key=lambda s: (abs(gap - 2 * sizes[s]), s))
        members[full].remove(slot)
        members[empty].add(slot)
        out[slot] = empty
        load[full] -= sizes[slot]
        load[empty] += sizes[slot]
    return out


def save_map(spark: SparkSession, path: str, version: int, slot_map: Mapping[int, int], sizes: DataFrame | list) -> None:
    """Store a version of the map beside the earlier ones; at most one row per slot."""
    rows = [(version, r["virtual_slot"], slot_map[r["virtual_slot"]], r["slot_bytes"], r["slot_rows"]) for r in sizes]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the newest by default."""
    rows = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is not None:
        return rows.filter(F.col("version") == version)
    newest = rows.agg(F.max("version").alias("version"))
    return rows.join(F.broadcast(newest), "version")


def shard_by_slots(
    docs: DataFrame,
    shards: int = SHARDS,
    slots: int = SLOTS,
    map_path: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document with its size, virtual slot, shard and place in the shard (``slot``, gapless from 0).

    Size is the UTF-8 bytes of the text plus one, a NULL text counting none. The map goes to ``map_path`` as version 1,
    or, if maps are there already, the newest is rebalanced and stored as the next version. Places follow the shard's
    slots, then id, size and checksum; rows equal in all of these are interchangeable. NULL ids share one slot. Other
    columns are not read. An empty input gives no rows and an empty map.
    """
    spark = docs.sparkSession
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    sized = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        (F.octet_length(content) + 1).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        virtual_slot(F.col(doc_id), slots).alias("virtual_slot"),
    )
    gathered = slot_sizes(sized).collect()  # at most one row per slot, a fixed number
    sizes = {r["virtual_slot"]: r["slot_bytes"] for r in gathered}
    path = map_path or f"{fresh_dir(spark, 'llm-slot-map')}"
    spark.createDataFrame([], MAP_SCHEMA).write.mode("ignore").parquet(path)
    known = load_map(spark, path).collect()
    slot_map = rebalance({r["virtual_slot"]: r["shard"] for r in known}, sizes, shards) if known else deal(sizes, shards)
    version = max((r["version"] for r in known), default=0) + 1
    save_map(spark, path, version, slot_map, gathered)

    # The map has at most one row per slot, and so has each table made from it.
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("slot_rows").over(before), F.lit(0)).alias("_first")
    placed = load_map(spark, path, version).select("virtual_slot", "shard", "version", first)
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    numbered = sized.withColumn("_row", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(placed), "virtual_slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_first") + F.col("_row")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )


def op9_virtual_slots(spark, sf_dir: str) -> DataFrame:
    return shard_by_slots(table(spark, sf_dir, "documents"))
