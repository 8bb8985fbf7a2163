"""Sharding over fixed virtual slots with a stored, versioned slot map.

A record's slot is a hash of the record and never changes. Bytes are summed for
each slot; slots, not records, are given to shards. The map of slots to shards is a
small table with a version. Rebalancing and growing write a new version in which some
slots have another shard, so only their records move.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeroflow.llm.common import columns, each_copy, size_in_bytes, stored, text_of, unused_name
from aeroflow.session import fresh_dir

SLOTS = 8192
SHARDS = 8
MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes bigint"


def virtual_slot(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """The record's slot. The text takes part, so that rows without an id spread as well."""
    return _slot_of(F.xxhash64(doc_id, text), slots)


def _slot_of(record: Column, slots: int) -> Column:
    return F.pmod(record, F.lit(slots)).cast("int")


def balanced(loads: dict[int, int], slots: int, shards: int) -> dict[int, int]:
    """A shard for each slot: the heaviest slot first, always to the lightest shard."""
    heap = [(0, 0, shard) for shard in range(shards)]
    placed = {}
    for slot in sorted(range(slots), key=lambda s: (-loads.get(s, 0), s)):
        load, held, shard = heapq.heappop(heap)
        placed[slot] = shard
        heapq.heappush(heap, (load + loads.get(slot, 0), held + 1, shard))
    return placed


def rebalanced(placed: dict[int, int], loads: dict[int, int], shards: int, tolerance: float = 0.01,
               into: range | None = None) -> dict[int, int]:
    """``placed`` with as few slots moved as bring every shard near the mean load.

    A slot moves from the heaviest to the lightest shard while that narrows their gap;
    only shards in ``into`` receive slots, if it is given.
    """
    placed = dict(placed)
    into = into or range(shards)
    held: dict[int, list[int]] = {s: [] for s in range(shards)}
    for slot, shard in placed.items():
        held[shard].append(slot)
    load = {s: sum(loads.get(x, 0) for x in held[s]) for s in held}
    mean = sum(load.values()) / shards
    for slots in held.values():
        slots.sort(key=lambda x: (loads.get(x, 0), x))
    while True:
        top, low = max(load, key=lambda s: (load[s], s)), min(into, key=lambda s: (load[s], s))
        gap = load[top] - load[low]
        if gap <= tolerance * mean:
            return placed
        fitting = [x for x in held[top] if 0 < loads.get(x, 0) < gap]
        if not fitting:
            return placed
        slot = max((x for x in fitting if loads[x] <= gap / 2), key=lambda x: loads[x], default=fitting[0])
        held[top].remove(slot)
        held[low].append(slot)
        placed[slot] = low
        load[top] -= loads[slot]
        load[low] += loads[slot]


def grown(placed: dict[int, int], loads: dict[int, int], shards: int) -> dict[int, int]:
    """``placed`` for a larger number of shards: slots move to the new shards only."""
    return rebalanced(placed, loads, shards, into=range(max(placed.values()) + 1, shards))


@dataclass
class SlotMap:
    """Versions of the slot map below one folder; a version is never rewritten."""

    spark: SparkSession
    path: str
    slots: int = SLOTS

    def write(self, version: int, placed: dict[int, int], loads: dict[int, int]) -> DataFrame:
        rows = [(version, slot, shard, loads.get(slot, 0)) for slot, shard in sorted(placed.items())]
        frame = self.spark.createDataFrame(rows, MAP_SCHEMA)
        frame.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/version={version:06d}")
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.path}/version={version:06d}")

    def placed(self, version: int) -> dict[int, int]:
        """The map itself; its size is the fixed number of slots."""
        return {r["virtual_slot"]: r["shard"] for r in self.read(version).collect()}


def slot_loads(records: DataFrame) -> dict[int, int]:
    """Bytes by slot: a number for each of the fixed slots at most."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    return {r["virtual_slot"]: r["bytes"] for r in sums.collect()}


def _records(docs: DataFrame, id_col: str, text_col: str, slots: int) -> DataFrame:
    text = text_of(text_col)
    return docs.select(
        F.col(id_col).alias("id"), (size_in_bytes(text) + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(F.col(id_col), text).alias("record"),
        virtual_slot(F.col(id_col), text, slots).alias("virtual_slot"),
    )


def _spread_copies(records: DataFrame, slots: int) -> DataFrame:
    """``records`` with a slot for each copy of a repeated row: its number takes part in the hash.

    Repeated rows are counted, not ordered: the copies of one are alike. The first
    has the slot that ``virtual_slot`` gives.
    """
    counted = records.groupBy("id", "size", "text_crc32", "record").agg(F.count("*").alias("n"))
    copies = each_copy(stored(counted, "counted"), "n", "copy")
    again = _slot_of(F.xxhash64("record", "copy"), slots)
    slot = F.when(F.col("copy") == 0, _slot_of(F.col("record"), slots)).otherwise(again)
    return copies.select("id", "size", "text_crc32", slot.alias("virtual_slot"))


def shard_map(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
              slots: int = SLOTS, path: str | None = None) -> SlotMap:
    """Version 1 of the slot map for ``docs``, stored below ``path`` (a shared folder if not given)."""
    records = _records(docs, id_col, text_col, slots).select("virtual_slot", "size")
    loads = slot_loads(records)
    spark = docs.sparkSession
    slot_map = SlotMap(spark, path or fresh_dir(spark, "llm-slot-map"), slots)
    slot_map.write(1, balanced(loads, slots, shards), loads)
    return slot_map


def shard_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
               slots: int = SLOTS) -> DataFrame:
    """The shard of every row: ``id_col, size, text_crc32, shard, slot, virtual_slot``.

    ``size`` is the bytes of the text plus 1; shards have near equal sums of it. ``slot``
    is the row's place in its shard, gapless from 0, in the order of virtual slot and
    id. NULL texts count as empty, NULL ids come last within a slot. Copies of a repeated
    row have slots of their own, so however many there are, shards stay near equal; a
    single text larger than a shard's share does not. Equal texts with different ids go to
    any shards. An empty table gives an empty result. Other columns are not looked at.
    """
    records = stored(_spread_copies(_records(docs, id_col, text_col, slots), slots), "records")
    loads = slot_loads(records)
    spark = docs.sparkSession
    slot_map = SlotMap(spark, fresh_dir(spark, "llm-slot-map"), slots)
    shard_of = slot_map.write(1, balanced(loads, slots, shards), loads)
    counts = records.groupBy("virtual_slot").agg(F.count("*").alias("n"))
    # One row for each slot that is in use: the number of slots is fixed.
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = shard_of.join(counts, "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("virtual_slot").orderBy(F.col("id").asc_nulls_last(), "text_crc32", "size")
    placed = records.withColumn("at", F.row_number().over(within) - 1).join(F.broadcast(starts), "virtual_slot")
    return placed.select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard",
        (F.col("start") + F.col("at")).cast("bigint").alias("slot"), "virtual_slot",
    )


def with_shard(docs: DataFrame, slot_map: SlotMap, version: int = 1, id_col: str = "doc_id", text_col: str = "text",
               shard_col: str = "shard") -> DataFrame:
    """``docs`` with the shard that a version of the map gives each row; all columns kept.

    A column of ``docs`` with the name of the new one gets no clash: the new one has
    underscores in front. NULL texts count as empty. Repeated rows go to one shard, as
    nothing but id and text decides; ``shard_rows`` spreads them. An empty table gives an
    empty result.
    """
    name = unused_name(shard_col, docs.columns)
    slot = unused_name("_virtual_slot", [*docs.columns, name])
    # The map has a row for each of the fixed number of slots.
    of = F.broadcast(slot_map.read(version).select(F.col("virtual_slot").alias(slot), F.col("shard").alias(name)))
    rows = docs.withColumn(slot, virtual_slot(F.col(id_col), text_of(text_col), slot_map.slots))
    return rows.join(of, slot).select(*columns(docs), name)


def write_shards(docs: DataFrame, slot_map: SlotMap, path: str, version: int = 1, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """A folder for each shard below ``path``. Tasks write what they read: no shuffle of texts.

    Rows go where ``with_shard`` puts them, NULL and repeated ones too. An empty table writes
    no folder of a shard.
    """
    rows = with_shard(docs, slot_map, version, id_col, text_col)
    rows.write.partitionBy(rows.columns[-1]).parquet(path)
