"""Sharding over fixed virtual slots, with a versioned slot-to-shard map.

Records are hashed into a fixed number of virtual slots (thousands). The map says which shard each
slot belongs to; it is a small table with a version. Bytes are aggregated per slot, and rebalancing
edits the map: it moves whole slots from heavy to light shards until sizes are near equal. Records
never move for any other reason, and old versions of the map stay readable.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quotegrid.session import stage, working_path

SLOTS = 8192
MAP_SCHEMA = "version int, slot int, shard int"
#: Rows of one virtual slot are numbered in so many strands, so that a hot key is not one task's.
STRANDS = 16


def edited(shard_of: np.ndarray, weight: np.ndarray, shards: int, tolerance: float = 0.001) -> np.ndarray:
    """The map after rebalancing: slots moved, or exchanged, from the heaviest to the lightest shard.

    Works on one number per slot (thousands, fixed). Stops when the spread is below ``tolerance`` of
    the mean or no single move or exchange narrows it. Slots on a shard that does not exist are dealt
    to the lightest shards first, so a smaller number of shards works too.
    """
    out = shard_of.copy()
    load = np.zeros(shards, dtype=np.int64)
    np.add.at(load, out[out < shards], weight[out < shards])
    lost = np.flatnonzero(out >= shards)
    for slot in lost[np.argsort(-weight[lost], kind="stable")]:
        out[slot] = int(load.argmin())
        load[out[slot]] += weight[slot]
    for _ in range(20 * len(out)):
        low = int(load.argmin())
        order = np.argsort(-load, kind="stable")
        moved = False
        for high in order[:4]:
            gap = int(load[high] - load[low])
            if gap <= max(1, tolerance * load.mean()):
                break
            mine, theirs = np.flatnonzero(out == high), np.flatnonzero(out == low)
            gain = weight[mine]
            use = (gain > 0) & (gain < gap)
            if use.any():
                slot = mine[use][np.abs(gain[use] - gap / 2).argmin()]
                best, swap = (abs(weight[slot] - gap / 2), None)
            else:
                slot, best, swap = None, gap / 2, None
            if best > gap / 8 and len(mine) and len(theirs):
                diff = gain[:, None] - weight[theirs][None, :]
                cost = np.where((diff > 0) & (diff < gap), np.abs(diff - gap / 2), np.inf)
                at = np.unravel_index(cost.argmin(), cost.shape)
                if cost[at] < best:
                    slot, swap = mine[at[0]], theirs[at[1]]
            if slot is None:
                continue
            out[slot] = low
            shift = weight[slot]
            if swap is not None:
                out[swap] = high
                shift = shift - weight[swap]
            load[high] -= shift
            load[low] += shift
            moved = True
            break
        if not moved:
            break
    return out


class SlotMap:
    """The versioned map, kept as Parquet below ``path``: one folder per version, none overwritten."""

    def __init__(self, spark: SparkSession, path: str, slots: int = SLOTS):
        self.spark, self.path, self.slots = spark, path, slots

    def _write(self, version: int, shard_of: np.ndarray) -> int:
        rows = [(version, int(i), int(s)) for i, s in enumerate(shard_of)]
        self.spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{self.path}/v{version:06d}")
        return version

    def create(self, shards: int) -> int:
        return self._write(0, np.arange(self.slots) % shards)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.path}/v{version:06d}")

    def rebalance(self, version: int, slot_bytes: DataFrame, shards: int) -> int:
        """Write the next version: ``version`` edited for the bytes (slot, bytes) of the records."""
        shard_of = np.zeros(self.slots, dtype=np.int64)
        for r in self.read(version).collect():
            shard_of[r["slot"]] = r["shard"]
        weight = np.zeros(self.slots, dtype=np.int64)
        for r in slot_bytes.collect():
            weight[r["slot"]] = r["bytes"]
        return self._write(version + 1, edited(shard_of, weight, shards))


def slotted(docs: DataFrame, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, virtual_slot, strand): one narrow row per record, by record hash.

    The hash takes key and text, so rows without a key, or with one key and different texts, spread.
    A NULL text counts no bytes (size 16) and has the checksum of the empty text.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
    ).select(
        "doc_id", "size", "text_crc32",
        F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slots)).cast("int").alias("virtual_slot"),
        (F.spark_partition_id() % STRANDS).alias("strand"),
    )


def shard(docs: DataFrame, shards: int = 40, slots: int = SLOTS, path: str | None = None,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every record into a shard; sizes are near equal (law ``bytes``).

    Returns doc_id, size, text_crc32, law, shard, slot (place in its shard, without gaps from 0),
    grown_shard (NULL under this law), virtual_slot and map_version. Places are the offset of the
    virtual slot in its shard plus the rank in it, so no shard is ever numbered by one task. Repeated rows are
    all placed; an empty table gives an empty result; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    rows = stage(slotted(docs, slots, key, text), "slotted")
    filled = stage(rows.groupBy("virtual_slot", "strand").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "slot-bytes")
    table = SlotMap(spark, path or working_path(spark, "slot-map"), slots)
    version = table.rebalance(
        table.create(shards), filled.groupBy(F.col("virtual_slot").alias("slot")).agg(F.sum("bytes").alias("bytes")), shards)
    # one row per (virtual slot, strand): at most slots x strands rows, whatever the input
    home = table.read(version).select(F.col("slot").alias("virtual_slot"), "shard", F.col("version").alias("map_version"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "strand").rowsBetween(Window.unboundedPreceding, -1)
    starts = filled.join(home, "virtual_slot").select(
        "virtual_slot", "strand", "shard", "map_version", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = Window.partitionBy("virtual_slot", "strand").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("place", F.row_number().over(place) - 1).join(starts, ["virtual_slot", "strand"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
