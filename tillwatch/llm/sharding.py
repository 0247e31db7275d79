"""Sharding by fixed virtual slots.

Every record hashes into one of `SLOTS` virtual slots and stays there for good. Bytes are summed per
slot, and a slot-to-shard map says where a slot lives. The map starts even (slot mod shards) and is
edited when it is rebalanced: slots move from the heaviest shard to the lightest until shards weigh
nearly the same. Every edit is a new version, kept as rows (version, slot, shard) in a folder of its own,
so an older placement can still be read, and a later run opens the map and goes on from its last version. The sums and the map have one row per slot, a fixed
number, and only they reach the driver.

Nulls: a null doc_id hashes like a value; a null text has no bytes. Repeated rows are numbered, so that
they spread over slots. A single record above a shard's fair share makes a shard that heavy. An empty
table gives an empty result and an even map. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import numbered_copies, text_of
from tillwatch.sources.store import Store, file_system

SLOTS = 8_192
SHARDS = 24
OVERHEAD = 8
#: Rebalancing ends when the heaviest shard is within this part of the mean.
TOLERANCE = 0.001
MAP = "version int, slot int, shard int"


class SlotMap:
    """A versioned map from slots to shards, stored as Parquet, one file set per version.

    A path that has a map already is opened at its last version, and edits continue from there. Each version
    is whole or not there; one that a lost writer has left unfinished is not read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.version = spark, path.rstrip("/"), -1
        self.shard: list[int] = []
        system, folder = file_system(spark, self.path)
        if system.exists(folder):
            names = [status.getPath().getName() for status in system.listStatus(folder)]
            for version in sorted((int(n) for n in names if n.isdigit()), reverse=True):
                if system.exists(file_system(spark, f"{self._of(version)}/_SUCCESS")[1]):
                    self.version = version
                    self.shard = [r.shard for r in self.read().orderBy("slot").collect()]  # a row for each slot
                    break

    def _of(self, version: int) -> str:
        return f"{self.path}/{version:06d}"

    def publish(self, shard: list[int]) -> None:
        if self.shard and len(shard) != len(self.shard):
            raise ValueError(f"the map has {len(self.shard)} slots, not {len(shard)}")
        version = self.version + 1
        rows = [(version, slot, to) for slot, to in enumerate(shard)]
        self.spark.createDataFrame(rows, MAP).coalesce(1).write.mode("overwrite").parquet(self._of(version))
        self.version, self.shard = version, list(shard)

    def read(self, version: int | None = None) -> DataFrame:
        wanted = self.version if version is None else version
        return self.spark.read.schema(MAP).parquet(self._of(wanted)).select("slot", "shard")


def rebalanced(shard: list[int], load: list[int], shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """The map after moving slots from heavy shards to light ones; slots of light shards stay put.

    Each heavy shard gives up slots, largest first, as long as that keeps it at the mean or above, and
    the slots so freed fill the shards below it, largest slot to lightest shard. Then single moves and
    swaps of slots between the heaviest and the lightest shard go on while they narrow the gap.
    """
    out, total = list(shard), [0] * shards
    own: list[list[int]] = [[] for _ in range(shards)]
    for slot, to in enumerate(out):
        total[to] += load[slot]
        own[to].append(slot)
    mean = sum(total) / shards
    freed = []
    for s in range(shards):
        for slot in sorted(own[s], key=lambda x: (-load[x], x)):
            if load[slot] and total[s] - load[slot] >= mean:
                total[s] -= load[slot]
                freed.append(slot)
    light = [(total[s], s) for s in range(shards)]
    heapq.heapify(light)
    for slot in sorted(freed, key=lambda x: (-load[x], x)):
        weight, s = heapq.heappop(light)
        out[slot] = s
        heapq.heappush(light, (weight + load[slot], s))
    return _narrowed(out, load, shards, tolerance)


def _narrowed(out: list[int], load: list[int], shards: int, tolerance: float) -> list[int]:
    total = [0] * shards
    own: list[set[int]] = [set() for _ in range(shards)]
    for slot, to in enumerate(out):
        total[to] += load[slot]
        own[to].add(slot)
    mean = sum(total) / shards
    for _ in range(len(out)):
        high, low = max(range(shards), key=lambda s: (total[s], -s)), min(range(shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        if gap <= tolerance * mean:
            break
        # The best change of half the gap: a slot alone, or against one of the lightest shard's.
        given = sorted(own[high], key=lambda x: (load[x], x))
        back = sorted(own[low], key=lambda x: (load[x], x))
        best, j = None, 0
        for a in given:
            for b in (None, *back[max(0, j - 1) : j + 2]):
                change = load[a] - (load[b] if b is not None else 0)
                if 0 < change < gap and (best is None or abs(gap / 2 - change) < best[0]):
                    best = (abs(gap / 2 - change), a, b)
            while j < len(back) and load[back[j]] < load[a] - gap / 2:
                j += 1
        if best is None:
            break
        _, a, b = best
        change = load[a] - (load[b] if b is not None else 0)
        total[high], total[low] = total[high] - change, total[low] + change
        own[high].remove(a)
        own[low].add(a)
        out[a] = low
        if b is not None:
            own[low].remove(b)
            own[high].add(b)
            out[b] = high
    return out


def grown(shard: list[int], load: list[int], shards: int) -> list[int]:
    """The map with one more shard, which takes slots of every other one; nothing else moves."""
    out, total = list(shard), [0] * shards
    for slot, to in enumerate(shard):
        total[to] += load[slot]
    mean, new = sum(total) / (shards + 1), 0
    for slot in sorted(range(len(shard)), key=lambda x: (-load[x], x)):
        if load[slot] and total[shard[slot]] - load[slot] >= mean and new + load[slot] <= mean:
            total[shard[slot]] -= load[slot]
            new += load[slot]
            out[slot] = shards
    return out


def placed(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every record."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_of()) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    numbered = numbered_copies(counted, "n", "copy")
    return numbered.withColumn(
        "virtual_slot", F.pmod(F.xxhash64("doc_id", "copy", "text_crc32"), F.lit(slots)).cast("int")
    )


def shard(
    documents: DataFrame, shards: int = SHARDS, slots: int = SLOTS, slot_map: SlotMap | None = None
) -> tuple[DataFrame, SlotMap]:
    """doc_id, size, text_crc32, copy, virtual_slot, shard, and the place within the shard; and the map.

    Places have no gaps: a slot's rows follow those of the shard's slots before it. A map from an earlier run is
    edited further, so few slots move; without one, or with an empty one, it starts even.
    """
    spark = documents.sparkSession
    store = Store(spark)
    rows = store.keep(placed(documents, slots), "placed")
    sums = rows.groupBy("virtual_slot").agg(F.sum("size"), F.count("*")).collect()  # at most `slots` rows
    load, count = [0] * slots, [0] * slots
    for slot, size, n in sums:
        load[slot], count[slot] = size, n
    if slot_map is None:
        slot_map = SlotMap(spark, store.folder("slot_map"))
    if not slot_map.shard:
        slot_map.publish([s % shards for s in range(slots)])
    if len(slot_map.shard) != slots or max(slot_map.shard) >= shards:
        raise ValueError(f"the map has {len(slot_map.shard)} slots in {max(slot_map.shard) + 1} shards")
    slot_map.publish(rebalanced(slot_map.shard, load, shards))
    first, ahead = [0] * slots, [0] * shards
    for slot, to in enumerate(slot_map.shard):
        first[slot] = ahead[to]
        ahead[to] += count[slot]
    starts = spark.createDataFrame(list(enumerate(first)), "slot int, first long")
    where = F.broadcast(slot_map.read().join(starts, "slot").withColumnRenamed("slot", "virtual_slot"))
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "copy", "text_crc32", "size")
    return (
        rows.withColumn("in_slot", F.row_number().over(in_slot))
        .join(where, "virtual_slot")
        .withColumn("place", F.col("first") + F.col("in_slot") - 1)
        .select("doc_id", "size", "text_crc32", "copy", "virtual_slot", "shard", "place"),
        slot_map,
    )
