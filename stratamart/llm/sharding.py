"""Sharding by fixed virtual slots and a versioned slot-to-shard map. DataFrame functions only.

Each record hashes into one of ``n_slots`` slots that never change; of the n rows alike in id and text, number k lies k
slots on, so that a row repeated any number of times fills all slots evenly, whatever their order. Bytes and rows are
summed per slot (``n_slots`` rows at most). The map from slots to shards is edited, by moving and swapping slots, until
shards are near equal in bytes. Every version is stored; a map that is there already is loaded, edited and stored as
the next version. A record's place in its shard is the rows of the shard's earlier slots plus its row number within
its slot, so that no task holds a shard.

* null text: size 1, crc 0. Null id: the record hashes by its text alone.
* repeated rows: each is a record of its own. Empty table: an empty result.
* ties (rows equal in id and text) take their numbers and places in any order.
* extra columns are ignored; only the id and text columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.copies import numbered_copies
from stratamart.llm.storage import documents, fresh_path, stored

N_SLOTS = 4096


def records(docs: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot; stored."""
    key, text = F.col(id_col), F.col(text_col)
    rows = docs.select(
        key.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(key, text).alias("hash"),
    )
    rows = numbered_copies(stored(rows, "records"), ["hash"])
    slot = F.pmod(F.pmod("hash", F.lit(n_slots)) + F.col("copy"), F.lit(n_slots)).cast("int")
    return stored(rows.select("doc_id", "size", "text_crc32", slot.alias("virtual_slot")), "slots")


def slot_weights(recs: DataFrame, n_slots: int = N_SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows per slot: at most ``n_slots`` rows reach the driver."""
    sizes, counts = [0] * n_slots, [0] * n_slots
    for slot, size, count in recs.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1))).collect():
        sizes[slot], counts[slot] = size, count
    return sizes, counts


def first_map(n_slots: int, n_shards: int) -> list[int]:
    return [slot % n_shards for slot in range(n_slots)]


def rebalanced(slot_map: list[int], sizes: list[int], n_shards: int) -> list[int]:
    """The map after moves from the heaviest to the lightest shard.

    A move takes one slot over, or swaps a larger one for a smaller, whichever comes nearest to half the gap, and only
    if the gap shrinks, so the sum of squared loads falls and the moves end. ``n_shards`` may exceed the shards in
    use: new ones are filled.
    """
    out, loads = list(slot_map), [0] * n_shards
    own: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(out):
        loads[shard] += sizes[slot]
        if sizes[slot]:
            own[shard].append((sizes[slot], slot))
    for slots in own:
        slots.sort()

    def hand_over(entry: tuple[int, int], giver: int, taker: int) -> None:
        own[giver].remove(entry)
        insort(own[taker], entry)
        loads[giver] -= entry[0]
        loads[taker] += entry[0]
        out[entry[1]] = taker

    while True:
        heavy = max(range(n_shards), key=lambda s: (loads[s], -s))
        light = min(range(n_shards), key=lambda s: (loads[s], s))
        gap = loads[heavy] - loads[light]
        best = None
        for given in own[heavy]:
            at = bisect_left(own[light], (given[0] - gap / 2, -1))
            for back in (None, *own[light][max(at - 1, 0) : at + 1]):
                moved = given[0] - (back[0] if back else 0)
                if 0 < moved < gap and (best is None or abs(moved - gap / 2) < best[0]):
                    best = (abs(moved - gap / 2), given, back)
        if best is None:
            return out
        hand_over(best[1], heavy, light)
        if best[2]:
            hand_over(best[2], light, heavy)


def _lookup(values: list[int], slot: Column, kind: str) -> Column:
    """values[slot], as a constant of the plan."""
    return F.element_at(F.split(F.lit(",".join(map(str, values))), ","), slot + 1).cast(kind)


def store_map(spark: SparkSession, path: str, version: int, slot_map: list[int]) -> None:
    rows = spark.range(len(slot_map)).select(F.col("id").cast("int").alias("slot"))
    rows.withColumn("shard", _lookup(slot_map, F.col("slot"), "int")).coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[int]]:
    """A stored version, the newest if none is named."""
    rows = spark.read.parquet(path)
    version = version if version is not None else rows.agg(F.max("version")).first()[0]
    return version, [r.shard for r in rows.where(F.col("version") == version).orderBy("slot").collect()]


def placed(recs: DataFrame, slot_map: list[int], counts: list[int]) -> DataFrame:
    """Adds shard, and slot: the record's place in its shard, gapless from 0."""
    before, filled = [], {}
    for shard, count in zip(slot_map, counts, strict=True):
        before.append(filled.get(shard, 0))
        filled[shard] = before[-1] + count
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return recs.withColumns(
        {
            "shard": _lookup(slot_map, F.col("virtual_slot"), "int"),
            "slot": _lookup(before, F.col("virtual_slot"), "long") + F.row_number().over(inside) - 1,
        }
    )


def edited_map(spark: SparkSession, path: str, sizes: list[int], n_shards: int) -> tuple[int, list[int]]:
    """The newest map at ``path`` rebalanced for these slots, stored as the next version if that moves any slot.

    Without a map there, round robin is version 0. A stored map has to have as many slots.
    """
    try:
        version, slot_map = load_map(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        version, slot_map = 0, first_map(len(sizes), n_shards)
        store_map(spark, path, version, slot_map)
    if len(slot_map) != len(sizes):
        raise ValueError(f"the map at {path} has {len(slot_map)} slots, not {len(sizes)}")
    if max(slot_map) >= n_shards:
        raise ValueError(f"the map at {path} uses shards beyond {n_shards - 1}")
    edited = rebalanced(slot_map, sizes, n_shards)
    if edited != slot_map:
        version += 1
        store_map(spark, path, version, edited)
    return version, edited


def shard(docs: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Every record with its shard and place under the newest map version, after it has been edited for these records."""
    recs = records(docs, n_slots)
    sizes, counts = slot_weights(recs, n_slots)
    version, slot_map = edited_map(docs.sparkSession, map_path or fresh_path(docs.sparkSession, "slot-map"), sizes, n_shards)
    return placed(recs, slot_map, counts).withColumn("map_version", F.lit(version))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 under the law ``bytes``."""
    return shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )
