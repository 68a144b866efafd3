"""Sharding by fixed virtual slots.

Records hash into a fixed number of virtual slots (thousands, whatever the number of shards).  Bytes and rows
are summed per slot, and a versioned slot-to-shard map says where each slot lives: version 0 deals the slots out
evenly, a rebalancing edits the map, moving slots from heavy to light shards, and becomes the next version.
Adding shards is the same edit with more shards.  Only the map (``n_slots`` rows, a parameter) passes through the
driver; the records are placed with a broadcast of the map.

Edge cases: a null text counts 8 bytes; null ids and texts hash like any value; repeated rows are placed one by
one; an empty table gives an empty result and an even map; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plenaria.llm.common import free_name, table, written

N_SLOTS = 8192
N_SHARDS = 24

MAP_SCHEMA = "version int, slot int, shard int, bytes long, n_rows long"


def records(docs: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot and an order key for every row.  The slot hashes id and text together,
    so neither a null id nor one common text gathers in a slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.pmod(key, F.lit(n_slots)).cast("int").alias("virtual_slot"),
        key.alias("order_key"))


def even_map(n_slots: int, n_shards: int) -> list[int]:
    return [slot % n_shards for slot in range(n_slots)]


def rebalanced(shard_of: list[int], slot_bytes: list[int], n_shards: int) -> list[int]:
    """The edited map: while it narrows the gap, the slot nearest to half the gap moves from the heaviest to the
    lightest shard; a shard that no move helps is left as it is.  Slots that need not move stay where they are."""
    shard_of = list(shard_of)
    load = [0] * n_shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(shard_of):
        load[shard] += slot_bytes[slot]
        if slot_bytes[slot]:
            insort(held[shard], (slot_bytes[slot], slot))
    heavy = [(-load[s], s) for s in range(n_shards)]
    light = [(load[s], s) for s in range(n_shards)]
    heapq.heapify(heavy)
    heapq.heapify(light)

    def top(heap: list, sign: int) -> int:
        while heap and sign * heap[0][0] != load[heap[0][1]]:
            heapq.heappop(heap)
        return heap[0][1] if heap else -1

    while (high := top(heavy, -1)) >= 0:
        low = top(light, 1)
        gap = load[high] - load[low]
        at = bisect_left(held[high], (gap / 2, -1))
        near = [x for x in held[high][max(0, at - 1):at + 1] if x[0] < gap]
        if not near:
            heapq.heappop(heavy)
            continue
        moved = min(near, key=lambda x: abs(x[0] - gap / 2))
        held[high].remove(moved)
        insort(held[low], moved)
        shard_of[moved[1]] = low
        load[high] -= moved[0]
        load[low] += moved[0]
        for s in (high, low):
            heapq.heappush(heavy, (-load[s], s))
            heapq.heappush(light, (load[s], s))
    return shard_of


def build_map(spark: SparkSession, sums: DataFrame, n_slots: int, n_shards: int,
              previous: list[int] | None = None, version: int = 1) -> DataFrame:
    """The next version of the map from the slots' sums (virtual_slot, bytes, n_rows), written to the shared folder
    with the version it was edited from.  ``sums`` has at most ``n_slots`` rows."""
    found = {r["virtual_slot"]: (r["bytes"], r["n_rows"]) for r in sums.collect()}
    size = [found.get(s, (0, 0))[0] for s in range(n_slots)]
    before = previous or even_map(n_slots, n_shards)
    after = rebalanced(before, size, n_shards)
    rows = [(v, s, shard_of[s], *found.get(s, (0, 0)))
            for v, shard_of in ((version - 1, before), (version, after)) for s in range(n_slots)]
    return written(spark.createDataFrame(rows, MAP_SCHEMA), "slot-map")


def shard(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard, gapless from 0), grown_shard, virtual_slot,
    map_version.  Places are ranks inside a virtual slot plus the rows of the shard's earlier slots."""
    spark = docs.sparkSession
    rows = written(records(docs, n_slots, id_col, text_col), "records")
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))
    slots = build_map(spark, sums, n_slots, n_shards)
    last = slots.where(F.col("version") == 1)
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    places = last.select(F.col("slot").alias("virtual_slot"), "shard", F.col("version").alias("map_version"),
                         F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first_place"))
    rank = Window.partitionBy("virtual_slot").orderBy("order_key", "doc_id", "text_crc32")
    return (rows.withColumn("rank", F.row_number().over(rank) - 1)
            .join(F.broadcast(places), "virtual_slot")   # n_slots rows, a parameter
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first_place") + F.col("rank")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version"))


def assigned(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS,
             id_col: str = "doc_id", text_col: str = "text", shard_col: str = "shard") -> DataFrame:
    """The rows as they are, with their shard after all other columns; only the map is joined."""
    sums = (records(docs, n_slots, id_col, text_col).groupBy("virtual_slot")
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows")))
    m_slot, m_shard = free_name(docs, "map_slot"), free_name(docs, "map_shard")
    last = (build_map(docs.sparkSession, sums, n_slots, n_shards).where(F.col("version") == 1)
            .select(F.col("slot").alias(m_slot), F.col("shard").alias(m_shard)))
    slot = F.pmod(F.xxhash64(docs[id_col], docs[text_col]), F.lit(n_slots)).cast("int")
    return (docs.join(F.broadcast(last), slot == F.col(m_slot))     # n_slots rows, a parameter
            .select(*(docs[c] for c in docs.columns), F.col(m_shard).alias(shard_col)))


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
