"""Shards by fixed virtual slots and a versioned slot-to-shard map.

A record's hash puts it into one of ``SLOTS`` virtual slots for good.  Bytes and rows are
summed per slot; only that table, whose size is fixed, meets the driver.  A slot map says
which shard holds a slot.  Rebalancing edits the map: it moves slots, never single rows,
and stores the result as a new version beside the old ones.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from arrears.llm.common import numbered, written

SLOTS = 8192
OVERHEAD = 8


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, vslot)``; a null text has no bytes.

    The slot comes from doc_id, the text's hashes and, for rows alike in these, their number,
    so that neither rows without an id nor one repeated id, text or row fill a single slot.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id", text).alias("h"),
    )
    unit = F.when(F.col("n") == 0, F.col("h")).otherwise(F.xxhash64("h", "n"))
    slot = F.pmod(unit, F.lit(slots)).cast("int").alias("vslot")
    return numbered(rows, "n").select("doc_id", "size", "text_crc32", slot)


def slot_sizes(rows: DataFrame) -> DataFrame:
    """``(vslot, bytes, rows)``: at most one row per virtual slot, summed before the shuffle."""
    return rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    return {v: v % shards for v in range(slots)}


def rebalanced(slot_map: dict[int, int], weights: dict[int, int], shards: int) -> dict[int, int]:
    """The map edited until no move of one slot or swap of two evens the fullest or the emptiest shard.

    Slots leave the fullest shard for the emptiest one; the slot nearest to half of the gap
    moves first, ties by slot number.  With more ``shards`` than the map has, the new ones
    begin empty.  The result depends on map and weights only.
    """
    new = dict(slot_map)
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    for v in sorted(new):
        held[new[v]][v] = weights.get(v, 0)
    total = [sum(h.values()) for h in held]
    for _ in range(4 * len(new)):
        full = max(range(shards), key=lambda s: (total[s], -s))
        low = min(range(shards), key=lambda s: (total[s], s))
        gap = total[full] - total[low]
        move = min(((abs(gap - 2 * w), v) for v, w in held[full].items() if 0 < w < gap), default=None)
        swap = None
        if move is None or move[0] > gap // 8:
            theirs = sorted((w, v) for v, w in held[low].items())
            mine = sorted((w, v) for v, w in held[full].items())
            swap = _best_swap(mine, theirs, gap)
        if move is None and swap is None:
            break
        if swap is not None and (move is None or swap[0] < move[0]):
            moves = [(swap[1], full, low), (swap[2], low, full)]
        else:
            moves = [(move[1], full, low)]
        for v, here, there in moves:
            w = held[here].pop(v)
            held[there][v] = w
            new[v] = there
            total[here] -= w
            total[there] += w
    return new


def _best_swap(mine: list[tuple[int, int]], theirs: list[tuple[int, int]], gap: int) -> tuple[int, int, int] | None:
    """The two slots whose exchange leaves the smallest gap, both lists sorted by weight."""
    best = None
    j = 0
    for w, v in mine:
        while j + 1 < len(theirs) and w - theirs[j + 1][0] >= gap / 2:
            j += 1
        for k in (j, j + 1):
            if k < len(theirs) and 0 < w - theirs[k][0] < gap:
                left = abs(gap - 2 * (w - theirs[k][0]))
                if best is None or (left, v, theirs[k][1]) < best:
                    best = (left, v, theirs[k][1])
    return best


def grown(slot_map: dict[int, int], weights: dict[int, int], shards: int) -> dict[int, int]:
    """The map for one more shard: slots only move into the new one, from the fullest shards first."""
    new = dict(slot_map)
    heaps: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for v in sorted(new):
        heapq.heappush(heaps[new[v]], (weights.get(v, 0), v))
    total = [sum(w for w, _ in h) for h in heaps]
    share, got = sum(total) / (shards + 1), 0
    while got < share:
        full = max(range(shards), key=lambda s: (total[s], -s))
        if not heaps[full] or total[full] <= share:
            break
        w, v = heapq.heappop(heaps[full])
        total[full] -= w
        got += w
        new[v] = shards
    return new


def store_map(spark: SparkSession, slot_map: dict[int, int], version: int, path: str) -> None:
    """Write a map as one more version under ``path``; older versions stay readable."""
    rows = [(v, s) for v, s in sorted(slot_map.items())]
    spark.createDataFrame(rows, "vslot int, shard int").coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``(vslot, shard, version)`` of a stored map, the latest version by default."""
    every = spark.read.parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.filter(F.col("version") == version)


def sharded(docs: DataFrame, shards: int, map_path: str, slots: int = SLOTS) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with its shard, its place there and the map's version.

    Law ``bytes``: the first map deals the slots out in turn, the second evens the bytes.
    ``slot`` counts the rows of a shard from 0 without gaps: slots in order, within a slot by
    doc_id (null first), size, checksum.  Rows equal in all three are interchangeable.
    Null texts count as empty; an empty table gives an empty result.  One virtual slot holds
    about 1/8192 of the rows; its rows are numbered in one task, a shard never is.
    """
    spark = docs.sparkSession
    rows = written(sized(docs, slots), "sized-rows")
    weights = slot_sizes(rows).collect()  # at most one row per virtual slot
    size = {r["vslot"]: r["bytes"] for r in weights}
    count = {r["vslot"]: r["rows"] for r in weights}
    dealt = first_map(shards, slots)
    store_map(spark, dealt, 1, map_path)
    current = rebalanced(dealt, size, shards)
    store_map(spark, current, 2, map_path)
    start, offsets = [0] * shards, []
    for v in range(slots):
        offsets.append((v, start[current[v]]))
        start[current[v]] += count.get(v, 0)
    places = load_map(spark, map_path).join(
        F.broadcast(spark.createDataFrame(offsets, "vslot int, start long")), "vslot"
    )
    order = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32")
    return (
        rows.withColumn("n", F.row_number().over(order))
        .join(F.broadcast(places), "vslot")  # one row per virtual slot
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("n") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), "vslot", F.col("version").alias("map_version"),
        )
    )
