"""Sharding through fixed virtual slots.

Every record is hashed into one of ``n_slots`` virtual slots (4,096 by
default). Bytes are summed per slot, and a slot-to-shard map, kept as a
versioned Parquet table, says which shard owns a slot. Rebalancing edits the
map: it moves single slots from the fullest to the emptiest shard and writes the
result as the next version, so records of unmoved slots stay where they are.

Main path: DataFrame functions only. The only rows that reach the driver are the
slot sums and the map, ``n_slots`` rows at any data size.

Defined results
    null text: empty (size 1, checksum 0); null doc_id: a key like any other;
    repeated rows: each copy is a record of its own, hashed with its copy number
    so that a row repeated very often is spread over all slots; ties: rows that
    agree in every column of the result are interchangeable; empty table: empty
    result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vehiscope.llm.common import run_folder

N_SLOTS = 4096
#: Rows of one slot that are numbered by one task; larger slots are split.
ROWS_PER_CELL = 100_000
#: Copies of one row made from one array.
COPY_CHUNK = 65_536


def records(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, copy, virtual_slot, spread`` per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    # two steps, so that no array grows with the number of copies of a row
    copies = (counted
              .withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1,
                                                        F.lit(COPY_CHUNK).cast("long"))))
              .withColumn("copy", F.explode(F.sequence(
                  F.col("first"), F.least(F.col("first") + COPY_CHUNK, F.col("n")) - 1))))
    key = [F.col(c) for c in ("doc_id", "size", "text_crc32", "copy")]
    return copies.select(
        *key, F.pmod(F.xxhash64(*key), F.lit(n_slots)).cast("int").alias("virtual_slot"),
        F.xxhash64(F.lit("spread"), *key).alias("spread"))


def slot_totals(recs: DataFrame) -> list[tuple[int, int, int]]:
    """(virtual_slot, bytes, rows) of the slots in use: at most n_slots rows."""
    return [(r[0], r[1], r[2]) for r in recs.groupBy("virtual_slot").agg(
        F.sum("size"), F.count("*")).orderBy("virtual_slot").collect()]


def first_map(n_shards: int, n_slots: int = N_SLOTS) -> list[int]:
    """Version 1: slots dealt in turn; ``result[slot]`` is the shard."""
    return [s % n_shards for s in range(n_slots)]


def rebalance(slot_map: list[int], slot_bytes: dict[int, int], n_shards: int) -> list[int]:
    """The map with single slots moved from the fullest to the emptiest shard,
    each time the one that evens the two best, until no move narrows the gap."""
    owner = list(slot_map)
    load = [0] * n_shards
    members: list[set[int]] = [set() for _ in range(n_shards)]
    for s, shard in enumerate(owner):
        load[shard] += slot_bytes.get(s, 0)
        members[shard].add(s)
    while True:
        high = max(range(n_shards), key=lambda i: (load[i], -i))
        low = min(range(n_shards), key=lambda i: (load[i], i))
        gap = load[high] - load[low]
        movable = [s for s in members[high] if 0 < slot_bytes.get(s, 0) < gap]
        if not movable:
            return owner
        best = min(movable, key=lambda s: (abs(gap - 2 * slot_bytes[s]), s))
        members[high].remove(best)
        members[low].add(best)
        owner[best] = low
        load[high] -= slot_bytes[best]
        load[low] += slot_bytes[best]


def grow(slot_map: list[int], slot_bytes: dict[int, int], n_shards: int) -> list[int]:
    """The map for one more shard: slots move into the new shard only, from the
    fullest one each time, until it holds its share."""
    owner = list(slot_map)
    load = [0] * n_shards
    members: list[list[int]] = [[] for _ in range(n_shards)]
    for s in sorted(range(len(owner)), key=lambda s: (slot_bytes.get(s, 0), s)):
        members[owner[s]].append(s)
        load[owner[s]] += slot_bytes.get(s, 0)
    share, held = sum(load) / (n_shards + 1), 0
    while held < share:
        high = max(range(n_shards), key=lambda i: (load[i], len(members[i]), -i))
        fits = [s for s in members[high] if held + slot_bytes.get(s, 0) <= share]
        if not fits:
            break
        s = fits[-1]
        members[high].remove(s)
        owner[s] = n_shards
        load[high] -= slot_bytes.get(s, 0)
        held += slot_bytes.get(s, 0)
    return owner


def write_map(spark: SparkSession, path: str, version: int, slot_map: list[int]) -> None:
    """Append one version (one file, so it is there as a whole or not at all)."""
    rows = [(version, s, shard) for s, shard in enumerate(slot_map)]
    (spark.createDataFrame(rows, "map_version int, virtual_slot int, shard int")
     .coalesce(1).write.mode("append").parquet(path))


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of one version, by default of the latest."""
    stored = spark.read.schema("map_version int, virtual_slot int, shard int").parquet(path)
    v = version if version is not None else stored.agg(F.max("map_version")).first()[0]
    return stored.where(F.col("map_version") == v)


def assign(recs: DataFrame, slot_map: DataFrame, total_rows: int,
           n_slots: int = N_SLOTS) -> DataFrame:
    """Add ``shard`` and ``slot``, the gapless position inside the shard.

    A slot is cut into cells of about ``ROWS_PER_CELL`` rows; rows are numbered
    per cell, and each cell starts where the cells before it in its shard end.
    The map has one row per virtual slot, so it is broadcast.
    """
    cells = max(1, math.ceil(total_rows / n_slots / ROWS_PER_CELL))
    placed = recs.join(F.broadcast(slot_map), "virtual_slot").withColumn(
        "cell", F.pmod("spread", F.lit(cells)))
    starts = placed.groupBy("shard", "virtual_slot", "cell").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "cell").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = starts.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    inside = Window.partitionBy("shard", "virtual_slot", "cell").orderBy(
        "doc_id", "size", "text_crc32", "copy")
    return (placed.withColumn("nth", F.row_number().over(inside) - 1)
            .join(starts, ["shard", "virtual_slot", "cell"])
            .withColumn("slot", (F.col("start") + F.col("nth")).cast("long")))


def shard(docs: DataFrame, n_shards: int = 8, n_slots: int = N_SLOTS,
          map_path: str | None = None) -> DataFrame:
    """Put every document into a shard; sizes of the shards are near equal.

    Without a stored map at ``map_path`` version 1 deals the slots in turn;
    the edited map is stored as the next version and used.
    """
    spark = docs.sparkSession
    recs = records(docs, n_slots)
    totals = slot_totals(recs)
    if map_path is None:
        map_path = run_folder(spark, "slot-map")
        write_map(spark, map_path, 1, first_map(n_shards, n_slots))
    old = read_map(spark, map_path).orderBy("virtual_slot").collect()
    version = old[0]["map_version"] + 1
    edited = rebalance([r["shard"] for r in old], {s: b for s, b, _ in totals}, n_shards)
    write_map(spark, map_path, version, edited)
    return assign(recs, read_map(spark, map_path, version), sum(n for _, _, n in totals), n_slots)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes, through 4,096 slots."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
