"""Shards by fixed virtual slots.

A record's hash names one of a fixed number of virtual slots. Equal records are counted and
numbered, and the number is part of the hash, so that a group of copies is spread like other
records. Bytes and rows are summed per slot, and a map from slot to shard spreads the slots so that shards hold nearly the same
bytes. The map is stored by version; rebalancing edits single entries of it, and only the
records of those slots move.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from swipeline.session import cut_lineage

VIRTUAL_SLOTS = 8192
#: Bytes of a record beside its text.
OVERHEAD = 16
MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes bigint, n_rows bigint"


#: Copies of one record that one row stands for while they are numbered.
PIECE = 4096


def records(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", slots: int = VIRTUAL_SLOTS
) -> DataFrame:
    """(id, size, text_crc32, virtual_slot) of every row; a null text has no bytes.

    Rows with one id, size and checksum cannot be told apart here. They are counted, combined
    before the shuffle, and come out again numbered from 0 - in pieces, which are dealt over the
    tasks, so no task writes a large group alone.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    key = ["id", "size", "text_crc32"]
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    once = groups.where("n <= 1").select(*key, F.lit(0).cast("bigint").alias("k"))
    pieces = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {PIECE}"))
    many = groups.where("n > 1").select(*key, "n", F.explode(pieces).alias("p")).hint("rebalance")
    numbers = F.sequence(F.col("p") * PIECE, F.least(F.col("n"), (F.col("p") + 1) * PIECE) - 1)
    many = many.select(*key, F.explode(numbers).alias("k"))
    slot = F.pmod(F.xxhash64(*key, "k"), F.lit(slots)).cast("int").alias("virtual_slot")
    return once.unionByName(many).select(*key, slot)


def slot_sizes(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(virtual slot, bytes, rows) for each slot in use: at most as many as there are slots."""
    sums = rows.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1)))
    return sorted(tuple(r) for r in sums.collect())


def assign(sizes: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """Slot to shard: each slot, the largest first, to the shard with the fewest bytes."""
    load = [(0, shard) for shard in range(shards)]
    out = {}
    for slot, size, _ in sorted(sizes, key=lambda s: (-s[1], s[0])):
        held, shard = heapq.heappop(load)
        out[slot] = shard
        heapq.heappush(load, (held + size, shard))
    return out


def rebalance(
    current: dict[int, int], sizes: list[tuple[int, int, int]], shards: int, slack: float = 0.01
) -> dict[int, int]:
    """Edit a map for new slot sizes or another number of shards, moving as little as needed.

    Slots of shards that no longer exist move, then, while a shard is off the mean by more than
    the slack, slots of the fullest shard that can give go to the emptiest one, each as long as
    that lowers the larger of the two.
    """
    bytes_of = {slot: size for slot, size, _ in sizes}
    held: dict[int, set[int]] = defaultdict(set)
    homeless = []
    for slot in bytes_of:
        shard = current.get(slot, -1)
        if 0 <= shard < shards:
            held[shard].add(slot)
        else:
            homeless.append(slot)
    load = {shard: sum(bytes_of[s] for s in held[shard]) for shard in range(shards)}
    for slot in sorted(homeless, key=lambda s: (-bytes_of[s], s)):
        shard = min(load, key=lambda s: (load[s], s))
        held[shard].add(slot)
        load[shard] += bytes_of[slot]
    target = sum(load.values()) / shards
    while True:
        empty = min(load, key=lambda s: (load[s], s))
        # a full shard may hold a single slot, larger than the mean, and have nothing to give
        for full in sorted(load, key=lambda s: (-load[s], s)):
            room = load[full] - load[empty]
            fitting = [s for s in held[full] if 0 < bytes_of[s] < room]
            if fitting:
                break
        close = load[full] <= target * (1 + slack) and load[empty] >= target * (1 - slack)
        if close or not fitting:
            break
        slot = min(fitting, key=lambda s: (abs(bytes_of[s] - room / 2), s))
        held[full].remove(slot)
        held[empty].add(slot)
        load[full] -= bytes_of[slot]
        load[empty] += bytes_of[slot]
    return {slot: shard for shard, slots in held.items() for slot in slots}


def store_map(
    spark: SparkSession, path: str, version: int, slot_map: dict[int, int], sizes: list[tuple[int, int, int]]
) -> None:
    """Add a version of the map to the table at path; a version is a partition of it."""
    rows = [(version, slot, slot_map[slot], size, n) for slot, size, n in sizes]
    frame = spark.createDataFrame(rows, MAP_SCHEMA).drop("version").coalesce(1)
    frame.write.mode("overwrite").parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the stored map, the newest unless named."""
    versions = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == F.lit(version))


def grow(spark: SparkSession, path: str, shards: int) -> DataFrame:
    """Edit the newest version of the map at path for a number of shards and store it as the next
    one, which is returned. Records are not read: the map holds the bytes of its slots."""
    rows = read_map(spark, path).collect()  # one per slot
    sizes = sorted((r["virtual_slot"], r["bytes"], r["n_rows"]) for r in rows)
    version = max((r["version"] for r in rows), default=-1) + 1
    store_map(spark, path, version, rebalance({r["virtual_slot"]: r["shard"] for r in rows}, sizes, shards), sizes)
    return read_map(spark, path, version)


def place(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with shard and slot, their place in the shard, from 0 without gaps.

    Places are counted per virtual slot, behind the rows of the shard's earlier slots, so a
    shard is never ordered in one task. The map has one row per virtual slot: broadcast.
    """
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select(
        "virtual_slot", "shard", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).alias("start")
    )
    order = Window.partitionBy("virtual_slot").orderBy("id", "text_crc32", "size")
    return (
        rows.withColumn("n", F.row_number().over(order))
        .join(F.broadcast(starts), "virtual_slot")
        .select(
            "id", "size", "text_crc32", "virtual_slot", "shard",
            (F.col("start") + F.col("n") - 1).cast("bigint").alias("slot"),
        )
    )


def shard_documents(
    docs: DataFrame, path: str, shards: int, id_column: str = "doc_id", text_column: str = "text",
    slots: int = VIRTUAL_SLOTS,
) -> DataFrame:
    """Put every row of docs into one of `shards` shards of nearly equal bytes.

    Stores version 0 of the map below path. Null ids and texts, ties and repeated rows are
    records like any other, and a group of equal ones is spread over the slots; a very long text is
    one record, so shards differ by it at most; an empty table gives no rows; other columns,
    whatever their names, are not read.
    """
    spark = docs.sparkSession
    rows = cut_lineage(records(docs, id_column, text_column, slots))
    sizes = slot_sizes(rows)
    store_map(spark, path, 0, assign(sizes, shards), sizes)
    return place(rows, read_map(spark, path, 0))
