"""Sharding through fixed virtual slots.

Records are hashed into a fixed number of slots. Bytes and rows are summed per slot, and a versioned map says which
shard holds each slot. Rebalancing edits the map: only the slots whose entry changes are moved.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.spread import heavy_keys
from ..session import fresh_path, settle

SLOTS = 4096
#: Equal rows of more than this part of the table are spread over slots.
HOT = 256


def slot_of(*record: Column, slots: int = SLOTS) -> Column:
    """Slot of a record."""
    return F.pmod(F.xxhash64(*record), F.lit(slots)).cast("int")


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """``(bytes, rows)`` of each slot, from a frame with ``virtual_slot`` and ``size``: one row per slot reaches the driver."""
    found = {r[0]: (r[1], r[2]) for r in rows.groupBy("virtual_slot").agg(F.sum("size"), F.count("*")).collect()}
    return [found.get(i, (0, 0)) for i in range(slots)]


def first_map(slots: int, shards: int) -> list[int]:
    """Version 1 of a map: slots dealt in turn."""
    return [i % shards for i in range(slots)]


def rebalanced(owner: list[int], sizes: list[int], shards: int) -> list[int]:
    """The map after edits: slots move, largest fitting first, from the fullest shard to the emptiest until no move helps.

    ``shards`` may exceed the number of shards in ``owner``: new shards then fill up, and untouched slots stay.
    """
    owner, load, held = list(owner), [0] * shards, [[] for _ in range(shards)]
    for slot, shard in enumerate(owner):
        load[shard] += sizes[slot]
        if sizes[slot]:
            held[shard].append(slot)
    while True:
        full, free = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[free]
        # A slot smaller than the gap lowers the sum of squares, so the loop ends; half the gap levels best.
        fitting = [s for s in held[full] if sizes[s] < gap]
        if not fitting:
            return owner
        slot = min(fitting, key=lambda s: (abs(2 * sizes[s] - gap), s))
        owner[slot] = free
        held[full].remove(slot)
        held[free].append(slot)
        load[full] -= sizes[slot]
        load[free] += sizes[slot]


def store_map(spark: SparkSession, versions: dict[int, list[int]], sizes: list[tuple[int, int]], path: str | None = None) -> str:
    """Write all versions of a map as a table ``(version, virtual_slot, shard, bytes, rows, first_row)`` and return its path.

    ``first_row`` is the number of rows in the lower slots of the same shard.
    """
    path = path or fresh_path(spark, "slot-map")
    listed = []
    for version, owner in sorted(versions.items()):
        before: dict[int, int] = {}
        for slot, shard in enumerate(owner):
            listed.append([version, slot, shard, sizes[slot][0], sizes[slot][1], before.get(shard, 0)])
            before[shard] = before.get(shard, 0) + sizes[slot][1]
    kind = "array<array<bigint>>"
    lines = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(listed)), kind)).alias("x"))
    names = ("version", "virtual_slot", "shard", "bytes", "rows", "first_row")
    types = ("int", "int", "int", "bigint", "bigint", "bigint")
    lines.select(*[F.col("x")[i].cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))]).write.mode("overwrite").parquet(path)
    return path


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the newest by default."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version)


def shard_by_bytes(docs: DataFrame, shards: int = 8, slots: int = SLOTS, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its shard, its place in the shard and the version of the map that put it there.

    The law is ``bytes``: sizes (UTF-8 bytes of the text plus 1) are near equal over the shards, as near as whole slots
    allow. ``slot`` counts a shard's rows from 0 without gaps, in the order of virtual slot, key and text checksum.

    A record's slot follows from key, checksum and size, so the rows of one key, or without any, spread. Equal rows share a slot
    unless they are more than a ``HOT``-th of the table; those spread by their number in the written table of sizes.

    A null text has no bytes (size 1, checksum 0). Repeated rows each get a place of their own. An empty table gives an empty
    result. Other columns are not read.
    """
    spark = docs.sparkSession
    record = ["doc_id", "text_crc32", "size"]
    rows = settle(docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"),
    ), "sizes")
    hot = [key for key, _ in heavy_keys(rows, record, HOT)]
    number = F.when(F.xxhash64(*record).isin(hot), F.col("row")).otherwise(F.lit(0)) if hot else F.lit(0)
    rows = rows.withColumn("virtual_slot", slot_of(*map(F.col, record), number, slots=slots))
    sizes = slot_sizes(rows, slots)
    first = first_map(slots, shards)
    path = store_map(spark, {1: first, 2: rebalanced(first, [b for b, _ in sizes], shards)}, sizes)
    placed = read_map(spark, path, 2).select("virtual_slot", "version", "shard", "first_row")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("nth", F.row_number().over(within))
        .join(placed, "virtual_slot")
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("first_row") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot", F.col("version").alias("map_version"),
        )
    )
