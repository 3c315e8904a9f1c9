"""A Bloom filter stored as a table of 64-bit words, so that it can be larger than any one machine."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import digest_mod, sha256_mod
from ..schemas import BLOOM_ERROR_RATE

WORD = 64


def bloom_size(capacity: int, error_rate: float) -> int:
    return max(1, int(-capacity * math.log(error_rate) / math.log(2) ** 2))


def bloom_hashes(size: int, capacity: int) -> int:
    return max(1, int(size / capacity * math.log(2)))


def bloom_positions(item: str | Column, capacity: int, error_rate: float = BLOOM_ERROR_RATE) -> Column:
    """Bit positions of an item: one digest per seed."""
    item = F.col(item) if isinstance(item, str) else item
    size = bloom_size(capacity, error_rate)
    seeds = range(bloom_hashes(size, capacity))
    return F.array(*[sha256_mod(F.concat(F.lit(f"{seed}:"), item), size) for seed in seeds])


def _bits(df: DataFrame, item: str, capacity: int, error_rate: float, *keep: str, seeds: range | None = None) -> DataFrame:
    """One row per item and seed. Digest and position are columns of their own, so each is computed once."""
    size = bloom_size(capacity, error_rate)
    seeds = range(bloom_hashes(size, capacity)) if seeds is None else seeds
    seeded = df.select(*keep, F.col(item).alias("_item"), F.explode(F.lit(list(seeds))).alias("_seed"))
    digests = seeded.select(*keep, F.sha2(F.concat_ws(":", F.col("_seed").cast("string"), "_item"), 256).alias("_digest"))
    positions = digests.select(*keep, digest_mod(F.col("_digest"), size).alias("_position"))
    return positions.select(
        *keep, F.floor(F.col("_position") / WORD).alias("word"), F.pmod("_position", F.lit(WORD)).cast("int").alias("bit")
    )


def bloom_build(df: DataFrame, item: str, capacity: int, error_rate: float = BLOOM_ERROR_RATE) -> DataFrame:
    """The filter over all items: ``(word, bits)`` rows, only words with a set bit. Combined before the shuffle.

    ``capacity`` is the number of distinct items to hold at the error rate; more items still lose none, but more
    others look seen. Build, merge and probe need the same one.
    """
    bits = _bits(df.filter(F.col(item).isNotNull()), item, capacity, error_rate)
    return bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def bloom_merge(left: DataFrame, right: DataFrame) -> DataFrame:
    """The filter of the union of two item sets (same capacity and error rate)."""
    return left.unionByName(right).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def bloom_probe(
    df: DataFrame, item: str, bloom: DataFrame, capacity: int, error_rate: float = BLOOM_ERROR_RATE
) -> DataFrame:
    """Each distinct item with ``maybe_seen``: false means certainly not in the filter.

    Bits are looked up in a cascade: the first ones a row per item, each deciding about half of the unseen items, and the
    rest only for those that are left. So an unseen item costs about two and a quarter shuffled rows, not one per bit.
    """
    distinct = df.select(item).filter(F.col(item).isNotNull()).distinct()
    left = distinct
    for seeds in bloom_stages(bloom_hashes(bloom_size(capacity, error_rate), capacity)):
        bits = _bits(left, item, capacity, error_rate, item, seeds=seeds)
        hit = bits.join(bloom, "word").filter(F.expr("getbit(bits, bit)") == 1)
        left = hit.select(item) if len(seeds) == 1 else hit.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(seeds)).select(item)
    return distinct.join(left.withColumn("_hit", F.lit(True)), item, "left").select(item, F.coalesce("_hit", F.lit(False)).alias("maybe_seen"))


def bloom_stages(hashes: int, single: int = 3) -> list[range]:
    """Seeds of each step of the cascade."""
    single = min(single, hashes)
    return [range(i, i + 1) for i in range(single)] + ([range(single, hashes)] if hashes > single else [])


def unseen_urls(
    items: DataFrame, seen: DataFrame, bloom: DataFrame, capacity: int, error_rate: float = BLOOM_ERROR_RATE
) -> DataFrame:
    """Distinct addresses that ``seen`` does not hold.

    The filter decides the certain cases; only addresses it may have seen are looked up exactly.
    """
    probed = bloom_probe(items, "url", bloom, capacity, error_rate)
    certain = probed.filter(~F.col("maybe_seen")).select("url")
    checked = probed.filter("maybe_seen").select("url").join(seen.select("url"), "url", "left_anti")
    return certain.unionByName(checked)
