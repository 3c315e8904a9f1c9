"""Ordered work on groups of any size, split so that no group needs a single task."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import settle


def spread_over(df: DataFrame, least: int) -> int:
    """In how many parts to split a hot group: as many as the session shuffles into, which is set with the data."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def running_position(df: DataFrame, order: str, keys: Sequence[str] = (), out: str = "position") -> DataFrame:
    """1-based position of every row inside its (non-null) keys, ordered by a unique column of any spacing.

    The rows are written in range partitions with sampled bounds. Each partition's rows are counted, a running total
    over the partitions gives each its start, and only the rows of one partition are sorted together.
    """
    keys = list(keys)
    ranged = settle(df.repartitionByRange(order).withColumn("_slice", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*keys, "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(order))
    return (
        ranged.withColumn("_inside", inside)
        .join(starts, [*keys, "_slice"])
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_slice", "_inside", "_start")
    )


def value_levels(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per distinct value of a key with the number of rows that share it."""
    return df.groupBy(key, value).agg(F.count(F.lit(1)).alias("ties"))


def rank_levels(levels: DataFrame, key: str, value: str, cuts: int | None = None) -> DataFrame:
    """Adds ``rank`` (1 = highest value, ties share a rank) and ``total`` rows per key to value levels.

    A key with very many values is cut at approximate quantiles. The cuts only decide where to split; the
    ranks are exact because row counts of the slices above are added.
    """
    cuts = cuts or spread_over(levels, 16)
    shares = [i / cuts for i in range(1, cuts)]
    bounds = levels.groupBy(key).agg(
        F.percentile_approx(value, shares).alias("_bounds"), F.sum("ties").alias("total")
    )
    sliced = levels.join(bounds, key).withColumn(
        "_slice", F.size(F.filter("_bounds", lambda b: b > F.col(value)))
    ).drop("_bounds")
    above = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(key, "_slice")
        .agg(F.sum("ties").alias("_rows"))
        .select(key, "_slice", F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_start"))
    )
    higher = (
        Window.partitionBy(key, "_slice").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        sliced.withColumn("_higher", F.coalesce(F.sum("ties").over(higher), F.lit(0)))
        .join(starts, [key, "_slice"])
        .withColumn("rank", F.lit(1) + F.col("_start") + F.col("_higher"))
        .drop("_slice", "_start", "_higher")
    )


def heavy_keys(df: DataFrame, on: Sequence[str], parts: int) -> list[tuple[int, int]]:
    """Hashes of keys that hold more than one ``parts``-th of the rows, with in how many pieces to split them.

    One pass with a frequent-items sketch, whose error is about a third of that share; a key that is off by it is split one
    piece more or less. There are at most ``parts`` such keys.
    """
    keyed = df.select(F.xxhash64(*on).alias("_key"))
    tracked = min(1_000_000, max(10_000, 8 * parts))
    total, top = keyed.agg(F.count(F.lit(1)), F.expr(f"approx_top_k(_key, {min(parts, tracked)}, {tracked})")).first()
    share = max(1.0, total / parts)
    return [(item["item"], math.ceil(item["count"] / share)) for item in top or [] if item["count"] > share]


def salted_join(
    many: DataFrame, one: DataFrame, on: Sequence[str], how: str = "inner", salts: int | None = None, salt_by: Column | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join where one key may hold a large share of ``many``; ``one`` has at most one row per key.

    Only heavy keys are salted, each by its own number of rows: their rows in ``many`` are spread over that many sub-keys, their
    row in ``one`` is repeated as often. All others join as they are. Heavy is what holds more than one ``salts``-th of the rows, so
    the copies are at most twice ``salts`` in all. ``counted`` has the keys of ``many`` where those are cheaper to count.
    """
    salts = salts or spread_over(many, 16)
    heavy = heavy_keys(counted if counted is not None else many, on, salts)
    if not heavy:
        return many.join(one, list(on), how)
    # No more than ``salts`` rows, so it may go to every task.
    listed = F.from_json(F.lit(json.dumps([{"_key": k, "_pieces": n} for k, n in heavy])), "array<struct<_key: bigint, _pieces: int>>")
    pieces = F.broadcast(many.sparkSession.range(1).select(F.inline(listed)))
    number = F.coalesce("_pieces", F.lit(1))
    marked = lambda df: df.withColumn("_key", F.xxhash64(*on)).join(pieces, "_key", "left").withColumn("_n", number)
    mixed = F.xxhash64(salt_by) if salt_by is not None else F.xxhash64(*many.columns)
    spread = marked(many).withColumn("_salt", F.pmod(mixed, F.col("_n")).cast("int")).drop("_key", "_pieces", "_n")
    copies = marked(one).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_key", "_pieces", "_n")
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")
