"""Hourly parts kept up by signed changes instead of being computed anew.

A change is a row that came (``sign`` 1) or went (-1); an update is both. Counts and sums follow by adding. A minimum or maximum
follows as long as rows only come; where one went that was as low or as high, its hour and source are computed from the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import hour_of, number_at
from .analytics import VALUE_PATH, bucketed, hour_source_parts
from .reads import active_only

CHANGE = "sign INT, id BIGINT, source STRING, timestamp TIMESTAMP_NTZ, raw_data STRING, processed BOOLEAN"
PARTS = "hour TIMESTAMP_NTZ, source STRING, rows BIGINT, processed_rows BIGINT, value_sum DOUBLE, value_count BIGINT, low DOUBLE, high DOUBLE, applied BIGINT"
SUMS = ("rows", "processed_rows", "value_sum", "value_count")


def row_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed changes from the touched rows as they were and as they are; only active rows with a time count, unchanged ones cancel out."""
    fields = ["id", "source", "timestamp", "raw_data", "processed"]
    signed = [active_only(df).filter(F.col("timestamp").isNotNull()).select(F.lit(sign).alias("sign"), *fields) for df, sign in ((before, -1), (after, 1))]
    return signed[0].unionByName(signed[1]).groupBy(*fields).agg(F.sum("sign").cast("int").alias("sign")).filter("sign <> 0").select("sign", *fields)


def delta_parts(changes: DataFrame, value_path: str = VALUE_PATH) -> DataFrame:
    """What the changes add to each hour and source, and the extremes that came and went.

    A missing value counts as 0 for the average and not at all for the extremes.
    """
    rows = changes.select("sign", hour_of("timestamp").alias("hour"), "source", "processed", number_at("raw_data", value_path).alias("value"))
    sign, filled = F.col("sign"), F.coalesce("value", F.lit(0.0))
    came, went = (F.when(sign * s > 0, F.col("value")) for s in (1, -1))
    return rows.groupBy("hour", "source").agg(
        F.sum(sign).alias("d_rows"), F.sum(F.when(F.col("processed"), sign).otherwise(0)).alias("d_processed_rows"),
        F.sum(sign * filled).alias("d_value_sum"), F.sum(sign).alias("d_value_count"),
        F.min(came).alias("low_in"), F.max(came).alias("high_in"), F.min(went).alias("low_out"), F.max(went).alias("high_out"),
    )


def merged_parts(stored: DataFrame, deltas: DataFrame) -> DataFrame:
    """The touched parts after the changes; ``stale`` where an extreme may have gone and has to be looked up."""
    both = deltas.join(stored.drop("applied"), ["hour", "source"], "left")
    sums = [(F.coalesce(s, F.lit(0)) + F.col(f"d_{s}")).alias(s) for s in SUMS]
    # What came may be as good as what went.
    lost_low = F.col("low_out").isNotNull() & ~F.coalesce(F.least("low", "low_in") < F.col("low_out"), F.lit(False))
    lost_high = F.col("high_out").isNotNull() & ~F.coalesce(F.greatest("high", "high_in") > F.col("high_out"), F.lit(False))
    return both.select(
        "hour", "source", *sums, F.least("low", "low_in").alias("low"), F.greatest("high", "high_in").alias("high"), (lost_low | lost_high).alias("stale"),
    )


def looked_up(merged: DataFrame, table: DataFrame, value_path: str = VALUE_PATH) -> DataFrame:
    """The parts with the extremes of stale ones taken from the rows of ``table``; parts without rows stay, with none."""
    wanted = merged.filter("stale").select("hour", "source")
    rows = bucketed(active_only(table), value_path).join(wanted, ["hour", "source"], "left_semi")
    found = hour_source_parts(rows, F.coalesce("value", F.lit(0.0)), F.col("value")).select("hour", "source", F.col("low").alias("_low"), F.col("high").alias("_high"))
    pick = lambda c: F.when(F.col("stale"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
    return merged.join(found, ["hour", "source"], "left").select("hour", "source", *SUMS, pick("low"), pick("high"))
