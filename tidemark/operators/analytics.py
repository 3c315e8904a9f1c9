"""Hourly summaries and rankings.

Three null policies exist side by side on purpose: ``summary_zero`` counts a missing value as 0,
``summary_skip`` leaves it out, and ``hourly_stats`` counts it as 0 for the average only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import check_range, hour_of, instant, month_of, number_at, pct
from ..session import settle
from ..schemas import SUMMARY_HOURS, TOP_HOURS, TOP_ROWS
from .reads import active_only, by_source, newest_first, recent
from .spread import rank_levels, value_levels

VALUE_PATH = "$.value"
#: Two to this many registers a sketch: a standard error of 1.6 %.
SKETCH_BITS = 12
SKETCHES = "hour TIMESTAMP_NTZ, sketch BINARY"
#: Size of a quantile sketch: its ranks are off by about 0.2 %.
QUANTILE_K = 1600
#: By how much of the rows a bar from sketches is set lower than asked.
BAR_SLACK = 0.01
VALUE_SKETCHES = "month TIMESTAMP_NTZ, source STRING, total BIGINT, sketch BINARY"


def hour_source_parts(df: DataFrame, average: Column, low_high: Column) -> DataFrame:
    """Partial results per hour and source; they can be added up in any order and across batches."""
    return df.groupBy("hour", "source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("processed").alias("processed_rows"),
        F.sum(average).alias("value_sum"),
        F.count(average).alias("value_count"),
        F.min(low_high).alias("low"),
        F.max(low_high).alias("high"),
    )


def combine_hours(parts: DataFrame, with_list: bool = False) -> DataFrame:
    """Hourly figures from the parts. One part per source makes the distinct count a plain count."""
    listed = [F.array_sort(F.collect_list("source")).alias("source_list")] if with_list else []
    return (
        parts.groupBy("hour")
        .agg(
            F.sum("rows").alias("record_count"),
            F.sum("processed_rows").alias("processed_count"),
            F.round(F.try_divide(F.sum("value_sum"), F.sum("value_count")), 4).alias("avg_value"),
            F.min("low").alias("min_value"),
            F.max("high").alias("max_value"),
            F.count("source").alias("unique_sources"),
            *listed,
        )
        .withColumn("processed_pct", pct(F.col("processed_count"), F.col("record_count")))
    )


def _hourly(df: DataFrame, average: Column, low_high: Column, with_list: bool = False) -> DataFrame:
    """Hourly figures in two hash aggregates: the hour and source level absorbs the rows before the shuffle."""
    return combine_hours(hour_source_parts(df, average, low_high), with_list)


def bucketed(df: DataFrame, value_path: str) -> DataFrame:
    return df.select(hour_of("timestamp").alias("hour"), "source", "processed", number_at("raw_data", value_path).alias("value"))


def summary_zero(df: DataFrame, hours: int, as_of: datetime | str | Column, value_path: str = VALUE_PATH) -> DataFrame:
    """Per hour, newest first; a missing value is 0 everywhere."""
    rows = recent(active_only(df), hours, as_of, SUMMARY_HOURS)
    value = F.coalesce("value", F.lit(0.0))
    return _hourly(bucketed(rows, value_path), value, value).orderBy(F.desc("hour"))


def summary_skip(df: DataFrame, hours: int, as_of: datetime | str | Column, value_path: str = VALUE_PATH) -> DataFrame:
    """Per hour, newest first; missing values are left out, null when an hour has none."""
    rows = recent(active_only(df), hours, as_of, SUMMARY_HOURS)
    return _hourly(bucketed(rows, value_path), F.col("value"), F.col("value")).orderBy(F.desc("hour"))


def hourly_stats(df: DataFrame, as_of: datetime | str | Column, value_path: str = VALUE_PATH) -> DataFrame:
    """The stored hourly table over all active rows."""
    rows = bucketed(active_only(df), value_path)
    stats = _hourly(rows, F.coalesce("value", F.lit(0.0)), F.col("value"), with_list=True)
    return stats.withColumn("materialized_at", instant(as_of))


def hourly_stats_fallback(df: DataFrame, limit: int, as_of: datetime | str | Column, value_path: str = VALUE_PATH) -> DataFrame:
    """Newest hours computed from the base table; missing values left out, sources joined by commas."""
    rows = bucketed(active_only(df), value_path)
    stats = _hourly(rows, F.col("value"), F.col("value"), with_list=True)
    return (
        stats.withColumn("source_list", F.concat_ws(",", "source_list"))
        .withColumn("materialized_at", instant(as_of))
        .orderBy(F.desc("hour"))
        .limit(limit)
    )


def processed_share(df: DataFrame, by: str = "source") -> DataFrame:
    """Filtered count and its share per group."""
    counted = active_only(df).groupBy(by).agg(
        F.count(F.lit(1)).alias("record_count"), F.count_if("processed").alias("processed_count")
    )
    return counted.withColumn("processed_pct", pct(F.col("processed_count"), F.col("record_count")))


def distinct_sources(df: DataFrame, approximate: bool = False, error: float = 0.02) -> DataFrame:
    count = F.approx_count_distinct("source", error) if approximate else F.count_distinct("source")
    return active_only(df).agg(count.alias("unique_sources"))


def distinct_sketches(df: DataFrame, column: str = "source") -> DataFrame:
    """``hour`` and ``sketch``: what a distinct count over any hours needs, in a few kilobytes an hour. Missing values do not count."""
    rows = active_only(df).filter(F.col("timestamp").isNotNull()).select(hour_of("timestamp").alias("hour"), column)
    return rows.groupBy("hour").agg(F.hll_sketch_agg(column, SKETCH_BITS).alias("sketch"))


def estimated_distinct(sketches: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """``estimate`` over the hours from ``start`` to before ``end``, of sketches of any tiers and batches: an hour may have several."""
    inside = sketches.filter((F.col("hour") >= instant(start)) & (F.col("hour") < instant(end)))
    return inside.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("estimate"))


def source_list_by_hour(df: DataFrame) -> DataFrame:
    """Sorted distinct sources per hour; duplicates are gone before the lists are built."""
    pairs = active_only(df).select(hour_of("timestamp").alias("hour"), "source").distinct()
    return pairs.groupBy("hour").agg(F.array_sort(F.collect_list("source")).alias("source_list"))


def ingestion_health(df: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Rows created in the last day and the latest creation time, deleted rows included."""
    return df.agg(
        F.max("created_at").alias("last_created_at"),
        F.count_if(F.col("created_at") >= instant(as_of) - F.make_dt_interval(F.lit(1))).alias("records_24h"),
    )


def _ranked_values(df: DataFrame, value_path: str) -> DataFrame:
    value = F.coalesce(number_at("raw_data", value_path), F.lit(0.0))
    return df.select("id", "source", "timestamp", value.alias("value"), "processed")


def percentile_by_value(df: DataFrame, source: str, limit: int = 100, value_path: str = VALUE_PATH) -> DataFrame:
    """PERCENT_RANK by value (0.0 = highest), the first ``limit`` rows of a source.

    Only the top rows are sorted. Every higher value is among them, so their rank equals the rank in the whole
    source; its size comes from a count in a scalar subquery.
    """
    rows = by_source(active_only(df), source)
    size = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    top = _ranked_values(rows, value_path).orderBy(F.desc("value"), "id").limit(limit)
    rank = F.rank().over(Window.partitionBy("source").orderBy(F.desc("value")))
    share = F.coalesce(F.try_divide((F.col("rank") - 1).cast("double"), F.col("size") - 1), F.lit(0.0))
    return (
        top.withColumn("rank", rank)
        .withColumn("size", size)
        .withColumn("percentile_rank", F.round(share, 4))
        .drop("rank", "size")
    )


def percentile_by_recency(df: DataFrame, source: str, limit: int = 100, value_path: str = VALUE_PATH) -> DataFrame:
    """Position among the newest rows of a source as a share; the value plays no part."""
    newest = newest_first(by_source(active_only(df), source)).limit(limit)
    order = Window.partitionBy("source").orderBy(F.desc("timestamp"), F.desc("id"))
    size = F.count(F.lit(1)).over(Window.partitionBy("source"))
    share = F.coalesce(F.try_divide((F.col("_pos") - 1).cast("double"), size - 1), F.lit(0.0))
    return newest.withColumn("_pos", F.row_number().over(order)).select(
        "id", "timestamp", number_at("raw_data", value_path).alias("value"), F.round(share, 4).alias("percentile_rank")
    )


def _top_levels(rows: DataFrame, limit: int) -> DataFrame:
    """The distinct values that hold ranks up to ``limit``: at most ``limit`` rows per source."""
    by_value = Window.partitionBy("source").orderBy(F.desc("value"))
    higher = by_value.rowsBetween(Window.unboundedPreceding, -1)
    return (
        value_levels(rows, "source", "value")
        .withColumn("_pos", F.row_number().over(by_value))
        .filter(F.col("_pos") <= limit)
        .withColumn("rank", F.lit(1) + F.coalesce(F.sum("ties").over(higher), F.lit(0)))
        .filter(F.col("rank") <= limit)
        .drop("_pos")
    )


def top_by_source(
    df: DataFrame, limit: int, hours: int, as_of: datetime | str | Column, value_path: str = VALUE_PATH
) -> DataFrame:
    """Rows whose RANK by value inside their source is at most ``limit``; ties can exceed it.

    The rank is worked out on distinct values, pre-aggregated before the shuffle, so neither a large source nor
    a large group of equal values is sorted in one task.
    """
    check_range("limit", limit, TOP_ROWS)
    rows = _ranked_values(recent(active_only(df), hours, as_of, TOP_HOURS), value_path)
    levels = _top_levels(rows, limit).select("source", "value", "rank")
    return rows.join(levels, ["source", "value"]).select("id", "source", "timestamp", "value", "processed", "rank")


def top_by_source_positional(
    df: DataFrame, limit: int, hours: int, as_of: datetime | str | Column, value_path: str = VALUE_PATH
) -> DataFrame:
    """Exactly the first ``limit`` rows per source, highest value first, missing values last."""
    check_range("limit", limit, TOP_ROWS)
    rows = recent(active_only(df), hours, as_of, TOP_HOURS).select(
        "id", "source", "timestamp", number_at("raw_data", value_path).alias("value"), "processed"
    )
    order = Window.partitionBy("source").orderBy(F.desc_nulls_last("value"), F.desc("timestamp"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def nest_by_source(ranked: DataFrame, rows_per_part: int = 10_000) -> DataFrame:
    """Ranked rows as ordered lists: ``part`` 0 of a source holds its first ``rows_per_part`` rows, part 1 the next.

    Rows of equal rank are in id order. Ties can make a source arbitrarily large; the parts keep every list within a task.
    """
    tied = Window.partitionBy("source", "rank").orderBy("id")
    item = F.struct("rank", "id", "timestamp", "value", "processed")
    position = F.col("rank") + F.row_number().over(tied) - 2
    return (
        ranked.withColumn("part", F.floor(position / F.lit(rows_per_part)).cast("bigint"))
        .groupBy("source", "part")
        .agg(F.array_sort(F.collect_list(item)).alias("rows"))
    )


def percentile_outliers(df: DataFrame, top_share: float, value_path: str = VALUE_PATH) -> DataFrame:
    """Rows of every source in its top share by value (PERCENT_RANK not above ``top_share``)."""
    rows = _ranked_values(active_only(df), value_path)
    ranked = rank_levels(value_levels(rows, "source", "value"), "source", "value")
    share = F.coalesce(F.try_divide((F.col("rank") - 1).cast("double"), F.col("total") - 1), F.lit(0.0))
    kept = ranked.withColumn("percentile_rank", share).filter(F.col("percentile_rank") <= top_share)
    return rows.join(kept.select("source", "value", F.round("percentile_rank", 4).alias("percentile_rank")), ["source", "value"])


def value_sketches(df: DataFrame, value_path: str = VALUE_PATH) -> DataFrame:
    """Rows and a sketch of the values per month and source. Sketches of batches and tiers add up; a month that lost rows is sketched anew."""
    rows = _ranked_values(active_only(df).filter(F.col("timestamp").isNotNull()), value_path)
    month = F.to_timestamp_ntz(month_of("timestamp"), F.lit("yyyyMM")).alias("month")
    return rows.groupBy(month, "source").agg(F.count(F.lit(1)).alias("total"), F.kll_sketch_agg_double("value", F.lit(QUANTILE_K)).alias("sketch"))


def value_bars(sketches: DataFrame, top_share: float) -> DataFrame:
    """``source``, ``total`` rows, and a ``bar`` that the values of the top share very probably reach."""
    merged = sketches.filter("source IS NOT NULL").groupBy("source").agg(F.sum("total").alias("total"), F.kll_merge_agg_double("sketch").alias("sketch"))
    share = max(0.0, 1 - top_share - BAR_SLACK)
    return merged.select("source", "total", F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias("bar"))


def percentile_outliers_over(df: DataFrame, sketches: DataFrame, top_share: float, value_path: str = VALUE_PATH) -> DataFrame:
    """``percentile_outliers`` of whole months, given their sketches: only values above a bar are shuffled and ranked.

    Ranks are exact, as all higher values are above the bar too. That a bar let enough rows through is counted; a source
    whose bar was too high, by the sketch's error, is ranked without one.
    """
    rows = _ranked_values(active_only(df).filter(F.col("timestamp").isNotNull()), value_path)
    bars = settle(value_bars(sketches, top_share), "value-bars")
    levels = settle(value_levels(rows.join(bars, "source").filter("value >= bar"), "source", "value"), "value-levels")
    passed = levels.groupBy("source").agg(F.sum("ties").alias("passed"))
    wanted = F.floor(F.lit(top_share) * (F.col("total") - 1)) + 1
    short = settle(bars.join(passed, "source", "left").filter(F.coalesce("passed", F.lit(0)) < wanted), "short-bars")
    if not short.isEmpty():
        levels = levels.unionByName(value_levels(rows.join(short, "source").filter("value < bar"), "source", "value"))
    ranked = rank_levels(levels, "source", "value").drop("total").join(bars.select("source", "total"), "source")
    share = F.coalesce(F.try_divide((F.col("rank") - 1).cast("double"), F.col("total") - 1), F.lit(0.0))
    kept = ranked.withColumn("percentile_rank", share).filter(F.col("percentile_rank") <= top_share)
    return rows.join(kept.select("source", "value", F.round("percentile_rank", 4).alias("percentile_rank")), ["source", "value"])


def group_summary(df: DataFrame, keys: Sequence[str], mean_max: str, total: str) -> DataFrame:
    """Mean and maximum of one column and the sum of another per group."""
    return df.groupBy(*keys).agg(
        F.avg(mean_max).alias(f"{mean_max}_mean"), F.max(mean_max).alias(f"{mean_max}_max"), F.sum(total).alias(f"{total}_sum")
    )


def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def order_summary(orders: DataFrame, customer: str, ordered_at: str, amount: str) -> DataFrame:
    """Orders and amount per customer and day."""
    return orders.groupBy(F.col(customer).alias("customer_id"), F.col(ordered_at).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(F.col(amount).cast("decimal(20,2)")).alias("total_amount")
    )


def merge_order_summary(current: DataFrame, delta: DataFrame) -> DataFrame:
    """Add a batch of summaries to the running ones."""
    return current.unionByName(delta).groupBy("customer_id", "day").agg(
        F.sum("order_count").alias("order_count"), F.sum("total_amount").alias("total_amount")
    )


def revenue_by(summary: DataFrame, customers: DataFrame, dim: str) -> DataFrame:
    """Amount per attribute of the customer; summaries are added up per customer before the join."""
    per_customer = summary.groupBy("customer_id").agg(F.sum("total_amount").alias("total_amount"))
    return per_customer.join(customers.select("customer_id", dim), "customer_id").groupBy(dim).agg(
        F.sum("total_amount").alias("revenue")
    )
