"""Stateless and aggregating streams: consuming the event log, running summaries, change events, snapshots.

Every ``foreachBatch`` writes into the folder of its batch with overwrite, or merges whole values by key, so a batch
that is run again after a failure leaves the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.scalars import event_time, from_event_time, number_at
from ..operators.analytics import combine_hours
from ..operators.events import dead_letter_json, dead_letters, dedupe_by_key, new_ledger_rows, parse_events
from ..schemas import LEDGER
from ..session import scratch, settle
from ..sources import months, runs
from ..sources.files import metric_lines
from .sources import batch_folder


def consume(log: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """Good events go to ``out/events``, bad ones to the dead letters in ``out/dlq``; nothing stops the stream.

    The parsed batch is written once, split by outcome. The dead letters are then taken from the written rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = batch_folder(f"{out}/events", batch_id)
        parsed = parse_events(batch).withColumn("outcome", F.when(F.col("error").isNull(), "good").otherwise("bad"))
        parsed.write.mode("overwrite").partitionBy("outcome").parquet(folder)
        bad = spark.read.schema(parsed.schema).parquet(folder).filter(F.col("outcome") == "bad")
        dead_letter_json(dead_letters(bad)).write.mode("overwrite").text(batch_folder(f"{out}/dlq", batch_id))

    return log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_events(spark: SparkSession, out: str) -> DataFrame:
    """The good events that ``consume`` has written."""
    return spark.read.parquet(f"{out}/events").filter(F.col("outcome") == "good").drop("outcome", "error", "batch_id")


def read_dead_letters(spark: SparkSession, out: str) -> DataFrame:
    shape = "source_topic STRING, source_partition INT, source_offset BIGINT, reason STRING, original STRING"
    lines = spark.read.text(f"{out}/dlq").select("value")
    return lines.select(F.from_json("value", shape).alias("m")).select("m.*")


def first_by_key(events: DataFrame, key: str, at: str, lateness: str) -> DataFrame:
    """One row per key; state for a key is dropped when it can no longer be repeated within ``lateness``."""
    timed = events.withColumn("_at", event_time(at)).withWatermark("_at", lateness)
    return timed.dropDuplicatesWithinWatermark([key]).drop("_at")


def each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """Hook for a caller's own batch function."""
    return df.writeStream.outputMode(mode).foreachBatch(fn).option("checkpointLocation", checkpoint)


def upsert_batches(df: DataFrame, out: str, checkpoint: str, keys: list[str], at: str) -> DataStreamWriter:
    """Merges the changed rows of a running aggregate into a table in monthly folders of the column ``at``.

    A batch carries whole new values, so a batch that is run again leaves the same table. Only the months that it
    touches are read and rewritten; ``latest_rows`` reads the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch(spark):
            changed = settle(batch, "changed-rows")
            touched = months.months_of(changed, at)
            if touched:
                shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changed.schema)
                stored = months.read_months(spark, out, shape, touched).drop("ym")
                merged = changed.unionByName(stored.join(changed.select(*keys), keys, "left_anti").select(*changed.columns))
                months.replace_months(merged, out, touched, at)

    return each_batch(df, write, checkpoint, "update")


def latest_rows(spark: SparkSession, out: str) -> DataFrame:
    """The table that ``upsert_batches`` keeps."""
    return spark.read.parquet(out).drop("ym")


def consume_to_ledger(log: DataFrame, out: str, checkpoint: str, as_of: str) -> DataStreamWriter:
    """Good events become pending ledger rows, one per idempotency key; the first that arrives wins.

    The ledger lies in runs of hash buckets (``sources.runs``): a micro-batch opens only buckets whose filter may have one of its
    keys. A batch that is run again replaces its own rows by the same ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger = ledger_runs(spark, out)
        with scratch(spark):
            ledger.merge(batch_id)
            good = parse_events(batch).filter("error IS NULL").withColumnRenamed("key", "idempotency_key").withColumn("_place", F.struct("part", "off"))
            firsts = settle(dedupe_by_key(good, order="_place"), "first-events")
            held = ledger.holding(firsts.select("idempotency_key"), but=batch_id)
            ledger.add(new_ledger_rows(held, firsts, as_of, "_place", ledger.top(but=batch_id)), batch_id)

    return each_batch(log, write, checkpoint)


def ledger_runs(spark: SparkSession, out: str) -> runs.KeyedRuns:
    return runs.KeyedRuns(spark, out, LEDGER, "idempotency_key")


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """The ledger that ``consume_to_ledger`` has written."""
    return ledger_runs(spark, out).rows()


def hourly_parts_stream(records: DataFrame, lateness: str = "1 hour", value_path: str = "$.value") -> DataFrame:
    """Running parts per hour and source of the active rows; rows older than the watermark are dropped.

    An exact distinct count cannot be kept in a streaming aggregate; with the source as part of the key it is
    the number of parts of an hour.
    """
    value = number_at("raw_data", value_path)
    timed = records.withColumn("_at", event_time("timestamp")).withWatermark("_at", lateness)
    rows = timed.filter(F.col("deleted_at").isNull()).withColumn("value", value)
    filled = F.coalesce("value", F.lit(0.0))
    return (
        rows.groupBy(F.window("_at", "1 hour"), "source")
        .agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("processed").alias("processed_rows"),
            F.sum(filled).alias("value_sum"), F.count(filled).alias("value_count"),
            F.min("value").alias("low"), F.max("value").alias("high"),
        )
        .select(from_event_time("window.start").alias("hour"), "source", "rows", "processed_rows", "value_sum", "value_count", "low", "high")
    )


def read_hourly_stats(spark: SparkSession, out: str) -> DataFrame:
    return combine_hours(latest_rows(spark, out), with_list=True)


def order_summary_stream(orders: DataFrame, customer: str, ordered_at: str, amount: str, lateness: str = "1 day") -> DataFrame:
    """Running orders and amount per customer and day; a day's state is dropped when the watermark has passed it."""
    timed = orders.withColumn("_at", event_time(ordered_at)).withWatermark("_at", lateness)
    return (
        timed.groupBy(F.col(customer).alias("customer_id"), F.window("_at", "1 day"))
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum(F.col(amount).cast("decimal(20,2)")).alias("total_amount"))
        .select("customer_id", from_event_time("window.start").cast("date").alias("day"), "order_count", "total_amount")
    )


def snapshot_stream(lines: DataFrame, out: str, checkpoint: str, every: str | None = "5 seconds") -> DataStreamWriter:
    """A snapshot of the metric texts that arrived, per trigger."""

    def write(batch: DataFrame, batch_id: int) -> None:
        snapshot = metric_lines(batch.withColumn("line", F.monotonically_increasing_id()))
        snapshot.write.mode("overwrite").parquet(batch_folder(out, batch_id))

    writer = each_batch(lines, write, checkpoint)
    return writer.trigger(processingTime=every) if every else writer
