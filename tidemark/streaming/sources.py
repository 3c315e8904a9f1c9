"""Streaming readers and writers. The broker options need the Kafka package; files carry the same columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..schemas import LOG, RECORDS_TOPIC
from ..session import scratch, settle


def kafka_log(spark: SparkSession, servers: str, topic: str = RECORDS_TOPIC, starting: str = "earliest", **options: str) -> DataFrame:
    """The topic as a stream; replay by passing offsets as ``starting``."""
    reader = spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting})
    return reader.options(**options).load().select(
        "topic", F.col("partition").alias("part"), F.col("offset").alias("off"), F.col("key").cast("string").alias("key"),
        F.col("timestamp").cast("timestamp_ntz").alias("ts"), "value",
    )


def file_log(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The topic as parquet files with the columns of ``schemas.LOG``."""
    return table_stream(spark, path, LOG, files_per_batch)


def table_stream(
    spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None, pattern: str | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, optionally only those whose name matches ``pattern``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def land_in_order(rows: DataFrame, path: str, order: Sequence[str], rows_per_file: int) -> str:
    """Parquet files of about ``rows_per_file`` rows with a range of ``order`` each, written one after another; returns the path.

    The file source takes files by age, so a stream with one file per batch gets the ranges in order, in batches of bounded size.
    """
    files = -(-rows.count() // rows_per_file)
    if files <= 1:
        rows.coalesce(1).write.parquet(path)
        return path
    with scratch(rows.sparkSession):
        ranged = rows.repartitionByRange(files, *order).withColumn("_range", F.spark_partition_id())
        ranged = settle(ranged, "ranges", "_range")
        for i in range(files):
            ranged.filter(F.col("_range") == i).drop("_range").coalesce(1).write.mode("append").parquet(path)
    return path


def kafka_sink(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Writer for ``value`` texts into a topic."""
    return messages.writeStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    )


def text_sink(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer for ``value`` texts into line files."""
    return messages.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything that is there now, then stop; raises when the query failed."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return query


def batch_folder(path: str, batch_id: int) -> str:
    """Where a micro-batch writes; a repeated batch replaces its own folder."""
    return f"{path}/batch_id={batch_id}"
