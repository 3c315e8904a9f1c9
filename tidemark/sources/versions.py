"""Versioned tables on plain parquet: write a new folder, then append its number to the version log.

Readers follow the newest entry of the log. A failed write leaves the log, and so the table, as it was, and a
folder that is being read is never overwritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LOG_SCHEMA = "version BIGINT, folder STRING"


def versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Entries of the version log, oldest first; one small row per version."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_log")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    rows = spark.read.schema(LOG_SCHEMA).json(f"{root}/_log").collect()
    return sorted((row["version"], row["folder"]) for row in rows)


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None) -> int:
    spark = df.sparkSession
    history = versions(spark, root)
    number = history[-1][0] + 1 if history else 1
    folder = f"v{number}-{uuid.uuid4().hex[:8]}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{root}/{folder}")
    spark.createDataFrame([(number, folder)], LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/_log")
    return number


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    history = dict(versions(spark, root))
    if not history:
        raise FileNotFoundError(f"no version under {root}")
    return spark.read.parquet(f"{root}/{history[version or max(history)]}")
