"""Tables in monthly folders ``ym=yyyyMM``, changed only where a job touches them.

New rows are appended; a month that loses or changes rows is written anew, and the other months are not read or written.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import month_of
from ..schemas import RECORDS
from ..session import fresh_path, settle
from .files import write_by_month


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def read_months(spark: SparkSession, path: str, schema: str = RECORDS, months: Iterable[str] | None = None) -> DataFrame:
    """The table with its ``ym`` column, or only some months of it; a missing table is empty."""
    where, files = _path(spark, path)
    if not files.exists(where):
        return spark.createDataFrame([], f"{schema}, ym STRING")
    rows = spark.read.schema(f"{schema}, ym STRING").parquet(path)
    return rows if months is None else rows.filter(F.col("ym").isin(list(months)))


def months_of(df: DataFrame, column: str = "timestamp") -> list[str]:
    """The months that occur: a few values, however many rows there are."""
    return sorted(r[0] for r in df.select(month_of(column)).distinct().collect())


def append_months(df: DataFrame, path: str, column: str = "timestamp") -> None:
    write_by_month(df, path, column)


def replace_months(df: DataFrame, path: str, months: Iterable[str], column: str = "timestamp") -> None:
    """Let ``df`` be the whole content of ``months``. The rows are written aside first, as they may come from there."""
    spark = df.sparkSession
    rows = settle(df, "months")
    kept = set(months_of(rows, column))
    if not kept <= set(months):
        raise ValueError(f"rows of other months than {sorted(months)}: {sorted(kept - set(months))}")
    if kept:
        dated = rows.withColumn("ym", month_of(column)).hint("rebalance", "ym")
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(path)
    for month in sorted(set(months) - kept):
        where, files = _path(spark, f"{path}/ym={month}")
        files.delete(where, True)


def new_table(spark: SparkSession, rows: DataFrame, column: str = "timestamp") -> str:
    """A table of ``rows`` in a folder of its own; returns the folder."""
    path = fresh_path(spark, "table")
    append_months(rows, path, column)
    return path
