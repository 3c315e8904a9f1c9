"""Lowest and highest value of a column per data file, so that a scan for what changed opens only files that hold a change.

A data file is written once, under a name of its own, so a note about it never goes stale. Notes of files that are gone are
passed over, and a file without a note is read: forgetting to take notes costs time, never rows.
"""

from __future__ import annotations

from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import instant
from ..operators.reads import modified_since
from ..schemas import RECORDS
from ..session import scratch, settle

NOTES = "file STRING, low TIMESTAMP_NTZ, high TIMESTAMP_NTZ, rows BIGINT"


class ZoneMap:
    """Notes on ``column`` of a table in monthly folders, kept beside the months in a folder that readers of the table pass over."""

    def __init__(self, spark: SparkSession, table: str, column: str = "updated_at", schema: str = RECORDS):
        self.spark, self.table, self.column, self.schema = spark, table.rstrip("/"), column, f"{schema}, ym STRING"
        self.path = f"{self.table}/_zones/{column}"

    def _exists(self, path: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def _read(self, files: list[str] | None = None) -> DataFrame:
        """The table, or the rows of some files. No files: no rows."""
        reader = self.spark.read.schema(self.schema).option("basePath", self.table)
        if files is None and self._exists(self.table):
            return reader.parquet(self.table)
        return reader.parquet(*map(unquote, files)) if files else self.spark.createDataFrame([], self.schema)

    def _files(self) -> DataFrame:
        """A row per data file, by the listing that Spark takes of the table anyway."""
        return self.spark.createDataFrame([(name,) for name in self._read().inputFiles()], "file STRING")

    def notes(self) -> DataFrame:
        return self.spark.read.schema(NOTES).parquet(self.path) if self._exists(self.path) else self.spark.createDataFrame([], NOTES)

    def note(self) -> int:
        """Take notes of the files that have none; returns their number. Only ``column`` of those files is read."""
        fresh = [r["file"] for r in self._files().join(self.notes(), "file", "left_anti").collect()]
        if fresh:
            # This function and the listing spell a name alike, which ``_metadata`` does not.
            found = self._read(fresh).select(F.input_file_name().alias("file"), F.col(self.column).alias("v")).groupBy("file").agg(
                F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("rows")
            )
            found.write.mode("append").parquet(self.path)
        return len(fresh)

    def tidy(self) -> None:
        """Drop notes of files that are gone. Should it stop in between, notes are missing, and their files are read until noted again."""
        with scratch(self.spark):
            kept = settle(self.notes().dropDuplicates(["file"]).join(self._files(), "file", "left_semi"), "zone-notes")
            kept.write.mode("overwrite").parquet(self.path)

    def files_since(self, moment: datetime | str | Column) -> list[str]:
        """Files that may hold a value after ``moment``: those noted with one, and those without a note. A file of nulls holds none."""
        ruled_out = self.notes().filter(F.col("high").isNull() | (F.col("high") <= instant(moment)))
        return sorted(r["file"] for r in self._files().join(ruled_out, "file", "left_anti").collect())

    def changed_since(self, moment: datetime | str | Column) -> DataFrame:
        """Rows whose ``column`` lies after ``moment``, from those files alone."""
        return modified_since(self._read(self.files_since(moment)), moment, self.column).drop("ym")
