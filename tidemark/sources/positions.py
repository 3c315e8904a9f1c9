"""Where a page by position lies: counts of active rows per range of ids, so that a deep page reads a range or two.

The counts are sums of signed ones, a folder for every refresh, named by the changes it covers. A folder that covers others replaces
them, so a refresh or a merge that stopped half-way is repeated without harm.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.deltas import CHANGE
from ..operators.reads import active_only, by_source

COUNTS = "slot BIGINT, source STRING, n BIGINT"


class Bounds(NamedTuple):
    """Ids from ``low`` to before ``high``; ``before`` active rows come earlier."""

    low: int
    high: int
    before: int


class PositionIndex:
    """Counts of the active rows in every ``width`` ids, by source; ``fan`` ranges are added up into one before any is looked at.

    Rows without an id or a time are in no range and on no page.
    """

    def __init__(self, spark: SparkSession, path: str, width: int = 65_536, fan: int = 1_024):
        self.spark, self.path, self.width, self.fan = spark, path, width, fan

    def _all_spans(self) -> list[tuple[int, int]]:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        disk = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in disk.listStatus(where)] if disk.exists(where) else []
        done = lambda name: disk.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS"))
        return sorted(tuple(map(int, n.removeprefix("span=").split("-"))) for n in names if n.startswith("span=") and done(n))

    def spans(self) -> list[tuple[int, int]]:
        """First and last change of every complete folder that no other one covers."""
        found = self._all_spans()
        return [s for s in found if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in found)]

    def counts(self) -> DataFrame:
        spans = self.spans()
        if not spans:
            return self.spark.createDataFrame([], COUNTS)
        stored = self.spark.read.schema(f"{COUNTS}, span STRING").parquet(self.path)
        return stored.filter(F.col("span").isin([f"{a}-{b}" for a, b in spans])).groupBy("slot", "source").agg(F.sum("n").alias("n"))

    def _write(self, counts: DataFrame, first: int, last: int) -> None:
        target = f"{self.path}/span={first}-{last}"
        counts.filter("n <> 0").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)

    def refresh(self, log: str, newest: int) -> None:
        """Add the logged changes up to ``newest`` that are not counted yet."""
        last = max((b for _, b in self.spans()), default=0)
        if newest > last:
            changes = self.spark.read.schema(f"{CHANGE}, change_id BIGINT").parquet(log).filter(F.col("change_id").between(last + 1, newest))
            slots = changes.filter("id IS NOT NULL").groupBy(self._slot(F.col("id")).alias("slot"), "source")
            self._write(slots.agg(F.sum("sign").cast("bigint").alias("n")), last + 1, newest)

    def merge(self, least: int = 8) -> None:
        """Make one folder of them all as soon as there are ``least``, and remove what a folder covers."""
        spans = self.spans()
        if len(spans) >= least:
            self._write(self.counts(), spans[0][0], spans[-1][1])
        kept = set(self.spans())
        for first, last in set(self._all_spans()) - kept:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/span={first}-{last}")
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def _slot(self, number: Column) -> Column:
        return F.floor(number / F.lit(self.width)).cast("bigint")

    def bounds(self, skip: int, limit: int, source: str | None = None) -> Bounds | None:
        """The ranges that hold the page; None behind the last row. Two running sums, over wide ranges and inside the few wide ones hit."""
        overlap = (F.col("_end") > skip) & (F.col("_end") - F.col("n") < skip + limit)
        slots = by_source(self.counts(), source).groupBy("slot").agg(F.sum("n").alias("n")).filter("n > 0")
        slots = slots.withColumn("wide", F.floor(F.col("slot") / F.lit(self.fan)))
        # A row per width x fan ids, about 67 million: few enough for one window.
        wide = slots.groupBy("wide").agg(F.sum("n").alias("n")).withColumn("_end", F.sum("n").over(Window.orderBy("wide"))).filter(overlap)
        starts = wide.select("wide", (F.col("_end") - F.col("n")).alias("_start"))
        inside = F.sum("n").over(Window.partitionBy("wide").orderBy("slot"))
        hit = slots.join(starts, "wide").withColumn("_end", F.col("_start") + inside).filter(overlap)
        found = hit.agg(F.min("slot").alias("low"), F.max("slot").alias("high"), F.min(F.col("_end") - F.col("n")).alias("before")).first()
        return None if found["low"] is None else Bounds(found["low"] * self.width, (found["high"] + 1) * self.width, found["before"])

    def page(self, table: DataFrame, skip: int, limit: int, source: str | None = None) -> DataFrame:
        """The page that ``reads.offset_page`` gives, from rows of those ids only. ``table`` is as of the last refresh."""
        rows = by_source(active_only(table), source).filter(F.col("timestamp").isNotNull())
        found = self.bounds(skip, limit, source)
        if found is None:
            return rows.limit(0)
        within = rows.filter((F.col("id") >= found.low) & (F.col("id") < found.high))
        return within.orderBy("id").offset(skip - found.before).limit(limit)
