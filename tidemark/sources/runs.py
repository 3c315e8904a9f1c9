"""Rows under a unique text key, laid out so that a lookup of a few keys opens a few folders, however large the table is.

Every batch adds a run: a folder of hash buckets with, beside each bucket, a Bloom filter of its keys. ``fan`` runs of a level are
merged into one of the next, with more buckets, so a bucket never holds much more than ``rows_a_bucket`` rows and the number
of runs grows with the logarithm of the table. A lookup reads the filters of the buckets that its keys fall into, and rows only of
buckets whose filter has one of the keys.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F

from ..session import settle

#: Bits of a filter for each key that a bucket is meant to hold, and bits that a key sets, all in one word of 64.
BITS_A_KEY, BITS_SET = 24, 5


class Run(NamedTuple):
    """The batches ``first`` to ``last``, merged ``level`` times, in ``buckets`` folders."""

    level: int
    first: int
    last: int
    buckets: int

    @property
    def name(self) -> str:
        return "-".join(map(str, self))


class KeyedRuns:
    """Append-only rows with the unique text column ``key`` and a growing number ``id``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, rows_a_bucket: int = 100_000, fan: int = 8):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        self.rows_a_bucket, self.fan = rows_a_bucket, fan
        self.words = max(1, rows_a_bucket * BITS_A_KEY // 64)

    def _file(self, *parts: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _runs(self) -> list[Run]:
        where, files = self._file("rows")
        if not files.exists(where):
            return []
        found = []
        for status in files.listStatus(where):
            name = status.getPath().getName()
            if name.startswith("run=") and files.exists(self._file("rows", name, "_SUCCESS")[0]):
                found.append(Run(*map(int, name.removeprefix("run=").split("-"))))
        return found

    def runs(self) -> list[Run]:
        """Complete runs that no other one covers, oldest first. A merge that stopped half-way counts for nothing."""
        found = self._runs()
        covered = lambda r: any(o.level > r.level and o.first <= r.first and r.last <= o.last for o in found)
        return sorted((r for r in found if not covered(r)), key=lambda r: r.first)

    def rows(self, runs: list[Run] | None = None) -> DataFrame:
        """All rows, or those of some runs."""
        runs = self.runs() if runs is None else runs
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        stored = self.spark.read.schema(f"{self.schema}, run STRING, bucket INT").parquet(f"{self.path}/rows")
        return stored.filter(F.col("run").isin([r.name for r in runs])).drop("run", "bucket")

    def top(self, but: int | None = None) -> int:
        """The largest id, from a row per run."""
        runs = [r for r in self.runs() if not _is(r, but)]
        if not runs:
            return 0
        notes = self.spark.read.schema("top BIGINT, run STRING").parquet(f"{self.path}/notes")
        return notes.filter(F.col("run").isin([r.name for r in runs])).agg(F.coalesce(F.max("top"), F.lit(0))).first()[0]

    def _marks(self) -> list[Column]:
        """The word of a key in its bucket's filter, and the bits it sets there."""
        bits = F.xxhash64(F.col(self.key), F.lit(2))
        each = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_bits, {6 * i}) & 63 as int))") for i in range(BITS_SET)]
        mask = each[0]
        for one in each[1:]:
            mask = mask.bitwiseOR(one)
        return [F.pmod(F.xxhash64(F.col(self.key), F.lit(1)), F.lit(self.words)).cast("int").alias("word"), bits.alias("_bits"), mask.alias("mask")]

    def _bucket(self, buckets: Column | int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")

    def _marked(self, keys: DataFrame, *keep: str) -> DataFrame:
        word, bits, mask = self._marks()
        return keys.withColumn("word", word).withColumn("_bits", bits).withColumn("mask", mask).select(*keep, "word", "mask")

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> None:
        count, top = rows.agg(F.count(F.lit(1)), F.coalesce(F.max("id"), F.lit(0))).first()
        run = Run(level, first, last, max(1, math.ceil(count / self.rows_a_bucket)))
        self._remove([r for r in self._runs() if r[:3] == run[:3]])
        placed = rows.withColumn("bucket", self._bucket(run.buckets))
        folder = f"run={run.name}"
        filters = self._marked(placed.select("bucket", self.key), "bucket").groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
        _whole(filters.hint("rebalance", "bucket")).partitionBy("bucket").parquet(f"{self.path}/filters/{folder}")
        self.spark.range(1).select(F.lit(top).cast("bigint").alias("top")).write.mode("overwrite").parquet(f"{self.path}/notes/{folder}")
        # Rows last: a run counts from the moment its rows are complete.
        _whole(placed.hint("rebalance", "bucket")).partitionBy("bucket").parquet(f"{self.path}/rows/{folder}")

    def _remove(self, runs: list[Run]) -> None:
        for run in runs:
            for kind in ("rows", "filters", "notes"):
                where, files = self._file(kind, f"run={run.name}")
                files.delete(where, True)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """The rows of a batch. A batch that is written again replaces its own rows, unless it has been merged: then it has none to add."""
        if not any(r.level and r.first <= batch_id <= r.last for r in self.runs()):
            self._write(settle(rows, "run-rows"), 0, batch_id, batch_id)

    def merge(self, before: int) -> None:
        """Merges neighbouring runs of batches below ``before``, as soon as ``fan`` of one level are there."""
        while True:
            done = [r for r in self.runs() if r.last < before]
            for level in sorted({r.level for r in done}):
                group = [r for r in done if r.level == level][:self.fan]
                if len(group) == self.fan:
                    break
            else:
                break
            self._write(self.rows(group), group[0].level + 1, group[0].first, group[-1].last)
        kept = set(self.runs())
        self._remove([r for r in self._runs() if r not in kept and r.last < before])

    def _within(self, pairs: dict[str, list[int]]) -> Column:
        """A filter on folders: these buckets of these runs."""
        chosen = F.lit(False)
        for run, buckets in pairs.items():
            chosen = chosen | ((F.col("run") == run) & F.col("bucket").isin(buckets))
        return chosen

    def folders(self, keys: DataFrame, but: int | None = None) -> tuple[dict[str, list[int]], dict[str, list[int]]]:
        """Buckets of every run that ``keys`` fall into, and those of them whose filter has one of the keys."""
        runs = [r for r in self.runs() if not _is(r, but)]
        if not runs:
            return {}, {}
        each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("run"), F.lit(r.buckets).alias("buckets")) for r in runs]))
        placed = keys.select(self.key, each.alias("r")).select(self.key, "r.run", self._bucket(F.col("r.buckets")).alias("bucket"))
        asked = _by_run(placed)
        filters = self.spark.read.schema("word INT, bits BIGINT, run STRING, bucket INT").parquet(f"{self.path}/filters").filter(self._within(asked))
        hits = self._marked(placed, "run", "bucket").join(filters, ["run", "bucket", "word"]).where("bits & mask = mask")
        return asked, _by_run(hits)

    def holding(self, keys: DataFrame, but: int | None = None) -> DataFrame:
        """Rows of the buckets that may hold one of ``keys``, all that do hold one among them; of the batch ``but`` none."""
        _, opened = self.folders(keys, but)
        if not opened:
            return self.spark.createDataFrame([], self.schema)
        stored = self.spark.read.schema(f"{self.schema}, run STRING, bucket INT").parquet(f"{self.path}/rows")
        return stored.filter(self._within(opened)).drop("run", "bucket")


def _whole(df: DataFrame) -> DataFrameWriter:
    """Replaces a folder as a whole; only that leaves the mark of a complete one."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static")


def _is(run: Run, batch_id: int | None) -> bool:
    return run.level == 0 and run.first == batch_id


def _by_run(pairs: DataFrame) -> dict[str, list[int]]:
    """Distinct (run, bucket) pairs; no more than there are folders."""
    out: dict[str, list[int]] = {}
    for run, bucket in pairs.select("run", "bucket").distinct().collect():
        out.setdefault(run, []).append(bucket)
    return {run: sorted(buckets) for run, buckets in sorted(out.items())}
