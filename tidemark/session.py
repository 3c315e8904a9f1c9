"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


_scopes = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``settle`` writes inside are removed at the end. For work whose result is written before then, such as a micro-batch."""
    outer = getattr(_scopes, "paths", None)
    _scopes.paths = paths = []
    try:
        yield
    finally:
        _scopes.paths = outer
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def settle(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write a frame that is read more than once and continue from the written table, in folders of the columns ``by``.

    The table outlives lost executors, unlike a cached frame, and is never recomputed. Inside ``scratch`` it lasts until its end.
    """
    path = fresh_path(df.sparkSession, label)
    if getattr(_scopes, "paths", None) is not None:
        _scopes.paths.append(path)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
