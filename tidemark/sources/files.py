"""File readers and writers: JSON requests, posts, CSV, metric text, partitioned archives."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import instant, month_of, wall_clock
from ..schemas import POSTS, REQUESTS, SNAPSHOT_METRICS, SYNTHETIC_BATCH_ROWS, SYNTHETIC_SOURCES


def scan_requests_json(spark: SparkSession, path: str, as_of: datetime | str | Column, extra: str = "") -> DataFrame:
    """Request-shaped JSON lines; a missing timestamp becomes ``as_of``, missing tags an empty list."""
    schema = f"{REQUESTS}, {extra}" if extra else REQUESTS
    stamp = F.when(F.col("timestamp").isNull(), instant(as_of)).otherwise(wall_clock("timestamp"))
    rows = spark.read.schema(schema).json(path)
    return rows.withColumn("timestamp", stamp).withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_records_jdbc(
    spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """The table over JDBC, read in parallel by id range; needs the driver jar of the database."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="id", lowerBound=lower, upperBound=upper, numPartitions=partitions, **options)
        .load()
    )


def scan_posts_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POSTS).json(path)


# Quotes are doubled as in RFC 4180, and times keep their microseconds, which the CSV defaults would cut.
CSV_FORMAT = {"header": "true", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_csv(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    return spark.read.options(**{**CSV_FORMAT, **options}).schema(schema).csv(path)


def scan_customers_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """Customer CSV with every field as text; lines that do not fit keep their text in ``corrupt_line``."""
    schema = "id STRING, email STRING, age STRING, purchase_date DATE, corrupt_line STRING"
    return read_csv(spark, path, schema, mode="PERMISSIVE", columnNameOfCorruptRecord="corrupt_line", **options)


def scan_metric_text(spark: SparkSession, path: str) -> DataFrame:
    """Metric exposition text as ``(name, value)``; names keep their labels, the last line of a name counts.

    Lines are ordered by file name, place of the read block in the file, and place in the block.
    """
    line = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place"))
    return metric_lines(spark.read.text(path).withColumn("line", line))


def metric_lines(lines: DataFrame) -> DataFrame:
    text = F.trim("value")
    parts = F.split(text, r"\s+")
    wanted = F.lit(False)
    for name in SNAPSHOT_METRICS:
        wanted = wanted | F.contains(F.col("name"), F.lit(name))
    return (
        lines.filter((text != "") & ~F.startswith(F.col("value"), F.lit("#")))
        .filter(F.size(parts) >= 2)
        .select(F.get(parts, F.lit(0)).alias("name"), F.get(parts, F.lit(1)).try_cast("double").alias("value"), "line")
        .filter(F.col("value").isNotNull() & wanted)
        .groupBy("name")
        .agg(F.max_by("value", "line").alias("value"))
    )


def metric_labels(name: str | Column) -> Column:
    """Labels of a metric name such as ``hits{a="b",c="d"}`` as a map."""
    inside = F.regexp_extract(name, r"\{(.*)\}", 1)
    return F.when(inside != "", F.str_to_map(F.replace(inside, F.lit('"'), F.lit("")), F.lit(","), F.lit("=")))


def write_csv_gz(df: DataFrame, path: str) -> None:
    """Cold export: CSV with a header, gzip; array and other nested columns must be texts already."""
    df.write.options(**CSV_FORMAT).option("compression", "gzip").csv(path)


def write_by_month(df: DataFrame, path: str, column: str = "timestamp", mode: str = "append") -> None:
    """Write to monthly folders. The rebalance splits a large month over tasks and merges small ones."""
    rows = df.withColumn("ym", month_of(column)).hint("rebalance", "ym")
    rows.write.mode(mode).partitionBy("ym").parquet(path)


def doc_store_append(docs: DataFrame, path: str, as_of: datetime | str | Column | None = None) -> None:
    """Append scraped documents to their source's folder."""
    rows = docs if as_of is None else docs.withColumn("scraped_at", instant(as_of))
    rows.write.mode("append").partitionBy("source").parquet(path)


def read_doc_store(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Stored documents; a store that nobody has written yet is empty. ``schema`` is that of the items."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def generate_records(numbers: DataFrame, number: str = "n") -> DataFrame:
    """Synthetic records for whole numbers from 0: the sources in turn, one second apart from 2024-01-01."""
    n = F.col(number)
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)")
    )
    sources = F.array(*[F.lit(source) for source in SYNTHETIC_SOURCES])
    return numbers.select(
        F.get(sources, (n % len(SYNTHETIC_SOURCES)).cast("int")).alias("source"),
        at.alias("timestamp"),
        F.to_json(F.struct(n.alias("value"), F.floor(n / SYNTHETIC_BATCH_ROWS).alias("batch"))).alias("raw_data"),
        F.array(
            F.concat(F.lit("tag-"), (n % 10).cast("string")), F.concat(F.lit("bucket-"), (n % 5).cast("string"))
        ).alias("tags"),
    )


def dated_path(root: str, day: date) -> str:
    """Folder of one day's export."""
    return f"{root.rstrip('/')}/{day.isoformat()}"
