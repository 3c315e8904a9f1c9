"""Composed jobs: scraping, ingesting, archiving and refreshing, each as a few writes in a safe order."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import instant
from ..operators import analytics, deltas, documents, events, mutations, quality, reads
from ..session import scratch, settle
from ..sources import files, months, positions, versions, zones


def scrape_job(
    pages: DataFrame, source: str, store: str, as_of: datetime | str | Column, limit: int | None = None,
    registry: documents.ExtractorRegistry | None = None, **options,
) -> tuple[DataFrame, DataFrame]:
    """Extract, drop repeated addresses, store, announce. Returns the counts and the messages to publish.

    Counts are of this run: ``scraped`` items, ``stored`` new ones, ``failed`` ones without an address. An address
    that the store holds for the source is not stored again, so a second run stores nothing. A request's ``limit``
    outside the allowed 1 to 100 rows per page becomes the nearest of the two.
    """
    spark = pages.sparkSession
    registry = registry or documents.default_registry()
    if limit is not None:
        options["limit"] = documents.clamp_limit(limit)
    found = settle(registry.apply(source, pages, source=source, **options), "scraped")
    items = documents.dedupe_urls(found.filter("url IS NOT NULL"), *documents.ITEM_ORDER).drop(*documents.ITEM_ORDER)
    known = files.read_doc_store(spark, store, items.schema).filter(F.col("source") == source).select("source", "url")
    fresh = settle(items.join(known, ["source", "url"], "left_anti").select(*items.columns), "scraped-new")
    files.doc_store_append(fresh, store, as_of)
    counts = items.agg(F.count(F.lit(1)).alias("scraped")).select(
        "scraped", fresh.agg(F.count(F.lit(1))).scalar().alias("stored"),
        found.filter("url IS NULL").agg(F.count(F.lit(1))).scalar().alias("failed"),
    )
    return counts, events.doc_scraped_events(items)


def log_run(spark: SparkSession, runs: str, job: str, as_of: datetime | str | Column, rows: int) -> None:
    """Append a successful run to the run log that ``reads.last_success`` reads."""
    at = instant(as_of)
    spark.range(1).select(
        F.lit(job).alias("job"), at.alias("completed_at"), F.lit("success").alias("status"), F.lit(rows).cast("bigint").alias("rows")
    ).write.mode("append").parquet(runs)


def ingest_job(
    spark: SparkSession, path: str, requests: DataFrame, position: str, as_of: datetime | str,
    transform: Callable[[DataFrame], DataFrame] | None = None, batch: str = "batch_id", runs: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Validate, append what is new to the monthly records table, summarise per batch, log the run.

    Returns the summary and the change messages of the inserted rows. Only the months of the batch are searched for its
    keys, and only new rows are written. A batch that is loaded again adds nothing.
    """
    rows = transform(requests) if transform else requests
    checked = settle(quality.validate_requests(rows, as_of), "checked")
    valid, _ = quality.split_valid(checked, [position])
    incoming = valid.select(
        F.col(position).alias("arrival"), "source", F.col("parsed_at").alias("timestamp"), F.col("data").alias("raw_data"), "tags"
    )
    table = months.read_months(spark, path)
    held = months.read_months(spark, path, months=months.months_of(incoming))
    inserted = settle(mutations.added_records(table.drop("ym"), held, incoming, "arrival", as_of), "inserted")
    months.append_months(inserted, path)
    if runs is not None:
        log_run(spark, runs, "ingest", as_of, inserted.count())
    return quality.batch_ingest_summary(checked, position, batch), events.record_created_events(inserted)


def archive_job(spark: SparkSession, hot_path: str, archive_path: str, days: int, as_of: datetime | str | Column) -> DataFrame:
    """Move old active rows to the monthly archive: append first, then rewrite the months of the hot table they leave.

    What the archive holds already is not appended again. So if the job stops in between, a second run only finishes
    the hot side, and a run without old rows writes nothing.
    """
    hot = months.read_months(spark, hot_path).drop("ym")
    before = hot.count()
    old = settle(mutations.old_active(hot, days, as_of), "archive-move")
    touched = months.months_of(old)
    moved = settle(mutations.to_archive(old, months.read_months(spark, archive_path, months=touched)), "archive-new")
    months.append_months(moved, archive_path)
    if touched:
        left = mutations.left_in_hot(months.read_months(spark, hot_path, months=touched).drop("ym"), days, as_of)
        months.replace_months(left, hot_path, touched)
    after = months.read_months(spark, hot_path).agg(F.count(F.lit(1))).scalar()
    return moved.agg(F.count(F.lit(1)).alias("archived")).withColumn("hot_before", F.lit(before).cast("bigint")).withColumn("hot_after", after)


def export_and_trim(spark: SparkSession, archive_path: str, target: str, days: int, as_of: datetime | str | Column) -> DataFrame:
    """Cold rows to CSV; they leave the archive's months only after the export holds as many rows."""
    archive = months.read_months(spark, archive_path).drop("ym")
    cold = settle(mutations.cold_rows(archive, days, as_of), "cold-rows")
    texts = cold.withColumn("tags", F.to_json("tags"))
    files.write_csv_gz(texts, target)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)
    exported, expected = files.read_csv(spark, target, schema, multiLine="true").count(), cold.count()
    if exported != expected:
        raise RuntimeError(f"export holds {exported} of {expected} rows, the archive stays as it is")
    touched = months.months_of(cold)
    if touched:
        warm = mutations.warm_rows(months.read_months(spark, archive_path, months=touched).drop("ym"), days, as_of)
        months.replace_months(warm, archive_path, touched)
    kept = months.read_months(spark, archive_path)
    return kept.agg(F.count(F.lit(1)).alias("kept")).withColumn("exported", F.lit(exported).cast("bigint"))


def refresh_stats(spark: SparkSession, records: DataFrame, root: str, as_of: datetime | str | Column) -> int:
    """Rebuild the hourly table as a new version; when it fails, readers keep the old one."""
    return versions.write_version(analytics.hourly_stats(records, as_of), root)


def _numbers(spark: SparkSession, path: str, column: str) -> list[int]:
    """The numbers of the complete folders ``column=n``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    disk = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in disk.listStatus(where)] if disk.exists(where) else []
    done = lambda name: disk.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS"))
    return sorted(int(n.removeprefix(f"{column}=")) for n in names if n.startswith(f"{column}=") and done(n))


def log_change(log: str, change_id: int, before: DataFrame, after: DataFrame) -> None:
    """Keep the signed rows of a change for the next refresh. A change that is logged already stays as it is."""
    if change_id not in _numbers(after.sparkSession, log, "change_id"):
        rows = deltas.row_changes(before, after)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{log}/change_id={change_id}")


def change_records(
    spark: SparkSession, path: str, log: str, change_id: int, ids: DataFrame, change: Callable[[DataFrame], DataFrame]
) -> None:
    """Change the rows named by ``ids`` in their months and log the difference. ``change`` leaves ids and times alone and may run twice.

    The log comes first, so a job that stops in between finishes the table in a second run and logs nothing more.
    """
    with scratch(spark):
        before = settle(months.read_months(spark, path).drop("ym").join(ids.select("id").distinct(), "id", "left_semi"), "rows-before")
        after = settle(change(before), "rows-after")
        log_change(log, change_id, before, after)
        touched = months.months_of(before)
        if touched:
            rest = months.read_months(spark, path, months=touched).drop("ym").join(before.select("id"), "id", "left_anti")
            months.replace_months(rest.select(*after.columns).unionByName(after), path, touched)


def refresh_hours(spark: SparkSession, records_path: str, parts_path: str, log: str) -> list[str]:
    """Bring the hourly parts up to the newest logged change; returns the months that were read and rewritten.

    A month notes the last change it holds, so a refresh that stopped half-way goes on where it was.
    """
    newest = max(_numbers(spark, log, "change_id"), default=0)
    runs = f"{parts_path}-refreshed"
    last = max(_numbers(spark, runs, "change_id"), default=0)
    if newest <= last:
        return []
    with scratch(spark):
        changes = spark.read.schema(f"{deltas.CHANGE}, change_id BIGINT").parquet(log).filter(F.col("change_id").between(last + 1, newest))
        touched = months.months_of(changes)
        stored = months.read_months(spark, parts_path, deltas.PARTS, touched)
        held = {r["ym"]: r["applied"] for r in stored.groupBy("ym").agg(F.max("applied").alias("applied")).collect()}
        for month, applied in held.items():
            changes = changes.filter((months.month_of("timestamp") != month) | (F.col("change_id") > applied))
        merged = settle(deltas.merged_parts(stored, deltas.delta_parts(changes)), "merged-parts")
        if not merged.filter("stale").isEmpty():
            merged = deltas.looked_up(merged, months.read_months(spark, records_path, months=touched))
        rest = stored.join(merged.select("hour", "source"), ["hour", "source"], "left_anti")
        parts = rest.select("hour", "source", *deltas.SUMS, "low", "high").unionByName(merged.drop("stale"))
        if touched:
            months.replace_months(parts.withColumn("applied", F.lit(newest).cast("bigint")), parts_path, touched, "hour")
    spark.range(0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{runs}/change_id={newest}")
    return touched


def read_hours(spark: SparkSession, parts_path: str) -> DataFrame:
    """The hourly table as of the last refresh."""
    return analytics.combine_hours(months.read_months(spark, parts_path, deltas.PARTS).filter("rows > 0"), with_list=True)


def refresh_positions(spark: SparkSession, index: positions.PositionIndex, log: str) -> None:
    """Bring the counts for deep pages up to the newest logged change."""
    index.refresh(log, max(_numbers(spark, log, "change_id"), default=0))
    index.merge()


def sketch_months(spark: SparkSession, records_path: str, sketches_path: str, touched: list[str]) -> None:
    """Sketch the values of months anew, after rows of them came, went or changed."""
    rows = months.read_months(spark, records_path, months=touched).drop("ym")
    months.replace_months(analytics.value_sketches(rows), sketches_path, touched, "month")


def extract_changes(spark: SparkSession, path: str, target: str, runs: str, as_of: datetime | str) -> int:
    """Append what changed in the records after the last run, up to ``as_of``, to ``target``, a folder per run; returns the number of rows.

    Only files that hold a change are read. The folder is written before the run is logged: a run that stopped in between is repeated
    from the same moment and replaces its folder. A logged run, or an earlier ``as_of``, extracts nothing more.
    """
    done = spark.read.parquet(runs) if _holds(spark, runs) else spark.createDataFrame([], "status STRING, completed_at TIMESTAMP_NTZ")
    last = reads.last_success(done).first()["last_run"]
    until = spark.range(1).select(instant(as_of).alias("t"), F.date_format(instant(as_of), "yyyyMMddHHmmssSSSSSS").alias("name")).first()
    if until["t"] <= last:
        return 0
    zone = zones.ZoneMap(spark, path)
    zone.note()
    changed = zone.changed_since(last).filter(F.col("updated_at") <= instant(as_of))
    folder = f"{target}/run={until['name']}"
    changed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
    rows = spark.read.schema(changed.schema).parquet(folder).count()
    log_run(spark, runs, "extract", as_of, rows)
    return rows


def _holds(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
