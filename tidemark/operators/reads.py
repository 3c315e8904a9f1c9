"""Filters, lookups and pages over the records table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.cursor import cursor_text, decode_cursor
from ..functions.scalars import check_range, hours as hours_interval, instant
from ..schemas import TOP_HOURS


def active_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("deleted_at").isNull())


def register_active_view(df: DataFrame, name: str) -> None:
    """Expose the active rows of a table under a view name."""
    active_only(df).createOrReplaceTempView(name)


def by_source(df: DataFrame, source: str | None) -> DataFrame:
    return df if source is None else df.filter(F.col("source") == source)


def date_range(df: DataFrame, start: datetime | str, end: datetime | str, source: str | None = None) -> DataFrame:
    """Active rows with ``start <= timestamp < end``."""
    inside = (F.col("timestamp") >= instant(start)) & (F.col("timestamp") < instant(end))
    return by_source(active_only(df), source).filter(inside)


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("timestamp"), F.desc("id"))


def by_id(df: DataFrame, record_id: int) -> DataFrame:
    return active_only(df).filter(F.col("id") == record_id)


def semi_by_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Active rows whose id is requested."""
    return active_only(df).join(ids.select("id"), "id", "left_semi")


def missing_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Requested ids, each once at its first position, that no active row has."""
    return dedupe_ids(ids).join(active_only(df).select("id"), "id", "left_anti")


def dedupe_ids(ids: DataFrame) -> DataFrame:
    """Distinct ids with the position of their first request."""
    return ids.groupBy("id").agg(F.min("position").alias("position"))


def by_processed(df: DataFrame, flag: bool) -> DataFrame:
    return active_only(df).filter(F.col("processed") == F.lit(flag))


def unprocessed_by_source(
    df: DataFrame, source: str, start: datetime | str | Column, end: datetime | str | Column, limit: int = 1000
) -> DataFrame:
    """Newest unprocessed active rows of a source; both ends belong to the range."""
    inside = (F.col("timestamp") >= instant(start)) & (F.col("timestamp") <= instant(end))
    return newest_first(by_source(by_processed(df, False), source).filter(inside)).limit(limit)


def recent(
    df: DataFrame, hours: int, as_of: datetime | str | Column, bounds: tuple[int, int] = TOP_HOURS, column: str = "timestamp"
) -> DataFrame:
    """Rows not older than ``hours`` before ``as_of``."""
    check_range("hours", hours, bounds)
    return df.filter(F.col(column) >= instant(as_of) - hours_interval(hours))


def to_response(df: DataFrame) -> DataFrame:
    """Public columns; the processing time is not part of them."""
    return df.select("id", "source", "timestamp", "raw_data", "tags", "processed", "created_at", "updated_at", "deleted_at")


def count_active(df: DataFrame, source: str | None = None) -> DataFrame:
    return by_source(active_only(df), source).agg(F.count(F.lit(1)).alias("total"))


def offset_page(df: DataFrame, skip: int, limit: int, source: str | None = None) -> DataFrame:
    """Page by position in id order, at any depth. The work grows with ``skip``; ``keyset_page`` has no such cost."""
    return by_source(active_only(df), source).orderBy("id").offset(skip).limit(limit)


def page_meta(df: DataFrame, skip: int, limit: int, source: str | None = None) -> DataFrame:
    """``total`` and ``has_more`` that go with an offset page."""
    return count_active(df, source).select("total", (F.lit(skip + limit) < F.col("total")).alias("has_more"))


def keyset_page(df: DataFrame, cursor: str | None, limit: int, source: str | None = None) -> DataFrame:
    """Page after a cursor in ``(timestamp, id)`` order, each row with its cursor and ``has_more``.

    One row more than the page is read; it only decides ``has_more``. An invalid cursor means the first page.
    """
    rows = by_source(active_only(df), source)
    position = decode_cursor(cursor)
    if position:
        last_id, last_ts = position
        after = F.col("timestamp") > instant(last_ts)
        same = (F.col("timestamp") == instant(last_ts)) & (F.col("id") > last_id)
        rows = rows.filter((F.col("timestamp") >= instant(last_ts)) & (after | same))
    fetched = rows.orderBy("timestamp", "id").limit(limit + 1)
    order = Window.orderBy("timestamp", "id")
    everything = Window.partitionBy(F.lit(1))
    return (
        fetched.withColumn("_pos", F.row_number().over(order))
        .withColumn("has_more", F.max("_pos").over(everything) > limit)
        .filter(F.col("_pos") <= limit)
        .withColumn("next_cursor", F.when(F.col("has_more") & (F.col("_pos") == limit), cursor_text("id", "timestamp")))
        .drop("_pos")
    )


def tag_counts(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Number of tags per active row, newest ids first."""
    rows = active_only(df).select("id", "source", "timestamp", F.greatest(F.size("tags"), F.lit(0)).alias("tag_count"))
    return rows if limit is None else rows.orderBy(F.desc("id")).limit(limit)


def tags_exploded(df: DataFrame) -> DataFrame:
    """One row per tag of the active rows."""
    return active_only(df).select("id", "source", F.explode("tags").alias("tag"))


def recent_records(df: DataFrame, limit: int, source: str | None = None) -> DataFrame:
    check_range("limit", limit, (1, 100))
    return newest_first(by_source(active_only(df), source)).limit(limit)


def stats_latest(stats: DataFrame, limit: int) -> DataFrame:
    check_range("limit", limit, (1, 168))
    return stats.orderBy(F.desc("hour")).limit(limit)


def events_by_status(ledger: DataFrame, status: str, limit: int) -> DataFrame:
    return ledger.filter(F.col("status") == status).orderBy("id").limit(limit)


def dead_letter_events(ledger: DataFrame, limit: int) -> DataFrame:
    return ledger.filter("dead_letter_queue").orderBy(F.desc("created_at"), F.desc("id")).limit(limit)


def pending_by_topic(ledger: DataFrame, topic: str, as_of: datetime | str | Column) -> DataFrame:
    """Pending events of a topic created in the last day, oldest first."""
    rows = ledger.filter((F.col("kafka_topic") == topic) & (F.col("status") == "pending"))
    return recent(active_only(rows), 24, as_of, column="created_at").orderBy("created_at", "id")


def last_record(df: DataFrame) -> DataFrame:
    """The newest row by creation time."""
    newest = F.max_by(F.struct("id", "source", "created_at"), F.struct("created_at", "id"))
    return df.agg(newest.alias("r")).select("r.*")


def tier_union(hot: DataFrame, archive: DataFrame) -> DataFrame:
    """One logical table over both tiers; a row present in both is taken from the hot tier."""
    only_archived = archive.join(hot.select("id", "timestamp"), ["id", "timestamp"], "left_anti")
    return hot.withColumn("tier", F.lit("hot")).unionByName(
        only_archived.select(*hot.columns).withColumn("tier", F.lit("archive"))
    )


def tier_overlap(hot: DataFrame, archive: DataFrame) -> DataFrame:
    """Rows that both tiers hold; empty when the tiers are disjoint."""
    return archive.join(hot.select("id", "timestamp"), ["id", "timestamp"], "left_semi")


def modified_since(df: DataFrame, last_run: datetime | str | Column, column: str = "updated_at") -> DataFrame:
    return df.filter(F.col(column) > instant(last_run))


def last_success(runs: DataFrame) -> DataFrame:
    """Completion time of the newest successful run, or 2000-01-01 when there is none."""
    done = F.max(F.when(F.col("status") == "success", F.col("completed_at")))
    return runs.agg(F.coalesce(done, instant("2000-01-01 00:00:00")).alias("last_run"))
