"""Changes to the records table as pure functions ``(table, change set) -> new table``.

The caller writes the result as a new version (``sources.versions``) or by dynamic partition overwrite.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import days as days_interval, instant, month_of
from ..session import settle
from .reads import active_only
from .spread import running_position, salted_join

KEY = ["source", "timestamp"]


def _marked(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The table with ``_hit`` set on the rows named by ``ids``."""
    return table.join(ids.select("id").distinct().withColumn("_hit", F.lit(True)), "id", "left").withColumn(
        "_hit", F.coalesce("_hit", F.lit(False))
    )


def next_ids(table: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """Ids for new rows: they continue after the largest stored id, in ``order``."""
    highest = table.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    numbered = running_position(incoming, order, out="_n")
    return numbered.withColumn("_highest", highest).withColumn("id", F.col("_highest") + F.col("_n")).drop("_n", "_highest")


def _new_rows(table: DataFrame, incoming: DataFrame, order: str, as_of: datetime | str | Column) -> DataFrame:
    now = instant(as_of)
    return next_ids(table, incoming, order).select(
        "id", "source", "timestamp", "raw_data", "tags",
        F.lit(False).alias("processed"), F.lit(None).cast("timestamp_ntz").alias("processed_at"),
        now.alias("created_at"), now.alias("updated_at"), F.lit(None).cast("timestamp_ntz").alias("deleted_at"),
    )


def insert_records(table: DataFrame, incoming: DataFrame, order: str, as_of: datetime | str | Column) -> DataFrame:
    """Append rows ``(source, timestamp, raw_data, tags)`` with ids, defaults and audit columns."""
    return table.unionByName(_new_rows(table, incoming, order, as_of))


def resolve_upsert(table: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """The outcome for every incoming row: ``created``, ``existing`` or ``conflict_deleted``, and the row id.

    The first arrival of a key wins. Keys are reduced to one row each before they meet the table; the way back
    to the incoming rows is salted, because one key may cover a large part of them. A key held by a
    soft-deleted row still counts as taken. A row without a source or a time cannot be stored: its outcome is
    ``invalid`` and it has no id.
    """
    firsts = incoming.dropna(subset=KEY).groupBy(*KEY).agg(F.min(order).alias("_first"))
    taken = table.select(*KEY, F.col("id").alias("_taken_id"), F.col("deleted_at").isNotNull().alias("_gone"))
    matched = settle(firsts.join(taken, KEY, "left"), "matched-keys")
    created = next_ids(table, matched.filter(F.col("_taken_id").isNull()), "_first").select(*KEY, "_first", "id", F.lit("created").alias("_state"))
    stored = matched.filter(F.col("_taken_id").isNotNull()).select(
        *KEY, "_first", F.col("_taken_id").alias("id"), F.when(F.col("_gone"), "conflict_deleted").otherwise("existing").alias("_state")
    )
    resolved = created.unionByName(stored)
    later = (F.col("_state") == "created") & (F.col(order) != F.col("_first"))
    return (
        salted_join(incoming, resolved, KEY, "left", salt_by=F.col(order))
        .withColumn("outcome", F.when(later, F.lit("existing")).otherwise(F.coalesce("_state", F.lit("invalid"))))
        .withColumnRenamed("id", "record_id")
        .drop("_first", "_state")
    )


def upsert_records(table: DataFrame, incoming: DataFrame, order: str, as_of: datetime | str | Column) -> DataFrame:
    """The table after an idempotent upsert: only keys that nobody holds are added, rows without a whole key are not."""
    return table.unionByName(added_records(table, table, incoming, order, as_of))


def added_records(table: DataFrame, held: DataFrame, incoming: DataFrame, order: str, as_of: datetime | str | Column) -> DataFrame:
    """The rows an upsert adds. ``held`` is the part of the table that may hold an incoming key, such as its months."""
    columns = ["raw_data", "tags"]
    firsts = incoming.dropna(subset=KEY).groupBy(*KEY).agg(F.min_by(F.struct(*columns), order).alias("_r"), F.min(order).alias("_first"))
    fresh = firsts.join(held.select(*KEY), KEY, "left_anti").select(*KEY, "_r.*", "_first")
    return _new_rows(table, fresh, "_first", as_of)


def strict_conflicts(resolved: DataFrame) -> DataFrame:
    """Conflict rows of a strict upsert."""
    message = F.format_string(
        "A record with source='%s' and timestamp=%s already exists.", F.col("source"), F.col("timestamp").cast("string")
    )
    return resolved.filter(~F.col("outcome").isin("created", "invalid")).select(
        "source", "timestamp", F.lit("conflict").alias("error"), message.alias("message"), F.col("record_id").alias("existing_id")
    )


def unique_violations(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def mark_processed(table: DataFrame, ids: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Set the flag; the first processing time stays. Soft-deleted rows are changed too."""
    now = instant(as_of)
    return (
        _marked(table, ids)
        .withColumn("processed", F.col("processed") | F.col("_hit"))
        .withColumn("processed_at", F.when(F.col("_hit"), F.coalesce("processed_at", now)).otherwise(F.col("processed_at")))
        .withColumn("updated_at", F.when(F.col("_hit"), now).otherwise(F.col("updated_at")))
        .select(*table.columns)
    )


def partial_update(table: DataFrame, changes: DataFrame, as_of: datetime | str | Column, order: str | None = None) -> DataFrame:
    """Non-null fields of ``changes`` override; soft-deleted rows are changed too.

    Of several changes of an id the last in ``order`` counts, without ``order`` the one with the largest fields.
    """
    fields = [c for c in changes.columns if c not in ("id", order)]
    change = F.struct(*fields)
    changes = changes.groupBy("id").agg(F.max_by(change, F.struct(order, change) if order else change).alias("_c")).select("id", "_c.*")
    renamed = changes.select("id", *[F.col(c).alias(f"_new_{c}") for c in fields], F.lit(True).alias("_hit"))
    joined = table.join(renamed, "id", "left")
    for field in fields:
        joined = joined.withColumn(field, F.coalesce(f"_new_{field}", field))
    return joined.withColumn("updated_at", F.when(F.col("_hit"), instant(as_of)).otherwise(F.col("updated_at"))).select(*table.columns)


def soft_delete(table: DataFrame, ids: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Mark active rows as deleted; rows deleted before keep their time."""
    now = instant(as_of)
    hit = F.col("_hit") & F.col("deleted_at").isNull()
    return (
        _marked(table, ids)
        .withColumn("updated_at", F.when(hit, now).otherwise(F.col("updated_at")))
        .withColumn("deleted_at", F.when(hit, now).otherwise(F.col("deleted_at")))
        .select(*table.columns)
    )


def soft_delete_report(table: DataFrame, ids: DataFrame) -> DataFrame:
    """What a soft delete does to each requested id."""
    state = table.select("id", F.when(F.col("deleted_at").isNull(), "deleted").otherwise("already_deleted").alias("_s"))
    return ids.select("id").distinct().join(state, "id", "left").select("id", F.coalesce("_s", F.lit("not_found")).alias("outcome"))


def hard_delete(table: DataFrame, ids: DataFrame) -> DataFrame:
    return table.join(ids.select("id"), "id", "left_anti")


def undelete(table: DataFrame, ids: DataFrame) -> DataFrame:
    return (
        _marked(table, ids)
        .withColumn("deleted_at", F.when(~F.col("_hit"), F.col("deleted_at")))
        .select(*table.columns)
    )


def backfill_processed_at(table: DataFrame) -> DataFrame:
    """Processed rows without a processing time take their creation time."""
    filled = F.when(F.col("processed"), F.coalesce("processed_at", "created_at")).otherwise(F.col("processed_at"))
    return table.withColumn("processed_at", filled)


def idempotent_load(table: DataFrame, incoming: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows that a conflict-ignoring load adds: the first of each key, when the table does not hold the key."""
    rest = [c for c in incoming.columns if c not in (*key, order)]
    firsts = incoming.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*key, "_r.*")
    return firsts.join(table.select(*key), key, "left_anti")


def older_than(column: str, days: int, as_of: datetime | str | Column) -> Column:
    return F.col(column) < instant(as_of) - days_interval(days)


def old_active(hot: DataFrame, days: int, as_of: datetime | str | Column) -> DataFrame:
    return active_only(hot).filter(older_than("created_at", days, as_of))


def to_archive(old: DataFrame, archive: DataFrame) -> DataFrame:
    """Old rows that the archive does not hold yet."""
    return old.join(archive.select("id", "timestamp"), ["id", "timestamp"], "left_anti").select(*old.columns)


def left_in_hot(hot: DataFrame, days: int, as_of: datetime | str | Column) -> DataFrame:
    """The hot table after the move: young rows, and deleted rows of any age."""
    moved = older_than("created_at", days, as_of) & F.col("deleted_at").isNull()
    return hot.filter(~F.coalesce(moved, F.lit(False)))


def cold_rows(archive: DataFrame, days: int, as_of: datetime | str | Column) -> DataFrame:
    return archive.filter(older_than("timestamp", days, as_of))


def warm_rows(archive: DataFrame, days: int, as_of: datetime | str | Column) -> DataFrame:
    return archive.filter(~F.coalesce(older_than("timestamp", days, as_of), F.lit(False)))


def purge_soft_deleted(table: DataFrame, days: int, as_of: datetime | str | Column) -> DataFrame:
    """The table without rows deleted longer ago than the grace period."""
    gone = F.col("deleted_at").isNotNull() & older_than("deleted_at", days, as_of)
    return table.filter(~gone)


def month_range(df: DataFrame, start: datetime | str, end: datetime | str, column: str = "timestamp") -> DataFrame:
    """``start <= column < end`` on a table partitioned by ``ym``.

    The month bounds are added as a filter on the partition column, which prunes whole months at planning.
    """
    low, high = instant(start), instant(end)
    months = (F.col("ym") >= month_of(low)) & (F.col("ym") <= month_of(high))
    return df.filter(months & (F.col(column) >= low) & (F.col(column) < high))


def upsert_points(points: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """Vector points after writing ``incoming`` (last write per id wins)."""
    rest = [c for c in incoming.columns if c not in ("id", order)]
    last = incoming.groupBy("id").agg(F.max_by(F.struct(*rest), order).alias("_r")).select("id", "_r.*")
    return points.join(last.select("id"), "id", "left_anti").unionByName(last)


def delete_points(points: DataFrame, ids: DataFrame) -> DataFrame:
    return points.join(ids.select("id"), "id", "left_anti")
