"""Tables after a change, each compared as a whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import month_of
from ..operators import joins, mutations, quality
from ..session import fresh_path
from ..sources import files, months, positions, tables, versions
from ..sources.tables import table
from .registry import report, with_views
from .views import ACTIVE, CHECKED, COLUMNS, POINTS, RECORDS, REQUESTS

AS_OF = "2024-02-01 00:00:00"
STAMP = "TIMESTAMP '2024-02-01 00:00:00'"
NEWEST = '(SELECT max("timestamp") FROM records)'
ON_RECORDS = with_views(RECORDS, ACTIVE)
HIT = "source = 'click'"


def _clicks(rows):
    """The change set: ids of all rows of one source, active or not."""
    return rows.filter("source = 'click'").select("id")


def _changed(**changes: str) -> str:
    columns = ["id", "source", "timestamp", "raw_data", "tags", "processed", "processed_at", "created_at", "updated_at", "deleted_at"]
    listed = ", ".join(f'{changes[c]} AS {c}' if c in changes else f'"{c}"' for c in columns)
    return f"{ON_RECORDS} SELECT {listed} FROM records"


INCOMING = """
incoming AS (
  SELECT event_id AS arrival, source, parsed_at AS "timestamp", data AS raw_data, tags FROM checked WHERE len(errs) = 0
  UNION ALL SELECT 1000000000 + id, source, "timestamp", raw_data, tags FROM records WHERE value > 90)
"""
ON_INCOMING = with_views(RECORDS, ACTIVE, REQUESTS, CHECKED, INCOMING)
OUTCOMES = f"""{ON_INCOMING}, firsts AS (
  SELECT i.source, i."timestamp", min(arrival) AS first_arrival, any_value(r.id) AS taken, bool_or(r.deleted_at IS NOT NULL) AS gone
  FROM incoming i LEFT JOIN records r ON r.source = i.source AND r."timestamp" = i."timestamp" GROUP BY 1, 2),
numbered AS (
  SELECT *, CASE WHEN taken IS NULL THEN (SELECT max(id) FROM records) +
    ROW_NUMBER() OVER (PARTITION BY taken IS NULL ORDER BY first_arrival) ELSE taken END AS record_id FROM firsts),
outcomes AS (
  SELECT i.arrival, i.source, i."timestamp", i.raw_data, i.tags, n.record_id,
    CASE WHEN n.gone THEN 'conflict_deleted' WHEN n.taken IS NOT NULL OR i.arrival <> n.first_arrival THEN 'existing' ELSE 'created' END AS outcome
  FROM incoming i JOIN numbered n ON n.source = i.source AND n."timestamp" = i."timestamp")"""


def _incoming(spark, sf):
    """Valid requests, most with the same key, and repeats of stored records, some of them deleted."""
    valid, _ = quality.split_valid(quality.validate_requests(tables.record_requests(spark, sf), AS_OF), ["event_id"])
    requests = valid.select(
        F.col("event_id").alias("arrival"), "source", F.col("parsed_at").alias("timestamp"), F.col("data").alias("raw_data"), "tags"
    )
    repeats = tables.records(spark, sf).filter(F.get_json_object("raw_data", "$.value").try_cast("double") > 90)
    return requests.unionByName(repeats.select((F.col("id") + 1_000_000_000).alias("arrival"), "source", "timestamp", "raw_data", "tags"))


@report(
    "inserted_records",
    f"""{ON_INCOMING} SELECT {COLUMNS} FROM records UNION ALL
    SELECT (SELECT max(id) FROM records) + ROW_NUMBER() OVER (ORDER BY arrival), source, "timestamp", raw_data, tags, FALSE, NULL,
      {STAMP}, {STAMP}, NULL FROM incoming""",
)
def inserted_records(spark, sf):
    return mutations.insert_records(tables.records(spark, sf), _incoming(spark, sf), "arrival", AS_OF)


@report("upsert_outcomes", f"{OUTCOMES} SELECT * FROM outcomes")
def upsert_outcomes(spark, sf):
    return mutations.resolve_upsert(tables.records(spark, sf), _incoming(spark, sf), "arrival")


@report(
    "upserted_records",
    f"""{OUTCOMES} SELECT {COLUMNS} FROM records UNION ALL
    SELECT record_id, source, "timestamp", raw_data, tags, FALSE, NULL, {STAMP}, {STAMP}, NULL FROM outcomes WHERE outcome = 'created'""",
)
def upserted_records(spark, sf):
    return mutations.upsert_records(tables.records(spark, sf), _incoming(spark, sf), "arrival", AS_OF)


@report(
    "strict_conflicts",
    f"""{OUTCOMES} SELECT source, "timestamp", 'conflict' AS error, 'A record with source=''' || source || ''' and timestamp=' ||
      CAST("timestamp" AS VARCHAR) || ' already exists.' AS message, record_id AS existing_id FROM outcomes WHERE outcome <> 'created'""",
)
def strict_conflicts(spark, sf):
    return mutations.strict_conflicts(mutations.resolve_upsert(tables.records(spark, sf), _incoming(spark, sf), "arrival"))


@report(
    "new_incoming",
    f"""{ON_INCOMING} SELECT arrival, source, "timestamp" FROM incoming i WHERE NOT EXISTS (
      SELECT 1 FROM records r WHERE r.source = i.source AND r."timestamp" = i."timestamp")""",
)
def new_incoming(spark, sf):
    return joins.new_keys(_incoming(spark, sf), tables.records(spark, sf), ["source", "timestamp"]).select("arrival", "source", "timestamp")


@report(
    "known_incoming",
    f"""{ON_INCOMING} SELECT arrival, source, "timestamp", r.id AS existing_id FROM incoming i JOIN records r USING (source, "timestamp")""",
)
def known_incoming(spark, sf):
    known = joins.known_keys(_incoming(spark, sf), tables.records(spark, sf), ["source", "timestamp"])
    return known.select("arrival", "source", "timestamp", "existing_id")


@report(
    "duplicate_keys",
    f"""{ON_INCOMING} SELECT source, "timestamp", count(*) AS n FROM incoming GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf):
    return mutations.unique_violations(_incoming(spark, sf), ["source", "timestamp"])


@report(
    "records_marked_processed",
    _changed(
        processed=f"processed OR {HIT}", processed_at=f"CASE WHEN {HIT} THEN coalesce(processed_at, {STAMP}) ELSE processed_at END",
        updated_at=f"CASE WHEN {HIT} THEN {STAMP} ELSE updated_at END",
    ),
)
def records_marked_processed(spark, sf):
    rows = tables.records(spark, sf)
    return mutations.mark_processed(rows, _clicks(rows), AS_OF)


@report(
    "records_updated",
    _changed(
        raw_data=f"CASE WHEN {HIT} AND processed THEN '{{\"value\": 1}}' ELSE raw_data END",
        tags=f"CASE WHEN {HIT} THEN 'changed' ELSE tags END", updated_at=f"CASE WHEN {HIT} THEN {STAMP} ELSE updated_at END",
    ),
)
def records_updated(spark, sf):
    rows = tables.records(spark, sf)
    changes = rows.filter(HIT).select(
        "id", F.when(F.col("processed"), '{"value": 1}').alias("raw_data"), F.array(F.lit("changed")).alias("tags")
    )
    return mutations.partial_update(rows, changes, AS_OF)


@report(
    "records_soft_deleted",
    _changed(
        deleted_at=f"CASE WHEN {HIT} THEN coalesce(deleted_at, {STAMP}) ELSE deleted_at END",
        updated_at=f"CASE WHEN {HIT} AND deleted_at IS NULL THEN {STAMP} ELSE updated_at END",
    ),
)
def records_soft_deleted(spark, sf):
    rows = tables.records(spark, sf)
    return mutations.soft_delete(rows, _clicks(rows), AS_OF)


@report(
    "soft_delete_report",
    f"""{with_views(RECORDS)} SELECT DISTINCT e.id, CASE WHEN r.id IS NULL THEN 'not_found' WHEN r.deleted_at IS NULL THEN 'deleted'
      ELSE 'already_deleted' END AS outcome
    FROM (SELECT (event_id // 2) * 3 AS id FROM events) e LEFT JOIN records r USING (id)""",
)
def soft_delete_report(spark, sf):
    return mutations.soft_delete_report(tables.records(spark, sf), tables.requested_ids(spark, sf))


@report("records_hard_deleted", f"{with_views(RECORDS)} SELECT {COLUMNS} FROM records WHERE NOT ({HIT})")
def records_hard_deleted(spark, sf):
    rows = tables.records(spark, sf)
    return mutations.hard_delete(rows, _clicks(rows))


@report("records_undeleted", _changed(deleted_at=f"CASE WHEN NOT ({HIT}) THEN deleted_at END"))
def records_undeleted(spark, sf):
    rows = tables.records(spark, sf)
    return mutations.undelete(rows, _clicks(rows))


@report("records_backfilled", _changed(processed_at="CASE WHEN processed THEN coalesce(processed_at, created_at) ELSE processed_at END"))
def records_backfilled(spark, sf):
    return mutations.backfill_processed_at(tables.records(spark, sf))


@report(
    "idempotent_load",
    f"""{ON_INCOMING} SELECT source, "timestamp", arg_min(raw_data, arrival) AS raw_data, arg_min(tags, arrival) AS tags FROM incoming i
    WHERE NOT EXISTS (SELECT 1 FROM records r WHERE r.source = i.source AND r."timestamp" = i."timestamp") GROUP BY 1, 2""",
)
def idempotent_load(spark, sf):
    return mutations.idempotent_load(tables.records(spark, sf), _incoming(spark, sf), ["source", "timestamp"], "arrival")


def _archive(rows):
    """An archive that already holds the oldest part."""
    return rows.filter("timestamp < TIMESTAMP_NTZ '2024-01-08 00:00:00'")


OLD = f"created_at < {NEWEST} - INTERVAL 10 DAY AND deleted_at IS NULL"


@report(
    "archive_additions",
    f"""{ON_RECORDS} SELECT {COLUMNS}, strftime("timestamp", '%Y%m') AS ym FROM records
    WHERE {OLD} AND NOT "timestamp" < TIMESTAMP '2024-01-08'""",
)
def archive_additions(spark, sf):
    rows = tables.records(spark, sf)
    moved = mutations.to_archive(mutations.old_active(rows, 10, tables.newest(rows)), _archive(rows))
    return moved.withColumn("ym", month_of("timestamp"))


@report("hot_after_archive", f"{ON_RECORDS} SELECT {COLUMNS} FROM records WHERE NOT ({OLD})")
def hot_after_archive(spark, sf):
    rows = tables.records(spark, sf)
    return mutations.left_in_hot(rows, 10, tables.newest(rows))


@report("purged_records", f"{ON_RECORDS} SELECT {COLUMNS} FROM records WHERE deleted_at IS NULL OR deleted_at >= {NEWEST} - INTERVAL 20 DAY")
def purged_records(spark, sf):
    rows = tables.records(spark, sf)
    return mutations.purge_soft_deleted(rows, 20, tables.newest(rows))


@report("warm_records", f"""{ON_RECORDS} SELECT {COLUMNS} FROM records WHERE NOT "timestamp" < {NEWEST} - INTERVAL 20 DAY""")
def warm_records(spark, sf):
    rows = tables.records(spark, sf)
    return mutations.warm_rows(rows, 20, tables.newest(rows))


@report(
    "cold_export",
    f"""{ON_RECORDS} SELECT id, source, "timestamp", raw_data, tags, processed FROM records WHERE "timestamp" < {NEWEST} - INTERVAL 20 DAY""",
)
def cold_export(spark, sf):
    """Cold rows through gzip CSV and back."""
    rows = tables.records(spark, sf)
    cold = mutations.cold_rows(rows, 20, tables.newest(rows)).select(
        "id", "source", "timestamp", "raw_data", F.concat_ws(",", "tags").alias("tags"), "processed"
    )
    path = fresh_path(spark, "cold-export")
    files.write_csv_gz(cold, path)
    schema = "id BIGINT, source STRING, timestamp TIMESTAMP_NTZ, raw_data STRING, tags STRING, processed BOOLEAN"
    return files.read_csv(spark, path, schema).withColumn("tags", F.coalesce("tags", F.lit("")))


@report(
    "archive_by_month",
    """SELECT strftime(l_shipdate, '%Y%m') AS ym, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem GROUP BY 1""",
)
def archive_by_month(spark, sf):
    """Rows written to monthly folders, counted from there."""
    path = fresh_path(spark, "archive")
    files.write_by_month(table(spark, sf, "lineitem").select("l_shipdate", "l_quantity"), path, "l_shipdate")
    stored = spark.read.schema("l_shipdate TIMESTAMP_NTZ, l_quantity DOUBLE, ym STRING").parquet(path)
    return stored.groupBy("ym").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@report(
    "archive_month_range",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-03-10' AND l_shipdate < TIMESTAMP '1998-02-05'""",
)
def archive_month_range(spark, sf):
    path = fresh_path(spark, "archive")
    files.write_by_month(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), path, "l_shipdate")
    stored = spark.read.schema("l_orderkey BIGINT, l_linenumber INT, l_shipdate TIMESTAMP_NTZ, ym STRING").parquet(path)
    return mutations.month_range(stored, "1997-03-10 00:00:00", "1998-02-05 00:00:00", "l_shipdate").drop("ym")


@report(
    "refreshed_stats",
    f"""{ON_RECORDS} SELECT date_trunc('hour', "timestamp")::TIMESTAMP AS hour, count(*) AS record_count,
      round(avg(coalesce(value, 0)), 4) AS avg_value, {NEWEST} AS materialized_at FROM active GROUP BY 1""",
)
def refreshed_stats(spark, sf):
    """The stored hourly table after a refresh that replaced an earlier version."""
    from ..operators.analytics import hourly_stats

    rows = tables.records(spark, sf)
    root = fresh_path(spark, "hourly-stats")
    versions.write_version(hourly_stats(rows.filter("processed"), tables.newest(rows)), root)
    versions.write_version(hourly_stats(rows, tables.newest(rows)), root)
    return versions.read_version(spark, root).select("hour", "record_count", "avg_value", "materialized_at")


@report(
    "refreshed_hours",
    f"""{with_views(RECORDS)}, active AS (
      SELECT *, CASE WHEN id % 19 = 2 THEN 500.0 ELSE value END AS now, processed OR id % 10 = 1 AS done
      FROM records WHERE id % 17 <> 3 AND (deleted_at IS NULL OR id % 22 = 0))
    SELECT date_trunc('hour', "timestamp")::TIMESTAMP AS hour, count(*) AS record_count, count(*) FILTER (WHERE done) AS processed_count,
      round(avg(coalesce(now, 0)), 4) AS avg_value, min(now) AS min_value, max(now) AS max_value, count(DISTINCT source) AS unique_sources,
      array_to_string(list_sort(list(DISTINCT source)), ',') AS source_list,
      round(count(*) FILTER (WHERE done) / count(*) * 100, 2) AS processed_pct FROM active GROUP BY 1""",
)
def refreshed_hours(spark, sf):
    """The hourly table after inserts, deletes, undeletes and updates, each followed by a refresh of what it touched."""
    from . import flows

    rows = tables.records(spark, sf)
    path, parts, log = months.new_table(spark, rows), fresh_path(spark, "hours"), fresh_path(spark, "changes")
    flows.log_change(log, 1, rows.limit(0), rows)
    flows.refresh_hours(spark, path, parts, log)
    now = tables.newest(rows)
    value = F.concat(F.lit('{"value": 500, "was": "'), F.col("id").cast("string"), F.lit('"}'))
    steps = [
        ("id % 17 = 3", lambda df: mutations.soft_delete(df, df.select("id"), now)),
        ("id % 22 = 0 AND id % 17 <> 3", lambda df: mutations.undelete(df, df.select("id"))),
        ("id % 10 = 1", lambda df: mutations.mark_processed(df, df.select("id"), now)),
        ("id % 19 = 2", lambda df: df.withColumn("raw_data", value)),
    ]
    for number, (which, change) in enumerate(steps, 2):
        flows.change_records(spark, path, log, number, rows.filter(which).select("id"), change)
        if number != 3:
            flows.refresh_hours(spark, path, parts, log)
    return flows.read_hours(spark, parts)


@report(
    "extracted_changes",
    f"""{with_views(RECORDS)} SELECT id, source, id % 10 = 4 OR processed AS processed, "timestamp",
      CASE WHEN id % 10 = 4 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE updated_at END AS updated_at,
      CAST(CASE WHEN id % 10 = 4 THEN 2 ELSE 1 END AS BIGINT) AS run
    FROM records UNION ALL SELECT id, source, processed, "timestamp", updated_at, 1 FROM records WHERE id % 10 = 4""",
)
def extracted_changes(spark, sf):
    """Two extracts: the whole table, then, from the files that hold a change, rows marked since."""
    from . import flows

    rows = tables.records(spark, sf)
    path, log, target, runs = months.new_table(spark, rows), *(fresh_path(spark, n) for n in ("changes", "extract", "extract-runs"))
    flows.extract_changes(spark, path, target, runs, "2024-02-20 00:00:00")
    mark = lambda df: mutations.mark_processed(df, df.select("id"), "2024-03-01 00:00:00")
    flows.change_records(spark, path, log, 1, rows.filter("id % 10 = 4").select("id"), mark)
    flows.extract_changes(spark, path, target, runs, "2024-03-02 00:00:00")
    number = F.when(F.col("run").cast("string") < "20240301", 1).otherwise(2)
    return spark.read.parquet(target).select("id", "source", "processed", "timestamp", "updated_at", number.alias("run"))


@report(
    "indexed_offset_page",
    f"""{with_views(RECORDS)} SELECT {COLUMNS.replace("updated_at, deleted_at", "updated_at")} FROM records
    WHERE deleted_at IS NULL AND id % 17 <> 3 ORDER BY id LIMIT 100 OFFSET 600""",
)
def indexed_offset_page(spark, sf):
    """A page behind 600 active rows after deletes, from the ranges of ids that the index names."""
    from . import flows

    rows = tables.records(spark, sf)
    path, log = months.new_table(spark, rows), fresh_path(spark, "changes")
    index = positions.PositionIndex(spark, fresh_path(spark, "positions"), width=512)
    flows.log_change(log, 1, rows.limit(0), rows)
    flows.refresh_positions(spark, index, log)
    gone = lambda df: mutations.soft_delete(df, df.select("id"), AS_OF)
    flows.change_records(spark, path, log, 2, rows.filter("id % 17 = 3").select("id"), gone)
    flows.refresh_positions(spark, index, log)
    return index.page(months.read_months(spark, path).drop("ym"), 600, 100).drop("deleted_at")


@report(
    "outliers_by_sketch",
    f"""{with_views(RECORDS)} SELECT id, source, "timestamp", value, processed, round(p, 4) AS percentile_rank FROM (
      SELECT id, source, "timestamp", coalesce(value, 0) AS value, processed,
        percent_rank() OVER (PARTITION BY source ORDER BY coalesce(value, 0) DESC) AS p FROM records
      WHERE deleted_at IS NULL AND id % 17 <> 3) WHERE p <= 0.05""",
)
def outliers_by_sketch(spark, sf):
    """The top twentieth of every source after deletes, from stored sketches of the archived and the hot months."""
    from ..operators import analytics
    from . import flows

    rows = tables.records(spark, sf)
    path, log, stored = months.new_table(spark, rows), fresh_path(spark, "changes"), fresh_path(spark, "value-sketches")
    flows.sketch_months(spark, path, stored, months.months_of(rows))
    gone = rows.filter("id % 17 = 3")
    flows.change_records(spark, path, log, 1, gone.select("id"), lambda df: mutations.soft_delete(df, df.select("id"), AS_OF))
    flows.sketch_months(spark, path, stored, months.months_of(gone))
    sketches = months.read_months(spark, stored, analytics.VALUE_SKETCHES)
    return analytics.percentile_outliers_over(months.read_months(spark, path).drop("ym"), sketches, 0.05)


@report(
    "estimated_readings",
    f"""{ON_RECORDS} SELECT count(DISTINCT raw_data) AS readings, true AS close FROM active
    WHERE "timestamp" >= TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-25 00:00:00'""",
)
def estimated_readings(spark, sf):
    """Distinct readings of a range from stored sketches of the hot and the archived hours, within three standard errors of the exact count."""
    from ..operators import analytics

    rows, path = tables.records(spark, sf), fresh_path(spark, "sketches")
    for tier in ("timestamp < '2024-01-15 00:30:00'", "timestamp >= '2024-01-15 00:30:00'"):
        months.append_months(analytics.distinct_sketches(rows.filter(tier), "raw_data"), path, "hour")
    stored = months.read_months(spark, path, analytics.SKETCHES)
    found = analytics.estimated_distinct(stored, "2024-01-05 00:00:00", "2024-01-25 00:00:00")
    exact = mutations.active_only(rows).filter("timestamp >= '2024-01-05' AND timestamp < '2024-01-25'").agg(F.count_distinct("raw_data").alias("n")).scalar()
    return found.withColumn("readings", exact).select("readings", (F.abs(F.col("estimate") - F.col("readings")) <= 0.05 * F.col("readings")).alias("close"))


@report(
    "upserted_points",
    f"""{with_views(POINTS)} SELECT id, CAST(CASE WHEN label < 5 THEN label + 100 ELSE label END AS BIGINT) AS label, round(vector[1], 6) AS first FROM points
    UNION ALL SELECT id + 1000000, label, round(vector[1], 6) FROM points WHERE label >= 5""",
)
def upserted_points(spark, sf):
    """Writes to known points (twice, the last one counts) and to new ones."""
    stored = tables.points(spark, sf)
    low = stored.filter("label < 5")
    fresh = stored.filter("label >= 5").withColumn("id", F.col("id") + 1_000_000)
    incoming = (
        low.withColumn("label", F.col("label") + 50).withColumn("seq", F.lit(1))
        .unionByName(low.withColumn("label", F.col("label") + 100).withColumn("seq", F.lit(2)))
        .unionByName(fresh.withColumn("seq", F.lit(3)))
    )
    changed = mutations.upsert_points(stored, incoming, "seq")
    return changed.select("id", "label", F.round(F.get("vector", F.lit(0)).cast("double"), 6).alias("first"))


@report("points_after_delete", f"{with_views(POINTS)} SELECT id, CAST(label AS BIGINT) AS label FROM points WHERE label <> 3")
def points_after_delete(spark, sf):
    stored = tables.points(spark, sf)
    return mutations.delete_points(stored, stored.filter("label = 3")).select("id", "label")


@report("points_total", "SELECT count(*) AS points FROM embeddings")
def points_total(spark, sf):
    return tables.points(spark, sf).agg(F.count(F.lit(1)).alias("points"))
