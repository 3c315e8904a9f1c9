"""Reads, pages, validation and lookups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.cursor import cursor_parts, cursor_text, encode_cursor
from ..functions.hashing import sha256_mod, short_hash
from ..functions.scalars import backoff_seconds, hour_of, iso_text, post_key
from ..operators import joins, quality, reads
from ..sources import tables
from ..sources.tables import table
from .registry import report, with_views
from .views import ACTIVE, CHECKED, COLUMNS, DOCS, EVENT_LOG, FIRST_EVENTS, IDS, JOB_RUNS, LEDGER, POSTS, RECORDS, REQUESTS, iso

AS_OF = "2024-02-01 00:00:00"
NEWEST = '(SELECT max("timestamp") FROM records)'
ON_RECORDS = with_views(RECORDS, ACTIVE)
ON_REQUESTS = with_views(REQUESTS, CHECKED)
ON_LEDGER = with_views(EVENT_LOG, FIRST_EVENTS, LEDGER)


@report("active_records", f"{ON_RECORDS} SELECT {COLUMNS} FROM active")
def active_records(spark, sf):
    return reads.active_only(tables.records(spark, sf))


@report("records_of_source", f"{ON_RECORDS} SELECT {COLUMNS} FROM active WHERE source = 'click'")
def records_of_source(spark, sf):
    return reads.by_source(reads.active_only(tables.records(spark, sf)), "click")


@report(
    "records_in_range",
    f"""{ON_RECORDS} SELECT {COLUMNS} FROM active
    WHERE "timestamp" >= TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-20 00:00:00'""",
)
def records_in_range(spark, sf):
    return reads.newest_first(reads.date_range(tables.records(spark, sf), "2024-01-05 00:00:00", "2024-01-20 00:00:00"))


@report("record_by_id", f"{ON_RECORDS} SELECT {COLUMNS} FROM active WHERE id = 42")
def record_by_id(spark, sf):
    return reads.by_id(tables.records(spark, sf), 42)


@report("records_by_ids", f"{with_views(RECORDS, ACTIVE, IDS)} SELECT {COLUMNS} FROM active WHERE id IN (SELECT id FROM requested)")
def records_by_ids(spark, sf):
    return reads.semi_by_ids(tables.records(spark, sf), tables.requested_ids(spark, sf))


@report(
    "missing_ids",
    f"""{with_views(RECORDS, ACTIVE, IDS)} SELECT id, min(position) AS position FROM requested
    WHERE id NOT IN (SELECT id FROM active) GROUP BY id""",
)
def missing_ids(spark, sf):
    return reads.missing_ids(tables.records(spark, sf), tables.requested_ids(spark, sf))


@report("distinct_requested_ids", f"{with_views(IDS)} SELECT id, min(position) AS position FROM requested GROUP BY id")
def distinct_requested_ids(spark, sf):
    return reads.dedupe_ids(tables.requested_ids(spark, sf))


@report("processed_records", f"{ON_RECORDS} SELECT {COLUMNS} FROM active WHERE processed")
def processed_records(spark, sf):
    return reads.by_processed(tables.records(spark, sf), True)


@report(
    "unprocessed_of_source",
    f"""{ON_RECORDS} SELECT {COLUMNS} FROM active WHERE NOT processed AND source = 'view'
    AND "timestamp" BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND {NEWEST} ORDER BY "timestamp" DESC, id DESC LIMIT 1000""",
)
def unprocessed_of_source(spark, sf):
    rows = tables.records(spark, sf)
    return reads.unprocessed_by_source(rows, "view", "2024-01-03 00:00:00", tables.newest(rows))


@report("records_of_last_week", f"""{ON_RECORDS} SELECT {COLUMNS} FROM active WHERE "timestamp" >= {NEWEST} - INTERVAL 168 HOUR""")
def records_of_last_week(spark, sf):
    rows = tables.records(spark, sf)
    return reads.recent(reads.active_only(rows), 168, tables.newest(rows))


@report(
    "response_rows",
    f"""{ON_RECORDS} SELECT id, source, "timestamp", raw_data, tags, processed, created_at, updated_at, deleted_at FROM active""",
)
def response_rows(spark, sf):
    return reads.to_response(reads.active_only(tables.records(spark, sf)))


@report("active_total", f"{ON_RECORDS} SELECT count(*) AS total FROM active")
def active_total(spark, sf):
    return reads.count_active(tables.records(spark, sf))


@report("offset_page", f"{ON_RECORDS} SELECT {COLUMNS} FROM active ORDER BY id LIMIT 50 OFFSET 200")
def offset_page(spark, sf):
    return reads.offset_page(tables.records(spark, sf), 200, 50)


@report("deep_offset_page", f"{ON_RECORDS} SELECT {COLUMNS} FROM active ORDER BY id LIMIT 100 OFFSET 5000")
def deep_offset_page(spark, sf):
    return reads.offset_page(tables.records(spark, sf), 5000, 100)


@report("offset_page_meta", f"{ON_RECORDS} SELECT count(*) AS total, 250 < count(*) AS has_more FROM active")
def offset_page_meta(spark, sf):
    return reads.page_meta(tables.records(spark, sf), 200, 50)


@report(
    "keyset_page",
    f"""{ON_RECORDS}, page AS (
      SELECT *, ROW_NUMBER() OVER (ORDER BY "timestamp", id) AS pos FROM active
      WHERE "timestamp" > TIMESTAMP '2024-01-02 12:00:00' OR ("timestamp" = TIMESTAMP '2024-01-02 12:00:00' AND id > 5)
      ORDER BY "timestamp", id LIMIT 51)
    SELECT {COLUMNS}, (SELECT max(pos) FROM page) > 50 AS has_more,
      CASE WHEN pos = 50 AND (SELECT max(pos) FROM page) > 50
           THEN to_base64(CAST('{{"id":' || id || ',"timestamp":"' || {iso('"timestamp"')} || '"}}' AS BLOB)) END AS next_cursor
    FROM page WHERE pos <= 50""",
)
def keyset_page(spark, sf):
    return reads.keyset_page(tables.records(spark, sf), encode_cursor(5, datetime(2024, 1, 2, 12)), 50)


@report("cursor_round_trip", f"""{ON_RECORDS} SELECT id, "timestamp" FROM active""")
def cursor_round_trip(spark, sf):
    cursors = reads.active_only(tables.records(spark, sf)).select(cursor_text("id", "timestamp").alias("c"))
    return cursors.select(cursor_parts("c").alias("p")).select("p.*")


@report("tag_counts", f"""{ON_RECORDS} SELECT id, source, "timestamp", CAST(tag_count AS BIGINT) AS tag_count FROM active""")
def tag_counts(spark, sf):
    return reads.tag_counts(tables.records(spark, sf))


@report(
    "newest_tag_counts",
    f"""{ON_RECORDS} SELECT id, source, "timestamp", CAST(tag_count AS BIGINT) AS tag_count FROM active ORDER BY id DESC LIMIT 100""",
)
def newest_tag_counts(spark, sf):
    return reads.tag_counts(tables.records(spark, sf), 100)


@report("tags_exploded", f"{ON_RECORDS} SELECT id, source, unnest(string_split(tags, ',')) AS tag FROM active WHERE tags <> ''")
def tags_exploded(spark, sf):
    return reads.tags_exploded(tables.records(spark, sf))


@report("newest_records", f"""{ON_RECORDS} SELECT {COLUMNS} FROM active ORDER BY "timestamp" DESC, id DESC LIMIT 100""")
def newest_records(spark, sf):
    return reads.recent_records(tables.records(spark, sf), 100)


@report("last_record", f"{with_views(RECORDS)} SELECT id, source, created_at FROM records ORDER BY created_at DESC, id DESC LIMIT 1")
def last_record(spark, sf):
    return reads.last_record(tables.records(spark, sf))


@report("failed_events", f"{ON_LEDGER} SELECT * FROM ledger WHERE status = 'failed' ORDER BY id LIMIT 100")
def failed_events(spark, sf):
    return reads.events_by_status(tables.ledger(spark, sf), "failed", 100)


@report("dead_letter_events", f"{ON_LEDGER} SELECT * FROM ledger WHERE dead_letter_queue ORDER BY created_at DESC, id DESC LIMIT 100")
def dead_letter_events(spark, sf):
    return reads.dead_letter_events(tables.ledger(spark, sf), 100)


@report(
    "pending_events",
    f"""{ON_LEDGER} SELECT * FROM ledger WHERE kafka_topic = 'records.events' AND status = 'pending' AND deleted_at IS NULL
    AND created_at >= (SELECT max(created_at) FROM ledger) - INTERVAL 24 HOUR""",
)
def pending_events(spark, sf):
    rows = tables.ledger(spark, sf)
    return reads.pending_by_topic(rows, "records.events", tables.newest(rows, "created_at"))


@report(
    "modified_since_last_run",
    f"""{with_views(RECORDS, JOB_RUNS)} SELECT {COLUMNS} FROM records WHERE updated_at > (
      SELECT coalesce(max(CASE WHEN status = 'success' THEN started_at - INTERVAL 2 DAY END), TIMESTAMP '2000-01-01') FROM job_runs)""",
)
def modified_since_last_run(spark, sf):
    runs = tables.job_runs(spark, sf).withColumn("completed_at", F.col("started_at") - F.expr("INTERVAL '2' DAY"))
    return reads.modified_since(tables.records(spark, sf), reads.last_success(runs).scalar())


@report(
    "normalized_requests",
    f"{ON_REQUESTS} SELECT event_id, batch_id, source, stamp AS \"timestamp\", data, tags, parsed_at FROM checked",
)
def normalized_requests(spark, sf):
    return quality.normalize_requests(tables.record_requests(spark, sf), AS_OF)


@report("request_errors", f"{ON_REQUESTS} SELECT event_id, array_to_string(errs, ',') AS errors FROM checked")
def request_errors(spark, sf):
    return quality.validate_requests(tables.record_requests(spark, sf), AS_OF).select("event_id", "errors")


@report("valid_requests", f"{ON_REQUESTS} SELECT event_id, batch_id, source, parsed_at, data, tags FROM checked WHERE len(errs) = 0")
def valid_requests(spark, sf):
    checked = quality.validate_requests(tables.record_requests(spark, sf), AS_OF)
    valid, _ = quality.split_valid(checked, ["event_id", "source", "data"])
    return valid.select("event_id", "batch_id", "source", "parsed_at", "data", "tags")


@report(
    "quarantined_requests",
    f"""{ON_REQUESTS} SELECT event_id, array_to_string(errs, ',') AS errors,
      '{{"event_id":' || event_id || CASE WHEN source IS NULL THEN '' ELSE ',"source":"' || source || '"' END || '}}' AS original_row
    FROM checked WHERE len(errs) > 0""",
)
def quarantined_requests(spark, sf):
    checked = quality.validate_requests(tables.record_requests(spark, sf), AS_OF)
    _, rejected = quality.split_valid(checked, ["event_id", "source"])
    return rejected.select("event_id", "errors", "original_row")


@report(
    "clean_batches",
    f"""{ON_REQUESTS} SELECT event_id, event_id // 20 AS batch_id FROM checked
    WHERE event_id // 20 NOT IN (SELECT event_id // 20 FROM checked WHERE len(errs) > 0)""",
)
def clean_batches(spark, sf):
    checked = quality.validate_requests(tables.record_requests(spark, sf), AS_OF)
    batched = checked.withColumn("batch_id", F.floor(F.col("event_id") / 20))
    return quality.reject_whole_batches(batched).select("event_id", "batch_id")


@report(
    "batch_sizes",
    f"{with_views(REQUESTS)} SELECT batch_id, count(*) AS row_count, count(*) BETWEEN 1 AND 1000 AS size_ok FROM requests GROUP BY 1",
)
def batch_sizes(spark, sf):
    return quality.batch_sizes(tables.record_requests(spark, sf))


@report(
    "batch_ingest_summary",
    f"""{ON_REQUESTS} SELECT batch_id, count(*) FILTER (WHERE len(errs) = 0) AS inserted, count(*) FILTER (WHERE len(errs) > 0) AS errors,
      arg_min(array_to_string(errs, ','), event_id) FILTER (WHERE len(errs) > 0) AS first_error
    FROM checked GROUP BY batch_id""",
)
def batch_ingest_summary(spark, sf):
    return quality.batch_ingest_summary(quality.validate_requests(tables.record_requests(spark, sf), AS_OF), "event_id")


@report(
    "clean_parts",
    """SELECT p_partkey AS id, trim(p_name) AS name, coalesce(TRY_CAST(CASE WHEN p_size % 5 = 0 THEN 'free' ELSE
      CAST(p_retailprice AS VARCHAR) END AS DOUBLE), 0.0) AS price FROM part WHERE p_size % 7 <> 0""",
)
def clean_parts(spark, sf):
    raw = table(spark, sf, "part").select(
        F.expr("CASE WHEN p_size % 7 <> 0 THEN p_partkey END").alias("id"),
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("name"),
        F.expr("CASE WHEN p_size % 5 = 0 THEN 'free' ELSE CAST(p_retailprice AS STRING) END").alias("price"),
    )
    return quality.clean_transform(raw)


@report("priced_parts", "SELECT p_partkey, p_retailprice, round(p_retailprice * 1.1, 4) AS price_usd FROM part WHERE p_retailprice > 950")
def priced_parts(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    dear = quality.filter_above(parts, "p_retailprice", 950.0)
    return quality.add_computed(dear, "p_retailprice", "price_usd", 1.1).withColumn("price_usd", F.round("price_usd", 4))


ENRICHED = f"""{with_views(RECORDS, ACTIVE, IDS, POSTS)}, enriched AS (
  SELECT r.position, r.id AS record_id, CASE WHEN a.id IS NULL THEN 'unknown' ELSE a.source END AS source,
    CASE WHEN a.id IS NOT NULL THEN p.title END AS external_title, CASE WHEN a.id IS NOT NULL THEN p.body END AS external_body,
    a.id IS NOT NULL AND p.id IS NOT NULL AS enriched,
    CASE WHEN a.id IS NULL THEN 'Record ' || r.id || ' not found' WHEN p.id IS NULL THEN 'Post ' || r.k || ' not found' END AS error
  FROM (SELECT *, CASE WHEN id % 100 = 0 THEN 1 ELSE id % 100 END AS k FROM requested) r
  LEFT JOIN active a ON a.id = r.id LEFT JOIN posts p ON p.id = r.k)"""


@report("enriched_records", f"{ENRICHED} SELECT * FROM enriched")
def enriched_records(spark, sf):
    return joins.enrich_left_join(tables.requested_ids(spark, sf), tables.records(spark, sf), tables.posts(spark, sf))


@report(
    "enrichment_summary",
    f"""{ENRICHED} SELECT count(*) AS total, count(*) FILTER (WHERE enriched) AS enriched,
    count(*) FILTER (WHERE NOT enriched) AS failed FROM enriched""",
)
def enrichment_summary(spark, sf):
    return joins.enrich_summary(enriched_records(spark, sf))


@report(
    "customer_orders",
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON o_custkey = c_custkey""",
)
def customer_orders(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return joins.lookup_once(orders, customers, "c_custkey", "inner")


@report(
    "orders_per_customer",
    "SELECT c_custkey, c_name, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2",
)
def orders_per_customer(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return joins.left_join_count(customers, table(spark, sf, "orders"), "c_custkey", "o_custkey")


@report(
    "day_source_spine",
    f"""{with_views(RECORDS)} SELECT source, CAST(d AS DATE) AS day FROM (SELECT DISTINCT source FROM records),
    (SELECT unnest(generate_series(min(CAST("timestamp" AS DATE))::TIMESTAMP, max(CAST("timestamp" AS DATE))::TIMESTAMP, INTERVAL 1 DAY)) AS d
     FROM records)""",
)
def day_source_spine(spark, sf):
    return joins.date_spine(tables.records(spark, sf).select("source", "timestamp"), "source", "timestamp")


@report(
    "order_lookup",
    """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def order_lookup(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return joins.lookup_once(orders, customers, "c_custkey").drop("c_custkey")


@report(
    "scalar_columns",
    f"""{with_views(RECORDS)} SELECT id, date_trunc('hour', "timestamp")::TIMESTAMP AS hour, {iso('"timestamp"')} AS iso,
      CASE WHEN id % 100 = 0 THEN 1 ELSE id % 100 END AS post_id, value, nullif(value, 0) AS non_zero,
      least(pow(2, id % 8), 60.0) AS delay_seconds, upper(source) AS upper_source,
      CAST(length(raw_data) AS BIGINT) AS raw_length
    FROM records""",
)
def scalar_columns(spark, sf):
    from ..functions.scalars import number_at

    value = number_at("raw_data")
    return tables.records(spark, sf).select(
        "id", hour_of("timestamp").alias("hour"), iso_text("timestamp").alias("iso"), post_key("id").alias("post_id"),
        value.alias("value"), F.nullif(value, F.lit(0.0)).alias("non_zero"),
        backoff_seconds(F.col("id") % 8, 1.0, 60.0).alias("delay_seconds"), F.upper("source").alias("upper_source"),
        F.length("raw_data").cast("bigint").alias("raw_length"),
    )


@report(
    "text_hashes",
    """SELECT page_id, url, CAST((h % 95850) AS BIGINT) AS position FROM (
      SELECT page_id, url, (((a * 18446744073709551616::HUGEINT + b) % 95850 * 18446744073709551616::HUGEINT + c) % 95850
        * 18446744073709551616::HUGEINT + d) % 95850 AS h
      FROM (SELECT page_id, url,
        CAST(CAST('0x' || substr(sha256('0:' || url), 1, 16) AS UBIGINT) AS HUGEINT) % 95850 AS a,
        CAST(CAST('0x' || substr(sha256('0:' || url), 17, 16) AS UBIGINT) AS HUGEINT) AS b,
        CAST(CAST('0x' || substr(sha256('0:' || url), 33, 16) AS UBIGINT) AS HUGEINT) AS c,
        CAST(CAST('0x' || substr(sha256('0:' || url), 49, 16) AS UBIGINT) AS HUGEINT) AS d FROM pages))""",
)
def text_hashes(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return pages.withColumn("position", sha256_mod(F.concat(F.lit("0:"), "url"), 95850))


@report("short_text_hashes", "SELECT page_id, url, right(sha256(url), 6) AS hash FROM pages")
def short_text_hashes(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", short_hash("url").alias("hash"))
