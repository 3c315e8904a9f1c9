"""Streams run to the end of their input; the result is what a batch over the same rows gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events
from ..schemas import EVENTS
from ..session import fresh_path
from ..sources import tables
from ..streaming import flows, offset_log, sources, stateful
from .registry import report, with_views
from .event_reports import TTL_FOLD
from .metric_reports import SLIDING_FOLD, TOKEN_FOLD
from .views import ACTIVE, EVENT_LOG, RECORDS

ON_LOG = with_views(EVENT_LOG)
ROWS_PER_BATCH = 4_000_000


def _landed_log(spark, sf) -> str:
    """The topic as files, in the order of its offsets."""
    path = fresh_path(spark, "log")
    log = tables.event_log(spark, sf).withColumnRenamed("idempotency_key", "key")
    log.select("topic", "part", "off", "key", "ts", "value").repartitionByRange(4, "ts").write.parquet(path)
    return path


def _event_stream(spark, sf):
    return sources.table_stream(spark, sf, EVENTS, pattern="events.parquet")


def _consumed(spark, sf) -> str:
    out = fresh_path(spark, "consumed")
    log = sources.file_log(spark, _landed_log(spark, sf), files_per_batch=2)
    sources.run_available(flows.consume(log, out, f"{out}-checkpoint"))
    return out


@report("streamed_events", f"{ON_LOG} SELECT topic, part, off, event_type, payload FROM event_log WHERE error IS NULL")
def streamed_events(spark, sf):
    return flows.read_events(spark, _consumed(spark, sf)).select("topic", "part", "off", "event_type", "payload")


@report(
    "streamed_dead_letters",
    f"""{ON_LOG} SELECT topic AS source_topic, part AS source_partition, off AS source_offset, error AS reason, value AS original
    FROM event_log WHERE error IS NOT NULL""",
)
def streamed_dead_letters(spark, sf):
    return flows.read_dead_letters(spark, _consumed(spark, sf))


@report("streamed_ledger", f"{ON_LOG} SELECT DISTINCT idempotency_key, 'pending' AS status FROM event_log WHERE error IS NULL")
def streamed_ledger(spark, sf):
    """Keys of the ledger rows that the stream of the topic has added, each once."""
    out = fresh_path(spark, "ledger")
    log = sources.file_log(spark, _landed_log(spark, sf), files_per_batch=1)
    sources.run_available(flows.consume_to_ledger(log, out, f"{out}-checkpoint", "2024-02-01 00:00:00"))
    return flows.read_ledger(spark, out).select("idempotency_key", "status")


@report("streamed_offsets", f"{ON_LOG} SELECT topic, part, max(off) AS last_offset, count(*) AS n FROM event_log GROUP BY 1, 2")
def streamed_offsets(spark, sf):
    """Offsets reached per partition by a stream whose positions are offsets, stopped half-way and taken up again."""
    path, out = fresh_path(spark, "offset-log"), fresh_path(spark, "consumed")
    log = tables.event_log(spark, sf).withColumnRenamed("idempotency_key", "key").select("topic", F.col("part").cast("int").alias("part"), "off", "key", "ts", F.col("value").cast("binary").alias("value"))
    half = log.agg(F.expr("max(off) div 2")).first()[0]
    for rows in (log.filter(F.col("off") <= half), log.filter(F.col("off") > half)):
        offset_log.land_log(rows, path, 1000)
        sources.run_available(flows.consume(offset_log.offset_log(spark, path, rows_a_segment=1000), out, f"{out}-checkpoint"))
    stored = spark.read.parquet(f"{out}/events")
    return stored.groupBy("topic", "part").agg(F.max("off").alias("last_offset"), F.count(F.lit(1)).alias("n"))


@report("streamed_first_keys", f"{ON_LOG} SELECT DISTINCT idempotency_key AS key FROM event_log")
def streamed_first_keys(spark, sf):
    """The files arrive in any order, so the watermark is longer than the data: every key comes out exactly once."""
    out = fresh_path(spark, "first-keys")
    log = sources.file_log(spark, _landed_log(spark, sf), files_per_batch=1)
    firsts = flows.first_by_key(log, "key", "ts", "60 days").select("key")
    writer = firsts.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
    sources.run_available(writer)
    return spark.read.parquet(out)


@report(
    "streamed_messages",
    f"""{with_views(RECORDS)} SELECT '{{"event_type":"record.created","payload":{{"record_id":' || id || ',"source":"' || source || '"}}}}'
    AS value FROM records""",
)
def streamed_messages(spark, sf):
    """Change events of inserted records, published by a stream."""
    out = fresh_path(spark, "messages")
    inserted = _event_stream(spark, sf).select(F.col("event_id").alias("id"), F.col("event_type").alias("source"))
    sources.run_available(sources.text_sink(events.record_created_events(inserted), out, f"{out}-checkpoint"))
    return spark.read.text(out)


@report(
    "streamed_hourly_stats",
    f"""{with_views(RECORDS, ACTIVE)} SELECT date_trunc('hour', "timestamp")::TIMESTAMP AS hour, count(*) AS record_count,
      count(*) FILTER (WHERE processed) AS processed_count, round(avg(coalesce(value, 0)), 4) AS avg_value, min(value) AS min_value,
      max(value) AS max_value, count(DISTINCT source) AS unique_sources,
      array_to_string(list_sort(list(DISTINCT source)), ',') AS source_list,
      round(count(*) FILTER (WHERE processed) / count(*) * 100, 2) AS processed_pct FROM active GROUP BY 1""",
)
def streamed_hourly_stats(spark, sf):
    landed = fresh_path(spark, "records")
    rows = tables.records(spark, sf)
    rows.repartitionByRange(4, "timestamp").sortWithinPartitions("timestamp").write.parquet(landed)
    out = fresh_path(spark, "hourly-parts")
    stream = sources.table_stream(spark, landed, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), 1)
    parts = flows.hourly_parts_stream(stream, lateness="60 days")
    sources.run_available(flows.upsert_batches(parts, out, f"{out}-checkpoint", ["hour", "source"], "hour"))
    return flows.read_hourly_stats(spark, out)


@report(
    "streamed_order_summary",
    """SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS day, count(*) AS order_count,
    CAST(sum(CAST(o_totalprice AS DECIMAL(20, 2))) AS DOUBLE) AS total_amount FROM orders GROUP BY 1, 2""",
)
def streamed_order_summary(spark, sf):
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    orders = sources.table_stream(spark, sf, schema, pattern="orders.parquet")
    out = fresh_path(spark, "order-summary")
    summary = flows.order_summary_stream(orders, "o_custkey", "o_orderdate", "o_totalprice", "4000 days")
    sources.run_available(flows.upsert_batches(summary, out, f"{out}-checkpoint", ["customer_id", "day"], "day"))
    return flows.latest_rows(spark, out)


@report(
    "streamed_metric_snapshot",
    """SELECT 'http_requests_total{type="' || event_type || '"}' AS name, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY event_type""",
)
def streamed_metric_snapshot(spark, sf):
    text = fresh_path(spark, "metric-text")
    counts = tables.table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    line = F.concat(F.lit('http_requests_total{type="'), "event_type", F.lit('"} '), F.col("n").cast("string"))
    counts.select(line.alias("value")).write.text(text)
    out = fresh_path(spark, "snapshots")
    sources.run_available(flows.snapshot_stream(spark.readStream.text(text), out, f"{out}-checkpoint", every=None))
    return spark.read.parquet(out).drop("batch_id")


def _request_stream(spark, sf):
    """The requests by time, ``ROWS_PER_BATCH`` in a micro-batch: the engine holds what a micro-batch brings of a key in one buffer."""
    landed = sources.land_in_order(tables.request_log(spark, sf), fresh_path(spark, "requests"), ["ts", "event_id"], ROWS_PER_BATCH)
    return sources.table_stream(spark, landed, "event_id BIGINT, key STRING, ts TIMESTAMP_NTZ", files_per_batch=1)


def _decided(spark, decided, label: str):
    """Writes a stateful stream to the end."""
    out = fresh_path(spark, label)
    writer = decided.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
    sources.run_available(writer)
    return spark.read.parquet(out)


@report("streamed_token_bucket", TOKEN_FOLD)
def streamed_token_bucket(spark, sf):
    decided = _decided(spark, stateful.token_bucket_stream(_request_stream(spark, sf)), "token-bucket")
    return decided.withColumn("remaining", F.round("remaining", 6)).withColumn("wait_seconds", F.round("wait_seconds", 5))


@report("streamed_sliding_window", SLIDING_FOLD)
def streamed_sliding_window(spark, sf):
    return _decided(spark, stateful.sliding_window_stream(_request_stream(spark, sf)), "sliding-window")


@report("streamed_within_ttl", TTL_FOLD)
def streamed_within_ttl(spark, sf):
    key = F.concat_ws(":", "event_type", (F.col("user_id") % 20).cast("string"))
    log = _event_stream(spark, sf).select("event_id", key.alias("key"), "ts")
    return _decided(spark, stateful.dedupe_ttl_stream(log, 6 * 3600), "within-ttl")


@report(
    "streamed_delivery_outcomes",
    f"""{ON_LOG}, tried AS (
      SELECT part, off, a AS attempt_no, error IS NULL AND (event_id + a) % 3 = 0 AS ok
      FROM event_log, LATERAL (SELECT unnest(generate_series(1, event_id % 7 + 1)) AS a)),
    runs AS (SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY part, off ORDER BY attempt_no
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM tried),
    counted AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY part, off, run ORDER BY attempt_no) AS k FROM runs)
    SELECT part, off, attempt_no, CASE WHEN ok THEN 'done' WHEN k % 3 = 0 THEN 'dead_letter' ELSE 'retry' END AS outcome,
      CASE WHEN ok THEN 0 ELSE (k - 1) % 3 + 1 END AS attempts FROM counted""",
)
def streamed_delivery_outcomes(spark, sf):
    rows = tables.deliveries(spark, sf).select("part", "off", "attempt_no", "ok")
    landed = fresh_path(spark, "deliveries")
    rows.write.parquet(landed)
    stream = sources.table_stream(spark, landed, "part INT, off BIGINT, attempt_no INT, ok BOOLEAN")
    return _decided(spark, stateful.retry_stream(stream), "delivery-outcomes")
