"""Explicit schemas and fixed limits; nothing in the library infers a schema."""

from __future__ import annotations

# Limits on requests and query arguments.
SOURCE_MIN_LENGTH = 1
SOURCE_MAX_LENGTH = 255
TAGS_MAX_COUNT = 10
BATCH_MIN_ROWS = 1
BATCH_MAX_ROWS = 1000
SUMMARY_HOURS = (1, 168)
TOP_HOURS = (1, 2160)
TOP_ROWS = (1, 50)
STATS_BUCKETS = (1, 168)
SEARCH_ROWS = (1, 100)
SCRAPE_ROWS = (1, 100)
MAX_DELIVERIES = 3
TOKEN_CAPACITY = 20
TOKEN_REFILL_PER_SECOND = 10 / 60
SLIDING_LIMIT = 10
SLIDING_SECONDS = 60
FIXED_LIMIT = 1000
DEDUPE_TTL_SECONDS = 3600
EMBEDDING_DIM = 384
BLOOM_CAPACITY = 10_000
BLOOM_ERROR_RATE = 0.01
LAG_WARNING = 1000
LAG_CRITICAL = 5000

# Addresses that are not accepted as a source (compared in lower case).
RESERVED_SOURCES = ["localhost", "127.0.0.1", "::1", "0.0.0.0", "::"]

# States.
EVENT_STATUSES = ["pending", "processing", "completed", "failed", "dead_letter"]
TASK_STATUSES = ["queued", "running", "succeeded", "failed", "cancelled"]

# Upper bounds of the histogram buckets.
BATCH_SIZE_BUCKETS = [1, 5, 10, 25, 50, 100, 250, 500, 1000]
ENRICH_SECONDS_BUCKETS = [0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
JOB_SECONDS_BUCKETS = [0.1, 0.5, 1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0]

# Topics and event types.
RECORDS_TOPIC = "records.events"
SCRAPED_TOPIC = "scraped.events"
DEAD_LETTER_TOPIC = "records.events.dlq"
RECORD_CREATED = "record.created"
DOC_SCRAPED = "doc.scraped"

# Sources of the synthetic records, in turn.
SYNTHETIC_SOURCES = ["sensor-alpha", "sensor-beta", "api-ingest", "etl-pipeline", "webhook-receiver"]
SYNTHETIC_BATCH_ROWS = 1000

# Names the metrics snapshot keeps.
SNAPSHOT_METRICS = ["http_requests_total", "records_created_total", "http_responses_total"]


# Table schemas as DDL.
RECORDS = (
    "id BIGINT, source STRING, timestamp TIMESTAMP_NTZ, raw_data STRING, tags ARRAY<STRING>, processed BOOLEAN, "
    "processed_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, deleted_at TIMESTAMP_NTZ"
)
REQUESTS = "source STRING, timestamp STRING, data STRING, tags ARRAY<STRING>"
LEDGER = (
    "id BIGINT, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, idempotency_key STRING, "
    "event_type STRING, payload STRING, status STRING, processing_attempts INT, error_message STRING, "
    "error_details STRING, dead_letter_queue BOOLEAN, dlq_reason STRING, processed_at TIMESTAMP_NTZ, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, deleted_at TIMESTAMP_NTZ"
)
LOG = "topic STRING, part INT, off BIGINT, key STRING, ts TIMESTAMP_NTZ, value BINARY"
SCRAPED = "source STRING, url STRING, title STRING, content STRING, scraped_at TIMESTAMP_NTZ"
POSTS = "id BIGINT, title STRING, body STRING"
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
