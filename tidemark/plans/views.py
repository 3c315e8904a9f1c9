"""The views of ``sources.tables`` in SQL, for checking."""

RECORDS = """
records AS (
  SELECT event_id AS id, event_type AS source, ts AS "timestamp",
    CASE WHEN event_id % 7 = 0 THEN '{"note": "no reading", "batch": ' || (event_id % 4) || '}'
         WHEN event_id % 97 = 0 THEN '{"value": "n/a"}'
         ELSE '{"value": ' || json_extract_string(props, '$.k') || ', "batch": ' || (event_id % 4) || '}' END AS raw_data,
    CASE WHEN event_id % 13 = 0 THEN '' ELSE 'tag-' || (event_id % 10) || ',bucket-' || (event_id % 5) END AS tags,
    CASE WHEN event_id % 13 = 0 THEN 0 ELSE 2 END AS tag_count,
    event_id % 3 = 0 AS processed,
    CASE WHEN event_id % 3 = 0 AND event_id % 5 <> 0 THEN ts + INTERVAL 1 MINUTE END AS processed_at,
    ts AS created_at, ts AS updated_at,
    CASE WHEN event_id % 11 = 0 THEN ts + INTERVAL 1 DAY END AS deleted_at,
    CASE WHEN event_id % 7 = 0 OR event_id % 97 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS value
  FROM events)
"""

ACTIVE = "active AS (SELECT * FROM records WHERE deleted_at IS NULL)"

COLUMNS = 'id, source, "timestamp", raw_data, tags, processed, processed_at, created_at, updated_at, deleted_at'

REQUESTS = """
requests AS (
  SELECT event_id, event_id % 100 AS batch_id,
    CASE WHEN event_id % 29 = 0 THEN 'LocalHost' WHEN event_id % 37 = 0 THEN ''
         WHEN event_id % 41 = 0 THEN NULL ELSE event_type END AS source,
    CASE WHEN event_id % 43 = 0 THEN 'not-a-time' WHEN event_id % 47 = 0 THEN '2999-01-01T00:00:00'
         WHEN event_id % 5 = 0 THEN NULL ELSE '2024-01-15T10:00:00+05:00' END AS stamp,
    CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN '[1,2]' ELSE props END AS data,
    CASE WHEN event_id % 61 = 0 THEN 't1,t2,t3,t4,t5,t6,t7,t8,t9,t10,t11'
         WHEN event_id % 2 = 0 THEN 'stock,nasdaq' ELSE '' END AS tags
  FROM events)
"""

CHECKED = """
checked AS (
  SELECT *, list_filter([
      CASE WHEN source IS NULL THEN 'source_missing' END,
      CASE WHEN length(source) < 1 OR length(source) > 255 THEN 'source_length' END,
      CASE WHEN lower(source) IN ('localhost', '127.0.0.1', '::1', '0.0.0.0', '::') THEN 'source_reserved' END,
      CASE WHEN data IS NULL THEN 'data_missing' END,
      CASE WHEN data IS NOT NULL AND json_type(data) <> 'OBJECT' THEN 'data_not_object' END,
      CASE WHEN parsed_at IS NULL THEN 'timestamp_invalid' END,
      CASE WHEN parsed_at > TIMESTAMP '2024-02-01 00:00:00' THEN 'timestamp_future' END,
      CASE WHEN len(string_split(tags, ',')) > 10 THEN 'too_many_tags' END
    ], lambda x : x IS NOT NULL) AS errs
  FROM (SELECT *, CASE WHEN stamp IS NULL THEN TIMESTAMP '2024-02-01 00:00:00'
                       ELSE TRY_CAST(regexp_replace(stamp, '[+-]\\d\\d:\\d\\d$', '') AS TIMESTAMP) END AS parsed_at
        FROM requests))
"""

EVENT_LOG = """
event_log AS (
  SELECT event_id, 'records.events' AS topic, user_id % 3 AS part,
    ROW_NUMBER() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS off,
    event_type || ':' || user_id || ':' || CAST(CAST(ts AS DATE) AS VARCHAR) AS idempotency_key, ts, event_type AS source,
    CASE WHEN event_id % 17 = 0 THEN 'not json' WHEN event_id % 19 = 0 THEN '{"event_type":"record.created"}'
         WHEN event_id % 23 = 0 THEN '[1,2]'
         ELSE '{"event_type":"record.created","payload":{"record_id":' || event_id || ',"source":"' || event_type || '"}}' END AS value,
    CASE WHEN event_id % 17 = 0 THEN 'malformed event' WHEN event_id % 19 = 0 THEN 'event missing ''event_type'' or ''payload'''
         WHEN event_id % 23 = 0 THEN 'malformed event' END AS error,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'record.created'
         WHEN event_id % 23 = 0 THEN NULL ELSE 'record.created' END AS event_type,
    CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 THEN NULL
         ELSE '{"record_id":' || event_id || ',"source":"' || event_type || '"}' END AS payload
  FROM events)
"""

FIRST_EVENTS = """
first_events AS (
  SELECT * FROM event_log WHERE error IS NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY idempotency_key ORDER BY event_id) = 1)
"""

LEDGER = """
ledger AS (
  SELECT event_id AS id, topic AS kafka_topic, part AS kafka_partition, off AS kafka_offset, idempotency_key, event_type, payload,
    ['pending', 'processing', 'completed', 'failed', 'dead_letter'][1 + event_id % 5] AS status,
    event_id % 4 AS processing_attempts, CAST(NULL AS VARCHAR) AS error_message, CAST(NULL AS VARCHAR) AS error_details,
    event_id % 5 = 4 AS dead_letter_queue, CASE WHEN event_id % 5 = 4 THEN 'retries exhausted' END AS dlq_reason,
    CAST(NULL AS TIMESTAMP) AS processed_at, ts AS created_at, ts AS updated_at,
    CASE WHEN event_id % 11 = 0 THEN ts + INTERVAL 1 DAY END AS deleted_at
  FROM first_events)
"""

REQUEST_LOG = """
request_log AS (SELECT event_id, event_type AS key, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id) AS ts FROM events)
"""

SAMPLES = """
samples AS (
  SELECT event_id, ts, handler, status,
    CAST(ROW_NUMBER() OVER (PARTITION BY handler, status ORDER BY event_id) % 500 AS DOUBLE) AS value
  FROM (SELECT event_id, ts, event_type AS handler,
          CASE WHEN event_id % 20 = 0 THEN '500' WHEN event_id % 10 = 0 THEN '404' ELSE '200' END AS status FROM events))
"""

JOB_RUNS = """
job_runs AS (
  SELECT event_id AS run_id, event_type AS job_name, ts AS started_at, value AS duration_seconds,
    CASE WHEN event_id % 9 = 0 THEN 'failed' WHEN event_id % 31 = 0 THEN 'timeout' ELSE 'success' END AS status,
    CASE WHEN event_id % 9 = 0 THEN 'error ' || event_id WHEN event_id % 31 = 0 THEN 'timeout exceeded' END AS error
  FROM events)
"""

DOCS = """
docs AS (
  SELECT source, 'doc/' || doc_id AS url, substr(text, 1, 40) AS title, text AS content,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS scraped_at
  FROM documents)
"""

POINTS = "points AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vector, label FROM embeddings)"

IDS = "requested AS (SELECT event_id AS position, (event_id // 2) * 3 AS id FROM events)"

PAGE_URLS = """
page_urls AS (
  SELECT url, page_id, 1 AS seen_no, 'page ' || page_id AS title FROM pages
  UNION ALL SELECT url, page_id, 2, 'page ' || page_id FROM pages WHERE page_id % 4 = 0)
"""

POSTS = """
posts AS (
  SELECT doc_id AS id, CASE WHEN doc_id % 7 <> 0 THEN 'title ' || doc_id END AS title, CASE WHEN doc_id % 5 <> 0 THEN text END AS body
  FROM documents)
"""


def iso(column: str) -> str:
    """ISO text of a timestamp, with a fraction only when there is one."""
    return (
        f"CASE WHEN date_part('microsecond', {column}) % 1000000 = 0 THEN strftime({column}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') END"
    )
