"""The event log, its dead letters and its ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events
from ..operators.ratelimit import dedupe_ttl
from ..sources import tables
from .registry import report, with_views
from .views import DOCS, EVENT_LOG, FIRST_EVENTS, LEDGER, RECORDS

ON_LOG = with_views(EVENT_LOG)
ON_LEDGER = with_views(EVENT_LOG, FIRST_EVENTS, LEDGER)
AS_OF = "2024-02-01 00:00:00"


@report("parsed_events", f"{ON_LOG} SELECT event_id, topic, part, off, event_type, payload, error FROM event_log")
def parsed_events(spark, sf):
    parsed = events.parse_events(tables.event_log(spark, sf))
    return parsed.select("event_id", "topic", "part", "off", "event_type", "payload", "error")


LETTERS = f"""{ON_LOG} SELECT topic AS source_topic, part AS source_partition, off AS source_offset, error AS reason, value AS original
    FROM event_log WHERE error IS NOT NULL"""


@report("dead_letters", LETTERS)
def dead_letters(spark, sf):
    return events.dead_letters(events.parse_events(tables.event_log(spark, sf)))


@report(
    "dead_letter_messages",
    f"""{ON_LOG} SELECT '{{"source_topic":"' || topic || '","source_partition":' || part || ',"source_offset":' || off ||
      ',"reason":"' || error || '","original":"' || replace(value, '"', '\\"') || '"}}' AS value FROM event_log WHERE error IS NOT NULL""",
)
def dead_letter_messages(spark, sf):
    return events.dead_letter_json(events.dead_letters(events.parse_events(tables.event_log(spark, sf))))


@report("replayed_dead_letters", f"{ON_LOG} SELECT topic, part, off, event_type, payload, error FROM event_log WHERE error IS NOT NULL")
def replayed_dead_letters(spark, sf):
    """Dead letters through the parser again; the same ones fail."""
    again = events.parse_events(events.replayable(dead_letters(spark, sf)))
    return again.select("topic", "part", "off", "event_type", "payload", "error")


@report(
    "record_created_messages",
    f"""{with_views(RECORDS)} SELECT '{{"event_type":"record.created","payload":{{"record_id":' || id || ',"source":"' || source || '"}}}}'
    AS value FROM records""",
)
def record_created_messages(spark, sf):
    return events.record_created_events(tables.records(spark, sf))


@report(
    "doc_scraped_messages",
    f"""{with_views(DOCS)} SELECT '{{"event_type":"doc.scraped","payload":{{"source":"' || source || '","count":' || count(*) || '}}}}'
    AS value FROM docs GROUP BY source""",
)
def doc_scraped_messages(spark, sf):
    return events.doc_scraped_events(tables.scraped_docs(spark, sf))


@report(
    "first_events_by_key",
    f"""{ON_LOG} SELECT idempotency_key, event_id, part, off FROM event_log
    QUALIFY ROW_NUMBER() OVER (PARTITION BY idempotency_key ORDER BY event_id) = 1""",
)
def first_events_by_key(spark, sf):
    return events.dedupe_by_key(tables.event_log(spark, sf)).select("idempotency_key", "event_id", "part", "off")


def _early(ledger):
    return ledger.filter("created_at < TIMESTAMP_NTZ '2024-01-16 00:00:00'")


def _late(spark, sf):
    parsed = events.good_events(events.parse_events(tables.event_log(spark, sf)))
    return parsed.filter("ts >= TIMESTAMP_NTZ '2024-01-10 00:00:00'")


EARLY = "early AS (SELECT * FROM ledger WHERE created_at < TIMESTAMP '2024-01-16')"
LATE = "late AS (SELECT * FROM event_log WHERE error IS NULL AND ts >= TIMESTAMP '2024-01-10')"
ON_BOTH = with_views(EVENT_LOG, FIRST_EVENTS, LEDGER, EARLY, LATE)


@report(
    "unseen_events",
    f"{ON_BOTH} SELECT event_id, idempotency_key, off FROM late WHERE idempotency_key NOT IN (SELECT idempotency_key FROM early)",
)
def unseen_events(spark, sf):
    return events.unseen_events(_late(spark, sf), _early(tables.ledger(spark, sf))).select("event_id", "idempotency_key", "off")


@report("seen_events", f"{ON_BOTH} SELECT event_id, l.idempotency_key, e.id AS ledger_id FROM late l JOIN early e USING (idempotency_key)")
def seen_events(spark, sf):
    return events.seen_events(_late(spark, sf), _early(tables.ledger(spark, sf))).select("event_id", "idempotency_key", "ledger_id")


@report(
    "ledger_after_events",
    f"""{ON_BOTH} SELECT * FROM early UNION ALL
    SELECT (SELECT max(id) FROM early) + ROW_NUMBER() OVER (ORDER BY event_id), topic, part, off, idempotency_key, event_type, payload,
      'pending', 0, NULL, NULL, FALSE, NULL, NULL, TIMESTAMP '{AS_OF}', TIMESTAMP '{AS_OF}', NULL
    FROM (SELECT * FROM late WHERE idempotency_key NOT IN (SELECT idempotency_key FROM early)
          QUALIFY ROW_NUMBER() OVER (PARTITION BY idempotency_key ORDER BY event_id) = 1)""",
)
def ledger_after_events(spark, sf):
    return events.create_events(_early(tables.ledger(spark, sf)), _late(spark, sf), AS_OF)


@report("ledger_after_append", f"{ON_LEDGER} SELECT * FROM ledger")
def ledger_after_append(spark, sf):
    ledger = tables.ledger(spark, sf)
    return events.append_events(_early(ledger), ledger.filter("created_at >= TIMESTAMP_NTZ '2024-01-16 00:00:00'"))


@report(
    "ledger_after_transitions",
    f"""{ON_LEDGER} SELECT * REPLACE (
      CASE WHEN id % 7 = 0 THEN 'dead_letter' ELSE 'completed' END AS status,
      processing_attempts + CASE WHEN id % 3 = 0 THEN 2 ELSE 1 END AS processing_attempts,
      CASE WHEN id % 3 = 0 THEN 'error ' || id END AS error_message,
      CASE WHEN id % 3 = 0 THEN '{{"step":"load"}}' END AS error_details,
      dead_letter_queue OR id % 7 = 0 AS dead_letter_queue,
      CASE WHEN id % 7 = 0 THEN 'retries exhausted' ELSE dlq_reason END AS dlq_reason,
      CASE WHEN id % 7 <> 0 THEN created_at + INTERVAL 4 MINUTE END AS processed_at,
      created_at + INTERVAL 4 MINUTE AS updated_at) FROM ledger""",
)
def ledger_after_transitions(spark, sf):
    ledger = tables.ledger(spark, sf)
    return events.apply_transitions(ledger, tables.transition_log(ledger))


@report(
    "duplicate_event_keys",
    f"{ON_LOG} SELECT idempotency_key, count(*) AS n FROM event_log GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_event_keys(spark, sf):
    from ..operators.mutations import unique_violations

    return unique_violations(tables.event_log(spark, sf, offsets=False), ["idempotency_key"])


@report(
    "consumer_lag",
    f"""{ON_BOTH}, committed AS (SELECT kafka_topic, kafka_partition, max(kafka_offset) AS committed_offset FROM early GROUP BY 1, 2)
    SELECT topic, part, end_offset, committed_offset, end_offset - coalesce(committed_offset, -1) AS lag,
      CASE WHEN end_offset - coalesce(committed_offset, -1) > 5000 THEN 'critical'
           WHEN end_offset - coalesce(committed_offset, -1) > 1000 THEN 'warning' ELSE 'ok' END AS severity
    FROM (SELECT topic, part, max(off) AS end_offset FROM event_log GROUP BY 1, 2)
    LEFT JOIN committed ON kafka_topic = topic AND kafka_partition = part""",
)
def consumer_lag(spark, sf):
    return events.consumer_lag(tables.event_log(spark, sf), _early(tables.ledger(spark, sf)))


@report(
    "retry_outcomes",
    f"""{ON_LOG}, tried AS (
      SELECT part, off, a AS attempt_no, error IS NULL AND (event_id + a) % 3 = 0 AS ok
      FROM event_log, LATERAL (SELECT unnest(generate_series(1, event_id % 7 + 1)) AS a)),
    runs AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY part, off ORDER BY attempt_no
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS run FROM tried),
    per_run AS (SELECT part, off, coalesce(run, 0) AS run, count(*) FILTER (WHERE NOT ok) AS failures, bool_or(ok) AS done, count(*) AS n
                FROM runs GROUP BY 1, 2, 3)
    SELECT part, off, CAST(sum(n) AS BIGINT) AS deliveries,
      arg_max(CASE WHEN done THEN 0 ELSE failures % 3 END, run) AS pending_attempts,
      CAST(sum(failures // 3) AS BIGINT) AS dead_letters, arg_max(done, run) AS succeeded_last
    FROM per_run GROUP BY part, off""",
)
def retry_outcomes(spark, sf):
    return events.retry_outcomes(tables.deliveries(spark, sf))


TTL_FOLD = """WITH RECURSIVE log AS (
      SELECT event_id, event_type || ':' || (user_id % 20) AS key, ts,
        ROW_NUMBER() OVER (PARTITION BY event_type, user_id % 20 ORDER BY ts, event_id) AS n FROM events),
    fold AS (
      SELECT event_id, key, ts, n, ts AS state, TRUE AS accepted FROM log WHERE n = 1
      UNION ALL
      SELECT l.event_id, l.key, l.ts, l.n, CASE WHEN l.ts > f.state + INTERVAL 6 HOUR THEN l.ts ELSE f.state END,
        l.ts > f.state + INTERVAL 6 HOUR
      FROM fold f JOIN log l ON l.key = f.key AND l.n = f.n + 1)
    SELECT event_id, key, ts, accepted FROM fold"""


@report("accepted_within_ttl", TTL_FOLD)
def accepted_within_ttl(spark, sf):
    key = F.concat_ws(":", "event_type", (F.col("user_id") % 20).cast("string"))
    log = tables.table(spark, sf, "events").select("event_id", key.alias("key"), "ts")
    return dedupe_ttl(log, 6 * 3600)
