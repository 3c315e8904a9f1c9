"""The event log and its ledger: parsing, dead letters, idempotency, status changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import instant
from ..schemas import DOC_SCRAPED, LAG_CRITICAL, LAG_WARNING, MAX_DELIVERIES, RECORD_CREATED
from ..session import settle
from .spread import running_position


def decoded(value: str | Column) -> Column:
    """Bytes as UTF-8 text; undecodable bytes become the replacement character."""
    value = F.col(value) if isinstance(value, str) else value
    return F.make_valid_utf8(value.cast("string"))


def parse_events(log: DataFrame) -> DataFrame:
    """Adds ``event_type``, ``payload`` (JSON text) and ``error`` (null for a good event) to log rows.

    Anything but a JSON object is malformed. One parse yields all three.
    """
    shape = "event_type STRING, payload STRING, malformed STRING"
    parsed = F.from_json(decoded("value"), shape, {"columnNameOfCorruptRecord": "malformed"})
    error = (
        F.when(F.col("_e.malformed").isNotNull() | F.col("_e").isNull(), F.lit("malformed event"))
        .when(F.col("_e.event_type").isNull() | F.col("_e.payload").isNull(), F.lit("event missing 'event_type' or 'payload'"))
    )
    return (
        log.withColumn("_e", parsed)
        .withColumn("event_type", F.col("_e.event_type"))
        .withColumn("payload", F.col("_e.payload"))
        .withColumn("error", error)
        .drop("_e")
    )


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Dead-letter messages of the bad events."""
    return parsed.filter(F.col("error").isNotNull()).select(
        F.col("topic").alias("source_topic"),
        F.col("part").alias("source_partition"),
        F.col("off").alias("source_offset"),
        F.col("error").alias("reason"),
        decoded("value").alias("original"),
    )


def dead_letter_json(letters: DataFrame) -> DataFrame:
    fields = ["source_topic", "source_partition", "source_offset", "reason", "original"]
    return letters.select(F.to_json(F.struct(*fields)).alias("value"))


def replayable(letters: DataFrame) -> DataFrame:
    """Dead letters as log rows again, for another pass through ``parse_events``."""
    return letters.select(
        F.col("source_topic").alias("topic"), F.col("source_partition").alias("part"),
        F.col("source_offset").alias("off"), F.encode("original", "UTF-8").alias("value"),
    )


def envelopes(event_type: str, payload: DataFrame) -> DataFrame:
    """``{"event_type": .., "payload": {..}}`` messages, the payload being all columns of the frame."""
    body = F.struct(F.lit(event_type).alias("event_type"), F.struct(*payload.columns).alias("payload"))
    return payload.select(F.to_json(body).alias("value"))


def record_created_events(inserted: DataFrame) -> DataFrame:
    return envelopes(RECORD_CREATED, inserted.select(F.col("id").alias("record_id"), "source"))


def doc_scraped_events(scraped: DataFrame) -> DataFrame:
    return envelopes(DOC_SCRAPED, scraped.groupBy("source").agg(F.count(F.lit(1)).alias("count")))


def retry_outcomes(deliveries: DataFrame, max_attempts: int = MAX_DELIVERIES) -> DataFrame:
    """State of every ``(part, off)`` after its deliveries ``(attempt_no, ok)``, ``attempt_no`` counting from 1.

    A success clears the failure counter; every ``max_attempts``-th failure in a row sends the message to the
    dead letters and clears it too. Failures are never sorted: the length of a run of failures is the distance
    between two successes, or between the last success and the last delivery.
    """
    message = ["part", "off"]
    before = F.lag("attempt_no", 1, 0).over(Window.partitionBy(*message).orderBy("attempt_no"))
    runs = F.floor((F.col("attempt_no") - F.col("_before") - 1) / F.lit(max_attempts))
    successes = (
        deliveries.filter("ok")
        .withColumn("_before", before)
        .groupBy(*message)
        .agg(F.sum(runs).alias("_letters"), F.max("attempt_no").alias("_last_ok"))
    )
    ends = deliveries.groupBy(*message).agg(F.max("attempt_no").alias("deliveries"))
    tail = F.col("deliveries") - F.coalesce("_last_ok", F.lit(0))
    return ends.join(successes, message, "left").select(
        *message,
        F.col("deliveries").cast("bigint").alias("deliveries"),
        F.pmod(tail, F.lit(max_attempts)).cast("bigint").alias("pending_attempts"),
        (F.coalesce("_letters", F.lit(0)) + F.floor(tail / F.lit(max_attempts))).cast("bigint").alias("dead_letters"),
        (tail == 0).alias("succeeded_last"),
    )


def dedupe_by_key(log: DataFrame, key: str = "idempotency_key", order: str = "event_id") -> DataFrame:
    """The first row of every key; only one candidate per key and task is shuffled."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def unseen_events(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """Incoming events whose key the ledger does not hold."""
    return incoming.join(ledger.select("idempotency_key"), "idempotency_key", "left_anti")


def seen_events(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """Incoming events whose key the ledger holds, with the id of the row that wins."""
    return incoming.join(ledger.select("idempotency_key", F.col("id").alias("ledger_id")), "idempotency_key")


def create_events(ledger: DataFrame, incoming: DataFrame, as_of: datetime | str | Column, order: str = "event_id") -> DataFrame:
    """The ledger after inserting ``incoming``; a key that exists keeps its row, offset and payload."""
    return ledger.unionByName(new_ledger_rows(ledger, incoming, as_of, order))


def new_ledger_rows(
    ledger: DataFrame, incoming: DataFrame, as_of: datetime | str | Column, order: str = "event_id", highest: int | None = None
) -> DataFrame:
    """The rows that ``incoming`` adds to the ledger, with the ids that follow its own.

    ``ledger`` may be the part of it that can hold an incoming key, if ``highest`` gives its largest id.
    """
    fresh = unseen_events(dedupe_by_key(incoming, order=order), ledger)
    highest = ledger.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar() if highest is None else F.lit(highest)
    now = instant(as_of)
    text = F.lit(None).cast("string")
    stamp = F.lit(None).cast("timestamp_ntz")
    return (
        running_position(fresh, order, out="_n")
        .withColumn("_highest", highest)
        .select(
            (F.col("_highest") + F.col("_n")).alias("id"),
            F.col("topic").alias("kafka_topic"), F.col("part").alias("kafka_partition"), F.col("off").alias("kafka_offset"),
            "idempotency_key", "event_type", "payload", F.lit("pending").alias("status"),
            F.lit(0).alias("processing_attempts"), text.alias("error_message"), text.alias("error_details"),
            F.lit(False).alias("dead_letter_queue"), text.alias("dlq_reason"), stamp.alias("processed_at"),
            now.alias("created_at"), now.alias("updated_at"), stamp.alias("deleted_at"),
        )
    )


def append_events(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Bulk append of ledger rows whose keys are known to be new."""
    return ledger.unionByName(rows)


def apply_transitions(ledger: DataFrame, log: DataFrame) -> DataFrame:
    """Replay status changes ``(id, seq, status, at, message, details)`` on the ledger.

    ``processing`` counts an attempt, ``completed`` sets the processing time, ``failed`` the error fields and
    ``dead_letter`` the flag and reason. The log is reduced to one row per event before it meets the ledger.
    """

    def last(field: str, status: str) -> Column:
        return F.expr(f"max_by({field}, seq) FILTER (WHERE status = '{status}')")

    replayed = log.groupBy("id").agg(
        F.max_by("status", "seq").alias("_status"),
        F.max("at").alias("_at"),
        F.count_if(F.col("status") == "processing").cast("int").alias("_attempts"),
        last("at", "completed").alias("_done"),
        last("message", "failed").alias("_message"),
        last("details", "failed").alias("_details"),
        F.bool_or(F.col("status") == "dead_letter").alias("_dead"),
        last("message", "dead_letter").alias("_reason"),
    )
    joined = ledger.join(replayed, "id", "left")
    return (
        joined.withColumn("status", F.coalesce("_status", "status"))
        .withColumn("processing_attempts", F.col("processing_attempts") + F.coalesce("_attempts", F.lit(0)))
        .withColumn("processed_at", F.coalesce("_done", "processed_at"))
        .withColumn("error_message", F.coalesce("_message", "error_message"))
        .withColumn("error_details", F.coalesce("_details", "error_details"))
        .withColumn("dead_letter_queue", F.coalesce("_dead", F.lit(False)) | F.col("dead_letter_queue"))
        .withColumn("dlq_reason", F.coalesce("_reason", "dlq_reason"))
        .withColumn("updated_at", F.coalesce("_at", "updated_at"))
        .select(*ledger.columns)
    )


def consumer_lag(log: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per topic and partition: newest offset minus the newest one in the ledger, with its severity."""
    ends = log.groupBy("topic", "part").agg(F.max("off").alias("end_offset"))
    committed = ledger.groupBy(F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("part")).agg(
        F.max("kafka_offset").alias("committed_offset")
    )
    lag = F.col("end_offset") - F.coalesce("committed_offset", F.lit(-1))
    return (
        ends.join(committed, ["topic", "part"], "left")
        .withColumn("lag", lag)
        .withColumn("severity", F.when(lag > LAG_CRITICAL, "critical").when(lag > LAG_WARNING, "warning").otherwise("ok"))
    )
