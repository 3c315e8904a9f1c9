"""The library's tables as views over the test parquet: records, event log, requests, metrics, job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.events import dedupe_by_key, good_events, parse_events
from ..operators.spread import running_position
from ..schemas import EVENT_STATUSES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records: some without a reading, some with a text in its place, some deleted, some without tags."""
    k = F.get_json_object("props", "$.k")
    batch = (F.col("event_id") % 4).cast("string")
    raw = (
        F.when(F.expr("event_id % 7 = 0"), F.concat(F.lit('{"note": "no reading", "batch": '), batch, F.lit("}")))
        .when(F.expr("event_id % 97 = 0"), F.lit('{"value": "n/a"}'))
        .otherwise(F.concat(F.lit('{"value": '), k, F.lit(', "batch": '), batch, F.lit("}")))
    )
    tags = F.array(
        F.concat(F.lit("tag-"), (F.col("event_id") % 10).cast("string")),
        F.concat(F.lit("bucket-"), (F.col("event_id") % 5).cast("string")),
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("timestamp"),
        raw.alias("raw_data"),
        F.when(F.expr("event_id % 13 = 0"), F.array().cast("array<string>")).otherwise(tags).alias("tags"),
        F.expr("event_id % 3 = 0").alias("processed"),
        F.when(F.expr("event_id % 3 = 0 AND event_id % 5 <> 0"), F.col("ts") + F.expr("INTERVAL '1' MINUTE")).alias("processed_at"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.when(F.expr("event_id % 11 = 0"), F.col("ts") + F.expr("INTERVAL '1' DAY")).alias("deleted_at"),
    )


def record_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming requests, some of them invalid; all valid ones with a timestamp share the same one."""
    source = (
        F.when(F.expr("event_id % 29 = 0"), "LocalHost").when(F.expr("event_id % 37 = 0"), "")
        .when(F.expr("event_id % 41 = 0"), F.lit(None).cast("string")).otherwise(F.col("event_type"))
    )
    stamp = (
        F.when(F.expr("event_id % 43 = 0"), "not-a-time").when(F.expr("event_id % 47 = 0"), "2999-01-01T00:00:00")
        .when(F.expr("event_id % 5 = 0"), F.lit(None).cast("string")).otherwise(F.lit("2024-01-15T10:00:00+05:00"))
    )
    data = (
        F.when(F.expr("event_id % 53 = 0"), F.lit(None).cast("string")).when(F.expr("event_id % 59 = 0"), "[1,2]")
        .otherwise(F.col("props"))
    )
    many = F.transform(F.sequence(F.lit(1), F.lit(11)), lambda i: F.concat(F.lit("t"), i.cast("string")))
    tags = (
        F.when(F.expr("event_id % 61 = 0"), many).when(F.expr("event_id % 2 = 0"), F.array(F.lit("Stock"), F.lit("NASDAQ")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % 100).alias("batch_id"), source.alias("source"), stamp.alias("timestamp"),
        data.alias("data"), tags.alias("tags"),
    )


def event_log(spark: SparkSession, sf_dir: str, offsets: bool = True) -> DataFrame:
    """The topic: three partitions with dense offsets, good and bad messages, repeated idempotency keys."""
    events = table(spark, sf_dir, "events")
    message = (
        F.when(F.expr("event_id % 17 = 0"), "not json")
        .when(F.expr("event_id % 19 = 0"), '{"event_type":"record.created"}')
        .when(F.expr("event_id % 23 = 0"), "[1,2]")
        .otherwise(
            F.concat(
                F.lit('{"event_type":"record.created","payload":{"record_id":'), F.col("event_id").cast("string"),
                F.lit(',"source":"'), F.col("event_type"), F.lit('"}}'),
            )
        )
    )
    key = F.concat_ws(":", "event_type", F.col("user_id").cast("string"), F.col("ts").cast("date").cast("string"))
    log = events.select(
        "event_id", F.lit("records.events").alias("topic"), (F.col("user_id") % 3).cast("int").alias("part"),
        key.alias("idempotency_key"), "ts", F.encode(message, "UTF-8").alias("value"),
    )
    if not offsets:
        return log
    # Only ids and partitions are numbered; the messages move once, to meet their offsets.
    numbers = running_position(log.select("event_id", "part"), "event_id", ["part"], out="off")
    return log.join(numbers.select("event_id", (F.col("off") - 1).alias("off")), "event_id")


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per second over five keys."""
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("event_id").cast("decimal(18,6)")
    )
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("key"), at.alias("ts"))


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters per handler and status that restart every 500 samples."""
    status = F.when(F.expr("event_id % 20 = 0"), "500").when(F.expr("event_id % 10 = 0"), "404").otherwise("200")
    rows = table(spark, sf_dir, "events").select("event_id", "ts", F.col("event_type").alias("handler"), status.alias("status"))
    counted = running_position(rows, "event_id", ["handler", "status"], out="n")
    return counted.select("event_id", "ts", "handler", "status", (F.col("n") % 500).cast("double").alias("value"))


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed, late = F.expr("event_id % 9 = 0"), F.expr("event_id % 31 = 0")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"), F.col("event_type").alias("job_name"), F.col("ts").alias("started_at"),
        F.col("value").alias("duration_seconds"),
        F.when(failed, "failed").when(late, "timeout").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("error "), F.col("event_id").cast("string"))).when(late, "timeout exceeded").alias("error"),
    )


def scraped_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as scraped items."""
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("doc_id").cast("decimal(18,6)")
    )
    return table(spark, sf_dir, "documents").select(
        "source", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        F.substring("text", 1, 40).alias("title"), F.col("text").alias("content"), at.alias("scraped_at"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as vector points; the label is their payload."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def newest(df: DataFrame, column: str = "timestamp"):
    """The newest instant of a table as a scalar subquery, the ``as_of`` of reproducible reports."""
    return df.agg(F.max(column).alias("as_of")).scalar()


def requested_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long request list ``(position, id)`` with repeated ids and ids that no record has."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("position"), (F.floor(F.col("event_id") / 2) * 3).alias("id")
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event ledger: the first good event of every key, in all states."""
    firsts = dedupe_by_key(good_events(parse_events(event_log(spark, sf_dir))))
    status = F.get(F.array(*[F.lit(s) for s in EVENT_STATUSES]), (F.col("event_id") % 5).cast("int"))
    text, stamp = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    return firsts.withColumn("status", status).select(
        F.col("event_id").alias("id"), F.col("topic").alias("kafka_topic"), F.col("part").alias("kafka_partition"),
        F.col("off").alias("kafka_offset"), "idempotency_key", "event_type", "payload", "status",
        (F.col("event_id") % 4).cast("int").alias("processing_attempts"), text.alias("error_message"),
        text.alias("error_details"), (F.col("status") == "dead_letter").alias("dead_letter_queue"),
        F.when(F.col("status") == "dead_letter", F.lit("retries exhausted")).alias("dlq_reason"), stamp.alias("processed_at"),
        F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"),
        F.when(F.expr("event_id % 11 = 0"), F.col("ts") + F.expr("INTERVAL '1' DAY")).alias("deleted_at"),
    )


def transition_log(rows: DataFrame) -> DataFrame:
    """Status changes of ledger rows: an attempt that may fail, another one, then completion or the dead letters."""
    fails, dies = F.expr("id % 3 = 0"), F.expr("id % 7 = 0")
    text = F.lit(None).cast("string")

    def change(seq: int, status: str, message=text, details=text):
        at = F.col("created_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(seq))
        return F.struct(
            F.lit(seq).alias("seq"), F.lit(status).alias("status"), at.alias("at"), message.alias("message"), details.alias("details")
        )

    failed = change(2, "failed", F.concat(F.lit("error "), F.col("id").cast("string")), F.lit('{"step":"load"}'))
    end = F.when(dies, change(4, "dead_letter", F.lit("retries exhausted"))).otherwise(change(4, "completed"))
    steps = F.array(change(1, "processing"), F.when(fails, failed), F.when(fails, change(3, "processing")), end)
    return rows.select("id", F.inline(F.filter(steps, lambda s: s.isNotNull())))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated deliveries of every message; bad ones always fail, good ones sometimes."""
    parsed = parse_events(event_log(spark, sf_dir)).select("event_id", "part", "off", "error")
    attempts = F.explode(F.sequence(F.lit(1), (F.col("event_id") % 7 + 1).cast("int")))
    tried = parsed.withColumn("attempt_no", attempts)
    return tried.withColumn("ok", F.col("error").isNull() & F.expr("(event_id + attempt_no) % 3 = 0")).drop("error")


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of the pages, every fourth page twice, as scraped items with their order of arrival."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    again = pages.filter("page_id % 4 = 0").withColumn("seen_no", F.lit(2))
    items = pages.withColumn("seen_no", F.lit(1)).unionByName(again)
    return items.select("url", "page_id", "seen_no", F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("title"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as API posts; some have no title or body."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.when(F.expr("doc_id % 7 <> 0"), F.concat(F.lit("title "), F.col("doc_id").cast("string"))).alias("title"),
        F.when(F.expr("doc_id % 5 <> 0"), F.col("text")).alias("body"),
    )
