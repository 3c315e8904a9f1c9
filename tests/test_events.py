import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import events, metrics
from tidemark.sources import files


def log_of(spark, values):
    rows = [("records.events", 0, i, v if isinstance(v, bytes) else v.encode()) for i, v in enumerate(values)]
    return spark.createDataFrame([(t, p, o, bytearray(v)) for t, p, o, v in rows], "topic STRING, part INT, off BIGINT, value BINARY")


def test_parse_and_dead_letters(spark):
    good = '{"event_type":"a","payload":{"x":1}}'
    values = [good, "not json", "[1]", "5", '{"event_type":"a"}', '{"event_type":"a","payload":null}', '{"a":1', b'\xff{"a"', '{"payload":1,"event_type":"b"}']
    parsed = events.parse_events(log_of(spark, values))
    assert {r.off: (r.event_type, r.payload) for r in events.good_events(parsed).collect()} == {0: ("a", '{"x":1}'), 8: ("b", "1")}
    letters = {r.source_offset: (r.reason, r.original) for r in events.dead_letters(parsed).collect()}
    assert letters[7] == ("malformed event", '�{"a"')
    missing = "event missing 'event_type' or 'payload'"
    assert {o: reason for o, (reason, _) in letters.items()} == {
        1: "malformed event", 2: "malformed event", 3: "malformed event", 4: missing, 5: missing, 6: "malformed event", 7: "malformed event",
    }


def test_existing_key_keeps_its_offset_and_payload(spark):
    from tidemark.schemas import LEDGER

    ledger = spark.createDataFrame([], LEDGER)
    make = lambda *rows: spark.createDataFrame(
        [(e, "t", 0, o, k, "a", p) for e, o, k, p in rows],
        "event_id BIGINT, topic STRING, part INT, off BIGINT, idempotency_key STRING, event_type STRING, payload STRING",
    )
    first = events.create_events(ledger, make((1, 200, "k", "one"), (2, 999, "k", "two"), (3, 5, "j", "x")), "2024-03-01 00:00:00")
    again = events.create_events(first, make((4, 7, "k", "three"), (5, 8, "new", "y")), "2024-03-01 00:00:00")
    found = {r.idempotency_key: (r.id, r.kafka_offset, r.payload, r.status) for r in again.collect()}
    assert found == {"k": (1, 200, "one", "pending"), "j": (2, 5, "x", "pending"), "new": (3, 8, "y", "pending")}


def brute_attempts(oks, limit=3):
    attempts = letters = 0
    for ok in oks:
        attempts = 0 if ok else attempts + 1
        if attempts >= limit:
            letters, attempts = letters + 1, 0
    return attempts, letters


def test_retry_outcomes_equal_the_loop(spark):
    import random

    rng = random.Random(5)
    runs = {off: [rng.random() < 0.3 for _ in range(rng.randint(1, 14))] for off in range(60)}
    rows = [(0, off, i + 1, ok) for off, oks in runs.items() for i, ok in enumerate(oks)]
    found = events.retry_outcomes(spark.createDataFrame(rows, "part INT, off BIGINT, attempt_no INT, ok BOOLEAN")).collect()
    assert {r.off: (r.pending_attempts, r.dead_letters) for r in found} == {off: brute_attempts(oks) for off, oks in runs.items()}


def test_counter_rate_with_reset_and_gap(spark):
    points = [("00:00:00", 10), ("00:02:00", 15), ("00:06:00", 18), ("00:07:00", 2), ("00:25:00", 1), ("00:26:00", 4)]
    samples = spark.createDataFrame([(f"2024-03-01 {t}", float(v)) for t, v in points], "ts STRING, value DOUBLE").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), F.lit("h").alias("handler"), "value"
    )
    found = metrics.counter_rate(samples, ["handler"], 300).orderBy("window_start").collect()
    assert [r.increase for r in found] == [5.0, 5.0, 4.0] and found[0].rate == 5 / 300


def test_quantile_in_first_and_open_bucket(spark):
    make = lambda numbers: metrics.bucket_histogram(
        spark.createDataFrame([("h", float(n)) for n in numbers], "handler STRING, v DOUBLE"), "v", [1, 2, 4], ["handler"]
    )
    first = metrics.histogram_quantile(make([0.5, 0.6, 0.7, 0.8]), 0.5, ["handler"]).first()
    assert first["quantile"] == 0.5
    middle = metrics.histogram_quantile(make([0.5, 1.5, 1.5, 3]), 0.5, ["handler"]).first()
    assert middle["quantile"] == 1.5
    assert metrics.histogram_quantile(make([9, 9, 9]), 0.95, ["handler"]).first()["quantile"] == 4.0


def test_sustained_alert_needs_the_whole_hold(spark):
    rows = [("00:00", True), ("00:05", True), ("00:10", False), ("00:15", True), ("00:20", True), ("00:25", True)]
    points = spark.createDataFrame([(f"2024-03-01 {t}:00", f) for t, f in rows], "at STRING, firing BOOLEAN").select(
        F.col("at").cast("timestamp_ntz").alias("window_start"), F.lit("s").alias("handler"), "firing"
    )
    found = metrics.sustained_alert(points, ["handler"], "firing", 600).collect()
    assert [(r.points, r.held_seconds) for r in found] == [(3, 600)]
    assert metrics.sustained_alert(points, [], "firing", 300).count() == 2


def test_job_health_without_recent_error(spark):
    rows = [(1, "j", "2024-03-01 00:00:00", 2.0, "failed", "boom"), (2, "j", "2024-03-01 01:00:00", 3.0, "success", None)]
    rows += [(i, "j", f"2024-03-01 02:00:0{i}", 1.0, "success", None) for i in range(3, 6)]
    runs = spark.createDataFrame(rows, "run_id BIGINT, job_name STRING, started_at STRING, duration_seconds DOUBLE, status STRING, error STRING")
    health = metrics.job_health(runs.withColumn("started_at", F.col("started_at").cast("timestamp_ntz"))).first()
    assert (health.success_rate, health.is_healthy, health.last_error, health.last_run_duration_seconds) == (0.8, True, None, 1.0)


def test_metric_text(spark, tmp_path):
    lines = [
        "# TYPE http_requests_total counter", "", 'http_requests_total{code="200"} 10', 'http_requests_total{code="200"} 12 1700',
        "records_created_total nope", "http_responses_total 3.5", "process_cpu 1", "lonely_http_requests_total",
    ]
    (tmp_path / "metrics.txt").write_text("\n".join(lines))
    found = {r.name: r.value for r in files.scan_metric_text(spark, str(tmp_path)).collect()}
    assert found == {'http_requests_total{code="200"}': 12.0, "http_responses_total": 3.5}


def test_transitions_replay(spark):
    from tidemark.schemas import LEDGER

    blank = {name.split()[0]: None for name in LEDGER.split(", ")}
    rows = [tuple({**blank, "id": i, "status": "pending", "processing_attempts": 0, "dead_letter_queue": False}.values()) for i in (1, 2, 3)]
    ledger = spark.createDataFrame(rows, LEDGER)
    log = spark.createDataFrame(
        [(1, 1, "processing", None), (1, 2, "failed", "e1"), (1, 3, "processing", None), (1, 4, "completed", None),
         (2, 1, "processing", None), (2, 2, "dead_letter", "gone")],
        "id BIGINT, seq INT, status STRING, message STRING",
    ).withColumn("at", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")).withColumn("details", F.lit(None).cast("string"))
    found = {r.id: r for r in events.apply_transitions(ledger, log).collect()}
    assert (found[1].status, found[1].processing_attempts, found[1].error_message) == ("completed", 2, "e1")
    assert found[1].processed_at is not None and not found[1].dead_letter_queue
    assert (found[2].status, found[2].dead_letter_queue, found[2].dlq_reason) == ("dead_letter", True, "gone")
    assert found[3].status == "pending"


@pytest.mark.parametrize("series", [["handler"], []])
def test_sustained_alert_over_slices_equals_a_walk(spark, series):
    rnd = random.Random(8)
    start = datetime(2024, 1, 1)
    rows, steps = [], sorted(rnd.sample(range(4000), 1500))
    for i, step in enumerate(steps):
        handlers = ["/a", "/b", None] if series else [["/a", "/b"][i % 2]]
        rows += [(h, start + timedelta(minutes=step), rnd.choice([True, True, True, True, False, None])) for h in handlers]
    points = spark.createDataFrame(rows + [("/a", None, True)], "handler string, window_start timestamp_ntz, firing boolean")
    expected = []
    for key in {r[0] if series else 0 for r in rows}:
        held = None
        own = sorted((r[1], r[2]) for r in rows if (r[0] if series else 0) == key and r[2] is not None)
        for at, on in [*own, (None, False)]:
            if on:
                held = (held[0] if held else at, at, held[2] + 1 if held else 1)
            elif held:
                seconds = int((held[1] - held[0]).total_seconds())
                if seconds >= 600:
                    expected.append(((key,) if series else ()) + (*held, seconds))
                held = None
    for width in (86_400, 1_800, 60):
        found = metrics.sustained_alert(points, series, "firing", 600, slice_seconds=width)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert metrics.sustained_alert(points.limit(0), series, "firing", 600).count() == 0
