import random
import tracemalloc
from types import SimpleNamespace
from unittest.mock import MagicMock

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ratelimit
from tidemark.plans import stream_reports
from tidemark.session import fresh_path
from tidemark.streaming import flows, offset_log, sources, stateful


def land(df, path, mode="append"):
    df.coalesce(1).write.mode(mode).parquet(path)


def test_redelivered_offsets_and_repeated_batches(spark):
    path, out = fresh_path(spark, "log"), fresh_path(spark, "out")
    values = ['{"event_type":"a","payload":1}', "broken"]
    log = spark.createDataFrame(
        [("t", 0, i, "k", bytearray(v.encode())) for i, v in enumerate(values)], "topic STRING, part INT, off BIGINT, key STRING, value BINARY"
    ).withColumn("ts", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")).select("topic", "part", "off", "key", "ts", "value")
    for _ in range(2):
        land(log, path)
        sources.run_available(flows.consume(sources.file_log(spark, path), out, f"{out}-checkpoint"))
    assert flows.read_events(spark, out).count() == 2 and flows.read_dead_letters(spark, out).count() == 2
    sources.run_available(flows.consume(sources.file_log(spark, path), out, f"{out}-checkpoint"))
    assert flows.read_events(spark, out).count() == 2


def records(spark, *rows):
    at = F.col("timestamp").cast("timestamp_ntz")
    return spark.createDataFrame(list(rows), "source STRING, timestamp STRING, raw_data STRING").select(
        "source", at.alias("timestamp"), "raw_data", F.lit(False).alias("processed"), F.lit(None).cast("timestamp_ntz").alias("deleted_at")
    )


def test_late_rows_after_the_watermark_are_left_out(spark):
    path, out = fresh_path(spark, "records"), fresh_path(spark, "parts")
    schema = "source STRING, timestamp TIMESTAMP_NTZ, raw_data STRING, processed BOOLEAN, deleted_at TIMESTAMP_NTZ"
    batches = [
        [("a", "2024-03-01 10:10:00", '{"value": 1}'), ("b", "2024-03-01 10:20:00", "{}")],
        [("a", "2024-03-01 10:50:00", '{"value": 3}'), ("a", "2024-03-01 14:00:00", '{"value": 9}')],
        [("a", "2024-03-01 10:55:00", '{"value": 100}'), ("a", "2024-03-01 13:30:00", '{"value": 7}')],
    ]
    for batch in batches:
        land(records(spark, *batch), path)
        parts = flows.hourly_parts_stream(sources.table_stream(spark, path, schema), lateness="1 hour")
        sources.run_available(flows.upsert_batches(parts, out, f"{out}-checkpoint", ["hour", "source"], "hour"))
    found = {r.hour.hour: (r.record_count, r.max_value, r.unique_sources) for r in flows.read_hourly_stats(spark, out).collect()}
    assert found == {10: (3, 3.0, 2), 13: (1, 7.0, 1), 14: (1, 9.0, 1)}


def test_state_carries_over_micro_batches(spark):
    path, out = fresh_path(spark, "requests"), fresh_path(spark, "decisions")
    schema = "event_id BIGINT, key STRING, ts TIMESTAMP_NTZ"
    expected = {0: True, 1: True, 2: False, 3: False, 4: True}
    seconds = {0: 0, 1: 1, 2: 2, 3: 61 - 1, 4: 61}
    for ids in ([0, 1], [2], [3, 4]):
        rows = spark.createDataFrame([(i, f"2024-03-01 00:{seconds[i] // 60:02d}:{seconds[i] % 60:02d}") for i in ids], "event_id BIGINT, ts STRING")
        land(rows.select("event_id", F.lit("k").alias("key"), F.col("ts").cast("timestamp_ntz").alias("ts")), path)
        decided = stateful.sliding_window_stream(sources.table_stream(spark, path, schema), 2, 60)
        sources.run_available(
            decided.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
        )
    assert {r.event_id: r.allowed for r in spark.read.parquet(out).collect()} == expected


def test_state_of_a_quiet_key_is_dropped(spark):
    path, out = fresh_path(spark, "requests"), fresh_path(spark, "decisions")
    schema = "event_id BIGINT, key STRING, ts TIMESTAMP_NTZ"
    batches = [
        [(0, "a", "00:00:00"), (1, "b", "00:00:01")], [(2, "b", "00:30:00")], [(3, "b", "00:30:01"), (4, "a", "00:30:02")],
        [(5, None, "00:45:00")], [(6, None, "01:00:00")],
    ]
    states = []
    for batch in batches:
        rows = spark.createDataFrame(batch, "event_id BIGINT, key STRING, at STRING")
        land(rows.select("event_id", "key", F.concat(F.lit("2024-03-01 "), "at").cast("timestamp_ntz").alias("ts")), path)
        decided = stateful.dedupe_ttl_stream(sources.table_stream(spark, path, schema), 60, "1 minute")
        sources.run_available(decided.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint"))
        held = spark.read.format("statestore").option("stateVarName", "last").load(f"{out}-checkpoint")
        states.append({r.k for r in held.select("key.key").withColumnRenamed("key", "k").collect()})
    expected = {0: True, 1: True, 2: True, 3: False, 4: True, 5: True, 6: True}
    assert {r.event_id: r.accepted for r in spark.read.parquet(out).collect()} == expected
    assert states[1] == {"b"} and states[4] <= {None}  # what stayed quiet is gone


def test_ttl_stream_equals_the_batch_rule_over_restarts(spark):
    """Rows a few seconds apart, in five micro-batches that are each a run of its own."""
    path, out = fresh_path(spark, "requests"), fresh_path(spark, "decisions")
    schema = "event_id BIGINT, key STRING, ts TIMESTAMP_NTZ"
    rnd, clock, rows = random.Random(4), 0, []
    for i in range(300):
        clock += rnd.choice([0, 200, 900, 4_000, 31_000])
        rows.append((i, rnd.choice(["a", "a", "b", "c"]), clock))
    whole = spark.createDataFrame(rows, "event_id BIGINT, key STRING, ms BIGINT")
    whole = whole.select("event_id", "key", F.expr("TIMESTAMP_NTZ '2024-03-01 00:00:00' + make_dt_interval(0, 0, 0, ms / 1000.0)").alias("ts"))
    for part in range(5):
        land(whole.filter(F.floor(F.col("event_id") / 60) == part), path)
        decided = stateful.dedupe_ttl_stream(sources.table_stream(spark, path, schema), 30, "1 minute")
        sources.run_available(decided.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint"))
    found = {r.event_id: r.accepted for r in spark.read.parquet(out).collect()}
    assert found == {r.event_id: r.accepted for r in ratelimit.dedupe_ttl(whole, 30).collect()} and len(found) == 300
    assert set(found.values()) == {True, False}


@pytest.mark.parametrize("in_memory, batch", [(10_000, 100), (300, 100), (50, 100), (1, 1), (64, 7)])
def test_rows_of_a_group_come_in_order_from_runs_on_disk(monkeypatch, in_memory, batch):
    monkeypatch.setattr(stateful, "ROWS_IN_MEMORY", in_memory)
    monkeypatch.setattr(stateful, "ROWS_AT_ONCE", 40)
    rnd = np.random.default_rng(in_memory)
    rows = np.column_stack([rnd.integers(-50, 50, 1000), rnd.integers(0, 5, 1000), np.arange(1000)])
    pieces = list(stateful._in_order(rows[i : i + batch] for i in range(0, 1000, batch)))
    found = np.concatenate(pieces)
    assert max(map(len, pieces)) <= 40 and found[:, :2].tolist() == sorted(rows[:, :2].tolist())
    assert sorted(found.tolist()) == sorted(rows.tolist())


@pytest.mark.parametrize("in_memory", [100_000, 50])
def test_outcomes_over_restarts_with_a_state_per_block_of_messages(spark, monkeypatch, in_memory):
    """A call and a state per message took 2 ms each; adjacent messages share them, whatever the offsets."""
    monkeypatch.setattr(stateful, "ROWS_IN_MEMORY", in_memory)
    monkeypatch.setattr(stateful, "ROWS_AT_ONCE", 30)
    path, out = fresh_path(spark, "deliveries"), fresh_path(spark, "outcomes")
    schema = "part INT, off BIGINT, attempt_no INT, ok BOOLEAN"
    rnd = random.Random(7)
    offsets = [*range(1000, 1100), None, -1, -1024, -1025, 2**62, 2**62 + 1]
    counters, tried, expected = {}, {}, {}
    for _ in range(3):
        rows = []
        for part in (0, 1, None):
            for off in offsets:
                for _ in range(rnd.choice([0, 1, 4])):
                    n = tried[part, off] = tried.get((part, off), 0) + 1
                    ok = rnd.choice([True, False, False, False, None])
                    failures = counters[part, off] = 0 if ok else counters.get((part, off), 0) + 1
                    expected[part, off, n] = ("done" if ok else "dead_letter" if failures == 3 else "retry", failures)
                    counters[part, off] = failures % 3
                    rows.append((part, off, n, ok))
        rnd.shuffle(rows)
        land(spark.createDataFrame(rows, schema), path)
        decided = stateful.retry_stream(sources.table_stream(spark, path, schema))
        sources.run_available(decided.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint"))
    found = spark.read.parquet(out).collect()
    assert {(r.part, r.off, r.attempt_no): (r.outcome, r.attempts) for r in found} == expected and len(found) == len(expected)
    assert sum(n > 0 for n in counters.values()) > 100
    # Per part: the offsets from 1000 lie in two blocks, and the others in four more, one of them without an offset.
    assert spark.read.format("statestore").load(f"{out}-checkpoint").count() <= 3 * 6


def test_a_lower_limit_after_a_restart(spark):
    """Four failures are pending when the limit becomes 3: the next one is the dead letter, and the count starts again."""
    path, out = fresh_path(spark, "deliveries"), fresh_path(spark, "outcomes")
    schema = "part INT, off BIGINT, attempt_no INT, ok BOOLEAN"
    for limit, attempts in ((9, range(1, 5)), (3, range(5, 10))):
        land(spark.createDataFrame([(0, 7, n, False) for n in attempts], schema), path)
        decided = stateful.retry_stream(sources.table_stream(spark, path, schema), limit)
        sources.run_available(decided.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint"))
    found = [(r.attempts, r.outcome) for r in spark.read.parquet(out).orderBy("attempt_no").collect()]
    assert found == [(n, "retry") for n in range(1, 5)] + [(5, "dead_letter"), (1, "retry"), (2, "retry"), (3, "dead_letter"), (1, "retry")]


@pytest.mark.parametrize("stream, batch", [(stateful.token_bucket_stream, ratelimit.token_bucket), (stateful.sliding_window_stream, ratelimit.sliding_window)])
def test_decisions_from_runs_on_disk_over_restarts(spark, monkeypatch, stream, batch):
    monkeypatch.setattr(stateful, "ROWS_IN_MEMORY", 20)
    monkeypatch.setattr(stateful, "ROWS_AT_ONCE", 7)
    path, out = fresh_path(spark, "requests"), fresh_path(spark, "decisions")
    rnd, clock, rows = random.Random(5), 0, []
    for i in range(400):
        clock += rnd.choice([0, 200, 900, 4_000, 131_000] if i % 50 else [0])
        rows.append((i, rnd.choice(["a", "a", "b"]), clock))
    rnd.shuffle(rows)
    whole = spark.createDataFrame(rows, "event_id BIGINT, key STRING, ms BIGINT")
    whole = whole.select("event_id", "key", F.expr("TIMESTAMP_NTZ '2024-03-01 00:00:00.000001' + make_dt_interval(0, 0, 0, ms / 1000.0)").alias("ts"))
    for part in (F.col("event_id") < 250, F.col("event_id") >= 250):
        land(whole.filter(part), path)
        decided = stream(sources.table_stream(spark, path, "event_id BIGINT, key STRING, ts TIMESTAMP_NTZ"), 3)
        sources.run_available(decided.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint"))
    found, expected = spark.read.parquet(out), batch(whole, 3)
    same = lambda df: sorted((r.event_id, r.key, r.ts, r.allowed, *(round(r[c], 6) for c in df.columns[4:])) for r in df.collect())
    assert same(found) == same(expected.select(*found.columns))
    assert {r.allowed for r in found.collect()} == {True, False}


def test_requests_of_a_key_do_not_lie_in_memory(spark):
    """All of a key's rows and decisions of a micro-batch were held at once, several hundred bytes a request."""
    requests = MagicMock()
    for name in ("withColumn", "withWatermark", "select", "groupBy"):
        getattr(requests, name).return_value = requests
    stateful.token_bucket_stream(requests)
    decide = requests.applyInPandasWithState.call_args.args[0]
    kept = []
    state = SimpleNamespace(exists=False, hasTimedOut=False, update=kept.append, setTimeoutTimestamp=kept.append, getCurrentWatermarkMs=lambda: 0)

    def batches():
        for i in reversed(range(80)):
            ids = np.arange(i * 10_000, (i + 1) * 10_000)
            yield pd.DataFrame({"event_id": ids, "ts": (ids * 1_000_000).astype("datetime64[us]"), "micros": ids * 1_000_000})

    tracemalloc.start()
    try:
        n = 0
        for decided in decide(("k",), batches(), state):
            assert decided["event_id"].iloc[0] == n and decided["event_id"].is_monotonic_increasing
            n += len(decided)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 800_000 and kept[1] == 799_999_000 + 121_000 + 1
    assert most < 100e6, f"{most / 1e6:.0f} MB"


def test_micro_batches_of_requests_are_bounded_and_in_order(spark, monkeypatch):
    """The whole table came as one micro-batch; the engine writes what that holds of a key into one buffer outside the heap."""
    monkeypatch.setattr(stream_reports, "ROWS_PER_BATCH", 200, raising=False)
    table, out = fresh_path(spark, "tables"), fresh_path(spark, "decisions")
    at = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    kinds = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None).cast("string")), (F.col("id") * F.col("id") % 3 + 1).cast("int"))
    rows = spark.range(1000).select(F.col("id").alias("event_id"), at.alias("ts"), "id", kinds.alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
    rows.withColumnRenamed("id", "user_id").orderBy(F.xxhash64("event_id")).write.parquet(f"{table}/events.parquet")
    monkeypatch.setattr(stream_reports, "_event_stream", lambda spark, sf: sources.table_stream(spark, f"{sf}/events.parquet", stream_reports.EVENTS))
    requests = stream_reports._request_stream(spark, table)
    query = sources.run_available(
        requests.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
    )
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(sizes) == 1000 and len(sizes) >= 4 and max(sizes) < 400
    decided = {r.event_id: (r.key, r.allowed, r.remaining) for r in stream_reports.streamed_token_bucket(spark, table).collect()}
    log = ratelimit.token_bucket(spark.read.parquet(out).filter("key IS NOT NULL"))
    expected = {r.event_id: (r.key, r.allowed, round(r.remaining, 6)) for r in log.collect()}
    assert {i: d for i, d in decided.items() if d[0] is not None} == expected and len(decided) == 1000


def test_a_repeated_batch_changes_no_ledger(spark):
    path, out = fresh_path(spark, "log"), fresh_path(spark, "ledger")
    value = bytearray(b'{"event_type":"a","payload":1}')
    rows = [("t", 0, i, f"k{i % 2}", value) for i in range(4)]
    log = spark.createDataFrame(rows, "topic STRING, part INT, off BIGINT, key STRING, value BINARY")
    land(log.withColumn("ts", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")).select("topic", "part", "off", "key", "ts", "value"), path)
    for checkpoint in ("first", "again"):
        writer = flows.consume_to_ledger(sources.file_log(spark, path), out, f"{out}-{checkpoint}", "2024-03-02 00:00:00")
        sources.run_available(writer)
        found = flows.read_ledger(spark, out).orderBy("id").collect()
        assert [(r.id, r.idempotency_key, r.kafka_offset) for r in found] == [(1, "k0", 0), (2, "k1", 1)]


def test_caller_hook_gets_every_batch(spark):
    path, out = fresh_path(spark, "hook"), fresh_path(spark, "hooked")
    land(spark.range(5), path)
    seen = []
    hook = lambda batch, batch_id: (seen.append(batch_id), batch.write.mode("overwrite").parquet(sources.batch_folder(out, batch_id)))
    sources.run_available(flows.each_batch(sources.table_stream(spark, path, "id BIGINT"), hook, f"{out}-checkpoint"))
    assert seen == [0] and spark.read.parquet(out).count() == 5


def test_offsets_are_the_position_of_the_stream(spark):
    """A restart goes on at the committed offsets, a replay from given ones gives the same events, segments before them are not opened."""
    path, out = fresh_path(spark, "offset-log"), fresh_path(spark, "out")
    fields = "topic STRING, part INT, off BIGINT, key STRING, value BINARY"
    rows = [("t", p, i, f"k{i}", bytearray(b'{"event_type":"a","payload":%d}' % i)) for p in (0, 1) for i in range(25)]
    log = spark.createDataFrame(rows, fields).withColumn("ts", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")).select("topic", "part", "off", "key", "ts", "value")

    def run(target, starting=None):
        stream = offset_log.offset_log(spark, path, starting, rows_a_segment=10)
        query = sources.run_available(stream.select("part", "off").writeStream.format("parquet").option("path", target).option("checkpointLocation", f"{target}-checkpoint"))
        return query.lastProgress

    def offsets(target):
        return sorted(tuple(r) for r in spark.read.parquet(target).collect())

    offset_log.land_log(log.filter("off < 12"), path, 10)
    run(out)
    assert offsets(out) == [(p, i) for p in (0, 1) for i in range(12)]
    offset_log.land_log(log.filter("off >= 12"), path, 10)
    progress = run(out)
    assert offsets(out) == [(p, i) for p in (0, 1) for i in range(25)]
    assert '"0": 25' in str(progress["sources"][0]["endOffset"]).replace("'", '"')
    replay = f"{out}-replay"
    run(replay, {0: 20, 1: 23})
    assert offsets(replay) == [(0, i) for i in range(20, 25)] + [(1, 23), (1, 24)]
    reader = offset_log.OffsetReader({"path": path, "rowsasegment": "10", "startingoffsets": "{}"})
    asked = reader.partitions({"0": 20, "1": 23}, reader.latestOffset())
    assert [(r.part, r.start, r.end) for r in asked] == [(0, 20, 25), (1, 23, 25)]
