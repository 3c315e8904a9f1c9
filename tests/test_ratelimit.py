"""The split folds against plain loops over the whole log."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ratelimit
from tidemark.sources import tables


def frame(spark, rows):
    at = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("ms") / 1000).cast("decimal(18,6)")
    )
    return spark.createDataFrame(rows, "event_id BIGINT, key STRING, ms BIGINT").select("event_id", "key", at.alias("ts"))


def ordered(rows):
    return sorted(rows, key=lambda r: (r[2], r[0]))


def loop_tokens(rows, capacity, refill):
    state, out = {}, {}
    for event_id, key, ms in ordered(rows):
        tokens, last = state.get(key, (float(capacity), ms))
        tokens = min(float(capacity), tokens + (ms - last) / 1000 * refill)
        allowed = tokens >= 1
        tokens -= allowed
        state[key] = (tokens, ms)
        out[event_id] = (allowed, round(tokens, 6), round(max(0.0, (1 - tokens) / refill), 6))
    return out


def loop_sliding(rows, limit, window):
    state, out = {}, {}
    for event_id, key, ms in ordered(rows):
        kept = [t for t in state.get(key, []) if t >= ms - window * 1000]
        allowed = len(kept) < limit
        left = limit - len(kept) - 1 if allowed else 0
        kept = kept + [ms] if allowed else kept
        state[key] = kept
        out[event_id] = (allowed, left, max(0, kept[0] + window * 1000 - ms) / 1000)
    return out


def loop_ttl(rows, ttl):
    state, out = {}, {}
    for event_id, key, ms in ordered(rows):
        out[event_id] = key not in state or ms - state[key] > ttl * 1000
        if out[event_id]:
            state[key] = ms
    return out


def bursty(seed, n=600):
    """One key with most of the rows: bursts at one instant, dense stretches and quiet gaps."""
    rng, rows, clock = random.Random(seed), [], {"hot": 0, "cold": 0, "rare": 0}
    for event_id in range(n):
        key = rng.choices(["hot", "cold", "rare"], [8, 2, 1])[0]
        clock[key] += rng.choices([0, rng.randint(1, 900), 1000, 30_000, 60_000, 200_000], [6, 8, 4, 1, 1, 0.5])[0]
        rows.append((event_id, key, clock[key]))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_folds_equal_the_loops(spark, seed):
    rows = bursty(seed)
    requests = frame(spark, rows)
    tokens = {
        r.event_id: (r.allowed, round(r.remaining, 6), round(r.wait_seconds, 6))
        for r in ratelimit.token_bucket(requests, 5, 0.5, partitions=3).collect()
    }
    assert tokens == loop_tokens(rows, 5, 0.5)
    sliding = {r.event_id: (r.allowed, r.remaining, r.reset_in) for r in ratelimit.sliding_window(requests, 4, 60).collect()}
    assert sliding == loop_sliding(rows, 4, 60)
    assert {r.event_id: r.accepted for r in ratelimit.dedupe_ttl(requests, 30).collect()} == loop_ttl(rows, 30)


def test_borders(spark):
    full = [(i, "k", 0) for i in range(4)] + [(9, "k", 2000)]
    assert {r.event_id: r.allowed for r in ratelimit.token_bucket(frame(spark, full), 3, 0.5).collect()} == {0: True, 1: True, 2: True, 3: False, 9: True}
    kept = [(0, "k", 0), (1, "k", 60_000), (2, "k", 60_001)]
    assert {r.event_id: r.allowed for r in ratelimit.sliding_window(frame(spark, kept), 1, 60).collect()} == {0: True, 1: False, 2: True}
    ttl = [(0, "k", 0), (1, "k", 60_000), (2, "k", 60_001), (3, "k", 120_001), (4, "k", 120_002)]
    assert {r.event_id: r.accepted for r in ratelimit.dedupe_ttl(frame(spark, ttl), 60).collect()} == {0: True, 1: False, 2: True, 3: False, 4: True}


def test_fixed_window(spark):
    rows = [(i, "k", 0) for i in range(50)] + [(90, "k", 59_999), (91, "k", 60_000), (92, "j", 0)]
    allowed = {r.event_id for r in ratelimit.fixed_window(frame(spark, rows), 3).filter("allowed").collect()}
    assert allowed == {0, 1, 2, 91, 92}


def test_expected_totals(spark):
    log = tables.request_log(spark, "/root/testdata/sf0.001")
    assert ratelimit.token_bucket(log).filter("NOT allowed").count() == 88
    assert ratelimit.sliding_window(log).filter("NOT allowed").count() == 290


def test_quiet_gaps_cut_a_key(spark):
    rows = [(i, "k", (i // 10) * 500_000 + i % 10) for i in range(100)]
    instants = ratelimit._instants(frame(spark, rows), 2)
    cut = ratelimit._cells(instants, 60, 1000)
    assert cut.select("stretch").distinct().count() == 10 and cut.filter("piece > 0").count() == 0
    assert ratelimit._cells(instants, 1000, 10).select("piece").distinct().count() == 10


@pytest.mark.parametrize("seed", [3])
def test_long_stretches_go_in_rounds(spark, seed):
    rows = [(event_id, key, ms // 6) for event_id, key, ms in bursty(seed, 400)]
    requests = frame(spark, rows)
    tokens = {
        r.event_id: (r.allowed, round(r.remaining, 6), round(r.wait_seconds, 6))
        for r in ratelimit.token_bucket(requests, 20, 0.1, rows_per_task=60).collect()
    }
    assert tokens == loop_tokens(rows, 20, 0.1)
    sliding = ratelimit.sliding_window(requests, 4, 60, rows_per_task=40).collect()
    assert {r.event_id: (r.allowed, r.remaining, r.reset_in) for r in sliding} == loop_sliding(rows, 4, 60)
    assert {r.event_id: r.accepted for r in ratelimit.dedupe_ttl(requests, 90, rows_per_task=50).collect()} == loop_ttl(rows, 90)


def dense(n=90):
    """Half a second apart, some instants repeated, one long gap."""
    return [(i, "hot", (i - i % 4) * 500 + (200_000 if i > 60 else 0)) for i in range(n)] + [(1000 + i, "cold", i * 7000) for i in range(12)]


@pytest.mark.parametrize("size", [1, 5, 7, 60, 5_000_000])
def test_pieces_never_change_a_decision(spark, size):
    rows = dense(60 if size == 1 else 90)
    requests = frame(spark, rows)
    tokens = {
        r.event_id: (r.allowed, round(r.remaining, 6), round(r.wait_seconds, 6))
        for r in ratelimit.token_bucket(requests, 10, 0.5, rows_per_task=size).collect()
    }
    assert tokens == loop_tokens(rows, 10, 0.5)
    sliding = ratelimit.sliding_window(requests, 6, 30, rows_per_task=size).collect()
    assert {r.event_id: (r.allowed, r.remaining, r.reset_in) for r in sliding} == loop_sliding(rows, 6, 30)
    assert {r.event_id: r.accepted for r in ratelimit.dedupe_ttl(requests, 12, rows_per_task=size).collect()} == loop_ttl(rows, 12)


def test_requests_without_key_or_time_come_back_undecided(spark):
    requests = frame(spark, [(1, "k", 0), (2, None, 0), (3, "k", None), (4, None, None)])
    for decided, column in (
        (ratelimit.token_bucket(requests, 3, 1.0), "allowed"), (ratelimit.sliding_window(requests, 3, 5), "allowed"),
        (ratelimit.dedupe_ttl(requests, 5), "accepted"), (ratelimit.fixed_window(requests, 3), "allowed"),
    ):
        assert {r["event_id"]: r[column] for r in decided.collect()} == {1: True, 2: None, 3: None, 4: None}


def test_no_requests(spark):
    assert ratelimit.token_bucket(frame(spark, [(1, "k", 0)]).filter("false")).count() == 0
