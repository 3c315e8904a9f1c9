"""Admission decisions and time-to-live deduplication over a request log ``(event_id, key, ts)``.

The rules depend on the order of a key's requests, but not on all of its history:

* requests of one key at one instant differ only by id, and only the first few of them can change the state, so
  a key's requests are reduced to one bounded row per instant before they are shuffled by key;
* after a quiet stretch the state is the initial one again, so a key is cut there. The cuts are found from the
  first and last instant per key and time cell, never from a sort of the whole key;
* a stretch with more instants than one task should take is cut into pieces as well, which run one after another:
  the state at the end of a piece is a row of the next round. Pieces are numbered per stretch without gaps, so a
  round holds the next piece of every stretch that has one, and without a long stretch there is one round;
* a piece is folded as a stream of sorted rows with a constant-size state;
* the decisions go back to the requests by key and instant, which spreads a hot key over all tasks.

A request without a key or a time has no place in any order: it is returned undecided, with nulls.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import epoch_micros
from ..schemas import (
    DEDUPE_TTL_SECONDS, FIXED_LIMIT, SLIDING_LIMIT, SLIDING_SECONDS, TOKEN_CAPACITY, TOKEN_REFILL_PER_SECOND,
)
from ..session import settle
from .spread import salted_join

MICROS = 1_000_000
ROWS_PER_TASK = 5_000_000
# A rule takes the state and the time in whole microseconds, so that equal times compare as equal.
Step = Callable[[Any, int], tuple[Any, bool, float, float]]


@dataclass(frozen=True)
class Rule:
    """A step and the way its state is written as JSON between rounds or micro-batches."""

    step: Step
    load: Callable[[Any], Any]
    dump: Callable[[Any], Any]

    def read_state(self, text: str) -> Any:
        return self.load(json.loads(text))

    def write_state(self, state: Any) -> str:
        return json.dumps(self.dump(state))


def token_bucket_rule(capacity: float, refill: float) -> Rule:
    """State ``(tokens, last)``. A step returns the state, allowed, tokens left and seconds until a token."""

    def step(state, now):
        tokens, last = state if state is not None else (float(capacity), now)
        tokens = min(float(capacity), tokens + (now - last) / MICROS * refill)
        allowed = tokens >= 1
        if allowed:
            tokens -= 1
        return (tokens, now), allowed, tokens, max(0.0, (1.0 - tokens) / refill)

    return Rule(step, load=tuple, dump=list)


def sliding_window_rule(limit: int, window: float) -> Rule:
    """State: times of the allowed requests. A step returns the state, allowed, requests left and seconds to reset."""
    width = int(window * MICROS)

    def step(state, now):
        times = state if state is not None else deque()
        while times and times[0] < now - width:
            times.popleft()
        used = len(times)
        allowed = used < limit
        if allowed:
            times.append(now)
        left = float(limit - used - 1) if allowed else 0.0
        return times, allowed, left, max(0, times[0] + width - now) / MICROS if times else 0.0

    return Rule(step, load=deque, dump=list)


def ttl_rule(ttl: float) -> Rule:
    """State: time of the last acceptance, which duplicates do not refresh."""

    def step(state, now):
        accepted = state is None or now - state > ttl * MICROS
        return (now if accepted else state), accepted, 0.0, 0.0

    return Rule(step, load=int, dump=int)


def _instants(requests: DataFrame, per_instant: int) -> DataFrame:
    """One row per key and instant with the ids that can change the state, at most ``per_instant`` of them."""
    rows = requests.select("key", "ts", "event_id").filter("key IS NOT NULL AND ts IS NOT NULL")
    if per_instant == 1:
        lists = rows.groupBy("key", "ts").agg(F.array(F.min("event_id")).alias("ids"))
    else:
        order = Window.partitionBy("key", "ts").orderBy("event_id")
        heads = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_instant)
        lists = heads.groupBy("key", "ts").agg(F.array_sort(F.collect_list("event_id")).alias("ids"))
    return lists.withColumn("micros", epoch_micros("ts"))


def _cells(instants: DataFrame, quiet_seconds: float, rows_per_task: int) -> DataFrame:
    """Time cells of every key with their ``stretch`` and ``piece``.

    A key falls into a new stretch after a gap longer than ``quiet_seconds``. Such a gap is longer than a cell, so
    the first and last instant of the cells find every one. A stretch starts a new piece when the cells so far
    hold another ``rows_per_task`` instants; a single cell with more than that still makes one piece.
    """
    quiet = int(quiet_seconds * MICROS)
    by_time = Window.partitionBy("key").orderBy("_cell")
    earlier = Window.partitionBy("key", "stretch").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    return (
        instants.groupBy("key", _cell_of(quiet_seconds))
        .agg(F.min("micros").alias("_low"), F.max("micros").alias("_high"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_new", F.coalesce((F.col("_low") - F.lag("_high").over(by_time) > quiet).cast("int"), F.lit(1)))
        .withColumn("stretch", F.sum("_new").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_full", F.floor(F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) / F.lit(rows_per_task)))
        .withColumn("piece", F.dense_rank().over(Window.partitionBy("key", "stretch").orderBy("_full")) - 1)
        .select("key", "_cell", "stretch", "piece")
    )


def _cell_of(quiet_seconds: float):
    return F.floor(F.col("micros") / F.lit(max(MICROS, int(quiet_seconds * MICROS) // 8))).alias("_cell")


def _fold(rows: DataFrame, make_rule: Callable[[], Rule], partitions: int | None) -> DataFrame:
    """Runs the rule over the sorted instants of every piece, carrying the state from batch to batch.

    A row with a ``state`` and no ids opens a piece with the state that the one before it has left. Every piece
    ends with such a row for the next one.
    """
    item = pa.struct([("event_id", pa.int64()), ("allowed", pa.bool_()), ("remaining", pa.float64()), ("wait_seconds", pa.float64())])

    def packed(rows: list[tuple], decisions: list[tuple]) -> pa.RecordBatch:
        """Rows ``(key, stretch, micros, number of decisions, state)`` with their decisions, which follow in order."""
        keys, stretches, times, counts, states = zip(*rows) if rows else [()] * 5
        starts, total = [], 0
        for count in counts:
            starts.append(None if count is None else total)
            total += count or 0
        fields = zip(*decisions) if decisions else [()] * 4
        items = pa.StructArray.from_arrays([pa.array(values, f.type) for values, f in zip(fields, item)], fields=list(item))
        lists = pa.ListArray.from_arrays(pa.array([*starts, total], pa.int32()), items)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(stretches, pa.int64()), pa.array(times, pa.timestamp("us")), lists,
             pa.array(states, pa.string())],
            names=["key", "stretch", "ts", "decisions", "state"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = make_rule()
        group, state = None, None
        for batch in batches:
            done, decisions = [], []
            for key, stretch, micros, ids, opening in zip(*(column.to_pylist() for column in batch.columns)):
                if (key, stretch) != group:
                    if group is not None:
                        done.append((*group, None, None, rule.write_state(state)))
                    group, state = (key, stretch), None
                if opening is not None:
                    state = rule.read_state(opening)
                    continue
                for event_id in ids:
                    state, allowed, left, wait = rule.step(state, micros)
                    decisions.append((event_id, allowed, left, wait))
                done.append((key, stretch, micros, len(ids), None))
            yield packed(done, decisions)
        if group is not None:
            yield packed([(*group, None, None, rule.write_state(state))], [])

    by = ["key", "stretch"]
    shuffled = rows.repartition(partitions, *by) if partitions else rows.repartition(*by)
    schema = (
        "key string, stretch bigint, ts timestamp_ntz, "
        "decisions array<struct<event_id: bigint, allowed: boolean, remaining: double, wait_seconds: double>>, state string"
    )
    return shuffled.select(*by, "micros", "ids", "state").sortWithinPartitions(*by, "micros").mapInArrow(run, schema)


def _decided(
    instants: DataFrame, make_rule: Callable[[], Rule], quiet_seconds: float, partitions: int | None, rows_per_task: int
) -> DataFrame:
    """The decisions of every key and instant.

    The placed instants are written once, in a folder per piece, and each round reads its own.
    """
    cells = _cells(instants, quiet_seconds, rows_per_task)
    placed = instants.withColumn("_cell", _cell_of(quiet_seconds)).join(cells, ["key", "_cell"])
    rows = settle(placed.select("key", "stretch", "micros", "ids", F.lit(None).cast("string").alias("state"), "piece"), "rule-pieces", "piece")
    rounds = (rows.agg(F.max("piece").alias("p")).first()["p"] or 0) + 1
    done, states = [], None
    for piece in range(rounds):
        current = rows.filter(F.col("piece") == piece).drop("piece")
        if states is not None:
            # Every stretch of this round was in the one before; those that have ended leave their state behind.
            going = current.select("key", "stretch").distinct()
            opening = states.join(going, ["key", "stretch"], "left_semi").select(
                "key", "stretch", F.lit(-(2**63)).alias("micros"), F.array().cast("array<bigint>").alias("ids"), "state",
            )
            current = current.unionByName(opening)
        result = settle(_fold(current, make_rule, partitions), "rule-round")
        states = result.filter(F.col("state").isNotNull()).select("key", "stretch", "state")
        done.append(result.filter(F.col("state").isNull()).select("key", "ts", "decisions"))
    return reduce(DataFrame.unionByName, done)


def _decide(
    requests: DataFrame, make_rule: Callable[[], Rule], per_instant: int, quiet_seconds: float, partitions: int | None,
    rows_per_task: int,
) -> DataFrame:
    instants = settle(_instants(requests, per_instant), "instants")
    decided = _decided(instants, make_rule, quiet_seconds, partitions, rows_per_task)
    own = F.get(F.filter("decisions", lambda d: d["event_id"] == F.col("event_id")), F.lit(0))
    # A request beyond the listed ones of its instant is refused in the state the last listed one left.
    last = F.element_at("decisions", -1)
    return (
        requests.join(decided, ["key", "ts"], "left")
        .withColumn("_own", own)
        .withColumn("_last", last)
        .withColumn("allowed", F.when(F.col("decisions").isNotNull(), F.coalesce(F.col("_own.allowed"), F.lit(False))))
        .withColumn("remaining", F.coalesce("_own.remaining", "_last.remaining"))
        .withColumn("wait_seconds", F.coalesce("_own.wait_seconds", "_last.wait_seconds"))
        .drop("_own", "_last", "decisions")
    )


def token_bucket(
    requests: DataFrame, capacity: int = TOKEN_CAPACITY, refill_per_second: float = TOKEN_REFILL_PER_SECOND,
    partitions: int | None = None, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds ``allowed``, ``remaining`` tokens and ``wait_seconds`` until the next token.

    A bucket is surely full again after the time a whole refill takes, plus a second for rounding. At most
    ``capacity`` requests of one instant can be served; one more shows the state the others are refused in.
    """
    quiet = capacity / refill_per_second + 1
    return _decide(requests, lambda: token_bucket_rule(capacity, refill_per_second), capacity + 1, quiet, partitions, rows_per_task)


def sliding_window(
    requests: DataFrame, limit: int = SLIDING_LIMIT, window_seconds: int = SLIDING_SECONDS,
    partitions: int | None = None, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds ``allowed``, ``remaining`` requests and ``reset_in`` seconds until the oldest one expires."""
    rule = lambda: sliding_window_rule(limit, window_seconds)
    decided = _decide(requests, rule, limit + 1, window_seconds, partitions, rows_per_task)
    return decided.withColumnRenamed("wait_seconds", "reset_in")


def dedupe_ttl(
    events: DataFrame, ttl_seconds: int = DEDUPE_TTL_SECONDS, partitions: int | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Adds ``accepted``: the key is new, or its last acceptance is longer ago than the time to live."""
    decided = _decide(events, lambda: ttl_rule(ttl_seconds), 1, ttl_seconds, partitions, rows_per_task)
    return decided.withColumnRenamed("allowed", "accepted").drop("remaining", "wait_seconds")


def fixed_window(requests: DataFrame, limit: int = FIXED_LIMIT, window_seconds: int = 60) -> DataFrame:
    """Adds ``window_start`` and ``allowed``: the request is among the first ``limit`` of its key and window.

    Only the first ``limit`` requests of a window are ranked; their last one is the bar for all others. A request
    without a key or a time is returned undecided.
    """
    place = F.struct("ts", "event_id")
    width = window_seconds * MICROS
    start = F.timestamp_micros(F.floor(epoch_micros("ts") / F.lit(width)) * F.lit(width)).cast("timestamp_ntz")
    windowed = requests.withColumn("window_start", start)
    order = Window.partitionBy("key", "window_start").orderBy("ts", "event_id")
    bars = (
        windowed.filter("key IS NOT NULL AND ts IS NOT NULL")
        .withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= limit)
        .groupBy("key", "window_start")
        .agg(F.max(place).alias("_bar"))
    )
    joined = salted_join(windowed, bars, ["key", "window_start"], "left", salt_by=F.col("event_id"))
    return joined.withColumn("allowed", place <= F.col("_bar")).drop("_bar")
