"""Rules that keep a state per key over micro-batches: admission, time-to-live dedupe, delivery attempts.

The rules are those of ``operators.ratelimit``. Rows of a key are taken in time order inside a micro-batch and in
order of arrival across micro-batches; the size of a micro-batch bounds what a key brings along.
"""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.scalars import epoch_micros, event_time
from ..operators.ratelimit import Rule, sliding_window_rule, token_bucket_rule
from ..schemas import DEDUPE_TTL_SECONDS, MAX_DELIVERIES, SLIDING_LIMIT, SLIDING_SECONDS, TOKEN_CAPACITY, TOKEN_REFILL_PER_SECOND

DECISION = "key string, event_id bigint, ts timestamp_ntz, allowed boolean, remaining double, wait_seconds double"
STATE = "state string"
ACCEPTED = "key string, event_id bigint, ts timestamp_ntz, accepted boolean"
LATENESS = "1 hour"
OFFSET_BITS = 10
MESSAGES_PER_STATE = 1 << OFFSET_BITS
ROWS_IN_MEMORY = 500_000
ROWS_AT_ONCE = 50_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _whole(*columns: pd.Series) -> np.ndarray:
    """Columns of whole numbers side by side; a null raises."""
    return np.column_stack([c.astype("int64") for c in columns])


def _in_order(batches: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """The rows of a group of any size by their first two columns, in pieces of at most ``ROWS_AT_ONCE`` rows.

    Beyond ``ROWS_IN_MEMORY`` rows they are sorted in runs, which go to one file in the executor's own folder and are merged from
    there: blocks of all runs are in memory, and what does not exceed the end of any block that has one after it comes next.
    """

    def ordered(parts: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(parts)
        return rows[np.lexsort((rows[:, 1], rows[:, 0]))]

    def pieces(rows: np.ndarray) -> Iterator[np.ndarray]:
        return (rows[i : i + ROWS_AT_ONCE] for i in range(0, len(rows), ROWS_AT_ONCE))

    held, count, runs = [], 0, []
    # Spooled: without a run there is no file.
    with tempfile.SpooledTemporaryFile(1, dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None) as file:

        def spill() -> None:
            runs.append([file.tell(), count])
            file.write(ordered(held).tobytes())

        for batch in batches:
            if held and count + len(batch) > ROWS_IN_MEMORY:
                spill()
                held, count = [], 0
            held.append(batch)
            count += len(batch)
        if not runs:
            yield from pieces(ordered(held))
            return
        spill()
        width, held = held[0].shape[1], []
        block = max(1, ROWS_IN_MEMORY // len(runs))
        heads = [np.empty((0, width), np.int64) for _ in runs]
        while True:
            for i, (at, left) in enumerate(runs):
                more = min(left, block - len(heads[i]))
                if more:
                    file.seek(at)
                    read = np.frombuffer(file.read(more * width * 8), np.int64).reshape(-1, width)
                    heads[i] = np.concatenate([heads[i], read])
                    runs[i] = [at + more * width * 8, left - more]
            ends = [tuple(head[-1, :2]) for head, (_, left) in zip(heads, runs) if left]
            if not ends:
                yield from pieces(ordered(heads))
                return
            first, second = min(ends)
            out = []
            for i, head in enumerate(heads):
                if len(head) and head[0, 0] <= first:
                    low, high = np.searchsorted(head[:, 0], first, "left"), np.searchsorted(head[:, 0], first, "right")
                    n = low + np.searchsorted(head[low:high, 1], second, "right")
                    out.append(head[:n])
                    heads[i] = head[n:]
            yield from pieces(ordered(out))


def _decide(requests: DataFrame, make_rule: Callable[[], Rule], quiet_seconds: float, lateness: str) -> DataFrame:
    """One decision per request; the state of a key is a short text.

    A key that has been quiet for ``quiet_seconds`` is in its first state again. Its state is dropped when the watermark,
    ``lateness`` behind the newest request, has passed that time. Requests behind the watermark are not decided.
    The requests of a key are sorted in runs of bounded size and decided piece by piece, however many a micro-batch brings.
    """

    def decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rule = make_rule()
        current = rule.read_state(state.get[0]) if state.exists else None
        for rows in _in_order(_whole(rows["micros"], rows["event_id"]) for rows in batches):
            out = []
            for micros in rows[:, 0].tolist():
                current, allowed, left, wait = rule.step(current, micros)
                out.append((bool(allowed), float(left), float(wait)))
            decided = pd.DataFrame(out, columns=["allowed", "remaining", "wait_seconds"])
            decided.insert(0, "key", key[0])
            decided.insert(1, "event_id", rows[:, 1])
            decided.insert(2, "ts", rows[:, 0].astype("datetime64[us]"))
            yield decided
        state.update((rule.write_state(current),))
        forgotten = int(micros / 1000 + quiet_seconds * 1000) + 1
        state.setTimeoutTimestamp(max(forgotten, state.getCurrentWatermarkMs() + 1))

    timed = requests.withColumn("_at", event_time("ts")).withWatermark("_at", lateness)
    timed = timed.select("key", "event_id", epoch_micros("ts").alias("micros"), "_at")
    return timed.groupBy("key").applyInPandasWithState(decide, DECISION, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def token_bucket_stream(
    requests: DataFrame, capacity: int = TOKEN_CAPACITY, refill_per_second: float = TOKEN_REFILL_PER_SECOND, lateness: str = LATENESS
) -> DataFrame:
    return _decide(requests, lambda: token_bucket_rule(capacity, refill_per_second), capacity / refill_per_second + 1, lateness)


def sliding_window_stream(
    requests: DataFrame, limit: int = SLIDING_LIMIT, window_seconds: int = SLIDING_SECONDS, lateness: str = LATENESS
) -> DataFrame:
    decided = _decide(requests, lambda: sliding_window_rule(limit, window_seconds), window_seconds, lateness)
    return decided.withColumnRenamed("wait_seconds", "reset_in")


def dedupe_ttl_stream(events: DataFrame, ttl_seconds: float = DEDUPE_TTL_SECONDS, lateness: str = LATENESS) -> DataFrame:
    """``accepted`` for the first event of a key and for those over ``ttl_seconds`` after the last accepted one.

    The state of a key is one number, kept by the engine in RocksDB, and a timer on event time removes it: as soon as the watermark,
    ``lateness`` behind the newest event, is past the time to live, nothing of the key is left. (The engine's own time to live runs on
    the clock of the machine, so a replay would not decide as the first run did.) Events behind the watermark are not decided.
    """
    ttl = int(ttl_seconds * 1_000_000)

    class Accepted(StatefulProcessor):
        """``last`` holds the time of the newest accepted event. Defined here, so that it is shipped by value."""

        def init(self, handle):
            self.handle, self.last = handle, handle.getValueState("last", "micros BIGINT")

        def _gone_at(self, micros):
            """The first millisecond at which every later event is accepted anyway."""
            return (micros + ttl) // 1000 + 1

        def handleInputRows(self, key, rows, timerValues):
            batch = pd.concat(list(rows)).sort_values(["micros", "event_id"])
            held = self.last.get()[0] if self.last.exists() else None
            last, accepted = held, []
            for micros in batch["micros"]:
                accepted.append(last is None or int(micros) - last > ttl)
                last = int(micros) if accepted[-1] else last
            if last != held:
                if held is not None:
                    self.handle.deleteTimer(self._gone_at(held))
                self.last.update((last,))
                self.handle.registerTimer(self._gone_at(last))
            yield pd.DataFrame({"key": key[0], "event_id": batch["event_id"], "ts": batch["ts"], "accepted": accepted})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.last.clear()
            yield from ()

        def close(self):
            pass

    # The operator exists on this store only. A query that restarts keeps the store noted in its checkpoint.
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = events.withColumn("_at", event_time("ts")).withWatermark("_at", lateness)
    timed = timed.select("key", "event_id", "ts", epoch_micros("ts").alias("micros"), "_at")
    return timed.groupBy("key").transformWithStateInPandas(Accepted(), ACCEPTED, "append", "eventTime")


def retry_stream(deliveries: DataFrame, max_attempts: int = MAX_DELIVERIES) -> DataFrame:
    """Outcome of every delivery ``(part, off, attempt_no, ok)``: done, to be tried again, or dead letter.

    Messages of ``MESSAGES_PER_STATE`` adjacent offsets share a group and its state, the counters of those with failures behind
    them: a call of the function costs about as much as thousands of rows, so it is not made per message.
    """
    # The first failure sends a message to the dead letters at any lower limit too.
    limit = max(1, max_attempts)

    def count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        part, block = (None if pd.isna(k) else int(k) for k in key)
        pending = np.zeros(MESSAGES_PER_STATE, np.int64)
        if state.exists:
            places, counts = json.loads(state.get[0])
            pending[places] = counts
        columns = (_whole(rows["place"], rows["attempt_no"], rows["ok"].eq(True)) for rows in batches)
        for rows in _in_order(columns):
            place, attempt_no, ok = rows[:, 0], rows[:, 1], rows[:, 2] == 1
            index = np.arange(len(rows))
            first = np.append(True, place[1:] != place[:-1])
            start = np.maximum.accumulate(np.where(first, index, 0))
            last_ok = np.maximum.accumulate(np.where(ok, index, -1))
            # Failures in a row: since the last success here, or else since the start and what is pending.
            held = np.where(last_ok < start, pending[place], 0)
            run = index - np.where(last_ok < start, start - 1, last_ok) + held
            # What is pending reaches the limit only if that was higher before a restart.
            over = np.maximum(held - (limit - 1), 0)
            attempts = np.where(ok, 0, (run - over - 1) % limit + 1)
            dead = attempts == limit
            attempts += np.where(run - over == limit, over, 0)
            last = np.append(first[1:], True)
            pending[place[last]] = np.where(dead, 0, attempts)[last]
            outcome = np.where(ok, "done", np.where(dead, "dead_letter", "retry")).astype(object)
            off = None if block is None else block * MESSAGES_PER_STATE + place
            yield pd.DataFrame({"part": part, "off": off, "attempt_no": attempt_no, "outcome": outcome, "attempts": attempts})
        places = np.flatnonzero(pending)
        if len(places):
            state.update((json.dumps([places.tolist(), pending[places].tolist()]),))
        elif state.exists:
            state.remove()

    # Rows without an offset are one message, as a key that is null.
    place = F.coalesce(F.col("off").bitwiseAND(MESSAGES_PER_STATE - 1), F.lit(0))
    blocks = deliveries.select("part", F.shiftright("off", OFFSET_BITS).alias("_block"), place.alias("place"), "attempt_no", "ok")
    return blocks.groupBy("part", "_block").applyInPandasWithState(
        count, "part int, off bigint, attempt_no int, outcome string, attempts int", STATE, "append", GroupStateTimeout.NoTimeout
    )
