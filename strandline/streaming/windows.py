"""Structured Streaming forms: the speaking-window machine over frames that arrive out of order, sessions, late rows."""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.folds import EMPTY, WINDOW_SCHEMA, window_finish, window_step

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FRAME = ("pts_ms", "target_present", "target_mar", "target_suspended", "other_present", "other_mar", "vad")
_WINDOW = Row("key", *(c.split()[0] for c in WINDOW_SCHEMA.split(", ")))


@contextmanager
def state_store(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which timers and list state need; the session's own setting comes back after."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, STATE_STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class SpeakingWindows(StatefulProcessor):
    """Frames wait in the key's state until the watermark has passed them, and then run through its machine in order of pts_ms.

    A timer stands at a key's first waiting frame, or, when none waits, idle_ms after the last one that ran: nothing more has come then, so the
    open window is closed as the end of the video and the key's state is dropped.  Machine, waiting frames and timer are one value, read and
    written once a call, as each call to the state store is a round trip; a key never holds more than what lies between its frames and the watermark.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "said string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from self._advance(key, [[r[c] for c in FRAME] for r in rows], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, [], timerValues)

    def _advance(self, key, frames: list, timerValues) -> list[Row]:
        """Run what the watermark has passed, close a video that has ended, and set the next timer."""
        now = timerValues.getCurrentWatermarkInMs()
        held = self.state.get()
        state, waiting, timer = json.loads(held[0]) if held else (dict(EMPTY), [], None)
        frames = sorted(waiting + frames, key=lambda f: f[0])
        n = bisect_right(frames, now, key=lambda f: f[0])
        found = []
        for f in frames[:n]:
            state, done = window_step(state, dict(zip(FRAME, f)))
            found += done
        left, last = frames[n:], state["previous"]
        if not left and last is not None and last + self.idle_ms <= now:
            found += window_finish(state)
            self._set(timer, None)
            self.state.clear()
        else:
            at = left[0][0] if left else last + self.idle_ms
            self._set(timer, at)
            self.state.update((json.dumps((state, left, at)),))
        return [_WINDOW(*key, *x) for x in found]

    def _set(self, old: int | None, at: int | None) -> None:
        """Leave one timer, at `at`, or none."""
        if old == at:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if at is not None:
            self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def speaking_windows_stream(frames: DataFrame, late_ms: int, idle_ms: int = 60_000) -> DataFrame:
    """Speaking windows of a stream of frames (key, pts_ms, ...), by any order of arrival within late_ms; start it inside state_store().

    Event time is pts_ms, shared by the keys.  A row with a null key only moves the watermark: such a heartbeat, late_ms + idle_ms after
    the last frame, lets a bounded stream close every video.  A frame that comes after the watermark has passed it is dropped.
    """
    timed = frames.select("key", *FRAME).withColumn("__at", F.timestamp_millis("pts_ms")).withWatermark("__at", f"{late_ms} milliseconds")
    return timed.groupBy("key").transformWithState(SpeakingWindows(idle_ms), f"key bigint, {WINDOW_SCHEMA}", "Append", "EventTime").where("key is not null")


def session_counts(events: DataFrame, ts: str, key: str, gap: str, lateness: str) -> DataFrame:
    """Closed sessions of a stream: rows of a key whose gaps are under `gap`."""
    marked = events.withWatermark(ts, lateness)
    return marked.groupBy(key, F.session_window(ts, gap).alias("s")).agg(F.count("*").alias("n")).select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def first_in_time(events: DataFrame, ts: str, ids: list[str], lateness: str) -> DataFrame:
    """Rows of a stream, one of those that repeat ids; what comes later than the watermark, which trails the latest row by `lateness`, is dropped by the engine."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(ids)
