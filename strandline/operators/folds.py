"""Ordered folds: per-key state machines that no window function expresses.

Rows are dealt by key, sorted within partitions, and streamed through Arrow batches; only the current
key's state is held, so a key of any size needs constant memory.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from ..functions.vectors import TINY


def ordered_fold(df: DataFrame, keys: list[str], order: list[str], start: Callable[[], Any], step: Callable, schema: str, finish: Callable | None = None) -> DataFrame:
    """Fold the rows of each key in order.

    step(state, row) and finish(state) return (state, tuples) and tuples; a row is a dict of df's columns.
    The result has the keys and then the tuples' columns (schema, DDL).
    """
    out = StructType([StructField(k, df.schema[k].dataType) for k in keys] + StructType.fromDDL(schema).fields)
    names = out.fieldNames()

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        key, state, ready = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                mine = tuple(row[k] for k in keys)
                if mine != key:
                    if finish and key is not None:
                        ready += [(*key, *x) for x in finish(state)]
                    key, state = mine, start()
                state, found = step(state, row)
                ready += [(*key, *x) for x in found]
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), arrow.types)], names=names)
                ready = []
        if finish and key is not None:
            ready = [(*key, *x) for x in finish(state)]
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), arrow.types)], names=names)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, out)


def greedy_clusters(df: DataFrame, keys: list[str], order: list[str], vector: str, keep: list[str], threshold: float) -> DataFrame:
    """Each vector joins the first cluster whose first member is similar enough, else begins one (number from 0)."""

    def step(state, row):
        """state: unit vectors of the first members, as the rows of a matrix that grows twofold, and their number."""
        first, n = state
        v = np.array(row[vector], np.float64)
        norm = np.sqrt(v @ v)
        u = v / norm if norm > TINY else np.zeros(len(v))
        near = np.flatnonzero(np.round(first[:n] @ u, 6) >= threshold) if n else ()
        if len(near):
            return state, ((*(row[k] for k in keep), int(near[0])),)
        if first is None or n == len(first):
            first = np.concatenate([np.zeros((0, len(u))) if first is None else first, np.zeros((max(16, n), len(u)))])
        first[n] = u
        return (first, n + 1), ((*(row[k] for k in keep), n),)

    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    return ordered_fold(df.select(*dict.fromkeys([*keys, *order, vector, *keep])), keys, order, lambda: (None, 0), step, f"{types}, cluster bigint")


@dataclass(frozen=True)
class WindowParams:
    """Mouth thresholds, hold time and smoothing."""

    mar_on: float = 0.15
    mar_off: float = 0.10
    hold_ms: int = 500
    span: int = 5


#: State of the speaking-window machine, as a flat record that streaming state can keep.
EMPTY = {"mode": "IDLE", "ema": None, "other_ema": None, "start": None, "deadline": None, "previous": None, "frames": 0, "present": 0, "closed": 0}
WINDOW_SCHEMA = "start_ms bigint, stop_ms bigint, reason string, frames bigint, other_present bigint, other_closed bigint"


def window_step(state: dict, o: dict, p: WindowParams = WindowParams()):
    """One frame of the speaking-window machine: the new state, and the window that it ends, if any.

    A frame has pts_ms, target_present, target_mar, target_suspended, other_present, other_mar, vad.
    A mean is x / half + old * (half - 1) / half, not alpha * x + (1 - alpha) * old with alpha = 1 / half: means often meet a threshold exactly,
    where the last bit decides, and this is the arithmetic that the SQL counterpart states.
    """
    s = dict(state)
    half = (p.span + 1) / 2
    smooth = lambda old, x: x if old is None else x / half + old * (half - 1) / half
    if not o["other_present"]:
        s["other_ema"] = None
    elif o["other_mar"] is not None:
        s["other_ema"] = smooth(s["other_ema"], o["other_mar"])
    if not o["target_present"]:
        s["ema"] = None
    elif not o["target_suspended"] and o["target_mar"] is not None:
        s["ema"] = smooth(s["ema"], o["target_mar"])
    open_ = s["ema"] is not None and s["ema"] > p.mar_on
    done, count = [], False
    if s["mode"] == "HOLD":
        if o["target_suspended"]:
            s["deadline"] += o["pts_ms"] - s["previous"] if s["previous"] is not None else 0
            count = True
        elif o["pts_ms"] >= s["deadline"]:
            done = [_close(s, s["deadline"], "plosive_expiry")]
        elif o["other_present"] and s["other_ema"] is not None and s["other_ema"] > p.mar_on:
            done = [_close(s, o["pts_ms"], "interviewer_interjection")]
        else:
            if o["target_present"] and open_ and o["vad"]:
                s["mode"] = "ACTIVE"
            count = True
    elif s["mode"] == "ACTIVE":
        quiet = not o["target_present"] or (s["ema"] is not None and s["ema"] < p.mar_off) or not o["vad"]
        if quiet and not o["target_suspended"]:
            s["mode"], s["deadline"] = "HOLD", o["pts_ms"] + p.hold_ms
        count = True
    if s["mode"] == "IDLE" and o["target_present"] and not o["target_suspended"] and open_ and o["vad"]:
        s["mode"], s["start"], count = "ACTIVE", o["pts_ms"], True
    if count:
        s["frames"] += 1
        if o["other_present"]:
            s["present"] += 1
            s["closed"] += s["other_ema"] is not None and s["other_ema"] < p.mar_off
    s["previous"] = o["pts_ms"]
    return s, done


def _close(s: dict, stop: int, reason: str) -> tuple:
    done = (s["start"], stop, reason, s["frames"], s["present"], s["closed"])
    s |= {"mode": "IDLE", "frames": 0, "present": 0, "closed": 0}
    return done


def window_finish(state: dict) -> list[tuple]:
    """What the end of the frames closes."""
    return [_close(dict(state), state["previous"], "end_of_video")] if state["mode"] != "IDLE" else []


def speaking_windows(frames: DataFrame, keys: list[str], p: WindowParams = WindowParams()) -> DataFrame:
    """Speaking windows of each key's frames, in order of pts_ms."""
    return ordered_fold(frames, keys, ["pts_ms"], lambda: dict(EMPTY), lambda s, o: window_step(s, o, p), WINDOW_SCHEMA, window_finish)
