"""Gaps and islands: runs, merged intervals, segments from probabilities.

Every operator partitions by its keys and needs one sort within them, so one exchange serves all its
steps.  None has a window over the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], order: list, starts, name: str = "island") -> DataFrame:
    """Number the islands of each key; starts(window) says whether a row begins one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__new", F.when(starts(w), 1).otherwise(0)).withColumn(name, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def merge_intervals(df: DataFrame, keys: list[str], start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Unite intervals that overlap or touch; empty and reversed ones go."""
    reach = lambda w: F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = islands(df.where(F.col(end) > F.col(start)), keys, [start, end], lambda w: reach(w).isNull() | (F.col(start) > reach(w)))
    return marked.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("island")


def runs(df: DataFrame, keys: list[str], index: str, holds: Column) -> DataFrame:
    """Maximal runs of consecutive indices where a condition holds: first, past-the-end index and size."""
    w = Window.partitionBy(*keys).orderBy(index)
    found = df.where(holds).withColumn("__run", F.col(index) - F.row_number().over(w))
    return found.groupBy(*keys, "__run").agg(F.min(index).alias("first"), (F.max(index) + 1).alias("stop"), F.count("*").alias("n")).drop("__run")


@dataclass(frozen=True)
class SegmentParams:
    """Detection threshold and durations."""

    threshold: float = 0.5
    window_samples: int = 512
    sample_rate: int = 16_000
    min_speech_ms: int = 250
    min_silence_ms: int = 100
    pad_ms: int = 30


def segments_from_probabilities(df: DataFrame, keys: list[str], index: str, prob: str, p: SegmentParams = SegmentParams()) -> DataFrame:
    """Windows with prob >= threshold become segments: runs, then gaps under min_silence closed, then
    segments under min_speech dropped, then padding within the recording and touching ones united."""
    at = lambda n: F.expr(f"({n} * {p.window_samples} * 1000) div {p.sample_rate}")
    w = Window.partitionBy(*keys)
    # the recording's length and the runs come from one exchange by key
    held = df.withColumn("__total", F.max(at(f"({index} + 1)")).over(w)).where(F.col(prob) >= p.threshold)
    held = held.withColumn("__run", F.col(index) - F.row_number().over(w.orderBy(index)))
    found = held.groupBy(*keys, "__total", "__run").agg(F.min(index).alias("first"), (F.max(index) + 1).alias("stop"))
    found = found.select(*keys, "__total", at("first").alias("start_ms"), at("stop").alias("end_ms"))
    gap = lambda w: F.col("start_ms") - F.lag("end_ms").over(w)
    joined = islands(found, keys, ["start_ms"], lambda w: gap(w).isNull() | (gap(w) >= p.min_silence_ms))
    joined = joined.groupBy(*keys, "__total", "island").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")).drop("island")
    kept = joined.where(F.col("end_ms") - F.col("start_ms") >= p.min_speech_ms)
    padded = kept.select(*keys, F.greatest(F.col("start_ms") - p.pad_ms, F.lit(0)).alias("start_ms"), F.least(F.col("end_ms") + p.pad_ms, "__total").alias("end_ms"))
    return merge_intervals(padded, keys)


def spans_of_points(df: DataFrame, keys: list[str], at: str, holds: Column, step: str | int, least_ms: int, factor: int = 3) -> DataFrame:
    """Spans of qualifying points, split where two are more than factor * step apart; shorter ones go."""
    limit = F.col(step) if isinstance(step, str) else F.lit(step)
    gap = lambda w: F.col(at) - F.lag(at).over(w)
    marked = islands(df.where(holds), keys, [at], lambda w: gap(w).isNull() | (gap(w) > factor * limit))
    out = marked.groupBy(*keys, "island").agg(F.min(at).alias("start_ms"), F.max(at).alias("end_ms"), F.count("*").alias("points")).drop("island")
    return out.where(F.col("end_ms") - F.col("start_ms") >= least_ms)


def adjacent_groups(df: DataFrame, keys: list[str], start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Unite intervals of a key where one ends exactly where the next starts."""
    marked = islands(df, keys, [start], lambda w: F.lag(end).over(w).isNull() | (F.lag(end).over(w) != F.col(start)))
    return marked.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("blocks")).drop("island")


def exclusive_prefix_sum(value: Column, keys: list[str], order: list) -> Column:
    """Sum of the earlier rows of a key; 0 for the first."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))
