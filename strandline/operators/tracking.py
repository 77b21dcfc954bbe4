"""Sliding windows to tiered blocks to refined runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import TierParams, activity_level, tier


def plan_windows(files: DataFrame, window_ms: int = 5000, hop_ms: int = 1000) -> DataFrame:
    """Full windows of each file (file_index, duration_ms); a file no longer than a window gives one, an empty one none."""
    last = F.expr(f"(duration_ms - {window_ms}) div {hop_ms}")
    starts = F.when(F.col("duration_ms") > window_ms, F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0)))).when(F.col("duration_ms") > 0, F.array(F.lit(0).cast("long")))
    out = files.select("*", F.explode(starts).alias("__i"))
    return out.withColumn("ws", F.col("__i") * hop_ms).withColumn("we", F.least(F.col("ws") + window_ms, "duration_ms")).drop("__i")


def plan_chunks(items: DataFrame, chunk_ms: int = 60_000, overlap_ms: int = 2_000) -> DataFrame:
    """Chunks of at most chunk_ms of each item (duration_ms), each starting overlap_ms before the last one's end."""
    step = chunk_ms - overlap_ms
    n = F.greatest(F.ceil((F.col("duration_ms") - overlap_ms) / step), F.lit(1))
    out = items.where("duration_ms > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("chunk"))
    return out.withColumn("start_ms", F.col("chunk") * step).withColumn("end_ms", F.least(F.col("start_ms") + chunk_ms, "duration_ms"))


def blocks_of_windows(windows: DataFrame, block_ms: int = 1000) -> DataFrame:
    """One row for each block that a window covers whole: block_index."""
    first, last = F.expr(f"(ws + {block_ms - 1}) div {block_ms}"), F.expr(f"we div {block_ms} - 1")
    return windows.withColumn("block_index", F.explode(F.when(first <= last, F.sequence(first, last))))


def median_pool(files: DataFrame, windows: DataFrame, block_ms: int = 1000) -> DataFrame:
    """Every whole block of every file: number of windows over it and the medians of s_t and s_i (null where none).

    Blocks carry a file's key, so each file is pooled by itself, with one exchange for both sides.
    """
    spine = files.select("file_index", F.explode(F.expr(f"if(duration_ms >= {block_ms}, sequence(0L, duration_ms div {block_ms} - 1), array())")).alias("block_index"))
    pooled = blocks_of_windows(windows, block_ms).groupBy("file_index", "block_index").agg(F.count("s_t").alias("evaluations"), F.median("s_t").alias("s_target"), F.median("s_i").alias("s_other"))
    return spine.join(pooled, ["file_index", "block_index"], "left").withColumn("evaluations", F.coalesce("evaluations", F.lit(0)))


def tiered(blocks: DataFrame, calibration: DataFrame, p: TierParams = TierParams(), anti: bool = True) -> DataFrame:
    """Blocks with tier and margin_failed; calibration is the one row of calibrate(), read as scalar subqueries."""
    high, med = calibration.select("theta_high").scalar(), calibration.select("theta_med").scalar()
    both = blocks.withColumns({"theta_high": high, "theta_med": med})
    return both.withColumn("__t", tier(F.col("s_target"), F.col("s_other"), F.col("theta_high"), F.col("theta_med"), p, anti)).select(*blocks.columns, "theta_high", "theta_med", "__t.*")


def adjusted_tiers(blocks: DataFrame, reached: DataFrame) -> DataFrame:
    """blocks with the tier after trimming: a HIGH block that no trimmed run reaches (file_index, block_index) counts as MEDIUM."""
    at = reached.select("file_index", "block_index").distinct().withColumn("__reached", F.lit(True))
    lost = (F.col("tier") == "HIGH") & F.col("__reached").isNull()
    return blocks.join(at, ["file_index", "block_index"], "left").withColumn("tier", F.when(lost, "MEDIUM").otherwise(F.col("tier"))).drop("__reached")


def fine_windows(runs: DataFrame, files: DataFrame, window_ms: int = 2000, least_ms: int = 1000) -> DataFrame:
    """Fine windows around both edges of each run: file_index, start_ms, leading, p, ws, we.

    A window begins at its position p on the leading edge and ends at it on the trailing one, is held within the file, and goes if under least_ms long.
    """
    edge = lambda leading, at: F.struct(F.lit(leading).alias("leading"), F.col(at).alias("edge"))
    edges = runs.select("file_index", "start_ms", F.explode(F.array(edge(True, "start_ms"), edge(False, "end_ms"))).alias("e"))
    p = edges.select("file_index", "start_ms", "e.leading", F.explode(fine_positions(F.col("e.edge"))).alias("p")).join(files, "file_index")
    start = F.greatest(F.col("p") - F.when(F.col("leading"), 0).otherwise(window_ms), F.lit(0))
    end = F.least(F.col("p") + F.when(F.col("leading"), window_ms).otherwise(0), "duration_ms")
    return p.withColumn("ws", start).withColumn("we", end).where(F.col("we") - F.col("ws") >= least_ms).drop("duration_ms")


def fine_passes(target: Column, other: Column, theta_high: Column, margin: float) -> Column:
    """Whether a fine window passes: over the threshold, and by the margin over the other speaker if there is one."""
    return (target > theta_high) & F.coalesce(target - other > margin, F.lit(True))


def fine_positions(edge: Column, span_ms: int = 2000, step_ms: int = 250) -> Column:
    return F.sequence(edge - span_ms, edge + span_ms, F.lit(step_ms).cast("long"))


def refine_edges(runs: DataFrame, fine: DataFrame, max_trim_ms: int = 750, block_ms: int = 1000) -> DataFrame:
    """Trim each run's edges to its first and last passing fine positions.

    runs: (file_index, start_ms, end_ms); fine: (file_index, start_ms, leading, p, passes) for both edges.
    Leading: the smallest passing p >= start; none, or a trim over max_trim_ms, demotes the first block.
    Trailing, only if something is left: the largest passing p <= end; else the last block is demoted
    if it begins after the new start, otherwise the edge stays as it is.
    """
    lead = F.min(F.when(F.col("passes") & F.col("leading") & (F.col("p") >= F.col("start_ms")), F.col("p"))).alias("lead")
    trail = F.max(F.when(F.col("passes") & ~F.col("leading") & (F.col("p") <= F.col("end_ms")), F.col("p"))).alias("trail")
    found = runs.join(fine, ["file_index", "start_ms"], "left").groupBy("file_index", "start_ms", "end_ms").agg(lead, trail)
    leads = F.coalesce(F.col("lead") - F.col("start_ms") <= max_trim_ms, F.lit(False))
    start = F.when(leads, F.col("lead")).otherwise(F.col("start_ms") + block_ms)
    out = found.withColumn("new_start_ms", start).withColumn("lead_demoted", ~leads)
    trails = F.coalesce(F.col("end_ms") - F.col("trail") <= max_trim_ms, F.lit(False))
    open_ = F.col("new_start_ms") < F.col("end_ms")
    demote = open_ & ~trails & (F.col("end_ms") - block_ms > F.col("new_start_ms"))
    end = F.when(open_ & trails, F.col("trail")).when(demote, F.col("end_ms") - block_ms).otherwise(F.col("end_ms"))
    out = out.withColumn("trail_demoted", demote).withColumn("new_end_ms", end)
    return out.withColumn("survives", F.col("new_start_ms") < F.col("new_end_ms")).drop("lead", "trail")


def file_summary(blocks: DataFrame, runs: DataFrame, speech: DataFrame) -> DataFrame:
    """Tier counts (all five), high_ms, silero_ms, ratio (null without speech), its level and unattributed_ms of each file."""
    names = ("HIGH", "MEDIUM", "SUB", "REJECT", "SKIPPED")
    counts = blocks.groupBy("file_index").agg(*(F.count_if(F.col("tier") == t).alias(f"n_{t.lower()}") for t in names))
    high = runs.groupBy("file_index").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("high_ms"))
    out = counts.join(high, "file_index", "left").join(speech, "file_index", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("high_ms", "silero_ms")})
    out = out.withColumn("ratio", F.col("high_ms") / F.nullif("silero_ms", F.lit(0)))
    return out.withColumn("ratio_level", activity_level(F.col("ratio"))).withColumn("unattributed_ms", F.greatest(F.col("silero_ms") - F.col("high_ms"), F.lit(0)))


def first_high_mean(blocks: DataFrame, keys: list[str], order: str, duration: Column, score: str, limit_ms: int = 30_000) -> DataFrame:
    """Mean score of each key's first blocks: those whose earlier blocks last less than limit_ms together."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    early = blocks.withColumn("__before", F.coalesce(F.sum(duration).over(w), F.lit(0)))
    return early.where(F.col("__before") < limit_ms).groupBy(*keys).agg(F.avg(score).alias("first_mean"))


def variance_jumps(rows: DataFrame, keys: list[str], order: str, known: str, now: str, limit: float, digits: int = 6) -> DataFrame:
    """Rows with a known value that exceeds the last known one before them by more than `limit`, with the increase (rounded)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("increase", F.round(F.col(now) - F.last(known, ignorenulls=True).over(w), digits))
    return out.where(F.col(known).isNotNull() & (F.col("increase") > limit))


def drift(files: DataFrame, keys: list[str], order: str, mean: str, first: str, limit: float = 0.10) -> DataFrame:
    """Rows whose first-blocks mean fell more than `limit` below the last known mean before them, in order within keys."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = files.withColumn("previous_mean", F.last(mean, ignorenulls=True).over(w))
    return out.withColumn("delta", F.col("previous_mean") - F.col(first)).where(F.col("delta") > limit)
