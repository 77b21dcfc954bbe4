"""Clicks against speaking windows, and how a vector pool grows file by file."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.gates import batch_end, speaking_click
from ..functions.rules import triple_gate
from ..functions.vectors import TINY, cosine
from .folds import ordered_fold
from .intervals import interval_join
from .sums import exact_vector_sum, gram_sums, gram_variance


@dataclass(frozen=True)
class QualityParams:
    """How long a pool has to last, and how much its similarities may vary."""

    strong_ms: int = 45_000
    strong_without_anti_ms: int = 60_000
    marginal_ms: int = 20_000
    variance_high: float = 0.05

    def state(self, ms: int, variance: float, anti: bool) -> str:
        if ms >= (self.strong_ms if anti else self.strong_without_anti_ms) and variance <= self.variance_high:
            return "STRONG"
        return "MARGINAL" if ms >= self.marginal_ms else "INSUFFICIENT"


def judged_clicks(clicks: DataFrame, windows: DataFrame, key: str = "key", bucket_ms: int = 4000, **bounds) -> DataFrame:
    """Per click (key, id, at_ms): id, the start of the first window that holds it (closed at both ends) and the reason to refuse it.

    windows: (key, id, start_ms, end_ms, present, closed).
    """
    points = clicks.select(key, "id", F.col("at_ms").alias("start_ms"), (F.col("at_ms") + 1).alias("end_ms"))
    closed = windows.withColumn("stop_ms", F.col("end_ms")).withColumn("end_ms", F.col("end_ms") + 1)
    hits = interval_join(points, closed, key, bucket_ms)
    first = hits.groupBy("id").agg(F.min(F.struct("r_start_ms", "r_id", "r_stop_ms", "r_present", "r_closed")).alias("w"))
    reason = speaking_click(F.col("w.r_stop_ms") - F.col("w.r_start_ms"), F.col("w.r_present"), F.col("w.r_closed"), **bounds)
    return clicks.join(first, "id", "left").select("id", F.col("w.r_start_ms").alias("window_start_ms"), reason.alias("reason"))


def pool_history(df: DataFrame, keys: list[str], order: str, vector: str, duration: str) -> DataFrame:
    """After each value of `order`: size, total duration and pair variance of the pool of all vectors so far.

    Sums over unit vectors and their products (sums.gram_sums, a few thousand numbers a key, order and task) run along `order` number by number, so
    neither pairs nor a pool as a whole ever meet in one task.
    """
    group = [*keys, order]
    so_far = lambda column, *parts: F.sum(column).over(Window.partitionBy(*keys, *parts).orderBy(order))
    base = df.groupBy(*group).agg(F.sum(duration).alias("ms")).withColumn("ms", so_far("ms"))
    grown = gram_sums(df, group, vector).withColumns({c: so_far(c, "__p") for c in ("__x", "__n", "__live")})
    out = base.join(gram_variance(grown, group), group)
    return out.select(*group, F.col("n").alias("pool_size"), F.col("ms").alias("verified_ms"), F.col("variance").alias("pool_variance"))


def profiles(vectors: DataFrame, files: DataFrame, keys: list[str], order: str, vector: str, duration: str) -> DataFrame:
    """Per row of files (keys, order): before and after, the duration-weighted mean of all vectors of earlier files, and of those of this file too; null without any.

    Exact sums a file run along `order` dimension by dimension, so a key's vectors never meet in one task.
    """
    group = [*keys, order]
    sums = exact_vector_sum(vectors, group, vector, F.col(duration), "__t")
    each = sums.select(*group, F.posexplode(F.concat(F.array("weight_total"), "__t")).alias("__p", "__x"))
    run = Window.partitionBy(*keys, "__p").orderBy(order)
    each = each.withColumns({"after": F.sum("__x").over(run), "before": F.sum("__x").over(run.rowsBetween(Window.unboundedPreceding, -1))})
    mean = lambda c: F.transform(F.slice(c, F.lit(2), F.size(c) - 1), lambda x: x / F.get(c, F.lit(0)))
    gathered = each.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("__p", "before", "after"))).alias("__a"))
    part = lambda name: F.transform("__a", lambda s: s[name])
    known = gathered.select(*group, mean(part("after")).alias("after"), F.when(F.get("__a", F.lit(0))["before"].isNotNull(), mean(part("before"))).alias("before"))
    # a file without vectors has what the last one with some left
    w = Window.partitionBy(*keys).orderBy(order)
    rows = files.join(known, group, "left").withColumn("__last", F.last("after", ignorenulls=True).over(w))
    return rows.select(*group, F.when(F.col("after").isNull(), F.col("__last")).otherwise(F.col("before")).alias("before"), F.coalesce("after", "__last").alias("after"))


COURSE = "accepted bigint, second_pass bigint, verified_ms bigint, pool_size bigint, pool_variance double, sim_composite_anti double, first_state string, state string"


def enrollment_course(windows: DataFrame, anti: DataFrame, keys: list[str], order: str, params: QualityParams = QualityParams(), digits: int = 6, **gates) -> DataFrame:
    """How a batch's enrollment goes, video by video: keys, order and COURSE's columns.

    windows: keys, order, vector, duration_ms, coverage, present, closed and seed (similarity to the seed); anti: keys, order, vector, duration_ms.
    A video's windows pass the three gates against the anti profile of the videos before it.  Then its own anti vectors join the profile, and
    the pool's duration, variance and state are judged.  If the state is MARGINAL and there is a profile, windows that failed gate C alone are
    judged again against the grown profile; those accepted join the pool, and the state is judged once more.

    Which windows a second pass would accept doesn't depend on the state, so both are added up first, a video a row (pool size, durations, Gram sums), in parallel
    over all windows.  Only these rows are followed in order, since a second pass changes the states after it.  A video without windows has a row too.
    """
    group = [*keys, order]
    files = windows.select(*group).unionByName(anti.select(*group)).distinct()
    profile = profiles(anti, files, keys, order, "vector", "duration_ms")
    sim = lambda c: F.when(F.col(c).isNotNull(), F.round(cosine(F.col("vector"), F.col(c)), digits))
    judged = windows.join(profile, group).withColumns({"__sim": sim("before"), "__again": sim("after")})
    gate = lambda s, there: triple_gate(F.col("coverage"), F.col("present"), F.col("closed"), F.col("seed"), F.col(s), there, **gates)
    judged = judged.withColumn("__first", gate("__sim", F.col("before").isNotNull())).withColumn("__second", gate("__again", F.lit(True)))
    take = F.when(F.col("__first.accepted"), 1).when((F.col("__first.gate") == "C") & F.col("after").isNotNull() & F.col("__second.accepted"), 2)
    taken = judged.withColumn("__pass", take).where("__pass is not null").select(*group, "__pass", "vector", "duration_ms")
    by = [*group, "__pass"]
    sums = exact_vector_sum(taken, by, "vector", F.col("duration_ms"), "__w").select(*by, F.concat(F.array("weight_total"), "__w").alias("__w"))
    grams = gram_sums(taken, by, "vector").groupBy(*by).agg(F.max("__n").alias("__n"), F.max("__live").alias("__live"), F.transform(F.array_sort(F.collect_list(F.struct("__p", "__x"))), lambda s: s["__x"]).alias("__g"))
    both = sums.join(grams, by).withColumn("__row", F.struct("__n", "__live", "__w", "__g"))
    wide = both.groupBy(*group).agg(*(F.max_by("__row", F.when(F.col("__pass") == i, 1)).alias(f"__p{i}") for i in (1, 2)))
    rows = profile.select(*group, F.col("after").alias("__anti")).join(wide, group, "left")
    return ordered_fold(rows, keys, [order], Pool, lambda pool, row: pool.video(row, order, params), f"{order} {windows.schema[order].dataType.simpleString()}, {COURSE}").select(*group, *(c.split()[0] for c in COURSE.split(", ")))


class Pool:
    """What a pool of vectors adds up to: n, vectors with a norm, weighted sum (weight first), Gram sums."""

    def __init__(self):
        self.n, self.live, self.w, self.g = 0, 0, 0.0, 0.0

    def add(self, part: dict | None) -> int:
        if part is None:
            return 0
        self.n, self.live = self.n + part["__n"], self.live + part["__live"]
        self.w, self.g = self.w + np.array(part["__w"]), self.g + np.array(part["__g"])
        return part["__n"]

    def variance(self) -> float:
        if self.n < 2:
            return 0.0
        d = len(self.w) - 1
        i, j = np.triu_indices(d)
        square, pairs = self.g * self.g, self.n * (self.n - 1) / 2
        mean = (square[:d].sum() - self.live) / 2 / pairs
        return float(max(((np.where(i == j, 1, 2) * square[d:]).sum() - self.live) / 2 / pairs - mean * mean, 0.0))

    def similarity(self, anti: list[float] | None) -> float | None:
        if anti is None or not self.n:
            return None
        a, b = self.w[1:], np.array(anti)
        norms = np.linalg.norm(a / self.w[0]), np.linalg.norm(b)
        return 0.0 if min(norms) <= TINY else float(a @ b / self.w[0] / norms[0] / norms[1])

    def video(self, row: dict, order: str, params: QualityParams):
        there = row["__anti"] is not None
        accepted = self.add(row["__p1"])
        ms = lambda: int(self.w[0]) if self.n else 0
        first = state = params.state(ms(), self.variance(), there)
        again = self.add(row["__p2"]) if state == "MARGINAL" and there else 0
        if again:
            state = params.state(ms(), self.variance(), there)
        return self, ((row[order], accepted, again, ms(), self.n, self.variance(), self.similarity(row["__anti"]), first, state),)


def batch_verdict(course: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Per batch, from enrollment_course: state, verified_ms and pool_variance after its last video, and the outcome: a halt, a warning, or null."""
    last = course.groupBy(*keys).agg(F.max_by(F.struct("state", "verified_ms", "pool_variance"), order).alias("e")).select(*keys, "e.*")
    return last.withColumn("outcome", batch_end(F.col("verified_ms"), F.col("state"), F.col("pool_variance")))
