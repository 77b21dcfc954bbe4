"""Interval joins on integer time: overlap, semi, anti, sums, nearness, as-of, bridging.

A plain overlap predicate plans as a nested loop.  Here intervals fall into classes by length, each 8 times the one before,
and time into buckets of each class's length, so an interval touches two buckets of its own class or of a longer one.  Two intervals meet by an
equi-join on (key, class, bucket) in the class of the longer one, where the shorter one is placed too if the other side has that class at all.  A row
thereby takes two places for each class present, however long its interval is, and adaptive execution can split a hot bucket.
Each pair is reported from its first common bucket only, so no distinct is needed.  bucket_ms, the length of the first class, should be near the usual interval length.
Intervals are half-open; null bounds match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Times a class is as long as the one before.
FACTOR = 8


def _sizes(bucket_ms: int) -> list[int]:
    sizes = [bucket_ms]
    while sizes[-1] < 1 << 58:
        sizes.append(sizes[-1] * FACTOR)
    return sizes


def _array(sizes: list[int]) -> str:
    return "array(" + ", ".join(f"{s}L" for s in sizes) + ")"


def _class(start: str, end: str, sizes: list[int]) -> str:
    """The number of the first class that is as long as the interval."""
    return f"size(filter({_array(sizes)}, s -> s < {end} - {start}))"


def _present(df: DataFrame, start: str, end: str, sizes: list[int], longest_ms: int | None) -> Column:
    """The classes that df has, as bits; those up to longest_ms, if that is given."""
    if longest_ms is not None:
        return F.lit((2 << sum(longest_ms > s for s in sizes)) - 1).cast("bigint")
    return df.select(F.expr(f"shiftleft(1L, {_class(start, end, sizes)})").alias("m")).agg(F.coalesce(F.bit_or("m"), F.lit(0).cast("bigint"))).scalar()


def _placed(df: DataFrame, start: str, end: str, sizes: list[int], there: Column, side: int, name: str) -> DataFrame:
    """df with its places (c, side, b, size): class, side, bucket and the class's length.

    On side 0 left intervals are in their own class and right ones of no longer class come to them; on side 1 right intervals are in
    their own class and left ones of a shorter class come to them.  So two intervals meet on one side, in one class.  `there` has the other input's classes.
    """
    known = df.where(f"{start} is not null and {end} is not null").withColumn("__own", F.expr(_class(start, end, sizes))).withColumn("__there", there)
    longer, has = ("c > __own", "true") if side == 0 else ("c >= __own", "(__there & (shiftleft(1L, __own) - 1)) != 0")
    both = f"""concat(filter(array(named_struct('c', __own, 'side', {side})), p -> {has}),
        transform(filter(sequence(0, {len(sizes) - 1}), c -> {longer} and (__there & shiftleft(1L, c)) != 0), c -> named_struct('c', c, 'side', {1 - side})))"""
    size = f"{_array(sizes)}[p.c]"
    buckets = f"sequence({start} div {size}, greatest({end} - 1, {start}) div {size})"
    places = f"flatten(transform({both}, p -> transform({buckets}, b -> named_struct('c', p.c, 'side', p.side, 'b', b, 'size', {size}))))"
    return known.withColumn(name, F.explode(F.expr(places))).drop("__own", "__there")


def interval_join(left: DataFrame, right: DataFrame, key: str = "key", bucket_ms: int = 4000, residual: Column | None = None, longest_ms: int | None = None) -> DataFrame:
    """Pairs of overlapping (key, start_ms, end_ms) rows; right's columns come with the prefix r_.

    longest_ms says that no interval of either side is longer, which saves looking which classes there are.
    """
    sizes = _sizes(bucket_ms)
    r = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    there_l, there_r = _present(left, "start_ms", "end_ms", sizes, longest_ms), _present(r, "r_start_ms", "r_end_ms", sizes, longest_ms)
    l, r = _placed(left, "start_ms", "end_ms", sizes, there_r, 0, "__p"), _placed(r, "r_start_ms", "r_end_ms", sizes, there_l, 1, "__q")
    on = (F.col(key) == F.col(f"r_{key}")) & (F.col("__p.c") == F.col("__q.c")) & (F.col("__p.side") == F.col("__q.side")) & (F.col("__p.b") == F.col("__q.b"))
    on = on & (F.col("start_ms") < F.col("r_end_ms")) & (F.col("r_start_ms") < F.col("end_ms"))
    on = on if residual is None else on & residual
    once = F.expr("greatest(start_ms, r_start_ms) div __p.size = __p.b")
    return l.join(r, on & once).drop("__p", "__q", f"r_{key}")


def interval_semi(left: DataFrame, right: DataFrame, ids: list[str], key: str = "key", bucket_ms: int = 4000, residual: Column | None = None) -> DataFrame:
    """The ids of left rows that overlap some right row."""
    return interval_join(left, right, key, bucket_ms, residual).select(*ids).distinct()


def with_flag(left: DataFrame, hits: DataFrame, ids: list[str], name: str) -> DataFrame:
    """left with a boolean: whether its ids are among hits."""
    return left.join(hits.withColumn(name, F.lit(True)), ids, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def overlap_ms(left: DataFrame, right: DataFrame, ids: list[str], key: str = "key", bucket_ms: int = 4000) -> DataFrame:
    """left with overlap_ms: total overlap with right rows (counted for each)."""
    part = F.least("end_ms", "r_end_ms") - F.greatest("start_ms", "r_start_ms")
    sums = interval_join(left, right, key, bucket_ms).groupBy(*ids).agg(F.sum(part).alias("overlap_ms"))
    return left.join(sums, ids, "left").withColumn("overlap_ms", F.coalesce("overlap_ms", F.lit(0)))


def near(points: DataFrame, segments: DataFrame, ids: list[str], at: str, tolerance_ms: int, key: str = "key", bucket_ms: int = 4000) -> DataFrame:
    """points with near: whether a segment, widened by the tolerance and closed at both ends, holds it."""
    p = points.withColumn("start_ms", F.col(at)).withColumn("end_ms", F.col(at) + 1)
    s = segments.select(key, (F.col("start_ms") - tolerance_ms).alias("start_ms"), (F.col("end_ms") + tolerance_ms + 1).alias("end_ms"))
    return with_flag(points, interval_semi(p, s, ids, key, bucket_ms), ids, "near")


def asof_nearest(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, take: list[str], within: int | None = None) -> DataFrame:
    """left with the right row nearest in time (of two as near the earlier; of equal times the one with the least `take`).

    One exchange of both sides together, two sorts and two running values: no join, so a hot key costs its sorts only.
    """
    value = F.struct(F.col(right_at).alias("at"), *(F.col(c).alias(c) for c in take))
    rights = right.groupBy(key, right_at).agg(F.min(F.struct(*take)).alias("__t")).select(key, right_at, "__t.*") if take else right.select(key, right_at).distinct()
    # points on the left sort between rights at or before them and those after
    l = left.select(F.col(key).alias("__k"), F.col(left_at).alias("__at"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"), F.lit(None).cast(rights.select(value.alias("v")).schema["v"].dataType).alias("__v"))
    r = rights.select(F.col(key).alias("__k"), F.col(right_at).alias("__at"), F.lit(0).alias("__side"), F.lit(None).cast(l.schema["__row"].dataType).alias("__row"), value.alias("__v"))
    w = Window.partitionBy("__k").orderBy("__at", "__side")
    both = l.unionByName(r)
    both = both.withColumn("__p", F.last("__v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # backwards a running value again: a frame that ends at the last row would be computed anew for every row
    back = Window.partitionBy("__k").orderBy(F.desc("__at"), F.desc("__side")).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__n", F.last("__v", ignorenulls=True).over(back))
    out = both.where("__side = 1")
    ahead, behind = F.col("__n.at") - F.col("__at"), F.col("__at") - F.col("__p.at")
    best = F.when(F.col("__p").isNull() | (ahead < behind), F.col("__n")).otherwise(F.col("__p"))
    out = out.withColumn("__best", best).withColumn("gap", F.abs(F.col("__best.at") - F.col("__at")))
    if within is not None:
        out = out.withColumn("__best", F.when(F.col("gap") <= within, F.col("__best"))).withColumn("gap", F.when(F.col("gap") <= within, F.col("gap")))
    return out.select("__row.*", F.col("__best.at").alias(right_at), *(F.col(f"__best.{c}").alias(c) for c in take), "gap")


def bridge_decisions(parts: DataFrame, regions: DataFrame, evidence: DataFrame, merge_gap_ms: int = 400, key: str = "key", guard: bool = True) -> DataFrame:
    """For each part after a key's first: the gap before it and why it is bridged or not.

    Reasons, in order: gap_too_long (>= merge_gap_ms), overlap_in_gap, interviewer_evidence_in_gap, bridged.
    evidence: blocks (key, start_ms, end_ms) that speak against bridging.
    """
    w = Window.partitionBy(key).orderBy("start_ms")
    gaps = parts.select(key, F.lag("end_ms").over(w).alias("gap_start_ms"), F.col("start_ms").alias("gap_end_ms")).where("gap_start_ms is not null")
    g = gaps.select(key, F.col("gap_start_ms").alias("start_ms"), F.col("gap_end_ms").alias("end_ms")).where(f"end_ms - start_ms < {merge_gap_ms}")
    ids = [key, "start_ms", "end_ms"]
    rename = lambda d: d.select(key, F.col("start_ms").alias("gap_start_ms"), F.col("end_ms").alias("gap_end_ms"))
    same = [key, "gap_start_ms", "gap_end_ms"]
    out = with_flag(gaps, rename(interval_semi(g, regions, ids, key)), same, "overlapped")
    out = with_flag(out, rename(interval_semi(g, evidence, ids, key)), same, "spoken")
    gap = F.col("gap_end_ms") - F.col("gap_start_ms")
    reason = F.when(gap >= merge_gap_ms, "gap_too_long").when(F.col("overlapped"), "overlap_in_gap").when(F.col("spoken") & F.lit(guard), "interviewer_evidence_in_gap").otherwise("bridged")
    return out.select(key, "gap_start_ms", "gap_end_ms", gap.alias("gap_ms"), reason.alias("reason"))


def bridge(parts: DataFrame, decisions: DataFrame, key: str = "key") -> DataFrame:
    """Parts united across bridged gaps: start_ms, end_ms, parts."""
    from .islands import islands

    d = decisions.select(key, F.col("gap_end_ms").alias("start_ms"), (F.col("reason") == "bridged").alias("__on"))
    marked = islands(parts.join(d, [key, "start_ms"], "left"), [key], ["start_ms"], lambda w: ~F.coalesce(F.col("__on"), F.lit(False)))
    return marked.groupBy(key, "island").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("parts")).drop("island")
