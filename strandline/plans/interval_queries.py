"""Queries of the interval operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators import islands as isl
from .registry import query
from .views import spans, spans_sql, table

B, R = spans_sql("click", "purchase"), spans_sql("error")
MERGED = "SELECT key, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM (SELECT *, sum(n) OVER (PARTITION BY key ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN start_ms <= max(end_ms) OVER (PARTITION BY key ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM {src} WHERE end_ms > start_ms)) GROUP BY key, g"


def blocks(spark, d):
    return spans(spark, d, "click", "purchase")


def regions(spark, d):
    return spans(spark, d, "error").select("key", "start_ms", "end_ms")


@query("j1_interval_join", f"SELECT b.id, r.id AS r_id, greatest(b.start_ms, r.start_ms) AS from_ms, least(b.end_ms, r.end_ms) AS to_ms FROM {B} b JOIN {R} r ON b.key = r.key AND b.start_ms < r.end_ms AND r.start_ms < b.end_ms")
def j1(spark, d):
    pairs = iv.interval_join(blocks(spark, d), spans(spark, d, "error"))
    return pairs.select("id", "r_id", F.greatest("start_ms", "r_start_ms").alias("from_ms"), F.least("end_ms", "r_end_ms").alias("to_ms"))


_EXISTS = f"EXISTS (SELECT 1 FROM {R} r WHERE b.key = r.key AND b.start_ms < r.end_ms AND r.start_ms < b.end_ms)"


@query("j2_interval_semi", f"SELECT id FROM {B} b WHERE {_EXISTS}")
def j2(spark, d):
    return iv.interval_semi(blocks(spark, d), regions(spark, d), ["id"])


@query("j3_interval_anti", f"SELECT id FROM {B} b WHERE NOT {_EXISTS}")
def j3(spark, d):
    b = blocks(spark, d)
    return b.join(iv.interval_semi(b, regions(spark, d), ["id"]), "id", "left_anti").select("id")


@query("j4_regions_hit", f"SELECT b.id, count(*) AS n_hit, string_agg(r.start_ms || '-' || r.end_ms, ',' ORDER BY r.start_ms, r.end_ms) AS hit FROM {B} b JOIN {R} r ON b.key = r.key AND b.start_ms < r.end_ms AND r.start_ms < b.end_ms GROUP BY 1")
def j4(spark, d):
    pairs = iv.interval_join(blocks(spark, d), regions(spark, d))
    hits = F.array_sort(F.collect_list(F.struct("r_start_ms", "r_end_ms")))
    said = F.transform(hits, lambda x: F.concat_ws("-", x["r_start_ms"], x["r_end_ms"]))
    return pairs.groupBy("id").agg(F.count("*").alias("n_hit"), F.array_join(said, ",").alias("hit"))


@query("j5_segment_overlap", f"SELECT b.id, coalesce(sum(CASE WHEN r.key IS NOT NULL THEN least(b.end_ms, r.end_ms) - greatest(b.start_ms, r.start_ms) END), 0)::BIGINT AS overlap_ms FROM {B} b LEFT JOIN {R} r ON b.key = r.key AND b.start_ms < r.end_ms AND r.start_ms < b.end_ms GROUP BY 1")
def j5(spark, d):
    return iv.overlap_ms(blocks(spark, d).select("key", "id", "start_ms", "end_ms"), regions(spark, d), ["id"]).select("id", "overlap_ms")


_V = spans_sql("view")


@query("j6_vad_near", f"SELECT b.id, EXISTS (SELECT 1 FROM {_V} v WHERE v.key = b.key AND v.start_ms - 50 <= b.start_ms AND b.start_ms <= v.end_ms + 50) AS near FROM {B} b")
def j6(spark, d):
    points = blocks(spark, d).select("key", "id", F.col("start_ms").alias("at"))
    return iv.near(points, spans(spark, d, "view"), ["id"], "at", 50).select("id", "near")


_GAPS = f"SELECT key, lag(end_ms) OVER (PARTITION BY key ORDER BY start_ms) AS s, start_ms AS e FROM ({MERGED.format(src=_V)})"
_EVIDENCE = "((c.value > 60 AND c.id % 2 = 0) OR c.value >= 90)"


def _evidence(spark, d):
    """Blocks that show someone else: MEDIUM with a failed margin, or the other's score at least the target's."""
    tier, failed, other, target = F.when(F.col("value") > 60, "MEDIUM").otherwise("HIGH"), F.col("id") % 2 == 0, F.col("value"), F.lit(90.0)
    return spans(spark, d, "click").where(((tier == "MEDIUM") & failed) | (other >= target)).select("key", "start_ms", "end_ms")


@query("j7_gap_guard", f"SELECT key, s AS start_ms, e AS end_ms FROM ({_GAPS}) g WHERE s IS NOT NULL AND EXISTS (SELECT 1 FROM {spans_sql('click')} c WHERE c.key = g.key AND g.s < c.end_ms AND c.start_ms < g.e AND {_EVIDENCE})")
def j7(spark, d):
    from pyspark.sql import Window

    parts = isl.merge_intervals(spans(spark, d, "view"), ["key"])
    gaps = parts.select("key", F.lag("end_ms").over(Window.partitionBy("key").orderBy("start_ms")).alias("s"), F.col("start_ms").alias("end_ms")).where("s is not null").withColumnRenamed("s", "start_ms")
    return iv.interval_semi(gaps, _evidence(spark, d), ["key", "start_ms", "end_ms"])


@query("j8_asof_nearest", f"SELECT id, pt AS r_at, abs(pt - start_ms) AS gap FROM (SELECT b.id, b.start_ms, r.start_ms AS pt, row_number() OVER (PARTITION BY b.id ORDER BY abs(r.start_ms - b.start_ms), r.start_ms) AS n FROM {B} b JOIN {R} r ON b.key = r.key) WHERE n = 1")
def j8(spark, d):
    left = blocks(spark, d).select("key", "id", F.col("start_ms").alias("at"))
    right = spans(spark, d, "error").select("key", F.col("start_ms").alias("r_at"))
    return iv.asof_nearest(left, right, "key", "at", "r_at", []).where("r_at is not null").select("id", "r_at", "gap")


@query("j9_click_in_span", f"SELECT b.id, min(r.start_ms) AS span_start_ms FROM {B} b JOIN {R} r ON b.key = r.key AND b.start_ms BETWEEN r.start_ms AND r.end_ms GROUP BY 1")
def j9(spark, d):
    points = blocks(spark, d).select("key", "id", "start_ms", (F.col("start_ms") + 1).alias("end_ms"))
    closed = regions(spark, d).withColumn("end_ms", F.col("end_ms") + 1)
    return iv.interval_join(points, closed).groupBy("id").agg(F.min("r_start_ms").alias("span_start_ms"))


_P = "(SELECT user_id AS key, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx, least(1.0, value / 40) AS prob FROM events)"
_AT = "({} * 512 * 1000) // 16000"


@query("w1_vad_segments", f"""
    WITH p AS {_P}, t AS (SELECT key, max({_AT.format('(idx + 1)')}) AS total FROM p GROUP BY 1),
    r AS (SELECT key, {_AT.format('min(idx)')} AS s, {_AT.format('(max(idx) + 1)')} AS e FROM (SELECT *, idx - row_number() OVER (PARTITION BY key ORDER BY idx) AS g FROM p WHERE prob >= 0.5) GROUP BY key, g),
    j AS (SELECT key, min(s) AS s, max(e) AS e FROM (SELECT *, sum(n) OVER (PARTITION BY key ORDER BY s ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY key ORDER BY s) < 100 THEN 0 ELSE 1 END AS n FROM r)) GROUP BY key, g),
    q AS (SELECT key, greatest(s - 30, 0) AS start_ms, least(e + 30, total) AS end_ms FROM j JOIN t USING (key) WHERE e - s >= 250)
    {MERGED.format(src='q')}""")  # fmt: skip
def w1(spark, d):
    from pyspark.sql import Window

    e = table(spark, d, "events")
    idx = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long") - 1
    probs = e.select(F.col("user_id").alias("key"), idx.alias("idx"), F.least(F.lit(1.0), F.col("value") / 40).alias("prob"))
    return isl.segments_from_probabilities(probs, ["key"], "idx", "prob")


@query("w3_runs", "SELECT key, min(idx) AS first, max(idx) + 1 AS stop, count(*) AS n FROM (SELECT *, idx - row_number() OVER (PARTITION BY key ORDER BY idx) AS g FROM (SELECT user_id AS key, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS idx, value FROM events) WHERE value > 30) GROUP BY key, g")
def w3(spark, d):
    from pyspark.sql import Window

    idx = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    e = table(spark, d, "events").select(F.col("user_id").alias("key"), idx.alias("idx"), "value")
    return isl.runs(e, ["key"], "idx", F.col("value") > 30)


_L = "(SELECT l_suppkey AS key, datediff('day', DATE '1995-01-01', l_shipdate::DATE) AS start_ms, datediff('day', DATE '1995-01-01', l_shipdate::DATE) + l_quantity::BIGINT AS end_ms FROM lineitem)"


@query("w4_merge_regions", MERGED.format(src=_L))
def w4(spark, d):
    day = F.datediff(F.col("l_shipdate").cast("date"), F.to_date(F.lit("1995-01-01"))).cast("long")
    l = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("key"), day.alias("start_ms"), (day + F.col("l_quantity").cast("long")).alias("end_ms"))
    return isl.merge_intervals(l, ["key"])


_GRID = f"(SELECT DISTINCT key, b * 1000 AS start_ms, b * 1000 + 1000 AS end_ms FROM (SELECT key, unnest(range(start_ms // 1000, (end_ms + 999) // 1000)) AS b FROM {_V}))"


@query("w5_nan_split", f"SELECT key, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS blocks FROM (SELECT *, sum(n) OVER (PARTITION BY key ORDER BY start_ms ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN lag(end_ms) OVER (PARTITION BY key ORDER BY start_ms) = start_ms THEN 0 ELSE 1 END AS n FROM {_GRID} b WHERE NOT {_EXISTS})) GROUP BY key, g")
def w5(spark, d):
    slots = F.explode(F.expr("sequence(start_ms div 1000, (end_ms + 999) div 1000 - 1)"))
    grid = spans(spark, d, "view").select("key", slots.alias("b")).distinct().select("key", (F.col("b") * 1000).alias("start_ms"), (F.col("b") * 1000 + 1000).alias("end_ms"))
    ids = ["key", "start_ms", "end_ms"]
    clean = grid.join(iv.interval_semi(grid, regions(spark, d), ids), ids, "left_anti")
    return isl.adjacent_groups(clean, ["key"])


_DECIDED = f"""SELECT key, s AS gap_start_ms, e AS gap_end_ms, e - s AS gap_ms, CASE WHEN e - s >= 2500 THEN 'gap_too_long'
    WHEN EXISTS (SELECT 1 FROM {R} r WHERE r.key = g.key AND g.s < r.end_ms AND r.start_ms < g.e) THEN 'overlap_in_gap'
    WHEN EXISTS (SELECT 1 FROM {spans_sql('click')} c WHERE c.key = g.key AND g.s < c.end_ms AND c.start_ms < g.e AND {_EVIDENCE}) THEN 'interviewer_evidence_in_gap' ELSE 'bridged' END AS reason
    FROM ({_GAPS}) g WHERE s IS NOT NULL"""


@query("w6_gap_decisions", _DECIDED)
def w6a(spark, d):
    parts = isl.merge_intervals(spans(spark, d, "view"), ["key"])
    return iv.bridge_decisions(parts, regions(spark, d), _evidence(spark, d), 2500)


@query("w6_bridge", f"WITH p AS ({MERGED.format(src=_V)}), dd AS ({_DECIDED}) SELECT key, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS parts FROM (SELECT *, sum(n) OVER (PARTITION BY key ORDER BY start_ms ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT p.*, CASE WHEN dd.reason = 'bridged' THEN 0 ELSE 1 END AS n FROM p LEFT JOIN dd ON dd.key = p.key AND dd.gap_end_ms = p.start_ms)) GROUP BY key, g")
def w6b(spark, d):
    parts = isl.merge_intervals(spans(spark, d, "view"), ["key"])
    return iv.bridge(parts, iv.bridge_decisions(parts, regions(spark, d), _evidence(spark, d), 2500))


@query("w7_solo_spans", "SELECT key, min(pt) AS start_ms, max(pt) AS end_ms, count(*) AS points FROM (SELECT *, sum(n) OVER (PARTITION BY key ORDER BY pt ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT key, pt, CASE WHEN pt - lag(pt) OVER (PARTITION BY key ORDER BY pt) <= 6000 THEN 0 ELSE 1 END AS n FROM (SELECT DISTINCT user_id AS key, epoch_us(ts) // 10000000 AS pt FROM events WHERE event_type <> 'error'))) GROUP BY key, g HAVING max(pt) - min(pt) >= 2000")
def w7(spark, d):
    points = spans(spark, d).where("kind <> 'error'").select("key", F.col("start_ms").alias("at")).distinct()
    return isl.spans_of_points(points, ["key"], "at", F.lit(True), 2000, 2000)


@query("w2_file_offsets", "SELECT o_orderkey, coalesce(sum(floor(o_totalprice)::BIGINT) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS file_offset_ms FROM orders")
def w2(spark, d):
    offset = isl.exclusive_prefix_sum(F.floor("o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return table(spark, d, "orders").select("o_orderkey", offset.alias("file_offset_ms"))


@query("a5_speech_totals", f"SELECT key, sum(end_ms - start_ms)::BIGINT AS speech_ms, count(*) AS segments FROM ({MERGED.format(src=_V)}) GROUP BY 1")
def a5(spark, d):
    return isl.merge_intervals(spans(spark, d, "view"), ["key"]).groupBy("key").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("speech_ms"), F.count("*").alias("segments"))
