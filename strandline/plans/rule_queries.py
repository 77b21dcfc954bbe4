"""Queries of scalar rules, gates, folds and sources."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.vectors import cosine
from ..operators import folds, pools, scans
from ..sources import media
from .registry import query
from .vector_queries import _SCORES, scores, sql_mean
from .views import VECTORS, table, vectors


@query("io2_canonical_order", "SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY string_split(p, '/')) - 1 AS file_index FROM (SELECT *, '/' || lower(c_mktsegment[1:1]) || CASE WHEN c_custkey % 2 = 0 THEN '/' ELSE '-c/' END || c_name || '.mp4' AS p FROM customer)")
def io2(spark, d):
    path = F.concat(F.lit("/"), F.lower(F.left("c_mktsegment", F.lit(1))), F.when(F.col("c_custkey") % 2 == 0, "/").otherwise("-c/"), "c_name", F.lit(".mp4"))
    return media.canonical_order(table(spark, d, "customer").withColumn("p", path), ["c_nationkey"], "p").select("c_custkey", "file_index")


_K = "json_extract(props, '$.k')::BIGINT"


@query("io4_probe_vfr", f"SELECT event_id, CASE WHEN k % 5 = 0 THEN 0 ELSE k * 3 END AS audio_start_ms, k % 5 = 0 AS audio_start_missing, 48000 AS sample_rate, k % 3 = 0 AS vfr_suspected FROM (SELECT event_id, {_K} AS k FROM events)")
def io4(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    start = F.when(k % 5 == 0, "N/A").otherwise(F.format_string("%.3f", k * 3 / 1000))
    video = F.concat(F.lit('{"codec_type":"video","avg_frame_rate":"30000/1001","r_frame_rate":"'), F.when(k % 3 == 0, "30/1").otherwise("60000/2002"), F.lit('"}'))
    probe = F.concat(F.lit('{"streams":['), video, F.lit(',{"codec_type":"audio","sample_rate":"48000","start_time":"'), start, F.lit('"}]}'))
    return table(spark, d, "events").select("event_id", media.parse_probe(probe).alias("p")).select("event_id", "p.*").drop("error")


@query("p1_ms_from_samples", "SELECT event_id, (floor(value * 1000)::BIGINT * 1000) // 16000 AS ms FROM events")
def p1(spark, d):
    return table(spark, d, "events").select("event_id", rules.ms_from_samples(F.floor(F.col("value") * 1000)).alias("ms"))


@query("p2_half_even_ms", "SELECT o_orderkey, CASE WHEN c % 2 = 0 THEN c // 2 WHEN (c // 2) % 2 = 0 THEN c // 2 ELSE c // 2 + 1 END AS ms FROM (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS c FROM orders)")
def p2(spark, d):
    seconds = F.floor("o_totalprice").cast("decimal(18,0)") * F.lit("0.0005").cast("decimal(10,4)")
    return table(spark, d, "orders").select("o_orderkey", rules.half_even_ms(seconds).alias("ms"))


def _dist(i, j):
    return f"sqrt((v[{2 * i + 1}] - v[{2 * j + 1}]) ** 2 + (v[{2 * i + 2}] - v[{2 * j + 2}]) ** 2)"


@query("p7_mouth_ratio", f"SELECT vec_id, round(CASE WHEN {_dist(0, 7)} > 1e-6 THEN ({_dist(1, 4)} + {_dist(2, 5)} + {_dist(3, 6)}) / 3 / {_dist(0, 7)} END, 6) AS mar FROM {VECTORS}")
def p7(spark, d):
    points = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.struct(F.get("v", 2 * i).alias("x"), F.get("v", 2 * i + 1).alias("y")))
    return vectors(spark, d).select("vec_id", F.round(rules.mouth_ratio(points, [1, 2, 3], [4, 5, 6], 0, 7), 6).alias("mar"))


@query("p8_yaw_suspends", "SELECT event_id, coalesce(abs(CASE WHEN event_type <> 'error' THEN value - 60 END) > 35, false) AS suspended FROM events")
def p8(spark, d):
    yaw = F.when(F.col("event_type") != "error", F.col("value") - 60)
    return table(spark, d, "events").select("event_id", rules.yaw_suspends(yaw).alias("suspended"))


_GATE = "(SELECT vec_id, (vec_id * 7 % 100) / 100.0::DOUBLE AS cov, vec_id % 11 AS present, vec_id * 5 % 11 AS closed, s_t, CASE WHEN vec_id % 13 > 0 THEN s_i END AS s_i, vec_id % 4 > 0 AS has FROM " + _SCORES + ")"


@query("c1_triple_gate", f"""SELECT vec_id, reason IS NULL AS accepted, CASE WHEN reason IN ('vad_coverage_low', 'interviewer_lips_open') THEN 'A' WHEN reason = 'low_sim_to_seed' THEN 'B' WHEN reason IS NOT NULL THEN 'C' END AS gate, reason
    FROM (SELECT vec_id, CASE WHEN cov < 0.5 THEN 'vad_coverage_low' WHEN present > 0 AND least(closed, present) / present < 0.8 THEN 'interviewer_lips_open' WHEN s_t < 0.1 THEN 'low_sim_to_seed' WHEN has AND s_i IS NULL THEN 'sim_anti_missing'
    WHEN has AND s_i > 0.1 THEN 'high_sim_to_anti' WHEN has AND round(s_t - s_i, 6) < 0.15 THEN 'margin_too_small' END AS reason FROM {_GATE})""")  # fmt: skip
def c1(spark, d):
    s = scores(spark, d)
    v = F.col("vec_id")
    present, other = v % 11, F.when(v % 13 > 0, F.col("s_i"))
    gate = rules.triple_gate((v * 7 % 100) / 100, present, F.least(v * 5 % 11, present), F.col("s_t"), other, v % 4 > 0, seed_min=0.1, anti_max=0.1, margin=0.1499999)
    return s.select("vec_id", gate.alias("g")).select("vec_id", "g.*")


@query("c4_quality", "SELECT o_orderkey, CASE WHEN ms >= CASE WHEN has THEN 45000 ELSE 60000 END AND var <= 0.05 THEN 'STRONG' WHEN ms >= 20000 THEN 'MARGINAL' ELSE 'INSUFFICIENT' END AS state FROM (SELECT o_orderkey, floor(o_totalprice / 5)::BIGINT AS ms, (o_orderkey % 10) / 100.0::DOUBLE AS var, o_orderkey % 3 = 0 AS has FROM orders)")
def c4(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", rules.quality_state(F.floor(F.col("o_totalprice") / 5), (k % 10) / 100, k % 3 == 0).alias("state"))


@query("c3_contamination_levels", "SELECT event_id, CASE WHEN value / 490 > 0.6 THEN 'HALT' WHEN value / 490 > 0.45 THEN 'WARNING' ELSE 'OK' END AS level FROM events")
def c3(spark, d):
    return table(spark, d, "events").select("event_id", rules.contamination_level(F.col("value") / 490).alias("level"))


@query("a8_activity_levels", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'NO_SPEECH' WHEN value / 100 > 0.25 THEN 'NORMAL' WHEN value / 100 >= 0.1 THEN 'LOW_ADVISORY' ELSE 'NEAR_ZERO_ALERT' END AS level FROM events")
def a8(spark, d):
    ratio = F.when(F.col("event_type") != "error", F.col("value") / 100)
    return table(spark, d, "events").select("event_id", rules.activity_level(ratio).alias("level"))


@query("a12_histogram", "SELECT n, count(*) AS frames FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) GROUP BY n")
def a12(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("frames"))


@query("a13_closed_fractions", "SELECT user_id, count(*) FILTER (event_type <> 'error') AS present, round(count(*) FILTER (event_type = 'click') / nullif(count(*) FILTER (event_type <> 'error'), 0), 6) AS closed_frac FROM events GROUP BY 1")
def a13(spark, d):
    present, closed = F.count_if(F.col("event_type") != "error"), F.count_if(F.col("event_type") == "click")
    return table(spark, d, "events").groupBy("user_id").agg(present.alias("present"), F.round(closed / F.nullif(present, F.lit(0)), 6).alias("closed_frac"))


@query("a15_peak_envelope", "SELECT user_id, col, round_even(m / 32768, 3) AS peak FROM (SELECT user_id, i // 8 AS col, max(abs(x)) AS m FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, floor(value * 60)::BIGINT - 15000 AS x FROM events) GROUP BY ALL)")
def a15(spark, d):
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long") - 1
    s = table(spark, d, "events").select("user_id", i.alias("i"), (F.floor(F.col("value") * 60) - 15000).alias("x"))
    return media.peak_envelope(s, ["user_id"], "i", "x", 8)


@query("a16_bounds", "SELECT coalesce(min(g0), 0) AS lo, coalesce(max(g1), 1000) AS hi FROM (SELECT epoch_us(ts) // 10000000 AS g0, epoch_us(ts) // 10000000 + 200 + floor(value * 40)::BIGINT AS g1 FROM events)")
def a16(spark, d):
    from .views import spans

    return spans(spark, d).agg(F.coalesce(F.min("start_ms"), F.lit(0)).alias("lo"), F.coalesce(F.max("end_ms"), F.lit(1000)).alias("hi"))


@query("w12_greedy_spacing", """WITH RECURSIVE p AS (SELECT user_id, epoch_us(ts) // 10000000 AS pt, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    r AS (SELECT user_id, n, pt, pt AS last, true AS ok FROM p WHERE n = 1 UNION ALL SELECT p.user_id, p.n, p.pt, CASE WHEN p.pt - r.last >= 2000 THEN p.pt ELSE r.last END, p.pt - r.last >= 2000 FROM r JOIN p ON p.user_id = r.user_id AND p.n = r.n + 1)
    SELECT user_id, pt FROM r WHERE ok""")  # fmt: skip
def w12(spark, d):
    from .views import spans

    points = spans(spark, d).select(F.col("key").alias("user_id"), F.col("start_ms").alias("pt"))
    return scans.greedy_spacing(points, ["user_id"], "pt", 2000)


@query("w13_moving_average", """WITH RECURSIVE p AS (SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN value END AS x, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
    r AS (SELECT user_id, event_id, n, x::DOUBLE AS ema FROM p WHERE n = 1 UNION ALL SELECT p.user_id, p.event_id, p.n, CASE WHEN p.x IS NULL THEN NULL WHEN r.ema IS NULL THEN p.x ELSE p.x / 3 + r.ema * 2 / 3 END FROM r JOIN p ON p.user_id = r.user_id AND p.n = r.n + 1)
    SELECT user_id, event_id, round(ema, 6) AS ema FROM r""")  # fmt: skip
def w13(spark, d):
    e = table(spark, d, "events").withColumn("x", F.when(F.col("event_type") != "error", F.col("value")))
    return scans.moving_average(e, ["user_id"], ["event_id"], "x", ["event_id"]).select("user_id", "event_id", F.round("ema", 6).alias("ema"))


def frames(spark, d):
    """Events as frames of their user: one each 100 ms, in order."""
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    e, kind = table(spark, d, "events"), F.col("event_type")
    places = lambda c: F.round(c * 10_000) / 10_000  # noqa: E731  as SQL rounds doubles: Spark's round to four places takes a half in the shortest decimal for a half in the double
    return e.select(
        F.col("user_id").alias("key"), (i * 100).alias("pts_ms"), (kind != "error").alias("target_present"), places(F.least(F.col("value"), F.lit(100.0)) / 250).alias("target_mar"),
        (F.col("event_id") % 7 == 0).alias("target_suspended"), (F.col("event_id") % 5 == 0).alias("other_present"), F.when(F.col("event_id") % 3 > 0, places(F.lit(0.3) - F.least(F.col("value"), F.lit(100.0)) / 400)).alias("other_mar"),
        (F.col("value") > 8).alias("vad"),
    )


_STEP = """SELECT x.*, CASE WHEN mode = 'HOLD' AND NOT susp AND pts >= deadline THEN 'plosive_expiry' WHEN mode = 'HOLD' AND NOT susp AND op AND oe > 0.15 THEN 'interviewer_interjection' END AS reason FROM
    (SELECT p.*, r.mode, r.start, r.frames, r.present, r.closed, CASE WHEN r.mode = 'HOLD' AND p.susp THEN r.deadline + 100 ELSE r.deadline END AS deadline,
     CASE WHEN NOT p.op THEN NULL WHEN p.omar IS NULL THEN r.oe WHEN r.oe IS NULL THEN p.omar ELSE p.omar / 3 + r.oe * 2 / 3 END AS oe,
     CASE WHEN NOT p.tp THEN NULL WHEN p.susp THEN r.ema WHEN r.ema IS NULL THEN p.mar ELSE p.mar / 3 + r.ema * 2 / 3 END AS ema
     FROM r JOIN p ON p.key = r.key AND p.n = r.n + 1) x"""


@query("w14_speaking_windows", f"""WITH RECURSIVE p AS (SELECT user_id AS key, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) * 100 AS pts, event_type <> 'error' AS tp, round(least(value, 100.0) / 250, 4) AS mar,
        event_id % 7 = 0 AS susp, event_id % 5 = 0 AS op, CASE WHEN event_id % 3 > 0 THEN round(0.3 - least(value, 100.0) / 400, 4) END AS omar, value > 8 AS vad FROM events),
    r AS (SELECT DISTINCT key, 0::BIGINT AS n, 0::BIGINT AS pts, 'IDLE' AS mode, NULL::DOUBLE AS ema, NULL::DOUBLE AS oe, NULL::BIGINT AS start, NULL::BIGINT AS deadline, 0::BIGINT AS frames, 0::BIGINT AS present, 0::BIGINT AS closed,
        NULL::VARCHAR AS reason, NULL::BIGINT AS e_start, NULL::BIGINT AS e_stop, 0::BIGINT AS e_frames, 0::BIGINT AS e_present, 0::BIGINT AS e_closed FROM p
      UNION ALL
      SELECT key, n, pts, CASE WHEN begins THEN 'ACTIVE' WHEN reason IS NOT NULL THEN 'IDLE' WHEN mode = 'HOLD' AND NOT susp AND tp AND ema > 0.15 AND vad THEN 'ACTIVE' WHEN quiet THEN 'HOLD' ELSE mode END, ema, oe,
        CASE WHEN begins THEN pts ELSE start END, CASE WHEN quiet THEN pts + 500 ELSE deadline END,
        CASE WHEN begins THEN 1 WHEN reason IS NOT NULL OR mode = 'IDLE' THEN 0 ELSE frames + 1 END,
        CASE WHEN begins THEN op::INT WHEN reason IS NOT NULL OR mode = 'IDLE' THEN 0 ELSE present + op::INT END,
        CASE WHEN begins THEN (op AND coalesce(oe < 0.1, false))::INT WHEN reason IS NOT NULL OR mode = 'IDLE' THEN 0 ELSE closed + (op AND coalesce(oe < 0.1, false))::INT END,
        reason, CASE WHEN reason IS NOT NULL THEN start END, CASE WHEN reason = 'plosive_expiry' THEN deadline WHEN reason IS NOT NULL THEN pts END, frames, present, closed
      FROM (SELECT *, (mode = 'IDLE' OR reason IS NOT NULL) AND tp AND NOT susp AND coalesce(ema > 0.15, false) AND vad AS begins, mode = 'ACTIVE' AND NOT susp AND (NOT tp OR coalesce(ema < 0.1, false) OR NOT vad) AS quiet FROM ({_STEP}))),
    z AS (SELECT * FROM r WHERE mode <> 'IDLE' AND n = (SELECT max(n) FROM p WHERE p.key = r.key))
    SELECT key, e_start AS start_ms, e_stop AS stop_ms, reason, e_frames AS frames, e_present AS other_present, e_closed AS other_closed FROM r WHERE reason IS NOT NULL
    UNION ALL SELECT key, start, pts, 'end_of_video', frames, present, closed FROM z""")  # fmt: skip
def w14(spark, d):
    return folds.speaking_windows(frames(spark, d), ["key"])


@query("v9_greedy_clusters", f"""WITH RECURSIVE p AS (SELECT *, row_number() OVER (PARTITION BY file_index ORDER BY pos) AS n FROM {VECTORS}),
    r AS (SELECT file_index, vec_id, n, 0::BIGINT AS cluster, [v] AS firsts FROM p WHERE n = 1
      UNION ALL SELECT file_index, vec_id, n, coalesce(hit, len(firsts)), CASE WHEN hit IS NULL THEN list_append(firsts, v) ELSE firsts END
      FROM (SELECT p.file_index, p.vec_id, p.n, p.v, r.firsts, list_position(list_transform(r.firsts, lambda f: round(list_cosine_similarity(f, p.v), 6) >= 0.25), true) - 1 AS hit FROM r JOIN p ON p.file_index = r.file_index AND p.n = r.n + 1))
    SELECT file_index, vec_id, cluster FROM r""")  # fmt: skip
def v9(spark, d):
    return folds.greedy_clusters(vectors(spark, d), ["file_index"], ["pos"], "v", ["vec_id"], 0.25)


_ACC = f"(SELECT v.file_index, v.dur_ms, v.label, round(list_cosine_similarity(v.v, s.m), 6) + 0.0 AS s FROM {VECTORS} v, {sql_mean('label = 0 AND file_index = 0')} s)"


@query("l1_prefix_enrollment", f"""SELECT file_index, accepted, verified_ms, CASE WHEN verified_ms >= 45000 THEN 'STRONG' WHEN verified_ms >= 20000 THEN 'MARGINAL' ELSE 'INSUFFICIENT' END AS state
    FROM (SELECT file_index, accepted, sum(ms) OVER (ORDER BY file_index)::BIGINT AS verified_ms FROM (SELECT file_index, count(*) FILTER (label = 0 AND s >= 0.1) AS accepted, coalesce(sum(dur_ms) FILTER (label = 0 AND s >= 0.1), 0) AS ms FROM {_ACC} GROUP BY 1))""")  # fmt: skip
def l1(spark, d):
    v = vectors(spark, d)
    seed = pools.weighted_mean(v.where("label = 0 and file_index = 0"), [], "v", F.col("dur_ms"))
    s = F.round(cosine(F.col("v"), F.col("mean")), 6)
    good = (F.col("label") == 0) & (F.col("s") >= 0.1)
    per_file = v.join(F.broadcast(seed)).withColumn("s", s).groupBy("file_index").agg(F.count_if(good).alias("accepted"), F.coalesce(F.sum(F.when(good, F.col("dur_ms"))), F.lit(0)).alias("ms"))
    # running sums within ranges of files, each range after what the ranges before it total; only those totals, one for 1,024 files, meet in one task
    ranged = per_file.withColumn("range", F.expr("file_index div 1024"))
    totals = ranged.groupBy("range").agg(F.sum("ms").alias("total"))
    before = totals.select("range", (F.sum("total").over(Window.orderBy("range")) - F.col("total")).alias("before"))
    inner = F.sum("ms").over(Window.partitionBy("range").orderBy("file_index"))
    out = ranged.withColumn("inner", inner).join(before, "range").withColumn("verified_ms", F.col("inner") + F.col("before"))
    return out.select("file_index", "accepted", "verified_ms", rules.quality_state(F.col("verified_ms"), F.lit(0.0), F.lit(True)).alias("state"))
