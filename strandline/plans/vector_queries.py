"""Queries of vector pools, windows, tiers and runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import TierParams
from ..functions.vectors import cosine, normalize
from ..operators import islands as isl
from ..operators import pairing, pools, tracking
from ..sources.shared import stored
from .registry import query
from .views import VECTORS, table, vectors

#: Thresholds under which the test vectors fill every tier.
P = TierParams(clamp_low=0.02, clamp_high=0.04, med_step=0.04, med_floor=0.0, evidence_floor=-0.04, margin=0.0)


def sql_mean(where: str) -> str:
    return f"(SELECT list(x ORDER BY i) AS m FROM (SELECT i, sum(v[i] * dur_ms) / sum(dur_ms) AS x FROM {VECTORS}, range(1, 65) t(i) WHERE {where} GROUP BY i))"


def composite(spark, d, label: int):
    return pools.weighted_mean(vectors(spark, d).where(F.col("label") == label), [], "v", F.col("dur_ms")).select(F.col("mean").alias(f"m{label}"))


@query("v1_normalize", f"SELECT vec_id, pos_, round(CASE WHEN n <= 1e-12 THEN 0 ELSE x / n END, 6) + 0.0 AS x FROM (SELECT vec_id, sqrt(list_sum(list_transform(v, lambda a: 4 * a * a))) AS n, unnest(list_transform(v, lambda a: 2 * a)) AS x, unnest(range(0, 64)) AS pos_ FROM {VECTORS})")
def v1(spark, d):
    twice = F.transform("v", lambda x: 2 * x)
    return vectors(spark, d).select("vec_id", F.posexplode(normalize(twice)).alias("p", "x")).select("vec_id", F.col("p").cast("long").alias("pos_"), (F.round("x", 6) + 0.0).alias("x"))


_SCORES = f"(SELECT vec_id, file_index, pos, dur_ms, label, round(list_cosine_similarity(v, a.m), 6) + 0.0 AS s_t, round(list_cosine_similarity(v, b.m), 6) + 0.0 AS s_i FROM {VECTORS}, {sql_mean('label = 0')} a, {sql_mean('label = 1')} b)"


def scores(spark, d):
    """Each vector's cosines to the composites of labels 0 and 1, to six places."""
    both = vectors(spark, d).withColumns({f"m{label}": composite(spark, d, label).scalar() for label in (0, 1)})
    at = lambda m: F.round(cosine(F.col("v"), F.col(m)), 6) + 0.0
    return both.select("vec_id", "file_index", "pos", "dur_ms", "label", at("m0").alias("s_t"), at("m1").alias("s_i"))


@query("v2_cosine", f"SELECT vec_id, s_t, s_i FROM {_SCORES}")
def v2(spark, d):
    return scores(spark, d).select("vec_id", "s_t", "s_i")


@query("v3_weighted_mean", f"SELECT label, i::BIGINT - 1 AS dim, round(sum(v[i] * dur_ms) / sum(dur_ms), 6) + 0.0 AS x FROM {VECTORS}, range(1, 65) t(i) GROUP BY label, i")
def v3(spark, d):
    m = pools.weighted_mean(vectors(spark, d), ["label"], "v", F.col("dur_ms"))
    return m.select("label", F.posexplode("mean").alias("p", "x")).select("label", F.col("p").cast("long").alias("dim"), (F.round("x", 6) + 0.0).alias("x"))


@query("v4_mean_embedding", f"SELECT label, i::BIGINT - 1 AS dim, round(x / sqrt(sum(x * x) OVER (PARTITION BY label)), 6) + 0.0 AS x FROM (SELECT label, i, avg(v[i]) AS x FROM {VECTORS}, range(1, 65) t(i) GROUP BY label, i)")
def v4(spark, d):
    m = pools.weighted_mean(vectors(spark, d), ["label"], "v", F.lit(1)).withColumn("mean", normalize(F.col("mean")))
    return m.select("label", F.posexplode("mean").alias("p", "x")).select("label", F.col("p").cast("long").alias("dim"), (F.round("x", 6) + 0.0).alias("x"))


_LOO = f"(SELECT vec_id, round(list_cosine_similarity(any_value(v), list(x ORDER BY i)), 6) + 0.0 AS loo FROM (SELECT a.vec_id, any_value(a.v) AS v, i, sum(b.v[i] * b.dur_ms) / sum(b.dur_ms) AS x FROM {VECTORS} a JOIN {VECTORS} b ON b.label = a.label AND a.vec_id <> b.vec_id, range(1, 65) t(i) WHERE a.label = 0 GROUP BY a.vec_id, i) GROUP BY vec_id)"


def loo(spark, d):
    pool = vectors(spark, d).where("label = 0")
    return pools.leave_one_out(pool, ["label"], "v", "dur_ms").select("vec_id", (F.round("loo", 6) + 0.0).alias("loo"))


@query("v5_leave_one_out", f"""SELECT vec_id, round(list_cosine_similarity(any_value(v), list(rest ORDER BY i)), 6) + 0.0 AS loo FROM (SELECT a.vec_id, a.v, t.i, t.s - a.v[t.i] * a.dur_ms AS rest
    FROM {VECTORS} a JOIN (SELECT label, i, sum(v[i] * dur_ms) AS s, count(*) AS n FROM {VECTORS}, range(1, 65) r(i) GROUP BY label, i) t ON t.label = a.label AND t.n > 1) GROUP BY vec_id""")  # fmt: skip
def v5(spark, d):
    return pools.leave_one_out(vectors(spark, d), ["label"], "v", "dur_ms").select("vec_id", (F.round("loo", 6) + 0.0).alias("loo"))


@query("v6_pair_variance", f"SELECT a.label, count(*) AS pairs, round(var_pop(list_cosine_similarity(a.v, b.v)), 6) AS variance FROM {VECTORS} a JOIN {VECTORS} b ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY 1")
def v6(spark, d):
    found = pools.pair_variance(vectors(spark, d), ["label"], "v")
    return found.select("label", F.expr("n * (n - 1) div 2").alias("pairs"), F.round("variance", 6).alias("variance"))


@query("v7_best_match", f"""WITH m AS (SELECT label AS name, list(x ORDER BY i) AS m FROM (SELECT label, i, sum(v[i] * dur_ms) / sum(dur_ms) AS x FROM {VECTORS}, range(1, 65) t(i) GROUP BY label, i) GROUP BY 1),
    s AS (SELECT vec_id, name, round(list_cosine_similarity(v, m), 6) + 0.0 AS s, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_cosine_similarity(v, m), 6) DESC, name) AS n FROM {VECTORS}, m)
    SELECT vec_id, CASE WHEN s >= 0.1 THEN name END AS match, CASE WHEN s >= 0.1 THEN s END AS similarity FROM s WHERE n = 1""")  # fmt: skip
def v7(spark, d):
    v = vectors(spark, d)
    return pools.best_match(v, "v", pools.weighted_mean(v, ["label"], "v", F.col("dur_ms")), "label", "mean", 0.1).select("vec_id", "match", "similarity")


@query("v12_contamination", f"SELECT round(s, 6) AS similarity, CASE WHEN s > 0.6 THEN 'HALT' WHEN s > 0.45 THEN 'WARNING' ELSE 'OK' END AS level FROM (SELECT list_cosine_similarity(a.m, b.m) AS s FROM {sql_mean('label = 0')} a, {sql_mean('label = 1')} b)")
def v12(spark, d):
    from ..functions.rules import contamination_level

    s = composite(spark, d, 0).withColumn("m1", composite(spark, d, 1).scalar()).select(cosine(F.col("m0"), F.col("m1")).alias("s"))
    return s.select(F.round("s", 6).alias("similarity"), contamination_level(F.col("s")).alias("level"))


@query("v14_consensus_anchor", f"""WITH a AS {sql_mean('label = 0 AND dur_ms >= 3000')}, k AS (SELECT v.vec_id, v.v, v.dur_ms FROM {VECTORS} v, a WHERE round(list_cosine_similarity(v.v, a.m), 6) >= 0.15),
    b AS (SELECT list(x ORDER BY i) AS m FROM (SELECT i, sum(v[i] * dur_ms) / sum(dur_ms) AS x FROM k, range(1, 65) t(i) GROUP BY i))
    SELECT k.vec_id, round(list_cosine_similarity(k.v, b.m), 6) + 0.0 AS similarity, round(list_cosine_similarity(k.v, b.m), 6) < 0.3 AS outlier FROM k, b""")  # fmt: skip
def v14(spark, d):
    v = vectors(spark, d)
    anchor = pools.weighted_mean(v.where("label = 0 and dur_ms >= 3000"), [], "v", F.col("dur_ms"))
    return pools.consensus(v, "v", F.col("dur_ms"), anchor, 0.15, 0.3).select("vec_id", "similarity", "outlier")


@query("a1_quantile", "SELECT user_id, round(quantile_cont(value, 0.1), 6) AS q10, round(median(value), 6) AS q50 FROM events GROUP BY 1")
def a1(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.round(F.percentile("value", F.lit(0.1)), 6).alias("q10"), F.round(F.median("value"), 6).alias("q50"))


_GEN = f"SELECT loo AS s FROM {_LOO}"
_CAL = f"""(SELECT n AS n_enrollment, CASE WHEN n >= 10 THEN least(greatest(raw, 0.02), 0.04) ELSE 0.6 END AS theta_high, CASE WHEN n >= 10 THEN greatest(least(greatest(raw, 0.02), 0.04) - 0.04, 0.0) ELSE 0.4 END AS theta_med,
    CASE WHEN n < 10 THEN 'FALLBACK_DEFAULTS' WHEN worst IS NULL THEN 'DERIVED_NO_ANTI' ELSE 'DERIVED' END AS calibration, n >= 10 AND raw > 0.04 AS calibration_overlap
    FROM (SELECT n, worst, CASE WHEN worst IS NULL THEN greatest(q, 0.55) ELSE greatest(q, worst + 0.05) END AS raw FROM (SELECT count(*) AS n, quantile_cont(s, 0.1) AS q FROM ({_GEN})), (SELECT max(s_t) AS worst FROM {_SCORES} WHERE label = 1)))"""


def calibration(spark, d, scored=None):
    genuine = loo(spark, d).select(F.col("loo").alias("s"))
    impostor = (scores(spark, d) if scored is None else scored).where("label = 1").select(F.col("s_t").alias("s"))
    return pools.calibrate(genuine, impostor, P)


@query("c6_calibration", f"SELECT n_enrollment, round(theta_high, 6) AS theta_high, round(theta_med, 6) AS theta_med, calibration, calibration_overlap FROM {_CAL}")
def c6(spark, d):
    return calibration(spark, d).select("n_enrollment", F.round("theta_high", 6).alias("theta_high"), F.round("theta_med", 6).alias("theta_med"), "calibration", "calibration_overlap")


def files(spark, d):
    return vectors(spark, d).groupBy("file_index").agg((F.max("pos") * 1000 + 5000).alias("duration_ms"))


_FILES = f"(SELECT file_index, max(pos) * 1000 + 5000 AS duration_ms FROM {VECTORS} GROUP BY 1)"


@query("w15_plan_windows", f"SELECT file_index, unnest(range(0, (duration_ms - 5000) // 1000 + 1)) * 1000 AS ws, unnest(range(0, (duration_ms - 5000) // 1000 + 1)) * 1000 + 5000 AS we FROM {_FILES} WHERE duration_ms > 5000 UNION ALL SELECT file_index, 0, duration_ms FROM {_FILES} WHERE duration_ms <= 5000")
def w15(spark, d):
    return tracking.plan_windows(files(spark, d)).select("file_index", "ws", "we")


@query("v10_chunks", "SELECT l_orderkey, l_linenumber, g AS chunk, g * 58000 AS start_ms, least(g * 58000 + 60000, dur) AS end_ms FROM (SELECT *, unnest(range(0, greatest(ceil((dur - 2000) / 58000)::BIGINT, 1))) AS g FROM (SELECT l_orderkey, l_linenumber, l_quantity::BIGINT * 5000 AS dur FROM lineitem))")
def v10(spark, d):
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("long") * 5000).alias("duration_ms"))
    return tracking.plan_chunks(l).select("l_orderkey", "l_linenumber", "chunk", "start_ms", "end_ms")


@query("v10_window_vectors", f"""WITH d AS (SELECT file_index, label, i, count(*) AS n_chunks, (max(pos * 1000 + dur_ms) - min(pos * 1000))::BIGINT AS duration_ms, sum(v[i] * dur_ms) / sum(dur_ms) AS m FROM {VECTORS}, range(1, 65) t(i) GROUP BY ALL)
    SELECT file_index, label, n_chunks, duration_ms, i::BIGINT - 1 AS dim, round(CASE WHEN n_chunks = 1 THEN m ELSE m / sqrt(sum(m * m) OVER (PARTITION BY file_index, label)) END, 6) + 0.0 AS x FROM d""")  # fmt: skip
def v10_pooled(spark, d):
    chunks = vectors(spark, d).withColumn("start_ms", F.col("pos") * 1000).withColumn("end_ms", F.col("start_ms") + F.col("dur_ms"))
    pooled = pools.window_vectors(chunks, ["file_index", "label"], "v")
    each = pooled.select("file_index", "label", "n_chunks", "duration_ms", F.posexplode("vector").alias("p", "x"))
    return each.select("file_index", "label", "n_chunks", "duration_ms", F.col("p").cast("long").alias("dim"), (F.round("x", 6) + 0.0).alias("x"))


#: One window a vector; the seconds of vectors of label 0 are speech.
_SPOKEN = f"(SELECT a.vec_id, a.file_index, a.pos, 1000 * count(b.vec_id) AS overlap_ms FROM {VECTORS} a LEFT JOIN {VECTORS} b ON b.file_index = a.file_index AND b.label = 0 AND b.pos BETWEEN a.pos AND a.pos + 4 GROUP BY ALL)"


def spoken_windows(spark, d):
    """Windows with their speech overlap, and whether it is enough for scoring."""
    v = vectors(spark, d).select("vec_id", "file_index", "pos", "label", (F.col("pos") * 1000).alias("start_ms"))
    speech = v.where("label = 0").select("file_index", "start_ms", (F.col("start_ms") + 1000).alias("end_ms"))
    return pairing.speech_share(v.drop("label").withColumn("end_ms", F.col("start_ms") + 5000), speech, ["vec_id"], "file_index")


def windows(spark, d, scored=None):
    """Scored windows; those with too little speech are skipped."""
    enough = spoken_windows(spark, d).where("scored").select("vec_id")
    return (scores(spark, d) if scored is None else scored).join(enough, "vec_id").select("file_index", (F.col("pos") * 1000).alias("ws"), (F.col("pos") * 1000 + 5000).alias("we"), "s_t", "s_i")


_POOLED = f"""(SELECT file_index, block_index, coalesce(n, 0) AS evaluations, s_t AS s_target, s_i AS s_other
    FROM (SELECT file_index, unnest(range(0, duration_ms // 1000)) AS block_index FROM {_FILES})
    LEFT JOIN (SELECT file_index, b AS block_index, count(*) AS n, median(s_t) AS s_t, median(s_i) AS s_i FROM (SELECT *, unnest(range(pos, pos + 5)) AS b FROM {_SCORES} WHERE vec_id IN (SELECT vec_id FROM {_SPOKEN} WHERE overlap_ms >= 1000)) GROUP BY ALL) USING (file_index, block_index))"""


def pooled(spark, d, scored=None):
    return tracking.median_pool(files(spark, d), windows(spark, d, scored))


@query("a3_median_pool", f"SELECT file_index, block_index, evaluations, round(s_target, 8) AS s_target, round(s_other, 8) AS s_other FROM {_POOLED}")
def a3(spark, d):
    return pooled(spark, d).select("file_index", "block_index", "evaluations", F.round("s_target", 8).alias("s_target"), F.round("s_other", 8).alias("s_other"))


_TIERED = f"""(SELECT p.*, theta_high, theta_med, CASE WHEN s_target IS NULL THEN 'SKIPPED' WHEN s_target > theta_high THEN CASE WHEN s_other IS NOT NULL AND s_target - s_other > 0 THEN 'HIGH' ELSE 'MEDIUM' END
    WHEN s_target > theta_med THEN 'MEDIUM' WHEN s_target >= -0.04 THEN 'SUB' ELSE 'REJECT' END AS tier, coalesce(s_target > theta_high AND NOT coalesce(s_target - s_other > 0, false), false) AS margin_failed FROM {_POOLED} p, {_CAL} c)"""


@dataclass
class Tracked:
    """What the queries from here on share, each computed once and stored: scores of all vectors, the one row of calibration, tiered blocks."""

    scores: DataFrame
    calibration: DataFrame
    tiers: DataFrame
    files: DataFrame

    def runs(self) -> DataFrame:
        r = isl.runs(self.tiers, ["file_index"], "block_index", F.col("tier") == "HIGH")
        return r.select("file_index", (F.col("first") * 1000).alias("start_ms"), (F.col("stop") * 1000).alias("end_ms"))

    def refined(self) -> DataFrame:
        """Runs with edges trimmed by fine windows, each scored by the vector of the second where it starts."""
        runs = self.runs()
        s = self.scores.select("file_index", F.col("pos").alias("slot"), "s_t", "s_i")
        hit = tracking.fine_windows(runs, self.files).withColumn("slot", F.expr("ws div 1000")).join(s, ["file_index", "slot"])
        passes = tracking.fine_passes(F.col("s_t"), F.col("s_i"), self.calibration.select("theta_high").scalar(), P.margin)
        return tracking.refine_edges(runs, hit.select("file_index", "start_ms", "leading", "p", passes.alias("passes")))

    def trimmed(self) -> DataFrame:
        return self.refined().where("survives").select("file_index", F.col("new_start_ms").alias("start_ms"), F.col("new_end_ms").alias("end_ms"))


def tracked(spark, d) -> Tracked:
    scored = stored(scores(spark, d), "scores")
    calibrated = stored(calibration(spark, d, scored), "calibration")
    return Tracked(scored, calibrated, stored(tracking.tiered(pooled(spark, d, scored), calibrated, P), "tiers"), files(spark, d))


def tiers(spark, d):
    return tracked(spark, d).tiers


@query("c5_tier_blocks", f"SELECT file_index, block_index, tier, margin_failed FROM {_TIERED}")
def c5(spark, d):
    return tiers(spark, d).select("file_index", "block_index", "tier", "margin_failed")


@query("a6_tier_counts", "SELECT file_index, " + ", ".join(f"count(*) FILTER (tier = '{t}') AS n_{t.lower()}" for t in ("HIGH", "MEDIUM", "SUB", "REJECT", "SKIPPED")) + f" FROM {_TIERED} GROUP BY 1")
def a6(spark, d):
    names = ("HIGH", "MEDIUM", "SUB", "REJECT", "SKIPPED")
    return tiers(spark, d).groupBy("file_index").agg(*(F.count_if(F.col("tier") == t).alias(f"n_{t.lower()}") for t in names))


_RUNS = f"(SELECT file_index, min(block_index) * 1000 AS start_ms, (max(block_index) + 1) * 1000 AS end_ms FROM (SELECT *, block_index - row_number() OVER (PARTITION BY file_index ORDER BY block_index) AS g FROM {_TIERED} WHERE tier = 'HIGH') GROUP BY file_index, g)"


_FINE = f"""(SELECT r.file_index, r.start_ms, lead, p, s.s_t > c.theta_high AND coalesce(s.s_t - s.s_i > 0, true) AS passes FROM
    (SELECT *, CASE WHEN lead THEN greatest(p, 0) ELSE greatest(p - 2000, 0) END AS ws, CASE WHEN lead THEN least(p + 2000, duration_ms) ELSE least(p, duration_ms) END AS we
     FROM (SELECT file_index, start_ms, true AS lead, unnest(range(start_ms - 2000, start_ms + 2001, 250)) AS p FROM {_RUNS} UNION ALL SELECT file_index, start_ms, false, unnest(range(end_ms - 2000, end_ms + 2001, 250)) FROM {_RUNS}) JOIN {_FILES} USING (file_index)) r
    JOIN {_SCORES} s ON s.file_index = r.file_index AND s.pos = r.ws // 1000, {_CAL} c WHERE r.we - r.ws >= 1000)"""
_REFINED = f"""(SELECT *, CASE WHEN ns < end_ms AND trail IS NOT NULL AND end_ms - trail <= 750 THEN trail WHEN trail_demoted THEN end_ms - 1000 ELSE end_ms END AS ne FROM
    (SELECT *, ns < end_ms AND NOT coalesce(end_ms - trail <= 750, false) AND end_ms - 1000 > ns AS trail_demoted FROM
    (SELECT *, NOT coalesce(lead_at - start_ms <= 750, false) AS lead_demoted, CASE WHEN coalesce(lead_at - start_ms <= 750, false) THEN lead_at ELSE start_ms + 1000 END AS ns FROM
    (SELECT r.file_index, r.start_ms, r.end_ms, min(p) FILTER (passes AND lead AND p >= r.start_ms) AS lead_at, max(p) FILTER (passes AND NOT lead AND p <= r.end_ms) AS trail FROM {_RUNS} r LEFT JOIN {_FINE} f USING (file_index, start_ms) GROUP BY ALL))))"""


@query("w18_edge_trim", f"SELECT file_index, start_ms, end_ms, ns AS new_start_ms, ne AS new_end_ms, lead_demoted, trail_demoted, ns < ne AS survives FROM {_REFINED}")
def w18(spark, d):
    return tracked(spark, d).refined()


@query("a7_file_summary", "SELECT file_index, " + ", ".join(f"n_{t}" for t in ("high", "medium", "sub", "reject", "skipped")) + f""", high_ms, silero_ms, round(high_ms / nullif(silero_ms, 0), 6) AS ratio,
    CASE WHEN silero_ms = 0 THEN 'NO_SPEECH' WHEN high_ms / silero_ms > 0.25 THEN 'NORMAL' WHEN high_ms / silero_ms >= 0.10 THEN 'LOW_ADVISORY' ELSE 'NEAR_ZERO_ALERT' END AS ratio_level, greatest(silero_ms - high_ms, 0) AS unattributed_ms
    FROM (SELECT file_index, {", ".join(f"count(*) FILTER (tier = '{t.upper()}') AS n_{t}" for t in ("high", "medium", "sub", "reject", "skipped"))} FROM {_TIERED} GROUP BY 1)
    JOIN (SELECT file_index, coalesce(sum(ne - ns) FILTER (ns < ne), 0)::BIGINT AS high_ms FROM {_FILES} LEFT JOIN {_REFINED} USING (file_index) GROUP BY 1) USING (file_index)
    JOIN (SELECT file_index, sum(dur_ms)::BIGINT AS silero_ms FROM {VECTORS} GROUP BY 1) USING (file_index)""")  # fmt: skip
def a7(spark, d):
    t = tracked(spark, d)
    speech = vectors(spark, d).groupBy("file_index").agg(F.sum("dur_ms").alias("silero_ms"))
    return tracking.file_summary(t.tiers, t.trimmed(), speech).withColumn("ratio", F.round("ratio", 6))


@query("a9_totals_rollup", f"SELECT coalesce(file_index::VARCHAR, 'all') AS file, count(*) AS runs, sum(ne - ns)::BIGINT AS high_ms FROM {_REFINED} WHERE ns < ne GROUP BY ROLLUP (file_index)")
def a9(spark, d):
    runs = tracked(spark, d).refined().where("survives")
    out = runs.rollup("file_index").agg(F.count("*").alias("runs"), F.sum(F.col("new_end_ms") - F.col("new_start_ms")).alias("high_ms"))
    return out.select(F.coalesce(F.col("file_index").cast("string"), F.lit("all")).alias("file"), "runs", "high_ms")


_EARLY = "(SELECT user_id, event_id, round(value / 490, 6) AS s, CASE WHEN event_type <> 'error' THEN round(value / 490, 6) END AS known, 1000 + 500 * (event_id % 5) AS dur, ts FROM events)"


@query("w9_first30_mean", f"SELECT user_id, round(avg(s), 6) AS first_mean FROM (SELECT *, coalesce(sum(dur) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM {_EARLY}) WHERE b < 30000 GROUP BY 1")
def w9(spark, d):
    e = table(spark, d, "events").withColumn("s", F.round(F.col("value") / 490, 6))
    out = tracking.first_high_mean(e, ["user_id"], "event_id", 1000 + 500 * F.expr("event_id % 5"), "s")
    return out.select("user_id", F.round("first_mean", 6).alias("first_mean"))


@query("w10_drift", f"SELECT event_id, round(p, 6) AS previous_mean, round(p - s, 6) AS delta FROM (SELECT *, last_value(known IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM {_EARLY}) WHERE round(p - s, 6) > 0.1")
def w10(spark, d):
    e = table(spark, d, "events").withColumn("s", F.round(F.col("value") / 490, 6)).withColumn("known", F.when(F.col("event_type") != "error", F.col("s")))
    out = tracking.drift(e, ["user_id"], "event_id", "known", "s", 0.0).withColumn("delta", F.round("delta", 6)).where("delta > 0.1")
    return out.select("event_id", F.round("previous_mean", 6).alias("previous_mean"), "delta")


@query("w11_variance_jump", f"SELECT event_id, round(s - p, 6) AS increase FROM (SELECT *, last_value(known IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM {_EARLY}) WHERE known IS NOT NULL AND round(s - p, 6) > 0.05")
def w11(spark, d):
    e = table(spark, d, "events").withColumn("s", F.round(F.col("value") / 490, 6)).withColumn("known", F.when(F.col("event_type") != "error", F.col("s")))
    return tracking.variance_jumps(e, ["user_id"], "event_id", "known", "s", 0.05).select("event_id", "increase")
