"""Queries of enrollment gates, click guardrails and pool history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import gates
from ..functions.vectors import cosine
from ..operators import enrollment, pairing, pools
from .registry import query
from .rule_queries import frames
from .vector_queries import _SCORES, scores
from .views import VECTORS, spans, spans_sql, table, vectors


@query("c7_audio_gate", f"""SELECT vec_id, CASE WHEN vec_id % 17 = 0 THEN 'seed_overlap' WHEN s_t < 0.05 THEN 'low_sim_to_anchor' WHEN vec_id % 4 > 0 AND (s_i > 0.1 OR round(s_t - s_i, 6) < 0.08) THEN 'anti_reject' ELSE 'accepted' END AS outcome FROM {_SCORES}""")
def c7(spark, d):
    v = F.col("vec_id")
    # the margin lies between two values of six places
    reason = gates.audio_gate(v % 17 == 0, F.col("s_t"), F.when(v % 4 > 0, F.col("s_i")), accept_min=0.05, anti_max=0.1, margin=0.0799999)
    return scores(spark, d).select("vec_id", F.coalesce(reason, F.lit("accepted")).alias("outcome"))


@query("c7_seed_gate", f"""WITH w AS (SELECT vec_id, file_index, pos * 1000 AS a, pos * 1000 + dur_ms AS b FROM {VECTORS}), s AS (SELECT file_index, pos * 1000 AS a, pos * 1000 + dur_ms AS b FROM {VECTORS} WHERE label = 0 AND pos < 30)
    SELECT vec_id, CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.file_index = w.file_index AND w.a < s.b AND s.a < w.b) THEN 'seed_overlap' WHEN s_t < 0.05 THEN 'low_sim_to_anchor' WHEN s_i > 0.1 OR round(s_t - s_i, 6) < 0.08 THEN 'anti_reject' ELSE 'accepted' END AS outcome
    FROM w JOIN {_SCORES} USING (vec_id, file_index)""")  # fmt: skip
def c7_seeds(spark, d):
    """The gate with seeds from the recording: the first thirty seconds' vectors of label 0 exclude what they overlap."""
    v = vectors(spark, d).select("vec_id", "file_index", "pos", "label", (F.col("pos") * 1000).alias("start_ms"), (F.col("pos") * 1000 + F.col("dur_ms")).alias("end_ms"))
    spans_ = pairing.seed_excluded(v.select("vec_id", "file_index", "start_ms", "end_ms"), v.where("label = 0 and pos < 30"), ["vec_id"], "file_index")
    # the margin lies between two values of six places
    reason = gates.audio_gate(F.col("seed_overlap"), F.col("s_t"), F.col("s_i"), accept_min=0.05, anti_max=0.1, margin=0.0799999)
    return spans_.join(scores(spark, d).select("vec_id", "s_t", "s_i"), "vec_id").select("vec_id", F.coalesce(reason, F.lit("accepted")).alias("outcome"))


@query("c8_anti_centers", "SELECT user_id, pts_ms FROM (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) * 100 AS pts_ms FROM events) WHERE event_id % 5 = 0 AND event_id % 3 > 0 AND round(0.3 - least(value, 100.0) / 400, 4) < 0.1 AND value > 8")
def c8(spark, d):
    hit = gates.anti_center(F.col("other_present"), F.col("other_mar"), F.col("vad"))
    return frames(spark, d).where(hit).select(F.col("key").alias("user_id"), "pts_ms")


@query("c9_speaking_clicks", f"""WITH s AS {spans_sql()}, c AS (SELECT key, id, start_ms AS p FROM s WHERE kind = 'click'),
    w AS (SELECT key, id AS wid, start_ms, end_ms, id % 9 AS present, least(id * 5 % 9, id % 9) AS closed FROM s WHERE kind <> 'click'),
    m AS (SELECT c.id, w.*, row_number() OVER (PARTITION BY c.id ORDER BY w.start_ms, w.wid) AS n FROM c JOIN w ON w.key = c.key AND c.p BETWEEN w.start_ms AND w.end_ms)
    SELECT c.id AS click_id, m.start_ms AS window_start_ms, CASE WHEN m.wid IS NULL THEN 'click_outside_speaking_window' WHEN m.end_ms - m.start_ms < 3000 THEN 'seed_too_short' WHEN m.present > 0 AND 1 - m.closed / m.present > 0.2 THEN 'overlap_at_speaking_click' ELSE 'ok' END AS outcome
    FROM c LEFT JOIN m ON m.id = c.id AND m.n = 1""")  # fmt: skip
def c9(spark, d):
    every, i = spans(spark, d), F.col("id")
    clicks = every.where("kind = 'click'").select("key", "id", F.col("start_ms").alias("at_ms"))
    windows = every.where("kind <> 'click'").select("key", "id", "start_ms", "end_ms", (i % 9).alias("present"), F.least(i * 5 % 9, i % 9).alias("closed"))
    return enrollment.judged_clicks(clicks, windows).select(F.col("id").alias("click_id"), "window_start_ms", F.coalesce("reason", F.lit("ok")).alias("outcome"))


@query("c9_anti_clicks", f"""SELECT vec_id, CASE WHEN s_t >= 0.1 THEN 'anti_click_matches_target' WHEN vec_id % 5 > 0 AND (vec_id % 30) / 100 >= 0.15 THEN 'target_lips_open_at_anti_click' WHEN vec_id % 3 = 0 THEN 'no_audio_energy_at_anti_click' ELSE 'ok' END AS outcome FROM {_SCORES}""")
def c9_anti(spark, d):
    v = F.col("vec_id")
    reason = gates.anti_click(F.col("s_t"), F.when(v % 5 > 0, (v % 30) / 100), v % 3 > 0, same_min=0.1)
    return scores(spark, d).select("vec_id", F.coalesce(reason, F.lit("ok")).alias("outcome"))


@query("a11_pool_history", f"""WITH f AS (SELECT label, file_index, count(*) AS c, sum(dur_ms) AS d FROM {VECTORS} GROUP BY ALL),
    p AS (SELECT a.label, greatest(a.file_index, b.file_index) AS f, list_cosine_similarity(a.v, b.v) AS s FROM {VECTORS} a JOIN {VECTORS} b ON a.label = b.label AND a.vec_id < b.vec_id),
    r AS (SELECT f.label, f.file_index, coalesce(var_pop(p.s), 0) AS var FROM f LEFT JOIN p ON p.label = f.label AND p.f <= f.file_index GROUP BY ALL)
    SELECT label, file_index, (sum(c) OVER w)::BIGINT AS pool_size, (sum(d) OVER w)::BIGINT AS verified_ms, round(var, 6) AS pool_variance FROM f JOIN r USING (label, file_index) WINDOW w AS (PARTITION BY label ORDER BY file_index)""")  # fmt: skip
def a11(spark, d):
    return enrollment.pool_history(vectors(spark, d), ["label"], "file_index", "v", "dur_ms").withColumn("pool_variance", F.round("pool_variance", 6))


@query("a14_reid_warnings", f"SELECT file_index, label, round(avg(s_t), 6) AS reid_mean FROM {_SCORES} GROUP BY ALL HAVING avg(s_t) < 0.05")
def a14(spark, d):
    return scores(spark, d).groupBy("file_index", "label").agg(F.avg("s_t").alias("m")).where("m < 0.05").select("file_index", "label", F.round("m", 6).alias("reid_mean"))


@query("a2_median", "SELECT l_suppkey, round(median(l_extendedprice::DOUBLE), 6) AS mid FROM lineitem GROUP BY 1")
def a2(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(F.median(F.col("l_extendedprice").cast("double")), 6).alias("mid"))


#: Sessions of five files.  Windows are the vectors of labels 0 and 2, five seconds from their slot on: coverage by the seconds of labels 0, 2 and 4, present and closed
#: faces by the slots of labels from 5 and those of them under three seconds.  Anti vectors are those of label 1.
_SLOTS = f"""(SELECT a.vec_id, a.file_index // 5 AS session, a.file_index, a.v, a.dur_ms, count(*) FILTER (b.label IN (0, 2, 4)) / 5 AS coverage, count(*) FILTER (b.label >= 5) AS present, count(*) FILTER (b.label >= 5 AND b.dur_ms < 3000) AS closed
    FROM {VECTORS} a JOIN {VECTORS} b ON b.file_index = a.file_index AND b.pos BETWEEN a.pos AND a.pos + 4 WHERE a.label IN (0, 2) GROUP BY ALL)"""
_COURSE = f"""
    WITH RECURSIVE x AS MATERIALIZED (SELECT session, list(m ORDER BY i) AS seed FROM (SELECT file_index // 5 AS session, i, sum(v[i] * dur_ms) / sum(dur_ms) AS m FROM {VECTORS}, range(1, 65) t(i) WHERE label = 0 AND file_index % 5 = 0 GROUP BY ALL) GROUP BY session),
    n AS MATERIALIZED (SELECT file_index // 5 AS session, file_index, label, v, dur_ms FROM {VECTORS} WHERE label = 1),
    f AS MATERIALIZED (SELECT DISTINCT file_index // 5 AS session, file_index FROM {VECTORS} WHERE label IN (0, 1, 2)),
    a AS MATERIALIZED (SELECT session, file_index, CASE WHEN count(b) > 0 THEN list(b ORDER BY i) END AS before, list(c ORDER BY i) AS after FROM (SELECT f.session, f.file_index, i, sum(v[i] * dur_ms) FILTER (n.file_index < f.file_index) / sum(dur_ms) FILTER (n.file_index < f.file_index) AS b, sum(v[i] * dur_ms) / sum(dur_ms) AS c
        FROM f JOIN n ON n.session = f.session AND n.file_index <= f.file_index, range(1, 65) t(i) GROUP BY ALL) GROUP BY ALL),
    s AS MATERIALIZED (SELECT w.*, round(list_cosine_similarity(w.v, x.seed), 6) AS seed, CASE WHEN a.before IS NOT NULL THEN round(list_cosine_similarity(w.v, a.before), 6) END AS s1, CASE WHEN a.after IS NOT NULL THEN round(list_cosine_similarity(w.v, a.after), 6) END AS s2
        FROM {_SLOTS} w JOIN x USING (session) LEFT JOIN a USING (session, file_index)),
    g AS MATERIALIZED (SELECT *, coverage >= 0.4 AND (present = 0 OR closed / present >= 0.5) AND seed >= 0 AS ab FROM s),
    p AS MATERIALIZED (SELECT session, file_index, vec_id, v, dur_ms, CASE WHEN s1 IS NULL OR (s1 <= 0 AND seed >= s1) THEN 1 WHEN s2 <= 0 AND seed >= s2 THEN 2 END AS k FROM g WHERE ab),
    c AS MATERIALIZED (SELECT y.session, y.vec_id AS a, z.vec_id AS b, list_cosine_similarity(y.v, z.v) AS s FROM p y JOIN p z ON y.session = z.session AND y.vec_id < z.vec_id WHERE y.k > 0 AND z.k > 0),
    o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY session ORDER BY file_index) AS i, coalesce((SELECT list(vec_id) FROM p WHERE p.file_index = f.file_index AND k = 1), []) AS one, coalesce((SELECT list(vec_id) FROM p WHERE p.file_index = f.file_index AND k = 2), []) AS two,
        EXISTS (SELECT 1 FROM n WHERE n.session = f.session AND n.file_index <= f.file_index) AS has_anti FROM f),
    r AS (SELECT session, 0::BIGINT AS i, NULL::BIGINT AS file_index, []::BIGINT[] AS ids, 0::BIGINT AS accepted, 0::BIGINT AS second_pass, 0::BIGINT AS verified_ms, 0::DOUBLE AS var, '' AS first_state, '' AS state FROM (SELECT DISTINCT session FROM o)
      UNION ALL SELECT session, i, file_index, ids2, len(one), CASE WHEN again THEN len(two) ELSE 0 END, ms2, var2, first_state,
        CASE WHEN ms2 >= CASE WHEN has_anti THEN 45000 ELSE 60000 END AND var2 <= 0.05 THEN 'STRONG' WHEN ms2 >= 20000 THEN 'MARGINAL' ELSE 'INSUFFICIENT' END
      FROM (SELECT *, (SELECT coalesce(sum(dur_ms), 0)::BIGINT FROM p WHERE list_contains(ids2, vec_id)) AS ms2, (SELECT coalesce(var_pop(s), 0) FROM c WHERE list_contains(ids2, a) AND list_contains(ids2, b)) AS var2
      FROM (SELECT *, first_state = 'MARGINAL' AND has_anti AS again, CASE WHEN first_state = 'MARGINAL' AND has_anti THEN list_concat(ids1, two) ELSE ids1 END AS ids2
      FROM (SELECT *, CASE WHEN ms1 >= CASE WHEN has_anti THEN 45000 ELSE 60000 END AND var1 <= 0.05 THEN 'STRONG' WHEN ms1 >= 20000 THEN 'MARGINAL' ELSE 'INSUFFICIENT' END AS first_state
      FROM (SELECT *, (SELECT coalesce(sum(dur_ms), 0)::BIGINT FROM p WHERE list_contains(ids1, vec_id)) AS ms1, (SELECT coalesce(var_pop(s), 0) FROM c WHERE list_contains(ids1, a) AND list_contains(ids1, b)) AS var1
      FROM (SELECT o.session, o.i, o.file_index, o.one, o.two, o.has_anti, list_concat(r.ids, o.one) AS ids1 FROM r JOIN o ON o.session = r.session AND o.i = r.i + 1))))))
    SELECT session, file_index, accepted, second_pass, verified_ms, len(ids) AS pool_size, round(var, 6) AS pool_variance, first_state, state FROM r WHERE i > 0"""  # fmt: skip


def course(spark, d):
    v = vectors(spark, d).withColumn("session", F.expr("file_index div 5"))
    near = v.select("file_index", "pos", F.col("label").alias("l"), F.col("dur_ms").alias("ms")).withColumn("at", F.explode(F.expr("sequence(greatest(pos - 4, 0), pos)"))).drop("pos")
    target = v.where("label in (0, 2)").withColumnRenamed("pos", "at")
    sides = [F.count_if(F.col("l").isin(0, 2, 4)), F.count_if(F.col("l") >= 5), F.count_if((F.col("l") >= 5) & (F.col("ms") < 3000))]
    seen = target.select("vec_id", "file_index", "at").join(near, ["file_index", "at"]).groupBy("vec_id").agg((sides[0] / 5).alias("coverage"), sides[1].alias("present"), sides[2].alias("closed"))
    seeds = pools.weighted_mean(v.where("label = 0 and file_index % 5 = 0"), ["session"], "v", F.col("dur_ms"))
    windows = target.join(seen, "vec_id").join(seeds, "session").withColumn("seed", F.round(cosine(F.col("v"), F.col("mean")), 6))
    windows = windows.select("session", "file_index", F.col("v").alias("vector"), F.col("dur_ms").alias("duration_ms"), "coverage", "present", "closed", "seed")
    anti = v.where("label = 1").select("session", "file_index", F.col("v").alias("vector"), F.col("dur_ms").alias("duration_ms"))
    return enrollment.enrollment_course(windows, anti, ["session"], "file_index", coverage_min=0.4, closed_min=0.5, seed_min=0.0, anti_max=0.0, margin=0.0)


@query("c12_enrollment_course", _COURSE)
def c12_course(spark, d):
    return course(spark, d).drop("sim_composite_anti").withColumn("pool_variance", F.round("pool_variance", 6))


@query("c10_batch_verdict", f"""SELECT session, state, verified_ms, pool_variance, CASE WHEN verified_ms < 20000 OR state = 'INSUFFICIENT' THEN 'critical_enrollment_failure' WHEN pool_variance > 0.05 THEN 'high_pool_variance_operator_review' ELSE 'ok' END AS outcome
    FROM ({_COURSE}) QUALIFY row_number() OVER (PARTITION BY session ORDER BY file_index DESC) = 1""")  # fmt: skip
def c10_verdict(spark, d):
    out = enrollment.batch_verdict(course(spark, d), ["session"], "file_index")
    return out.select("session", "state", "verified_ms", F.round("pool_variance", 6).alias("pool_variance"), F.coalesce("outcome", F.lit("ok")).alias("outcome"))
