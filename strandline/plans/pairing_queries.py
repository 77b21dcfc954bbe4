"""Queries of identity pairing, clicked faces, seed exclusion, speech shares and second passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import gates
from ..functions.rules import triple_gate
from ..operators import pairing, tracking
from .registry import query
from .vector_queries import _REFINED, _SCORES, _SPOKEN, _TIERED, scores, spoken_windows, tracked
from .views import VECTORS, spans, spans_sql, table, vectors

#: Four consecutive vectors of a file are the faces of a frame; boxes come from their numbers.
_FACES = f"(SELECT file_index, pos // 4 AS frame, pos % 4 AS ord, s_t AS sim_target, s_i AS sim_other, abs(s_i) AS det_score, (vec_id * 37) % 100 AS x0, (vec_id * 53) % 100 AS y0, (vec_id * 37) % 100 + 20 + vec_id % 30 AS x1, (vec_id * 53) % 100 + 25 + vec_id % 20 AS y1 FROM {_SCORES})"


def faces(spark, d):
    v = F.col("vec_id")
    x, y = v * 37 % 100, v * 53 % 100
    return scores(spark, d).select(
        "file_index", F.expr("pos div 4").alias("frame"), F.expr("pos % 4").alias("ord"), F.col("s_t").alias("sim_target"), F.col("s_i").alias("sim_other"),
        F.abs("s_i").alias("det_score"), x.alias("x0"), y.alias("y0"), (x + 20 + v % 30).alias("x1"), (y + 25 + v % 20).alias("y1"),
    )


def _identities(other: str) -> str:
    rest = f"(SELECT f.*, row_number() OVER (PARTITION BY f.file_index, f.frame ORDER BY {other} DESC, f.ord) AS n FROM {_FACES} f LEFT JOIN t ON t.file_index = f.file_index AND t.frame = f.frame WHERE t.ord IS NULL OR f.ord <> t.ord)"
    return f"""WITH t AS (SELECT file_index, frame, ord FROM (SELECT *, row_number() OVER (PARTITION BY file_index, frame ORDER BY sim_target DESC, ord) AS n FROM {_FACES}) WHERE n = 1 AND sim_target >= 0.02),
        o AS (SELECT file_index, frame, ord FROM {rest} WHERE n = 1{' AND sim_other >= 0.02' if other == 'sim_other' else ''})
        SELECT f.file_index, f.frame, t.ord AS target, o.ord AS other FROM (SELECT DISTINCT file_index, frame FROM {_FACES}) f LEFT JOIN t USING (file_index, frame) LEFT JOIN o USING (file_index, frame)"""


@query("j16_identities_known", _identities("sim_other"))
def j16(spark, d):
    return pairing.paired_identities(faces(spark, d), ["file_index", "frame"], 0.02, True)


@query("j16_identities_unknown", _identities("det_score"))
def j16b(spark, d):
    return pairing.paired_identities(faces(spark, d), ["file_index", "frame"], 0.02, False)


@query("j8_clicked_face", f"""WITH c AS (SELECT DISTINCT file_index, frame, file_index * 1000 + frame AS click, (frame * 17) % 120 AS x, (frame * 29) % 120 AS y FROM {_FACES}),
    j AS (SELECT *, x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 AS held FROM c JOIN {_FACES} USING (file_index, frame)),
    r AS (SELECT *, row_number() OVER (PARTITION BY click ORDER BY held DESC, CASE WHEN held THEN -det_score ELSE ((x0 + x1) / 2 - x) * ((x0 + x1) / 2 - x) + ((y0 + y1) / 2 - y) * ((y0 + y1) / 2 - y) END, ord) AS n FROM j)
    SELECT click, ord, held AS contained FROM r WHERE n = 1""")  # fmt: skip
def j8_face(spark, d):
    f = faces(spark, d)
    clicks = f.select("file_index", "frame").distinct().select("*", (F.col("file_index") * 1000 + F.col("frame")).alias("click"), (F.col("frame") * 17 % 120).alias("x"), (F.col("frame") * 29 % 120).alias("y"))
    return pairing.clicked_faces(clicks, f, ["file_index", "frame"], "click")


@query("j14_faces_at", f"""WITH p AS (SELECT file_index, frame FROM (SELECT DISTINCT file_index FROM {_FACES}), range(0, 30) t(frame))
    SELECT p.file_index, p.frame, count(f.ord) AS n, coalesce(string_agg(f.ord::VARCHAR, ',' ORDER BY f.ord), '') AS ords FROM p LEFT JOIN {_FACES} f ON f.file_index = p.file_index AND f.frame = p.frame GROUP BY 1, 2""")
def j14(spark, d):
    f = faces(spark, d)
    times = f.select("file_index").distinct().withColumn("frame", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(29).cast("long"))))
    out = pairing.faces_at(times, f, "file_index", "frame", ["det_score"])
    return out.select("file_index", "frame", F.size("faces").cast("long").alias("n"), F.array_join(F.transform("faces", lambda x: x["ord"].cast("string")), ",").alias("ords"))


@query("j17_frame_times", f"SELECT v.file_index, v.pos, p.pts_ms, v.vec_id FROM {VECTORS} v JOIN (SELECT user_id AS file_index, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, epoch_us(ts) // 1000 AS pts_ms FROM events) p USING (file_index, pos)")
def j17(spark, d):
    from pyspark.sql import Window

    from .views import epoch_ms

    e = table(spark, d, "events")
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long") - 1
    clock = e.select(F.col("user_id").alias("file_index"), number.alias("pos"), epoch_ms("ts").alias("pts_ms"))
    return pairing.positional_join(vectors(spark, d), clock, "file_index", "pos").select("file_index", "pos", "pts_ms", "vec_id")


_SEEDS, _SPANS = f"(SELECT * FROM {spans_sql('click')} WHERE id % 40 = 0)", f"(SELECT * FROM {spans_sql()} WHERE kind <> 'click')"


@query("j10_seed_overlap", f"""WITH s AS (SELECT * FROM {_SEEDS}), h AS (SELECT key, min(start_ms) AS a, max(end_ms) AS b FROM s GROUP BY 1)
    SELECT c.id, EXISTS (SELECT 1 FROM s WHERE s.key = c.key AND c.start_ms < s.end_ms AND s.start_ms < c.end_ms) AS seed_overlap, coalesce(c.start_ms < h.b AND c.end_ms > h.a, false) AS hull_overlap FROM {_SPANS} c LEFT JOIN h USING (key)""")
def j10(spark, d):
    every = spans(spark, d).select("key", "id", "start_ms", "end_ms", "kind")
    seeds, rest = every.where("kind = 'click' and id % 40 = 0"), every.where("kind <> 'click'")
    one = pairing.seed_excluded(rest, seeds, ["id"], "key")
    both = pairing.seed_excluded(one.withColumnRenamed("seed_overlap", "one"), seeds, ["id"], "key", hull=True)
    return both.select("id", F.col("one").alias("seed_overlap"), F.col("seed_overlap").alias("hull_overlap"))


@query("w16_speech_share", f"SELECT file_index, pos * 1000 AS ws, overlap_ms, overlap_ms / 5000 >= 0.2 AS scored FROM {_SPOKEN}")
def w16(spark, d):
    return spoken_windows(spark, d).select("file_index", F.col("start_ms").alias("ws"), "overlap_ms", "scored")


@query("w8_longest_spans", f"SELECT key, rank, start_ms, end_ms FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY end_ms - start_ms DESC, start_ms) AS rank FROM (SELECT DISTINCT key, start_ms, end_ms FROM {spans_sql()})) WHERE rank <= 8")
def w8(spark, d):
    s = spans(spark, d).select("key", "start_ms", "end_ms").distinct()
    return pairing.longest(s, ["key"]).select("key", F.col("rank").cast("long").alias("rank"), "start_ms", "end_ms")


@query("v8_own_thresholds", f"""SELECT vec_id, name, s FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, name) AS n FROM (SELECT vec_id, s_t AS s, 0.05 AS least, 'target' AS name FROM {_SCORES} UNION ALL SELECT vec_id, s_i, 0.02, 'other' FROM {_SCORES}) WHERE s >= least) WHERE n = 1""")
def v8(spark, d):
    both = scores(spark, d).select("vec_id", F.explode(F.array(F.struct(F.col("s_t").alias("s"), F.lit(0.05).alias("least"), F.lit("target").alias("name")), F.struct(F.col("s_i").alias("s"), F.lit(0.02).alias("least"), F.lit("other").alias("name")))).alias("c")).select("vec_id", "c.*")
    return pairing.match_with_thresholds(both, "vec_id", "s", "least", "name")


_RUN_BLOCKS = f"""(SELECT r.file_index, r.start_ms, b.block_index, greatest(r.ns, b.block_index * 1000) AS from_ms, least(r.ne, b.block_index * 1000 + 1000) AS to_ms FROM {_REFINED} r JOIN {_TIERED} b ON b.file_index = r.file_index AND b.tier = 'HIGH' AND b.block_index * 1000 < r.ne AND b.block_index * 1000 + 1000 > r.ns WHERE r.ns < r.ne)"""


@query("j12_run_blocks", f"SELECT file_index, block_index, from_ms, to_ms FROM {_RUN_BLOCKS}")
def j12(spark, d):
    t = tracked(spark, d)
    return pairing.run_blocks(t.trimmed(), t.tiers).select("file_index", "block_index", "from_ms", "to_ms")


@query("a6_adjusted_counts", f"""SELECT t.file_index, count(*) FILTER (t.tier = 'HIGH' AND b.block_index IS NOT NULL) AS n_high, count(*) FILTER (t.tier = 'MEDIUM' OR t.tier = 'HIGH' AND b.block_index IS NULL) AS n_medium, count(*) FILTER (t.tier = 'SUB') AS n_sub, count(*) FILTER (t.tier = 'REJECT') AS n_reject, count(*) FILTER (t.tier = 'SKIPPED') AS n_skipped
    FROM {_TIERED} t LEFT JOIN (SELECT DISTINCT file_index, block_index FROM {_RUN_BLOCKS}) b USING (file_index, block_index) GROUP BY 1""")
def a6_adjusted(spark, d):
    """Tier counts after demotion: a HIGH block that no trimmed run reaches counts as MEDIUM."""
    t = tracked(spark, d)
    adjusted = tracking.adjusted_tiers(t.tiers, pairing.run_blocks(t.trimmed(), t.tiers))
    names = ("HIGH", "MEDIUM", "SUB", "REJECT", "SKIPPED")
    return adjusted.groupBy("file_index").agg(*(F.count_if(F.col("tier") == n).alias(f"n_{n.lower()}") for n in names))


@query("c2_mixed_trap", f"SELECT vec_id, s_t > 0.1 AS discarded FROM {_SCORES}")
def c2(spark, d):
    return scores(spark, d).select("vec_id", gates.mixed_trap(F.col("s_t"), 0.1).alias("discarded"))


@query("c12_second_pass", f"""WITH g AS (SELECT vec_id, s_t, s_i FROM {_SCORES} WHERE (pos * 7) % 10 >= 5 AND s_t >= 0 AND (s_i > 0.05 OR round(s_t - s_i, 6) < 0.0299999))
    SELECT vec_id, CASE WHEN round(s_i / 2, 6) > 0.05 THEN 'high_sim_to_anti' WHEN s_t - round(s_i / 2, 6) < 0.0299999 THEN 'margin_too_small' ELSE 'accepted' END AS outcome FROM g""")
def c12(spark, d):
    bounds = {"seed_min": 0.0, "anti_max": 0.05, "margin": 0.0299999}
    rows = scores(spark, d).select("vec_id", F.expr("(pos * 7) % 10 / 10").alias("coverage"), F.lit(0).alias("present"), F.lit(0).alias("closed"), F.col("s_t").alias("seed"), F.col("s_i").alias("anti"))
    first = rows.withColumn("gate", triple_gate(F.col("coverage"), F.col("present"), F.col("closed"), F.col("seed"), F.col("anti"), F.lit(True), **bounds)["gate"])
    again = pairing.second_pass(first, F.round(F.col("anti") / 2, 6), **bounds)
    return again.select("vec_id", F.coalesce("again.reason", F.lit("accepted")).alias("outcome"))


@query("c10_batch_end", f"""SELECT label, verified_ms, CASE WHEN verified_ms < 30000 THEN 'critical_enrollment_failure' WHEN variance > 0.0156 THEN 'high_pool_variance_operator_review' ELSE 'ok' END AS outcome
    FROM (SELECT label, sum(dur_ms)::BIGINT AS verified_ms FROM {VECTORS} GROUP BY 1) JOIN (SELECT a.label, round(var_pop(list_cosine_similarity(a.v, b.v)), 6) AS variance FROM {VECTORS} a JOIN {VECTORS} b ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY 1) USING (label)""")
def c10(spark, d):
    from ..operators import pools

    v = vectors(spark, d)
    per = v.groupBy("label").agg(F.sum("dur_ms").alias("verified_ms")).join(pools.pair_variance(v, ["label"], "v").select("label", F.round("variance", 6).alias("variance")), "label")
    return per.select("label", "verified_ms", F.coalesce(gates.batch_end(F.col("verified_ms"), F.lit("STRONG"), F.col("variance"), 30_000, 0.0156), F.lit("ok")).alias("outcome"))


@query("p5_clamp_local", "SELECT l_orderkey, l_linenumber, least(greatest(l_partkey::BIGINT, 500), 500 + l_suppkey::BIGINT) AS at_ms FROM lineitem")
def p5(spark, d):
    at = gates.clamp_local(F.col("l_partkey").cast("long"), F.lit(500).cast("long"), F.col("l_suppkey").cast("long"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", at.alias("at_ms"))


@query("io20_located", """WITH f AS (SELECT s_suppkey AS file_index, 'in/' || replace(s_name, '#', '') || CASE WHEN s_suppkey % 2 = 0 THEN '.mp4' ELSE '.mov' END AS source, replace(s_name, '#', '') AS stem FROM supplier),
    e AS (SELECT *, printf('%03d', file_index) || '_' || stem || '.16k.wav' AS expected FROM f)
    SELECT file_index, source, CASE WHEN file_index % 3 = 0 THEN 'work' || (file_index % 2) || '/' || expected WHEN file_index % 3 = 1 THEN 'loose/take ' || stem || '.wav' END AS wav FROM e""")
def io20(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("file_index"), F.replace("s_name", F.lit("#"), F.lit("")).alias("stem"))
    i = F.col("file_index")
    files = s.select("file_index", F.concat(F.lit("in/"), "stem", F.when(i % 2 == 0, ".mp4").otherwise(".mov")).alias("source"))
    expected = F.format_string("%03d_%s.16k.wav", "file_index", "stem")
    folders = s.where("file_index % 3 = 0").select((i % 2).alias("place"), F.concat(F.lit("work"), (i % 2).cast("string"), F.lit("/"), expected).alias("path"))
    loose = s.where("file_index % 3 = 1").select(i.alias("place"), F.concat(F.lit("loose/take "), "stem", F.lit(".wav")).alias("path"))
    return pairing.located(files, folders, loose)
