"""Queries of click sessions, exports, click documents, log notices, refusals and batch totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.gates import activity_review
from ..functions.rules import activity_level, utc_stamp
from ..operators import intervals as iv
from ..operators import islands as isl
from ..operators import pairing, sessions
from ..sources.clicks import parse_clicks
from .interval_queries import _DECIDED, MERGED, _evidence
from .registry import query
from .views import spans, spans_sql, table

#: An event's number says what the operator did.
_ACTION = "CASE event_id % 10 WHEN 0 THEN 'beard' WHEN 1 THEN 'clear_speaking' WHEN 2 THEN 'clear_anti' WHEN 3 THEN 'anti' WHEN 4 THEN 'anti' ELSE 'speaking' END"
_STATES = f"""(WITH a AS (SELECT user_id, event_id, {_ACTION} AS action, event_id % 20 = 0 AS flag FROM events),
    b AS (SELECT *, row_number() OVER w AS n, coalesce(last_value(CASE WHEN action = 'beard' THEN flag END IGNORE NULLS) OVER w, false) AS tb FROM a WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    c AS (SELECT *, sum(CASE WHEN action = 'clear_speaking' OR tb <> was THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY n) AS ep FROM (SELECT *, coalesce(lag(tb) OVER (PARTITION BY user_id ORDER BY n), false) AS was FROM b)),
    s AS (SELECT user_id, event_id, action, tb, count(*) FILTER (action = 'speaking') OVER w AS clicks, min(CASE WHEN action = 'speaking' THEN n END) OVER w AS fs, max(CASE WHEN action = 'speaking' THEN n END) OVER w AS ls,
      max(CASE WHEN action IN ('speaking', 'clear_anti') THEN n END) OVER w AS stale, max(CASE WHEN action = 'anti' THEN n END) OVER w AS an FROM c WINDOW w AS (PARTITION BY user_id, ep ORDER BY n))
    SELECT s.user_id, s.event_id, s.action, s.tb AS target_bearded, CASE WHEN s.tb THEN clicks ELSE least(clicks, 1) END AS seeds, sp.event_id AS speaking_id, an.event_id AS anti_id, CASE WHEN s.action = 'anti' AND clicks = 0 THEN 'speaking_click_required_first' END AS reason
    FROM s LEFT JOIN b sp ON sp.user_id = s.user_id AND sp.n = CASE WHEN s.tb THEN fs ELSE ls END LEFT JOIN b an ON an.user_id = s.user_id AND an.n = CASE WHEN clicks > 0 AND s.an > stale THEN s.an END)"""  # fmt: skip


def states(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.expr(_ACTION).alias("action"), (F.col("event_id") % 20 == 0).alias("target_flag"))
    return sessions.session_states(e, ["user_id"], ["event_id"])


@query("u7_session_states", f"SELECT * FROM {_STATES}")
def u7(spark, d):
    return states(spark, d)


@query("io24_export_reasons", f"""SELECT user_id, CASE WHEN speaking_id IS NULL THEN 'export_requires_speaking_click' WHEN target_bearded AND anti_id IS NULL THEN 'anti_click_required_beard' WHEN user_id % 2 = 0 AND anti_id IS NULL THEN 'anti_click_not_registered' ELSE 'ok' END AS outcome
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM {_STATES}) WHERE k = 1""")
def io24(spark, d):
    last = states(spark, d).groupBy("user_id").agg(F.max_by(F.struct("speaking_id", "anti_id", "target_bearded"), "event_id").alias("s")).select("user_id", "s.*")
    reason = sessions.export_reason(F.col("speaking_id"), F.col("anti_id"), F.col("target_bearded"), F.col("user_id") % 2 == 0)
    return last.select("user_id", F.coalesce(reason, F.lit("ok")).alias("outcome"))


@query("io13_clicks", """SELECT event_id, CASE event_id % 5 WHEN 1 THEN 'speaking_click is mandatory' WHEN 2 THEN 'file_index and pts_ms must be integers, x and y numbers' WHEN 3 THEN 'flags must be booleans' END AS error,
    CASE WHEN event_id % 5 IN (0, 4) THEN user_id END AS pts_ms, CASE WHEN event_id % 5 = 0 THEN user_id + 1 END AS anti_pts_ms FROM events""")
def io13(spark, d):
    click = "'{{\"file_index\": 0, \"pts_ms\": ', {}, ', \"x\": 1.5, \"y\": 2}}'"
    kind, user = "event_id % 5", "user_id"
    quoted = "CASE WHEN event_id % 5 = 2 THEN concat('\"', user_id, '\"') ELSE cast(user_id AS string) END"
    doc = F.expr(f"""concat(CASE WHEN {kind} = 1 THEN '{{' ELSE concat('{{"speaking_click": ', {click.format(quoted)}, ', ') END,
        CASE WHEN {kind} = 0 THEN concat('"anti_click": ', {click.format(user + ' + 1')}, ', ') ELSE '"anti_click": null, ' END, '"target_bearded": ', CASE WHEN {kind} = 3 THEN '1' ELSE 'true' END, '}}')""")  # fmt: skip
    c = table(spark, d, "events").select("event_id", parse_clicks(doc).alias("c"))
    return c.select("event_id", "c.error", F.col("c.speaking.pts_ms").alias("pts_ms"), F.col("c.anti.pts_ms").alias("anti_pts_ms"))


@query("a10_batch_summary", f"""WITH s AS (SELECT key AS file_index, end_ms - start_ms AS ms, kind FROM {spans_sql()}),
    f AS (SELECT c_custkey AS file_index, (c_custkey * 1000)::BIGINT AS duration_ms FROM customer),
    p AS (SELECT file_index, sum(ms) FILTER (kind = 'click') AS a, count(*) FILTER (kind = 'click') AS na, sum(ms) FILTER (kind = 'view') AS b, count(*) FILTER (kind = 'view') AS nb, sum(ms) FILTER (kind = 'purchase') AS c, count(*) FILTER (kind = 'purchase') AS nc, sum(ms) FILTER (kind NOT IN ('click', 'view', 'purchase')) AS e, count(*) FILTER (kind NOT IN ('click', 'view', 'purchase')) AS ne FROM s GROUP BY 1)
    SELECT f.file_index, count(*) AS files, sum(duration_ms)::BIGINT AS duration_ms, sum(coalesce(a, 0))::BIGINT AS speech_ms, sum(coalesce(na, 0))::BIGINT AS n_speech, sum(coalesce(b, 0))::BIGINT AS high_ms, sum(coalesce(nb, 0))::BIGINT AS n_high, sum(coalesce(c, 0))::BIGINT AS clean_ms, sum(coalesce(nc, 0))::BIGINT AS n_clean, sum(coalesce(e, 0))::BIGINT AS excluded_ms, sum(coalesce(ne, 0))::BIGINT AS n_excluded
    FROM f LEFT JOIN p USING (file_index) GROUP BY ROLLUP (f.file_index)""")
def a10(spark, d):
    s = spans(spark, d).withColumnRenamed("key", "file_index")
    files = table(spark, d, "customer").select(F.col("c_custkey").alias("file_index"), (F.col("c_custkey") * 1000).cast("long").alias("duration_ms"))
    kinds = ("click", "view", "purchase")
    return sessions.batch_summary(files, *(s.where(F.col("kind") == k) for k in kinds), s.where(~F.col("kind").isin(*kinds)))


@query("p12_refusals", f"""SELECT user_id, event_id, CASE WHEN reason IS NOT NULL THEN 'Register the speaking click first.' WHEN event_id % 7 = 0 THEN 'The speaking window lasts ' || event_id || ' ms, and a seed needs 3000 ms.' END AS message FROM {_STATES} WHERE reason IS NOT NULL OR event_id % 7 = 0""")
def p12(spark, d):
    s = states(spark, d).withColumn("why", F.coalesce("reason", F.when(F.col("event_id") % 7 == 0, "seed_too_short"))).where("why is not null")
    return s.select("user_id", "event_id", sessions.refusal_text(F.col("why"), F.col("event_id"), F.lit(3000)).alias("message"))


_EPOCHS = _STATES[: _STATES.index("SELECT s.user_id")] + "SELECT c.*, e.value FROM c JOIN events e USING (user_id, event_id))"


@query("u7_anchors", f"""SELECT user_id, event_id, round(CASE WHEN tb THEN avg(value) FILTER (said) OVER w ELSE last_value(CASE WHEN said THEN value END IGNORE NULLS) OVER w END, 6) AS x,
    round(CASE WHEN tb THEN avg(event_id % 7) FILTER (said) OVER w ELSE last_value(CASE WHEN said THEN event_id % 7 END IGNORE NULLS) OVER w END, 6) AS y FROM (SELECT *, action = 'speaking' AS said FROM {_EPOCHS}) WINDOW w AS (PARTITION BY user_id, ep ORDER BY n)""")  # fmt: skip
def u7_anchors(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.expr(_ACTION).alias("action"), (F.col("event_id") % 20 == 0).alias("target_flag"), F.array("value", (F.col("event_id") % 7).cast("double")).alias("face"))
    a = sessions.session_anchors(e, ["user_id"], ["event_id"], "face")
    return a.select("user_id", "event_id", *(F.round(F.get("anchor", F.lit(i)), 6).alias(n) for i, n in enumerate("xy")))


@query("u7_refused_clicks", f"SELECT user_id, event_id, seeds, speaking_id, anti_id FROM {_STATES.replace(_ACTION + ' AS action', 'CASE WHEN event_id % 3 = 0 AND (' + _ACTION + ") IN ('speaking', 'anti') THEN 'refused' ELSE " + _ACTION + ' END AS action')}")
def u7_refused(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.expr(_ACTION).alias("action"), (F.col("event_id") % 20 == 0).alias("target_flag"), (F.col("event_id") % 3 > 0).alias("valid"))
    return sessions.session_states(e, ["user_id"], ["event_id"]).select("user_id", "event_id", "seeds", "speaking_id", "anti_id")


@query("io24_payloads", f"""WITH l AS (SELECT * FROM {_STATES} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1), c AS (SELECT event_id, '{{"file_index":0,"pts_ms":' || event_id * 10 || ',"x":' || round_even(value, 2) || ',"y":' || round_even(value * 3, 2) || '}}' AS j FROM events)
    SELECT l.user_id, '{{' || CASE WHEN a.j IS NULL THEN '' ELSE '"anti_click":' || a.j || ',' END || CASE WHEN l.user_id % 3 = 0 THEN '"interviewer_bearded":true,' ELSE '' END || '"speaking_click":' || s.j || CASE WHEN l.target_bearded THEN ',"target_bearded":true' ELSE '' END || '}}' AS payload
    FROM l JOIN c s ON s.event_id = l.speaking_id LEFT JOIN c a ON a.event_id = l.anti_id""")  # fmt: skip
def io24_payloads(spark, d):
    """The click document of each session that has a speaking click, read back as a check."""
    clicks = table(spark, d, "events").select("event_id", F.struct(F.lit(0).alias("file_index"), (F.col("event_id") * 10).alias("pts_ms"), F.col("value").alias("x"), (F.col("value") * 3).alias("y")).alias("c"))
    last = states(spark, d).groupBy("user_id").agg(F.max_by(F.struct("speaking_id", "anti_id", "target_bearded"), "event_id").alias("s")).select("user_id", "s.*").where("speaking_id is not null")
    side = lambda n: clicks.select(F.col("event_id").alias(f"{n}_id"), F.col("c").alias(n))
    both = last.join(side("speaking"), "speaking_id").join(side("anti"), "anti_id", "left")
    none = F.array_remove(F.array("speaking"), F.col("speaking"))
    payload = sessions.export_payload(F.col("speaking"), none, F.col("anti"), F.col("target_bearded"), F.col("user_id") % 3 == 0)
    return sessions.checked_exports(both.withColumn("payload", payload)).select("user_id", "payload")


_SAY = {
    0: ("no_face_at_speaking_click", "'No face is seen within 500 ms of this time; click inside a face''s box.'"), 1: ("no_face_at_anti_click", "'No face is seen within 500 ms of this time; the other person has to be in the picture.'"),
    2: ("click_not_in_solo_speech", "'With the target''s lips unseen a seed needs 500 ms of speech with no other face in the picture.'"), 3: ("invalid_request", "'The request is malformed: pts_ms must be an integer, x and y numbers, type ''speaking'' or ''anti''.'"),
    4: ("click_outside_speaking_window", "'The target doesn''t speak here; click where it clearly does.'"), 5: ("no_audio_energy_at_anti_click", "'Nobody speaks at this time.'"), 6: ("export_requires_speaking_click", "'No speaking click is registered.'"),
    7: ("anti_click_required_beard", "'With the target''s lips unseen an anti click is required.'"), 8: ("anti_click_not_registered", "'The anti click to be exported isn''t registered.'"), 9: ("seed_too_short", "'The speaking window lasts ' || event_id || ' ms, and a seed needs 500 ms.'"),
}


@query("p12_reasons", f"SELECT event_id, CASE event_id % 11 {' '.join(f'WHEN {k} THEN {t}' for k, (_, t) in _SAY.items())} END AS message FROM events")
def p12_reasons(spark, d):
    reason = F.element_at(F.create_map(*(F.lit(x) for k, (r, _) in _SAY.items() for x in (k, r))), (F.col("event_id") % 11).cast("int"))
    return table(spark, d, "events").select("event_id", sessions.refusal_text(reason, F.col("event_id"), F.lit(500)).alias("message"))


@query("u8_timeline", """WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events), s AS (SELECT user_id, i * 40 AS a, i * 40 + 20 AS b FROM e WHERE event_type = 'view' AND value > 50)
    SELECT user_id, i, i * 40 AS pts_ms, EXISTS (SELECT 1 FROM s WHERE s.user_id = e.user_id AND e.i * 40 BETWEEN s.a - 50 AND s.b + 50) AS vad, (value > 30)::INT AS n_faces, CASE WHEN value > 30 THEN round_even(value, 1) END AS x0,
    CASE WHEN value > 30 AND event_type <> 'error' THEN round_even(value / 490, 4) END AS mar, CASE WHEN value > 30 THEN round_even(value / 500, 3) END AS det FROM e""")  # fmt: skip
def u8(spark, d):
    from pyspark.sql import Window

    e = table(spark, d, "events").withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long") - 1).withColumn("pts_ms", F.col("i") * 40)
    face = F.struct(F.array("value").alias("bbox"), F.when(F.col("event_type") != "error", F.col("value") / 490).alias("mar"), (F.col("value") / 500).alias("det_score"), (F.col("value") - 60).alias("yaw"))
    frames = e.where("value > 30").select("user_id", "pts_ms", F.array(face).alias("faces"))
    speech = e.where("event_type = 'view' and value > 50").select("user_id", F.col("pts_ms").alias("start_ms"), (F.col("pts_ms") + 20).alias("end_ms"))
    shown = sessions.display_frames(e.select("user_id", "i", "pts_ms"), frames, speech, "user_id")
    first = F.get("faces", F.lit(0))
    return shown.select("user_id", "i", "pts_ms", "vad", F.size("faces").alias("n_faces"), F.get(first["bbox"], F.lit(0)).alias("x0"), first["mar"].alias("mar"), first["det"].alias("det"))


@query("a17_notices", "SELECT user_id, CASE event_type WHEN 'error' THEN 'warning' ELSE 'drift_notice' END AS kind, count(*) AS n FROM events WHERE event_type IN ('error', 'purchase') GROUP BY ALL")
def a17_notices(spark, d):
    operation = F.when(F.col("event_type") == "error", "warning").when(F.col("event_type") == "purchase", "drift_notice").otherwise(F.col("event_type"))
    return sessions.notices(table(spark, d, "events").withColumn("operation", operation)).groupBy("user_id", "kind").agg(F.count("*").alias("n"))


@query("c13_activity_review", "SELECT event_id, 'near_zero_activity_manual_review' AS warning FROM events WHERE event_type <> 'error' AND value / 100 < 0.1")
def c13(spark, d):
    level = activity_level(F.when(F.col("event_type") != "error", F.col("value") / 100))
    return table(spark, d, "events").select("event_id", activity_review(level).alias("warning")).where("warning is not null")


@query("p19_utc_stamp", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS at FROM events")
def p19(spark, d):
    return table(spark, d, "events").select("event_id", utc_stamp(F.col("ts")).alias("at"))


@query("j19_hover", f"""SELECT b.id, (SELECT r.id FROM {spans_sql('error')} r WHERE r.key = b.key AND r.start_ms <= b.start_ms AND b.start_ms < r.end_ms ORDER BY r.start_ms, r.id LIMIT 1) AS hit FROM {spans_sql('click', 'purchase')} b""")
def j19(spark, d):
    points = spans(spark, d, "click", "purchase").select("key", "id", F.col("start_ms").alias("at"))
    over = spans(spark, d, "error").select("key", F.col("id").alias("span"), "start_ms", "end_ms")
    return pairing.hit_first(points, over, ["id"], "at", take="span").select("id", "hit")


@query("set3_concatenated", f"SELECT key, kind AS lane, start_ms, end_ms FROM {spans_sql('click')} UNION ALL SELECT key, 'merged', start_ms, end_ms FROM ({MERGED.format(src=spans_sql('view'))})")
def set3(spark, d):
    """Lanes of different make one after the other, repeats kept."""
    one = spans(spark, d, "click").select("key", F.col("kind").alias("lane"), "start_ms", "end_ms")
    return one.unionByName(isl.merge_intervals(spans(spark, d, "view"), ["key"]).withColumn("lane", F.lit("merged")))


_PARTS = f"({MERGED.format(src=spans_sql('view'))})"


@query("a9_contamination_totals", f"""WITH p AS {_PARTS}, r AS ({MERGED.format(src=spans_sql('error'))}), dd AS ({_DECIDED}),
    c AS (SELECT key, sum(end_ms - start_ms)::BIGINT AS high_ms FROM p GROUP BY 1),
    x AS (SELECT p.key, sum(least(p.end_ms, r.end_ms) - greatest(p.start_ms, r.start_ms))::BIGINT AS contaminated_ms FROM p JOIN r ON p.key = r.key AND p.start_ms < r.end_ms AND r.start_ms < p.end_ms GROUP BY 1),
    b AS (SELECT key, sum(gap_ms)::BIGINT AS bridged_ms, count(*) AS n_bridged FROM dd WHERE reason = 'bridged' GROUP BY 1)
    SELECT key, sum(high_ms)::BIGINT AS high_ms, sum(coalesce(contaminated_ms, 0))::BIGINT AS contaminated_ms, sum(high_ms - coalesce(contaminated_ms, 0))::BIGINT AS clean_ms, sum(coalesce(bridged_ms, 0))::BIGINT AS bridged_ms, sum(coalesce(n_bridged, 0))::BIGINT AS n_bridged
    FROM c LEFT JOIN x USING (key) LEFT JOIN b USING (key) GROUP BY ROLLUP (key)""")  # fmt: skip
def a9_totals(spark, d):
    """Per key, and as key null for all: run time, overlapped and clean time, bridged gaps."""
    parts, regions = isl.merge_intervals(spans(spark, d, "view"), ["key"]), isl.merge_intervals(spans(spark, d, "error"), ["key"])
    decisions = iv.bridge_decisions(parts, spans(spark, d, "error").select("key", "start_ms", "end_ms"), _evidence(spark, d), 2500)
    return sessions.contamination_totals(parts, regions, decisions, "key")
