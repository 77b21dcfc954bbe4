"""Click sessions against a loop, click documents, resumption, missing files, texts."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import audit, pools, sessions
from strandline.sources import clicks


def brute(rows):
    bearded, seeds, anti, out = False, [], None, []
    for i, action, flag in rows:
        reason = None
        if action == "beard" and flag != bearded:
            bearded, seeds, anti = flag, [], None
        elif action == "speaking":
            seeds, anti = ([*seeds, i] if bearded else [i]), None
        elif action == "anti" and not seeds:
            reason = "speaking_click_required_first"
        elif action == "anti":
            anti = i
        elif action == "clear_speaking":
            seeds, anti = [], None
        elif action == "clear_anti":
            anti = None
        out.append((i, bearded, len(seeds), seeds[0] if seeds else None, anti, reason))
    return out


def test_session_states(spark):
    rng = random.Random(5)
    data, want = [], []
    for k in range(20):
        rows = [(i, rng.choice(["speaking", "speaking", "anti", "anti", "clear_speaking", "clear_anti", "beard"]), rng.random() < 0.5) for i in range(60)]
        data += [(k, *r) for r in rows]
        want += [(k, *r) for r in brute(rows)]
    df = spark.createDataFrame(data, "k int, event_id int, action string, target_flag boolean")
    got = sessions.session_states(df, ["k"], ["event_id"]).select("k", "event_id", "target_bearded", "seeds", "speaking_id", "anti_id", "reason")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == want


def test_clicks(spark, tmp_path):
    good = '{"speaking_click": {"file_index": 0, "pts_ms": 41250, "x": 812, "y": 440.5}, "anti_click": {}, "speaking_clicks": [{"file_index": 0, "pts_ms": 5, "x": 1, "y": 2}]}'
    docs = [(0, good), (1, good.replace("41250", "true")), (2, good.replace("41250", "4.5")), (3, "{}"), (4, "x"), (5, good[:-1] + ', "target_bearded": 1}'), (6, good.replace('"pts_ms": 5', '"pts_ms": "5"')), (7, None)]
    got = {r.i: r.c for r in spark.createDataFrame(docs, "i int, t string").select("i", clicks.parse_clicks(F.col("t")).alias("c")).collect()}
    assert got[0].error is None and got[0].speaking.pts_ms == 41250 and got[0].anti is None and got[0].extra_seeds[0].y == 2.0
    assert all(got[i].error for i in range(1, 8))
    (tmp_path / "clicks.json").write_text(good)
    assert clicks.read_clicks(spark, str(tmp_path)).first().speaking.x == 812.0
    (tmp_path / "other.json").write_text("{}")
    with pytest.raises(Exception, match="mandatory"):
        clicks.read_clicks(spark, str(tmp_path)).collect()


def test_videos(spark, tmp_path):
    for n in ("b.mp4", "a.mov", "c.txt"):
        (tmp_path / n).write_bytes(b"12")
    found = clicks.discover_videos(spark, str(tmp_path))
    assert [r.path.rsplit("/", 1)[1] for r in found.collect()] == ["a.mov", "b.mp4"]
    assert clicks.present(found.select("path"), found).count() == 2
    with pytest.raises(Exception, match="missing file"):
        clicks.present(spark.createDataFrame([("zzz",)], "path string"), found).collect()


def test_resume(spark):
    log = spark.createDataFrame([(0, i, "warning" if i == 1 else "x", f"{{{i}}}") for i in range(4)], "s int, seq long, operation string, payload string")
    log = log.withColumn("payload_sha256", F.sha2("payload", 256))
    linked = log.join(audit.chain(log, ["s"]), ["s", "seq"])
    last = linked.where("seq = 3").first().entry_sha256
    assert tuple(sessions.resume_points(linked, ["s"]).first()) == (0, 4, last)
    forged = linked.withColumn("payload", F.when(F.col("seq") == 1, "no").otherwise(F.col("payload")))
    assert sessions.resume_points(forged, ["s"], verified=False).first().next_seq == 4
    with pytest.raises(Exception, match="breaks at seq 1"):
        sessions.resume_points(forged, ["s"]).collect()
    both = sessions.starts(spark.createDataFrame([(0,), (1,)], "s int"), sessions.resume_points(linked, ["s"]), ["s"]).collect()
    assert {r.s: r.next_seq for r in both} == {0: 4, 1: 0}
    assert sessions.notices(linked).count() == 1


def test_texts_and_timeline(spark):
    row = spark.sql("select array(named_struct('start_ms', 1L, 'end_ms', 5L)) as r, cast(array() as array<struct<start_ms: bigint, end_ms: bigint>>) as e, array(named_struct('bbox', array(1.26D), 'mar', cast(null as double), 'det_score', 0.12345D, 'yaw', 3.14D)) as faces, cast(null as boolean) as vad")
    got = row.select(sessions.excluded_text(F.col("r")), sessions.clean_text(F.lit(900), F.lit(1), F.col("e")), sessions.refusal_text(F.lit("seed_too_short"), F.lit(None), F.lit(3000))).first()
    assert got[0] == "EXCLUDED: simultaneous speech in 1-5 ms" and "bridged" not in got[1] and got[2].startswith("The speaking window lasts ? ms")
    face = sessions.timeline(row).first()
    assert face.vad is False and tuple(face.faces[0]) == ([1.3], None, 0.123, 3.1)


def test_window_vectors(spark):
    rows = [(1, 0, 60_000, [1.0, 0.0]), (1, 58_000, 78_000, [0.0, 1.0]), (2, 0, 5_000, [0.3, 0.4]), (None, 0, 1_000, [2.0, 0.0]), (None, 0, 1_000, [2.0, 0.0])]
    chunks = spark.createDataFrame(rows, "w int, start_ms long, end_ms long, v array<double>")
    got = {r.w: r for r in pools.window_vectors(chunks, ["w"], "v").collect()}
    assert (got[1].n_chunks, got[1].duration_ms) == (2, 78_000)
    assert got[1].vector == pytest.approx([3 / 10**0.5, 1 / 10**0.5])
    assert got[2].vector == [0.3, 0.4]
    assert got[None].vector == pytest.approx([1.0, 0.0])
    assert pools.window_vectors(chunks.where("false"), ["w"], "v").count() == 0
    with pytest.raises(Exception, match="total duration"):
        pools.window_vectors(chunks.withColumn("end_ms", chunks.start_ms), ["w"], "v").collect()
