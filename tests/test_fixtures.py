"""Golden vectors, hand-computed cases and property tests of the operators."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strandline.functions import rules, vectors
from strandline.operators import audit, folds, intervals, islands, pools, tracking
from strandline.sources import media


def segments(spark, flags):
    df = spark.createDataFrame([(0, i, 0.9 if f else 0.0) for i, f in enumerate(flags)], "key int, idx long, prob double")
    return sorted((r.start_ms, r.end_ms) for r in islands.segments_from_probabilities(df, ["key"], "idx", "prob").collect())


@pytest.mark.parametrize("flags, want", [
    ([1] * 10 + [0] * 10, [(0, 350)]),
    ([1] * 5 + [0] * 15, []),
    ([1] * 8 + [0] * 2 + [1] * 8 + [0] * 2, [(0, 606)]),
    ([1] * 8 + [0] * 4 + [1] * 8, [(0, 286), (354, 640)]),
])
def test_segments(spark, flags, want):
    assert segments(spark, flags) == want


def fold_segments(flags, p=islands.SegmentParams()):
    """The sequential rules, for comparison."""
    at = lambda n: n * p.window_samples * 1000 // p.sample_rate
    runs, i = [], 0
    while i < len(flags):
        if flags[i]:
            j = i
            while j < len(flags) and flags[j]:
                j += 1
            runs.append([at(i), at(j)])
            i = j
        else:
            i += 1
    merged = []
    for a, b in runs:
        if merged and a - merged[-1][1] < p.min_silence_ms:
            merged[-1][1] = b
        else:
            merged.append([a, b])
    out = []
    for a, b in merged:
        if b - a >= p.min_speech_ms:
            a, b = max(a - p.pad_ms, 0), min(b + p.pad_ms, at(len(flags)))
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
    return [tuple(x) for x in out]


def test_segments_equal_fold(spark):
    rng = random.Random(4)
    cases = [[rng.random() < 0.7 for _ in range(rng.randint(1, 120))] for _ in range(60)]
    df = spark.createDataFrame([(k, i, 1.0 if f else 0.0) for k, c in enumerate(cases) for i, f in enumerate(c)], "key int, idx long, prob double")
    got = {}
    for r in islands.segments_from_probabilities(df, ["key"], "idx", "prob").collect():
        got.setdefault(r.key, []).append((r.start_ms, r.end_ms))
    for k, c in enumerate(cases):
        assert sorted(got.get(k, [])) == fold_segments(c)


def test_clocks(spark):
    df = spark.createDataFrame([(511, "2.0005"), (16, "2.0015"), (0, "0.023220")], "n long, s string")
    got = df.select(rules.ms_from_samples(F.col("n")).alias("a"), rules.half_even_ms(F.col("s").cast("decimal(28,9)")).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(31, 2000), (1, 2002), (0, 23)]


def test_probe(spark):
    video = '{{"codec_type":"video","avg_frame_rate":"30000/1001","r_frame_rate":"{}"}}'
    rows = [(f'{{"streams":[{video.format("30/1")},{{"codec_type":"audio","start_time":"N/A","sample_rate":"48000"}}]}}',), (f'{{"streams":[{video.format("60000/2002")},{{"codec_type":"audio","start_time":"0.023220"}}]}}',)]
    got = spark.createDataFrame(rows, "t string").select(media.parse_probe(F.col("t")).alias("p")).select("p.*").collect()
    assert tuple(got[0]) == (0, True, 48000, True, None)
    assert tuple(got[1]) == (23, False, None, False, None)


def merged(spark, rows):
    df = spark.createDataFrame([(0, a, b) for a, b in rows], "key int, start_ms long, end_ms long")
    return sorted((r.start_ms, r.end_ms) for r in islands.merge_intervals(df, ["key"]).collect())


def test_merge(spark):
    assert merged(spark, [(5, 10), (0, 6), (20, 30), (30, 35)]) == [(0, 10), (20, 35)]
    assert merged(spark, [(5, 5), (3, 2)]) == []


def test_interval_join_equals_theta(spark):
    rng = random.Random(9)
    make = lambda n: [(rng.randint(0, 2), i, s := rng.randint(0, 30_000), s + rng.choice([0, 1, 50, 900, 9000])) for i in range(n)]
    left, right = make(120), make(150)
    schema = "key int, id int, start_ms long, end_ms long"
    pairs = intervals.interval_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), bucket_ms=700)
    got = sorted((r.id, r.r_id) for r in pairs.collect())
    assert got == sorted((a[1], b[1]) for a in left for b in right if a[0] == b[0] and a[2] < b[3] and b[2] < a[3])


def test_near(spark):
    p = spark.createDataFrame([(0, x) for x in (90, 240, 49, 500, 50)], "key int, at long")
    s = spark.createDataFrame([(0, 100, 200), (0, 300, 400)], "key int, start_ms long, end_ms long")
    assert {r.at: r.near for r in intervals.near(p, s, ["at"], "at", 50).collect()} == {90: True, 240: True, 49: False, 500: False, 50: True}


def test_asof_ties(spark):
    left = spark.createDataFrame([(0, 10), (0, 25), (1, 5), (2, 7)], "key int, at long")
    right = spark.createDataFrame([(0, 5, "a"), (0, 15, "b"), (0, 15, "c"), (1, 900, "d")], "key int, r long, tag string")
    got = {(r.key, r.at): (r.r, r.tag) for r in intervals.asof_nearest(left, right, "key", "at", "r", ["tag"], within=200).collect()}
    assert got == {(0, 10): (5, "a"), (0, 25): (15, "b"), (1, 5): (None, None), (2, 7): (None, None)}


@pytest.mark.parametrize("parts, regions, evidence, want", [
    ([(7000, 9000), (9300, 11000)], [], [], "bridged"),
    ([(7000, 9000), (9400, 11000)], [], [], "gap_too_long"),
    ([(7000, 9000), (9300, 11000)], [(9100, 9200)], [], "overlap_in_gap"),
    ([(7000, 9000), (9300, 11000)], [(9300, 9400)], [], "bridged"),
    ([(7000, 9000), (9300, 11000)], [], [(9000, 10000)], "interviewer_evidence_in_gap"),
])
def test_bridge(spark, parts, regions, evidence, want):
    make = lambda rows: spark.createDataFrame([(0, a, b) for a, b in rows], "key int, start_ms long, end_ms long")
    p = make(parts)
    d = intervals.bridge_decisions(p, make(regions), make(evidence))
    assert [r.reason for r in d.collect()] == [want]
    out = sorted((r.start_ms, r.end_ms) for r in intervals.bridge(p, d).collect())
    assert out == ([(7000, 11000)] if want == "bridged" else parts)


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0, 9.0]), ([0.0, 0.0], [1.0, 1.0, 0.0])], "a array<double>, b array<double>")
    got = df.select(vectors.normalize(F.col("a")).alias("n"), vectors.cosine(F.col("a"), F.slice("b", 1, 2)).alias("c")).collect()
    assert got[0].n == pytest.approx([0.6, 0.8]) and got[0].c == pytest.approx(0.6)
    assert got[1].n == [0.0, 0.0] and got[1].c == 0.0


def test_pools(spark):
    pool = spark.createDataFrame([(0, 0, [1.0, 0.0], 1000), (0, 1, [1.0, 0.0], 1000), (0, 2, [0.0, 1.0], 1000), (1, 3, [1.0, 0.0], 500)], "p int, i int, v array<double>, d long")
    mean = pools.weighted_mean(spark.createDataFrame([([1.0, 0.0], 1000), ([0.0, 1.0], 3000)], "v array<double>, d long"), [], "v", F.col("d")).first()[0]
    assert mean == pytest.approx([0.25, 0.75])
    loo = {r.i: r.loo for r in pools.leave_one_out(pool, ["p"], "v", "d").collect()}
    assert loo[0] == pytest.approx(math.sqrt(0.5)) and 3 not in loo
    var = {r.p: r.variance for r in pools.pair_variance(pool, ["p"], "v").collect()}
    assert var[0] == pytest.approx(2 / 9) and var[1] == 0.0


@pytest.mark.parametrize("genuine, impostor, anti, want", [
    ([0.58 + 0.02 * i for i in range(10)], [0.2, 0.3], True, (0.598, "DERIVED", False)),
    ([0.3] * 10, [0.2], True, (0.45, "DERIVED", False)),
    ([0.9] * 10, [0.85], True, (0.75, "DERIVED", True)),
    ([0.5] * 10, [], False, (0.55, "DERIVED_NO_ANTI", False)),
    ([0.9] * 5, [0.2], True, (0.60, "FALLBACK_DEFAULTS", False)),
    ([], [], False, (0.60, "FALLBACK_DEFAULTS", False)),
])
def test_calibration(spark, genuine, impostor, anti, want):
    make = lambda xs: spark.createDataFrame([(x,) for x in xs], "s double")
    r = pools.calibrate(make(genuine), make(impostor), anti=anti).first()
    assert (round(r.theta_high, 6), r.calibration, r.calibration_overlap) == want


def test_tiers(spark):
    rows = [(0.8, 0.2), (0.8, 0.7), (0.5, 0.2), (0.3, 0.2), (0.1, 0.2), (0.8, None), (None, None)]
    df = spark.createDataFrame(rows, "t double, o double").withColumn("h", F.lit(0.62)).withColumn("m", F.lit(0.47))
    tier = lambda anti: [tuple(r.x) for r in df.select(rules.tier(F.col("t"), F.col("o"), F.col("h"), F.col("m"), anti=anti).alias("x")).collect()]
    assert tier(True) == [("HIGH", False), ("MEDIUM", True), ("MEDIUM", False), ("SUB", False), ("REJECT", False), ("MEDIUM", True), ("SKIPPED", False)]
    assert tier(False)[5] == ("HIGH", False)


def test_windows_and_chunks(spark):
    files = spark.createDataFrame([(0, 10_000), (1, 4_000), (2, 5_000), (3, 0)], "file_index int, duration_ms long")
    got = {}
    for r in tracking.plan_windows(files).collect():
        got.setdefault(r.file_index, []).append((r.ws, r.we))
    assert sorted(got[0]) == [(i * 1000, i * 1000 + 5000) for i in range(6)] and got[1] == [(0, 4000)] and got[2] == [(0, 5000)] and 3 not in got
    items = spark.createDataFrame([(45_000,), (130_000,), (121_000,)], "duration_ms long")
    got = sorted((r.duration_ms, r.start_ms, r.end_ms) for r in tracking.plan_chunks(items).collect())
    assert got == [(45_000, 0, 45_000), (121_000, 0, 60_000), (121_000, 58_000, 118_000), (121_000, 116_000, 121_000), (130_000, 0, 60_000), (130_000, 58_000, 118_000), (130_000, 116_000, 130_000)]


@pytest.mark.parametrize("first, last, want", [
    (7250, 12000, (7250, 12000, False, False, True)),
    (8000, 12000, (8000, 12000, True, False, True)),
    (None, None, (8000, 11000, True, True, True)),
])
def test_edges(spark, first, last, want):
    runs = spark.createDataFrame([(0, 7000, 12000)], "file_index int, start_ms long, end_ms long")
    fine = [(0, 7000, True, p, first is not None and p >= first) for p in range(5000, 9001, 250)] + [(0, 7000, False, p, last is not None and p <= last) for p in range(10000, 14001, 250)]
    r = tracking.refine_edges(runs, spark.createDataFrame(fine, "file_index int, start_ms long, leading boolean, p long, passes boolean")).first()
    assert (r.new_start_ms, r.new_end_ms, r.lead_demoted, r.trail_demoted, r.survives) == want


def test_single_block_with_failing_tail(spark):
    runs = spark.createDataFrame([(0, 7000, 8000)], "file_index int, start_ms long, end_ms long")
    fine = spark.createDataFrame([(0, 7000, True, 7000, True)], "file_index int, start_ms long, leading boolean, p long, passes boolean")
    r = tracking.refine_edges(runs, fine).first()
    assert (r.new_start_ms, r.new_end_ms, r.trail_demoted, r.survives) == (7000, 8000, False, True)


@pytest.mark.parametrize("row, want", [
    ((0.8, 10, 9, 0.8, 0.2, True), (True, None)), ((0.3, 10, 9, 0.8, 0.2, True), (False, "A")), ((0.8, 10, 5, 0.8, 0.2, True), (False, "A")), ((0.8, 10, 9, 0.6, 0.2, True), (False, "B")),
    ((0.8, 10, 9, 0.8, 0.6, True), (False, "C")), ((0.8, 10, 9, 0.8, None, True), (False, "C")), ((0.8, 0, 0, 0.8, None, False), (True, None)), ((0.5, 10, 8, 0.7, 0.5, True), (True, None)),
])
def test_gate(spark, row, want):
    df = spark.createDataFrame([row], "c double, p int, l int, s double, a double, h boolean")
    g = df.select(rules.triple_gate(*(F.col(c) for c in "cplsah")).alias("g")).first().g
    assert (g.accepted, g.gate) == want


@pytest.mark.parametrize("row, want", [((50000, 0.01, True), "STRONG"), ((50000, 0.10, True), "MARGINAL"), ((30000, 0.01, True), "MARGINAL"), ((10000, 0.01, True), "INSUFFICIENT"), ((50000, 0.01, False), "MARGINAL"), ((65000, 0.01, False), "STRONG")])
def test_quality(spark, row, want):
    df = spark.createDataFrame([row], "m long, v double, a boolean")
    assert df.select(rules.quality_state(F.col("m"), F.col("v"), F.col("a"))).first()[0] == want


def frame(pts, mar=0.3, present=True, suspended=False, other=False, other_mar=None, vad=True):
    return {"pts_ms": pts, "target_present": present, "target_mar": mar, "target_suspended": suspended, "other_present": other, "other_mar": other_mar, "vad": vad}


def run_machine(frames):
    s, out = dict(folds.EMPTY), []
    for f in frames:
        s, done = folds.window_step(s, f)
        out += done
    return out + folds.window_finish(s)


def test_machine_expiry_at_deadline():
    speak = [frame(t) for t in range(0, 100, 10)]
    silent = [frame(t, mar=0.0, vad=False) for t in range(100, 800, 10)]
    assert run_machine(speak + silent)[0][:3] == (0, 600, "plosive_expiry")


def test_machine_suspension_moves_the_deadline():
    speak = [frame(t) for t in range(0, 100, 10)]
    hold = [frame(100, vad=False)] + [frame(t, suspended=True, vad=False) for t in range(110, 220, 10)] + [frame(t, vad=False) for t in range(220, 1000, 10)]
    assert run_machine(speak + hold)[0][:3] == (0, 100 + 500 + 110, "plosive_expiry")


def test_machine_interjection_and_end():
    speak = [frame(t) for t in range(0, 50, 10)]
    assert run_machine(speak + [frame(50, vad=False), frame(60, vad=False, other=True, other_mar=0.4)])[0][:3] == (0, 60, "interviewer_interjection")
    assert run_machine(speak)[0][:3] == (0, 40, "end_of_video")
    closed = run_machine([frame(t, other=True, other_mar=0.05) for t in range(0, 100, 10)])[0]
    assert closed[4:] == (10, 10)


def test_chain_detects_change_and_truncation(spark):
    rows = [(0, i, "layer2_block" if i < 4 else "done", f'{{"tier":"HIGH","n":{i}}}') for i in range(5)]
    log = spark.createDataFrame(rows, "s int, seq long, operation string, payload string").withColumn("payload_sha256", F.sha2("payload", 256))
    linked = log.join(audit.chain(log, ["s"]), ["s", "seq"])
    good = audit.verify(linked, ["s"], "done").first()
    assert (good.entries, good.first_bad, good.complete) == (5, None, True)
    forged = linked.withColumn("payload", F.when(F.col("seq") == 2, F.replace("payload", F.lit("HIGH"), F.lit("MEGA"))).otherwise(F.col("payload")))
    assert audit.verify(forged, ["s"], "done").first().first_bad == 2
    cut = audit.verify(linked.where("seq < 4"), ["s"], "done").first()
    assert cut.first_bad is None and not cut.complete


def test_time_fields_and_canonical():
    from pyspark.sql.types import StructType

    assert audit.time_fields_ok(StructType.fromDDL("a_ms double, b struct<c_ms: bigint, d: array<struct<e_ms: string>>>")) == ["a_ms", "b.d[].e_ms"]
    assert audit.canonical_json({"b": None, "a": 1e-7}) == '{"a":1e-07,"b":null}'
    with pytest.raises(ValueError):
        audit.canonical_json({"x": float("nan")})


def test_registry(spark):
    make = lambda rows: spark.createDataFrame(rows, "path string, sha256 string")
    got = audit.registry_difference(make([("a", "1"), ("b", "2"), ("c", "3")]), make([("a", "1"), ("b", "9"), ("d", "4")])).collect()
    assert sorted(map(tuple, got)) == [("b", "mismatched"), ("c", "missing"), ("d", "unexpected")]


def test_wav_and_slice(spark, tmp_path):
    pcm = bytes(range(256)) * 250
    (tmp_path / "x.wav").write_bytes(media.wav_bytes(pcm))
    wav = media.read_wav(spark, str(tmp_path))
    row = wav.first()
    assert row.n_samples == 32_000 and bytes(row.pcm) == pcm
    cut = lambda a, b: wav.select(media.pcm_slice(F.col("pcm"), F.lit(23), F.lit(a), F.lit(b)).alias("s")).first().s
    assert len(cut(1023, 1523)) == 16_000 and len(cut(0, 50)) == 864


def test_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    media.write_log(spark.createDataFrame([(0, "a", None), (1, "b", "x")], "seq long, operation string, reason string"), path)
    assert sorted(map(tuple, media.read_log(spark, path, "seq long, operation string, reason string").collect())) == [(0, "a", None), (1, "b", "x")]


def test_empty_tables(spark):
    e = spark.createDataFrame([], "key int, start_ms long, end_ms long")
    assert islands.merge_intervals(e, ["key"]).count() == 0 and intervals.interval_join(e, e).count() == 0
    assert folds.speaking_windows(spark.createDataFrame([], "key int, pts_ms long, target_present boolean, target_mar double, target_suspended boolean, other_present boolean, other_mar double, vad boolean"), ["key"]).count() == 0


def test_partition_count_does_not_matter(spark):
    from strandline.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append([sorted(map(str, QUERIES[q](spark, sf).collect())) for q in ("w14_speaking_windows", "w20_chain", "w6_bridge", "c5_tier_blocks")])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]
