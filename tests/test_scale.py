"""Exact sums, chunked scans, length classes, the enrollment course and checks, by brute force."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strandline.operators import enrollment, intervals, pairing, pools, scans, sums
from strandline.sources import clicks, media

# ---- exact sums


def adversarial(rng):
    xs = [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-1070, 1000) for _ in range(300)]
    xs += [1e308, 1e308, -1e308, -1e308, 5e-324, -5e-324, 2.0**-1022, 1.0, 1e100, 1.0, -1e100, 0.0, -0.0, 2.0**53, 1.0, 1.0, 2.0**-512, 2.0**1023, -(2.0**1023)]
    xs += [2.0**k for k in range(-1074, 1000, 16)] + [math.nextafter(2.0**k, 0) for k in range(-1000, 1000, 16)]
    rng.shuffle(xs)
    return xs


def test_exact_sums_equal_fsum_however_rows_are_dealt(spark):
    rng = random.Random(1)
    cases = {i: adversarial(rng) for i in range(6)} | {6: [0.1] * 1000, 7: [1e16, 1.0, -1e16], 8: [5e-324] * 3, 9: [0.0], 10: [-(2.0**-1074), 2.0**-1060, 1e-310]}
    rows = [(k, x) for k, xs in cases.items() for x in [*xs, None]] + [(11, None), (12, math.inf), (12, 1.0), (13, math.inf), (13, -math.inf), (14, math.nan), (14, 1.0), (15, 1.7e308), (15, 1.7e308)]
    rng.shuffle(rows)
    want = {k: float(sum(map(Fraction, xs))) for k, xs in cases.items()}
    assert all(math.fsum(xs) == want[k] for k, xs in cases.items() if k > 5)  # fsum itself may overflow on the way
    for parts in (1, 7):
        got = {r.k: r.total for r in sums.exact_sum(spark.createDataFrame(rows, "k int, x double").repartition(parts), ["k"], F.col("x")).collect()}
        assert {k: got[k] for k in want} == want
        assert 11 not in got and got[12] == math.inf and math.isnan(got[13]) and math.isnan(got[14]) and got[15] == math.inf


def test_vector_sums_by_fsum(spark):
    rng = random.Random(2)
    rows = [(i % 3, [rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12) for _ in range(4)], rng.randint(1, 9)) for i in range(200)] + [(1, None, 5)]
    for parts in (1, 6):
        df = spark.createDataFrame(rows, "k int, v array<double>, w int").repartition(parts)
        for r in sums.exact_vector_sum(df, ["k"], "v", F.col("w")).collect():
            own = [x for x in rows if x[0] == r.k and x[1]]
            assert r.weight_total == sum(w for _, _, w in own)
            assert r.total == [math.fsum(v[d] * w for _, v, w in own) for d in range(4)]
        for r in pools.weighted_mean(df, ["k"], "v", F.col("w")).collect():
            own = [x for x in rows if x[0] == r.k and x[1]]
            assert r["mean"] == [math.fsum(v[d] * w for _, v, w in own) / math.fsum(w for _, _, w in own) for d in range(4)]


@pytest.mark.parametrize("dims", [1, 2, 7])
def test_pair_variance_by_pairs(spark, dims, monkeypatch):
    monkeypatch.setattr(sums, "HELD", 2)
    rng = np.random.default_rng(dims)
    rows = [(int(i % 5), rng.normal(size=dims).tolist()) for i in range(60)] + [(7, [1.0] * dims), (8, [0.0] * dims), (8, [1.0] * dims), (8, None)]
    for r in pools.pair_variance(spark.createDataFrame(rows, "k int, v array<double>").repartition(4), ["k"], "v").collect():
        u = [np.array(v) / (np.linalg.norm(v) or 1) for k, v in rows if k == r.k and v]
        cosines = [float(a @ b) for i, a in enumerate(u) for b in u[:i]]
        assert r.n == len(u) and abs(r.variance - (np.var(cosines) if cosines else 0)) < 1e-9


# ---- chunked scans


@pytest.mark.parametrize("chunks", [1, 3, 40])
def test_scans_by_fold(spark, chunks):
    rng = random.Random(chunks)
    rows = []
    for key, n in ((1, 700), (2, 3), (None, 20), (4, 1), (5, 60)):
        at = 0
        for i in range(n):
            at += rng.choice([0, 1, 1, 3, 40, 900]) if key != 5 else 1
            rows.append((key, i, at, None if rng.random() < 0.05 and key != 4 else rng.uniform(-5, 5)))
    rows += [(6, i, None, None) for i in range(3)]
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "k int, i int, at long, x double").repartition(5)
    want = {}
    for key in {r[0] for r in rows}:
        ema = None
        for _, i, _, x in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            ema = None if x is None else x if ema is None else x / 3 + ema * 2 / 3
            want[key, i] = ema
    got = {(r.k, r.i): r.ema for r in scans.moving_average(df, ["k"], ["i"], "x", ["i"], chunks=chunks).collect()}
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (v is None) and (v is None or abs(got[k] - v) < 1e-9) for k, v in want.items())
    accepted = []
    for key in {r[0] for r in rows}:
        last = None
        for p in sorted({r[2] for r in rows if r[0] == key and r[2] is not None}):
            if last is None or p - last >= 50:
                accepted.append((key, p))
                last = p
    assert sorted(map(str, accepted)) == sorted(str((r.k, r.at)) for r in scans.greedy_spacing(df, ["k"], "at", 50, chunks=chunks).collect())


def test_a_hot_key_is_dealt_over_many_tasks(spark):
    df = spark.range(200_000).select(F.lit(1).alias("k"), F.col("id").alias("at"), (F.col("id") % 7).cast("double").alias("x"))
    sizes = [r["count"] for r in scans.ranged(df, ["k"], ["at"], 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 60_000
    assert scans.greedy_spacing(df, ["k"], "at", 2000, chunks=8).count() == 100


# ---- length classes


def spans_case(rng, n, longest):
    return [(rng.choice("ab"), i, s := rng.randint(-50_000, 400_000), s + int(rng.choice([0, 1, 300, 5000, longest]) * rng.random() + rng.choice([0, 1]))) for i in range(n)]


def overlaps(left, right):
    return sorted((x[1], y[1]) for x in left for y in right if x[0] == y[0] and x[2] < y[3] and y[2] < x[3])


@pytest.mark.parametrize("longest", [3000, 400_000, 40_000_000_000])
def test_interval_join_by_pairs(spark, longest):
    rng = random.Random(longest)
    left, right = spans_case(rng, 150, longest), spans_case(rng, 120, longest)
    frame = lambda rows: spark.createDataFrame([*rows, ("a", -1, None, 5), (None, -2, 0, 9)], "key string, id int, start_ms long, end_ms long")
    for bound in (None, max(longest, 5000) + 1):
        got = intervals.interval_join(frame(left), frame(right), longest_ms=bound).select("id", "r_id").collect()
        assert sorted((r.id, r.r_id) for r in got) == overlaps(left, right)
    assert intervals.interval_join(frame(left), frame([])).count() == 0


def test_a_long_span_takes_a_bounded_number_of_rows(spark):
    year = 365 * 86_400_000
    df = spark.createDataFrame([("a", 0, year), ("a", 5, 6), ("a", 7, 7000)], "key string, start_ms long, end_ms long")
    sizes = intervals._sizes(4000)
    there = intervals._present(df, "start_ms", "end_ms", sizes, None)
    for side in (0, 1):
        assert intervals._placed(df, "start_ms", "end_ms", sizes, there, side, "p").count() <= 3 * 2 * 4
    # with short spans alone a row takes its own buckets only
    short = df.where("end_ms < 4000")
    assert intervals._placed(short, "start_ms", "end_ms", sizes, intervals._present(short, "start_ms", "end_ms", sizes, None), 0, "p").count() == 1


# ---- the enrollment course


def test_course_by_fold(spark):
    rng = np.random.default_rng(9)
    target, other = rng.normal(size=6), rng.normal(size=6)
    windows, anti = [], []
    for batch in range(3):
        for video in range(6):
            for _ in range(int(rng.integers(0, 14))):
                v = target + rng.normal(size=6) * 0.5 + other * rng.uniform(0, 1.2)
                windows.append((batch, video, v.tolist(), int(rng.integers(1, 5)) * 1000, float(rng.uniform(0.3, 1)), int(rng.integers(0, 4)), 2, float(v @ target / np.linalg.norm(v) / np.linalg.norm(target))))
            for _ in range(int(rng.integers(0, 3)) if batch < 2 else 0):
                anti.append((batch, video, (other + rng.normal(size=6) * 1.6).tolist(), int(rng.integers(1, 5)) * 1000))
    q = enrollment.QualityParams(strong_ms=90_000, strong_without_anti_ms=120_000, marginal_ms=6000)
    bounds = dict(seed_min=0.5, anti_max=0.35, margin=0.15)

    def cos(a, b):
        return float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))

    def mean(rows, at):
        return np.average([r[at] for r in rows], axis=0, weights=[r[at + 1] for r in rows]) if rows else None

    def judge(w, profile):
        _, _, v, _, coverage, present, closed, seed = w
        if coverage < 0.5 or present > 0 and closed / present < 0.8:
            return "A"
        if seed < 0.5:
            return "B"
        s = None if profile is None else round(cos(v, profile), 6)
        return "C" if s is not None and (s > 0.35 or seed - s < 0.15) else None

    want, second = [], 0
    for batch in range(3):
        pool = []

        def look():
            ms = sum(w[3] for w in pool)
            cosines = [cos(a[2], b[2]) for i, a in enumerate(pool) for b in pool[:i]]
            var = float(np.var(cosines)) if cosines else 0.0
            return ms, var, q.state(ms, var, profile is not None)

        for video in range(6):
            own = [w for w in windows if w[:2] == (batch, video)]
            if not own and not [a for a in anti if a[:2] == (batch, video)]:
                continue
            before, profile = mean([a for a in anti if a[0] == batch and a[1] < video], 2), mean([a for a in anti if a[0] == batch and a[1] <= video], 2)
            good = [w for w in own if judge(w, before) is None]
            pool += good
            ms, var, first = look()
            again = [w for w in own if judge(w, before) == "C" and judge(w, profile) is None] if first == "MARGINAL" and profile is not None else []
            pool += again
            second += len(again)
            ms, var, state = look()
            sim = None if profile is None or not pool else cos(mean(pool, 2), profile)
            want.append((batch, video, len(good), len(again), ms, len(pool), var, sim, first, state))
    w = spark.createDataFrame(windows, "b int, f int, vector array<double>, duration_ms long, coverage double, present int, closed int, seed double").repartition(4)
    a = spark.createDataFrame(anti, "b int, f int, vector array<double>, duration_ms long").repartition(3)
    course = enrollment.enrollment_course(w, a, ["b"], "f", q, **bounds)
    got = sorted(map(tuple, course.collect()))
    assert len(got) == len(want) and second > 0 and {x[8] for x in want} >= {"INSUFFICIENT", "MARGINAL"}
    for x, y in zip(got, want):
        assert x[:6] == y[:6] and x[8:] == y[8:]
        assert abs(x[6] - y[6]) < 1e-9 and ((x[7] is None) == (y[7] is None)) and (y[7] is None or abs(x[7] - y[7]) < 1e-9)
    verdicts = {r.b: r.outcome for r in enrollment.batch_verdict(course, ["b"], "f").collect()}
    assert verdicts.keys() == {0, 1, 2}


# ---- checks hold whichever columns are read


def refused(df, *columns):
    for use in (lambda: df.count(), *(lambda c=c: df.select(c).collect() for c in columns)):
        with pytest.raises(PySparkException):
            use()


def test_checks_are_not_pruned(spark, tmp_path):
    from strandline.operators import sessions

    (tmp_path / "bad.json").write_text('{"anti_click": {}}')
    refused(clicks.read_clicks(spark, str(tmp_path)), "speaking", "path", "target_bearded")
    found, expected = spark.createDataFrame([("a",)], "path string"), spark.createDataFrame([("a", 1), ("b", 2)], "path string, n int")
    refused(clicks.present(expected, found), "n", "path")
    assert clicks.present(expected.limit(1), found).select("n").collect() == [(1,)]
    (tmp_path / "probe.json").write_text('{"streams": [{"codec_type": "video"}]}')
    refused(media.probes(spark, str(tmp_path / "probe.json")), "audio_start_ms", "path", "vfr_suspected")
    (tmp_path / "good.json").write_text('{"streams": [{"codec_type": "audio", "start_time": "0.5", "sample_rate": "8000"}]}')
    assert tuple(media.probes(spark, str(tmp_path / "good.json")).first())[1:] == (500, False, 8000, False)
    broken = spark.createDataFrame([(0, 0, "x", "y", "z", "w")], "s int, seq long, operation string, payload string, prev_sha256 string, entry_sha256 string")
    try:
        tail = sessions.resume_points(broken, ["s"])
    except PySparkException:
        return  # other columns are asked for
    refused(tail, "prev_sha256", "next_seq")


def test_best_match_refuses_many_candidates(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0])], "id int, v array<double>")
    many = spark.range(30).select(F.col("id").alias("name"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("c"))
    assert pools.best_match(v, "v", many, "name", "c", most=30).first().match == 0
    refused(pools.best_match(v, "v", many, "name", "c", most=29), "id", "match")


def test_speech_share_of_an_empty_window(spark):
    w = spark.createDataFrame([(1, 0, 5, 5), (2, 0, 0, 10)], "id int, f int, start_ms long, end_ms long")
    speech = spark.createDataFrame([(0, 0, 4)], "f int, start_ms long, end_ms long")
    assert {r.id: r.scored for r in pairing.speech_share(w, speech, ["id"], "f").collect()} == {1: False, 2: True}
