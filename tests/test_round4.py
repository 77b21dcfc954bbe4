"""Small cases of findings that larger tables brought up."""

import pytest
from pyspark.sql import functions as F

from strandline.operators import folds
from strandline.plans import queries as core
from strandline.plans.rule_queries import frames

from .compare import assert_same, duck

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def some_events(spark, tmp_path_factory):
    """The events of 60 users of sf0.1, among them one whose smoothed value meets a threshold exactly."""
    at = tmp_path_factory.mktemp("events")
    spark.read.parquet(f"{SF}/events.parquet").where("user_id between 1100 and 1159").coalesce(1).write.parquet(f"{at}/events.parquet")
    return str(at)


def _sql(at, text):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view events as select * from '{at}/events.parquet/*.parquet'")
    return con, text


def test_f4_speaking_windows_at_a_threshold(spark, some_events):
    assert_same(core.QUERIES["w14_speaking_windows"](spark, some_events), *_sql(some_events, core.ORACLES["w14_speaking_windows"]))


def test_f4_a_mean_that_lies_on_a_threshold():
    """SQL's x / 3 + old * 2 / 3, to the last bit, for every pair of four-place values on a grid."""
    frame = {"target_present": True, "target_suspended": False, "other_present": False, "other_mar": None, "vad": True}
    for a in range(0, 4000, 37):
        for b in range(0, 4000, 41):
            s, _ = folds.window_step(dict(folds.EMPTY), {**frame, "pts_ms": 0, "target_mar": a / 10_000})
            s, _ = folds.window_step(s, {**frame, "pts_ms": 100, "target_mar": b / 10_000})
            assert s["ema"] == b / 10_000 / 3 + a / 10_000 * 2 / 3


def test_f4_frames_are_rounded_as_in_sql(spark):
    want = "SELECT event_id, round(least(value, 100.0) / 250, 4) AS t, CASE WHEN event_id % 3 > 0 THEN round(0.3 - least(value, 100.0) / 400, 4) END AS o FROM events"
    con = duck(SF)
    have = sorted((r.key, r.pts_ms, r.target_mar, r.other_mar) for r in frames(spark, SF).where("key < 300").collect())
    order = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) * 100"
    assert have == sorted(con.execute(f"SELECT user_id, {order}, t, o FROM events JOIN ({want}) USING (event_id) WHERE user_id < 300").fetchall())


def test_f1_many_loose_files(spark):
    """More loose files than the 10,000 that were once allowed, and stems that lie within others."""
    from strandline.operators import pairing

    files = spark.range(11_000).select(F.col("id").alias("file_index"), F.concat(F.lit("in/s"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit(".mp4")).alias("source"))
    loose = files.select((11_000 - F.col("file_index")).alias("place"), F.concat(F.lit("loose/take "), F.regexp_extract("source", "(s.*)[.]", 1), F.lit(".wav")).alias("path"))
    got = pairing.located(files, files.limit(0).select(F.col("file_index").alias("place"), F.col("source").alias("path")), loose)
    assert got.where("wav = concat('loose/take s', lpad(file_index, 6, '0'), '.wav')").count() == 11_000


def test_f1_located_by_brute_force(spark):
    import random

    from strandline.operators import pairing

    rng = random.Random(5)
    word = lambda least: "".join(rng.choice("ab\u00e9\U0001F600") for _ in range(rng.randint(least, 5)))
    files = [(i, f"in/{word(1)}.mp4") for i in range(60)] + [(60, None), (61, "in/")]
    loose = [(rng.randrange(10_000), f"l/{word(0)}{i % 3 or ''}.wav") for i in range(80)] + [(10_001, None)]
    found = pairing.located(spark.createDataFrame(files, "file_index long, source string"), spark.createDataFrame([], "place long, path string"), spark.createDataFrame(loose, "place long, path string"))
    base = lambda p: p.split("/")[-1]
    stem = lambda p: base(p).rsplit(".", 1)[0] or base(p)
    for r in found.collect():
        fits = sorted((k, p) for k, p in loose if p is not None and r.source is not None and stem(r.source) in stem(p))
        assert r.wav == (fits[0][1] if fits else None), r


def test_f3_a_tree_of_six_levels_has_one_root(spark):
    """More files than five levels of eight hold: the levels go on to one root, which covers all of them."""
    import hashlib

    from strandline.operators import documents

    n = 8**5 + 9
    docs = spark.range(n).select(F.col("id").alias("file_index"), F.sha2(F.col("id").cast("string"), 256).alias("sha256"))
    rows = documents.digest_tree(docs, fanout=8).where("level >= 5").collect()
    level, want = 0, [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    while len(want) > 1:
        want, level = [hashlib.sha256("".join(want[i : i + 8]).encode()).hexdigest() for i in range(0, len(want), 8)], level + 1
    assert level == 6 and [(r.position, r.children, r.sha256) for r in rows if r.level == 6] == [(0, 2, want[0])] and len(rows) == 3


def test_f2_the_driver_moves_and_lists_folders(spark, tmp_path):
    """Files in folders of about `bytes`, one of them larger; records with the samples, of an empty file too; nothing left by a failed write."""
    import random

    from pyspark.errors import PySparkException

    from strandline.sources.wav import WavReader, WavSource

    spark.dataSource.register(WavSource)
    rng = random.Random(7)
    pcm = {f"s{i}": rng.randbytes(2 * n) for i, n in enumerate([0, 1, 7, 60_000] + [100] * 300)}
    rows = spark.createDataFrame([(k, v, f'{{"of":"{k}"}}') for k, v in pcm.items()], "name string, pcm binary, record string").repartition(3, "name")
    at = str(tmp_path / "out")
    rows.write.format("wav").option("folders", True).option("bytes", 10_000).mode("append").save(at)
    folders = list((tmp_path / "out").iterdir())
    assert all(p.name.startswith("part-") for p in folders) and 7 < len(folders) < 30
    parts = WavReader({"path": at, "bytes": "10000"}).partitions()
    assert sum(len(p.shares) for p in parts) < 100 and sum(len(p.folders) for p in parts) == len(folders) - 1
    got, said = {}, {}
    for r in spark.read.format("wav").option("bytes", 10_000).option("samples", 1999).option("records", True).load(at).collect():
        name = r.path.split("/")[-1][:-4]
        got.setdefault(name, {})[r.first_sample] = bytes(r.pcm)
        if r.record is not None:
            assert name not in said
            said[name] = r.record
    assert {k: b"".join(v for _, v in sorted(x.items())) for k, x in got.items()} == pcm
    assert said == {k: f'{{"of":"{k}"}}' for k in pcm}
    with pytest.raises(PySparkException):
        rows.unionByName(rows).repartition(2, "name").write.format("wav").option("folders", True).mode("append").save(str(tmp_path / "bad"))
    assert list((tmp_path / "bad").iterdir()) == []


def test_f5_the_stream_at_a_threshold(spark, some_events):
    assert_same(core.QUERIES["s_speaking_stream"](spark, some_events), *_sql(some_events, core.ORACLES["s_speaking_stream"]))


def test_f5_one_read_and_one_write_of_state_a_call():
    """The stream's machine over shuffled frames of one key finds the fold's windows, and a call reads and writes the key's state once, however many frames it has."""
    import random

    from pyspark.sql import Row

    from strandline.streaming import windows as st

    calls, timers, held = [], set(), []

    class Handle:
        def getValueState(self, name, schema):
            return self

        def get(self):
            calls.append("get")
            return held[0] if held else None

        def update(self, value):
            calls.append("update")
            held[:] = [value]

        def clear(self):
            calls.append("clear")
            held.clear()

        registerTimer, deleteTimer = staticmethod(timers.add), staticmethod(timers.remove)

    class Now:
        def __init__(self, at):
            self.getCurrentWatermarkInMs = lambda: at

    rng = random.Random(3)
    row = Row("key", *st.FRAME)
    frames = [row(7, 100 * i, rng.random() < 0.9, rng.random() / 3, rng.random() < 0.1, rng.random() < 0.3, rng.choice([None, 0.05, 0.2]), rng.random() < 0.8) for i in range(500)]
    state, want = dict(folds.EMPTY), []
    for f in frames:
        state, done = folds.window_step(state, f.asDict())
        want += done
    want += folds.window_finish(state)
    machine, got, now = st.SpeakingWindows(60_000), [], 0
    machine.init(Handle())
    for i in range(0, 500, 50):
        got += machine.handleInputRows((7,), iter(rng.sample(frames[i : i + 50], 50)), Now(now))
        assert len(calls) <= 2 and len(timers) == 1, calls
        calls.clear()
        now = 100 * (i + 50) - 3000
    got += machine.handleExpiredTimer((7,), Now(200_000), None)
    assert len(calls) <= 2 and not timers and not held
    assert len(want) > 5 and [tuple(r) for r in got] == [(7, *w) for w in want]
