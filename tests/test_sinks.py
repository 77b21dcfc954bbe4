"""The log sink, WAV source and writer, documents, frame scan and result cache."""

import hashlib
import json
import random
import wave

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strandline.operators import audit, documents, folds
from strandline.operators import frames as fr
from strandline.sources.cache import ResultCache
from strandline.sources.media import wav_bytes
from strandline.sources.wav import WavSource
from strandline.streaming import windows as st
from strandline.streaming.log_sink import LeaseHeld, LogSink, worker_digests, write_worker_log

# ---- log


def entries(spark, rows):
    return spark.createDataFrame([(s, f, a, op, json.dumps({"n": n})) for s, f, a, op, n in rows], "s int, file_index int, start_ms long, operation string, payload string")


def check_chain(got):
    """The rule of the chain, entry by entry."""
    by = {}
    for e in sorted(got, key=lambda e: (e.s, e.seq)):
        seq, prev = by.get(e.s, (0, audit.GENESIS))
        payload = hashlib.sha256(e.payload.encode()).hexdigest()
        assert (e.seq, e.prev_sha256) == (seq, prev)
        assert e.entry_sha256 == hashlib.sha256(f"{seq}|{e.operation}|{payload}|{prev}".encode()).hexdigest()
        by[e.s] = (seq + 1, e.entry_sha256)
    return {s: n for s, (n, _) in by.items()}


def test_replayed_and_cut_off_batches_leave_one_chain(spark, tmp_path):
    sink = LogSink(spark, str(tmp_path), ["s"], "a")
    batches = [entries(spark, [(s, i % 2, 100 - i, "op", 10 * b + i) for s in range(1 + b % 3) for i in range(4)]) for b in range(4)]
    for b in (0, 1):
        sink.write(batches[b], b)
    before = sink.entries().collect()
    sink.write(batches[1], 1)
    sink.write(batches[0], 0)  # replays
    assert sorted(sink.entries().collect()) == sorted(before)
    # a batch that was cut off after its entries: no commit, so it doesn't count and is written again
    sink._create("commits-not/2")
    entries(spark, [(0, 0, 0, "half", 1)]).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/entries/batch=2")
    assert len(sink.entries().collect()) == len(before)
    sink.write(batches[2], 2)
    LogSink(spark, str(tmp_path), ["s"], "a").write(batches[3], 3)  # resumed by a new process of the same run
    assert check_chain(sink.entries().collect()) == {0: 16, 1: 8, 2: 4}
    assert {r.s: (r.next_seq, r.batch) for r in sink.heads().collect()} == {0: (16, 3), 1: (8, 3), 2: (4, 3)}
    with pytest.raises(ValueError):
        LogSink(spark, str(tmp_path / "none"), ["s"], "a").entries()


def test_one_writer(spark, tmp_path):
    a, b = (LogSink(spark, str(tmp_path), ["s"], r) for r in "ab")
    a.lease()
    a.lease()
    with pytest.raises(LeaseHeld):
        b.write(entries(spark, [(0, 0, 0, "op", 1)]), 0)
    b.release()  # not its own
    with pytest.raises(LeaseHeld):
        b.lease()
    LogSink(spark, str(tmp_path), ["s"], "b", lease_ms=0).lease()  # an old lease is taken over
    with pytest.raises(LeaseHeld):
        a.lease()
    b.release()
    a.lease()


def test_worker_logs(spark, tmp_path):
    rows = [(f, "op", f'{{"n":{n}}}', n) for f in (0, 1) for n in range(5)]
    df = lambda rs: spark.createDataFrame(rs, "file_index int, operation string, payload string, start_ms long")
    write_worker_log(df(rows), str(tmp_path), "r1")
    with pytest.raises(PySparkException):
        write_worker_log(df(rows), str(tmp_path), "r1")
    back = spark.read.schema("file_index int, operation string, payload string, start_ms long").json(f"{tmp_path}/run=r1")
    one, two = (sorted(map(tuple, worker_digests(x).collect())) for x in (back, df(rows[::-1]).repartition(3)))
    assert one == two and [r[:2] for r in one] == [(0, 5), (1, 5)]


# ---- WAV


@pytest.fixture(scope="module")
def wav(spark):
    spark.dataSource.register(WavSource)
    return spark


def test_wav_round_trip_by_ranges(wav, tmp_path):
    rng = random.Random(3)
    pcm = {f"s{i}": rng.randbytes(2 * n) for i, n in enumerate((0, 1, 7, 5000, 123_457))}
    wav.createDataFrame([(k, v, f'{{"of":"{k}"}}', 1) for k, v in pcm.items()], "name string, pcm binary, record string, more int").repartition(3).write.format("wav").mode("append").save(str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(f"{k}.{e}" for k in pcm for e in ("wav", "json"))
    with wave.open(str(tmp_path / "s3.wav")) as f:
        assert (f.getnchannels(), f.getsampwidth(), f.getframerate(), f.readframes(5000)) == (1, 2, 16_000, pcm["s3"])
    df = wav.read.format("wav").option("bytes", 10_000).option("samples", 1999).load(str(tmp_path))
    assert df.rdd.getNumPartitions() >= 25
    parts = {}
    for r in df.collect():
        assert len(r.pcm) == 2 * r.n_samples and r.n_samples <= 1999
        parts.setdefault(r.path.split("/")[-1][:-4], {})[r.first_sample] = bytes(r.pcm)
    assert {k: b"".join(v for _, v in sorted(parts.get(k, {}).items())) for k in pcm} == pcm


@pytest.mark.parametrize("bad", [b"", b"RIFFxxxxWAVE", wav_bytes(b"ab" * 9, 8000), wav_bytes(b"ab" * 9)[:-3], b"ID3" + bytes(60), wav_bytes(b"ab").replace(b"\x01\x00\x01\x00", b"\x01\x00\x02\x00")])
def test_bad_wav_files_fail(wav, tmp_path, bad):
    (tmp_path / "x.wav").write_bytes(bad)
    with pytest.raises(PySparkException):
        wav.read.format("wav").load(str(tmp_path)).count()


def test_a_failed_write_leaves_no_file(wav, tmp_path):
    good = wav.createDataFrame([(f"n{i}", b"ab" * i, "{}") for i in range(20)], "name string, pcm binary, record string")
    bad = good.withColumn("record", F.when(F.col("name") == "n7", F.raise_error(F.lit("no"))).otherwise(F.col("record")))
    with pytest.raises(PySparkException):
        bad.repartition(4).write.format("wav").mode("append").save(str(tmp_path))
    with pytest.raises(PySparkException):
        good.unionByName(good.limit(1)).write.format("wav").mode("append").save(str(tmp_path))  # one name twice
    with pytest.raises(PySparkException):
        good.withColumn("name", F.lit("../x")).write.format("wav").mode("append").save(str(tmp_path))
    assert list(tmp_path.iterdir()) == []


# ---- documents


def test_file_documents_and_tree(spark):
    segments = spark.createDataFrame([(f, s, s + 5, None if s % 3 else True) for f in range(20) for s in range(f % 4)], "file_index int, start_ms int, end_ms int, flag boolean")
    files = spark.createDataFrame([(f, f * 100) for f in range(20)], "file_index int, duration_ms int")
    docs = documents.file_documents(files, {"segments": segments})
    got = {r.file_index: r for r in docs.collect()}
    for f in range(20):
        want = {"file_index": f, "duration_ms": f * 100, "segments": [{"start_ms": s, "end_ms": s + 5, "flag": None if s % 3 else True} for s in range(f % 4)]}
        assert got[f].document == audit.canonical_json(want)
        assert got[f].sha256 == hashlib.sha256(got[f].document.encode()).hexdigest()
    tree = {}
    for parts in (1, 6):
        rows = documents.digest_tree(docs.repartition(parts), fanout=3).collect()
        tree[parts] = sorted(map(tuple, rows))
    assert tree[1] == tree[6]
    level = [got[f].sha256 for f in range(20)]
    n = 0
    while len(level) > 1:
        n += 1
        level = [hashlib.sha256("".join(level[i : i + 3]).encode()).hexdigest() for i in range(0, len(level), 3)]
        assert [t[3] for t in tree[1] if t[0] == n] == level
    assert max(t[0] for t in tree[1]) == n
    other = documents.digest_tree(docs.withColumn("sha256", F.when(F.col("file_index") == 11, "x").otherwise(F.col("sha256"))), fanout=3)
    changed = {t[:2] for t in tree[1]} & {tuple(r)[:2] for r in other.collect() if tuple(r) not in tree[1]}
    assert changed == {(1, 3), (2, 1), (3, 0)}
    assert documents.digest_tree(docs.where("file_index = 0"), fanout=3).count() == 1
    assert documents.digest_tree(docs.limit(0)).count() == 0


# ---- frame scan


def test_frame_scan_by_rule(spark):
    rng = random.Random(8)
    counts = {1: (50, 50), 2: (40, 45), 3: (47, 44), 4: (10, 0)}
    decoded = [(k, i, [rng.random()] if rng.random() < 0.8 else [], [(rng.random(),) for _ in range(3)]) for k, (n, _) in counts.items() for i in range(n)]
    listed = [(k, i, i * 40 + k) for k, (_, n) in counts.items() for i in range(n)]
    speech = [(1, 400, 700), (2, 0, 100), (3, 1600, 1700)]
    d = spark.createDataFrame(decoded, "k int, i int, persons array<double>, faces array<struct<det_score: double>>")
    t, s = spark.createDataFrame(listed, "k int, i int, pts_ms long"), spark.createDataFrame(speech, "k int, start_ms long, end_ms long")
    seen = Observation("scan")
    out = fr.scan(d, t, s, "k", observation=seen)
    got = sorted((r.k, r.i, r.pts_ms, [f.det_score for f in r.faces]) for r in out.collect())
    pts = {(k, i): p for k, i, p in listed}
    near = lambda k, p: any(x == k and a - 50 <= p <= b + 50 for x, a, b in speech)
    looked = [f for f in decoded if f[:2] in pts and (f[1] % 5 == 0 or near(f[0], pts[f[:2]]))]
    want = sorted((k, i, pts[k, i], [x for (x,) in faces if x >= 0.5]) for k, i, persons, faces in looked if any(x >= 0.25 for x in persons))
    assert got == want
    assert seen.get == {"decoded": len(decoded), "listed": len(listed), "looked_at": len(looked), "analysed": len(want)}
    stats = {r.k: tuple(r)[1:] for r in fr.scan_stats(d, t, out, "k").collect()}
    assert {k: (v[0], v[1], v[3]) for k, v in stats.items()} == {1: (50, 50, False), 2: (40, 45, True), 3: (45, 44, True), 4: (1, 0, True)}
    assert sum(v[2] for v in stats.values()) == len(want)


# ---- cache


def test_cache_builds_once_for_each_key(spark, tmp_path):
    built = []

    def build(n):
        return lambda: built.append(n) or spark.range(n)

    cache = ResultCache(spark, str(tmp_path), optional=("models",))
    key = {"input": "abc", "params": {"a": 1, "b": [1, 2]}, "models": "m1"}
    assert cache.get(key, build(3)).count() == 3 == cache.get(dict(reversed(key.items())), build(4)).count()
    assert cache.get({**key, "params": {"a": 2, "b": [1, 2]}}, build(5)).count() == 5
    assert cache.get({**key, "models": "m2"}, build(6)).count() == 6
    assert cache.get({**key, "models": None}, build(7)).count() in (3, 6)  # whichever models made it
    assert built == [3, 5, 6]
    # without its key document a table doesn't count
    for p in tmp_path.rglob("key.json"):
        p.unlink()
    assert cache.get(key, build(8)).count() == 8


# ---- streaming: late frames, idle keys, the closing window


def test_stream_of_late_frames(spark, tmp_path):
    rng = random.Random(2)
    frames = []
    for key in range(3):
        for i in range(120):
            frames.append((key, i * 100, rng.random() < 0.9, rng.uniform(0.05, 0.3), rng.random() < 0.1, rng.random() < 0.2, rng.choice([None, rng.uniform(0, 0.3)]), rng.random() < 0.8))
    schema = "key long, pts_ms long, target_present boolean, target_mar double, target_suspended boolean, other_present boolean, other_mar double, vad boolean"
    every = spark.createDataFrame(frames, schema)
    want = sorted(map(str, folds.speaking_windows(every, ["key"]).collect()))
    assert any("end_of_video" in w for w in want)
    batches = [[] for _ in range(4)]
    for f in frames:
        batches[min(3, (f[1] + rng.randint(0, 1500)) // 3300)].append(f)
    batches.append([(None, 12_000 + 70_000, *[None] * 6)])  # the heartbeat that ends all
    for b in batches:
        rng.shuffle(b)
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    provider = spark.conf.get(st.PROVIDER)
    with st.state_store(spark):
        out = st.speaking_windows_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), late_ms=2000)
        q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.conf.get(st.PROVIDER) == provider
    assert sorted(map(str, spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect())) == want
