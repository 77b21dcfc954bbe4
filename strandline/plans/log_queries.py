"""Queries of the audit log and of streaming."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import audit
from ..sources.shared import shared_path, stored
from ..streaming import windows as st
from .registry import ORACLES, query
from .rule_queries import frames
from .vector_queries import _TIERED, tiers
from .views import spans, spans_sql, table

_PAYLOAD = """'{"event_id":' || event_id || ',"kind":"' || event_type || '"}'"""
_LOG = f"(SELECT user_id, event_id, event_type AS operation, epoch_us(ts) // 10000000 AS start_ms, event_id % 5 AS file_index, {_PAYLOAD} AS payload FROM events)"


def log(spark, d):
    payload = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"kind":"'), "event_type", F.lit('"}'))
    start = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div 10000000")
    return table(spark, d, "events").select("user_id", "event_id", F.col("event_type").alias("operation"), start.alias("start_ms"), (F.col("event_id") % 5).alias("file_index"), payload.alias("payload"), F.sha2(payload, 256).alias("payload_sha256"))


_MERGED = f"(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY file_index, start_ms, operation, sha256(payload)) - 1 AS seq FROM {_LOG})"


@query("o1_merge_order", f"SELECT user_id, event_id, seq FROM {_MERGED}")
def o1(spark, d):
    return audit.merge_order(log(spark, d), ["user_id"]).select("user_id", "event_id", "seq")


_CHAIN = f"""WITH RECURSIVE m AS {_MERGED}, c AS (SELECT user_id, seq, repeat('0', 64) AS prev_sha256, sha256(seq || '|' || operation || '|' || sha256(payload) || '|' || repeat('0', 64)) AS entry_sha256 FROM m WHERE seq = 0
    UNION ALL SELECT m.user_id, m.seq, c.entry_sha256, sha256(m.seq || '|' || m.operation || '|' || sha256(m.payload) || '|' || c.entry_sha256) FROM c JOIN m ON m.user_id = c.user_id AND m.seq = c.seq + 1)"""


@query("w20_chain", f"{_CHAIN} SELECT user_id, seq, prev_sha256, entry_sha256 FROM c")
def w20(spark, d):
    return audit.chain(audit.merge_order(log(spark, d), ["user_id"]), ["user_id"])


@query("w20_verify", "SELECT user_id, count(*) AS entries, CASE WHEN user_id % 10 = 3 AND count(*) > 4 THEN 4::BIGINT END AS first_bad, true AS complete FROM events GROUP BY 1")
def w20v(spark, d):
    """Chains of which every tenth user's fifth payload was changed afterwards."""
    merged = audit.merge_order(log(spark, d), ["user_id"])
    linked = merged.join(audit.chain(merged, ["user_id"]), ["user_id", "seq"])
    forged = F.when((F.col("user_id") % 10 == 3) & (F.col("seq") == 4), F.concat("payload", F.lit(" "))).otherwise(F.col("payload"))
    return audit.verify(linked.withColumn("payload", forged), ["user_id"])


@query("p15_unwrap", f"SELECT event_id, CASE WHEN event_id % 3 = 0 THEN file_index END AS file_index, CASE WHEN event_id % 3 = 0 THEN start_ms END AS start_ms, CASE WHEN event_id % 3 = 1 THEN '{{\"file_index\":1,\"payload\":{{\"a\":1}}}}' ELSE payload END AS payload FROM {_LOG}")
def p15(spark, d):
    wrapped = F.concat(F.lit('{"file_index":'), F.col("file_index").cast("string"), F.lit(',"operation":"'), "operation", F.lit('","payload":'), "payload", F.lit(',"start_ms":'), F.col("start_ms").cast("string"), F.lit("}"))
    other = F.lit('{"file_index":1,"payload":{"a":1}}')
    entries = log(spark, d).select("event_id", "operation", F.when(F.col("event_id") % 3 == 0, wrapped).when(F.col("event_id") % 3 == 1, other).otherwise(F.col("payload")).alias("payload"))
    return audit.unwrap(entries).select("event_id", "file_index", "start_ms", "payload")


@query("p16_canonical_json", "SELECT event_id, '{\"a\":null,\"b\":[1,2],\"k\":' || json_extract(props, '$.k') || '}' AS payload FROM events")
def p16(spark, d):
    k = F.get_json_object("props", "$.k")
    loose = F.concat(F.lit('{ "k" : '), k, F.lit(', "b": [1, 2], "a": null }'))
    return table(spark, d, "events").select("event_id", audit.canonical(loose).alias("payload"))


@query("set1_registry_diff", "SELECT path, kind FROM (SELECT coalesce(e.path, a.path) AS path, CASE WHEN a.path IS NULL THEN 'missing' WHEN e.path IS NULL THEN 'unexpected' WHEN e.h <> a.h THEN 'mismatched' END AS kind FROM (SELECT p_brand || '/' || p_partkey AS path, sha256(p_name) AS h FROM part WHERE p_partkey % 7 > 0) e FULL JOIN (SELECT p_brand || '/' || p_partkey AS path, sha256(CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE p_name END) AS h FROM part WHERE p_partkey % 11 > 0) a ON e.path = a.path) WHERE kind IS NOT NULL")
def set1(spark, d):
    part = table(spark, d, "part")
    path = F.concat_ws("/", "p_brand", F.col("p_partkey").cast("string")).alias("path")
    expected = part.where("p_partkey % 7 > 0").select(path, F.sha2("p_name", 256).alias("sha256"))
    actual = part.where("p_partkey % 11 > 0").select(path, F.sha2(F.when(F.col("p_partkey") % 5 == 0, "x").otherwise(F.col("p_name")), 256).alias("sha256"))
    return audit.registry_difference(expected, actual)


@query("set2_pins", "SELECT p_partkey, p_size AS wanted, (p_size + p_partkey % 2)::INT AS found FROM part WHERE p_size <> p_size + p_partkey % 2")
def set2(spark, d):
    part = table(spark, d, "part")
    have = part.select("p_partkey", (F.col("p_size") + F.col("p_partkey") % 2).cast("int").alias("found"))
    return part.select("p_partkey", F.col("p_size").alias("wanted")).join(have, "p_partkey").where("wanted <> found")


@query("w19_lanes", f"SELECT id, kind AS lane, start_ms + coalesce(o, 0) AS global_start_ms, end_ms + coalesce(o, 0) AS global_end_ms FROM (SELECT *, key % 50 AS f FROM {spans_sql()}) s LEFT JOIN (SELECT c_custkey AS f, floor(c_acctbal)::BIGINT AS o FROM customer WHERE c_custkey < 40) USING (f)")
def w19(spark, d):
    files = table(spark, d, "customer").where("c_custkey < 40").select(F.col("c_custkey").alias("file_index"), F.floor("c_acctbal").alias("file_offset_ms"))
    records = spans(spark, d).select("id", F.col("kind").alias("operation"), (F.col("key") % 50).alias("file_index"), "start_ms", "end_ms")
    return audit.lanes(records, files).select("id", F.col("operation").alias("lane"), "global_start_ms", "global_end_ms")


@query("a17_last_hashes", f"SELECT user_id, operation, arg_max(sha256(payload), seq) AS last_sha256, count(*) AS n FROM {_MERGED} GROUP BY ALL")
def a17(spark, d):
    merged = audit.merge_order(log(spark, d), ["user_id"])
    return merged.groupBy("user_id", "operation").agg(F.max_by("payload_sha256", "seq").alias("last_sha256"), F.count("*").alias("n"))


@query("p13_verdicts", f"""SELECT file_index, block_index, CASE WHEN tier = 'SKIPPED' THEN 'SKIPPED: no scored window covers this block' WHEN tier = 'HIGH' THEN 'HIGH: target ' || t || ' > 0.040 and margin ' || g || ' > 0.00'
    WHEN tier = 'MEDIUM' AND margin_failed THEN 'MEDIUM: target ' || t || ' > 0.040 but margin ' || g || ' <= 0.00' WHEN tier = 'MEDIUM' THEN 'MEDIUM: 0.000 < target ' || t || ' <= 0.040'
    WHEN tier = 'SUB' THEN 'SUB: -0.04 <= target ' || t || ' <= 0.000' ELSE 'REJECT: target ' || t || ' < -0.04' END AS verdict
    FROM (SELECT *, printf('%.3f', trunc(s_target * 1000) / 1000 + 0.0) AS t, printf('%.3f', trunc((s_target - s_other) * 1000) / 1000 + 0.0) AS g FROM {_TIERED})""")  # fmt: skip
def p13(spark, d):
    cut = lambda c: F.when(c >= 0, F.floor(c * 1000) / 1000).otherwise(F.ceil(c * 1000) / 1000)
    b = tiers(spark, d).withColumn("t", cut(F.col("s_target"))).withColumn("o", F.col("t") - cut(F.col("s_target") - F.col("s_other")))
    return b.select("file_index", "block_index", audit.verdict(F.col("tier"), F.col("t"), F.col("o"), F.col("margin_failed"), 0.04, 0.0, 0.0, -0.04).alias("verdict"))


def _streamed(spark, stream, name):
    """Run a stream to its end and read what it wrote."""
    at = shared_path(spark, name)
    q = stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


def _dealt(spark, df, batch, batches, name):
    """A stream of df in micro-batches, by the number in column `batch`: one folder of one file each, in order."""
    at = shared_path(spark, name)
    for b in range(batches):
        df.where(F.col(batch) == b).coalesce(1).write.mode("append").parquet(at)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(at)


def _event_stream(spark, d):
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


_SESSIONS = "(SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS n FROM (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS c FROM events)) GROUP BY user_id, g)"


@query("s_session_segments", f"SELECT user_id, epoch_us(first) // 1000 AS start_ms, epoch_us(last) // 1000 + 21600000 AS end_ms, n FROM {_SESSIONS} WHERE last + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def s_sessions(spark, d):
    events = _event_stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    out = st.session_counts(events, "ts", "user_id", "6 hours", "1 hour")
    ms = lambda c: F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast({c} as timestamp_ntz)) div 1000")
    return _streamed(spark, out, "sessions").select("user_id", ms("start").alias("start_ms"), ms("end").alias("end_ms"), "n")


@query("s_speaking_stream", ORACLES["w14_speaking_windows"])
def s_fsm(spark, d):
    """The machine as a stream over shuffled micro-batches; equals w14, windows that the end closes included."""
    f = stored(frames(spark, d), "all-frames").withColumn("shift", F.xxhash64("key", "pts_ms") % 2001)
    span = f.agg(F.max("pts_ms")).first()[0] // 5 + 1
    dealt = f.select("*", F.expr(f"cast(least(4, (pts_ms + abs(shift)) div {span}) as int)").alias("batch")).drop("shift")
    beat = dealt.limit(1).select(*(F.lit(None).cast(t).alias(c) if c not in ("pts_ms", "batch") else F.lit(5 * span + 70_000 if c == "pts_ms" else 5).cast(t).alias(c) for c, t in dealt.dtypes))
    with st.state_store(spark):
        return _streamed(spark, st.speaking_windows_stream(_dealt(spark, dealt.unionByName(beat), "batch", 6, "frames"), 3000), "speaking")


_ARRIVALS = "(SELECT event_id, ts, least(4, (event_id * 7919 % 1009) // 202) AS batch FROM events)"


@query("s_late_drop", f"SELECT event_id FROM {_ARRIVALS} a WHERE ts > coalesce((SELECT max(ts) FROM {_ARRIVALS} b WHERE b.batch < a.batch - 1) - INTERVAL 10 DAY, TIMESTAMP '1970-01-01')")
def s_late(spark, d):
    """Events in five micro-batches; a batch's late rows are those under the watermark that the batch before it ran with."""
    e = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.expr("cast(least(4, (event_id * 7919 % 1009) div 202) as int)").alias("batch"))
    return _streamed(spark, st.first_in_time(_dealt(spark, e, "batch", 5, "arrivals"), "ts", ["event_id"], "10 days"), "late").select("event_id")
