"""Domain views over the driver's tables, in Spark and as SQL text for the oracles.

Time is an integer count of ticks, called ms throughout; an events tick is ten seconds of wall time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(column: str):
    """Milliseconds since 1970 of a timestamp without zone, whatever the session's zone is."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {column}) div 1000")


def spans(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """(key, id, start_ms, end_ms, kind, value): events as intervals of their user."""
    e = table(spark, sf_dir, "events")
    e = e.where(F.col("event_type").isin(*kinds)) if kinds else e
    start = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div 10000000")
    return e.select(F.col("user_id").alias("key"), F.col("event_id").alias("id"), start.alias("start_ms"), (start + 200 + F.floor(F.col("value") * 40)).alias("end_ms"), F.col("event_type").alias("kind"), "value")


def spans_sql(*kinds: str) -> str:
    where = f" WHERE event_type IN ({', '.join(repr(k) for k in kinds)})" if kinds else ""
    return f"(SELECT user_id AS key, event_id AS id, epoch_us(ts) // 10000000 AS start_ms, epoch_us(ts) // 10000000 + 200 + floor(value * 40)::BIGINT AS end_ms, event_type AS kind, value FROM events{where})"


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, file_index, pos, dur_ms, label, v): embeddings as a hundred one-second slots a file."""
    v = table(spark, sf_dir, "embeddings")
    return v.select("vec_id", F.expr("vec_id div 100").alias("file_index"), F.expr("vec_id % 100").alias("pos"), (1000 + 500 * F.expr("vec_id % 5")).alias("dur_ms"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))


VECTORS = "(SELECT vec_id, vec_id // 100 AS file_index, vec_id % 100 AS pos, 1000 + 500 * (vec_id % 5) AS dur_ms, label::BIGINT AS label, embedding::DOUBLE[] AS v FROM embeddings)"
