"""The frame scan: which decoded frames are looked at, and whether their number fits the listed times."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .intervals import interval_join


@dataclass(frozen=True)
class ScanParams:
    """Every how many frames are looked at in silence, how far from speech counts as in it, and least scores of persons and faces."""

    stride: int = 5
    tolerance_ms: int = 50
    person_min: float = 0.25
    det_min: float = 0.5


def paired(decoded: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Decoded frames (key, i, ...) and listed times (key, i, pts_ms) by number, either side alone too: is_decoded, is_listed."""
    d, t = decoded.withColumn("is_decoded", F.lit(True)), listed.select(key, "i", "pts_ms").withColumn("is_listed", F.lit(True))
    return d.join(t, [key, "i"], "full").fillna(False, ["is_decoded", "is_listed"])


def scan(decoded: DataFrame, listed: DataFrame, speech: DataFrame, key: str, p: ScanParams = ScanParams(), observation: Observation | None = None) -> DataFrame:
    """Analysed frames: key, i, pts_ms and the faces (structs with det_score) that are sure enough.

    decoded: key, i (from 0), persons (array of scores) and faces; listed: key, i, pts_ms; speech: key, start_ms, end_ms.
    A frame is looked at near speech, and in silence if its number is a multiple of the stride; without a listed time it isn't.  Of those looked at,
    the ones with a person are analysed.  `observation` gets decoded, listed, looked_at and analysed, counted in the same pass.
    """
    both = paired(decoded, listed, key)
    at = listed.select(key, "i", F.col("pts_ms").alias("start_ms"), (F.col("pts_ms") + 1).alias("end_ms"))
    wide = speech.select(key, (F.col("start_ms") - p.tolerance_ms).alias("start_ms"), (F.col("end_ms") + p.tolerance_ms + 1).alias("end_ms"))
    near = interval_join(at, wide, key).select(key, "i").distinct().withColumn("near", F.lit(True))
    seen = F.col("is_decoded") & F.col("is_listed") & (F.coalesce("near", F.lit(False)) | (F.col("i") % p.stride == 0))
    person = F.exists(F.coalesce("persons", F.array().cast("array<double>")), lambda s: s >= p.person_min)
    out = both.join(near, [key, "i"], "left").withColumn("looked_at", seen).withColumn("analysed", seen & F.coalesce(person, F.lit(False)))
    if observation is not None:
        out = out.observe(observation, *(F.count_if(F.col(c)).alias(n) for c, n in (("is_decoded", "decoded"), ("is_listed", "listed"), ("looked_at", "looked_at"), ("analysed", "analysed"))))
    return out.where("analysed").select(key, "i", "pts_ms", F.filter("faces", lambda f: f["det_score"] >= p.det_min).alias("faces"))


def scan_stats(decoded: DataFrame, listed: DataFrame, analysed: DataFrame, key: str) -> DataFrame:
    """Per key: decoded_frames, listed_pts, analysed_frames and pts_mismatch.

    Decoding stops at the first frame without a listed time, so decoded_frames is one more than listed_pts at most.
    """
    count = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    out = count(decoded, "d").join(count(listed, "listed_pts"), key, "full").join(count(analysed, "analysed_frames"), key, "left").fillna(0, ["d", "listed_pts", "analysed_frames"])
    return out.select(key, F.least("d", F.col("listed_pts") + 1).alias("decoded_frames"), "listed_pts", "analysed_frames", (F.col("d") != F.col("listed_pts")).alias("pts_mismatch"))
