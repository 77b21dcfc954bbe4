"""Media metadata and PCM: probe documents, frame clocks, WAV files, slices."""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .clicks import required

PROBE = "struct<streams: array<struct<codec_type: string, start_time: string, sample_rate: string, avg_frame_rate: string, r_frame_rate: string>>>"


def parse_probe(text: Column) -> Column:
    """A probe document's first audio stream's start (ms; "N/A" is 0 and missing) and rate, whether its video's rate varies, and its error.

    error is null for a good document and says what is wrong with one without an audio stream: see probes, which fails then.
    """
    from ..functions.rules import half_even_ms

    streams = F.from_json(text, PROBE)["streams"]
    first = lambda kind: F.get(F.filter(streams, lambda s: s["codec_type"] == kind), F.lit(0))
    audio, video = first("audio"), first("video")
    part = lambda c, i: F.try_element_at(F.split(c, "/"), F.lit(i)).try_cast("bigint")
    a, r = video["avg_frame_rate"], video["r_frame_rate"]
    varies = part(a, 1) * part(r, 2) != part(r, 1) * part(a, 2)
    start = audio["start_time"].try_cast("decimal(28,9)")
    error = F.when(streams.isNull(), "not a probe document").when(audio.isNull(), "no audio stream")
    return F.struct(
        F.coalesce(half_even_ms(start), F.lit(0)).alias("audio_start_ms"), start.isNull().alias("audio_start_missing"),
        audio["sample_rate"].try_cast("int").alias("sample_rate"), F.coalesce(varies, F.lit(False)).alias("vfr_suspected"), error.alias("error"),
    )


def probes(spark: SparkSession, path: str) -> DataFrame:
    """(path, audio_start_ms, audio_start_missing, sample_rate, vfr_suspected) of probe documents, one a file; one without a usable audio stream fails."""
    files = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), parse_probe(F.col("value")).alias("p"))
    good = required(files, F.col("p.error").isNull(), F.concat("path", F.lit(": "), F.col("p.error")))
    return good.select("path", "p.audio_start_ms", "p.audio_start_missing", "p.sample_rate", "p.vfr_suspected")


def canonical_order(df: DataFrame, keys: list[str], path: str) -> DataFrame:
    """file_index from 0 by path components, not by raw strings, within keys."""
    from pyspark.sql import Window

    return df.withColumn("file_index", F.row_number().over(Window.partitionBy(*keys).orderBy(F.split(path, "/"))).cast("long") - 1)


def frame_clock(lines: DataFrame, text: str = "value") -> DataFrame:
    """Frame times (ms) from lines of decimal seconds: blank and N/A lines go; what follows a comma is ignored."""
    from ..functions.rules import half_even_ms

    token = F.trim(F.split_part(text, F.lit(","), F.lit(1)))
    return lines.select(half_even_ms(token.try_cast("decimal(28,9)")).alias("pts_ms")).where("pts_ms is not null")


def pcm_slice(pcm: Column, start_pts: Column, t0: Column, t1: Column, samples_per_ms: int = 16) -> Column:
    """Bytes of 16-bit PCM between two local times, clamped to the recording."""
    n = F.floor(F.length(pcm) / (2 * samples_per_ms))
    lo, hi = F.greatest(t0 - start_pts, F.lit(0)), F.least(t1 - start_pts, n)
    return F.substring(pcm, (1 + lo * 2 * samples_per_ms).cast("int"), (F.greatest(hi - lo, F.lit(0)) * 2 * samples_per_ms).cast("int"))


def read_wav(spark: SparkSession, path: str, rate: int = 16_000) -> DataFrame:
    """(path, n_samples, pcm) of WAV files; other than mono 16-bit at `rate` fails."""

    def decode(raw: bytes):
        at = 12
        form = None
        while at + 8 <= len(raw):
            name, size = raw[at : at + 4], struct.unpack("<I", raw[at + 4 : at + 8])[0]
            if name == b"fmt ":
                form = struct.unpack("<HHIIHH", raw[at + 8 : at + 24])
            if name == b"data":
                if form is None or form[1] != 1 or form[5] != 16 or form[2] != rate:
                    raise ValueError(f"not mono 16-bit PCM at {rate} Hz")
                return size // 2, raw[at + 8 : at + 8 + size]
            at += 8 + size + size % 2
        raise ValueError("no data chunk")

    udf = F.udf(decode, "n_samples bigint, pcm binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path)
    return files.select("path", udf("content").alias("w")).select("path", "w.n_samples", "w.pcm")


def wav_bytes(pcm: bytes, rate: int = 16_000) -> bytes:
    """A mono 16-bit WAV file."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(pcm), b"WAVE", b"fmt ", 16, 1, 1, rate, rate * 2, 2, 16, b"data", len(pcm))
    return head + pcm


def peak_envelope(samples: DataFrame, keys: list[str], index: str, value: str, per_column: int) -> DataFrame:
    """Largest absolute sample of each column of per_column samples, as a share of full scale, to three places."""
    col = F.expr(f"{index} div {per_column}")
    return samples.groupBy(*keys, col.alias("col")).agg(F.bround(F.max(F.abs(value)) / 32768, 3).alias("peak"))


def write_log(entries: DataFrame, path: str) -> None:
    """Append audit entries as JSON lines, nulls kept."""
    entries.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Audit entries from JSON lines; blank lines are skipped and malformed ones fail."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("e")).select("e.*")
