"""Operator click documents and the videos of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIDEOS = ("mp4", "mov", "mkv", "avi", "webm")


def discover_videos(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the videos right in a folder, sorted by path; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join(VIDEOS) + "}").load(folder)
    return files.select("path", "length").orderBy("path")


def required(df: DataFrame, good: Column, message: Column) -> DataFrame:
    """df, if good holds for each of its rows; one for which it doesn't fails the query.

    The check is a filter, so it is made whichever columns are read, and for a count too.
    """
    return df.where(F.assert_true(F.coalesce(good, F.lit(False)), message).isNull())


def present(expected: DataFrame, found: DataFrame, path: str = "path") -> DataFrame:
    """expected, if found has each of its paths; a missing one fails the query."""
    have = found.select(path).distinct().withColumn("__found", F.lit(True))
    return required(expected.join(have, path, "left"), F.col("__found"), F.concat(F.lit("missing file: "), F.coalesce(path, F.lit("null")))).drop("__found")


def parse_clicks(text: Column) -> Column:
    """A clicks document as (error, speaking, extra_seeds, anti, target_bearded, interviewer_bearded); error null: it is valid.

    Both versions: speaking_click is mandatory, speaking_clicks, anti_click and the two flags are optional.  file_index and pts_ms
    must be integers and flags booleans, by their JSON type; an empty or null anti_click is none.
    """
    doc = F.try_parse_json(text)
    part = lambda v, name, kind="variant": F.try_variant_get(v, f"$.{name}", kind)
    whole = lambda v, name: F.coalesce(F.schema_of_variant(part(v, name)) == "BIGINT", F.lit(False))
    click = lambda v: F.struct(
        part(v, "file_index", "bigint").alias("file_index"), part(v, "pts_ms", "bigint").alias("pts_ms"),
        part(v, "x", "double").alias("x"), part(v, "y", "double").alias("y"))
    wrong = lambda v: ~(whole(v, "file_index") & whole(v, "pts_ms") & part(v, "x", "double").isNotNull() & part(v, "y", "double").isNotNull())
    speaking, anti = part(doc, "speaking_click"), part(doc, "anti_click")
    extra = F.coalesce(part(doc, "speaking_clicks", "array<variant>"), F.array().cast("array<variant>"))
    no_anti = anti.isNull() | F.schema_of_variant(anti).isin("VOID", "OBJECT<>")
    flag_wrong = lambda name: F.coalesce(F.schema_of_variant(part(doc, name)) != "BOOLEAN", F.lit(False))
    flag = lambda name: F.coalesce(part(doc, name, "boolean"), F.lit(False))
    error = (
        F.when(doc.isNull(), "not a JSON document")
        .when(speaking.isNull(), "speaking_click is mandatory")
        .when(wrong(speaking) | (~no_anti & wrong(anti)) | F.exists(extra, wrong), "file_index and pts_ms must be integers, x and y numbers")
        .when(flag_wrong("target_bearded") | flag_wrong("interviewer_bearded"), "flags must be booleans")
    )
    return F.struct(
        error.alias("error"), F.when(error.isNull(), click(speaking)).alias("speaking"), F.when(error.isNull(), F.transform(extra, click)).alias("extra_seeds"),
        F.when(error.isNull() & ~no_anti, click(anti)).alias("anti"), flag("target_bearded").alias("target_bearded"), flag("interviewer_bearded").alias("interviewer_bearded"),
    )


def read_clicks(spark: SparkSession, path: str) -> DataFrame:
    """(path, speaking, extra_seeds, anti, target_bearded, interviewer_bearded) of click documents; an invalid one fails."""
    files = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), parse_clicks(F.col("value")).alias("c"))
    return required(files, F.col("c.error").isNull(), F.concat("path", F.lit(": "), F.col("c.error"))).select("path", "c.speaking", "c.extra_seeds", "c.anti", "c.target_bearded", "c.interviewer_bearded")
