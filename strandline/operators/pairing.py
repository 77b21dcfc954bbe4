"""Who is who in a frame: faces by time, faces under clicks, targets and others, and spans kept clear of seeds.

Frames carry a session key, so each window and join below is dealt by (key, frame).  Faces within a
frame are few and numbered by `ord`; of ties the least ord wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import interval_join, interval_semi, overlap_ms, with_flag


def contains_point(x: Column, y: Column) -> Column:
    """Whether a face's box (x0, y0, x1, y1), borders included, holds the point."""
    return x.between(F.col("x0"), F.col("x1")) & y.between(F.col("y0"), F.col("y1"))


def from_center(x: Column, y: Column) -> Column:
    """Squared distance of the point from the middle of a face's box."""
    dx, dy = (F.col("x0") + F.col("x1")) / 2 - x, (F.col("y0") + F.col("y1")) / 2 - y
    return dx * dx + dy * dy


def positional_join(left: DataFrame, right: DataFrame, key: str, index: str) -> DataFrame:
    """Row i of left with row i of right within key; what the longer side has more goes."""
    return left.join(right, [key, index])


def faces_at(times: DataFrame, faces: DataFrame, key: str, pts: str, columns: list[str]) -> DataFrame:
    """times with faces: the array of face structs (ord first) of that very time, empty where there is none."""
    lists = faces.groupBy(key, pts).agg(F.array_sort(F.collect_list(F.struct("ord", *columns))).alias("faces"))
    kind = lists.schema["faces"].dataType
    return times.join(lists, [key, pts], "left").withColumn("faces", F.coalesce("faces", F.array().cast(kind)))


def clicked_faces(clicks: DataFrame, faces: DataFrame, on: list[str], click: str) -> DataFrame:
    """The face that each click (x, y) means in its frame: of boxes that hold the point the one of greatest det_score, else the nearest by its middle."""
    both = clicks.join(faces, on)
    held = contains_point(F.col("x"), F.col("y"))
    rank = F.struct((~held).alias("away"), F.when(held, -F.col("det_score")).otherwise(from_center(F.col("x"), F.col("y"))).alias("by"), F.col("ord"))
    best = both.groupBy(click).agg(F.min_by(F.struct("ord", held.alias("held")), rank).alias("b"))
    return best.select(click, F.col("b.ord").alias("ord"), F.col("b.held").alias("contained"))


def paired_identities(faces: DataFrame, frame: list[str], threshold: float, known_other: bool) -> DataFrame:
    """(frame, target, other): ords of the target's and the other person's face.

    The target is the face most like it (sim_target), if that is at least the threshold.  Of the remaining faces the other is
    the one most like the known other (sim_other, same threshold), or where nobody is known the one of greatest det_score.
    """
    first = lambda c: F.row_number().over(Window.partitionBy(*frame).orderBy(F.desc(c), "ord"))
    marked = faces.withColumn("__target", (first("sim_target") == 1) & (F.col("sim_target") >= threshold))
    rest = "sim_other" if known_other else "det_score"
    marked = marked.withColumn("__rest", F.when(~F.col("__target"), F.col(rest)))
    other = F.col("__rest").isNotNull() & (F.row_number().over(Window.partitionBy(*frame).orderBy(F.desc_nulls_last("__rest"), "ord")) == 1)
    other = other & (F.col("__rest") >= threshold) if known_other else other
    marked = marked.withColumn("__other", other)
    return marked.groupBy(*frame).agg(F.max(F.when(F.col("__target"), F.col("ord"))).alias("target"), F.max(F.when(F.col("__other"), F.col("ord"))).alias("other"))


def hit_first(points: DataFrame, spans: DataFrame, ids: list[str], at: str, key: str = "key", take: str = "id", bucket_ms: int = 4000) -> DataFrame:
    """points with hit: `take` of the first span (least start, then least `take`) that holds the point, its end left out; null if none does."""
    p = points.select(key, *ids, F.col(at).alias("start_ms"), (F.col(at) + 1).alias("end_ms"))
    hits = interval_join(p, spans.select(key, take, "start_ms", "end_ms"), key, bucket_ms).groupBy(*ids).agg(F.min_by(f"r_{take}", F.struct("r_start_ms", f"r_{take}")).alias("hit"))
    return points.join(hits, ids, "left")


def match_with_thresholds(rows: DataFrame, row: str, score: str, least: str, name: str) -> DataFrame:
    """For each row the candidate of greatest score among those that reach their own threshold; rows without one go."""
    best = rows.where(F.col(score) >= F.col(least)).groupBy(row).agg(F.min_by(F.struct(name, score), F.struct(-F.col(score), F.col(name))).alias("b"))
    return best.select(row, F.col(f"b.{name}").alias(name), F.col(f"b.{score}").alias(score))


def seed_excluded(spans: DataFrame, seeds: DataFrame, ids: list[str], key: str, hull: bool = False, bucket_ms: int = 4000) -> DataFrame:
    """spans with seed_overlap: whether one overlaps a seed of its key, or with `hull` the stretch from the first seed's start to the last one's end."""
    if hull:
        around = seeds.groupBy(key).agg(F.min("start_ms").alias("seed_start"), F.max("end_ms").alias("seed_end"))
        over = (F.col("start_ms") < F.col("seed_end")) & (F.col("end_ms") > F.col("seed_start"))
        return spans.join(around, key, "left").withColumn("seed_overlap", F.coalesce(over, F.lit(False))).drop("seed_start", "seed_end")
    return with_flag(spans, interval_semi(spans, seeds.select(key, "start_ms", "end_ms"), ids, key, bucket_ms), ids, "seed_overlap")


def speech_share(windows: DataFrame, speech: DataFrame, ids: list[str], key: str, least: float = 0.20, bucket_ms: int = 4000) -> DataFrame:
    """windows with overlap_ms and scored: whether speech covers at least that share of one; the others, those of no length too, are to be reported as skipped."""
    out = overlap_ms(windows, speech, ids, key, bucket_ms)
    return out.withColumn("scored", F.coalesce(F.col("overlap_ms") / F.nullif(F.col("end_ms") - F.col("start_ms"), F.lit(0)) >= least, F.lit(False)))


def longest(spans: DataFrame, keys: list[str], n: int = 8) -> DataFrame:
    """The n longest spans of each key, `rank` from 1; of equal ones the earlier comes first."""
    w = Window.partitionBy(*keys).orderBy(F.desc(F.col("end_ms") - F.col("start_ms")), "start_ms")
    return spans.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def run_blocks(runs: DataFrame, blocks: DataFrame, key: str = "file_index", block_ms: int = 1000) -> DataFrame:
    """The HIGH blocks under each run (key, start_ms, end_ms), clipped to it: block_index, from_ms, to_ms."""
    first, last = F.expr(f"start_ms div {block_ms}"), F.expr(f"(end_ms - 1) div {block_ms}")
    spread = runs.where("end_ms > start_ms").withColumn("block_index", F.explode(F.sequence(first, last)))
    high = blocks.where("tier = 'HIGH'").select(key, "block_index")
    at = F.col("block_index") * block_ms
    return spread.join(high, [key, "block_index"]).withColumn("from_ms", F.greatest("start_ms", at)).withColumn("to_ms", F.least("end_ms", at + block_ms))


def second_pass(failed: DataFrame, anti_sim: Column, **bounds) -> DataFrame:
    """Gate-C failures (coverage, present, closed, seed) judged once more against a grown anti profile: gate as a struct."""
    from ..functions.rules import triple_gate

    again = triple_gate(F.col("coverage"), F.col("present"), F.col("closed"), F.col("seed"), anti_sim, F.lit(True), **bounds)
    return failed.where("gate = 'C'").withColumn("again", again)


def located(files: DataFrame, folders: DataFrame, loose: DataFrame) -> DataFrame:
    """files (file_index, source) with wav: the expected name in the first folder that has it, else the first loose file whose stem holds the source's, else the only loose one of an only file.

    folders: (place, path) of files in folders, in the folders' order; loose: (place, path), files named one by one by hand.
    A stem may lie anywhere in another.  So each loose stem is cut into all its pieces as long as some file's stem is, and equal pieces meet in a join:
    as many rows as the loose stems have places, for each length that a source's stem has.  Of the loose files with a piece only the first goes on, so a common one makes one row.
    """
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    stem = lambda c: F.regexp_replace(base(c), r"(?<=.)\.[^.]*$", "")
    named = files.withColumn("stem", stem("source"))
    named = named.withColumn("expected", F.format_string("%03d_%s.16k.wav", "file_index", "stem"))
    one = folders.select(base("path").alias("expected"), "place", "path").groupBy("expected").agg(F.min_by("path", "place").alias("in_folder"))
    loose = loose.select("place", F.col("path").alias("loose_path"), stem("path").alias("loose_stem"))
    lengths = named.where("stem is not null").select(F.length("stem").alias("n")).distinct()  # no more than a file's name has characters
    cut = loose.join(F.broadcast(lengths), F.length("loose_stem") >= F.col("n")).withColumn("at", F.explode(F.sequence(F.lit(1), F.length("loose_stem") - F.col("n") + 1)))
    two = cut.groupBy(F.substring("loose_stem", F.col("at"), F.col("n")).alias("stem")).agg(F.min(F.struct("place", "loose_path"))["loose_path"].alias("by_stem"))
    only = loose.agg(F.when(F.count("*") == 1, F.min("loose_path")).alias("sole"))
    many = files.agg((F.count("*") == 1).alias("single"))
    out = named.join(one, "expected", "left").join(two, "stem", "left").join(F.broadcast(only)).join(F.broadcast(many))
    return out.select("file_index", "source", F.coalesce("in_folder", "by_stem", F.when(F.col("single"), F.col("sole"))).alias("wav"))
