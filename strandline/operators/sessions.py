"""Click sessions, timelines, log resumption and notices, and what a batch adds up to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.clicks import parse_clicks, required
from .audit import GENESIS, verify
from .intervals import near as near_speech
from .intervals import overlap_ms

NOTICES = ("warning", "blocking_halt", "drift_notice")


def session_states(events: DataFrame, keys: list[str], order: list[str], event: str = "event_id", epochs: bool = False) -> DataFrame:
    """The state of each click session after each of its events.

    events: action ('speaking', 'anti', 'clear_speaking', 'clear_anti', 'beard') and for 'beard' target_flag; a session
    begins without the flag.  A change of the flag and 'clear_speaking' forget every click, so a session falls into epochs;
    in one the seeds are its speaking clicks (without the flag the last one alone), and the anti click is the last one after
    the last speaking click and the last 'clear_anti'.  An anti click before any speaking click is refused.
    A click with `valid` false was refused by its checks and changes nothing (its action reads refused_speaking or refused_anti); without that column all are valid.
    Windows over the session's order do it all, so no state passes through Python.
    """
    if "valid" in events.columns:
        void = ~F.coalesce("valid", F.lit(True)) & F.col("action").isin("speaking", "anti")
        events = events.withColumn("action", F.when(void, F.concat(F.lit("refused_"), "action")).otherwise(F.col("action")))
    session = Window.partitionBy(*keys).orderBy(*order)
    flag = F.coalesce(F.last(F.when(F.col("action") == "beard", F.col("target_flag")), ignorenulls=True).over(session), F.lit(False))
    rows = events.withColumn("target_bearded", flag)
    changed = F.col("target_bearded") != F.coalesce(F.lag("target_bearded").over(session), F.lit(False))
    rows = rows.withColumn("__reset", (changed | (F.col("action") == "clear_speaking")).cast("int"))
    rows = rows.withColumns({"__epoch": F.sum("__reset").over(session), "__n": F.row_number().over(session)})
    epoch = Window.partitionBy(*keys, "__epoch").orderBy("__n")
    speaking, stale = F.col("action") == "speaking", F.col("action").isin("speaking", "clear_anti")
    last = lambda c, value: F.last(F.when(c, value), ignorenulls=True).over(epoch)
    rows = rows.withColumns({
        "__clicks": F.count_if(speaking).over(epoch),
        "__first": F.first(F.when(speaking, F.col(event)), ignorenulls=True).over(epoch),
        "__last": last(speaking, F.col(event)),
        "__stale": last(stale, F.col("__n")),
        "__anti": last(F.col("action") == "anti", F.struct("__n", F.col(event).alias("id"))),
    })
    clicks = F.col("__clicks")
    anti = F.when((clicks > 0) & (F.col("__anti.__n") > F.col("__stale")), F.col("__anti.id"))
    refused = F.when((F.col("action") == "anti") & (clicks == 0), "speaking_click_required_first")
    return rows.select(
        *keys, *order, "action", "target_bearded",
        F.when(F.col("target_bearded"), clicks).otherwise(F.least(clicks, F.lit(1).cast("long"))).alias("seeds"),
        F.when(F.col("target_bearded"), F.col("__first")).otherwise(F.col("__last")).alias("speaking_id"),
        anti.alias("anti_id"), refused.alias("reason"), *(["__epoch"] if epochs else []),
    )


def session_anchors(events: DataFrame, keys: list[str], order: list[str], vector: str, event: str = "event_id") -> DataFrame:
    """After each event of a click session its anchor: the mean of the faces of all seeds with the flag, else the last speaking click's face; null without one.

    events as for session_states, with the face's vector.  Sums run along an epoch dimension by dimension, so a session's vectors don't meet in one row.
    """
    states = session_states(events, keys, order, event, epochs=True).select(*keys, *order, "target_bearded", "speaking_id", "__epoch", F.col("action").alias("__said"))
    seeds = states.where("__said = 'speaking'").join(events.select(*keys, *order, vector), [*keys, *order])
    run = Window.partitionBy(*keys, "__epoch", "__i").orderBy(*order)
    dims = seeds.select(*keys, *order, "__epoch", F.posexplode(vector).alias("__i", "__x")).withColumn("__m", F.avg("__x").over(run))
    means = dims.groupBy(*keys, *order, "__epoch").agg(F.array_sort(F.collect_list(F.struct("__i", "__m", "__x"))).alias("__a"))
    part = lambda name: F.transform("__a", lambda e: e[name])
    known = means.select(*keys, *order, part("__m").alias("__mean"), part("__x").alias("__face"))
    rows = states.join(known, [*keys, *order], "left")
    w = Window.partitionBy(*keys, "__epoch").orderBy(*order)
    last = lambda c: F.last(c, ignorenulls=True).over(w)
    return rows.select(*keys, *order, F.when(F.col("speaking_id").isNotNull(), F.when(F.col("target_bearded"), last("__mean")).otherwise(last("__face"))).alias("anchor"))


def export_payload(speaking: Column, extra: Column, anti: Column, target_bearded: Column, interviewer_bearded: Column) -> Column:
    """A session's click document as canonical JSON: sorted keys, none for what isn't there.

    Clicks are structs (file_index, pts_ms, x, y), extra an array of them; coordinates are rounded to two places.  Extra seeds and the flags are only written if set.
    """
    click = lambda c: F.when(c.isNotNull(), F.struct(
        c["file_index"].alias("file_index"), c["pts_ms"].alias("pts_ms"), F.bround(c["x"].cast("double"), 2).alias("x"), F.bround(c["y"].cast("double"), 2).alias("y")))
    flag = lambda c: F.when(c, F.lit(True))
    more = F.when(target_bearded & (F.size(extra) > 0), F.transform(extra, click))
    return F.to_json(F.struct(
        click(anti).alias("anti_click"), flag(interviewer_bearded).alias("interviewer_bearded"), click(speaking).alias("speaking_click"),
        more.alias("speaking_clicks"), flag(target_bearded).alias("target_bearded")))


def checked_exports(exports: DataFrame, payload: str = "payload", anti: str = "anti") -> DataFrame:
    """exports, if each payload is read back as a valid document that has an anti click exactly if `anti` isn't null; one that isn't fails the query."""
    back = parse_clicks(F.col(payload))
    good = back["error"].isNull() & (back["anti"].isNotNull() == F.col(anti).isNotNull())
    return required(exports, good, F.concat(F.lit("not a valid export: "), F.coalesce(payload, F.lit("null"))))


def write_exports(exports: DataFrame, folder: str, name: str = "name", payload: str = "payload") -> None:
    """One file a row, <folder>/<name>/clicks.json, each put in place whole: a reader sees the old document or the new one."""

    def write(rows):
        import posixpath

        from ..sources.wav import file_system

        fs, root = file_system(folder)
        for row in rows:
            at = posixpath.join(root, str(row[name]))
            fs.create_dir(at, recursive=True)
            with fs.open_output_stream(posixpath.join(at, "clicks.json.tmp")) as file:
                file.write((row[payload] + "\n").encode())
            fs.move(posixpath.join(at, "clicks.json.tmp"), posixpath.join(at, "clicks.json"))

    exports.select(name, payload).foreachPartition(write)


def export_reason(speaking: Column, anti: Column, target_bearded: Column, include_anti: Column) -> Column:
    """Why a session's clicks can't be exported; null: they can."""
    return (
        F.when(speaking.isNull(), "export_requires_speaking_click")
        .when(target_bearded & anti.isNull(), "anti_click_required_beard")
        .when(include_anti & anti.isNull(), "anti_click_not_registered")
    )


def display_frames(listed: DataFrame, frames: DataFrame, speech: DataFrame, key: str, tolerance_ms: int = 50) -> DataFrame:
    """timeline() of display frames (key, i, pts_ms): with the faces of the analysed frame (key, pts_ms, faces) of the same time, none if there is none, and vad, whether speech is near."""
    faces = frames.groupBy(key, "pts_ms").agg(F.first("faces").alias("faces"))
    both = listed.join(faces, [key, "pts_ms"], "left")
    none = F.array().cast(frames.schema["faces"].dataType)
    seen = near_speech(both.withColumn("faces", F.coalesce("faces", none)), speech, [key, "i"], "pts_ms", tolerance_ms, key)
    return timeline(seen.withColumnRenamed("near", "vad"))


def timeline(frames: DataFrame, near: str = "vad") -> DataFrame:
    """Frames (..., pts_ms, vad, faces: array of structs bbox, mar, det_score, yaw) with faces rounded for display."""
    shown = F.transform("faces", lambda f: F.struct(
        F.transform(f["bbox"], lambda v: F.bround(v, 1)).alias("bbox"), F.bround(f["mar"], 4).alias("mar"),
        F.bround(f["det_score"], 3).alias("det"), F.bround(f["yaw"], 1).alias("yaw")))
    return frames.withColumn("faces", shown).withColumn(near, F.coalesce(near, F.lit(False)))


def resume_points(entries: DataFrame, keys: list[str], verified: bool = True) -> DataFrame:
    """Per session the seq that comes next and the hash to link it to; with `verified` a broken chain fails, else the tail is believed."""
    tail = entries.groupBy(*keys).agg((F.max("seq") + 1).alias("next_seq"), F.max_by("entry_sha256", "seq").alias("prev_sha256"))
    if not verified:
        return tail
    checked = tail.join(verify(entries, keys).select(*keys, "first_bad"), keys)
    return required(checked, F.col("first_bad").isNull(), F.concat(F.lit("the log's chain breaks at seq "), F.col("first_bad").cast("string"))).drop("first_bad")


def starts(sessions: DataFrame, resumed: DataFrame, keys: list[str]) -> DataFrame:
    """resume_points for all sessions: one without entries begins at 0 with the genesis hash."""
    out = sessions.select(*keys).distinct().join(resumed, keys, "left")
    return out.select(*keys, F.coalesce("next_seq", F.lit(0).cast("long")).alias("next_seq"), F.coalesce("prev_sha256", F.lit(GENESIS)).alias("prev_sha256"))


def notices(entries: DataFrame) -> DataFrame:
    """Warnings, halts and drift notices of the log, with kind."""
    return entries.where(F.col("operation").isin(*NOTICES)).withColumn("kind", F.col("operation"))


def batch_summary(files: DataFrame, speech: DataFrame, runs: DataFrame, segments: DataFrame, excluded: DataFrame) -> DataFrame:
    """Per file, and as file_index null for the batch: duration, speech, HIGH, clean and excluded time, and how many of each.

    All but files (file_index, duration_ms) are spans (file_index, start_ms, end_ms).  Each is added up by file before it meets
    the others, and the batch's row comes from the same sums, so nothing is gathered but one row a file.
    """
    out = files.select("file_index", "duration_ms")
    for name, df in (("speech", speech), ("high", runs), ("clean", segments), ("excluded", excluded)):
        per = df.groupBy("file_index").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias(f"{name}_ms"), F.count("*").alias(f"n_{name}"))
        out = out.join(per, "file_index", "left").fillna(0, [f"{name}_ms", f"n_{name}"])
    columns = [c for c in out.columns if c != "file_index"]
    return out.rollup("file_index").agg(F.count("*").alias("files"), *(F.sum(c).alias(c) for c in columns))


def contamination_totals(runs: DataFrame, regions: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """Per key, and as key null for all: high_ms, contaminated_ms (under merged overlap regions), clean_ms, bridged_ms and n_bridged (gaps that were bridged)."""
    covered = overlap_ms(runs, regions, [key, "start_ms", "end_ms"], key)
    per = covered.groupBy(key).agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("high_ms"), F.sum("overlap_ms").alias("contaminated_ms"))
    gaps = decisions.where("reason = 'bridged'").groupBy(key).agg(F.sum("gap_ms").alias("bridged_ms"), F.count("*").alias("n_bridged"))
    out = per.withColumn("clean_ms", F.col("high_ms") - F.col("contaminated_ms")).join(gaps, key, "left").fillna(0, ["bridged_ms", "n_bridged"])
    return out.rollup(key).agg(*(F.sum(c).alias(c) for c in ("high_ms", "contaminated_ms", "clean_ms", "bridged_ms", "n_bridged")))


def excluded_text(regions: Column) -> Column:
    """The sentence for an excluded block, given the overlaps (start_ms, end_ms) that it meets."""
    spans = F.array_join(F.transform(regions, lambda r: F.format_string("%d-%d ms", r["start_ms"], r["end_ms"])), ", ")
    return F.when(F.size(regions) > 0, F.concat(F.lit("EXCLUDED: simultaneous speech in "), spans)).otherwise("EXCLUDED: overlapping speech")


def clean_text(duration_ms: Column, blocks: Column, bridged: Column) -> Column:
    """The sentence for a kept segment, with the gaps (start_ms, end_ms) that were bridged in it."""
    spans = F.array_join(F.transform(bridged, lambda r: F.format_string("%d-%d ms", r["start_ms"], r["end_ms"])), ", ")
    text = F.format_string("KEPT: %d ms, %d HIGH blocks, free of overlap", duration_ms, blocks)
    return F.when(F.size(bridged) > 0, F.concat(text, F.lit("; bridged gaps: "), spans)).otherwise(text)


def refusal_text(reason: Column, value: Column, limit: Column) -> Column:
    """A sentence for the operator on why a click or an export was refused, with the measured value ('?' if unknown) and the limit."""
    num = lambda places, c: F.when(c.isNull(), "?").otherwise(F.format_string(f"%.{places}f", c.cast("double")))
    say = {
        "click_outside_speaking_window": [F.lit("The target doesn't speak here; click where it clearly does.")],
        "seed_too_short": [F.lit("The speaking window lasts "), num(0, value), F.lit(" ms, and a seed needs "), num(0, limit), F.lit(" ms.")],
        "overlap_at_speaking_click": [F.lit("Other lips are open for "), num(0, value * 100), F.lit("% of the window; at most "), num(0, limit * 100), F.lit("% are allowed.")],
        "anti_click_matches_target": [F.lit("This face is like the target's (cosine "), num(3, value), F.lit(", from "), num(2, limit), F.lit("); click the other person.")],
        "target_lips_open_at_anti_click": [F.lit("The target's lips are open ("), num(3, value), F.lit(", from "), num(2, limit), F.lit("); it may be speaking.")],
        "no_audio_energy_at_anti_click": [F.lit("Nobody speaks at this time.")],
        "speaking_click_required_first": [F.lit("Register the speaking click first.")],
        "export_requires_speaking_click": [F.lit("No speaking click is registered.")],
        "anti_click_required_beard": [F.lit("With the target's lips unseen an anti click is required.")],
        "anti_click_not_registered": [F.lit("The anti click to be exported isn't registered.")],
        "no_face_at_speaking_click": [F.lit("No face is seen within "), num(0, limit), F.lit(" ms of this time; click inside a face's box.")],
        "no_face_at_anti_click": [F.lit("No face is seen within "), num(0, limit), F.lit(" ms of this time; the other person has to be in the picture.")],
        "click_not_in_solo_speech": [F.lit("With the target's lips unseen a seed needs "), num(0, limit), F.lit(" ms of speech with no other face in the picture.")],
        "invalid_request": [F.lit("The request is malformed: pts_ms must be an integer, x and y numbers, type 'speaking' or 'anti'.")],
    }
    out = F.lit(None).cast("string")
    for name, parts in say.items():
        out = F.when(reason == name, F.concat(*parts)).otherwise(out)
    return out


def no_anti_text(strong_without_anti_ms: int = 60_000, strong_ms: int = 45_000) -> str:
    """The warning for a session that is exported without an anti click."""
    return f"Without an anti click STRONG takes {strong_without_anti_ms // 1000} s of verified speech, not {strong_ms // 1000} s; only do so if the other person is never in the picture."
