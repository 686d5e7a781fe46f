"""End-to-end pipelines over files, and the metrics of their runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cliplake.functions.paths import clip_name, rename_plan, stem, suffix
from cliplake.functions.records import RecordOptions, commentary_record, legacy_record, merged_record, pair_record, qa_record
from cliplake.functions.text import is_blank, or_else
from cliplake.operators import inference as M
from cliplake.operators.media import cut_clips, cut_summary, probe_media
from cliplake.operators.ordinal import dense_ordinal, shuffle_key, stride_shard
from cliplake.operators.pairing import clip_files, clip_index, last_wins, pair_with_previous, valid_key, with_scene
from cliplake.operators.segment import commentary_clips, contiguous_tiles
from cliplake.schemas import CLIP, DESCRIBED, LEGACY_CLIP, PAIR, QA, RECORD
from cliplake.session import write_out
from cliplake.sources.jsonl import BAD, lines, parsed, read_jsonl, sniffed
from cliplake.sources.listing import VIDEO_SUFFIXES, media_files, plain_path, with_suffix
from cliplake.sources.sinks import run_file_actions, write_jsonl
from cliplake.sources.subtitles import read_subtitles


def counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with metrics that are gathered while it is written; read them from the observation's ``get``."""
    seen = Observation(name)
    return df.observe(seen, *(c.alias(n) for n, c in metrics.items())), seen


def _write(df: DataFrame, out: str, name: str, mode: str = "overwrite") -> dict[str, int]:
    rows, seen = counted(df, name, written=F.count(F.lit(1)))
    write_jsonl(rows, out, mode, keep_nulls=True)
    return seen.get


def _convert(rows: DataFrame, made: Column, out: str, name: str, order: list[str], **skipped: Column) -> dict[str, int]:
    """Writes the records that ``made`` gives of the parsed rows, in order; counts all rows, bad lines and skips.

    A skip is charged to the first reason that holds; a row without a record and without a reason is ``other``.
    """
    good = F.col(BAD).isNull()
    reason = F.when(~good, "malformed")
    for label, c in skipped.items():
        reason = reason.when(c, label)
    made_rows = write_out(rows.select(*order, F.when(good, made).alias("r"), reason.alias("_reason")))  # made once, then counted and sorted
    lost = [F.count_if(F.col("r").isNull() & (F.col("_reason") == k)).alias(k) for k in ("malformed", *skipped)]
    other = F.count_if(F.col("r").isNull() & F.col("_reason").isNull()).alias("other")
    said = made_rows.agg(F.count(F.lit(1)).alias("total"), other, *lost).first().asDict()
    return said | _write(made_rows.where("r is not null").orderBy(*order).select("r.*"), out, name)


def _parsed_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every non-blank line with its fields, or with its text in the column of bad lines."""
    return parsed(lines(spark, path, exact=False).where(~is_blank("line")), "line", schema)


def commentary(spark: SparkSession, subtitles: str, out: str, part: int = 1, parts: int = 1, options: RecordOptions = RecordOptions(), **cuts) -> dict[str, int]:
    """Subtitle files to commentary records; ``part`` of ``parts`` takes every parts-th video by name."""
    videos = dense_ordinal(read_subtitles(spark, subtitles, title_suffix="_"), ["video"])
    clips = commentary_clips(stride_shard(videos, "ordinal", part, parts), **cuts)
    return _write(clips.select(commentary_record(F.struct(*clips.columns), options).alias("r")).select("r.*"), out, "commentary")


def pair_clips(spark: SparkSession, descriptions: str, clip_dir: str, out: str, include_missing: bool = False, trim_ids: bool = False) -> dict[str, int]:
    """Described clips (JSON array or lines) and a clip folder to pairs with their exact predecessors."""
    rows = dense_ordinal(sniffed(spark, descriptions, CLIP), ["file", "line_no"])
    files = clip_files(with_suffix(media_files(spark, clip_dir), (".mp4",)).select(F.col("path").alias("clip_path")))
    made = pair_with_previous(clip_index(rows, "ordinal"), files, include_missing, trim_ids)
    return _write(made.orderBy("current_clip.video_id", "current_clip.clip_number"), out, "pairs")


def pairs_to_training(spark: SparkSession, pairs: str, out: str, skip_no_previous: bool = False, options: RecordOptions = RecordOptions()) -> dict[str, int]:
    """Pairs to training records; with ``skip_no_previous`` only those whose predecessor has a description."""
    rows = _parsed_lines(spark, pairs, PAIR)
    alone = or_else("previous_clip.description").isNull()
    made = pair_record(F.col("previous_clip"), F.col("current_clip"), options)
    made = F.when(~alone, made) if skip_no_previous else made
    # as its fixed order has it, a skip counts as one of a missing predecessor wherever there is none
    return _convert(rows, made, out, "pairs to training", ["file", "line_no"], no_previous=alone, no_description=is_blank("current_clip.description"))


def qa_to_training(spark: SparkSession, qa: str, out: str, options: RecordOptions = RecordOptions()) -> dict[str, int]:
    path = or_else("source_clip_path", "clip_path")
    made = qa_record(F.col("question"), F.col("answer"), path, F.col("video_id"), F.col("start_time"), F.col("end_time"), options)
    return _convert(
        _parsed_lines(spark, qa, QA), made, out, "answers to training", ["file", "line_no"], no_question=is_blank("question"), no_answer=is_blank("answer"), no_path=path.isNull()
    )


def merge_to_training(spark: SparkSession, pairs: str, descriptions: str, out: str, skip_no_description: bool = False, options: RecordOptions = RecordOptions()) -> dict[str, int]:
    """Pairs and scene descriptions to records that answer with both; ``skip_no_description`` needs a scene."""
    index, _ = read_jsonl(spark, descriptions, CLIP, exact=False)
    numbered = dense_ordinal(index.where(valid_key(False)).select("video_id", "clip_number", "description", "file", "line_no"), ["file", "line_no"]).drop("file", "line_no")
    rows = with_scene(_parsed_lines(spark, pairs, PAIR), last_wins(numbered, ["video_id", "clip_number"], "ordinal"))
    made = merged_record(F.col("scene"), F.col("previous_clip"), F.col("current_clip"), options)
    made = F.when(F.col("current_clip").isNotNull() & (~is_blank("scene") if skip_no_description else F.lit(True)), made)
    return _convert(rows, made, out, "merged training", ["file", "line_no"], no_current=F.col("current_clip").isNull(), no_description=is_blank("scene"), empty_answer=is_blank("current_clip.description"))


def legacy_to_training(spark: SparkSession, clips: str, out: str, options: RecordOptions = RecordOptions()) -> dict[str, int]:
    """Commentary clips (video, content [start, end, words], previous, title, category) to the older record layout."""
    c = lambda k: F.try_element_at("content", F.lit(k))
    start, end, said = c(1).try_cast("double"), c(2).try_cast("double"), c(3)
    whole = (F.size("content") == 3) & start.isNotNull() & end.isNotNull() & F.col("video").isNotNull()
    made = F.when(whole, legacy_record(F.col("video"), start, end, said, F.col("previous"), F.col("title"), F.col("category"), options))
    return _convert(_parsed_lines(spark, clips, LEGACY_CLIP), made, out, "legacy training", ["file", "line_no"], bad_content=~F.coalesce(whole, F.lit(False)))


def array_to_lines(spark: SparkSession, path: str, out: str) -> dict[str, int]:
    """The objects of JSON array files as JSON lines, whatever their fields."""
    elements = F.posexplode(F.from_json("value", "array<variant>")).alias("at", "v")
    items = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value").select("file", elements)
    rows = items.select("file", "at", F.to_json("v").alias("value")).where(F.col("value").startswith("{"))
    told, seen = counted(rows.orderBy("file", "at").select("value"), "array to lines", written=F.count(F.lit(1)))
    told.write.mode("overwrite").text(out)
    return seen.get


def _done(spark: SparkSession, out: str, schema: str) -> DataFrame | None:
    """The rows that an earlier run has written, or None."""
    try:
        return read_jsonl(spark, out, schema, exact=False)[0]
    except Exception as x:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(x):
            return None
        raise


def _videos(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = VIDEO_SUFFIXES) -> DataFrame:
    return with_suffix(media_files(spark, folder).select(plain_path("path").alias("path")), suffixes)


def describe(spark: SparkSession, clip_dir: str, out: str, model, frames=M.OpenCvFrames, resume: bool = True, most: int = 0) -> dict[str, int]:
    """A clip folder to described clips, in order of their paths; clips described by an earlier run are left out."""
    files = _videos(spark, clip_dir, (".mp4",)).orderBy("path")
    files = files.limit(most) if most else files
    done = _done(spark, out, CLIP) if resume else None
    told = write_out(M.describe_clips(files, model, frames, done)[0])
    total = files.count()
    before = 0 if done is None else done.select("clip_path").distinct().join(files.withColumnRenamed("path", "clip_path"), "clip_path", "left_semi").count()
    said = _write(told.orderBy("clip_path"), out, "describe", "append" if done is not None else "overwrite")
    return said | {"total": total, "done_before": before, "failed": total - before - said["written"]}


def judge(spark: SparkSession, video_dir: str, out: str, model, frames=M.OpenCvFrames, strict: bool = True, most: int = 0) -> dict[str, int]:
    """A video folder to verdicts, in order of their paths."""
    files = _videos(spark, video_dir).orderBy("path")
    found = write_out(M.judge_videos(files.limit(most) if most else files, model, frames, strict))
    said = _write(found.orderBy("video_path"), out, "judge")
    yes = found.where("is_cs2_csgo").count()
    return said | {"accepted": yes, "rejected": said["written"] - yes}


def ask(spark: SparkSession, descriptions: str, out: str, model, questions: int = 4, resume: bool = True) -> dict[str, int]:
    """Described clips to question and answer rows; clips that an earlier run has rows of are left out."""
    rows, bad = read_jsonl(spark, descriptions, DESCRIBED, exact=False)
    done = _done(spark, out, QA) if resume else None
    made = write_out(M.generate_qa(rows, model, done, questions))
    return _write(made.orderBy("source_clip_path", "question"), out, "ask", "append" if done is not None else "overwrite") | {"malformed": bad.count()}


def cut(spark: SparkSession, video_dir: str, out_dir: str, least: float = 6.0, most: float = 15.0, seed: int = 42, style: str = "fast", durations: DataFrame | None = None) -> dict[str, int]:
    """A video folder to clips of random length; ``durations`` (path, duration, error) replace the probe.

    Clips that are there already are not cut again.
    """
    videos = write_out(probe_media(_videos(spark, video_dir)) if durations is None else durations)
    tiles = contiguous_tiles(videos.where("duration is not null"), "path", "duration", least, most, seed)
    # the target's name is the source's with the tile's number and times
    name = clip_name(stem(F.col("path")), F.col("tile"), F.col("start_time"), F.col("end_time"), suffix(F.col("path")))
    plan = tiles.select(F.col("path").alias("source"), F.concat(F.lit(out_dir.rstrip("/") + "/"), name).alias("target"), F.col("start_time").alias("start"), F.col("end_time").alias("end"))
    cuts = write_out(cut_clips(plan, style=style))
    failed = videos.select("path", F.when(F.col("duration").isNull(), F.coalesce("error", F.lit("no duration"))).alias("error"))
    return cut_summary(failed, cuts).first().asDict()


def rename(spark: SparkSession, folder: str, out_dir: str, execute: bool = False) -> dict[str, int]:
    """Copies of a folder's ``.mp4`` and ``.json`` files under their bracketed identifiers; a dry run unless ``execute``."""
    files = with_suffix(media_files(spark, folder, recursive=True).select(plain_path("path").alias("path")), (".mp4", ".json"))
    plan = write_out(rename_plan(files))
    moves = plan.where("new_name is not null").select("path", F.concat(F.lit(out_dir.rstrip("/") + "/"), "new_name").alias("target"))
    done = run_file_actions(moves, "copy", target="target", execute=execute).groupBy(F.substring_index("status", ":", 1).alias("s")).count().collect()
    return {r.s: r["count"] for r in done} | {"skipped": plan.where("new_name is null").count()}


def merge_training_files(spark: SparkSession, inputs: list[str], out: str, shuffle: bool = False, seed: int = 42) -> dict[str, int]:
    """Record files one after the other, or in an order that depends on the seed and the rows' places only."""
    parts = [read_jsonl(spark, path, RECORD, exact=False)[0].withColumn("source_rank", F.lit(k)) for k, path in enumerate(inputs)]
    rows = reduce(DataFrame.unionByName, parts)
    place = F.concat_ws(":", "source_rank", "file", "line_no")
    order = [shuffle_key(place, seed)] if shuffle else ["source_rank", "file", "line_no"]
    return _write(rows.orderBy(*order).drop("file", "line_no", "source_rank"), out, "merged files")


def audit_videos(spark: SparkSession, path: str, most: int = 50) -> DataFrame:
    """(line_no, kind): the first records whose ``video`` is neither absent, a string nor a list of strings."""
    from cliplake.sources.jsonl import audit_field

    return audit_field(lines(spark, path), "line_no", "line", "video", most)
