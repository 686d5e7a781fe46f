"""Keyed clip indexes, exact predecessors, merges and anti-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.functions.paths import parse_clip_name

CLIP = ["clip_path", "clip_filename", "video_id", "clip_number", "start_time", "end_time", "duration", "description"]
KEY = ["video_id", "clip_number"]


def last_wins(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of every key, nulls in it included; aggregated map-side, so that no group is gathered."""
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*key, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(df.columns)


def valid_key(strict: bool = True) -> Column:
    """Whether a row can be indexed; strict also asks for a non-empty video id."""
    both = F.col("video_id").isNotNull() & F.col("clip_number").isNotNull()
    return both & (F.col("video_id") != "") if strict else both


def clip_index(rows: DataFrame, order: str, strict: bool = True) -> DataFrame:
    """One described clip per (video_id, clip_number), the last in ``order``."""
    return last_wins(rows.where(valid_key(strict)).select(*CLIP, order), KEY, order).drop(order)


def clip_files(paths: DataFrame, path: str = "clip_path") -> DataFrame:
    """(video_id, clip_number, file) of a listing's clip files; the smallest path of a key."""
    named = paths.select(F.col(path).alias("file")).where("file is not null").withColumn("x", parse_clip_name(F.col("file")))
    return named.select("x.video_id", "x.clip_number", "file").where("clip_number > 0").groupBy(*KEY).agg(F.min("file").alias("file"))


def pair_with_previous(described: DataFrame, files: DataFrame, include_missing: bool = False, trim_ids: bool = False) -> DataFrame:
    """(previous_clip, current_clip, has_previous, previous_has_description) of every clip after the first.

    The predecessor is the clip numbered exactly one less. Its file must exist: with a description it is the
    described row, else a stub from the file's name. Without a file the pair is dropped, or kept with a null
    predecessor and a null last column if ``include_missing``. ``trim_ids`` matches files by video ids without
    trailing underscores, as parsed file names lack the one that ids may end with.
    """
    listed = lambda c: F.rtrim(c, F.lit("_")) if trim_ids else c
    current = described.where("clip_number > 1").select(
        F.col("video_id").alias("video_id"), (F.col("clip_number") - 1).alias("clip_number"), F.struct(*CLIP).alias("current_clip")
    )
    known = described.select(*KEY, F.struct(*CLIP).alias("known"))
    name = parse_clip_name(F.col("file"))
    stub = F.struct(
        F.col("file").alias("clip_path"), F.substring_index("file", "/", -1).alias("clip_filename"), "video_id", "clip_number",
        name["start_time"].alias("start_time"), name["end_time"].alias("end_time"), name["duration"].alias("duration"), F.lit(None).cast("string").alias("description"),
    )
    found = files.groupBy(listed(F.col("video_id")).alias("_v"), F.col("clip_number").alias("_n")).agg(F.min("file").alias("file"))  # ids may only differ in underscores
    on = (listed(F.col("video_id")) == F.col("_v")) & (F.col("clip_number") == F.col("_n"))
    joined = current.join(found, on, "left" if include_missing else "inner").join(known, KEY, "left")
    previous = F.when(F.col("file").isNull(), None).otherwise(F.coalesce("known", stub))
    said = F.when(F.col("file").isNotNull(), F.coalesce(F.col("known.description"), F.lit("")) != "")
    return joined.select(previous.alias("previous_clip"), "current_clip", F.col("file").isNotNull().alias("has_previous"), said.alias("previous_has_description"))


def with_scene(pairs: DataFrame, descriptions: DataFrame) -> DataFrame:
    """``pairs`` with the column scene: the description indexed under the current clip's key, '' if none."""
    index = descriptions.select(F.col("video_id").alias("_v"), F.col("clip_number").alias("_n"), F.col("description").alias("scene"))
    on = (F.col("current_clip.video_id") == F.col("_v")) & (F.col("current_clip.clip_number") == F.col("_n"))
    return pairs.join(index, on, "left").drop("_v", "_n").withColumn("scene", F.coalesce("scene", F.lit("")))


def unprocessed(tasks: DataFrame, task_key: Column, done: DataFrame, done_key: Column) -> DataFrame:
    """Tasks whose key is not among the done ones; a task without a key is never done. Repeats stay."""
    keys = done.select(done_key.alias("_done")).where("_done is not null").distinct()
    keyed = tasks.withColumn("_task", task_key)
    left = keyed.where("_task is not null").join(keys, F.col("_task") == F.col("_done"), "left_anti")
    return left.unionByName(keyed.where("_task is null")).drop("_task")  # rows without a key are in no join


def presence(rows: DataFrame, key: Column, listing: DataFrame, listed: Column) -> DataFrame:
    """``rows`` with the column present: whether the key is in the listing."""
    keys = listing.select(listed.alias("_listed")).where("_listed is not null").distinct()
    keyed = rows.withColumn("_key", key)
    met = keyed.where("_key is not null").join(keys, F.col("_key") == F.col("_listed"), "left").withColumn("present", F.col("_listed").isNotNull()).drop("_key", "_listed")
    return met.unionByName(keyed.where("_key is null").withColumn("present", F.lit(False)).drop("_key"))  # rows without a key are in no join
