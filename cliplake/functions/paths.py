"""Paths and file names of clips and videos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.functions.rounding import fixed2

#: Fixed value: layout of a clip's file name without its suffix.
CLIP_NAME = r"^(.+?)__clip(\d+)_([\d.]+)-([\d.]+)$"
#: Fixed value: a name that carries its identifier in brackets.
BRACKETED = r"^.*?\[([A-Za-z0-9_]+)\]\.([^.]+)$"


def basename(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def suffix(c: Column) -> Column:
    """The last dot and what follows it; empty for none and for a leading dot only."""
    return F.regexp_extract(basename(c), r"^.+(\.[^.]+)$", 1)


def stem(c: Column) -> Column:
    return F.regexp_replace(basename(c), r"(?<=.)\.[^.]+$", "")


def sidecar(c: Column) -> Column:
    """The JSON file beside a video."""
    return F.regexp_replace(c, r"(?i)\.mp4$", ".json")


def rebase(c: Column, base: str) -> Column:
    """``base/name`` for a path that does not start with ``base``; an empty base changes nothing."""
    return c if not base else F.when(c.startswith(base), c).otherwise(F.concat(F.lit(f"{base}/"), basename(c)))


def parse_clip_name(c: Column) -> Column:
    """Struct (video_id, clip_number, start_time, end_time, duration) of a clip's file name.

    A name of another layout is its own video id with number 0 and times 0.0; a malformed number gives null.
    """
    name = stem(c)
    hit = name.rlike(CLIP_NAME)
    part = lambda k: F.regexp_extract(name, CLIP_NAME, k)
    start, end = part(3).try_cast("double"), part(4).try_cast("double")
    number = F.when(hit, part(2).try_cast("long")).otherwise(F.lit(0).cast("long"))
    return F.struct(
        F.when(hit, part(1)).otherwise(name).alias("video_id"),
        number.alias("clip_number"),
        F.when(hit, start).otherwise(F.lit(0.0)).alias("start_time"),
        F.when(hit, end).otherwise(F.lit(0.0)).alias("end_time"),
        F.when(hit, end - start).otherwise(F.lit(0.0)).alias("duration"),
    )


def clip_name(video: Column, number: Column, start: Column, end: Column, ext: str = ".mp4") -> Column:
    """``{video}_clip{0001}_{s.ss}-{e.ee}``; a video id that lacks its trailing underscore gets it."""
    head = F.when(video.endswith("_"), video).otherwise(F.concat(video, F.lit("_")))
    return F.concat(head, F.lit("_clip"), F.format_string("%04d", number), F.lit("_"), fixed2(start), F.lit("-"), fixed2(end), F.lit(ext))


def commentary_name(video: Column, start: Column, end: Column) -> Column:
    return F.concat(video, F.lit("_"), fixed2(start), F.lit("-"), fixed2(end), F.lit("_2.0fps.mp4"))


def legacy_name(video: Column, start: Column, end: Column) -> Column:
    """Name in milliseconds, with never more than two underscores behind the id."""
    gap = F.when(video.endswith("_"), F.lit("_")).otherwise(F.lit("__"))
    ms = lambda x: (x * 1000).cast("long").cast("string")
    return F.concat(video, gap, ms(start), F.lit("_"), ms(end), F.lit(".mp4"))


def rename_plan(files: DataFrame, path: str = "path") -> DataFrame:
    """(path, new_name, reason) of every file: its bracketed identifier with the suffix.

    The smallest path of an identifier keeps the plain name, the smallest of each further folder is prefixed
    with the folder (``root`` at the top), and any other also carries a digest of its path, so that no two
    files of a run share a name. Files without an identifier have a null name and a reason.
    """
    p = F.col("path")
    folder = F.regexp_extract(p, r"([^/]+)/[^/]*$", 1)
    named = (
        files.select(F.col(path).alias("path"))
        .where(p.isNotNull())
        .distinct()
        .withColumn("id", F.nullif(F.regexp_extract(basename(p), BRACKETED, 1), F.lit("")))
        .withColumn("ext", F.regexp_extract(basename(p), BRACKETED, 2))
        .withColumn("folder", F.when(folder == "", "root").otherwise(folder))
    )
    good = named.where("id is not null")
    by_folder = good.groupBy("id", "ext", "folder").agg(F.min("path").alias("in_folder"))
    first = by_folder.groupBy("id", "ext").agg(F.min("in_folder").alias("first_path"))
    rows = good.join(by_folder, ["id", "ext", "folder"]).join(first, ["id", "ext"])
    plain, tail = F.concat("id", F.lit("."), "ext"), F.substring(F.md5("path"), 1, 8)
    name = (
        F.when(p == F.col("first_path"), plain)
        .when(p == F.col("in_folder"), F.concat("folder", F.lit("_"), plain))
        .otherwise(F.concat("folder", F.lit("_"), "id", F.lit("_"), tail, F.lit("."), "ext"))
    )
    reason = F.lit("no identifier in brackets")
    return rows.select("path", name.alias("new_name"), F.lit(None).cast("string").alias("reason")).unionByName(
        named.where("id is null").select("path", F.lit(None).cast("string").alias("new_name"), reason.alias("reason"))
    )
