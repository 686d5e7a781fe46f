"""Listings of media files: names and sizes only, never their content."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions.paths import suffix

#: Fixed value: the suffixes that count as video.
VIDEO_SUFFIXES = (".mp4", ".avi", ".mov", ".mkv", ".flv", ".wmv", ".webm", ".m4v", ".mpg", ".mpeg", ".3gp", ".ts")


def media_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, length, modified) of a folder's files; the content column is pruned from the scan.

    Files of no bytes are no media and are not listed.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def with_suffix(files: DataFrame, suffixes: tuple[str, ...], column: str = "path", mixed_case: bool = True) -> DataFrame:
    """Files with one of the suffixes; without ``mixed_case`` only all-lower and all-upper spellings count."""
    ext = suffix(F.col(column))
    wanted = F.lower(ext).isin(*suffixes) if mixed_case else ext.isin(*suffixes, *(s.upper() for s in suffixes))
    return files.where(wanted)


def sorted_files(files: DataFrame, suffixes: tuple[str, ...], column: str = "path", mixed_case: bool = False) -> DataFrame:
    return with_suffix(files, suffixes, column, mixed_case).select(column).distinct().orderBy(column)


def suffix_counts(files: DataFrame, column: str = "path") -> DataFrame:
    return files.groupBy(F.lower(suffix(F.col(column))).alias("suffix")).agg(F.count("*").alias("n_files"))


def plain_path(column: str) -> Column:
    """A local file's path without its scheme."""
    return F.regexp_replace(column, r"^file:/+", "/")


def count_videos(spark: SparkSession, folder: str) -> tuple[int, list[str]]:
    """Number and sorted names of a folder's videos, any case of suffix; nothing for a folder that is not there."""
    try:
        files = spark.read.format("binaryFile").load(folder).inputFiles()
    except Exception as x:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(x):
            return 0, []
        raise
    names = sorted(unquote(f.rsplit("/", 1)[-1]) for f in files)
    kept = [n for n in names if n.lower().endswith(VIDEO_SUFFIXES)]
    return len(kept), kept
