"""Per-video subtitle files: a JSON array of cues, the file's stem being the video's id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions.paths import stem
from cliplake.operators.segment import clean_cues
from cliplake.schemas import CUE


def read_subtitles(spark: SparkSession, path: str, title_suffix: str = "", category: str = "game") -> DataFrame:
    """(video, title, category, subtitles) of every ``.json`` file with at least one usable cue.

    A malformed file, one that is no array, or one without a usable cue gives no row.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value").where(F.col("name").endswith(".json"))
    cues = clean_cues(F.from_json("value", f"array<struct<{CUE.replace(' ', ':')}>>".replace(",:", ",")))
    rows = files.select(stem(F.col("name")).alias("video"), cues.alias("subtitles")).where(F.size("subtitles") > 0)
    return rows.select("video", F.concat("video", F.lit(title_suffix)).alias("title"), F.lit(category).alias("category"), "subtitles")
