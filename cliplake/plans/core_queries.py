"""Queries of the general problems that are part of the core, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.operators.intervals import interval_gaps, merge_intervals
from cliplake.session import read_table


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = interval_gaps(read_table(spark, sf_dir, "subtitle_cues"), "video_id", "start_ms", "end_ms")
    return gaps.select("video_id", F.col("gap_start").alias("gap_start_ms"), F.col("gap_end").alias("gap_end_ms")).distinct()


def p7_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_intervals(read_table(spark, sf_dir, "subtitle_cues"), "video_id", "start_ms", "end_ms")


_REACH = """
WITH cues AS (
  SELECT video_id, start_ms AS s, end_ms AS e FROM subtitle_cues
  WHERE video_id IS NOT NULL AND start_ms IS NOT NULL AND end_ms > start_ms
), reach AS (
  SELECT *, max(e) OVER (PARTITION BY video_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM cues
)
"""

SQL = {
    "p7_found": _REACH + "SELECT DISTINCT video_id, r AS gap_start_ms, s AS gap_end_ms FROM reach WHERE s > r",
    "p7_periods": _REACH
    + """, isl AS (
  SELECT *, sum(CASE WHEN r IS NULL OR s > r THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM reach
)
SELECT video_id, min(s) AS period_start, max(e) AS period_end, count(*) AS n_intervals FROM isl GROUP BY video_id, k""",
}

QUERIES = {"p7_found": p7_found, "p7_periods": p7_periods}
