"""Queries of the model and cutting stages, run with deterministic stand-ins for models and media, with their SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.operators import inference as M
from cliplake.operators.media import EchoBackend, cut_summary
from cliplake.plans.clip_queries import _parse, sql_strip
from cliplake.session import read_table

ASKED = "问题1：谁先开枪？\n答案1：突破手。\n问题2：在哪里？\n答案2：中路。"


def _files(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "clip_qa_pairs").select(F.col("source_clip_path").alias("path"))


def describe_stage(s: SparkSession, d: str) -> DataFrame:
    """Clips named by the answers that no described clip has, described by the stand-in."""
    done = read_table(s, d, "clip_descriptions_copy").select("clip_path", "clip_filename")
    told, _ = M.describe_clips(_files(s, d), partial(M.EchoVision, " {} frames up to {} "), partial(M.StillFrames, 6), done)
    return told.select("clip_path", "video_id", "clip_number", "start_time", "end_time", "description")


def judge_stage(s: SparkSession, d: str) -> DataFrame:
    return M.judge_videos(_files(s, d), partial(M.EchoVision, "- 是否是CS2或CSGO：是\n- 判断理由：{} 帧，到 {}"), partial(M.StillFrames, 2))


def ask_stage(s: SparkSession, d: str) -> DataFrame:
    """Two questions about every description of a clip without answers; an empty description falls back to its source."""
    clips = read_table(s, d, "clip_descriptions_copy").withColumn("desc", F.concat(F.lit("来源 "), "source_file"))
    made = M.generate_qa(clips, partial(EchoBackend, ASKED), read_table(s, d, "clip_qa_pairs"))
    return made.groupBy("source_clip_path", "question", "answer").agg(F.count("*").alias("n_rows"))


def device_assignment(s: SparkSession, d: str) -> DataFrame:
    return M.assign_devices(read_table(s, d, "clip_qa_pairs").select("qa_id"), ["qa_id"], 3)


def cut_accounting(s: SparkSession, d: str) -> DataFrame:
    """The accounting of a cutting run whose outcomes are drawn from the tables."""
    rows = read_table(s, d, "clip_descriptions_copy")
    k = F.col("row_id") % 7
    status = F.when(k == 0, "failed").when(k == 1, "exists").when(k < 5, "copied").when(k == 5, "encoded").otherwise("failed: timeout")
    cuts = rows.where("video_id is not null").select(F.col("video_id").alias("source"), status.alias("status"))
    error = F.when(F.coalesce(F.col("category"), F.lit("")) == "", "no category")
    return cut_summary(read_table(s, d, "video_sources").select(F.col("video_id").alias("path"), error.alias("error")), cuts)


QUERIES = {f.__name__: f for f in (describe_stage, judge_stage, ask_stage, device_assignment, cut_accounting)}

_STATUS = "row_id % 7 BETWEEN 1 AND 5"

SQL = {
    "describe_stage": f"""SELECT clip_path, {_parse("clip_path")}, '6 frames up to 149' AS description FROM (SELECT DISTINCT source_clip_path AS clip_path FROM clip_qa_pairs WHERE source_clip_path IS NOT NULL)
 WHERE clip_path NOT IN (SELECT coalesce(nullif(clip_path, ''), nullif(clip_filename, '')) FROM clip_descriptions_copy WHERE coalesce(nullif(clip_path, ''), nullif(clip_filename, '')) IS NOT NULL)""",
    "judge_stage": """SELECT DISTINCT source_clip_path AS video_path, regexp_replace(source_clip_path, '^.*/', '') AS video_filename, true AS is_cs2_csgo, '- 是否是CS2或CSGO：是' || chr(10) || '- 判断理由：2 帧，到 49' AS reason
 FROM clip_qa_pairs WHERE source_clip_path IS NOT NULL""",
    "ask_stage": f"""SELECT k AS source_clip_path, question, answer, count(*) AS n_rows FROM (
 SELECT coalesce(nullif(clip_path, ''), nullif(clip_filename, '')) AS k, coalesce(nullif(description, ''), nullif('来源 ' || source_file, '')) AS told FROM clip_descriptions_copy) c,
 (VALUES ('谁先开枪？', '突破手。'), ('在哪里？', '中路。')) q(question, answer)
 WHERE coalesce({sql_strip("told")}, '') <> '' AND k IS NOT NULL AND NOT EXISTS (SELECT 1 FROM clip_qa_pairs p WHERE nullif(p.source_clip_path, '') = k) GROUP BY ALL""",
    "device_assignment": "SELECT qa_id, row_number() OVER (ORDER BY qa_id) - 1 AS ordinal, CAST((row_number() OVER (ORDER BY qa_id) - 1) % 3 AS INTEGER) AS device FROM clip_qa_pairs",
    "cut_accounting": f"""WITH v AS (SELECT CAST(count_if(coalesce(category, '') <> '') AS BIGINT) AS videos_processed, CAST(count_if(coalesce(category, '') = '') AS BIGINT) AS videos_failed FROM video_sources),
 c AS (SELECT CAST(count(DISTINCT CASE WHEN {_STATUS} THEN video_id END) AS BIGINT) AS videos_cut, CAST(count_if({_STATUS}) AS BIGINT) AS clips_created, CAST(count_if(NOT ({_STATUS})) AS BIGINT) AS clips_failed FROM clip_descriptions_copy WHERE video_id IS NOT NULL)
 SELECT * FROM v, c""",
}
