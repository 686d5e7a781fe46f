"""Queries of the clip pipeline: names, pairing, merging, records, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import paths as P
from cliplake.functions import text as T
from cliplake.functions.records import (
    ADVICE,
    OPENING,
    PREVIOUS_ADVICE,
    RecordOptions,
    legacy_record,
    merged_record,
    pair_record,
    qa_record,
)
from cliplake.operators import pairing as J
from cliplake.session import read_table

OPTIONS = RecordOptions()
W = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{W}+|{W}+$', '', 'g')"


def _clips(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "clip_descriptions_copy")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "clip_pairs_all")


def _qa(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "clip_qa_pairs")


def _flat(rows: DataFrame, key: str, made: Column) -> DataFrame:
    r = rows.select(key, made.alias("r")).where("r is not null")
    return r.select(
        key, "r.video", F.col("r.conversations")[0]["value"].alias("human"), F.col("r.conversations")[1]["value"].alias("gpt"),
        "r.metadata.title", "r.metadata.video_start", "r.metadata.video_end", F.round("r.metadata.duration", 6).alias("duration"), "r.metadata.source_file",
    )


# names and paths


def clip_name_parse(s: SparkSession, d: str) -> DataFrame:
    x = P.parse_clip_name(F.col("clip_filename"))
    rows = _clips(s, d).where("clip_filename is not null").select("row_id", x.alias("x"))
    return rows.select("row_id", "x.video_id", "x.clip_number", "x.start_time", "x.end_time", F.round("x.duration", 6).alias("duration"))


def clip_name_format(s: SparkSession, d: str) -> DataFrame:
    c = _clips(s, d).where("video_id is not null and clip_number is not null")
    made = P.clip_name(F.col("video_id"), F.col("clip_number"), F.col("start_time"), F.col("end_time"))
    return c.select("row_id", made.alias("clip_name"), P.commentary_name(F.col("video_id"), F.col("start_time"), F.col("end_time")).alias("commentary_name"))


def legacy_name_format(s: SparkSession, d: str) -> DataFrame:
    c = _clips(s, d).where("video_id is not null")
    return c.select("row_id", P.legacy_name(F.col("video_id"), F.col("start_time"), F.col("end_time")).alias("legacy_name"))


def path_parts(s: SparkSession, d: str) -> DataFrame:
    p = F.col("clip_path")
    return _clips(s, d).where("clip_path is not null").select(
        "row_id", P.basename(p).alias("basename"), P.stem(p).alias("stem"), P.suffix(p).alias("suffix"), P.sidecar(p).alias("sidecar"), P.rebase(p, OPTIONS.video_base).alias("rebased")
    )


def _bracketed(s: SparkSession, d: str) -> DataFrame:
    folder = F.concat(F.lit("/raw/"), F.date_format("generated_at", "yyyyMMdd"), F.lit("/"))
    name = F.when(F.col("qa_id") % 7 == 0, "plain.mp4").otherwise(F.concat(F.lit("片段"), F.col("qa_id").cast("string"), F.lit("["), F.coalesce("video_id", F.lit("none")), F.lit("].mp4")))
    return _qa(s, d).where("generated_at is not null").select(F.concat(folder, name).alias("path"))


def identifier_extract(s: SparkSession, d: str) -> DataFrame:
    name = P.basename(F.col("path"))
    return _bracketed(s, d).select("path", F.regexp_extract(name, P.BRACKETED, 1).alias("identifier"), F.regexp_extract(name, P.BRACKETED, 2).alias("extension"))


def rename_plan(s: SparkSession, d: str) -> DataFrame:
    return P.rename_plan(_bracketed(s, d)).select("path", "new_name", "reason")


# keyed indexes, predecessors, merges


def last_wins_dedupe(s: SparkSession, d: str) -> DataFrame:
    rows = _clips(s, d).where(J.valid_key()).select("video_id", "clip_number", "row_id", "description", "clip_path")
    return J.last_wins(rows, ["video_id", "clip_number"], "row_id")


def _index(s: SparkSession, d: str) -> DataFrame:
    return J.clip_index(_clips(s, d), "row_id")


def _files(s: SparkSession, d: str) -> DataFrame:
    return J.clip_files(_clips(s, d).select("clip_path").union(_qa(s, d).select(F.col("source_clip_path").alias("clip_path"))))


def _paired(s: SparkSession, d: str, include: bool) -> DataFrame:
    made = J.pair_with_previous(_index(s, d), _files(s, d), include, trim_ids=True)
    return made.select(
        F.col("current_clip.video_id").alias("video_id"), F.col("current_clip.clip_number").alias("clip_number"), F.col("current_clip.clip_path").alias("clip_path"),
        F.col("previous_clip.clip_path").alias("previous_path"), F.col("previous_clip.description").alias("previous_description"),
        F.col("previous_clip.start_time").alias("previous_start"), "has_previous", F.col("previous_has_description").cast("string").alias("previous_has_description"),
    )


def pair_previous(s: SparkSession, d: str) -> DataFrame:
    return _paired(s, d, False)


def pair_previous_all(s: SparkSession, d: str) -> DataFrame:
    return _paired(s, d, True)


def pair_previous_stubs(s: SparkSession, d: str) -> DataFrame:
    """Described are the clips of the pairs only, so that predecessors without a description occur."""
    current = _pairs(s, d).where("current_clip is not null").select("current_clip.*", "pair_id")
    made = J.pair_with_previous(J.clip_index(current, "pair_id"), _files(s, d), trim_ids=True)
    return made.select(
        F.col("current_clip.video_id").alias("video_id"), F.col("current_clip.clip_number").alias("clip_number"), F.col("previous_clip.clip_path").alias("previous_path"),
        F.col("previous_clip.start_time").alias("previous_start"), "previous_has_description",
    )


def _scenes(s: SparkSession, d: str) -> DataFrame:
    index = J.last_wins(_clips(s, d).where(J.valid_key(False)).select("video_id", "clip_number", "description", "row_id"), ["video_id", "clip_number"], "row_id")
    return J.with_scene(_pairs(s, d), index)


def merge_left_join(s: SparkSession, d: str) -> DataFrame:
    return _scenes(s, d).select("pair_id", F.col("current_clip.video_id").alias("video_id"), F.col("current_clip.clip_number").alias("clip_number"), "scene")


def merge_counts(s: SparkSession, d: str) -> DataFrame:
    rows = _scenes(s, d).where("current_clip is not null")
    no_scene, no_advice = T.is_blank("scene"), T.is_blank("current_clip.description")
    return rows.agg(
        F.count("*").alias("total"), F.count_if(no_scene).alias("no_scene"), F.count_if(no_scene & no_advice).alias("empty_answer"),
        F.count_if(no_advice & ~no_scene).alias("no_advice_kept"), F.count_if(~(no_scene & no_advice)).alias("written"),
    )


# records


def pair_to_training(s: SparkSession, d: str) -> DataFrame:
    return _flat(_pairs(s, d), "pair_id", pair_record(F.col("previous_clip"), F.col("current_clip"), OPTIONS))


def merged_to_training(s: SparkSession, d: str) -> DataFrame:
    return _flat(_scenes(s, d), "pair_id", merged_record(F.col("scene"), F.col("previous_clip"), F.col("current_clip"), OPTIONS))


def qa_to_training(s: SparkSession, d: str) -> DataFrame:
    made = qa_record(*(F.col(c) for c in ("question", "answer", "source_clip_path", "video_id", "start_time", "end_time")), OPTIONS)
    return _flat(_qa(s, d), "qa_id", made)


def legacy_to_training(s: SparkSession, d: str) -> DataFrame:
    c = F.col("current_clip")
    rows = _pairs(s, d).where(~T.is_blank("current_clip.description") & F.col("current_clip.video_id").isNotNull())
    made = legacy_record(c["video_id"], c["start_time"], c["end_time"], c["description"], F.col("previous_clip.description"), F.lit("t"), F.lit("game"), OPTIONS)
    r = rows.select("pair_id", made.alias("r"))
    return r.select("pair_id", "r.video", F.col("r.conversations")[0]["value"].alias("human"), F.col("r.conversations")[1]["value"].alias("gpt"), "r.metadata.video_id")


def skip_attribution(s: SparkSession, d: str) -> DataFrame:
    previous, current = F.coalesce("previous_clip.description", F.lit("")), "current_clip.description"
    cause = F.when(previous == "", "no_previous").when(T.is_blank(current), "no_description").otherwise("converted")
    return _pairs(s, d).groupBy(cause.alias("cause")).agg(F.count("*").alias("n_pairs"))


# anti-joins and audits


def anti_join_resume(s: SparkSession, d: str) -> DataFrame:
    tasks = _clips(s, d).select("row_id", "clip_path", "clip_filename")
    return J.unprocessed(tasks, T.or_else("clip_path", "clip_filename"), _qa(s, d), T.or_else("source_clip_path")).select("row_id")


def existence_audit(s: SparkSession, d: str) -> DataFrame:
    rows = J.presence(_clips(s, d), P.basename(F.col("clip_path")), _qa(s, d), P.basename(F.col("source_clip_path")))
    return rows.groupBy("present").agg(F.count("*").alias("n_rows"), F.count_distinct("video_id").alias("n_videos"))


def pair_flags(s: SparkSession, d: str) -> DataFrame:
    return _pairs(s, d).groupBy("has_previous", F.col("previous_has_description").cast("string").alias("previous_has_description")).agg(F.count("*").alias("n_pairs"))


QUERIES = {
    f.__name__: f
    for f in (
        clip_name_parse, clip_name_format, legacy_name_format, path_parts, identifier_extract, rename_plan, last_wins_dedupe, pair_previous, pair_previous_all, pair_previous_stubs,
        merge_left_join, merge_counts, pair_to_training, merged_to_training, qa_to_training, legacy_to_training, skip_attribution, anti_join_resume, existence_audit, pair_flags,
    )
}

_NAME = r"^(.+?)__clip(\d+)_([\d.]+)-([\d.]+)$"
_STEM = r"regexp_replace({x}, '^(.+)\.[^.]+$', '\1')"


def _parse(x: str) -> str:
    st = _STEM.format(x=f"regexp_replace({x}, '^.*/', '')")
    hit = f"regexp_matches({st}, '{_NAME}')"
    part = lambda k: f"regexp_extract({st}, '{_NAME}', {k})"
    return (
        f"CASE WHEN {hit} THEN {part(1)} ELSE {st} END AS video_id, CASE WHEN {hit} THEN CAST({part(2)} AS BIGINT) ELSE 0 END AS clip_number, "
        f"CASE WHEN {hit} THEN CAST({part(3)} AS DOUBLE) ELSE 0.0 END AS start_time, CASE WHEN {hit} THEN CAST({part(4)} AS DOUBLE) ELSE 0.0 END AS end_time"
    )


_IDX = """idx AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id, clip_number ORDER BY row_id DESC) AS rn FROM {src}
    WHERE video_id IS NOT NULL AND video_id <> '' AND clip_number IS NOT NULL) WHERE rn = 1)"""
_FILES = f"""files AS (
  SELECT video_id, clip_number, min(file) AS file FROM (
    SELECT file, {_parse("file")} FROM (
      SELECT clip_path AS file FROM clip_descriptions_copy UNION ALL SELECT source_clip_path FROM clip_qa_pairs) WHERE file IS NOT NULL)
  WHERE clip_number > 0 GROUP BY ALL)"""


def _pair_sql(src: str, join: str, columns: str, prior: str = "") -> str:
    return f"""WITH {prior}{_IDX.format(src=src)}, {_FILES},
stub AS (SELECT file AS sfile, {_parse("file")} FROM files)
SELECT {columns} FROM idx c {join} JOIN files f ON rtrim(f.video_id, '_') = rtrim(c.video_id, '_') AND f.clip_number = c.clip_number - 1
LEFT JOIN stub s ON s.sfile = f.file
LEFT JOIN idx k ON k.video_id = c.video_id AND k.clip_number = c.clip_number - 1 AND f.file IS NOT NULL
WHERE c.clip_number > 1"""


_PAIR_COLUMNS = """c.video_id, c.clip_number, c.clip_path,
CASE WHEN k.video_id IS NOT NULL THEN k.clip_path ELSE f.file END AS previous_path, k.description AS previous_description,
CASE WHEN k.video_id IS NOT NULL THEN k.start_time ELSE s.start_time END AS previous_start, f.file IS NOT NULL AS has_previous,
CAST(CASE WHEN f.file IS NOT NULL THEN coalesce(k.description, '') <> '' END AS VARCHAR) AS previous_has_description"""

_BRACKETED = """files AS (SELECT '/raw/' || strftime(generated_at, '%Y%m%d') || '/' || CASE WHEN qa_id % 7 = 0 THEN 'plain.mp4'
  ELSE '片段' || qa_id || '[' || coalesce(video_id, 'none') || '].mp4' END AS path FROM clip_qa_pairs WHERE generated_at IS NOT NULL)"""
_B = r"^.*?\[([A-Za-z0-9_]+)\]\.([^.]+)$"
_FIXED = "printf('%.2f', {x})"
_LEGACY = "video_id || CASE WHEN video_id LIKE '%\\_' ESCAPE '\\' THEN '_' ELSE '__' END || CAST(trunc(start_time * 1000) AS BIGINT) || '_' || CAST(trunc(end_time * 1000) AS BIGINT) || '.mp4'"


def _blank(x: str) -> str:
    return f"(coalesce({sql_strip(x)}, '') = '')"


def _previous(x: str) -> str:
    t = sql_strip(x)
    return f"CASE WHEN {_blank(x)} THEN '...' WHEN length({t}) > 500 THEN '...' || right({t}, 500) ELSE {t} END"


def _lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_BASE = f"CASE WHEN starts_with(path, '{OPTIONS.video_base}') THEN path ELSE '{OPTIONS.video_base}/' || regexp_replace(path, '^.*/', '') END"
_META = """CASE WHEN coalesce(vid, '') = '' THEN '' ELSE vid || '_' END AS title, s AS video_start, e AS video_end, round(dur, 6) AS duration,
CASE WHEN coalesce(vid, '') = '' THEN 'unknown.json' ELSE vid || '.json' END AS source_file"""
_SCENES = """scenes AS (SELECT p.*, coalesce(i.description, '') AS scene FROM clip_pairs_all p LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id, clip_number ORDER BY row_id DESC) AS rn FROM clip_descriptions_copy
    WHERE video_id IS NOT NULL AND clip_number IS NOT NULL) WHERE rn = 1) i
  ON i.video_id = p.current_clip.video_id AND i.clip_number = p.current_clip.clip_number)"""
_CUR = """current_clip.clip_path AS path, current_clip.video_id AS vid, coalesce(current_clip.start_time, 0.0) AS s, coalesce(current_clip.end_time, 0.0) AS e,
coalesce(current_clip.duration, coalesce(current_clip.end_time, 0.0) - coalesce(current_clip.start_time, 0.0)) AS dur"""
_NL = "chr(10)"


def _text(x: str) -> str:
    """A literal whose newlines survive in SQL."""
    return " || chr(10) || ".join(_lit(p) for p in x.split("\n"))


SQL = {
    "clip_name_parse": f"SELECT row_id, video_id, clip_number, start_time, end_time, round(end_time - start_time, 6) AS duration FROM (SELECT row_id, {_parse('clip_filename')} FROM (SELECT row_id, clip_filename FROM clip_descriptions_copy WHERE clip_filename IS NOT NULL))",
    "clip_name_format": f"""SELECT row_id, CASE WHEN video_id LIKE '%\\_' ESCAPE '\\' THEN video_id ELSE video_id || '_' END || '_clip' || printf('%04d', clip_number) || '_' || {_FIXED.format(x="start_time")} || '-' || {_FIXED.format(x="end_time")} || '.mp4' AS clip_name,
  video_id || '_' || {_FIXED.format(x="start_time")} || '-' || {_FIXED.format(x="end_time")} || '_2.0fps.mp4' AS commentary_name FROM clip_descriptions_copy WHERE video_id IS NOT NULL AND clip_number IS NOT NULL""",
    "legacy_name_format": f"SELECT row_id, {_LEGACY} AS legacy_name FROM clip_descriptions_copy WHERE video_id IS NOT NULL",
    "path_parts": f"""SELECT row_id, base AS basename, {_STEM.format(x="base")} AS stem, regexp_extract(base, '^.+(\\.[^.]+)$', 1) AS suffix, regexp_replace(clip_path, '(?i)\\.mp4$', '.json') AS sidecar,
  CASE WHEN starts_with(clip_path, '{OPTIONS.video_base}') THEN clip_path ELSE '{OPTIONS.video_base}/' || base END AS rebased
  FROM (SELECT row_id, clip_path, regexp_replace(clip_path, '^.*/', '') AS base FROM clip_descriptions_copy WHERE clip_path IS NOT NULL)""",
    "identifier_extract": f"WITH {_BRACKETED} SELECT path, regexp_extract(n, '{_B}', 1) AS identifier, regexp_extract(n, '{_B}', 2) AS extension FROM (SELECT path, regexp_replace(path, '^.*/', '') AS n FROM files)",
    "rename_plan": f"""WITH {_BRACKETED}, x AS (SELECT DISTINCT path, regexp_extract(regexp_replace(path, '^.*/', ''), '{_B}', 1) AS id, regexp_extract(regexp_replace(path, '^.*/', ''), '{_B}', 2) AS ext, regexp_extract(path, '([^/]+)/[^/]*$', 1) AS folder FROM files),
 y AS (SELECT *, min(path) OVER (PARTITION BY id, ext) AS first_path, min(path) OVER (PARTITION BY id, ext, folder) AS in_folder FROM x)
 SELECT path, CASE WHEN id = '' THEN NULL WHEN path = first_path THEN id || '.' || ext WHEN path = in_folder THEN folder || '_' || id || '.' || ext ELSE folder || '_' || id || '_' || substr(md5(path), 1, 8) || '.' || ext END AS new_name,
 CASE WHEN id = '' THEN 'no identifier in brackets' END AS reason FROM y""",
    "last_wins_dedupe": f"WITH {_IDX.format(src='clip_descriptions_copy')} SELECT video_id, clip_number, row_id, description, clip_path FROM idx",
    "pair_previous": _pair_sql("clip_descriptions_copy", "", _PAIR_COLUMNS),
    "pair_previous_all": _pair_sql("clip_descriptions_copy", "LEFT", _PAIR_COLUMNS),
    "pair_previous_stubs": _pair_sql(
        "odd", "", "c.video_id, c.clip_number, CASE WHEN k.video_id IS NOT NULL THEN k.clip_path ELSE f.file END AS previous_path, CASE WHEN k.video_id IS NOT NULL THEN k.start_time ELSE s.start_time END AS previous_start, coalesce(k.description, '') <> '' AS previous_has_description",
        "odd AS (SELECT pair_id AS row_id, current_clip.clip_path, current_clip.clip_filename, current_clip.video_id, current_clip.clip_number, current_clip.start_time, current_clip.end_time, current_clip.duration, current_clip.description FROM clip_pairs_all WHERE current_clip IS NOT NULL), ",
    ),
    "merge_left_join": f"WITH {_SCENES} SELECT pair_id, current_clip.video_id AS video_id, current_clip.clip_number AS clip_number, scene FROM scenes",
    "merge_counts": f"""WITH {_SCENES}, b AS (SELECT {_blank("scene")} AS ns, {_blank("current_clip.description")} AS na FROM scenes WHERE current_clip IS NOT NULL)
 SELECT count(*) AS total, CAST(count_if(ns) AS BIGINT) AS no_scene, CAST(count_if(ns AND na) AS BIGINT) AS empty_answer, CAST(count_if(na AND NOT ns) AS BIGINT) AS no_advice_kept, CAST(count_if(NOT (ns AND na)) AS BIGINT) AS written FROM b""",
    "pair_to_training": f"""SELECT pair_id, {_BASE} AS video, {_text(OPENING + "，请给我一些指导建议")} || CASE WHEN pre = '...' THEN '' ELSE {_text(PREVIOUS_ADVICE)} || pre END || {_text(chr(10) + "请观看这个游戏视频片段: " + ADVICE)} AS human, gpt, {_META}
 FROM (SELECT pair_id, {_CUR}, {_previous("previous_clip.description")} AS pre, {sql_strip("current_clip.description")} AS gpt FROM clip_pairs_all WHERE NOT {_blank("current_clip.description")})""",
    "merged_to_training": f"""WITH {_SCENES} SELECT pair_id, {_BASE} AS video, {_text(OPENING + "，请给我一些指导建议")} || CASE WHEN pre = '...' THEN '' ELSE {_text(PREVIOUS_ADVICE)} || pre END || {_text(chr(10) + "请观看这个游戏视频片段，" + ADVICE)} AS human, gpt, {_META}
 FROM (SELECT pair_id, {_CUR}, {_previous("previous_clip.description")} AS pre, concat_ws({_NL} || {_NL}, CASE WHEN NOT {_blank("scene")} THEN '{OPTIONS.scene_label}' || {_NL} || {sql_strip("scene")} END, CASE WHEN NOT {_blank("current_clip.description")} THEN '{OPTIONS.advice_label}' || {_NL} || {sql_strip("current_clip.description")} END) AS gpt FROM scenes) WHERE gpt <> ''""",
    "qa_to_training": f"""SELECT qa_id, {_BASE} AS video, {_text(OPENING + "。" + chr(10) + "请根据这个游戏视频片段回答下面的问题：")} || q AS human, a AS gpt, {_META}
 FROM (SELECT qa_id, source_clip_path AS path, {sql_strip("question")} AS q, {sql_strip("answer")} AS a, {sql_strip("coalesce(video_id, '')")} AS vid, start_time AS s, end_time AS e, CASE WHEN coalesce(end_time, 0) <> 0 AND start_time IS NOT NULL THEN end_time - start_time ELSE 0.0 END AS dur
 FROM clip_qa_pairs WHERE NOT {_blank("question")} AND NOT {_blank("answer")} AND coalesce(source_clip_path, '') <> '')""",
    "skip_attribution": f"SELECT CASE WHEN coalesce(previous_clip.description, '') = '' THEN 'no_previous' WHEN {_blank('current_clip.description')} THEN 'no_description' ELSE 'converted' END AS cause, count(*) AS n_pairs FROM clip_pairs_all GROUP BY 1",
    "anti_join_resume": "SELECT row_id FROM clip_descriptions_copy c WHERE NOT EXISTS (SELECT 1 FROM clip_qa_pairs q WHERE nullif(q.source_clip_path, '') = coalesce(nullif(c.clip_path, ''), nullif(c.clip_filename, '')))",
    "existence_audit": """SELECT l.n IS NOT NULL AS present, count(*) AS n_rows, count(DISTINCT c.video_id) AS n_videos FROM clip_descriptions_copy c
 LEFT JOIN (SELECT DISTINCT regexp_replace(source_clip_path, '^.*/', '') AS n FROM clip_qa_pairs WHERE source_clip_path IS NOT NULL) l ON l.n = regexp_replace(c.clip_path, '^.*/', '') GROUP BY 1""",
    "pair_flags": "SELECT has_previous, CAST(previous_has_description AS VARCHAR) AS previous_has_description, count(*) AS n_pairs FROM clip_pairs_all GROUP BY 1, 2",
}


def _legacy_sql() -> str:
    from cliplake.functions.records import LEGACY_PROMPTS

    options = ", ".join(_lit(p) for p in LEGACY_PROMPTS)
    pick = f"list_extract([{options}], CAST(CAST('0x' || substr(md5('42:' || name), 1, 8) AS BIGINT) % 10 AS INTEGER) + 1)"
    tail = "CASE WHEN length(prev) > 200 THEN '...' || right(prev, 200) ELSE prev END"
    return f"""SELECT pair_id, 'videos_val/' || name AS video, '<video>' || {_NL} || CASE WHEN length(coalesce(prev, '')) > 10 THEN '基于之前的解说内容："' || {tail} || '"' || {_NL} || {_NL} || {_lit(LEGACY_PROMPTS[0])} ELSE {pick} END AS human, said AS gpt, video_id
 FROM (SELECT pair_id, prev, said, video_id, {_LEGACY} AS name FROM (SELECT pair_id, previous_clip.description AS prev, current_clip.description AS said, current_clip.video_id AS video_id, current_clip.start_time AS start_time, current_clip.end_time AS end_time
 FROM clip_pairs_all WHERE NOT {_blank("current_clip.description")} AND current_clip.video_id IS NOT NULL))"""


SQL["legacy_to_training"] = _legacy_sql()
