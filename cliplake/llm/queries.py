"""Queries of the training-data operators, with the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.llm.language import CODES, document_languages, language_segments
from cliplake.llm.leakage import leaked_passages
from cliplake.llm.neardup import NearDuplicates
from cliplake.llm.packing import CAPACITY, pack_documents
from cliplake.llm.qadefects import qa_defects
from cliplake.llm.repetition import repetition
from cliplake.llm.splits import split_related, video_groups
from cliplake.llm.truncation import truncated
from cliplake.llm.turns import speaker_turns, turn_words
from cliplake.session import read_table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = speaker_turns(read_table(spark, sf_dir, "subtitle_cues"), read_table(spark, sf_dir, "speaker_roster"))
    return turns.select("video_id", "first_cue_id", "last_cue_id")


def p2_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns' words; a long turn comes in parts."""
    return turn_words(read_table(spark, sf_dir, "subtitle_cues"), read_table(spark, sf_dir, "speaker_roster"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = video_groups(read_table(spark, sf_dir, "clip_descriptions_copy"), read_table(spark, sf_dir, "video_sources"))
    first = groups.groupBy("component").agg(F.min("video_id").alias("video_a"))
    return (
        groups.join(first, "component")
        .where("video_id <> video_a")
        .select("video_a", F.col("video_id").alias("video_b"))
        .distinct()
    )


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling with the smallest one of its group and its number of clips."""
    groups = video_groups(read_table(spark, sf_dir, "clip_descriptions_copy"), read_table(spark, sf_dir, "video_sources"))
    first = groups.groupBy("component").agg(F.min("video_id").alias("video_a"))
    return groups.join(first, "component").select("video_id", "video_a", F.col("n").alias("n_clips"))


def p1_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_related(read_table(spark, sf_dir, "clip_descriptions_copy"), read_table(spark, sf_dir, "video_sources"))
    return rows.select("row_id", "video_id", "clip_number", "component", "split")


def _described(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """(src, rec, text, source_file) of the clip descriptions and of one side of the clip pairs."""
    clips = read_table(spark, sf_dir, "clip_descriptions_copy").select(
        F.lit("clip").alias("src"), F.col("row_id").alias("rec"), F.col("description").alias("text"), "source_file"
    )
    pairs = read_table(spark, sf_dir, "clip_pairs_all").select(
        F.lit("pair").alias("src"), F.col("pair_id").alias("rec"), F.col(f"{side}.description").alias("text"), "source_file"
    )
    return clips.union(pairs)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearDuplicates(_described(spark, sf_dir, "current_clip")).pairs()


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearDuplicates(_described(spark, sf_dir, "current_clip")).groups()


def p3_link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearDuplicates(_described(spark, sf_dir, "current_clip")).link_counts()


def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(read_table(spark, sf_dir, "clip_descriptions_copy"), "row_id", "description")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    likely = _repeats(spark, sf_dir).where("posterior >= 0.5")  # the posterior selects, the exact check follows
    return likely.where("n_chars >= 40 and repeat_share >= 0.25").select(F.col("rec").alias("row_id")).distinct()


def p4_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _repeats(spark, sf_dir)
    return found.select(F.col("rec").alias("row_id"), "n_chars", "repeat_share", "sentence_share", "posterior")


def p4_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measured shares alone, without the votes."""
    return _repeats(spark, sf_dir).select(F.col("rec").alias("row_id"), "n_chars", F.round("repeat_share", 9).alias("repeat_share"))


def _defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_defects(read_table(spark, sf_dir, "clip_qa_pairs"), "qa_id", "question", "answer")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _defects(spark, sf_dir).where("defect is not null").select(F.col("rec").alias("qa_id"), "defect").distinct()


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _defects(spark, sf_dir).groupBy("defect").agg(F.count("*").alias("n_pairs"))


def _cut_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(_described(spark, sf_dir, "previous_clip"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut_off(spark, sf_dir).where("probability >= 0.5").select("src", F.col("rec").alias("rec_id")).distinct()


def p6_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.count_if(F.col("probability") >= 0.5)
    rates = _cut_off(spark, sf_dir).groupBy("src", "source_file").agg(F.count("*").alias("n_records"), found.alias("n_truncated"))
    return rates.withColumn("rate", F.col("n_truncated") / F.col("n_records"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are, in one row."""
    used = p8_containers(spark, sf_dir).groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
    return used.agg(
        F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), (F.sum("used") / (F.count("*") * CAPACITY)).alias("fill"), F.max("used").alias("most")
    )


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_table(spark, sf_dir, "eval_passages")
    return leaked_passages(read_table(spark, sf_dir, "documents"), "doc_id", "text", items, "item_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id")


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test item with the number of documents that hold it."""
    found = _leaks(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_documents"), F.max("contained").alias("most_contained"))
    items = read_table(spark, sf_dir, "eval_passages").select("item_id", "suite")
    return items.join(found, "item_id", "left").select("item_id", "suite", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.round(F.coalesce("most_contained", F.lit(0.0)), 6).alias("most_contained"))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_segments(read_table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = document_languages(_segments(spark, sf_dir))
    tag = F.split(F.lower(F.trim("label")), "[-_]")[0]
    codes = F.create_map(*(F.lit(x) for pair in CODES.items() for x in pair))
    tag = F.coalesce(codes[tag], tag)
    right = (F.col("n_languages") == 1) & (F.coalesce(tag, F.lit("")) == F.col("lang"))
    return found.where(~right).select("doc_id", F.col("lang").alias("lang_found")).distinct()


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).select("doc_id", "segment", "start", "stop", "lang", "confidence")


QUERIES = {
    "p1_found": p1_found,
    "p1_groups": p1_groups,
    "p1_split": p1_split,
    "p2_found": p2_found,
    "p2_turns": p2_turns,
    "p3_found": p3_found,
    "p3_groups": p3_groups,
    "p3_link_counts": p3_link_counts,
    "p4_found": p4_found,
    "p4_repetition": p4_repetition,
    "p4_shares": p4_shares,
    "p5_found": p5_found,
    "p5_counts": p5_counts,
    "p6_found": p6_found,
    "p6_rates": p6_rates,
    "p8_containers": p8_containers,
    "p8_fill": p8_fill,
    "p9_found": p9_found,
    "p10_found": p10_found,
    "p10_segments": p10_segments,
    "p9_items": p9_items,
}

# Unicode white space as DuckDB's regex spells it, and the full-width forms of ASCII with what NFKC makes of them.
_W = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WIDE, _PLAIN = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)), "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")


def _dense(x: str) -> str:
    return f"regexp_replace({x}, '{_W}', '', 'g')"


def _key(x: str) -> str:
    return f"rtrim(lower(translate({_dense(x)}, '{_WIDE}', '{_PLAIN}')), '_')"


def _written(x: str) -> str:
    return f"{_dense(x)} <> ''"


def _alnum(x: str) -> str:
    return f"regexp_replace(lower(nfc_normalize(translate({x}, '{_WIDE}', '{_PLAIN}'))), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


_HELD = f"""items AS (SELECT item_id, {_alnum("text")} AS t FROM eval_passages),
 grams AS (SELECT DISTINCT item_id, g FROM (SELECT item_id, unnest(list_transform(range(1, length(t) - 8), lambda i: substr(t, i, 10))) AS g FROM items WHERE length(t) >= 10)),
 sizes AS (SELECT item_id, count(*) AS n FROM grams GROUP BY item_id),
 docs AS (SELECT doc_id, {_alnum("text")} AS t FROM documents WHERE text IS NOT NULL),
 held AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(list_transform(range(1, length(t) - 8), lambda i: substr(t, i, 10))) AS g FROM docs WHERE length(t) >= 10) WHERE g IN (SELECT g FROM grams)),
 met AS (SELECT doc_id, item_id, count(*) AS k FROM held JOIN grams USING (g) GROUP BY ALL),
 leaks AS (SELECT doc_id, item_id, k::DOUBLE / n AS share FROM met JOIN sizes USING (item_id) WHERE k >= 0.4 * n)"""

_TIED = f"""src AS (
  SELECT 'v:' || {_key("video_id")} AS v, CASE WHEN {_written("reupload_of")} THEN 'v:' || {_key("reupload_of")} END AS r,
    CASE WHEN {_written("uploader")} THEN 'u:' || lower(regexp_replace(uploader, '^{_W}+|{_W}+$', '', 'g')) END AS u FROM video_sources WHERE {_written("video_id")}),
 clips AS (SELECT DISTINCT video_id, 'v:' || {_key("video_id")} AS v FROM clip_descriptions_copy WHERE {_written("video_id")}),
 one AS (SELECT v AS a, r AS b FROM src WHERE r IS NOT NULL UNION SELECT v, u FROM src WHERE u IS NOT NULL),
 edges AS (SELECT a, b FROM one UNION SELECT b, a FROM one),
 reach AS (SELECT DISTINCT v AS x, v AS y FROM clips UNION SELECT reach.x, edges.b FROM reach JOIN edges ON edges.a = reach.y),
 comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
 named AS (SELECT clips.video_id, min(clips.video_id) OVER (PARTITION BY comp.c) AS video_a FROM clips JOIN comp ON comp.x = clips.v)"""
_NEAR = f"""recs AS (
  SELECT 'clip' AS src, row_id AS rec, {_dense("description")} AS t FROM clip_descriptions_copy
  UNION ALL SELECT 'pair', pair_id, {_dense("current_clip.description")} FROM clip_pairs_all),
 grams AS (SELECT DISTINCT src, rec, g FROM (SELECT src, rec, unnest(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) AS g FROM recs WHERE length(t) >= 40)),
 sizes AS (SELECT src, rec, count(*) AS n FROM grams GROUP BY ALL),
 met AS (SELECT x.src, x.rec AS a, y.rec AS b, count(*) AS k FROM grams x JOIN grams y ON x.src = y.src AND x.g = y.g AND x.rec < y.rec GROUP BY ALL),
 pairs AS (SELECT met.src, a AS rec_a, b AS rec_b FROM met JOIN sizes p ON p.src = met.src AND p.rec = a JOIN sizes q ON q.src = met.src AND q.rec = b WHERE k >= 0.7 * (p.n + q.n - k))"""
_CLASSES = """sides AS (SELECT src, rec_a AS a, rec_b AS b FROM pairs UNION SELECT src, rec_b, rec_a FROM pairs),
 joined AS (SELECT DISTINCT src, a AS rec, a AS y FROM sides UNION SELECT j.src, j.rec, sides.b FROM joined j JOIN sides ON sides.src = j.src AND sides.a = j.y),
 classes AS (SELECT src, rec, min(y) AS group_id FROM joined GROUP BY ALL)"""

SQL: dict[str, str] = {
    "p9_found": f"WITH {_HELD} SELECT doc_id, item_id FROM leaks",
    "p9_items": f"""WITH {_HELD} SELECT p.item_id, p.suite, count(doc_id) AS n_documents, round(coalesce(max(share), 0.0), 6) AS most_contained FROM eval_passages p LEFT JOIN leaks USING (item_id) GROUP BY ALL""",
    "p1_found": f"WITH RECURSIVE {_TIED} SELECT DISTINCT video_a, video_id AS video_b FROM named WHERE video_id <> video_a",
    "p1_groups": f"WITH RECURSIVE {_TIED}, sizes AS (SELECT video_id, count(*) AS n_clips FROM clip_descriptions_copy GROUP BY 1) SELECT video_id, video_a, n_clips FROM named JOIN sizes USING (video_id)",
    "p3_found": f"WITH {_NEAR} SELECT src, rec_a, rec_b FROM pairs",
    "p3_groups": f"WITH RECURSIVE {_NEAR}, {_CLASSES} SELECT src, rec, group_id FROM classes",
    "p3_link_counts": f"WITH RECURSIVE {_NEAR}, {_CLASSES} SELECT src, rec, group_id, n_links FROM classes JOIN (SELECT src, a AS rec, count(*) AS n_links FROM sides GROUP BY src, a) USING (src, rec)",
    "p4_shares": f"""SELECT row_id, length(t) AS n_chars, CASE WHEN length(t) >= 8 THEN round(1 - len(list_distinct(list_transform(range(1, length(t) - 6), lambda i: substr(t, i, 8))))::DOUBLE / (length(t) - 7), 9) ELSE 0.0 END AS repeat_share
FROM (SELECT row_id, coalesce({_dense("description")}, '') AS t FROM clip_descriptions_copy)""",
    "p4_found": f"""SELECT row_id FROM (SELECT row_id, {_dense("description")} AS t FROM clip_descriptions_copy)
WHERE length(t) >= 40 AND 1 - len(list_distinct(list_transform(range(1, length(t) - 6), lambda i: substr(t, i, 8))))::DOUBLE / (length(t) - 7) >= 0.25""",
}
