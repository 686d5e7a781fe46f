"""Queries of text, order, segmentation, parsing and audit operators over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import qa as Q
from cliplake.functions import text as T
from cliplake.functions import verdict as V
from cliplake.functions.frames import frame_plan as plan_frames
from cliplake.functions.rounding import exact_round, fixed2, hms, seconds
from cliplake.operators import ordinal as O
from cliplake.operators import segment as S
from cliplake.plans.clip_queries import W, sql_strip
from cliplake.session import read_table
from cliplake.sources.jsonl import audit_field, json_type
from cliplake.sources.listing import VIDEO_SUFFIXES, suffix_counts, with_suffix
from cliplake.sources.sinks import delete_plan as plan_deletes

HOUR = 3600


def strip_unicode(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "clip_descriptions_copy").where("description is not null")
    return rows.select("row_id", T.strip("description").alias("stripped"), F.length(T.strip("description")).alias("n_chars"))


def truncate_ends(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "documents")
    return rows.select("doc_id", T.tail_truncate("text", 500).alias("tail"), T.head_truncate("text", 300).alias("head"), T.previous_text("text", 200).alias("previous"))


def placeholder_fallback(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "clip_descriptions_copy")
    return rows.select("row_id", T.or_else("description", "clip_filename", "source_file").alias("shown"), T.is_blank("description").alias("is_blank"))


def round_exact(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "lineitem")
    x = F.col("l_extendedprice") / 1000
    return rows.select("l_orderkey", "l_linenumber", exact_round(x, 1).alias("one"), exact_round(x, 2).alias("two"), fixed2(x).alias("shown"))


def cue_seconds(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "subtitle_cues").where("start_ms is not null")
    return rows.select("cue_id", seconds(F.col("start_ms")).alias("start_s"), hms(F.col("start_ms") / 1000).alias("shown"))


def word_tokens_rle(s: SparkSession, d: str) -> DataFrame:
    w = T.words("text")
    rows = read_table(s, d, "documents").where("text is not null")
    return rows.select("doc_id", F.size(w).alias("n_words"), F.array_join(w, "|").alias("joined"))


def word_timing(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "subtitle_cues").where("start_ms is not null and end_ms > start_ms and not contains(text, '[') and not contains(text, ']')")
    rows = rows.where(~T.is_blank("text"))
    told = S.timed_words(F.col("start_ms") / 1000, F.col("end_ms") / 1000, F.col("text"))
    return rows.select("cue_id", F.posexplode(told).alias("at", "w")).select("cue_id", "at", "w.start", "w.end", "w.word")


def nested_sum(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "documents").select("source", F.size(T.words(F.coalesce("text", F.lit("")))).alias("n"))
    return rows.groupBy("source").agg(F.sum("n").alias("n_words"), F.count("*").alias("n_docs"))


def _segments(s: SparkSession, d: str) -> DataFrame:
    events = read_table(s, d, "events").withColumn("t", F.expr("unix_micros(CAST(ts AS TIMESTAMP)) div 1000000"))
    return S.greedy_segments(events, "user_id", "t", "event_id", 48 * HOUR, 12 * HOUR, 6 * HOUR)


def greedy_segments(s: SparkSession, d: str) -> DataFrame:
    return _segments(s, d)


def segment_rate_filter(s: SparkSession, d: str) -> DataFrame:
    rate = F.col("n_rows") * HOUR / (F.col("end_t") - F.col("start_t"))
    return _segments(s, d).where("end_t > start_t").where(rate.between(0.1, 0.3)).select("user_id", "first_id", "n_rows")


def contiguous_tiling(s: SparkSession, d: str) -> DataFrame:
    orders = read_table(s, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("duration"))
    tiles = S.contiguous_tiles(orders, "o_orderkey", "duration")
    return tiles.select("o_orderkey", "tile", F.round("start_time", 6).alias("start_time"), F.round("end_time", 6).alias("end_time"))


def overlap_windows(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "clip_descriptions_copy").where("start_time is not null and end_time > start_time")
    w = F.explode(S.hop_windows(F.col("start_time"), F.col("end_time"), 5.0, 1.0)).alias("w")
    return rows.select("row_id", w).select("row_id", F.round("w.start", 6).alias("start"), F.round("w.end", 6).alias("end"))


def frame_plan(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "clip_descriptions_copy").where("duration is not null")
    fps = F.when(F.col("row_id") % 5 == 0, 0.0).otherwise(F.lit(25.0))
    frames = plan_frames(fps, (F.col("duration") * 25).cast("long"))
    return rows.select("row_id", F.size(frames).alias("n_frames"), F.array_join(frames.cast("array<string>"), ",").alias("frames"))


def dense_ordinal(s: SparkSession, d: str) -> DataFrame:
    return O.dense_ordinal(read_table(s, d, "clip_descriptions_copy").select("row_id"), ["row_id"])


def stride_shard(s: SparkSession, d: str) -> DataFrame:
    numbered = O.dense_ordinal(read_table(s, d, "documents").select("doc_id", "source"), ["doc_id"])
    return O.stride_shard(numbered, "ordinal", 3, 8)


def shuffle_seeded(s: SparkSession, d: str) -> DataFrame:
    keyed = read_table(s, d, "documents").select("doc_id", O.shuffle_key(F.col("doc_id")).alias("shuffle_key"))
    return O.dense_ordinal(keyed, ["shuffle_key", "doc_id"], "place")


def union_ordered(s: SparkSession, d: str) -> DataFrame:
    clips = read_table(s, d, "clip_descriptions_copy").select(F.col("row_id").alias("rec"), F.col("description").alias("text"))
    answers = read_table(s, d, "clip_qa_pairs").select(F.col("qa_id").alias("rec"), F.col("answer").alias("text"))
    return O.union_ordered(clips, answers, order="rec")


def prefix_limit(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "clip_descriptions_copy").where(~T.is_blank("description"))
    return O.prefix_limit(rows, ["row_id"], 100).select("row_id", "description")


def group_limit(s: SparkSession, d: str) -> DataFrame:
    rows = read_table(s, d, "clip_descriptions_copy").where("video_id is not null and clip_number is not null").select("video_id", "clip_number", "row_id")
    return O.group_limit(rows, "video_id", ["clip_number", "row_id"], 3)


def _answers(s: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("doc_id") % 3 == 0, "是否是CS2或CSGO：否\n").when(F.col("doc_id") % 3 == 1, "是否是CS2或CSGO：是\n").otherwise("")
    named = F.when(F.col("doc_id") % 4 == 0, "这是CS2游戏。").otherwise("")
    rows = read_table(s, d, "documents").where("text is not null")
    return rows.select("doc_id", "lang", F.concat(label, named, "text").alias("answer"), F.concat(F.lit("/videos/"), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("path"))


def verdict_parse(s: SparkSession, d: str) -> DataFrame:
    a = F.col("answer")
    return _answers(s, d).select("doc_id", V.legacy_verdict(a).alias("legacy"), F.coalesce(V.strict_verdict(a).cast("string"), F.lit("none")).alias("strict"), V.verdict_reason(a).alias("reason"))


def verdict_tally(s: SparkSession, d: str) -> DataFrame:
    kind = F.coalesce(V.strict_verdict(F.col("answer")).cast("string"), F.lit("none"))
    return _answers(s, d).groupBy(kind.alias("verdict")).agg(F.count("*").alias("n_videos"))


def delete_plan(s: SparkSession, d: str) -> DataFrame:
    rows = _answers(s, d).select(F.col("path").alias("video_path"), F.lit(None).cast("string").alias("video_filename"), V.verdict_reason(F.col("answer")).alias("reason"))
    return plan_deletes(rows, _answers(s, d).where("lang is not null").select("path"))


def _responses(s: SparkSession, d: str, loose: bool) -> DataFrame:
    """Responses made of the non-blank pairs, those included that hold labels themselves."""
    rows = read_table(s, d, "clip_qa_pairs").where(~T.is_blank("question") & ~T.is_blank("answer"))
    q, a = F.col("question"), F.col("answer")
    if loose:
        return rows.select("qa_id", F.concat(F.lit("问："), q, F.lit("\n答："), a, F.lit("\nQ: "), q, F.lit("\n")).alias("response"))
    text = F.concat(F.lit("问题2："), q, F.lit("\n答案2："), a, F.lit("\n问题1:第一\n答案 1 : "), a, F.lit("\n问题3："), q)
    return rows.select("qa_id", text.alias("response"))


def _parsed(rows: DataFrame) -> DataFrame:
    return rows.select("qa_id", F.posexplode(Q.parse_pairs(F.col("response"))).alias("at", "p")).select("qa_id", "at", "p.question", "p.answer")


def qa_parse_numbered(s: SparkSession, d: str) -> DataFrame:
    return _parsed(_responses(s, d, False))


def qa_parse_loose(s: SparkSession, d: str) -> DataFrame:
    return _parsed(_responses(s, d, True))


def json_field_scan(s: SparkSession, d: str) -> DataFrame:
    value = F.try_variant_get(F.try_parse_json("props"), "$.k", "long")
    return read_table(s, d, "events").select("event_id", value.alias("k")).groupBy("k").agg(F.count("*").alias("n_events"))


def _typed(s: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 6
    made = F.when(k == 0, '{"video": "a.mp4"}').when(k == 1, '{"video": ["a", "b"]}').when(k == 2, '{"video": null}').when(k == 3, '{"other": 1}').when(k == 4, '{"video": [1, "b"]}').otherwise('{"video": 7}')
    return read_table(s, d, "events").select("event_id", made.alias("line"))


def type_audit(s: SparkSession, d: str) -> DataFrame:
    bad = ~json_type(F.col("line"), "video").isin("absent", "null", "string", "strings")
    return _typed(s, d).groupBy(bad.alias("is_bad")).agg(F.count("*").alias("n_rows"), F.min("event_id").alias("first_id"))


def type_audit_first(s: SparkSession, d: str) -> DataFrame:
    return audit_field(_typed(s, d), "event_id", "line", "video").select("event_id")


def file_suffixes(s: SparkSession, d: str) -> DataFrame:
    ext = F.when(F.col("qa_id") % 4 == 0, ".MP4").when(F.col("qa_id") % 4 == 1, ".Mkv").when(F.col("qa_id") % 4 == 2, ".json").otherwise(".mp4")
    files = read_table(s, d, "clip_qa_pairs").select(F.concat(F.regexp_replace("source_clip_path", r"\.mp4$", ""), ext).alias("path"))
    mixed, strict = with_suffix(files, VIDEO_SUFFIXES), with_suffix(files, VIDEO_SUFFIXES, mixed_case=False)
    strict_counts = suffix_counts(strict).withColumnRenamed("n_files", "n_plain")
    return suffix_counts(mixed).join(strict_counts, "suffix", "left").select("suffix", "n_files", F.coalesce("n_plain", F.lit(0)).alias("n_plain"))


_NAMES = (
    strip_unicode, truncate_ends, placeholder_fallback, round_exact, cue_seconds, word_tokens_rle, word_timing, nested_sum, greedy_segments, segment_rate_filter, contiguous_tiling,
    overlap_windows, frame_plan, dense_ordinal, stride_shard, shuffle_seeded, union_ordered, prefix_limit, group_limit, verdict_parse, verdict_tally, delete_plan, qa_parse_numbered,
    qa_parse_loose, json_field_scan, type_audit, type_audit_first, file_suffixes,
)
QUERIES = {f.__name__: f for f in _NAMES}

_PREV = lambda x, n: f"CASE WHEN coalesce({sql_strip(x)}, '') = '' THEN '...' WHEN length({sql_strip(x)}) > {n} THEN '...' || right({sql_strip(x)}, {n}) ELSE {sql_strip(x)} END"
_WORDS = "list_filter(w, lambda x, i: i = 1 OR x <> w[i - 1])"
_ANSWERS = """answers AS (SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 THEN '是否是CS2或CSGO：否' || chr(10) WHEN doc_id % 3 = 1 THEN '是否是CS2或CSGO：是' || chr(10) ELSE '' END
 || CASE WHEN doc_id % 4 = 0 THEN '这是CS2游戏。' ELSE '' END || text AS answer, '/videos/' || doc_id || '.mp4' AS path FROM documents WHERE text IS NOT NULL)"""
_HEAD = f"CASE WHEN length({sql_strip('answer')}) > 300 THEN left({sql_strip('answer')}, 300) || '...' ELSE {sql_strip('answer')} END"


def _contains(x: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


_STRICT = "coalesce(CASE regexp_extract(answer, '是否是CS2或CSGO\\s*[：:]\\s*(是|否)', 1) WHEN '是' THEN 'true' WHEN '否' THEN 'false' END, 'none')"
_SEG = """WITH RECURSIVE ev AS (SELECT user_id, event_id, CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS t FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
 r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS m FROM ev),
 g AS (SELECT a.user_id, a.i, a.m, a.t, min(b.i) AS j FROM r a JOIN r b ON a.user_id = b.user_id AND b.i > a.i
   LEFT JOIN r p ON p.user_id = b.user_id AND p.i = b.i - 1 WHERE b.t - a.t > 172800 OR b.t - p.t > 43200 OR b.i = a.m - 1 GROUP BY ALL),
 walk AS (SELECT user_id, i, j FROM g WHERE i = 0 UNION ALL SELECT w.user_id, g.i, g.j FROM walk w JOIN g ON g.user_id = w.user_id AND g.i = w.j),
 seg AS (SELECT w.user_id, a.event_id AS first_id, z.event_id AS last_id, a.t AS start_t, z.t AS end_t, w.j - w.i AS n_rows FROM walk w
   JOIN r a ON a.user_id = w.user_id AND a.i = w.i JOIN r z ON z.user_id = w.user_id AND z.i = w.j - 1 WHERE z.t - a.t >= 21600)
"""

def _parse_sql(response: str) -> str:
    """The label parser over all non-blank pairs. A mark set before each label stands for the lookahead that RE2 lacks."""
    mark = lambda labels: f"regexp_replace(t, '{labels}', chr(1) || '\\0', 'g')"
    body = f"{W}*(\\x01?[^\\x01]+)"
    q, a = f"(?:问|Q)题?{W}*[：:]", f"(?:答|A)案?{W}*[：:]"

    def numbered(side: str, label: str) -> str:
        found = lambda n: f"unnest(regexp_extract_all(t, '{label}{W}*(\\p{{Nd}}+){W}*[：:]{body}', {n}))"
        bare = sql_strip("replace(b, chr(1), '')")
        return f"""{side} AS (SELECT k, n, arg_max({bare}, i) AS {side} FROM (SELECT k, TRY_CAST(translate(d, '０１２３４５６７８９', '0123456789') AS BIGINT) AS n, b, i
   FROM (SELECT k, {found(1)} AS d, {found(2)} AS b, generate_subscripts(regexp_extract_all(t, '{label}{W}*(\\p{{Nd}}+){W}*[：:]{body}', 1), 1) AS i FROM marked)) WHERE n IS NOT NULL GROUP BY k, n)"""

    def loose(side: str, label: str, other: str) -> str:
        found = f"regexp_extract_all({mark(other)}, '{label}{body}', 1)"
        bare = sql_strip("replace(b, chr(1), '')")
        return f"{side} AS (SELECT k, n, {bare} AS {side} FROM (SELECT k, unnest({found}) AS b, generate_subscripts({found}, 1) AS n FROM resp))"

    return f"""WITH resp AS MATERIALIZED (SELECT row_number() OVER () AS k, qa_id, {response} AS t FROM clip_qa_pairs
   WHERE coalesce({sql_strip("question")}, '') <> '' AND coalesce({sql_strip("answer")}, '') <> ''),
 marked AS (SELECT k, {mark(f"(?:问题|答案){W}*\\p{{Nd}}+{W}*[：:]")} AS t FROM resp),
 {numbered("nq", "问题")}, {numbered("na", "答案")}, {loose("lq", q, a)}, {loose("la", a, q)},
 first AS (SELECT k, n, nq AS question, na AS answer FROM nq JOIN na USING (k, n) WHERE nq <> '' AND na <> ''),
 found AS (SELECT * FROM first UNION ALL SELECT k, n, lq, la FROM lq JOIN la USING (k, n) WHERE lq <> '' AND la <> '' AND k NOT IN (SELECT k FROM first))
SELECT qa_id, CAST(row_number() OVER (PARTITION BY k ORDER BY n) - 1 AS INTEGER) AS at, found.question, found.answer FROM found JOIN resp USING (k)"""


_NUMBERED_RESPONSE = "'问题2：' || question || chr(10) || '答案2：' || answer || chr(10) || '问题1:第一' || chr(10) || '答案 1 : ' || answer || chr(10) || '问题3：' || question"
_LOOSE_RESPONSE = "'问：' || question || chr(10) || '答：' || answer || chr(10) || 'Q: ' || question || chr(10)"
_TYPED = "typed AS (SELECT event_id, event_id % 6 IN (4, 5) AS is_bad FROM events)"

SQL = {
    "strip_unicode": f"SELECT row_id, {sql_strip('description')} AS stripped, length({sql_strip('description')}) AS n_chars FROM clip_descriptions_copy WHERE description IS NOT NULL",
    "truncate_ends": f"SELECT doc_id, CASE WHEN length(text) > 500 THEN '...' || right(text, 500) ELSE text END AS tail, CASE WHEN length(text) > 300 THEN left(text, 300) || '...' ELSE text END AS head, {_PREV('text', 200)} AS previous FROM documents",
    "placeholder_fallback": f"SELECT row_id, coalesce(nullif(description, ''), nullif(clip_filename, ''), nullif(source_file, '')) AS shown, coalesce({sql_strip('description')}, '') = '' AS is_blank FROM clip_descriptions_copy",
    "round_exact": "SELECT l_orderkey, l_linenumber, CAST(printf('%.1f', x) AS DOUBLE) AS one, CAST(printf('%.2f', x) AS DOUBLE) AS two, printf('%.2f', x) AS shown FROM (SELECT *, l_extendedprice / 1000 AS x FROM lineitem)",
    "cue_seconds": "SELECT cue_id, CAST(printf('%.1f', start_ms / 1000.0::DOUBLE) AS DOUBLE) AS start_s, printf('%02d:%02d:%02d', s // 3600, (s % 3600) // 60, s % 60) AS shown FROM (SELECT *, CAST(floor(start_ms / 1000.0) AS BIGINT) AS s FROM subtitle_cues WHERE start_ms IS NOT NULL)",
    "word_tokens_rle": f"SELECT doc_id, CAST(len({_WORDS}) AS INTEGER) AS n_words, array_to_string({_WORDS}, '|') AS joined FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents WHERE text IS NOT NULL)",
    "word_timing": f"""WITH c AS (SELECT cue_id, start_ms / 1000::DOUBLE AS s, end_ms / 1000::DOUBLE AS e, string_split(text, ' ') AS w FROM subtitle_cues WHERE start_ms IS NOT NULL AND end_ms > start_ms AND NOT contains(text, '[') AND NOT contains(text, ']') AND coalesce({sql_strip("text")}, '') <> ''),
 x AS (SELECT cue_id, s, (e - s) / len({_WORDS}) AS step, {_WORDS} AS v FROM c), y AS (SELECT cue_id, s, step, unnest(v) AS word, generate_subscripts(v, 1) - 1 AS i FROM x)
 SELECT cue_id, CAST(i AS INTEGER) AS at, CAST(printf('%.1f', s + i * step) AS DOUBLE) AS start, CAST(printf('%.1f', s + (i + 1) * step) AS DOUBLE) AS "end", word FROM y""",
    "nested_sum": f"SELECT source, CAST(sum(len({_WORDS})) AS BIGINT) AS n_words, count(*) AS n_docs FROM (SELECT source, string_split(coalesce(text, ''), ' ') AS w FROM documents) GROUP BY source",
    "greedy_segments": _SEG + "SELECT * FROM seg",
    "segment_rate_filter": _SEG + "SELECT user_id, first_id, n_rows FROM seg WHERE end_t > start_t AND n_rows * 3600 / (end_t - start_t) BETWEEN 0.1 AND 0.3",
    "contiguous_tiling": """WITH RECURSIVE t AS (SELECT o_orderkey, o_totalprice / 1000 AS d, 0 AS tile, 0.0::DOUBLE AS s, 0.0::DOUBLE AS e FROM orders
 UNION ALL SELECT o_orderkey, d, tile + 1, e, e + (6.0::DOUBLE + (CAST('0x' || substr(md5('42:' || o_orderkey || ':' || (tile + 1)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE) * (least(15.0::DOUBLE, d - e) - 6.0::DOUBLE)) FROM t WHERE d - e >= 6.0)
 SELECT o_orderkey, tile, round(s, 6) AS start_time, round(e, 6) AS end_time FROM t WHERE tile > 0""",
    "overlap_windows": """SELECT row_id, round(s + i * 4.0::DOUBLE, 6) AS start, round(least(s + i * 4.0::DOUBLE + 5.0::DOUBLE, e), 6) AS "end" FROM (
 SELECT row_id, start_time AS s, end_time AS e, unnest(range(greatest(1, CAST(ceil((end_time - start_time - 1.0::DOUBLE) / 4.0::DOUBLE) AS BIGINT)))) AS i FROM clip_descriptions_copy WHERE start_time IS NOT NULL AND end_time > start_time)""",
    "frame_plan": """WITH a AS (SELECT row_id, CASE WHEN row_id % 5 = 0 THEN 30.0::DOUBLE ELSE 25.0::DOUBLE END AS fps, CAST(trunc(duration * 25) AS BIGINT) AS f FROM clip_descriptions_copy WHERE duration IS NOT NULL),
 b AS (SELECT *, f / fps AS span, least(CAST(trunc(f / fps) AS BIGINT), 8) AS n FROM a),
 c AS (SELECT row_id, CASE WHEN f <= 0 OR n <= 0 THEN [] WHEN n = 1 THEN [least(CAST(trunc(span / 2 * fps) AS BIGINT), f - 1)] ELSE list_transform(range(n), lambda i: least(CAST(trunc(i::DOUBLE / (n - 1) * span * fps) AS BIGINT), f - 1)) END AS x FROM b)
 SELECT row_id, CAST(len(x) AS INTEGER) AS n_frames, array_to_string(x, ',') AS frames FROM c""",
    "dense_ordinal": "SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS ordinal FROM clip_descriptions_copy",
    "stride_shard": "SELECT * FROM (SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents) WHERE ordinal % 8 = 2",
    "shuffle_seeded": "SELECT doc_id, md5('42:' || doc_id) AS shuffle_key, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS place FROM documents",
    "union_ordered": "SELECT row_id AS rec, description AS text, 0 AS source_rank FROM clip_descriptions_copy UNION ALL SELECT qa_id, answer, 1 FROM clip_qa_pairs ORDER BY source_rank, rec",
    "prefix_limit": f"SELECT row_id, description FROM clip_descriptions_copy WHERE coalesce({sql_strip('description')}, '') <> '' ORDER BY row_id LIMIT 100",
    "group_limit": "SELECT video_id, clip_number, row_id FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY clip_number, row_id) AS k FROM clip_descriptions_copy WHERE video_id IS NOT NULL AND clip_number IS NOT NULL) WHERE k <= 3",
    "verdict_parse": f"WITH {_ANSWERS} SELECT doc_id, ({_contains('low', V.AFFIRMING)} AND NOT {_contains('low', V.NEGATING)}) OR ({_contains('low', V.GAME_WORDS)} AND NOT {_contains('low', V.NEGATING + V.OTHER_GAMES)}) AS legacy, {_STRICT} AS strict, {_HEAD} AS reason FROM (SELECT *, lower(answer) AS low FROM answers)",
    "verdict_tally": f"WITH {_ANSWERS} SELECT {_STRICT} AS verdict, count(*) AS n_videos FROM answers GROUP BY 1",
    "delete_plan": f"WITH {_ANSWERS} SELECT path, regexp_replace(path, '\\.mp4$', '.json') AS sidecar, lang IS NOT NULL AS exists FROM answers WHERE contains({_HEAD}, '{V.DENIAL}')",
    "qa_parse_numbered": _parse_sql(_NUMBERED_RESPONSE),
    "qa_parse_loose": _parse_sql(_LOOSE_RESPONSE),
    "json_field_scan": "SELECT TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n_events FROM events GROUP BY 1",
    "type_audit": f"WITH {_TYPED} SELECT is_bad, count(*) AS n_rows, min(event_id) AS first_id FROM typed GROUP BY 1",
    "type_audit_first": f"WITH {_TYPED} SELECT event_id FROM typed WHERE is_bad ORDER BY event_id LIMIT 50",
    "file_suffixes": """WITH f AS (SELECT lower(x) AS suffix, x FROM (SELECT CASE qa_id % 4 WHEN 0 THEN '.MP4' WHEN 1 THEN '.Mkv' WHEN 2 THEN '.json' ELSE '.mp4' END AS x FROM clip_qa_pairs WHERE source_clip_path IS NOT NULL) WHERE x <> '.json')
 SELECT suffix, count(*) AS n_files, CAST(count_if(x = lower(x) OR x = upper(x)) AS BIGINT) AS n_plain FROM f GROUP BY 1""",
}
