"""Prompts and training records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from cliplake.functions.paths import commentary_name, legacy_name, rebase
from cliplake.functions.text import PLACEHOLDER, is_blank, or_else, previous_text, seeded_choice, strip, tail_truncate

# Wording of the prompts, which records must carry literally.
OPENING = "<video>\n这是cs2的游戏画面，你现在是我的游戏AI助手"
ADVICE = "详细描述视频内容，并给出专业的游戏解说和分析，包括战术策略、操作技巧和关键决策。"
PREVIOUS_ADVICE = "\n上一个连续视频片段的建议内容: "
GAME_COMMENTARY = "请观看这个游戏视频片段，并给出专业的游戏解说和分析，包括战术策略、操作技巧和关键决策。"
OTHER_COMMENTARY = "请观看视频并给出解说: Provide a commentary on a mechanical repair process, highlighting specific measurements and steps involved."
LEGACY_PROMPTS = [
    "请观看这个游戏视频片段，并给出专业的游戏解说和分析。",
    "请分析这个游戏片段中的战术策略和操作技巧。",
    "请详细解说这个游戏视频中的关键操作和决策。",
    "请从专业角度分析这个游戏片段的亮点和技巧。",
    "请观看视频并解释游戏中的战术运用和团队配合。",
    "请分析这个游戏片段中的操作细节和策略思路。",
    "请解说这个游戏视频中的精彩操作和战术分析。",
    "请从游戏专业角度分析这个片段的技巧和策略。",
    "请详细分析这个游戏视频中的操作技巧和战术运用。",
    "请观看并解说这个游戏片段中的关键操作和决策过程。",
]


@dataclass(frozen=True)
class RecordOptions:
    data_path: str = "dataset"
    video_base: str = "video_clips_6_15s"
    category: str = "cs2_web_data"
    most_previous: int = 500
    scene_label: str = "【画面描述】"
    advice_label: str = "【游戏建议】"
    seed: int = 42


def title_of(video: Column) -> Column:
    return F.when(F.coalesce(video, F.lit("")) == "", "").otherwise(F.concat(video, F.lit("_")))


def source_of(video: Column) -> Column:
    return F.when(F.coalesce(video, F.lit("")) == "", "unknown.json").otherwise(F.concat(video, F.lit(".json")))


def stored_duration(duration: Column, start: Column, end: Column) -> Column:
    """The stored value, else end - start, missing times counting as 0."""
    return F.coalesce(duration, F.coalesce(end, F.lit(0.0)) - F.coalesce(start, F.lit(0.0)))


def truthy_duration(start: Column, end: Column) -> Column:
    """end - start if there is an end other than 0 and a start, else 0."""
    return F.when((F.coalesce(end, F.lit(0.0)) != 0) & start.isNotNull(), end - start).otherwise(F.lit(0.0))


def record(video: Column, human: Column, gpt: Column, metadata: Column, data_path: str | None) -> Column:
    said = F.array(
        F.struct(F.lit("human").alias("from"), human.alias("value")), F.struct(F.lit("gpt").alias("from"), gpt.alias("value"))
    )
    fields = [video.alias("video")] + ([F.lit(data_path).alias("data_path")] if data_path is not None else [])
    return F.struct(*fields, said.alias("conversations"), metadata.alias("metadata"))


def _metadata(title: Column, category: Column, start: Column, end: Column, duration: Column, source: Column) -> Column:
    return F.struct(
        title.alias("title"), category.alias("category"), start.alias("video_start"), end.alias("video_end"), duration.alias("duration"), source.alias("source_file")
    )


def previous_clause(previous: Column) -> Column:
    return F.when(previous == PLACEHOLDER, "").otherwise(F.concat(F.lit(PREVIOUS_ADVICE), previous))


def pair_record(previous: Column, current: Column, o: RecordOptions) -> Column:
    """The record of a clip pair; null where the current clip has no description."""
    before = previous_text(previous["description"], o.most_previous)
    human = F.concat(F.lit(OPENING + "，请给我一些指导建议"), previous_clause(before), F.lit(f"\n请观看这个游戏视频片段: {ADVICE}"))
    start, end = F.coalesce(current["start_time"], F.lit(0.0)), F.coalesce(current["end_time"], F.lit(0.0))
    meta = _metadata(
        title_of(current["video_id"]), F.lit(o.category), start, end, stored_duration(current["duration"], start, end), source_of(current["video_id"])
    )
    made = record(rebase(F.coalesce(current["clip_path"], F.lit("")), o.video_base), human, strip(current["description"]), meta, o.data_path)
    return F.when(~is_blank(current["description"]), made)


def merged_record(scene: Column, previous: Column, current: Column, o: RecordOptions) -> Column:
    """The record of a pair whose answer joins the scene's description and the advice; null if both are blank."""
    answer = F.concat_ws(
        "\n\n",
        F.when(~is_blank(scene), F.concat(F.lit(f"{o.scene_label}\n"), strip(scene))),
        F.when(~is_blank(current["description"]), F.concat(F.lit(f"{o.advice_label}\n"), strip(current["description"]))),
    )
    before = previous_text(previous["description"], o.most_previous)
    human = F.concat(F.lit(OPENING + "，请给我一些指导建议"), previous_clause(before), F.lit(f"\n请观看这个游戏视频片段，{ADVICE}"))
    start, end = F.coalesce(current["start_time"], F.lit(0.0)), F.coalesce(current["end_time"], F.lit(0.0))
    meta = _metadata(
        title_of(current["video_id"]), F.lit(o.category), start, end, stored_duration(current["duration"], start, end), source_of(current["video_id"])
    )
    made = record(rebase(F.coalesce(current["clip_path"], F.lit("")), o.video_base), human, answer, meta, o.data_path)
    return F.when(answer != "", made)


def qa_record(question: Column, answer: Column, path: Column, video: Column, start: Column, end: Column, o: RecordOptions) -> Column:
    """The record of a question and its answer; null where one of them or the path is blank."""
    q, a, vid = strip(question), strip(answer), strip(F.coalesce(video, F.lit("")))
    human = F.concat(F.lit(OPENING + "。\n请根据这个游戏视频片段回答下面的问题："), q)
    meta = _metadata(title_of(vid), F.lit(o.category), start, end, truthy_duration(start, end), source_of(vid))
    whole = ~is_blank(question) & ~is_blank(answer) & or_else(path).isNotNull()
    return F.when(whole, record(rebase(path, o.video_base), human, a, meta, o.data_path))


def commentary_record(clip: Column, o: RecordOptions) -> Column:
    """The record of a commentary clip (video, content, previous, title, category, start_time, end_time)."""
    category, previous = F.coalesce(clip["category"], F.lit("")), F.coalesce(clip["previous"], F.lit(""))
    low = F.lower(category)
    ask = F.when(low.contains("cs2") | low.contains("game"), GAME_COMMENTARY).otherwise(OTHER_COMMENTARY)
    before = F.when(previous == "", PLACEHOLDER).otherwise(tail_truncate(previous, 500))
    clause = F.when(before == PLACEHOLDER, "").otherwise(F.concat(F.lit("\n之前的解说内容: "), before))
    human = F.concat(F.lit("<video>\n视频标题: "), clip["title"], F.lit("\n类别: "), category, clause, F.lit("\n请观看视频并给出解说: "), ask)
    said = F.array_join(F.transform(clip["content"], lambda w: w["word"]), " ")
    start, end = clip["start_time"], clip["end_time"]
    meta = _metadata(clip["title"], category, start, end, end - start, F.concat(clip["video"], F.lit(".json")))
    return record(F.concat(F.lit("videos/"), commentary_name(clip["video"], start, end)), human, said, meta, o.data_path)


def legacy_record(video: Column, start: Column, end: Column, said: Column, previous: Column, title: Column, category: Column, o: RecordOptions) -> Column:
    """The older layout: no data path, a context of over 10 characters, a prompt picked by the clip's hash."""
    name = legacy_name(video, start, end)
    context = F.concat(F.lit('基于之前的解说内容："'), tail_truncate(previous, 200), F.lit(f'"\n\n{LEGACY_PROMPTS[0]}'))
    ask = F.when(F.length(F.coalesce(previous, F.lit(""))) > 10, context).otherwise(seeded_choice(LEGACY_PROMPTS, name, o.seed))
    meta = F.when(
        (F.coalesce(title, F.lit("")) != "") | (F.coalesce(category, F.lit("")) != ""),
        F.struct(
            title.alias("title"), category.alias("category"), video.alias("video_id"), start.alias("start_time"), end.alias("end_time"), (end - start).alias("duration")
        ),
    )
    return record(F.concat(F.lit("videos_val/"), name), F.concat(F.lit("<video>\n"), ask), said, meta, None)
