"""Raw transcript cues to clean, ordered speaker turns.

Each cue runs through a finite-state line parser (marks -> label -> body). Kept cues are range-sorted by
(video, start, cue) over all partitions; each partition folds its cues to local runs, one summary row per
partition is prefix-combined, and the runs are rescanned with the carried speaker. No video and no turn is
gathered: a long turn's words come in parts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.session import cut_lineage, table_partitions, write_out

UNKNOWN = "unknown"
#: Names up to which the roster goes to every task; of a larger one each cue gets those it mentions, by a join.
MAX_ROSTER_NAMES = 50_000
#: A turn's words come in parts of at most so many cues or characters, so that no turn is gathered in one row.
PART_CUES, PART_CHARS = 1_000, 100_000

# Hesitations that carry no word when they stand alone.
_FILLER = re.compile(
    r"(?:嗯+|啊+|呃+|额+|唔+|哦+|噢+|喔+|诶+|欸+|哎+|唉+|呀+|哈+|那个|这个|怎么说呢|怎么说|就是说|就是|然后呢"
    r"|u+h+|u+h*m+|e+r+m*|h+m+|m+h*m+|m+|a+h+|o+h+|e+h+|you know|i mean|sort of|kind of|like|well|えっと|あの|음|어)",
    re.I,
)
_PIECE = re.compile(r"[^\s\W_]+(?:['’-][^\s\W_]+)*", re.U)
_STAMP = r"\d{1,2}\s?[:：]\s?\d{2}\s?[:：]\s?\d{2}(?:[.,，．]\d{1,3})?"
_SHORT_STAMP = r"\d{1,3}[:：]\d{2}(?:[.,]\d{1,3})?"
_LEAD = re.compile(
    rf"\s+|\d+[ \t]*\n(?=\s*\d{{1,2}}:)|{_STAMP}|{_SHORT_STAMP}(?=\s*(?:-+>|$))|-+>|>{{2,}}|»|[-–—•]+(?=\s)|﻿|​"
)
_PAIRS = {"[": "]", "【": "】", "(": ")", "（": "）", "<": ">", "〈": "〉", "{": "}", "［": "］", "＜": "＞", "〔": "〕"}
_BRACKET = re.compile(r"\[([^\]]*)\]|【([^】]*)】|[(（]([^)）]*)[)）]|[<＜]([^>＞]*)[>＞]|〈([^〉]*)〉|\{([^}]*)\}|［([^］]*)］|〔([^〕]*)〕")
_STAMP_ONLY = re.compile(rf"\s*(?:{_STAMP}|{_SHORT_STAMP})(?:\s*(?:-+>|[-–~])\s*(?:{_STAMP}|{_SHORT_STAMP})?)?\s*$")
_LABEL = re.compile(r"([^:：\[\]【】()（）<>♪*\n]{1,40}?)(?:\s*(?:说道?|says?|said))?(?:\s*[:：]|\s+[-–—|>»](?=\s))")
_NOTE = re.compile(r"\*[^*\n]{1,60}\*|♪[^♪]*♪|[♪♫♬]+|#[^#\n]{1,60}#(?=\s|$)")
_INNER_STAMP = re.compile(rf"[\[(【（<]\s*(?:{_STAMP}|{_SHORT_STAMP})\s*[\])】）>]|{_STAMP}\s*-+>\s*{_STAMP}")
_EDGE = re.compile(r"^[\s,，、.。…·\-–—:：;；]+|\s+$")
_GLUED = re.compile(r"(?:嗯+|啊+|呃+|唔+)[，,、…]+|(?<![^\W_])(?:怎么说呢|那个|uh+|u+h*m+|e+rm*|you know|i mean)\s*[,，、…]+\s*", re.I)


def name_key(name: str | None) -> str:
    """Spelling-free form of a speaker name: NFKC, case-folded, without white space."""
    return "".join(unicodedata.normalize("NFKC", name or "").casefold().split())


def parse_cue(text: str | None, names: dict[str, str]) -> tuple[str | None, str]:
    """One cue to (speaker id or None, spoken words). Words are '' if nothing is spoken.

    States: MARKS eats time marks, arrows and sound notes; LABEL accepts one roster name in a bracket or
    before a colon; BODY strips annotations and standalone fillers.
    """
    if not text:
        return None, ""
    at, speaker, size = 0, None, len(text)
    state = "MARKS"
    while state != "BODY":
        lead = _LEAD.match(text, at)
        if lead and lead.end() > at:
            at = lead.end()
            continue
        if at >= size:
            break
        bracket = _BRACKET.match(text, at)
        if bracket:
            inner = next(g for g in bracket.groups() if g is not None)
            key = name_key(inner)
            if key.startswith("v") and key not in names and key[1:] in names:  # <v Name>
                key = key[1:]
            if speaker is None and key.rstrip(":：") in names:
                speaker = names[key.rstrip(":：")]
            at = bracket.end()  # a label, a time mark or a sound note
            if speaker is not None and text[at : at + 1] in (":", "："):
                at += 1
            continue
        note = _NOTE.match(text, at)
        if note:
            at = note.end()
            continue
        if speaker is None and (label := _LABEL.match(text, at)) and (key := name_key(label[1].strip("-–—>» "))) in names:
            speaker = names[key]
            at = label.end()
            continue
        state = "BODY"
    body = _INNER_STAMP.sub(" ", text[at:])
    body = _BRACKET.sub(" ", _NOTE.sub(" ", body))
    words = _strip_fillers(body)
    return speaker, "" if name_key(words.strip(" .,，。!！?？:：")) in names else words


def _strip_fillers(body: str) -> str:
    plain = re.sub(r"\b(?:you know|i mean|sort of|kind of)\b", " uh ", body, flags=re.I)
    if all(_FILLER.fullmatch(w) for w in _PIECE.findall(plain)):
        return ""
    previous = None
    while previous != body:
        previous, body = body, _GLUED.sub("", body)
    body = re.sub(r"(?:^|(?<=[\s，,。.…]))(?:嗯+|啊+|呃+|uh+|u+hm+|um+|uhm|erm?)(?=$|[\s，,。.…])", "", body, flags=re.I)
    body = re.sub(r"[ \t　]{2,}", " ", re.sub(r"\s*\n\s*", " ", body))
    return _EDGE.sub("", body)


class _Asked(dict):
    """A roster that knows one name at most and keeps every name that it is asked for."""

    def __init__(self, known: str | None):
        super().__init__({} if known is None else {known: known})
        self.keys_asked: set[str] = set()

    def __contains__(self, key: object) -> bool:
        self.keys_asked.add(str(key))
        return super().__contains__(key)


def name_candidates(text: str | None) -> set[str]:
    """Every name key that :func:`parse_cue` can look up in this text, whatever the roster: of the names that a
    roster knows, the first one met decides the further path."""
    found: set[str] = set()
    todo: list[str | None] = [None]
    while todo:
        asked = _Asked(todo.pop())
        parse_cue(text, asked)
        todo += asked.keys_asked - found
        found |= asked.keys_asked
    return found - {""}


def roster_names(roster: DataFrame) -> DataFrame:
    """(key, speaker): every spelling of the roster's names; one that entries share goes to the smallest id.

    Null names and ids are skipped.
    """
    names = roster.select(
        F.col("speaker_id").cast("string").alias("speaker"), F.explode(F.concat(F.array("display_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("n")
    ).where("n is not null and speaker is not null")
    key = F.pandas_udf(lambda s: s.map(name_key), "string")
    return names.select(key("n").alias("key"), "speaker").where("key <> ''").groupBy("key").agg(F.min("speaker").alias("speaker"))


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(v, c, k) for v, c, t in zip(pdf["video_id"], pdf["cue_id"], pdf["text"], strict=True) for k in sorted(name_candidates(t))]
        yield pd.DataFrame(rows, columns=["video_id", "cue_id", "key"])


def _with_known(cues: DataFrame, names: DataFrame) -> DataFrame:
    """``cues`` with the column known: the names of the roster among those that a cue mentions, with their speakers."""
    asked = cues.mapInPandas(_candidates, "video_id string, cue_id long, key string").join(names, "key")
    known = asked.groupBy("video_id", "cue_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "speaker"))).alias("known"))  # a cue's few names
    return cues.join(known, ["video_id", "cue_id"], "left")


_RUNS = "pid int, video_id string, speaker string, seq int, part int, first_cue long, last_cue long, first_ms long, last_ms long, n_cues long, words string"


def _parser(names: dict[str, str] | None, words: bool):
    """Cues parsed with the given names, or with each cue's own; ``words`` are kept or only known to be there."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rosters = [dict(m) if m is not None else {} for m in pdf["known"]] if names is None else [names] * len(pdf)
            done = [parse_cue(t, m) for t, m in zip(pdf["text"], rosters, strict=True)]
            kept = [d[1] != "" for d in done]
            out = pdf.assign(speaker=[d[0] for d in done], words=[d[1] if words else None for d in done])
            yield out.loc[kept, ["video_id", "cue_id", "start_ms", "end_ms", "speaker", "words"]]

    return parse


def _join_words(parts: list[str]) -> str:
    out = ""
    for p in parts:
        out += (" " if out and (out[-1].isascii() or p[:1].isascii()) else "") + p
    return out


def _fold_runs(part_cues: int, part_chars: int):
    """Sorted kept cues of a partition to its local runs; a run before any name has a null speaker.

    A run with words is cut in parts of bounded size, which share their ``seq``.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cur: dict | None = None
        size = 0
        for pdf in batches:
            out = []
            for pid, video, cue, s, e, speaker, words in zip(
                pdf["pid"], pdf["video_id"], pdf["cue_id"], pdf["start_ms"], pdf["end_ms"], pdf["speaker"], pdf["words"], strict=True
            ):
                e = s if e is None or e != e else max(int(e), s)
                seq = part = 0
                if cur is not None and cur["video_id"] == video:
                    goes_on = speaker is None or speaker == cur["speaker"]
                    full = words is not None and (cur["n_cues"] >= part_cues or size + len(words) > part_chars)
                    if goes_on and not full:
                        cur["last_cue"], cur["last_ms"] = cue, max(cur["last_ms"], e)
                        cur["n_cues"] += 1
                        if words is not None:
                            cur["words"].append(words)
                            size += len(words)
                        continue
                    seq, part = (cur["seq"], cur["part"] + 1) if goes_on else (cur["seq"] + 1, 0)
                    speaker = cur["speaker"] if goes_on else speaker
                if cur is not None:
                    out.append(cur | {"words": _join_words(cur["words"])})
                size = len(words or "")
                cur = {
                    "pid": pid, "video_id": video, "speaker": speaker, "seq": seq, "part": part, "first_cue": cue, "last_cue": cue,
                    "first_ms": s, "last_ms": e, "n_cues": 1, "words": [words] if words is not None else [],
                }
            if out:
                yield pd.DataFrame(out)
        if cur is not None:
            yield pd.DataFrame([cur | {"words": _join_words(cur["words"])}])

    return fold


def combine_runs(summaries: list[tuple]) -> dict[int, tuple[str, str | None, int]]:
    """Prefix-combine (pid, last video, runs, first run's speaker, last run's speaker, its first cue).

    The state before a partition is (video, speaker, first cue of the open turn).
    """
    carried: dict[int, tuple] = {}
    state: tuple | None = None
    for pid, video, runs, first_speaker, speaker, cue in sorted(summaries, key=lambda x: x[0]):
        if state is not None:
            carried[pid] = state
        if state is None or state[0] != video:
            state = (video, speaker, cue)
        elif runs == 1 and (speaker is None or speaker == state[1]):
            pass  # the open turn goes on
        elif runs == 2 and first_speaker is None and speaker == state[1]:
            pass
        else:
            state = (video, speaker, cue)
    return carried


def _resolve(carried: dict[int, tuple]):
    def rescan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for pdf in batches:
            speakers, labels = [], []
            for pid, video, speaker, cue in zip(pdf["pid"], pdf["video_id"], pdf["speaker"], pdf["first_cue"], strict=True):
                if pid != at:
                    at, state = pid, carried.get(int(pid))
                if state is not None and state[0] == video and (speaker is None or speaker == state[1]):
                    speakers.append(state[1])
                    labels.append(state[2])
                else:
                    state = (video, speaker, cue)
                    speakers.append(speaker)
                    labels.append(cue)
            yield pdf.assign(speaker=speakers, turn=labels)

    return rescan


def _parts(cues: DataFrame, roster: DataFrame, partitions: int | None, words: bool, max_names: int, part_cues: int = PART_CUES) -> DataFrame:
    """The local runs of all partitions with their turn's speaker and first cue."""
    spark = cues.sparkSession
    once = (
        cues.select(F.col("video_id").cast("string").alias("video_id"), "text", F.col("start_ms").cast("long").alias("start_ms"), F.col("end_ms").cast("long").alias("end_ms"), "cue_id")
        .where("video_id is not null and text is not null and start_ms is not null and cue_id is not null")
        .groupBy("video_id", "text", "start_ms", "end_ms")
        .agg(F.min("cue_id").alias("cue_id"))
    )
    names = roster_names(roster)
    few = names.limit(max_names + 1).collect()
    small = {r.key: r.speaker for r in few} if len(few) <= max_names else None
    known = once if small is not None else _with_known(write_out(once), write_out(names))
    kept = known.mapInPandas(_parser(small, words), "video_id string, cue_id long, start_ms long, end_ms long, speaker string, words string")
    order = ["video_id", "start_ms", "cue_id"]
    ranged = cut_lineage(kept).repartitionByRange(partitions or table_partitions(spark), *order).sortWithinPartitions(*order)
    runs = cut_lineage(ranged.withColumn("pid", F.spark_partition_id()).mapInPandas(_fold_runs(part_cues, PART_CHARS), _RUNS))
    # one row per (partition, its last video): bounded by the partition count
    per_video = runs.groupBy("pid", "video_id").agg(
        (F.max("seq") + 1).alias("n"),
        F.min(F.struct("seq", "part", "speaker")).alias("lo"),
        F.max(F.struct("seq", -F.col("part"), "speaker", "first_cue")).alias("hi"),
    )
    last = per_video.groupBy("pid").agg(F.max(F.struct("video_id", "n", "lo", "hi")).alias("x"))
    summaries = [(r.pid, r.x.video_id, r.x.n, r.x.lo.speaker, r.x.hi.speaker, r.x.hi.first_cue) for r in last.collect()]
    return runs.mapInPandas(_resolve(combine_runs(summaries)), _RUNS + ", turn long")


def speaker_turns(cues: DataFrame, roster: DataFrame, partitions: int | None = None, max_names: int = MAX_ROSTER_NAMES) -> DataFrame:
    """Turns (video_id, speaker_id, first_cue_id, last_cue_id, start_ms, end_ms, n_cues) per video, without their words.

    Cues with a null start, text, cue id or video id are left out; a missing or earlier end counts as the
    start. Cues equal in video, text, start and end count once, by the smallest cue id. Cues that tie in
    start are ordered by cue id. A cue without a spoken word is dropped and changes no speaker. Before the
    first name of a video the speaker is ``unknown``. Empty tables give no rows; other columns are not read.
    """
    return (
        _parts(cues, roster, partitions, False, max_names)
        .groupBy("video_id", "turn")
        .agg(
            F.first("speaker", ignorenulls=True).alias("speaker_id"),
            F.max(F.struct("pid", "seq", "part", "last_cue")).alias("z"),
            F.min("first_ms").alias("start_ms"),
            F.max("last_ms").alias("end_ms"),
            F.sum("n_cues").alias("n_cues"),
        )
        .select(
            "video_id",
            F.coalesce("speaker_id", F.lit(UNKNOWN)).alias("speaker_id"),
            F.col("turn").alias("first_cue_id"),
            F.col("z.last_cue").alias("last_cue_id"),
            "start_ms", "end_ms", "n_cues",
        )
    )


def turn_words(cues: DataFrame, roster: DataFrame, partitions: int | None = None, max_names: int = MAX_ROSTER_NAMES, part_cues: int = PART_CUES) -> DataFrame:
    """The clean words of the turns: (video_id, speaker_id, first_cue_id, part_cue_id, last_cue_id, start_ms, end_ms, n_cues, words).

    ``first_cue_id`` is the turn's, the rest the part's. A turn is one part, unless it is longer than
    ``part_cues`` cues or PART_CHARS characters or crosses the border of a task: then its parts follow each other by
    (start_ms, part_cue_id). Rows are left out as in :func:`speaker_turns`.
    """
    return _parts(cues, roster, partitions, True, max_names, part_cues).select(
        "video_id", F.coalesce("speaker", F.lit(UNKNOWN)).alias("speaker_id"), F.col("turn").alias("first_cue_id"), F.col("first_cue").alias("part_cue_id"),
        F.col("last_cue").alias("last_cue_id"), F.col("first_ms").alias("start_ms"), F.col("last_ms").alias("end_ms"), "n_cues", "words",
    )
