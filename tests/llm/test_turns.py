import random

import pytest

from cliplake.llm.turns import combine_runs, name_candidates, name_key, parse_cue, roster_names, speaker_turns, turn_words

ROSTER = [("s1", "解说阿岚", ["阿岚", "Caster Lan"]), ("s2", "Player Bo", ["TV", None]), ("s3", "Solo", None)]
NAMES = {name_key(n): i for i, d, a in ROSTER for n in [d, *(a or [])] if n}
ROSTER_DDL = "speaker_id string, display_name string, aliases array<string>"
CUES_DDL = "cue_id long, video_id string, text string, start_ms long, end_ms long, speaker string, words string, turn long"


@pytest.mark.parametrize(
    ("text", "speaker", "words"),
    [
        ("解说阿岚：好球", "s1", "好球"),
        ("阿岚 : 好球", "s1", "好球"),
        ("[caster  LAN] nice shot", "s1", "nice shot"),
        ("【ＴＶ】好球", "s2", "好球"),
        ("<v Solo> hello", "s3", "hello"),
        (">> player bo: go", "s2", "go"),
        ("00:00:01,500 --> 00:00:02,000\nTV：走", "s2", "走"),
        ("12\n00:00:01,500 --> 00:00:02,000\n走", None, "走"),
        ("[01:23] (阿岚) 啊，好球（枪声）", "s1", "好球"),
        ("比分 2:11 很近", None, "比分 2:11 很近"),
        ("从这里可以学到：等队友", None, "从这里可以学到：等队友"),
        ("score is 2:11 uh, close", None, "score is 2:11 close"),
        ("等待呃，残局", None, "等待残局"),
        ("[音乐] 阿岚：走", "s1", "走"),
        ("阿岚：（笑）", "s1", ""),
        ("阿岚：嗯，嗯……", "s1", ""),
        ("um, uh", None, ""),
        ("you know, uh", None, ""),
        ("♪ 背景音乐 ♪", None, ""),
        ("*键盘声*", None, ""),
        ("[00:00:01]", None, ""),
        ("00:01:14,500", None, ""),
        ("...", None, ""),
        ("", None, ""),
        (None, None, ""),
        ("阿岚", None, ""),
        ("解说阿岚：TV。", "s1", ""),
        ("阿岚说：好球", "s1", "好球"),
        ("阿岚 - 好球", "s1", "好球"),
        ("Tov: text", None, "Tov: text"),
    ],
)
def test_parse_cue(text, speaker, words):
    assert parse_cue(text, NAMES) == (speaker, words)


def brute(rows):
    once = {}
    for cue, video, text, s, e in rows:
        if None in (cue, video, text, s):
            continue
        key = (video, text, s, e)
        once[key] = min(cue, once.get(key, cue))
    by = {}
    for (video, text, s, _), cue in once.items():
        speaker, words = parse_cue(text, NAMES)
        if words:
            by.setdefault(video, []).append((s, cue, speaker))
    out = set()
    for video, cues in by.items():
        cues.sort()
        last, first, prior = "unknown", None, None
        for _, cue, speaker in cues:
            speaker = speaker or last
            if first is None or speaker != last:
                if first is not None:
                    out.add((video, last, first, prior))
                first, last = cue, speaker
            prior = cue
        out.add((video, last, first, prior))
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("partitions", [1, 9])
def test_turns_equal_brute_force_with_a_hot_video(spark, seed, partitions):
    rng = random.Random(seed)
    rows = []
    for k in range(250):
        video = "hot" if rng.random() < 0.6 else rng.choice("abcd")
        text = rng.choice(["阿岚：", "TV: ", "[Solo] ", "", "", "", "", ""]) + rng.choice(["走", "打", "嗯", "（笑）", "go left"])
        rows.append((k, video, text, rng.randrange(60), rng.choice([None, 5, 100])))
    rows += [(900, "hot", "阿岚：走", None, 3), (901, None, "走", 1, 3), (902, "a", None, 1, 3), (3, *rows[3][1:])]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], CUES_DDL)
    roster = spark.createDataFrame(ROSTER, ROSTER_DDL)
    got = {(r.video_id, r.speaker_id, r.first_cue_id, r.last_cue_id) for r in speaker_turns(df, roster, partitions).collect()}
    assert got == brute(rows)
    if seed == 0:
        # a roster too large for the tasks is joined by name
        joined = {(r.video_id, r.speaker_id, r.first_cue_id, r.last_cue_id) for r in speaker_turns(df, roster, partitions, max_names=1).collect()}
        assert joined == got
        parts = turn_words(df, roster, partitions, part_cues=3).collect()
        assert max(p.n_cues for p in parts) == 3
        turns = {}
        for p in sorted(parts, key=lambda p: (p.start_ms, p.part_cue_id)):
            v, sp, first, last, n, words = turns.get((p.video_id, p.first_cue_id), (p.video_id, p.speaker_id, p.first_cue_id, None, 0, ""))
            turns[p.video_id, p.first_cue_id] = (v, p.speaker_id, first, p.last_cue_id, n + p.n_cues, words + p.words)
        whole = {(r.video_id, r.first_cue_id): r.n_cues for r in speaker_turns(df, roster, partitions).collect()}
        assert {t[:4] for t in turns.values()} == got and {k: t[4] for k, t in turns.items()} == whole


def test_candidates_hold_every_name_that_matters():
    rng = random.Random(5)
    bits = ["阿岚", "TV", "Solo", "：", ": ", "[", "]", "（", "）", "<v ", ">", "00:01:02", " - ", "走", " ", "vTV", "嗯", "说："]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 9)))
        names = {k: k for k in rng.sample(["阿岚", "tv", "solo", "vtv", "走", "阿岚tv", "嗯"], 3)}
        few = {k: names[k] for k in name_candidates(text) if k in names}
        assert parse_cue(text, few) == parse_cue(text, names), text


def test_empty_tables_and_words(spark):
    roster, cues = spark.createDataFrame(ROSTER, ROSTER_DDL), spark.createDataFrame([], CUES_DDL)
    assert speaker_turns(cues, roster).count() == 0
    assert turn_words(cues, roster).count() == 0
    df = spark.createDataFrame([(1, "v", "阿岚：走", 0, 5, "", "", 0), (2, "v", "go " * 5000, 3, 9, "", "", 0)], CUES_DDL)
    (turn,) = speaker_turns(df, roster, 1).collect()
    (words,) = turn_words(df, roster, 1).collect()
    assert words.words.startswith("走 go go") and (turn.start_ms, turn.end_ms, turn.n_cues) == (0, 9, 2)
    (unknown,) = turn_words(df, roster.where("false"), 1).where("first_cue_id = 1").collect()
    assert unknown.speaker_id == "unknown" and unknown.words.startswith("阿岚：走")


def test_combined_runs():
    runs = [(0, "v", 3, None, "a", 10), (1, "v", 1, None, None, 11), (2, "v", 2, None, "a", 12), (3, "v", 2, None, "b", 13), (4, "w", 1, "b", "b", 14)]
    assert combine_runs(runs) == {1: ("v", "a", 10), 2: ("v", "a", 10), 3: ("v", "a", 10), 4: ("v", "b", 13)}


def test_names_shared_by_entries_go_to_the_smallest_id(spark):
    rows = [("b", "Max", ["M X", None]), ("a", "max", None), (None, "Zed", []), ("c", None, ["Ｍx"])]
    got = {r.key: r.speaker for r in roster_names(spark.createDataFrame(rows, "speaker_id string, display_name string, aliases array<string>")).collect()}
    assert got == {"max": "a", "mx": "b"}
