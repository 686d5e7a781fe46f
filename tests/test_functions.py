import random

import pytest
from pyspark.sql import functions as F

from cliplake.functions import paths as P
from cliplake.functions import text as T
from cliplake.functions import verdict as V
from cliplake.functions.frames import frame_plan
from cliplake.functions.qa import parse_pairs, qa_prompt
from cliplake.functions.records import RecordOptions, commentary_record, legacy_record, pair_record, qa_record, stored_duration, truthy_duration
from cliplake.functions.rounding import exact_round, fixed2, hms


def one(spark, value, kind, *columns):
    return spark.createDataFrame([(value,)], f"x {kind}").select(*columns).first()


def test_rounding_equals_python(spark):
    rng = random.Random(1)
    values = [k / 1000 for k in range(0, 4001, 5)] + [rng.uniform(0, 5000) for _ in range(500)] + [0.125, 2.675, 0.35, 1.15, -0.25, -2.5]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", exact_round(F.col("x"), 1).alias("a"), fixed2(F.col("x")).alias("b")).collect()
    for r in rows:
        assert r.a == round(r.x, 1), r.x
        assert r.b == f"{r.x:.2f}", r.x


def test_hms_has_more_than_a_day(spark):
    assert one(spark, 90061.9, "double", hms(F.col("x")))[0] == "25:01:01"


@pytest.mark.parametrize("edge", ["", " ", "　", "\x85", " ", " ", "\x1c", "​", "﻿", "\n\t"])
def test_strip_equals_python(spark, edge):
    text = f"{edge}a {edge}b{edge}"
    assert one(spark, text, "string", T.strip("x"))[0] == text.strip()


def test_previous_text(spark):
    kinds = {None: "...", "": "...", "　": "...", "a": "a", "啊" * 500: "啊" * 500, "啊" * 501: "..." + "啊" * 500, "...": "..."}
    for text, wanted in kinds.items():
        assert one(spark, text, "string", T.previous_text("x"))[0] == wanted


def test_words_drop_consecutive_repeats_and_keep_empties(spark):
    assert one(spark, "go go left  left go", "string", T.words("x"))[0] == ["go", "left", "", "left", "go"]
    assert one(spark, "", "string", T.words("x"))[0] == [""]


def test_or_else_skips_null_and_empty(spark):
    row = spark.createDataFrame([("", None, "c")], "a string, b string, c string").select(T.or_else("a", "b", "c"), T.or_else("a", "b")).first()
    assert tuple(row) == ("c", None)


def test_clip_name_parse(spark):
    x = P.parse_clip_name(F.col("x"))
    cases = {
        "/d/av1__clip0002_6.50-13.00.mp4": ("av1", 2, 6.5, 13.0, 6.5),
        "x_clip0002_1.00-2.00.mp4": ("x_clip0002_1.00-2.00", 0, 0.0, 0.0, 0.0),
        "av1__clip0003_1.2.3-4.mp4": ("av1", 3, None, 4.0, None),
    }
    for name, wanted in cases.items():
        assert tuple(one(spark, name, "string", x.alias("p")).p) == wanted


def test_names(spark):
    row = spark.createDataFrame([("av1_", 3, 1.001, 2.675), ("av2", 12, 0.0, 10.0)], "v string, n long, s double, e double")
    made = row.select(
        P.clip_name(F.col("v"), F.col("n"), F.col("s"), F.col("e")), P.legacy_name(F.col("v"), F.col("s"), F.col("e")), P.commentary_name(F.col("v"), F.col("s"), F.col("e"))
    ).collect()
    assert tuple(made[0]) == ("av1__clip0003_1.00-2.67.mp4", "av1__1000_2675.mp4", "av1__1.00-2.67_2.0fps.mp4")
    assert tuple(made[1]) == ("av2__clip0012_0.00-10.00.mp4", "av2__0_10000.mp4", "av2_0.00-10.00_2.0fps.mp4")


def test_path_parts(spark):
    p = F.col("x")
    row = one(spark, "/a/b/c.d.MP4", "string", P.basename(p), P.stem(p), P.suffix(p), P.sidecar(p), P.rebase(p, "base"), P.rebase(p, "/a"), P.rebase(p, ""))
    assert tuple(row) == ("c.d.MP4", "c.d", ".MP4", "/a/b/c.d.json", "base/c.d.MP4", "/a/b/c.d.MP4", "/a/b/c.d.MP4")
    assert tuple(one(spark, ".hidden", "string", P.stem(p), P.suffix(p))) == (".hidden", "")


def test_rename_plan_names_are_unique(spark):
    paths = ["/r/a/x[id1].mp4", "/r/a/y[id1].mp4", "/r/b/z[id1].mp4", "/r/b/z[id1].mp4", "top[id2].json", "/r/a/none.mp4", None]
    rows = P.rename_plan(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    names = {r.path: r.new_name for r in rows}
    assert len(rows) == 5 and names["/r/a/x[id1].mp4"] == "id1.mp4" and names["/r/b/z[id1].mp4"] == "b_id1.mp4" and names["top[id2].json"] == "id2.json"
    assert names["/r/a/y[id1].mp4"].startswith("a_id1_") and names["/r/a/none.mp4"] is None
    made = [n for n in names.values() if n]
    assert len(made) == len(set(made))


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("问题1：a 答案1：b 问题2：c", [("a", "b")]),
        ("问题2: x\n答案2 ： y\n问题 1：p\n答案 1：q\nmore", [("p", "q\nmore"), ("x", "y")]),
        ("问题1：a 答案1：b 问题1：c 答案1：d", [("c", "d")]),
        ("问：a\n答：b\nQ: c\nA: d", [("a", "b"), ("c", "d")]),
        ("问：a\n答：b\n问：c", [("a", "b")]),
        ("问题１：全\n答案１：角", [("全", "角")]),
        ("", []),
        (None, []),
        ("no labels", []),
    ],
)
def test_parse_pairs(spark, text, wanted):
    got = one(spark, text, "string", parse_pairs(F.col("x")).alias("p")).p
    assert [(r.question, r.answer) for r in got] == wanted


def test_qa_prompt_has_as_many_slots_as_asked(spark):
    made = one(spark, "desc", "string", qa_prompt(F.col("x"), 3))[0]
    assert made.count("：<答案>") == 3 and "答案3：" in made and made.endswith("desc")


@pytest.mark.parametrize(
    ("text", "legacy", "strict", "denied"),
    [
        ("这是CS2游戏", True, None, False),
        ("是否是CS2或CSGO：是", False, True, False),
        ("是否是CS2或CSGO：否", False, False, True),
        ("I know it is cs2", False, None, False),
        ("地图是dust2", True, None, False),
        ("其他游戏，像dust2", False, None, False),
        ("", False, None, False),
        (None, False, None, False),
    ],
)
def test_verdicts(spark, text, legacy, strict, denied):
    x = F.col("x")
    assert tuple(one(spark, text, "string", V.legacy_verdict(x), V.strict_verdict(x), V.denied(x))) == (legacy, strict, denied)


def test_verdict_reason_is_cut(spark):
    assert one(spark, " " + "a" * 301, "string", V.verdict_reason(F.col("x")))[0] == "a" * 300 + "..."


@pytest.mark.parametrize(
    ("fps", "frames", "wanted"),
    [(30.0, 300, [0, 42, 85, 128, 171, 214, 257, 299]), (0.0, 60, [0, 59]), (30.0, 0, []), (30.0, 45, [22]), (30.0, 29, []), (None, 90, [0, 45, 89]), (30.0, None, [])],
)
def test_frame_plan(spark, fps, frames, wanted):
    row = spark.createDataFrame([(fps, frames)], "f double, n long").select(frame_plan(F.col("f"), F.col("n")).alias("p")).first()
    assert row.p == wanted


CLIP = "struct<clip_path:string,video_id:string,start_time:double,end_time:double,duration:double,description:string>"


def test_pair_record(spark):
    rows = [
        (("p", "v", 0.0, 1.0, 1.0, " 前 "), ("/x/c.mp4", "v", 1.0, 3.5, None, " now ")),
        (None, ("video_clips_6_15s/c.mp4", None, None, None, None, "now")),
        (("p", "v", 0.0, 1.0, 1.0, "..."), ("/x/c.mp4", "", 1.0, 3.0, 9.0, "now")),
        (None, ("/x/c.mp4", "v", 1.0, 3.0, 2.0, " 　")),
    ]
    df = spark.createDataFrame(rows, f"previous {CLIP}, current {CLIP}")
    made = [r.r for r in df.select(pair_record(F.col("previous"), F.col("current"), RecordOptions()).alias("r")).collect()]
    assert made[0].video == "video_clips_6_15s/c.mp4" and made[0].metadata.duration == 2.5 and made[0].metadata.title == "v_"
    assert "上一个连续视频片段的建议内容: 前\n" in made[0].conversations[0].value and made[0].conversations[1].value == "now"
    assert made[1].video == "video_clips_6_15s/c.mp4" and made[1].metadata.source_file == "unknown.json" and made[1].metadata.duration == 0.0
    assert "上一个" not in made[2].conversations[0].value and made[2].metadata.duration == 9.0
    assert made[3] is None


def test_qa_record_and_durations(spark):
    rows = [("q", "a", "/p/c.mp4", " v ", 1.0, 4.0), ("q", "a", "/p/c.mp4", None, 1.0, 0.0), (" ", "a", "/p", "v", 1.0, 2.0), ("q", "a", "", "v", 1.0, 2.0), ("q", "a", "/p", "v", None, 2.0)]
    df = spark.createDataFrame(rows, "q string, a string, p string, v string, s double, e double")
    made = [r.r for r in df.select(qa_record(*(F.col(c) for c in "qapvse"), RecordOptions()).alias("r")).collect()]
    assert made[0].metadata.title == "v_" and made[0].metadata.duration == 3.0 and made[1].metadata.duration == 0.0 and made[1].metadata.title == ""
    assert made[2] is None and made[3] is None and made[4].metadata.duration == 0.0
    t = spark.createDataFrame([(None, 1.0, 4.0), (7.0, 1.0, 4.0)], "d double, s double, e double")
    assert [r[0] for r in t.select(stored_duration(F.col("d"), F.col("s"), F.col("e"))).collect()] == [3.0, 7.0]
    assert [r[0] for r in t.select(truthy_duration(F.col("s"), F.col("e"))).collect()] == [3.0, 3.0]


def test_commentary_and_legacy_records(spark):
    kind = "struct<video:string,content:array<struct<start:double,end:double,word:string>>,previous:string,title:string,category:string,start_time:double,end_time:double>"
    clip = ("v", [(0.0, 1.0, "go"), (1.0, 2.0, "left")], "p" * 501, "t", "cars", 0.0, 2.0)
    r = one(spark, clip, kind, commentary_record(F.col("x"), RecordOptions()).alias("r")).r
    assert r.video == "videos/v_0.00-2.00_2.0fps.mp4" and r.conversations[1].value == "go left" and "mechanical" in r.conversations[0].value
    assert "之前的解说内容: ..." + "p" * 500 + "\n" in r.conversations[0].value
    rows = spark.createDataFrame([("v_", 0.0, 2.0, "said", "x" * 11, "t", ""), ("v_", 0.0, 2.0, "said", "x" * 10, "", "")], "v string, s double, e double, a string, p string, t string, c string")
    made = [x.r for x in rows.select(legacy_record(*(F.col(c) for c in "vseaptc"), RecordOptions()).alias("r")).collect()]
    assert "xxxxxxxxxxx" in made[0].conversations[0].value and made[0].metadata.duration == 2.0
    assert "xxx" not in made[1].conversations[0].value and made[1].metadata is None and made[1].video == "videos_val/v__0_2000.mp4"
