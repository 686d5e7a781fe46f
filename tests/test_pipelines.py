import json

import pytest
from pyspark.sql import functions as F

from cliplake.__main__ import main, parser
from cliplake.functions.frames import frame_plan
from cliplake.operators.inference import EchoVision, StillFrames, assign_devices, describe_clips, extract_frames, generate_qa, judge_videos
from cliplake.operators.media import EchoBackend, cut_commands
from cliplake.plans import pipelines as P
from cliplake.sources.jsonl import lines
from cliplake.sources.listing import count_videos
from cliplake.sources.sinks import run_file_actions, write_json_array


def jsonl(path, rows):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def read(folder):
    return [json.loads(x) for p in sorted(folder.glob("part-*")) for x in p.read_text(encoding="utf-8").splitlines()]


def clip(video, number, text, **more):
    name = f"{video}_clip{number:04d}_{number * 10:.2f}-{number * 10 + 8:.2f}.mp4"
    return {"clip_path": f"/c/{name}", "clip_filename": name, "video_id": video, "clip_number": number, "start_time": number * 10.0, "end_time": number * 10 + 8.0, "duration": 8.0, "description": text} | more


def test_commentary(spark, tmp_path):
    for k in range(3):
        cues = [{"text": f"w{i}", "start": i * 1000, "end": i * 1000 + 1000} for i in range(20)]
        (tmp_path / f"av{k}.json").write_text(json.dumps(cues), encoding="utf-8")
    (tmp_path / "bad.json").write_text("{", encoding="utf-8")
    out = tmp_path / "out"
    said = P.commentary(spark, str(tmp_path), str(out), 2, 3)
    rows = read(out)
    assert said["written"] == len(rows) and {r["metadata"]["source_file"] for r in rows} == {"av1.json"}
    assert rows[0]["conversations"][1]["value"].startswith("w0 w1")
    with pytest.raises(ValueError):
        P.commentary(spark, str(tmp_path), str(out), 0, 3)


def test_pairs_and_their_records(spark, tmp_path):
    clips = tmp_path / "clips"
    clips.mkdir()
    for v, n in (("v_", 1), ("v_", 2), ("w_", 1)):
        (clips / clip(v, n, "")["clip_filename"]).write_bytes(b"x")
    described = jsonl(tmp_path / "d.json", [clip("v_", 1, "old"), clip("v_", 1, "one"), clip("v_", 2, "two"), clip("w_", 2, "now"), clip("u_", 2, "no file")])
    out = tmp_path / "pairs"
    assert P.pair_clips(spark, described, str(clips), str(out), trim_ids=True)["written"] == 2
    pairs = {p["current_clip"]["video_id"]: p for p in read(out)}
    assert pairs["v_"]["previous_clip"]["description"] == "one" and pairs["w_"]["previous_clip"]["description"] is None
    assert P.pair_clips(spark, described, str(clips), str(tmp_path / "all"), include_missing=True, trim_ids=True)["written"] == 3
    assert P.pairs_to_training(spark, str(out), str(tmp_path / "t1"))["written"] == 2
    assert P.pairs_to_training(spark, str(out), str(tmp_path / "t2"), skip_no_previous=True)["written"] == 1
    scenes = jsonl(tmp_path / "s.jsonl", [clip("v_", 2, "scene"), clip("w_", 2, " ")])
    assert P.merge_to_training(spark, str(out), scenes, str(tmp_path / "m1"))["written"] == 2
    assert P.merge_to_training(spark, str(out), scenes, str(tmp_path / "m2"), skip_no_description=True)["written"] == 1
    (merged,) = read(tmp_path / "m2")
    assert merged["conversations"][1]["value"] == "【画面描述】\nscene\n\n【游戏建议】\ntwo"


def test_answers_and_merged_files(spark, tmp_path):
    qa = jsonl(tmp_path / "qa.jsonl", [{"question": f"q{k}", "answer": "a", "source_clip_path": "/p/c.mp4", "video_id": "v"} for k in range(9)] + [{"question": "", "answer": "a", "source_clip_path": "/p"}, {"question": "q", "answer": "a", "clip_path": "/p/d.mp4"}])
    assert P.qa_to_training(spark, qa, str(tmp_path / "t"))["written"] == 10
    folder = str(tmp_path / "t")
    assert P.merge_training_files(spark, [folder, folder], str(tmp_path / "u"))["written"] == 20
    first = [r["conversations"][0]["value"] for r in read(tmp_path / "u")]
    assert first[:10] == first[10:]
    P.merge_training_files(spark, [folder, folder], str(tmp_path / "s1"), shuffle=True)
    P.merge_training_files(spark, [folder, folder], str(tmp_path / "s2"), shuffle=True)
    assert read(tmp_path / "s1") == read(tmp_path / "s2") != read(tmp_path / "u")
    bad = jsonl(tmp_path / "bad.jsonl", [{"video": "a"}, {"video": 3}])
    assert [tuple(r) for r in P.audit_videos(spark, bad).collect()] == [(2, "bigint")]


def test_counted_metrics(spark):
    df, seen = P.counted(spark.range(5), "n", all=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    df.collect()
    assert seen.get == {"all": 5, "odd": 2}


def stand_ins():
    """Local classes, which go to the workers by value."""

    class Broken:
        def look(self, prompt, frames):
            raise RuntimeError("gone")

        generate = look

    class SomeFrames(StillFrames):
        def probe(self, path):
            if "bad" in path:
                raise ValueError("no video")
            return StillFrames.probe(self, path)

    return Broken, SomeFrames


def test_model_stages(spark):
    Broken, SomeFrames = stand_ins()
    files = spark.createDataFrame([("/c/v__clip0001_1.00-3.00.mp4",), ("/c/w__clip0002_1.00-3.00.mp4",), ("/c/bad.mp4",), (None,)], "path string")
    told, lost = describe_clips(files, lambda: EchoVision(" {} frames "), SomeFrames)
    rows = {r.clip_number: r for r in told.collect()}
    assert rows[1].video_id == "v" and rows[1].duration == 2.0 and rows[1].description == "6 frames"
    assert [tuple(r) for r in lost.collect()] == [("/c/bad.mp4", "ValueError: no video")]
    assert describe_clips(files, EchoVision, SomeFrames, done=told.where("clip_number = 1"))[0].count() == 1
    told2, lost2 = describe_clips(files, Broken, SomeFrames)
    assert told2.count() == 0 and {r.error for r in lost2.collect()} == {"RuntimeError: gone", "ValueError: no video"}
    judged = judge_videos(files, lambda: EchoVision("是否是CS2或CSGO：是 {}"), StillFrames).collect()
    assert len(judged) == 3 and all(r.is_cs2_csgo for r in judged) and {r.reason for r in judged} == {"是否是CS2或CSGO：是 2"}
    assert not any(r.is_cs2_csgo for r in judge_videos(files, lambda: EchoVision("是否是CS2或CSGO：是 {}"), StillFrames, strict=False).collect())
    assert {(r.is_cs2_csgo, r.reason) for r in judge_videos(files, Broken, StillFrames).collect()} == {(False, "RuntimeError: gone")}
    asked = generate_qa(told, lambda: EchoBackend("问题1：q1 答案1：a1 问题2：q2 答案2：a2"))
    assert asked.count() == 4 and {r.question for r in asked.collect()} == {"q1", "q2"}
    assert generate_qa(told, lambda: EchoBackend("问题1：q1 答案1：a1"), done=asked.where("video_id = 'v'")).count() == 1
    assert generate_qa(told, lambda: EchoBackend("nothing")).count() == 0 and generate_qa(told, Broken).count() == 0
    fallback = told.withColumns({"description": F.lit(""), "desc": F.lit("x")})
    assert generate_qa(fallback, lambda: EchoBackend("问题1：q1 答案1：a1")).count() == 2
    with pytest.raises(ValueError):
        assign_devices(files, ["path"], 0)


def test_frames(spark):
    _, SomeFrames = stand_ins()
    files = spark.createDataFrame([("a.mp4",), ("bad.mp4",), (None,)], "path string")
    rows = {r.path: r for r in extract_frames(files, backend=SomeFrames, most=4).collect()}
    planned = spark.range(1).select(frame_plan(F.lit(25.0), F.lit(150), 1.0, 4)).first()[0]
    assert [int(bytes(f)) for f in rows["a.mp4"].frames] == planned and len(planned) == 4
    assert rows["bad.mp4"].error == "ValueError: no video" and len(rows) == 2
    assert all(not r.frames and r.error for r in extract_frames(files).collect())


def test_describe_resumes_and_judges_in_order(spark, tmp_path):
    clips = tmp_path / "clips"
    clips.mkdir()
    for v in "cab":
        (clips / f"{v}__clip0001_1.00-3.00.mp4").write_bytes(b"x")
    out = tmp_path / "d"
    assert P.describe(spark, str(clips), str(out), EchoVision, StillFrames, most=2) == {"written": 2, "total": 2, "done_before": 0, "failed": 0}
    assert P.describe(spark, str(clips), str(out), EchoVision, StillFrames) == {"written": 1, "total": 3, "done_before": 2, "failed": 0}
    assert sorted(r["video_id"] for r in read(out)) == ["a", "b", "c"]
    assert P.judge(spark, str(clips), str(tmp_path / "j"), EchoVision, StillFrames) == {"written": 3, "accepted": 0, "rejected": 3}
    assert [r["video_filename"][0] for r in read(tmp_path / "j")] == ["a", "b", "c"]
    asked = P.ask(spark, str(out), str(tmp_path / "q"), lambda: EchoBackend("问题1：q1 答案1：a1"))
    assert asked == {"written": 3, "malformed": 0} and P.ask(spark, str(out), str(tmp_path / "q"), lambda: EchoBackend("问题1：q1 答案1：a1"))["written"] == 0


def test_cutting_and_renaming(spark, tmp_path):
    videos = spark.createDataFrame([("/v/a.mp4", 40.0, None), ("/v/b.mp4", 3.0, None), ("/v/c.mp4", None, "gone")], "path string, duration double, error string")
    said = P.cut(spark, str(tmp_path), str(tmp_path / "out"), durations=videos)
    assert said["videos_processed"] == 2 and said["videos_failed"] == 1 and said["videos_cut"] == said["clips_created"] == 0 and said["clips_failed"] >= 2
    assert cut_commands("a", "b", 1.0, 3.5)[0][2:4] == ["-ss", "1.00"] and cut_commands("a", "b", 1.0, 3.5, "exact")[0][2:4] == ["-i", "a"] and len(cut_commands("a", "b", 1, 2, "encode")) == 1
    raw = tmp_path / "raw" / "day"
    raw.mkdir(parents=True)
    for name in ("片段[ab1].mp4", "片段[ab1].json", "plain.mp4", "note.txt"):
        (raw / name).write_bytes(b"x")
    target = tmp_path / "named"
    target.mkdir()
    assert P.rename(spark, str(tmp_path / "raw"), str(target)) == {"planned": 2, "skipped": 1} and not list(target.iterdir())
    assert P.rename(spark, str(tmp_path / "raw"), str(target), execute=True) == {"done": 2, "skipped": 1}
    assert sorted(p.name for p in target.iterdir()) == ["ab1.json", "ab1.mp4"]


def test_file_actions_run_once(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x")
    plan = spark.createDataFrame([(str(tmp_path / "a"),), (str(tmp_path / "b"),)], "path string")
    done = run_file_actions(plan, "delete", execute=True)
    for _ in range(2):  # reading the outcome again deletes nothing again
        assert {r.path[-1]: r.status for r in done.collect()} == {"a": "done", "b": "missing"}
    with pytest.raises(ValueError):
        run_file_actions(plan, "burn")


def test_legacy_clips_and_arrays(spark, tmp_path):
    rows = [{"video": "v", "content": [1.5, 4, "said"], "previous": "x" * 300, "title": "t"}, {"video": "w", "content": [1, 2]}, {"video": "w", "content": "no"}]
    path = jsonl(tmp_path / "c.jsonl", rows)
    said = P.legacy_to_training(spark, path, str(tmp_path / "l"))
    assert said["total"] == 3 and said["written"] == 1 and said["malformed"] + said["bad_content"] == 2
    (made,) = read(tmp_path / "l")
    assert made["conversations"][1]["value"] == "said" and made["metadata"]["duration"] == 2.5 and made["video"].startswith("videos_val/v")
    (tmp_path / "a.json").write_text('[{"b": 1}, 3, {"c": [1, "中"]}]', encoding="utf-8")
    assert P.array_to_lines(spark, str(tmp_path / "a.json"), str(tmp_path / "n")) == {"written": 2}
    assert read(tmp_path / "n") == [{"b": 1}, {"c": [1, "中"]}]


def test_skips_are_counted_by_reason(spark, tmp_path):
    rows = [{"previous_clip": None, "current_clip": clip("v", 2, "now")}, {"previous_clip": clip("v", 1, "then"), "current_clip": clip("v", 2, " ")}, {"previous_clip": None, "current_clip": clip("v", 2, "")}]
    path = jsonl(tmp_path / "p.jsonl", rows)
    with open(path, "a", encoding="utf-8") as f:
        f.write("{bad\n\n")
    said = P.pairs_to_training(spark, path, str(tmp_path / "o"))
    assert said == {"total": 4, "written": 1, "other": 0, "malformed": 1, "no_previous": 1, "no_description": 1}
    said = P.pairs_to_training(spark, path, str(tmp_path / "o"), skip_no_previous=True)
    assert said["written"] == 0 and said["no_previous"] == 2


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    for name, n in (("a", 500), ("b", 3)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{k}\n" if k % 5 else "\n" for k in range(n)), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    try:
        rows = lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 503 and all(r.line == ("" if (r.line_no - 1) % 5 == 0 else f"{r.file[-5]}{r.line_no - 1}") for r in rows)


def test_counting_and_array_export(spark, tmp_path):
    (tmp_path / "b.Mp4").write_bytes(b"")
    (tmp_path / "a.avi").write_bytes(b"")
    (tmp_path / "c.txt").write_bytes(b"")
    assert count_videos(spark, str(tmp_path)) == (2, ["a.avi", "b.Mp4"]) and count_videos(spark, str(tmp_path / "gone")) == (0, [])
    out = tmp_path / "x.json"
    assert write_json_array(spark.createDataFrame([(1, None), (2, "中")], "a long, b string"), str(out)) == 2
    assert json.loads(out.read_text(encoding="utf-8")) == [{"a": 1, "b": None}, {"a": 2, "b": "中"}]
    assert write_json_array(spark.createDataFrame([], "a long"), str(tmp_path / "none.json")) == 0 and not (tmp_path / "none.json").exists()


def test_command_line(spark, tmp_path, capsys):
    qa = jsonl(tmp_path / "qa.jsonl", [{"question": "q", "answer": "a", "source_clip_path": "/p/c.mp4"}])
    assert main(["convert-qa", qa, str(tmp_path / "out"), "--category", "x"])["written"] == 1
    assert read(tmp_path / "out")[0]["metadata"]["category"] == "x" and '"written": 1' in capsys.readouterr().out
    video = tmp_path / "v"
    video.mkdir()
    (video / "a.mp4").write_bytes(b"x")
    assert main(["count", str(video)])["count"] == 1
    verdicts = jsonl(tmp_path / "verdicts.jsonl", [{"video_path": "a.mp4", "reason": "是否是CS2或CSGO：否"}])
    assert main(["delete", verdicts, str(video)]) == {str(video / "a.mp4"): "planned"} and (video / "a.mp4").exists()
    assert main(["audit", qa])["bad"] == []
    stage = "cliplake.operators.inference"
    assert main(["filter", str(video), str(tmp_path / "f"), "--model", f"{stage}:EchoVision", "--frames", f"{stage}:StillFrames"])["rejected"] == 1
    assert main(["rename", str(video), str(tmp_path)]) == {"skipped": 1}
    with pytest.raises(SystemExit):
        parser().parse_args(["unknown"])
