import json
import os

import pytest
from pyspark.sql import functions as F

from cliplake.operators import media as M
from cliplake.sources import jsonl, listing, sinks, subtitles
from cliplake.streaming.resume import process_new


def test_jsonl_keeps_ordinals_and_reports_bad_rows(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"a": 1, "b": "x"}\n\n  {"a": 2}  \n{"a": "2"}\nnot json\n[1, 2]\n"str"\n{"a": 3, "extra": 1}\n', encoding="utf-8")
    good, bad = jsonl.read_jsonl(spark, str(path), "a LONG, b STRING")
    assert sorted((r.line_no, r.a, r.b) for r in good.collect()) == [(1, 1, "x"), (3, 2, None), (8, 3, None)]
    assert sorted(r.line_no for r in bad.collect()) == [4, 5, 6, 7]
    strict, _ = jsonl.read_jsonl(spark, str(path), "a LONG, b STRING", strict=True)
    with pytest.raises(Exception, match="bad line"):
        strict.collect()


def test_lines_of_split_files_keep_their_order(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text("".join(f'{{"a": {k}}}\n' for k in range(3000)), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        rows = jsonl.read_jsonl(spark, str(tmp_path), "a LONG", exact=False)[0].collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len({(r.file, r.line_no) for r in rows}) == 6000
    for name in ("a", "b"):
        own = sorted((r.line_no, r.a) for r in rows if r.file.endswith(f"{name}.jsonl"))
        assert [a for _, a in own] == list(range(3000))


def test_json_arrays_skip_scalars_and_sniffing_takes_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, 7, "x", {"a": 2}, null]', encoding="utf-8")
    (tmp_path / "b.json").write_text('{"a": 3}\nbroken\n{"a": 4}', encoding="utf-8")
    (tmp_path / "c.jsonl").write_text('{"a": 5}\n', encoding="utf-8")
    assert sorted((r.line_no, r.a) for r in jsonl.read_json_array(spark, str(tmp_path / "a.json"), "a LONG").collect()) == [(1, 1), (4, 2)]
    assert sorted(r.a for r in jsonl.sniffed(spark, str(tmp_path), "a LONG").collect()) == [1, 2, 3, 4, 5]


def test_field_audit(spark):
    lines = ['{"v": "a"}', '{"v": ["a"]}', '{"v": null}', "{}", '{"v": 1}', '{"v": [1, "a"]}', '{"v": {"x": 1}}', '{"v": []}', "broken"]
    df = spark.createDataFrame(list(enumerate(lines)), "n long, line string")
    assert [r.n for r in jsonl.audit_field(df, "n", "line", "v").collect()] == [4, 5, 6]
    assert [r.n for r in jsonl.audit_field(df, "n", "line", "v", most=1).collect()] == [4]


def test_subtitle_files(spark, tmp_path):
    (tmp_path / "av1.json").write_text(json.dumps([{"text": "go", "start": 250, "end": 1150}, {"text": "[x]", "start": 0, "end": 1}]), encoding="utf-8")
    (tmp_path / "av2.json").write_text(json.dumps([{"text": " ", "start": 0, "end": 1}]), encoding="utf-8")
    (tmp_path / "av3.json").write_text("{broken", encoding="utf-8")
    (tmp_path / "av4.JSON").write_text(json.dumps([{"text": "go", "start": 0, "end": 1}]), encoding="utf-8")
    rows = subtitles.read_subtitles(spark, str(tmp_path), title_suffix="_").collect()
    assert [(r.video, r.title, [tuple(x) for x in r.subtitles]) for r in rows] == [("av1", "av1_", [(0.2, 1.1, "go")])]


def test_listing(spark, tmp_path):
    for name in ("b.mp4", "a.MP4", "c.Mp4", "d.json", "sub/e.mkv"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(b"x" * 10)
    files = listing.media_files(spark, str(tmp_path))
    base = F.substring_index("path", "/", -1)
    assert [r[0] for r in listing.sorted_files(files, (".mp4",)).select(base).collect()] == ["a.MP4", "b.mp4"]
    assert listing.with_suffix(files, listing.VIDEO_SUFFIXES).count() == 3
    assert listing.media_files(spark, str(tmp_path), recursive=True).count() == 5
    assert {(r.suffix, r.n_files) for r in listing.suffix_counts(files).collect()} == {(".mp4", 3), (".json", 1)}


def test_jsonl_sink_writes_nulls(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.write_jsonl(spark.createDataFrame([(1, None), (2, "中")], "a long, b string"), out, one_file=True)
    (part,) = [n for n in os.listdir(out) if n.endswith(".json")]
    assert (tmp_path / "out" / part).read_text(encoding="utf-8").split("\n")[:2] == ['{"a":1,"b":null}', '{"a":2,"b":"中"}']
    assert spark.createDataFrame([(1, None)], "a long, b string").select(sinks.to_line("a", "b")).first()[0] == '{"a":1,"b":null}'


def test_delete_plan_and_dry_run(spark, tmp_path):
    path = tmp_path / "v.mp4"
    path.write_bytes(b"x")
    denial = "是否是CS2或CSGO：否"
    verdicts = spark.createDataFrame([(str(path), None, denial), (None, "gone.mp4", denial), ("keep.mp4", None, "是"), ("n.mp4", None, None), (str(path), None, denial)], "video_path string, video_filename string, reason string")
    known = spark.createDataFrame([(str(path),)], "path string")
    plan = sinks.delete_plan(verdicts, known, base="/base")
    assert {(r.path, r.exists) for r in plan.collect()} == {(str(path), True), ("/base/gone.mp4", False)}
    assert {r.status for r in sinks.run_file_actions(plan, "delete").collect()} == {"planned", "missing"} and path.exists()
    assert {r.status for r in sinks.run_file_actions(plan, "delete", execute=True).collect()} == {"done", "missing"} and not path.exists()


def test_backends(spark):
    class Failing:
        def generate(self, inputs):
            raise RuntimeError("no model")

    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, p string")
    rows = M.generate_text(df, "k", "p", lambda: M.EchoBackend("<{}>")).collect()
    assert {(r.k, r.response, r.error) for r in rows} == {(1, "<a>", None), (2, "<b>", None)}
    failed = M.generate_text(df, "k", "p", Failing).collect()
    assert all(r.response is None and r.error == "RuntimeError: no model" for r in failed)


def test_media_tools_without_their_binaries(spark, tmp_path):
    big, small = tmp_path / "big.mp4", tmp_path / "small.mp4"
    big.write_bytes(b"x" * 2000)
    small.write_bytes(b"")
    rows = {r.path: r for r in M.probe_media(spark.createDataFrame([(str(big),), (str(small),), (None,)], "path string")).collect()}
    assert rows[str(small)].valid is False and len(rows) == 2
    plan = spark.createDataFrame([("s.mp4", str(big), 0.0, 1.0), ("missing.mp4", str(tmp_path / "t.mp4"), 0.0, 1.0)], "source string, target string, start double, end double")
    status = {r.target: r.status for r in M.cut_clips(plan).collect()}
    assert status[str(big)] == "exists" and status[str(tmp_path / "t.mp4")].startswith("failed")
    assert M.cut_commands("a", "b", 1.0, 3.5)[0] == ["ffmpeg", "-y", "-ss", "1.00", "-i", "a", "-t", "2.50", "-c", "copy", "b"]


def test_resume_retries_keys_without_output(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows = spark.createDataFrame([(1, "a"), (2, ""), (2, ""), (3, "c")], "k long, x string")
    rows.write.parquet(src)
    stream = lambda: spark.readStream.schema(rows.schema).parquet(src)
    process_new(spark, stream(), "k", lambda d: d.where("x <> ''"), out, str(tmp_path / "c1"), str(tmp_path / "tries"))
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 3]
    process_new(spark, stream(), "k", lambda d: d.select("k", F.lit("again").alias("x")), out, str(tmp_path / "c2"), str(tmp_path / "tries"))
    assert sorted((r.k, r.x) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "again"), (3, "c")]
    assert spark.read.parquet(str(tmp_path / "tries")).where("k = 2").count() == 2
