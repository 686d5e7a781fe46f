"""Command line: ``python -m cliplake COMMAND ...`` runs a pipeline and prints what it counted."""

from __future__ import annotations

import argparse
import importlib
import json

from cliplake.functions.records import RecordOptions
from cliplake.plans import pipelines as P
from cliplake.session import get_session
from cliplake.sources.listing import count_videos
from cliplake.sources.sinks import delete_plan, run_file_actions


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cliplake")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *names: str) -> argparse.ArgumentParser:
        made = sub.add_parser(name)
        for n in names:
            made.add_argument(n)
        return made

    def records(made: argparse.ArgumentParser) -> None:
        made.add_argument("--data_path", default=RecordOptions.data_path)
        made.add_argument("--video_base_path", default=RecordOptions.video_base)
        made.add_argument("--category", default=RecordOptions.category)
        made.add_argument("--max_previous_length", type=int, default=RecordOptions.most_previous)

    c = command("commentary", "input", "output")
    c.add_argument("--part", default="1/1")
    c.add_argument("--max_clips_per_video", type=int, default=0)
    c.add_argument("--no_rate_check", action="store_true")
    records(c)
    p = command("pair", "input", "clip_dir", "output")
    p.add_argument("--include_missing", action="store_true")
    p.add_argument("--trim_ids", action="store_true")
    t = command("convert-pairs", "input", "output")
    t.add_argument("--skip_no_previous", action="store_true")
    records(t)
    records(command("convert-qa", "input", "output"))
    m = command("merge", "pairs", "descriptions", "output")
    m.add_argument("--skip_no_description", action="store_true")
    m.add_argument("--desc_label", default=RecordOptions.scene_label)
    m.add_argument("--suggestion_label", default=RecordOptions.advice_label)
    records(m)
    j = command("merge-train", "output")
    j.add_argument("inputs", nargs="+")
    j.add_argument("--shuffle", action="store_true")
    j.add_argument("--seed", type=int, default=42)
    def backends(made: argparse.ArgumentParser, frames: bool = True) -> None:
        made.add_argument("--model", required=True, help="MODULE:NAME of a backend class or factory")
        if frames:
            made.add_argument("--frames", default="cliplake.operators.inference:OpenCvFrames", help="MODULE:NAME of a frame reader")

    e = command("describe", "clip_dir", "output")
    e.add_argument("--max_clips", type=int, default=0)
    e.add_argument("--no_resume", action="store_true")
    backends(e)
    f = command("filter", "video_dir", "output")
    f.add_argument("--max_videos", type=int, default=0)
    f.add_argument("--legacy", action="store_true")
    backends(f)
    g = command("generate-qa", "input", "output")
    g.add_argument("--questions", type=int, default=4)
    g.add_argument("--no_resume", action="store_true")
    backends(g, frames=False)
    k = command("cut", "video_dir", "output")
    k.add_argument("--min_duration", type=float, default=6.0)
    k.add_argument("--max_duration", type=float, default=15.0)
    k.add_argument("--seed", type=int, default=42)
    k.add_argument("--style", choices=["fast", "exact", "encode"], default="fast")
    n = command("rename", "folder", "output")
    n.add_argument("--execute", action="store_true")
    records(command("legacy", "input", "output"))
    command("array-to-jsonl", "input", "output")
    command("audit", "input")
    command("count", "folder")
    d = command("delete", "verdicts", "folder")
    d.add_argument("--execute", action="store_true")
    return top


def options(a: argparse.Namespace) -> RecordOptions:
    return RecordOptions(
        a.data_path, a.video_base_path, a.category, a.max_previous_length, getattr(a, "desc_label", RecordOptions.scene_label), getattr(a, "suggestion_label", RecordOptions.advice_label)
    )


def named(path: str):
    """The object of MODULE:NAME."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None) -> dict:
    a = parser().parse_args(argv)
    spark = get_session()
    if a.command == "commentary":
        part, parts = map(int, a.part.split("/"))
        said = P.commentary(spark, a.input, a.output, part, parts, options(a), check_rate=not a.no_rate_check, most=a.max_clips_per_video)
    elif a.command == "pair":
        said = P.pair_clips(spark, a.input, a.clip_dir, a.output, a.include_missing, a.trim_ids)
    elif a.command == "convert-pairs":
        said = P.pairs_to_training(spark, a.input, a.output, a.skip_no_previous, options(a))
    elif a.command == "convert-qa":
        said = P.qa_to_training(spark, a.input, a.output, options(a))
    elif a.command == "merge":
        said = P.merge_to_training(spark, a.pairs, a.descriptions, a.output, a.skip_no_description, options(a))
    elif a.command == "merge-train":
        said = P.merge_training_files(spark, a.inputs, a.output, a.shuffle, a.seed)
    elif a.command == "describe":
        said = P.describe(spark, a.clip_dir, a.output, named(a.model), named(a.frames), not a.no_resume, a.max_clips)
    elif a.command == "filter":
        said = P.judge(spark, a.video_dir, a.output, named(a.model), named(a.frames), not a.legacy, a.max_videos)
    elif a.command == "generate-qa":
        said = P.ask(spark, a.input, a.output, named(a.model), a.questions, not a.no_resume)
    elif a.command == "cut":
        said = P.cut(spark, a.video_dir, a.output, a.min_duration, a.max_duration, a.seed, a.style)
    elif a.command == "rename":
        said = P.rename(spark, a.folder, a.output, a.execute)
    elif a.command == "legacy":
        said = P.legacy_to_training(spark, a.input, a.output, options(a))
    elif a.command == "array-to-jsonl":
        said = P.array_to_lines(spark, a.input, a.output)
    elif a.command == "audit":
        said = {"bad": [[r.line_no, r.kind] for r in P.audit_videos(spark, a.input).collect()]}
    elif a.command == "count":
        n, names = count_videos(spark, a.folder)
        said = {"count": n, "names": names}
    else:
        from cliplake.schemas import VERDICT
        from cliplake.sources.jsonl import read_jsonl
        from cliplake.sources.listing import media_files, plain_path

        verdicts, _ = read_jsonl(spark, a.verdicts, VERDICT)
        plan = delete_plan(verdicts, media_files(spark, a.folder).select(plain_path("path").alias("path")), a.folder)
        said = {r.path: r.status for r in run_file_actions(plan, "delete", execute=a.execute).collect()}
    print(json.dumps(said, ensure_ascii=False))
    return said


if __name__ == "__main__":
    main()
