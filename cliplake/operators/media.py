"""Model calls and media tools as Arrow batches behind backends that tests replace."""

from __future__ import annotations

import os
import shutil
import subprocess
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TextBackend(Protocol):
    """Makes one text for every input of a batch."""

    def generate(self, inputs: list[str]) -> list[str]: ...


class EchoBackend:
    """A deterministic stand-in for a model."""

    def __init__(self, template: str = "{}"):
        self.template = template

    def generate(self, inputs: list[str]) -> list[str]:
        return [self.template.format(x) for x in inputs]


def generate_text(df: DataFrame, key: str, prompt: str, backend: Callable[[], TextBackend]) -> DataFrame:
    """(key, response, error) of a model over prompts; the backend is made once per task.

    A batch that fails gives null responses with the error, and the job goes on.
    """
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for pdf in batches:
            try:
                model = model or backend()
                made, error = model.generate(pdf["prompt"].tolist()), None
            except Exception as x:  # noqa: BLE001 - any failure of a backend is a row's failure
                made, error = [None] * len(pdf), f"{type(x).__name__}: {x}"
            yield pd.DataFrame({"key": pdf["key"], "response": made, "error": [error] * len(pdf)})

    rows = df.selectExpr(f"`{key}` as key", f"`{prompt}` as prompt")
    return rows.mapInPandas(run, f"key {kind}, response string, error string").withColumnRenamed("key", key)


def probe_media(files: DataFrame, path: str = "path", timeout: float = 10.0) -> DataFrame:
    """(path, duration, valid, error) by ffprobe; without it, files of over 1024 bytes pass and have no duration."""

    def probe(name: str) -> tuple[float | None, bool, str | None]:
        if not os.path.exists(name) or not os.path.getsize(name):
            return None, False, "missing or empty"
        if shutil.which("ffprobe") is None:
            return None, os.path.getsize(name) > 1024, "ffprobe is not installed"
        ask = ["ffprobe", "-v", "error", "-select_streams", "v:0", "-show_entries", "stream=codec_name:format=duration", "-of", "csv=p=0", name]
        try:
            said = subprocess.run(ask, capture_output=True, text=True, timeout=timeout, check=False).stdout.split()
            return float(said[-1]), len(said) > 1, None
        except (subprocess.TimeoutExpired, ValueError, IndexError) as x:
            return None, False, type(x).__name__

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [probe(p) for p in pdf["path"]]
            yield pd.DataFrame({"path": pdf["path"], "duration": [f[0] for f in found], "valid": [f[1] for f in found], "error": [f[2] for f in found]})

    return files.selectExpr(f"`{path}` as path").where("path is not null").mapInPandas(run, "path string, duration double, valid boolean, error string")


def cut_commands(source: str, target: str, start: float, end: float, style: str = "fast") -> list[list[str]]:
    """The commands to cut a clip, each tried if the one before fails.

    "fast" seeks before the input, copies, then encodes quickly; "exact" seeks behind it, copies, then encodes;
    "encode" only encodes, on one thread.
    """
    span = ["-t", f"{end - start:.2f}"]
    seek = ["ffmpeg", "-y", "-ss", f"{start:.2f}", "-i", source, *span]
    behind = ["ffmpeg", "-y", "-i", source, "-ss", f"{start:.2f}", *span]
    encode = lambda preset, crf, audio: ["-c:v", "libx264", "-preset", preset, "-crf", crf, "-c:a", "aac", "-b:a", audio]
    if style == "fast":
        return [[*seek, "-c", "copy", target], [*seek, *encode("ultrafast", "28", "96k"), target]]
    if style == "exact":
        return [[*behind, "-c", "copy", target], [*behind, *encode("veryfast", "23", "128k"), target]]
    if style == "encode":
        return [[*seek, *encode("veryfast", "23", "128k"), "-threads", "1", target]]
    raise ValueError(f"no style {style!r}")


def cut_clips(plan: DataFrame, timeouts: tuple[float, float] = (300.0, 600.0), style: str = "fast") -> DataFrame:
    """(source, target, status) of cutting (source, target, start, end) rows; an existing target is left as it is.

    A clip is written under another name first, so that a broken-off attempt leaves no target behind.
    """

    def cut(source: str, target: str, start: float, end: float) -> str:
        if os.path.exists(target):
            return "exists"
        if shutil.which("ffmpeg") is None:
            return "failed: ffmpeg is not installed"
        base, ext = os.path.splitext(target)
        part = f"{base}.part{ext}"
        for command, seconds in zip(cut_commands(source, part, start, end, style), timeouts, strict=False):
            try:
                if subprocess.run(command, capture_output=True, timeout=seconds, check=False).returncode == 0 and os.path.getsize(part):
                    os.replace(part, target)
                    return "copied" if "copy" in command else "encoded"
            except (subprocess.TimeoutExpired, OSError):
                continue
        return "failed"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [cut(*row) for row in zip(pdf["source"], pdf["target"], pdf["start"], pdf["end"], strict=True)]
            yield pd.DataFrame({"source": pdf["source"], "target": pdf["target"], "status": done})

    return plan.select("source", "target", "start", "end").mapInPandas(run, "source string, target string, status string")


def cut_summary(videos: DataFrame, cuts: DataFrame) -> DataFrame:
    """One row (videos_processed, videos_failed, videos_cut, clips_created, clips_failed).

    ``videos`` are probed (path, error) rows, of which those with an error have failed; ``cuts`` are (source,
    status) rows. A clip that was there already counts as created; a video is cut if one of its clips is.
    """
    made = F.col("status").isin("exists", "copied", "encoded")
    names = ("videos_processed", "videos_failed", "videos_cut", "clips_created", "clips_failed")
    row = lambda *parts: [F.coalesce(c, F.lit(0)).cast("long").alias(n) for c, n in zip(parts, names, strict=True)]
    none = F.lit(0)
    by = cuts.groupBy("source").agg(F.count_if(made).alias("made"), F.count_if(~made).alias("lost"))
    clips = by.select(*row(none, none, (F.col("made") > 0).cast("long"), F.col("made"), F.col("lost")))
    seen = videos.select(*row(F.col("error").isNull().cast("long"), F.col("error").isNotNull().cast("long"), none, none, none))
    return seen.unionByName(clips).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
