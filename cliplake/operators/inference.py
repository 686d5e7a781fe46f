"""Model stages: describing clips, judging videos, asking and answering questions about descriptions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.functions.frames import frame_plan
from cliplake.functions.paths import basename, parse_clip_name
from cliplake.functions.qa import parse_pairs, qa_prompt
from cliplake.functions.text import is_blank, or_else, strip
from cliplake.functions.verdict import legacy_verdict, strict_verdict, verdict_reason
from cliplake.operators.media import TextBackend, generate_text
from cliplake.operators.ordinal import dense_ordinal
from cliplake.operators.pairing import unprocessed

DESCRIBE = (
    "下面是一段游戏视频按时间顺序抽取的画面。请用连贯的段落描述玩家在做什么：所在位置与移动、所用武器与道具、交火过程与结果、队友和对手的动向，以及这些选择背后的战术意图。只写画面中能看到的内容。"
)
#: The two labelled lines are fixed values: verdicts are read by them.
JUDGE = (
    "下面是一段视频按时间顺序抽取的画面。请根据界面、地图、武器、回合与经济机制和画面风格，判断它是否为 CS2 或 CSGO 的游戏视频。\n"
    "请只按以下两行回答：\n- 是否是CS2或CSGO：是/否\n- 判断理由：（一两句话）"
)


class FrameBackend(Protocol):
    """Reads a media file's frame rate and length, and frames of given numbers as encoded images."""

    def probe(self, path: str) -> tuple[float, int]: ...

    def grab(self, path: str, numbers: list[int]) -> list[bytes]: ...


class VisionBackend(Protocol):
    """Makes one text of a prompt and the frames of every file of a batch."""

    def look(self, prompt: str, frames: list[list[bytes]]) -> list[str]: ...


class OpenCvFrames:
    """Frames by OpenCV, where it is installed."""

    def probe(self, path: str) -> tuple[float, int]:
        import cv2

        video = cv2.VideoCapture(path)
        try:
            if not video.isOpened():
                raise ValueError("cannot be opened")
            return float(video.get(cv2.CAP_PROP_FPS)), int(video.get(cv2.CAP_PROP_FRAME_COUNT))
        finally:
            video.release()

    def grab(self, path: str, numbers: list[int]) -> list[bytes]:
        import cv2

        video = cv2.VideoCapture(path)
        try:
            out = []
            for n in numbers:
                video.set(cv2.CAP_PROP_POS_FRAMES, n)
                ok, frame = video.read()
                if ok:
                    out.append(cv2.imencode(".jpg", frame)[1].tobytes())
            return out
        finally:
            video.release()


class StillFrames:
    """A stand-in: every file has ``seconds`` of 25 frames a second, and a frame is its number."""

    def __init__(self, seconds: int = 6):
        self.seconds = seconds

    def probe(self, path: str) -> tuple[float, int]:
        return 25.0, 25 * self.seconds

    def grab(self, path: str, numbers: list[int]) -> list[bytes]:
        return [str(n).encode() for n in numbers]


class EchoVision:
    """A deterministic stand-in for a model that sees: the template with the number of frames and the last of them."""

    def __init__(self, template: str = "{} frames up to {}"):
        self.template = template

    def look(self, prompt: str, frames: list[list[bytes]]) -> list[str]:
        return [self.template.format(len(f), f[-1].decode() if f else "") for f in frames]


def extract_frames(files: DataFrame, path: str = "path", backend: Callable[[], FrameBackend] = OpenCvFrames, fps: float = 1.0, most: int = 8) -> DataFrame:
    """(path, frames array<binary>, error): the frames of ``functions.frames``; a file that fails has none and the error."""

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = backend()
        for pdf in batches:
            out = []
            for name in pdf["path"]:
                try:
                    out.append((name, *reader.probe(name), None))
                except Exception as x:  # noqa: BLE001 - one file's failure is its row's
                    out.append((name, None, None, f"{type(x).__name__}: {x}"))
            yield pd.DataFrame(out, columns=["path", "fps", "total", "error"])

    def grab(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = backend()
        for pdf in batches:
            frames, errors = [], []
            for name, numbers, error in zip(pdf["path"], pdf["numbers"], pdf["error"], strict=True):
                try:
                    frames.append(reader.grab(name, [int(n) for n in numbers]) if error is None else [])
                    errors.append(error if error is not None or frames[-1] else "no frame")
                except Exception as x:  # noqa: BLE001
                    frames.append([])
                    errors.append(f"{type(x).__name__}: {x}")
            yield pd.DataFrame({"path": pdf["path"], "frames": frames, "error": errors})

    known = files.selectExpr(f"`{path}` as path").where("path is not null").mapInPandas(probe, "path string, fps double, total long, error string")
    planned = known.select("path", frame_plan(F.col("fps"), F.col("total"), fps, most).alias("numbers"), "error")
    return planned.mapInPandas(grab, "path string, frames array<binary>, error string")


def look_at(files: DataFrame, prompt: str, model: Callable[[], VisionBackend], frames: Callable[[], FrameBackend] = OpenCvFrames, fps: float = 1.0, most: int = 8) -> DataFrame:
    """(path, response, error) of a model over every file's frames; a failing file or batch has the error."""

    def say(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = None
        for pdf in batches:
            good = [k for k, e in enumerate(pdf["error"]) if e is None]
            responses, errors = [None] * len(pdf), list(pdf["error"])
            try:
                made = made or model()
                for k, text in zip(good, made.look(prompt, [[bytes(x) for x in pdf["frames"].iat[k]] for k in good]), strict=True):
                    responses[k] = text
            except Exception as x:  # noqa: BLE001 - any failure of a backend is its rows' failure
                for k in good:
                    errors[k] = f"{type(x).__name__}: {x}"
            yield pd.DataFrame({"path": pdf["path"], "response": responses, "error": errors})

    return extract_frames(files, "path", frames, fps, most).mapInPandas(say, "path string, response string, error string")


def assign_devices(tasks: DataFrame, order: list[str], devices: int) -> DataFrame:
    """``tasks`` with the columns ordinal and device: task by task round the devices, in the given order."""
    if devices < 1:
        raise ValueError(f"{devices} devices")
    return dense_ordinal(tasks, order).withColumn("device", (F.col("ordinal") % devices).cast("int"))


def describe_clips(files: DataFrame, model: Callable[[], VisionBackend], frames: Callable[[], FrameBackend] = OpenCvFrames, done: DataFrame | None = None, prompt: str = DESCRIBE, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """(described clips, failures (clip_path, error)) of the files that ``done`` does not list."""
    tasks = files.select(F.col("path").alias("clip_path")).where("clip_path is not null").distinct()
    if done is not None:
        tasks = unprocessed(tasks, F.col("clip_path"), done, or_else("clip_path", "clip_filename"))
    made = look_at(tasks.select(F.col("clip_path").alias("path")), prompt, model, frames, most=most).withColumnRenamed("path", "clip_path")
    x = parse_clip_name(F.col("clip_path"))
    told = made.where(~is_blank("response")).select(
        "clip_path", basename(F.col("clip_path")).alias("clip_filename"), *(x[c].alias(c) for c in ("video_id", "clip_number", "start_time", "end_time", "duration")),
        strip("response").alias("description"),
    )
    return told, made.where(is_blank("response")).select("clip_path", F.coalesce("error", F.lit("blank response")).alias("error"))


def judge_videos(files: DataFrame, model: Callable[[], VisionBackend], frames: Callable[[], FrameBackend] = OpenCvFrames, strict: bool = True, prompt: str = JUDGE, most: int = 2) -> DataFrame:
    """(video_path, video_filename, is_cs2_csgo, reason); a failed call is a false verdict with the error as reason.

    The strict reading takes the answer's own label, the legacy one its phrases.
    """
    made = look_at(files.select("path").where("path is not null").distinct(), prompt, model, frames, most=most)
    said = F.coalesce("response", F.lit(""))
    verdict = F.coalesce(strict_verdict(said), F.lit(False)) if strict else legacy_verdict(said)
    return made.select(
        F.col("path").alias("video_path"), basename(F.col("path")).alias("video_filename"), (verdict & F.col("error").isNull()).alias("is_cs2_csgo"),
        F.coalesce("error", verdict_reason(said)).alias("reason"),
    )


def generate_qa(descriptions: DataFrame, backend: Callable[[], TextBackend], done: DataFrame | None = None, questions: int = 4) -> DataFrame:
    """Question and answer rows of described clips that ``done`` does not list; ``desc`` stands in for a description.

    A clip whose answer holds no pair has no row, and is asked again by a later run.
    """
    key = or_else("clip_path", "clip_filename")
    if "desc" in descriptions.columns:
        descriptions = descriptions.withColumn("description", or_else("description", "desc")).drop("desc")
    tasks = descriptions.where(~is_blank("description")).withColumn("source_clip_path", key)
    if done is not None:
        tasks = unprocessed(tasks, F.col("source_clip_path"), done, or_else("source_clip_path"))
    keyed = tasks.withColumn("_id", F.xxhash64("source_clip_path", "description"))
    made = generate_text(keyed.withColumn("_prompt", qa_prompt(F.col("description"), questions)), "_id", "_prompt", backend).where("error is null")
    pairs = made.dropDuplicates(["_id"]).select("_id", F.posexplode(parse_pairs(F.col("response"))).alias("_at", "_pair"))
    return keyed.join(pairs, "_id").select(
        F.col("_pair.question").alias("question"), F.col("_pair.answer").alias("answer"), "source_clip_path", "video_id", "clip_number", "start_time", "end_time"
    )
