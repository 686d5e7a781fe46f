"""Which frames of a video to sample."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def frame_plan(video_fps: Column, total_frames: Column, fps: float = 1.0, most: int = 8) -> Column:
    """Array of frame numbers, evenly spaced from the first to the last frame.

    A frame rate of 0 or less counts as 30; a video without frames, or too short for one sample, gives an
    empty array. One sample takes the middle.
    """
    rate = F.when(F.coalesce(video_fps, F.lit(0.0)) <= 0, F.lit(30.0)).otherwise(video_fps.cast("double"))
    frames = F.coalesce(total_frames.cast("long"), F.lit(0).cast("long"))
    span = frames / rate
    wanted = F.least((span * fps).cast("int"), F.lit(most))
    n = F.greatest(F.lit(1), wanted)
    at = lambda t: F.least((t * rate).cast("long"), frames - 1)
    many = F.transform(F.sequence(F.lit(0), n - 1), lambda i: at(i / F.greatest(n - 1, F.lit(1)) * span))
    return F.when((frames <= 0) | (wanted <= 0), F.array().cast("array<bigint>")).when(n == 1, F.array(at(span / 2))).otherwise(many)
