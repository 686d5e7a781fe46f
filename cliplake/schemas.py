"""Explicit schemas of the records that the engine reads."""

from __future__ import annotations

CUE = "text STRING, start LONG, end LONG"
SUBTITLES = "video STRING, title STRING, category STRING, subtitles ARRAY<STRUCT<start: DOUBLE, end: DOUBLE, text: STRING>>"
VERDICT = "video_path STRING, video_filename STRING, is_cs2_csgo BOOLEAN, reason STRING"
CLIP = "clip_path STRING, clip_filename STRING, video_id STRING, clip_number LONG, start_time DOUBLE, end_time DOUBLE, duration DOUBLE, description STRING"
DESCRIBED = f"{CLIP}, desc STRING"
PAIR = f"previous_clip STRUCT<{CLIP.replace(' ', ': ').replace(',: ', ', ')}>, current_clip STRUCT<{CLIP.replace(' ', ': ').replace(',: ', ', ')}>, has_previous BOOLEAN, previous_has_description BOOLEAN"
QA = "question STRING, answer STRING, source_clip_path STRING, clip_path STRING, video_id STRING, clip_number LONG, start_time DOUBLE, end_time DOUBLE"
RECORD = (
    "video STRING, data_path STRING, conversations ARRAY<STRUCT<from: STRING, value: STRING>>, "
    "metadata STRUCT<title: STRING, category: STRING, video_start: DOUBLE, video_end: DOUBLE, duration: DOUBLE, source_file: STRING>"
)
LEGACY_CLIP = "video STRING, content ARRAY<STRING>, previous STRING, title STRING, category STRING"
