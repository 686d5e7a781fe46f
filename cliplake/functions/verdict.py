"""Verdicts on videos out of a model's free text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cliplake.functions.text import head_truncate, strip

# The phrases that the legacy reading looks for, lower-cased.
AFFIRMING = (
    "是cs2", "是csgo", "是反恐精英", "是counter-strike", "是cs2或csgo", "是cs2或者csgo", "是csgo或cs2", "是csgo或者cs2",
    "cs2游戏", "csgo游戏", "counter-strike 2", "counter-strike: global offensive",
)
NEGATING = ("不是", "非", "no", "not", "否")
OTHER_GAMES = ("其他游戏", "别的游戏")
GAME_WORDS = ("cs2", "csgo", "counter-strike", "反恐精英", "dust2", "mirage", "inferno")
DENIAL = "是否是CS2或CSGO：否"
LABEL = r"是否是CS2或CSGO\s*[：:]\s*(是|否)"


def _any(text: Column, phrases: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(p) for p in phrases))


def legacy_verdict(text: Column) -> Column:
    """By phrases: affirmed or naming the game, and nothing negating anywhere in the text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    affirmed = _any(low, AFFIRMING) & ~_any(low, NEGATING)
    named = _any(low, GAME_WORDS) & ~_any(low, NEGATING + OTHER_GAMES)
    return affirmed | named


def strict_verdict(text: Column) -> Column:
    """By the answer's own label; null if it has none."""
    label = F.regexp_extract(F.coalesce(text, F.lit("")), LABEL, 1)
    return F.when(label == "是", True).when(label == "否", False)


def verdict_reason(text: Column) -> Column:
    return head_truncate(strip(text), 300)


def denied(reason: Column) -> Column:
    """The reason says literally that the video is of another game; null is no denial."""
    return F.coalesce(reason.contains(DENIAL), F.lit(False))
