"""Greedy segmentation of timed words by gap and span, word timing, and tiling."""

from __future__ import annotations

from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliplake.functions.rounding import exact_round, seconds
from cliplake.functions.text import is_blank, let, words
from cliplake.session import cut_lineage, table_partitions


def clean_cues(cues: Column) -> Column:
    """Array of raw cues (text, start ms, end ms) to (start, end, text) in seconds; blank and bracketed ones go."""
    kept = F.filter(cues, lambda c: ~is_blank(c["text"]) & ~c["text"].contains("[") & ~c["text"].contains("]"))
    time = lambda x: seconds(F.coalesce(x, F.lit(0)).cast("double"))
    return F.transform(kept, lambda c: F.struct(time(c["start"]).alias("start"), time(c["end"]).alias("end"), c["text"].alias("text")))


def timed_words(start: Column, end: Column, text: Column) -> Column:
    """Array of (start, end, word): a cue's words spread evenly over it, to one decimal."""
    parts = words(text)

    def spread(c: Column) -> Column:
        at = lambda i: exact_round(c["s"] + i * c["d"], 1)
        return F.transform(c["p"], lambda w, i: F.struct(at(i).alias("start"), at(i + 1).alias("end"), w.alias("word")))

    return let(spread, p=parts, s=start.cast("double"), d=((end - start) / F.size(parts)).cast("double"))


def greedy_cuts(ends: list[float], longest: float, gap: float, least: float, last_open: bool = True) -> list[tuple[int, int]]:
    """Index ranges [i, j) of one run of words by their end times.

    A segment closes before the first word that makes it longer than ``longest`` or follows by more than
    ``gap``; it is kept if it lasts at least ``least``. With ``last_open`` the very last word only closes.
    """
    found, i, m = [], 0, len(ends)
    for j in range(1, m):
        if j == m - 1 and last_open or ends[j] - ends[i] > longest or ends[j] - ends[j - 1] > gap:
            if ends[j - 1] - ends[i] >= least:
                found.append((i, j))
            i = j
    if not last_open and m and ends[m - 1] - ends[i] >= least:
        found.append((i, m))
    return found


def commentary_clips(video: DataFrame, longest: float = 15, gap: float = 2, least: float = 5, slowest: float = 1, fastest: float = 4, check_rate: bool = True, most: int = 0) -> DataFrame:
    """Clips of subtitle records (video, title, category, subtitles array): one record in, its clips out.

    A clip has content, previous (all words before it, joined), title, category, start_time and end_time, and
    its rate of words per second (from the first to the last end) lies within the bounds.
    """
    told = F.flatten(F.transform("subtitles", lambda c: timed_words(c["start"], c["end"], c["text"])))
    kind = "array<struct<first:int,last:int>>"

    @F.pandas_udf(kind)
    def cuts(ends: pd.Series) -> pd.Series:
        return pd.Series([[{"first": a, "last": b} for a, b in greedy_cuts(list(x), longest, gap, least)] for x in ends])

    rows = video.select("video", "title", "category", told.alias("said"))
    rows = rows.withColumn("cut", F.explode(cuts(F.transform("said", lambda w: w["end"]))))
    first, last = F.col("cut.first"), F.col("cut.last")
    content = F.slice("said", first + 1, last - first)
    before = F.array_join(F.transform(F.slice("said", F.lit(1), first), lambda w: w["word"]), " ")
    clips = rows.select(
        "video", content.alias("content"), before.alias("previous"), "title", "category",
        F.element_at(content, 1)["start"].alias("start_time"), F.element_at(content, -1)["end"].alias("end_time"), first.alias("at"),
    )
    span = F.element_at("content", -1)["end"] - F.element_at("content", 1)["end"]
    kept = clips.where(span > 0)
    if check_rate:
        kept = kept.where((F.size("content") / span).between(slowest, fastest))
    if most:
        from cliplake.operators.ordinal import group_limit

        kept = group_limit(kept, "video", ["at"], most)
    return kept.drop("at")


@dataclass
class _Open:
    """The segment that is open behind a row: its first row, its rows so far, and the last one."""

    key: object
    start_t: int
    start_id: int
    rows: int
    last_t: int
    last_id: int


def _transfer(longest: int, gap: int):
    """One row per sorted partition: how the open segment before it becomes the one behind it.

    A gap or a new key forgets what came before. Up to there, only the row that makes the first cut matters, and
    that lies within ``longest`` of the partition's first row: chains of cuts are followed from each such row at
    once, and merge where they cut at the same row. A partition holds as many chains as rows fit in ``longest``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, pure, first, key, t, ident = 0, True, None, None, 0, 0
        chains: deque[tuple[int, int, int, list[int]]] = deque()  # start time, id and place, the first cuts that lead here
        cuts: list[int] = []  # times of the possible first cuts
        start = (0, 0, 0)
        pid = 0
        for pdf in batches:
            for pid, k, x, i in zip(pdf["pid"], pdf["key"], pdf["t"], pdf["id"], strict=True):
                if n and (k != key or x - t > gap):
                    pure, start = False, (x, i, n)
                    chains.clear()
                elif pure:
                    here: list[int] = []
                    while chains and x - chains[0][0] > longest:
                        here += chains.popleft()[3]
                    if not n or t - first[1] <= longest:
                        here.append(len(cuts))
                        cuts.append(x)
                    if here:
                        chains.append((x, i, n, here))
                elif x - start[0] > longest:
                    start = (x, i, n)
                first = first or (k, x)
                key, t, ident, n = k, x, i, n + 1
        if n:
            ends = [start] * (1 if not pure else len(cuts))
            for x, i, at, leads in chains:
                for c in leads:
                    ends[c] = (x, i, at)
            yield pd.DataFrame(
                [(pid, first[0], first[1], pure, key, t, ident, n, cuts if pure else [], [e[0] for e in ends], [e[1] for e in ends], [n - e[2] for e in ends])],
                columns=["pid", "first_key", "first_t", "pure", "last_key", "last_t", "last_id", "n", "cuts", "start_t", "start_id", "since"],
            )

    return run


def carry_segments(summaries: list, longest: int, gap: int) -> tuple[dict[int, _Open], dict[int, object]]:
    """The segment that is open before each partition, and the first key behind it, from the partitions' summaries."""
    carried: dict[int, _Open] = {}
    following: dict[int, object] = {}
    state: _Open | None = None
    before = None
    for r in sorted(summaries, key=lambda r: r.pid):
        if before is not None:
            following[before] = r.first_key
        before = r.pid
        goes_on = state is not None and state.key == r.first_key
        if goes_on:
            carried[r.pid] = state
        joins = goes_on and r.first_t - state.last_t <= gap
        at = bisect_right(r.cuts, state.start_t + longest) if r.pure and joins else 0
        if r.pure and joins and at == len(r.cuts):
            state = _Open(state.key, state.start_t, state.start_id, state.rows + r.n, r.last_t, r.last_id)
        else:
            state = _Open(r.last_key, r.start_t[at], r.start_id[at], r.since[at], r.last_t, r.last_id)
    return carried, following


def greedy_segments(df: DataFrame, key: str, time: str, ident: str, longest: int, gap: int, least: int, partitions: int | None = None) -> DataFrame:
    """(key, first_id, last_id, start_t, end_t, n_rows) of every kept segment of timed rows.

    As :func:`greedy_cuts` over a key's rows by (time, id). Rows are range-sorted over all partitions and no key
    is gathered: each task carries its open segment only, and what is open before a task comes from one summary
    per partition. Null keys, times and ids are left out; rows that tie in all of them are one by one.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[key]
    columns = ["key", "first_id", "last_id", "start_t", "end_t", "n_rows"]
    rows = df.select(F.col(key).alias("key"), F.col(time).cast("long").alias("t"), F.col(ident).cast("long").alias("id")).where("key is not null and t is not null and id is not null")
    ranged = rows.repartitionByRange(partitions or table_partitions(spark), "key", "t", "id").sortWithinPartitions("key", "t", "id")
    placed = cut_lineage(ranged.withColumn("pid", F.spark_partition_id()))
    summary = f"pid int, first_key {kind}, first_t long, pure boolean, last_key {kind}, last_t long, last_id long, n long, cuts array<long>, start_t array<long>, start_id array<long>, since array<long>"
    carried, following = carry_segments(placed.mapInPandas(_transfer(longest, gap), summary).collect(), longest, gap)  # one row per partition

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: _Open | None = None
        waiting = pid = None

        def meet(row: tuple, is_last: bool) -> list[tuple]:
            nonlocal state
            k, x, i = row
            if state is None or state.key != k:
                state = _Open(k, x, i, 1, x, i)
                return []
            done = []
            if is_last or x - state.start_t > longest or x - state.last_t > gap:
                if state.last_t - state.start_t >= least:
                    done.append((k, state.start_id, state.last_id, state.start_t, state.last_t, state.rows))
                state = _Open(k, x, i, 1, x, i)
            else:
                state.rows, state.last_t, state.last_id = state.rows + 1, x, i
            return done

        for pdf in batches:
            out = []
            for pid, *row in zip(pdf["pid"], pdf["key"], pdf["t"], pdf["id"], strict=True):
                if waiting is None:
                    state = carried.get(int(pid))
                else:
                    out += meet(waiting, waiting[0] != row[0])
                waiting = tuple(row)
            if out:
                yield pd.DataFrame(out, columns=columns)
        if waiting is not None and (out := meet(waiting, following.get(int(pid)) != waiting[0])):
            yield pd.DataFrame(out, columns=columns)

    out = placed.mapInPandas(fold, f"key {kind}, first_id long, last_id long, start_t long, end_t long, n_rows long")
    return out.withColumnRenamed("key", key)


def tile_draw(seed: int, key: Column, k: Column) -> Column:
    """The k-th uniform draw of a key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"), F.lit(":"), k.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0


def contiguous_tiles(df: DataFrame, key: str, duration: str, least: float = 6.0, most: float = 15.0, seed: int = 42) -> DataFrame:
    """(key, tile, start_time, end_time): [0, duration) cut into tiles of random length, a tail below ``least`` dropped.

    Draws come from a hash of seed, key and tile number, so that a rerun gives the same tiles. Null keys and
    durations give no tile.
    """
    kind = "array<double>"

    def step(ends: Column, k: Column) -> Column:
        at = F.element_at(ends, -1)
        room = F.col("duration") - at
        size = F.lit(least) + tile_draw(seed, F.col("key"), k) * (F.least(F.lit(most), room) - F.lit(least))
        return F.when(room >= least, F.concat(ends, F.array(at + size))).otherwise(ends)

    rows = df.select(F.col(key).alias("key"), F.col(duration).cast("double").alias("duration")).where("key is not null and duration is not null")
    rounds = F.greatest(F.floor(F.col("duration") / least), F.lit(0)).cast("int")  # no tile is shorter than ``least``
    numbers = F.when(rounds > 0, F.sequence(F.lit(1), rounds)).otherwise(F.array().cast("array<int>"))
    ends = F.aggregate(numbers, F.array(F.lit(0.0)).cast(kind), step)
    tiles = F.arrays_zip(F.slice(ends, F.lit(1), F.greatest(F.size(ends) - 1, F.lit(0))).alias("a"), F.slice(ends, F.lit(2), F.size(ends)).alias("b"))
    flat = rows.select("key", F.posexplode(tiles).alias("at", "x"))
    return flat.select(F.col("key").alias(key), (F.col("at") + 1).alias("tile"), F.col("x.a").alias("start_time"), F.col("x.b").alias("end_time"))


def hop_windows(start: Column, end: Column, length: float, overlap: float) -> Column:
    """Array of (start, end) windows of a length that overlap by ``overlap``; the last may be cut at the end."""
    step = length - overlap
    count = F.greatest(F.lit(1), F.ceil((end - start - overlap) / step).cast("int"))
    return F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.struct((start + i * step).alias("start"), F.least(start + i * step + length, end).alias("end"))
    )
