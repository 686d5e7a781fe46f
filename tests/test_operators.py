import random

import pytest
from pyspark.sql import functions as F

from cliplake.operators import ordinal as O
from cliplake.operators import pairing as J
from cliplake.operators import segment as S

CLIP = "row_id long, clip_path string, clip_filename string, video_id string, clip_number long, start_time double, end_time double, duration double, description string"


def clips(spark, rows):
    made = [(k, f"/c/{v}__clip{n or 0:04d}_0.00-1.00.mp4", None, v, n, 0.0, 1.0, 1.0, text) for k, (v, n, text) in enumerate(rows)]
    return spark.createDataFrame(made, CLIP)


def test_last_wins_even_if_null(spark):
    df = clips(spark, [("v", 1, "old"), ("v", 1, None), ("w", 1, "a"), ("w", 1, "b")])
    got = {r.video_id: r.description for r in J.clip_index(df, "row_id").collect()}
    assert got == {"v": None, "w": "b"}


def test_invalid_keys_are_not_indexed(spark):
    df = clips(spark, [("", 1, "a"), (None, 1, "a"), ("v", None, "a"), ("v", 2, "a")])
    assert J.clip_index(df, "row_id").count() == 1
    assert J.clip_index(df, "row_id", strict=False).count() == 2


def test_predecessors_are_exact(spark):
    df = clips(spark, [("v", 1, "one"), ("v", 2, "two"), ("v", 4, "four"), ("w", 2, "no file"), ("u", 1, ""), ("u", 2, "x")])
    files = spark.createDataFrame(
        [("/c/v__clip0001_0.00-6.00.mp4",), ("/b/v__clip0001_0.00-6.00.mp4",), ("/c/v__clip0003_9.00-12.50.mp4",), ("/c/u__clip0001_0.00-1.00.mp4",), ("/c/odd.mp4",), (None,)], "clip_path string"
    )
    index = J.clip_index(df, "row_id")
    got = {(r.current_clip.video_id, r.current_clip.clip_number): r for r in J.pair_with_previous(index, J.clip_files(files)).collect()}
    assert set(got) == {("v", 2), ("v", 4), ("u", 2)}
    assert got["v", 2].previous_clip.description == "one" and got["v", 2].previous_has_description
    stub = got["v", 4].previous_clip
    assert (stub.clip_number, stub.start_time, stub.duration, stub.description) == (3, 9.0, 3.5, None) and not got["v", 4].previous_has_description
    assert not got["u", 2].previous_has_description
    every = {(r.current_clip.video_id, r.current_clip.clip_number): r for r in J.pair_with_previous(index, J.clip_files(files), include_missing=True).collect()}
    assert every["w", 2].previous_clip is None and every["w", 2].has_previous is False and every["w", 2].previous_has_description is None


def test_anti_join_keeps_rows_without_key(spark):
    tasks = spark.createDataFrame([("a",), ("b",), (None,), ("b",)], "k string")
    done = spark.createDataFrame([("a",), (None,)], "k string")
    assert sorted((r.k or "") for r in J.unprocessed(tasks, F.col("k"), done, F.col("k")).collect()) == ["", "b", "b"]
    assert {(r.k, r.present) for r in J.presence(tasks, F.col("k"), done, F.col("k")).collect()} == {("a", True), ("b", False), (None, False)}


def test_dense_ordinal_over_many_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    rows = O.dense_ordinal(df, ["x"], partitions=7).collect()
    assert all(r.x == r.ordinal for r in rows) and len(rows) == 1000
    assert O.dense_ordinal(df.where("x < 0"), ["x"]).count() == 0
    shard = O.stride_shard(O.dense_ordinal(df, ["x"]), "ordinal", 2, 3)
    assert {r.ordinal % 3 for r in shard.collect()} == {1}
    with pytest.raises(ValueError):
        O.stride_shard(df, "x", 0, 3)


def test_limits_and_union(spark):
    df = spark.createDataFrame([("a", k) for k in range(5)] + [("b", 1)], "g string, k long")
    assert sorted((r.g, r.k) for r in O.group_limit(df, "g", ["k"], 2).collect()) == [("a", 0), ("a", 1), ("b", 1)]
    assert O.prefix_limit(df, ["k"], 0).count() == 6 and O.prefix_limit(df, ["k"], 2).count() == 2
    both = O.union_ordered(df, df.drop("g"), order="k").collect()
    assert len(both) == 12 and [r.source_rank for r in both] == [0] * 6 + [1] * 6


def two_pointer(ends, longest, gap, least):
    out, i, m = [], 0, len(ends)
    while i < m - 1:
        j = i + 1
        while j < m - 1 and not (ends[j] - ends[i] > longest or ends[j] - ends[j - 1] > gap):
            j += 1
        if ends[j - 1] - ends[i] >= least:
            out.append((i, j))
        i = j
    return out


def test_greedy_cuts_equal_two_pointers():
    rng = random.Random(3)
    for _ in range(2000):
        ends, t = [], 0
        for _ in range(rng.randrange(14)):
            t += rng.choice([0, 1, 1, 2, 3, 6])
            ends.append(t)
        assert S.greedy_cuts(ends, 10, 2, 3) == two_pointer(ends, 10, 2, 3)


def test_worked_examples():
    assert S.greedy_cuts([1, 2, 3, 4, 5, 6, 7, 8], 15, 2, 5) == [(0, 7)]
    assert S.greedy_cuts([1, 2, 3, 4, 5, 6, 7, 9.5, 10], 15, 2, 5) == [(0, 7)]
    assert S.greedy_cuts([], 15, 2, 5) == [] and S.greedy_cuts([1], 15, 2, 0) == []


@pytest.mark.parametrize("partitions", [1, 8, 40])
def test_greedy_segments_over_partitions(spark, partitions):
    rng = random.Random(partitions)
    rows, wanted = [], set()
    # a third of the rows under one key without a gap, once at even steps, where chains of cuts never merge
    steps = {"even": [1], "gapless": [0, 1, 2], "ties": [0, 0, 0, 0, 1]}
    for key, n in (("hot", 300), ("a", 7), ("b", 1), ("c", 40), ("even", 200), ("gapless", 500), ("ties", 200)):
        t, times = 0, []
        for k in range(n):
            t += rng.choice(steps.get(key, [0, 1, 1, 1, 2, 4]))
            times.append(t)
            rows.append((key, t, k))
        for i, j in two_pointer(times, 12, 3, 4):
            wanted.add((key, i, j - 1, times[i], times[j - 1], j - i))
    rows += [(None, 3, 1), ("a", None, 99)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, t long, i long")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert {tuple(r) for r in S.greedy_segments(df, "k", "t", "i", 12, 3, 4).collect()} == wanted
        assert S.greedy_segments(df.where("false"), "k", "t", "i", 12, 3, 4).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_word_timing_and_cue_cleaning(spark):
    cues = [("go go left", 0, 1000), (" 　", 0, 1), ("a [x]", 0, 1), (None, 1, 2), ("late", None, 1150)]
    df = spark.createDataFrame([(cues,)], "c array<struct<text:string,start:long,end:long>>").select(S.clean_cues(F.col("c")).alias("c"))
    got = df.first().c
    assert [(c.start, c.end, c.text) for c in got] == [(0.0, 1.0, "go go left"), (0.0, 1.1, "late")]
    told = df.select(F.flatten(F.transform("c", lambda c: S.timed_words(c["start"], c["end"], c["text"]))).alias("w")).first().w
    assert [tuple(w) for w in told][:2] == [(0.0, 0.5, "go"), (0.5, 1.0, "left")]


def test_commentary_clips(spark):
    said = [(float(k), float(k + 1), f"w{k}") for k in range(9)]
    df = spark.createDataFrame([("v", "t", "game", said), ("one", "t", "game", said[:1]), ("none", "t", "game", [])], "video string, title string, category string, subtitles array<struct<start:double,end:double,text:string>>")
    got = S.commentary_clips(df, longest=4, gap=2, least=3).collect()
    assert [(r.video, r.start_time, r.end_time, r.previous) for r in got] == [("v", 0.0, 5.0, "")]
    more = S.commentary_clips(df, longest=3, gap=2, least=3, fastest=10).collect()
    assert [(r.start_time, r.previous) for r in more] == [(0.0, ""), (4.0, "w0 w1 w2 w3")]
    assert S.commentary_clips(df, longest=3, gap=2, least=3, fastest=0.5, slowest=0).count() == 0
    assert S.commentary_clips(df, longest=3, gap=2, least=3, fastest=0.5, check_rate=False, most=1).count() == 1


def test_tiles_are_contiguous_and_repeatable(spark):
    df = spark.createDataFrame([("a", 100.0), ("b", 5.0), ("c", 6.0), (None, 9.0), ("d", None)], "k string, d double")
    rows = sorted(map(tuple, S.contiguous_tiles(df, "k", "d").collect()))
    assert rows == sorted(map(tuple, S.contiguous_tiles(df.repartition(3), "k", "d").collect()))
    a = [r for r in rows if r[0] == "a"]
    assert all(x[3] == y[2] for x, y in zip(a, a[1:], strict=False)) and 100 - a[-1][3] < 6 and all(6 <= r[3] - r[2] <= 15 for r in a)
    assert [r[1:] for r in rows if r[0] == "c"] == [(1, 0.0, 6.0)] and not [r for r in rows if r[0] in ("b", "d")]


def test_hop_windows(spark):
    df = spark.createDataFrame([(0.0, 20.0), (0.0, 3.0)], "s double, e double").select(S.hop_windows(F.col("s"), F.col("e"), 10.0, 2.0).alias("w"))
    assert [[tuple(x) for x in r.w] for r in df.collect()] == [[(0.0, 10.0), (8.0, 18.0), (16.0, 20.0)], [(0.0, 3.0)]]
