import random

import pytest

from cliplake.operators.intervals import combine_summaries, interval_gaps, merge_intervals

DDL = "video string, a long, b long, entity string, s string, pid int"


def table(spark, rows):
    return spark.createDataFrame([(v, a, b, "x", "y", 3) for v, a, b in rows], DDL)


def brute(rows):
    by = {}
    for v, a, b in rows:
        if v is not None and a is not None and b is not None and b > a:
            by.setdefault(v, []).append((a, b))
    periods, gaps = set(), set()
    for v, iv in by.items():
        iv.sort()
        start, end, n = *iv[0], 0
        for a, b in iv:
            if a > end:
                periods.add((v, start, end, n))
                gaps.add((v, end, a))
                start, end, n = a, b, 0
            end, n = max(end, b), n + 1
        periods.add((v, start, end, n))
    return periods, gaps


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("partitions", [1, 9])
def test_equals_brute_force_with_a_hot_entity(spark, seed, partitions):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        video = "hot" if rng.random() < 0.5 else rng.choice("abcdef")
        start = rng.randrange(1500)
        rows.append((video, start, start + rng.choice([0, 1, 1, 2, 3, 5, 40, -4])))
    rows += [("hot", 0, 900), ("hot", 0, 900), (None, 1, 5), ("a", None, 5), ("a", 5, None), ("long", 0, 10**12), ("long", 5, 6)]
    df = table(spark, rows)
    periods, gaps = brute(rows)
    assert {tuple(r) for r in merge_intervals(df, "video", "a", "b", partitions).collect()} == periods
    got = [tuple(r) for r in interval_gaps(df, "video", "a", "b", partitions).collect()]
    assert set(got) == gaps and len(got) == len(gaps)


def test_touching_intervals_are_one_period(spark):
    df = table(spark, [("a", 0, 5), ("a", 5, 8), ("a", 9, 10)])
    assert sorted(map(tuple, merge_intervals(df, "video", "a", "b").collect())) == [("a", 0, 8, 2), ("a", 9, 10, 1)]
    assert [tuple(r) for r in interval_gaps(df, "video", "a", "b").collect()] == [("a", 8, 9)]


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(None, 1, 2), ("a", 3, 3)]):
        df = table(spark, rows)
        assert merge_intervals(df, "video", "a", "b").count() == 0
        assert interval_gaps(df, "video", "a", "b").count() == 0


def test_summaries_carry_reach_and_label():
    carried = combine_summaries([(0, "a", 0, 50), (2, "a", 60, 70), (1, "a", 10, 20), (3, "b", 1, 2)])
    assert carried == {1: ("a", 0, 50), 2: ("a", 0, 50), 3: ("a", 60, 70)}
