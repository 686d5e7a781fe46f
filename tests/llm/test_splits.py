import random

import pytest

from cliplake.llm.components import components
from cliplake.llm.splits import split_related, spread_hubs, video_groups, video_key


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize(("small", "seeds"), [(10**6, 8), (5, 3)])
def test_components_equal_union_find(spark, small, seeds):
    rng = random.Random(small)
    edges = [(f"n{rng.randrange(150):03d}", f"n{rng.randrange(150):03d}") for _ in range(90)]
    edges += [(f"c{k:03d}", f"c{k + 1:03d}") for k in range(60)] + [("hub", f"leaf{k}") for k in range(40)] + [("alone", "alone"), (None, "x"), ("x", None), edges[0]]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a string, b string"), small, seeds).collect()}
    assert got == brute(edges)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize(("spelling", "key"), [("AV1_", "av1"), (" ａｖ 1__", "av1"), ("　", None), ("", None), (None, None), ("_", ""), ("a_b", "a_b")])
def test_video_key(spelling, key):
    assert video_key(spelling) == key


CLIPS = "row_id long, video_id string, clip_number long, split string, node string, n long"
SOURCES = "video_id string, uploader string, reupload_of string, title string"


def related(spark):
    rng = random.Random(4)
    clips = [(k, f"v{rng.randrange(400):03d}_", rng.choice([None, 1, 2]), "old", "x", 0) for k in range(3000)]
    clips += [(3000 + k, "V001", 1, None, None, 0) for k in range(900)] + [(9000, None, 1, None, None, 0), (9001, " ", 1, None, None, 0), (9002, "unlisted", 1, None, None, 0)]
    sources = [(f"v{k:03d}_", f" User{k // 3} " if k % 2 else None, None, "t") for k in range(400)]
    sources += [("v000_", "", "v399", "t"), ("ghost", "user0", "V005_", "t"), (None, "user1", None, "t"), ("v010_", "USER0", None, "t")]
    return spark.createDataFrame(clips, CLIPS), spark.createDataFrame(sources, SOURCES), clips, sources


def test_groups_and_splits(spark):
    clips, sources, rows, listed = related(spark)
    edges = [("v" + video_key(c[1]),) * 2 for c in rows if video_key(c[1]) is not None]
    for video, up, again, _ in listed:
        if video_key(video) is not None:
            edges.append(("v" + video_key(video),) * 2)
            if up and up.strip():
                edges.append(("v" + video_key(video), "u" + up.strip().lower()))
            if again:
                edges.append(("v" + video_key(video), "v" + video_key(again)))
    wanted = brute(edges)
    groups = {r.video_id: r.component for r in video_groups(clips, sources).collect()}
    spelled = {c[1] for c in rows if video_key(c[1]) is not None}
    assert set(groups) == spelled
    for a in list(spelled)[:80]:
        for b in list(spelled)[:80]:
            assert (groups[a] == groups[b]) == (wanted["v" + video_key(a)] == wanted["v" + video_key(b)])
    out = split_related(clips, sources).select("row_id", "video_id", "component", "split").collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.component, set()).add(r.split)
    assert all(len(s) == 1 for s in by.values())
    share = {s: sum(r.split == s for r in out) / len(out) for s in ("train", "validation", "test")}
    assert abs(share["train"] - 0.8) < 0.05 and share["validation"] > 0.05 and share["test"] > 0.05
    again = {(r.row_id, r.split) for r in split_related(clips.repartition(5), sources).select("row_id", "split").collect()}
    assert again == {(r.row_id, r.split) for r in out}


def test_hubs_of_any_degree(spark):
    rng = random.Random(7)
    ties = [(f"v:{k}", rng.choice(["u:big", "u:big", "v:0", f"u:{k % 9}"])) for k in range(400)]
    edges = spread_hubs(spark.createDataFrame(ties, "node string, hub string"), fan=10)
    rows = [(r.a, r.b) for r in edges.collect()]
    near = {}
    for a, b in rows:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    assert max(len(x) for x in near.values()) <= 30  # salts are drawn by hash, so a list is about as long as fan
    wanted, got = brute(ties), brute(rows)
    nodes = [n for t in ties for n in t]
    for a in nodes[:60]:
        assert all((got[a] == got[b]) == (wanted[a] == wanted[b]) for b in nodes[:60])
    # through the whole operator: sub-nodes change no group
    clips, sources, *_ = related(spark)
    plain = {r.video_id: r.component for r in video_groups(clips, sources).collect()}
    spread = {r.video_id: r.component for r in video_groups(clips, sources, fan=2).collect()}
    assert plain.keys() == spread.keys() and len(set(zip(plain.values(), (spread[v] for v in plain), strict=True))) == len(set(plain.values())) == len(set(spread.values()))


@pytest.mark.parametrize("nameless", [None, "", " 　"])
def test_a_third_of_the_rows_without_a_video(spark, nameless):
    rows = [(k, nameless if k % 3 == 0 else f"v{k % 50}", 1, None, None, 0) for k in range(900)]
    df = spark.createDataFrame(rows, CLIPS)
    out = split_related(df, spark.createDataFrame([], SOURCES))
    got = out.select("row_id", "video_id", "component", "split").collect()
    assert len(got) == 900 and len({r.component for r in got if r.video_id == nameless}) == 300
    assert all(len({r.split for r in got if r.video_id == v}) == 1 for v in {f"v{k}" for k in range(50)})


def test_empty_tables(spark):
    clips, sources = spark.createDataFrame([], CLIPS), spark.createDataFrame([], SOURCES)
    assert video_groups(clips, sources).count() == 0 and split_related(clips, sources).count() == 0
    alone = split_related(spark.createDataFrame([(1, "v", 1, None, None, 0)], CLIPS), sources).collect()
    assert len(alone) == 1 and alone[0].split in ("train", "validation", "test")
