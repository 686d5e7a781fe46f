"""Train, validation and test splits that keep related records together."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.llm.components import components
from cliplake.session import cut_lineage, table_partitions, write_out

#: Ties that one node has at most: a more popular uploader or original gets as many sub-nodes as that takes.
FAN = 10_000
HUGE_SHARE = 0.01
HOT_ONE_IN = 64


def video_key(spelling: str | None) -> str | None:
    """NFKC, lower case, no white space, no trailing underscores; None for a null or blank spelling."""
    if spelling is None or not spelling.strip():
        return None
    return "".join(unicodedata.normalize("NFKC", spelling).lower().split()).rstrip("_")


def uploader_key(name: str | None) -> str | None:
    """Lower case without outer white space; None for a null or blank name."""
    return (name or "").strip().lower() or None


def _source_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        own = [video_key(x) for x in pdf["video_id"]]
        again = [video_key(x) for x in pdf["reupload_of"]]
        by = [uploader_key(x) for x in pdf["uploader"]]
        name = lambda keys, kind: pd.Series([None if k is None else kind + k for k in keys], dtype=object)
        yield pd.DataFrame({"node": name(own, "v:"), "other": name(again, "v:"), "u": name(by, "u:")})


def _clip_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keys = [video_key(x) for x in pdf["video_id"]]
        out = pdf.assign(node=[None if k is None else "v:" + k for k in keys])
        yield out[out["node"].notna()]


def spread_hubs(ties: DataFrame, fan: int = FAN) -> DataFrame:
    """Edges (a, b) of the ties (node, hub); a hub of over ``fan`` ties is reached through sub-nodes.

    The hubs that need them are few (the ties over ``fan``) and written out, so that their join is planned from
    their true number.
    """
    degrees = ties.groupBy(F.col("hub").alias("busy")).agg(F.count("*").alias("n")).where(F.col("n") > fan)
    busy = write_out(degrees.select("busy", F.ceil(F.col("n") / fan).cast("int").alias("salts")))
    salt = F.pmod(F.xxhash64("node"), F.col("salts")).cast("string")
    sub = F.concat(F.lit("s:"), "hub", F.lit(" "), salt)
    placed = ties.join(busy, F.col("hub") == F.col("busy"), "left").select("node", "hub", F.when(F.col("salts").isNotNull(), sub).alias("sub"))
    return placed.select(F.col("node").alias("a"), F.coalesce("sub", "hub").alias("b")).union(placed.where("sub is not null").select("sub", "hub").distinct())


def video_groups(clips: DataFrame, sources: DataFrame, small_edges: int | None = None, fan: int = FAN) -> DataFrame:
    """(video_id, component, n) of each distinct non-blank spelling in ``clips``, n being its rows.

    Videos are tied by equal normalised spelling, by ``reupload_of`` and by uploader, transitively. No adjacency
    list of an uploader or original is longer than ``fan``. Null and blank ids, uploaders and reuploads tie nothing.
    """
    text = lambda df, *names: df.select(*(F.col(c).cast("string").alias(c) for c in names))
    spelled = text(clips, "video_id").where("video_id is not null").groupBy("video_id").agg(F.count("*").alias("n"))
    used = write_out(spelled.mapInPandas(_clip_nodes, "video_id string, n long, node string"))
    listed = write_out(text(sources, "video_id", "uploader", "reupload_of").mapInPandas(_source_nodes, "node string, other string, u string").where("node is not null"))
    ties = listed.where("u is not null").select("node", F.col("u").alias("hub")).union(listed.where("other is not null").select("node", F.col("other").alias("hub")))
    own = listed.select("node").union(used.select("node"))
    edges = spread_hubs(ties, fan).union(own.select(F.col("node").alias("a"), F.col("node").alias("b")))
    found = components(edges) if small_edges is None else components(edges, small_edges)
    return used.join(found, "node").select("video_id", "component", "n")


def _prefix(before: dict[int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, total = None, 0
        for pdf in batches:
            if len(pdf) and at is None:
                at = int(pdf["pid"].iat[0])
                total = before.get(at, 0)
            mid = total + pdf["n"].cumsum() - pdf["n"] / 2
            total += int(pdf["n"].sum())
            yield pdf.assign(mid=mid)[["component", "n", "mid"]]

    return run


def split_related(
    clips: DataFrame,
    sources: DataFrame,
    proportions: tuple[tuple[str, float], ...] = (("train", 0.8), ("validation", 0.1), ("test", 0.1)),
    seed: int = 42,
    huge_share: float = HUGE_SHARE,
) -> DataFrame:
    """``clips`` with the columns component and split; all records of a component get one split.

    Components are laid out in the order of their hash and cut where the running row count crosses the
    proportions. Components of over ``huge_share`` of the rows (fewer than 1 / huge_share) are placed first,
    largest first, each into the split with the most room. A row with a null or blank video_id is tied to
    nothing, is a component of its own (by row_id; rows without row_id share one) and draws its split by its
    hash. An empty table gives no rows. Existing columns named component or split are replaced.
    """
    base = clips.drop("component", "split")
    groups = write_out(video_groups(clips, sources))
    sizes = write_out(groups.groupBy("component").agg(F.sum("n").alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    names = [name for name, _ in proportions]
    room = {name: share * total for name, share in proportions}
    huge = sizes.where(F.col("n") > huge_share * total).collect()  # at most 1 / huge_share rows
    placed = {}
    for r in sorted(huge, key=lambda r: (-r.n, r.component)):
        best = max(names, key=lambda name: room[name])
        placed[r.component] = best
        room[best] -= r.n
    order = F.xxhash64("component", F.lit(seed))
    small = sizes.where(F.col("n") <= huge_share * total).withColumn("h", order)
    ranged = cut_lineage(
        small.repartitionByRange(table_partitions(clips.sparkSession), "h", "component")
        .sortWithinPartitions("h", "component")
        .withColumn("pid", F.spark_partition_id())
    )
    sums = sorted((r.pid, r.n) for r in ranged.groupBy("pid").agg(F.sum("n").alias("n")).collect())  # one per partition
    before, running = {}, 0
    for pid, n in sums:
        before[pid], running = running, running + n
    laid = ranged.mapInPandas(_prefix(before), "component string, n long, mid double")
    free = {name: max(0.0, room[name]) for name in names}
    scale = running / (sum(free.values()) or 1)
    edge, which = 0.0, F.lit(names[-1])
    bounds = []
    for name in names[:-1]:
        edge += free[name] * scale
        bounds.append((edge, name))
    for edge, name in reversed(bounds):
        which = F.when(F.col("mid") < edge, name).otherwise(which)
    assigned = laid.select("component", which.alias("split"))
    if placed:
        fixed = clips.sparkSession.createDataFrame(list(placed.items()), "component string, split string")
        assigned = assigned.union(fixed)
    by_video = write_out(groups.join(assigned, "component").select("video_id", "component", "split", "n"))
    # a hot video's rows meet their split in place: at most HOT_ONE_IN videos are hot
    is_hot = F.col("n") * HOT_ONE_IN > max(total, 1)
    hot = F.broadcast(by_video.where(is_hot).drop("n"))
    # rows without a video are no key of any join
    written = F.coalesce(F.col("video_id").cast("string").rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))
    named, nameless = base.where(written), base.where(~written).withColumns({"component": F.lit(None).cast("string"), "split": F.lit(None).cast("string")})
    warm = named.join(hot, "video_id")
    cool = named.join(F.broadcast(by_video.where(is_hot).select("video_id")), "video_id", "left_anti").join(by_video.where(~is_hot).drop("n"), "video_id", "left")
    rest = cool.unionByName(nameless)
    own = F.concat(F.lit("row:"), F.coalesce(F.col("row_id").cast("string"), F.lit("")))
    draw = F.pmod(F.xxhash64(own, F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    edge, drawn = 1.0, F.lit(names[-1])
    for name, share in reversed(proportions[1:]):
        edge -= share
        drawn = F.when(draw < edge, proportions[[n for n, _ in proportions].index(name) - 1][0]).otherwise(drawn)
    alone = rest.withColumns({"component": F.coalesce("component", own), "split": F.coalesce("split", drawn)})
    return warm.unionByName(alone)
