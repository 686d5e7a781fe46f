"""Connected components by concurrent breadth-first search from many seeds.

Adjacency lists are hash-partitioned; hash-chosen seeds expand together for a fixed number of rounds; nodes
that no seed reached become seeds themselves; edges between differently labelled nodes give a graph of seed
labels, smaller by the seeding rate, which is merged on its own (again by search while it is large, in one
bounded task once it is small).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.session import write_out

SEED_ONE_IN = 8
ROUNDS = 3
SMALL_EDGES = 500_000


def _union_find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parent: dict = {}

    def find(x):
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for pdf in batches:
        for a, b in zip(pdf["a"], pdf["b"], strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    names = list(parent)
    yield pd.DataFrame({"node": pd.Series(names, dtype=object), "label": pd.Series([find(x) for x in names], dtype=object)})


def components(edges: DataFrame, small_edges: int = SMALL_EDGES, seed_one_in: int = SEED_ONE_IN, rounds: int = ROUNDS) -> DataFrame:
    """Components of an undirected graph: (node string, component string), the component being its smallest node.

    ``edges`` has the columns a and b. Nulls are left out; loops and repeated edges change nothing (a node
    with only a loop is a component of its own); no edges give no rows. Up to ``small_edges`` edges of seed labels are merged
    in one task, a documented bound of that task's memory; a larger graph of seed labels is searched again.
    """
    given = edges.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b")).where("a is not null and b is not null")
    pairs = write_out(given.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = _label(pairs, small_edges, seed_one_in, rounds, 0)
    return labels.withColumnRenamed("label", "component")


def _label(pairs: DataFrame, small_edges: int, seed_one_in: int, rounds: int, level: int) -> DataFrame:
    if level and pairs.count() <= small_edges:
        return pairs.coalesce(1).mapInPandas(_union_find, "node string, label string")
    both = pairs.where("a <> b")
    adjacency = write_out(
        both.select("a", "b").union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumnRenamed("a", "node").repartition("node")
    )
    nodes = write_out(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    seeded = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(seed_one_in)) == 0
    reached = write_out(nodes.where(seeded).select("node", F.col("node").alias("label")))
    frontier = reached
    for _ in range(rounds):
        step = adjacency.join(frontier, "node").groupBy(F.col("b").alias("node")).agg(F.min("label").alias("label"))
        frontier = write_out(step.join(reached, "node", "left_anti"))
        reached = reached.union(frontier)
    left = write_out(nodes.join(reached, "node", "left_anti"))
    # a node that no seed reached takes its smallest neighbour, so that every level shrinks
    beside = left.join(adjacency, "node", "left").groupBy("node").agg(F.least("node", F.min("b")).alias("label"))
    reached = write_out(reached.union(beside))
    a, b = reached.toDF("a", "la"), reached.toDF("b", "lb")
    collided = both.join(a, "a").join(b, "b").where("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
    merged = _label(write_out(collided.distinct()), small_edges, seed_one_in, rounds, level + 1).toDF("label", "root")
    rooted = write_out(reached.join(merged, "label", "left").select("node", F.coalesce("root", "label").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("node").alias("label"))
    return rooted.join(smallest, "root").select("node", "label")
