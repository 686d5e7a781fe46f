"""Dense global ordinals, shards, limits and shuffles by order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliplake.session import cut_lineage, table_partitions


def dense_ordinal(df: DataFrame, order: list[str], name: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """``df`` with a 0-based dense number of its row in the given order.

    Range-sorted partitions are counted and offset by the counts before them; no single task sees all rows.
    Rows equal in ``order`` are numbered in an arbitrary but fixed order of one run.
    """
    spark = df.sparkSession
    sorted_rows = df.repartitionByRange(partitions or table_partitions(spark), *order).sortWithinPartitions(*order)
    placed = cut_lineage(sorted_rows.withColumn("_at", F.monotonically_increasing_id()))
    pid = F.shiftright("_at", 33)
    counts = sorted((r.pid, r.n) for r in placed.groupBy(pid.alias("pid")).agg(F.count("*").alias("n")).collect())  # one per partition
    before, offsets = 0, []
    for p, n in counts:
        offsets.append((p, before))
        before += n
    table = spark.createDataFrame(offsets, "pid long, before long")
    numbered = placed.withColumn("pid", pid).join(F.broadcast(table), "pid")
    return numbered.withColumn(name, F.col("before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "pid", "before")


def stride_shard(df: DataFrame, ordinal: str, part: int, parts: int) -> DataFrame:
    """Every ``parts``-th row from the ``part``-th (1-based) on."""
    if not 1 <= part <= parts:
        raise ValueError(f"part {part} of {parts}")
    return df.where(F.col(ordinal) % parts == part - 1)


def prefix_limit(df: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first rows in order; 0 means no limit."""
    return df.orderBy(*order).limit(most) if most else df


def group_limit(df: DataFrame, key: str, order: list[Column | str], most: int) -> DataFrame:
    """The first ``most`` rows of every key; each task cuts its groups before anything is shuffled."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")


def union_ordered(*frames: DataFrame, order: str) -> DataFrame:
    """All rows one table after the other: with the columns source_rank and the order column, duplicates kept."""
    ranked = [df.withColumn("source_rank", F.lit(k)) for k, df in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked).orderBy("source_rank", order)


def shuffle_key(key: Column, seed: int = 42) -> Column:
    """Sort key of a deterministic full shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
