"""Merging overlapping intervals per entity and listing the gaps between the merged periods.

The scan never gathers an entity: rows are range-sorted by (entity, start) over all partitions, each
partition folds its own rows to disjoint islands, one summary row per partition is prefix-combined,
and the islands are rescanned with the state carried into their partition. A hot entity is spread over
as many partitions as its rows need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.session import cut_lineage, table_partitions

_ISLANDS = "pid int, entity string, isl_start long, isl_end long, n_rows long"
_LABELLED = "entity string, period_start long, period_end long, n_rows long, gap_start long"


def _fold_islands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (pid, entity, s, e, n) rows to the partition's disjoint islands; state crosses batches."""
    open_island = None  # (pid, entity, start, end, rows)
    for pdf in batches:
        if pdf.empty:
            continue
        pid = int(pdf["pid"].iat[0])
        entity = pdf["entity"].to_numpy()
        start = pdf["s"].to_numpy(np.int64)
        end = pdf["e"].to_numpy(np.int64)
        if open_island is not None and open_island[1] == entity[0] and start[0] <= open_island[3]:
            # the open island goes in front of the batch as one more row
            entity = np.concatenate([np.array([open_island[1]], dtype=object), entity])
            start = np.concatenate([[open_island[2]], start])
            end = np.concatenate([[open_island[3]], end])
            count = np.concatenate([[open_island[4]], pdf["n"].to_numpy(np.int64)])
        else:
            if open_island is not None:
                yield pd.DataFrame([open_island], columns=["pid", "entity", "isl_start", "isl_end", "n_rows"])
            count = pdf["n"].to_numpy(np.int64)
        fresh = np.ones(len(start), bool)
        fresh[1:] = entity[1:] != entity[:-1]
        group = np.cumsum(fresh) - 1
        reach = pd.Series(end).groupby(group).cummax().to_numpy()
        breaks = fresh.copy()
        breaks[1:] |= start[1:] > reach[:-1]
        first = np.flatnonzero(breaks)
        last = np.append(first[1:], len(start)) - 1
        out = pd.DataFrame(
            {
                "pid": np.int32(pid),
                "entity": entity[first],
                "isl_start": start[first],
                "isl_end": reach[last],
                "n_rows": np.add.reduceat(count, first),
            }
        )
        open_island = (pid, *(out[c].iat[-1] for c in ("entity", "isl_start", "isl_end", "n_rows")))
        if len(out) > 1:
            yield out.iloc[:-1]
    if open_island is not None:
        yield pd.DataFrame([open_island], columns=["pid", "entity", "isl_start", "isl_end", "n_rows"])


def combine_summaries(summaries: list[tuple[int, str, int, int]]) -> dict[int, tuple[str, int, int]]:
    """Prefix-combine (pid, last entity, last island's start, its end) into each partition's carried state.

    The state before partition p is (entity, label, reach): the last entity before p, the start of its
    open period and the furthest end seen of it.
    """
    carried: dict[int, tuple[str, int, int]] = {}
    state: tuple[str, int, int] | None = None
    for pid, entity, start, end in sorted(summaries):
        if state is not None:
            carried[pid] = state
        if state is None or state[0] != entity or start > state[2]:
            reach = end if state is None or state[0] != entity else max(end, state[2])
            state = (entity, start, reach)
        else:
            state = (entity, state[1], max(end, state[2]))
    return carried


def _label(carried: dict[int, tuple[str, int, int]]):
    def rescan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        at = None
        for pdf in batches:
            for pid, part in pdf.groupby("pid", sort=False):
                if pid != at:
                    at, state = pid, carried.get(int(pid))
                entity = part["entity"].to_numpy()
                start = part["isl_start"].to_numpy(np.int64)
                end = part["isl_end"].to_numpy(np.int64)
                label = start.copy()
                gap = np.empty(len(part), dtype=object)
                same = np.zeros(len(part), bool)
                same[1:] = entity[1:] == entity[:-1]
                gap[1:][same[1:]] = end[:-1][same[1:]]
                # only the leading islands of the carried entity can be reached by the state
                k = 0
                while state is not None and k < len(part) and entity[k] == state[0]:
                    if start[k] > state[2]:
                        gap[k] = state[2]
                        break
                    label[k] = state[1]
                    gap[k] = None
                    state = (state[0], state[1], max(state[2], int(end[k])))
                    k += 1
                state = (entity[-1], int(label[-1]), max(int(end[-1]), state[2] if state and state[0] == entity[-1] else int(end[-1])))
                yield pd.DataFrame(
                    {
                        "entity": entity,
                        "period_start": label,
                        "period_end": end,
                        "n_rows": part["n_rows"].to_numpy(),
                        "gap_start": pd.array([None if g is None else int(g) for g in gap], dtype="Int64"),
                    }
                )

    return rescan


def _labelled_islands(df: DataFrame, entity: str, start: str, end: str, partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    rows = df.select(
        F.col(entity).cast("string").alias("entity"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e")
    ).where("entity is not null and s is not null and e is not null and e > s")
    # equal rows cannot be split by range: they are counted first, map-side
    rows = rows.groupBy("entity", "s", "e").agg(F.count("*").alias("n"))
    ranged = rows.repartitionByRange(partitions or table_partitions(spark), "entity", "s", "e").sortWithinPartitions("entity", "s", "e")
    islands = cut_lineage(ranged.withColumn("pid", F.spark_partition_id()).mapInPandas(_fold_islands, _ISLANDS))
    last = F.max(F.struct("entity", "isl_start", "isl_end")).alias("x")
    # one row per partition: bounded by the partition count, whatever the data
    summaries = [(r.pid, r.x.entity, r.x.isl_start, r.x.isl_end) for r in islands.groupBy("pid").agg(last).collect()]
    return islands.mapInPandas(_label(combine_summaries(summaries)), _LABELLED)


def merge_intervals(df: DataFrame, entity: str, start: str, end: str, partitions: int | None = None) -> DataFrame:
    """Continuous periods per entity: (entity, period_start, period_end, n_intervals).

    Intervals that overlap, nest or touch form one period. Rows with a null entity, start or end, or with
    end <= start, are no intervals and are left out; repeated rows count in ``n_intervals`` but change no
    period. An empty table gives no rows; other columns of ``df``, whatever their names, are not read.
    """
    islands = _labelled_islands(df, entity, start, end, partitions)
    return (
        islands.groupBy("entity", "period_start")
        .agg(F.max("period_end").alias("period_end"), F.sum("n_rows").alias("n_intervals"))
        .select(F.col("entity").alias(entity), "period_start", "period_end", "n_intervals")
    )


def interval_gaps(df: DataFrame, entity: str, start: str, end: str, partitions: int | None = None) -> DataFrame:
    """Gaps between successive periods of an entity: (entity, gap_start, gap_end), of any length.

    An entity with a single period has no gap. Same treatment of nulls, empty tables, ties and repeated
    rows as :func:`merge_intervals`.
    """
    islands = _labelled_islands(df, entity, start, end, partitions)
    return islands.where("gap_start is not null").select(
        F.col("entity").alias(entity), "gap_start", F.col("period_start").alias("gap_end")
    )
