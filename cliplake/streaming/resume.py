"""Incremental, resumable processing with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.operators.pairing import unprocessed


def process_new(
    spark: SparkSession, source: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, attempts: str | None = None
) -> None:
    """Runs ``work`` over the stream's rows whose key is not in the output yet, and appends what it makes.

    A batch that is replayed after a failure finds its keys in the output and adds nothing twice. Keys that
    ``work`` made no row of stay out of the output and are tried again by a later run; ``attempts`` keeps every
    tried key, so that such keys can be seen.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows = rows.dropDuplicates([key])
        try:
            done = spark.read.parquet(out)
            rows = unprocessed(rows, F.col(key), done, F.col(key))
        except Exception as x:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(x) and "UNABLE_TO_INFER_SCHEMA" not in str(x):
                raise
        if attempts:
            rows.select(key, F.lit(number).alias("batch")).write.mode("append").parquet(attempts)
        work(rows).write.mode("append").parquet(out)

    query = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(events: DataFrame, time: str, by: str, length: str = "1 day", late: str = "2 days") -> DataFrame:
    """(window_start, by, n_events) per tumbling window, rows later than the watermark dropped."""
    counted = events.withWatermark(time, late).groupBy(F.window(time, length), by).agg(F.count("*").alias("n_events"))
    return counted.select(F.col("window.start").alias("window_start"), by, "n_events")
