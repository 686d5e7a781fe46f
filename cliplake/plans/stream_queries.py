"""Queries that run Structured Streaming to the end of the present input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.session import ensure_checkpoint_dir, read_table
from cliplake.streaming.resume import process_new, windowed_counts


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = read_table(spark, sf_dir, name).schema
    # as a pattern, the path may be one file or a folder of files
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 20).parquet(f"{sf_dir}/{name}.parque[t]")


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same source: the second finds all keys done."""
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    work = lambda rows: rows.select("qa_id", F.coalesce(F.length("answer"), F.lit(0)).alias("n_chars"))
    for run in range(2):
        process_new(spark, _stream(spark, sf_dir, "clip_qa_pairs"), "qa_id", work, f"{base}/out", f"{base}/run-{run}", f"{base}/attempts")
    return spark.read.parquet(f"{base}/out")


def stream_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = _stream(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    counts = windowed_counts(events, "ts", "event_type")

    def keep(rows: DataFrame, batch: int) -> None:
        rows.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{base}/out")

    # every batch gives the windows that it changed; windows behind the watermark leave the state
    query = counts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    last = spark.read.parquet(f"{base}/out").groupBy("window_start", "event_type").agg(F.max_by("n_events", "batch").alias("n_events"))
    return last.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n_events")


def stored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as JSON lines and read back with its bad rows counted."""
    from cliplake.sources.jsonl import read_jsonl
    from cliplake.sources.sinks import write_jsonl

    path = f"{ensure_checkpoint_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    write_jsonl(read_table(spark, sf_dir, "clip_qa_pairs").select("qa_id", "question", "answer", "end_time"), path)
    good, _ = read_jsonl(spark, path, "qa_id LONG, question STRING, answer STRING, end_time DOUBLE", exact=False)
    return good.select("qa_id", "question", "answer", "end_time")


QUERIES = {"stream_resume": stream_resume, "stream_event_windows": stream_event_windows, "jsonl_round_trip": stored_pairs}

SQL = {
    "stream_resume": "SELECT qa_id, CAST(coalesce(length(answer), 0) AS INTEGER) AS n_chars FROM clip_qa_pairs",
    "stream_event_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n_events FROM events WHERE ts IS NOT NULL GROUP BY 1, 2",
    "jsonl_round_trip": "SELECT qa_id, question, answer, end_time FROM clip_qa_pairs",
}
