"""Structured Streaming counterparts: pages scored as they arrive, usage by time windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagewright.operators.toc import score_pages


def read_page_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of pages as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def scored_page_stream(pages: DataFrame) -> DataFrame:
    """Scores of pages that carry lines, page_index and total_pages: the batch operator has no
    state, so it runs on a stream as it is."""
    return score_pages(pages)


def usage_windows(events: DataFrame, moment: str = "ts", late: str = "1 hour", size: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """window_start, model, call_count, tokens by event time; rows later than late are dropped
    by the watermark.  Times without a zone count as UTC."""
    timed = events.withColumn("_at", F.col(moment).cast("timestamp")).withWatermark("_at", late)
    window = F.window("_at", size, slide) if slide else F.window("_at", size)
    return timed.groupBy(window.alias("w"), "model").agg(F.count(F.lit(1)).alias("call_count"), F.sum("tokens").alias("tokens")).select(F.col("w.start").alias("window_start"), "model", "call_count", "tokens")


def first_seen(rows: DataFrame, key: str, moment: str, late: str = "1 hour") -> DataFrame:
    """Rows without later copies of their key, with state bounded by the watermark."""
    return rows.withColumn("_at", F.col(moment).cast("timestamp")).withWatermark("_at", late).dropDuplicatesWithinWatermark([key])


def start(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run a stream into sink batch by batch; the checkpoint makes batches repeatable, and sink
    gets the batch's number to write it once."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
