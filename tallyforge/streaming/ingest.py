"""Pages and events as streams: routing of pages as they arrive, sessions by gaps, late data by watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import numbers
from ..operators import pages
from ..sources.readers import PAGE_TEXT


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """page_text rows from JSON files that arrive in a folder."""
    return spark.readStream.schema(PAGE_TEXT).option("maxFilesPerTrigger", str(files_per_batch)).json(path)


def route(stream: DataFrame) -> DataFrame:
    """Pages with tags, unit, quality and number of amounts: stateless, so that each page is routed once."""
    unit = numbers.unit_of(F.col("text"))
    return stream.withColumns({"tags": pages.page_tags(F.col("text")), "unit": unit, "quality_ok": pages.quality_ok(F.col("text")), "n_tokens": F.size(numbers.line_tokens(F.col("text")))})


def sessions(events: DataFrame, gap: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """(user_id, start, end, n, total) of runs of events that are no further apart than the gap."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark("ts", late)
    s = e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return s.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def windowed(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """(start, event_type, n, total) of tumbling windows."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark("ts", late)
    w = e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def write_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write what is there to Parquet, exactly once, and end."""
    return stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
