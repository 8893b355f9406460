"""Following a folder of logs: the same parsers over a stream, and counts by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import parse_log


def tail_logs(spark: SparkSession, folder: str, format: str = "jsonl", files_per_batch: int = 100) -> DataFrame:
    """Events of every file that appears in the folder. Parsing has no state, so append mode works."""
    docs = spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", files_per_batch).text(folder).select(F.col("value").alias("content"), F.col("_metadata.file_path").alias("log_file"))
    return parse_log(docs, "content", format, log_file="log_file")


def counts_by_time(events: DataFrame, at: str = "started_at", window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Events by window, tool and status; a watermark bounds the state."""
    timed = events.withColumn("_at", F.to_timestamp(at)).where("_at is not null").withWatermark("_at", late)
    return timed.groupBy(F.window("_at", window), "tool_name", "status").count().select("window.start", "window.end", "tool_name", "status", F.col("count").alias("n"))
