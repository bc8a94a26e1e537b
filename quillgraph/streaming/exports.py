"""Exports that arrive as files in a directory, read as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.exports import clean_bytes, parse_lines


def stream_entries(spark: SparkSession, directory: str, files_at_once: int = 100) -> DataFrame:
    """line_no (null: streaming.records orders lines), global_name, subscripts, value, raw_line of every entry of the files in a directory."""
    text = spark.readStream.option("maxFilesPerTrigger", files_at_once).text(directory)
    return parse_lines(text.select(F.lit(None).cast("bigint").alias("line_no"), clean_bytes(F.col("value")).alias("raw")))


def keep_up(entries: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Hand every batch of entries to write(batch, number); with once, stop when all files there are read."""
    out = entries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()
