"""Streaming entry points: the batch operators over arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stratakit.operators import rowparse


def line_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def parse_stream(lines: DataFrame, headers: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Error-parse every arriving batch of lines; loaded and rejected rows go to two folders, each batch to its own, so that a repeated
    batch replaces what it wrote before."""

    def write(batch: DataFrame, number: int) -> None:
        parsed = rowparse.error_parse(batch, headers).persist()
        rowparse.loaded(parsed).write.mode("overwrite").parquet(f"{out}/loaded/batch={number}")
        rowparse.rejected(parsed).write.mode("overwrite").parquet(f"{out}/rejected/batch={number}")
        parsed.unpersist()

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once_per_key(stream: DataFrame, keys: list[str], time: str, delay: str = "30 days") -> DataFrame:
    """Drop repeated deliveries that arrive within ``delay`` of the first."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def counts_by_window(stream: DataFrame, time: str, key: str, width: str = "1 day", delay: str = "7 days") -> DataFrame:
    """Rows per window and key; rows later than ``delay`` are left out."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))
