"""Streams of lines: cleaning and exact deduplication with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import cleaned


def stream_table(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """A growing folder of parquet files as a stream; the schema is that of the files now there."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def unique_lines(lines: DataFrame, time_col: str, delay: str = "7 days") -> DataFrame:
    """Cleaned lines, each hash once within ``delay`` of its first arrival: late copies are still known, older state is dropped."""
    rows = cleaned(lines).withColumn("hash", F.md5("line"))
    return rows.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["hash"])


def loss_by_window(points: DataFrame, time_col: str, loss: str, window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Mean loss of each run and time window of a stream of log points."""
    return points.withWatermark(time_col, delay).groupBy(F.window(time_col, window), "run_key").agg(F.avg(loss).alias("mean_loss"), F.count("*").alias("points"))
