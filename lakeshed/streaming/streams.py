"""Streams: rows once by key, running counts, windows by event time, upserts and dead letters by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, path: str, schema: StructType | str, files_a_trigger: int = 16) -> DataFrame:
    """New Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(path)


def once_by_key(stream: DataFrame, keys: list[str], event_time: str | None = None, late: str = "1 hour") -> DataFrame:
    """The first arrival of each key; with an event time state is kept only within ``late``."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(keys) if event_time else stream.dropDuplicates(keys)


def running_counts(stream: DataFrame, keys: list[str]) -> DataFrame:
    return stream.groupBy(*keys).agg(F.count("*").alias("n"))


def windowed(stream: DataFrame, event_time: str, width: str, keys: list[str], late: str = "1 hour", *measures: Column) -> DataFrame:
    """Counts and measures by window of event time; later rows than ``late`` are left out."""
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, width), *keys).agg(F.count("*").alias("n"), *measures)


def sessions(stream: DataFrame, event_time: str, gap: str, key: str, late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(event_time, late).groupBy(F.session_window(event_time, gap), key).agg(F.count("*").alias("n"))


def run_once(stream: DataFrame, sink: str, path: str, checkpoint: str, mode: str = "append") -> None:
    """Handles all files there are and stops; a rerun goes on where it stopped."""
    stream.writeStream.format(sink).option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> None:
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def split_failures(batch: DataFrame, fails: Column, good: str, bad: str, number: int) -> None:
    """A micro-batch's rows into two folders by batch number, so that a repeated batch replaces itself."""
    marked = batch.withColumn("_fails", F.coalesce(fails, F.lit(True)))
    marked.filter("not _fails").drop("_fails").write.mode("overwrite").parquet(f"{good}/batch={number}")
    marked.filter("_fails").drop("_fails").write.mode("overwrite").parquet(f"{bad}/batch={number}")


def to_retry(dead: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Dead letters that nothing has handled since."""
    return dead.join(done.select(key).distinct(), key, "left_anti")
