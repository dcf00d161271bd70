"""Results that are kept for as long as what they were made of stays the same; files by their contents; tables that get columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.sources.readers import inventory


def signature(df: DataFrame, columns: list[str]) -> str:
    """A checksum of the set of distinct rows, whatever their order: a count and sums of hashes, one row to the driver."""
    row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(row, k, 15), 16, 10).cast("decimal(38,0)")) for k in (1, 16, 31, 46)]
    got = df.select(*columns).distinct().agg(F.count("*"), *parts).first()
    return "-".join(str(x or 0) for x in got)


def of_files(spark: SparkSession, folder: str) -> str:
    """The signature of a folder's files: path, size, time; none is opened."""
    return signature(inventory(spark, folder), ["path", "bytes", "modified"])


def reused(spark: SparkSession, path: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What was made under ``key``, read from ``path``, or made now and written there.

    Each key has a folder of its own, named by it, and counts once Spark has marked it as
    complete; an older or half-written one is never read.
    """
    place = f"{path}/key={key}"
    spark_path = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
    if not spark_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark_path):
        make().write.mode("overwrite").parquet(place)
    return spark.read.parquet(place)


def report_cache(spark: SparkSession, path: str, source: DataFrame, columns: list[str], report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A small report, made again only when the rows it is of have changed."""
    return reused(spark, path, signature(source, columns), lambda: report(source).coalesce(1))


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, sha256) of all files, hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verified_files(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """(path, verdict) of a manifest's files (path, bytes, sha256): ok, missing, size differs, contents differ; a file beyond it is unlisted."""
    m = manifest.select("path", F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha"), F.lit(True).alias("_listed"))
    both = m.join(found, "path", "full_outer")
    verdict = F.when(F.col("_listed").isNull(), "unlisted").when(F.col("bytes").isNull(), "missing").when(F.col("bytes") != F.col("_bytes"), "size differs")
    return both.select("path", verdict.when(~F.col("sha256").eqNullSafe(F.col("_sha")), "contents differ").otherwise("ok").alias("verdict"))


def with_added(df: DataFrame, added: dict[str, Column]) -> DataFrame:
    """Columns that a table lacks, filled from the others; those that it has keep their values but for nulls."""
    return df.withColumns({name: F.coalesce(F.col(name), value) if name in df.columns else value for name, value in added.items()})


def next_number(df: DataFrame, key: str) -> int:
    """Where a sequence goes on: one beyond the largest key, 1 for an empty table."""
    return (df.agg(F.max(key)).first()[0] or 0) + 1
