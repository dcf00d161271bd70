"""Tables kept in the cluster's shared folder, and totals over an order without one task holding it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words, as the contract has them.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset and all runs on one machine, as in tests, one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='spark-')}")
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back, which cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bucket_count(rows: int, each: int = 50_000, least: int = 16, most: int = 65_536) -> int:
    """A number of buckets, a power of two, that leaves about ``each`` rows in one."""
    n = least
    while n < most and n * each < rows:
        n *= 2
    return n


def partitions_for(spark: SparkSession, size: int, each: int = 48 << 20) -> int:
    """A number of partitions that leaves about ``each`` bytes in one, no fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def totals_before(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the group's rows that come earlier.

    ``bucket`` has to follow the order.  Rows are sorted within (group, bucket)
    only; totals of buckets, one small row each, carry the sum across buckets.
    """
    keys = [*group, bucket]
    earlier = (Window.unboundedPreceding, -1)
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*earlier)
    across = Window.partitionBy(*[F.col(g) for g in group] or [F.lit(0)]).orderBy(bucket).rowsBetween(*earlier)
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    base = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return out.join(base, same).withColumn(name, F.col("_base") + F.col("_within")).drop("_within", "_base", *[f"_k{i}" for i in range(len(keys))])
