"""Rows kept in the cluster's shared folder: cut from their lineage, and there when executors are lost."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset and all runs on one machine, as in tests, one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='spark-')}")
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """Writes the rows that several steps read to the shared folder and reads them back."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
