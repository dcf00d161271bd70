"""Versions of a table in a folder: written, checked, and only then pointed at.

Each write goes to a folder of its own, ``versions/<run>-<attempt>``; a pointer
file names the one that readers see and is replaced by a rename.  So a reader
finds one whole version at any time, a failed gate or a lost job changes nothing,
and a repeated run replaces its own rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.operators.gates import Gate, checked

_POINTER = "_current"


class _Files:
    """The few calls of the file system that a pointer needs; any store that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.folder = spark.sparkContext._jvm, folder.rstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(self.folder).getFileSystem(conf).makeQualified(self.path(self.folder)).toUri(), conf)
        self.system = self.path(self.folder).getFileSystem(conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def read(self, name: str) -> str | None:
        at = self.path(f"{self.folder}/{name}")
        if not self.system.exists(at):
            return None
        source = self.system.open(at)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def replace(self, name: str, text: str) -> None:
        """Writes beside and renames over, which readers see as one step."""
        own = self.path(f"{self.folder}/.{name}-{uuid.uuid4().hex}")
        out = self.system.create(own, True)
        out.write(text.encode())
        out.close()
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        how[0] = options.OVERWRITE
        self.context.rename(own, self.path(f"{self.folder}/{name}"), how)


def version(spark: SparkSession, folder: str) -> str | None:
    """The name of the version that readers see; null before the first."""
    return _Files(spark, folder).read(_POINTER)


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that readers see: one whole version, which later writes leave in place."""
    name = version(spark, folder)
    if name is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(f"{folder.rstrip('/')}/versions/{name}")


def published(df: DataFrame, folder: str, run: str, gates: Sequence[Gate] = (), dry_run: bool = False) -> list[str]:
    """Writes a version and makes it the one that readers see, unless a gate fails on what was written; the names of failed gates."""
    name = f"{run}-{uuid.uuid4().hex[:12]}"
    path = f"{folder.rstrip('/')}/versions/{name}"
    df.write.mode("errorifexists").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    failed = [r["gate"] for r in checked(written, gates).filter("not passed").collect()] if gates else []
    if not failed and not dry_run:
        _Files(df.sparkSession, folder).replace(_POINTER, name)
    return failed


def appended(df: DataFrame, folder: str, run: str, group: str, gates: Sequence[Gate] = ()) -> list[str]:
    """Adds a run's rows to a log, once for each group and run: a repeated run's rows replace those of its groups.

    Runs are folders with versions of their own, so that others aren't rewritten.
    """
    spark, own = df.sparkSession, f"{folder.rstrip('/')}/run={run}"
    if version(spark, own) is not None:
        before = current(spark, own)
        df = before.join(df.select(group).distinct(), group, "left_anti").unionByName(df)
    return published(df, own, run, gates)


def logged(spark: SparkSession, folder: str, runs: Sequence[str]) -> DataFrame:
    """The rows of these runs of a log, each as last appended, with ``run``."""
    frames = [current(spark, f"{folder.rstrip('/')}/run={r}").withColumn("run", F.lit(r)) for r in runs]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
