"""Sources and sinks: lines of JSON, whole JSON documents, CSV, Parquet, file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Lines of JSON; blank lines are skipped, others that don't parse keep their text in ``_corrupt_record``."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return spark.read.schema(f"{ddl}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)


def json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Files that hold one JSON value or array each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def csv_text(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with every column as text; ``columns`` names those of files without a header.  A byte-order mark is dropped."""
    reader = spark.read.option("header", columns is None).option("multiLine", True).option("escape", '"')
    df = reader.csv(path) if columns is None else reader.schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def latest_file(spark: SparkSession, folder: str, pattern: str, read: str = "parquet") -> DataFrame:
    """The rows of the file whose name comes last."""
    df = spark.read.format(read).option("pathGlobFilter", pattern).load(folder).withColumn("_file", F.col("_metadata.file_name"))
    last = df.agg(F.max("_file")).first()[0]
    return df.filter(F.col("_file") == last).drop("_file")


def united_files(spark: SparkSession, folder: str, pattern: str, without: str, read: str = "json") -> DataFrame:
    """All files of a pattern but those whose name holds ``without``."""
    df = spark.read.format(read).option("pathGlobFilter", pattern).load(folder).withColumn("_file", F.col("_metadata.file_name"))
    return df.filter(~F.col("_file").contains(without))


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """path, bytes, modified of all files; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def first_list(payload: Column, keys: list[str], element: str) -> Column:
    """The first list under one of the keys, or the payload itself if it is one."""
    options = [F.from_json(F.get_json_object(payload, f"$.{k}"), f"array<{element}>") for k in keys]
    return F.coalesce(*options, F.when(F.startswith(F.trim(payload), F.lit("[")), F.from_json(payload, f"array<{element}>")))


def with_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Exactly these columns and types: missing ones null, others dropped, values that don't fit null."""
    return df.select(*[(F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in wanted.items()])


def flat_for_csv(df: DataFrame, most: int = 32_767) -> DataFrame:
    """Nested columns as JSON, control characters out, at most so many characters a cell as sheets allow."""
    out = []
    for f in df.schema:
        nested = f.dataType.typeName() in ("array", "struct", "map")
        c = F.to_json(F.col(f"`{f.name}`")) if nested else F.col(f"`{f.name}`")
        if nested or f.dataType.typeName() == "string":
            c = F.substring(F.regexp_replace(c, r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}]", ""), 1, most)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    flat_for_csv(df).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet by partition columns; only the partitions that the rows hold are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def with_na(df: DataFrame, columns: list[str], word: str = "NA") -> DataFrame:
    """Nulls as a word, for files that leave the engine."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(word)) for c in columns})
