"""Tables of a database by JDBC: ranges, batches of keys, resumed copies, staged writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that are sent to the database in predicates; with more, ranges are read and joined.
SENT_KEYS, KEYS_A_QUERY = 50_000, 500


def bounds(spark: SparkSession, url: str, name: str, key: str, properties: dict[str, str], after: int | None = None) -> tuple[int, int] | None:
    """The smallest and largest key (beyond ``after``), by one query; null if there is none."""
    beyond = f" where {key} > {int(after)}" if after is not None else ""
    low, high = spark.read.jdbc(url, f"(select min({key}) as low, max({key}) as high from {name}{beyond}) t", properties=properties).first()
    return None if low is None else (int(low), int(high))


def by_ranges(spark: SparkSession, url: str, name: str, key: str, properties: dict[str, str], parts: int = 16, after: int | None = None, where: str = "") -> DataFrame:
    """A table's rows with a key (beyond ``after``), read in ``parts`` ranges of it; ``where`` is a condition for the database."""
    conditions = [*([f"{key} > {int(after)}"] if after is not None else [f"{key} is not null"]), *([f"({where})"] if where else [])]
    source = f"(select * from {name} where {' and '.join(conditions)}) t"
    edges = bounds(spark, url, name, key, properties, after)
    if edges is None:
        return spark.read.jdbc(url, source, properties=properties)
    return spark.read.jdbc(url, source, column=key, lowerBound=edges[0], upperBound=edges[1] + 1, numPartitions=parts, properties=properties)


def of_keys(spark: SparkSession, url: str, name: str, key: str, keys: DataFrame, properties: dict[str, str], parts: int = 16) -> DataFrame:
    """A table's rows whose key is in ``keys`` (of one whole-number column).

    Up to ``SENT_KEYS``, counted first, go to the database in batches, a task each;
    beyond, the ranges between the least and the largest are read and joined.
    """
    column = keys.columns[0]
    wanted = keys.filter(F.col(column).isNotNull()).select(F.col(column).cast("long").alias("_k")).distinct()
    few = [r[0] for r in wanted.limit(SENT_KEYS + 1).collect()]
    if len(few) <= SENT_KEYS:
        few.sort()
        batches = [few[k : k + KEYS_A_QUERY] for k in range(0, len(few), KEYS_A_QUERY)] or [[]]
        predicates = [f"{key} in ({', '.join(map(str, b))})" if b else "1 = 0" for b in batches]
        return spark.read.jdbc(url, name, predicates=predicates, properties=properties)
    low, high = wanted.agg(F.min("_k"), F.max("_k")).first()
    rows = by_ranges(spark, url, name, key, properties, parts, where=f"{key} between {low} and {high}")
    field = next(c for c in rows.columns if c.lower() == key.lower())
    return rows.join(wanted, rows[field] == wanted["_k"], "left_semi")


def resumed(spark: SparkSession, url: str, name: str, key: str, path: str, properties: dict[str, str], parts: int = 16) -> int:
    """Adds to the Parquet folder the rows beyond the largest key that it has; how many there were.

    A copy that broke off left no rows (Spark commits a write as a whole), so that the next one reads them again.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    after = spark.read.parquet(path).agg(F.max(key)).first()[0] if there else None
    edges = bounds(spark, url, name, key, properties, after)
    if edges is None:
        return 0
    # Keys up to those seen now: rows that come meanwhile are for the next copy.
    rows = by_ranges(spark, url, name, key, properties, parts, after, f"{key} <= {edges[1]}")
    rows.select(*[F.col(c).alias(c.lower()) for c in rows.columns]).write.mode("append").parquet(path)
    done = spark.read.parquet(path)
    return done.count() if after is None else done.filter(F.col(key) > after).count()


def staged(df: DataFrame, url: str, staging: str, properties: dict[str, str], parts: int = 8, batch: int = 20_000) -> None:
    """Writes rows to a staging table, emptied first, in ``parts`` connections and batches of so many rows; the target is the database's to change."""
    df.repartition(parts).write.option("truncate", True).option("batchsize", batch).jdbc(url, staging, mode="overwrite", properties=properties)
