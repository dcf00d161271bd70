"""Which row, value or share of a group: every choice has an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_filled_rows(df: DataFrame, key: str, order: list[Column], identity: str) -> DataFrame:
    """One row for each non-empty key, all rows where the key is empty or null."""
    own = F.when(F.coalesce(F.col(key), F.lit("")) != "", F.concat(F.lit("k:"), F.col(key))).otherwise(F.concat(F.lit("r:"), F.col(identity).cast("string")))
    return first_rows(df.withColumn("_own", own), ["_own"], order).drop("_own")


def first_values(df: DataFrame, keys: list[str], columns: list[str], order: Column) -> DataFrame:
    """The first non-null value of each column."""
    return df.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys, value).agg(F.count("*").alias("n"))


def modes(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each group's most frequent non-null value, the smallest on a tie, with its count and the group's."""
    counts = value_counts(df.filter(F.col(value).isNotNull()), keys, value)
    top = counts.withColumn("_most", F.max("n").over(Window.partitionBy(*keys))).withColumn("_all", F.sum("n").over(Window.partitionBy(*keys)))
    return top.filter("n = _most").groupBy(*keys).agg(F.min(value).alias(value), F.max("n").alias("n"), F.max("_all").alias("total"))


def profile(df: DataFrame, keys: list[str], value: str, least_share: float, most: int) -> DataFrame:
    """Values with at least this share of their group, the most frequent first, at most ``most`` of them."""
    counts = value_counts(df, keys, value).withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    counts = counts.withColumn("share", F.col("n") / F.col("total")).filter(F.col("share") >= least_share)
    return numbered(counts, keys, [F.desc("n"), F.asc(value)], "place").filter(F.col("place") <= most)


def allowed_values(df: DataFrame, keys: list[str], value: str, least_rows: int, least_share: float) -> DataFrame:
    """The values a group may have: those with the share; null (any) where the group is too small to tell."""
    counts = value_counts(df, keys, value).withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    some = F.sort_array(F.collect_set(F.when(F.col("n") / F.col("total") >= least_share, F.col(value))))
    return counts.groupBy(*keys).agg(F.when(F.max("total") >= least_rows, some).alias("allowed"))


def dominant(df: DataFrame, keys: list[str], value: str, least_rows: int, least_share: float) -> DataFrame:
    """A group's value where it has enough rows and the value enough of them."""
    return modes(df, keys, value).filter((F.col("total") >= least_rows) & (F.col("n") / F.col("total") >= least_share)).select(*keys, value)


def uniform_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rewrites ``value`` to its most frequent one for each ``key``; rows without a key stay."""
    best = modes(df.filter(F.col(key).isNotNull()), [key], value).select(F.col(key).alias("_key"), F.col(value).alias("_best"))
    return df.join(best, F.col(key) == F.col("_key"), "left").withColumn(value, F.coalesce("_best", value)).drop("_key", "_best")


def shared_by_others(df: DataFrame, value: str, name: str) -> DataFrame:
    """Values that more than one distinct name uses."""
    return df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.countDistinct(name).alias("names")).filter("names > 1")


def stratified(df: DataFrame, stratum: str, identity: str, rows: int) -> DataFrame:
    """About ``rows`` rows, by share of strata, at least one of each, in the order of a hash of the id."""
    counts = df.groupBy(stratum).agg(F.count("*").alias("_n"))
    quota = counts.withColumn("_quota", F.greatest(F.lit(1), F.floor(F.col("_n") * rows / F.sum("_n").over(Window.partitionBy(F.lit(0)))))).drop("_n")
    order = [F.md5(F.col(identity).cast("string")), F.col(identity)]
    out = numbered(df, [stratum], order, "_place").join(quota, stratum)
    return out.filter(F.col("_place") <= F.col("_quota")).drop("_place", "_quota")


def dealt_round(df: DataFrame, order: list[Column], groups: int, bucket: Column) -> DataFrame:
    """Rows in turn to ``groups`` groups.  ``bucket`` follows the order; only its counts are summed in one place."""
    within = Window.partitionBy("_bucket").orderBy(*order)
    rows = df.withColumn("_bucket", bucket)
    before = rows.groupBy("_bucket").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    placed = rows.withColumn("_place", F.row_number().over(within)).join(before, "_bucket")
    return placed.withColumn("group", ((F.col("_before") + F.col("_place") - 1) % groups).cast("int")).drop("_bucket", "_place", "_before")


def compositions(df: DataFrame, entity: str, label: str, term: str, labels: int = 4, terms: int = 5) -> DataFrame:
    """(entity, shares, terms): the shares of an entity's most frequent labels, as a map, and its most frequent terms, in order; nulls don't count."""

    def top(value: str, n: int) -> DataFrame:
        counts = value_counts(df.filter(F.col(value).isNotNull()), [entity], value)
        total = counts.groupBy(entity).agg(F.sum("n").alias("_all"))
        best = first_rows(counts, [entity], [F.desc("n"), F.asc(value)], n).join(total, entity)
        rows = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"), (F.col("n") / F.col("_all")).alias("share"))))
        return best.groupBy(entity).agg(rows.alias("_x"))

    shares = top(label, labels).select(entity, F.map_from_entries(F.transform("_x", lambda x: F.struct(x["v"], x["share"]))).alias("shares"))
    return shares.join(top(term, terms).select(entity, F.col("_x.v").alias("terms")), entity, "full_outer")


def majority(df: DataFrame, keys: list[str], value: str, complete: Column, rank: Column) -> DataFrame:
    """Each group's value by whether a row of it is complete, then its best rank, then its rows; the smallest on a tie.

    Columns: the keys, value, n (its rows), others (rows of the group that say something else).
    """
    rows = df.filter(F.col(value).isNotNull()).withColumns({"_c": complete.cast("int"), "_r": rank})
    said = rows.groupBy(*keys, value).agg(F.max(F.struct("_c", "_r")).alias("_best"), F.count("*").alias("n"))
    total = said.groupBy(*keys).agg(F.sum("n").alias("_all"))
    return first_rows(said, keys, [F.desc("_best"), F.desc("n"), F.asc(value)]).join(total, keys).select(*keys, value, "n", (F.col("_all") - F.col("n")).alias("others"))


def split_by_match(df: DataFrame, side: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their match in ``side`` (unique by the keys), and those without one."""
    return df.join(side, keys), df.join(side.select(*keys), keys, "left_anti")


def first_wins(df: DataFrame, side: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds the columns of the first row of ``side`` with the same keys; null where there is none."""
    return df.join(first_rows(side, keys, order), keys, "left")
