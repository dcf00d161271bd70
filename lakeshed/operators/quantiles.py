"""Exact quantiles by counts of values: no group's values come together."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshed.operators.storing import stored

#: Ranges that the values between two bounds are counted in, a round.
RANGES = 1024


def by_rank(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """keys, n, and for each of ``ranks`` the value that has this place, from 0, among the group's sorted values.

    A rank is an expression of the group's count n of values that aren't null.
    Values are counted first.  Then each rank's bounds close in: the counts between
    them are summed by range, the range that the rank falls in gives the next bounds,
    by the values there are in it, until they meet.  Groups with no value are left out.
    """
    counts = stored(df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n")), "value-counts")
    groups = counts.groupBy(*keys).agg(F.sum("_n").alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("n")).cast("long").alias("rank")) for name, rank in ranks.items()]))
    state = stored(groups.withColumn("_r", wanted).select(*keys, "n", "_r.*", "_low", "_high", F.lit(0).cast("long").alias("_before")), "ranks")
    while not (rest := state.filter("_low < _high")).isEmpty():
        there = counts.join(rest, keys) if keys else counts.crossJoin(rest)  # a row for each rank
        there = there.filter((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))
        low, high = F.col("_low").cast("double"), F.col("_high").cast("double")
        share = (F.col("_v").cast("double") - low) / F.nullif(high - low, F.lit(0.0))
        span = F.when(F.col("_v") == F.col("_high"), RANGES).otherwise(F.least(F.floor(F.coalesce(share, F.lit(0.0)) * RANGES), F.lit(RANGES - 1)))
        own = [*keys, "name"]
        sums = there.groupBy(*own, "n", "rank", "_before", span.alias("_span")).agg(F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        earlier = F.coalesce(F.sum("_n").over(Window.partitionBy(*own).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("_before")
        picked = sums.withColumn("_before", earlier).filter((F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("_n")))
        state = stored(state.filter("_low = _high").unionByName(picked.select(*state.columns)), "ranks")
    columns = [F.max(F.when(F.col("name") == name, F.col("_low"))).alias(name) for name in ranks]
    return state.groupBy(*keys).agg(F.max("n").alias("n"), *columns)


def quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """keys, n, and a column for each share from 0 to 1: the value at that share of the way, between two neighbours in proportion."""
    at = lambda n, share: (n - 1) * share
    ranks = {f"_{edge}_{k}": (lambda n, s=s, f=f: f(at(n, F.lit(float(s))))) for k, s in enumerate(shares.values()) for edge, f in (("a", F.floor), ("b", F.ceil))}
    out = by_rank(df, keys, value, ranks)
    part = lambda k, s: at(F.col("n"), F.lit(float(s))) - F.floor(at(F.col("n"), F.lit(float(s))))
    columns = [(F.col(f"_a_{k}") + (F.col(f"_b_{k}") - F.col(f"_a_{k}")) * part(k, s)).alias(name) for k, (name, s) in enumerate(shares.items())]
    return out.select(*keys, "n", *columns)


def upper_medians(df: DataFrame, keys: list[str], value: str, name: str = "upper_median") -> DataFrame:
    """keys, n and the element at n // 2 of the sorted values."""
    return by_rank(df, keys, value, {name: lambda n: F.floor(n / 2)})


def joined(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Facts of the same groups side by side; null keys are a group."""
    def pair(a: DataFrame, b: DataFrame) -> DataFrame:
        other = b.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        return a.join(other, same, "left").drop(*[f"_k_{k}" for k in keys])

    return reduce(pair, frames)
