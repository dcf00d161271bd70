"""Registering queries with their SQL, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Plans:
    """Queries of a module, by the function's name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Adds lat and lon, made from the key as SQL makes them too: a city of about 40 by 40 km."""
    k = F.col(key)
    lat = F.lit(25.0) + (k * (7919 + seed) % 4001) / 10000.0
    lon = F.lit(55.0) + (k * (6101 + seed) % 3989) / 10000.0
    return df.withColumns({"lat": lat, "lon": lon})


def places_sql(key: str, seed: int) -> str:
    return f"(25.0::DOUBLE + ({key} * {7919 + seed} % 4001)::DOUBLE / 10000.0::DOUBLE) AS lat, (55.0::DOUBLE + ({key} * {6101 + seed} % 3989)::DOUBLE / 10000.0::DOUBLE) AS lon"


METRES_SQL = "2 * 6371000.0::DOUBLE * asin(sqrt(least(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2), 1.0)))"


def money(x: Column) -> Column:
    """Two digits, so that the order of a sum doesn't show."""
    return F.round(x, 2)


def mean_money(x: Column) -> Column:
    """The mean of amounts with two digits, from an exact sum of hundredths, so that no half depends on the order."""
    return F.round(F.sum(F.round(x * 100).cast("long")) / F.nullif(F.count(x), F.lit(0))) / 100


def mean_money_sql(x: str) -> str:
    return f"(round(sum(round({x} * 100)::BIGINT)::DOUBLE / nullif(count({x}), 0)) / 100)"
