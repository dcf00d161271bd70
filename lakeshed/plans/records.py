"""Raw place records on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.operators import records
from lakeshed.plans.base import Plans, table

plans = Plans()
c = F.col


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as raw captures, with what captures lack."""
    k, part = c("p_partkey"), table(spark, sf, "part")
    none = lambda t: F.lit(None).cast(t)
    return part.select(
        k.cast("string").alias("placeId"), F.when(k % 19 == 0, "  ").when(k % 23 != 0, F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("title"), F.when(k % 7 != 0, c("p_type")).alias("categoryName"),
        F.when(k % 3 == 0, F.array("p_type", "p_brand")).alias("categories"), c("p_brand").alias("address"), none("string").alias("street"), none("string").alias("neighborhood"), F.when(k % 2 == 0, " Dubai ").alias("city"),
        none("string").alias("phone"), none("string").alias("website"), F.struct(F.when(k % 5 != 0, 24.0 + k % 10).alias("lat"), F.when(k % 5 != 0, 54.0 + k % 6).alias("lng")).alias("location"),
        F.concat(F.lit("https://maps.example/?x=1&cid="), k.cast("string")).alias("url"), none("string").alias("plusCode"), (c("p_size") / 10).alias("totalScore"), F.when(k % 4 != 0, c("p_size")).alias("reviewsCount"),
        F.when(k % 4 != 0, F.struct(*[(c("p_size") + i).alias(f"{n}Star") for i, n in enumerate(("one", "two", "three", "four", "five"))])).alias("reviewsDistribution"), none("string").alias("price"),
        none("array<string>").alias("openingHours"), none("string").alias("menu"), (k % 29 == 0).alias("permanentlyClosed"), F.when(k % 31 == 0, True).alias("temporarilyClosed"), none("string").alias("scrapedAt"),
    )


def _kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Types of parts that stand for other businesses: the first one by name."""
    return table(spark, sf, "part").agg(F.min("p_type").alias("category"))


_REASON = "CASE WHEN p_partkey % 29 = 0 OR p_partkey % 31 = 0 THEN 'closed' WHEN p_partkey % 19 = 0 OR p_partkey % 23 = 0 THEN 'no name' WHEN p_partkey % 7 <> 0 AND p_type = (SELECT min(p_type) FROM part) THEN 'other kind' END"


@plans.query(f"SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM (SELECT {_REASON} AS reason FROM part) GROUP BY 1")
def dropped_records(spark: SparkSession, sf: str) -> DataFrame:
    return records.reasons(records.drop_reason(_raw(spark, sf), _kinds(spark, sf)))


@plans.query(f"""
WITH t AS (SELECT p_type, min(p_brand) AS type FROM part GROUP BY 1 HAVING count(*) % 2 = 0), p AS (SELECT * FROM part WHERE {_REASON} IS NULL)
SELECT p_partkey::VARCHAR AS place_id, p_name AS "Name", CASE WHEN p_partkey % 2 = 0 THEN 'Dubai' ELSE '' END AS "City", CASE WHEN p_partkey % 5 <> 0 THEN 24.0::DOUBLE + p_partkey % 10 END AS "Geo_Lat", 'https://maps.example/?cid=' || p_partkey AS "Google_Maps_URL", CASE WHEN p_partkey % 7 <> 0 THEN p_type ELSE '' END AS "Category",
 CASE WHEN p_partkey % 3 = 0 THEN p_type || '|' || p_brand WHEN p_partkey % 7 <> 0 THEN p_type ELSE '' END AS kinds, coalesce(CASE WHEN p_partkey % 7 <> 0 THEN type END, 'Other') AS "Category_Type", CASE WHEN p_partkey % 4 <> 0 THEN p_size ELSE 0 END::BIGINT AS "Review_Count", CASE WHEN p_partkey % 4 <> 0 THEN p_size + 4 ELSE 0 END::BIGINT AS five
FROM p LEFT JOIN t USING (p_type)""")
def normalised_records(spark: SparkSession, sf: str) -> DataFrame:
    kept = records.drop_reason(_raw(spark, sf), _kinds(spark, sf)).filter("reason is null")
    types = table(spark, sf, "part").groupBy(c("p_type").alias("category")).agg(F.min("p_brand").alias("type"), F.count("*").alias("n")).filter("n % 2 = 0")
    out = records.place_records(kept, types)
    return out.select("place_id", "Name", "City", "Geo_Lat", "Google_Maps_URL", "Category", F.array_join("All_Categories", "|").alias("kinds"), "Category_Type", "Review_Count", c("Rating_Distribution.5_star").alias("five"))


@plans.query("""
SELECT p_partkey, (contains(lower(p_name), 'red') OR contains(lower(p_name), 'small')) AND NOT contains(lower(p_name), 'ring') AS brand, regexp_matches(lower(p_type || ' ' || p_brand), 'promo|#7$') AS other, p_type IN ('SMALL', 'MEDIUM') OR contains(p_name, 'hot') AS cuisine,
 coalesce(CASE WHEN p_partkey % 5 <> 0 THEN 24.0 + p_partkey % 10 BETWEEN 25 AND 30 AND 54.0 + p_partkey % 6 BETWEEN 55 AND 58 END, true) AND NOT contains(p_brand, '#2') AS country FROM part""")
def record_rules(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf)
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type").join(raw.select(c("placeId").cast("long").alias("p_partkey"), "location"), "p_partkey")
    return part.select(
        "p_partkey", records.carries_brand(c("p_name"), ["Red", "small"], ["RING"]).alias("brand"), records.other_business(F.array("p_type", "p_brand"), "promo|#7$").alias("other"),
        records.wanted_cuisine(F.concat(F.lit("none , "), "p_type"), c("p_name"), ["Small", "Medium"], "hot").alias("cuisine"), records.in_country(c("location.lat"), c("location.lng"), c("p_brand"), (25.0, 30.0, 55.0, 58.0), "#2").alias("country"),
    )


@plans.query("""
SELECT c_custkey, o_orderkey, CASE WHEN o_orderkey IS NULL THEN 'not_found' ELSE 'matched' END AS found FROM customer LEFT JOIN (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F') ON c_custkey = o_custkey""")
def all_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer with all finished orders, and once without where there are none."""
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(c("o_custkey").alias("c_custkey"), "o_orderkey")
    return records.fanned_out(table(spark, sf, "customer").select("c_custkey"), done, "c_custkey", ["o_orderkey"])


@plans.query("""
WITH a AS (SELECT s_suppkey, s_name AS said, CASE WHEN s_suppkey % 3 = 0 THEN 'confirmed' ELSE 'open' END AS status FROM supplier WHERE s_suppkey % 4 <> 0), b AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey % 5 <> 0)
SELECT s_suppkey, CASE WHEN status = 'confirmed' THEN said ELSE coalesce(c_name, said) END AS said, CASE WHEN status = 'confirmed' THEN 'first' WHEN c_name IS NOT NULL THEN 'second' WHEN said IS NOT NULL THEN 'first, unconfirmed' ELSE 'none' END AS source
FROM (SELECT s_suppkey FROM supplier) LEFT JOIN a USING (s_suppkey) LEFT JOIN b ON s_suppkey = c_custkey""")
def reconciled_names(spark: SparkSession, sf: str) -> DataFrame:
    supplier, customer = table(spark, sf, "supplier"), table(spark, sf, "customer")
    first = supplier.filter("s_suppkey % 4 <> 0").select("s_suppkey", c("s_name").alias("said"), F.when(c("s_suppkey") % 3 == 0, "confirmed").otherwise("open").alias("status"))
    second = customer.filter("c_custkey % 5 <> 0").select(c("c_custkey").alias("s_suppkey"), c("c_name").alias("said"))
    return records.reconciled(supplier.select("s_suppkey"), first, second, "s_suppkey", "said").select("s_suppkey", "said", "source")
