"""Majorities, compositions, patches, rules and answers on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.operators import choosing, gates, merging, tiers
from lakeshed.plans.base import Plans, table

plans = Plans()
c = F.col


@plans.query("""
WITH n AS (SELECT p_brand, p_type AS v, count(*) AS n FROM part GROUP BY 1, 2), t AS (SELECT p_brand, sum(n) AS total FROM n GROUP BY 1), k AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, v) <= 4),
w AS (SELECT p_brand, string_split(p_name, ' ')[1] AS v, count(*) AS n FROM part GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, string_split(p_name, ' ')[1]) <= 5)
SELECT p_brand, (SELECT string_agg(v || '=' || round(n / total * 1000)::BIGINT, ',' ORDER BY n DESC, v) FROM k JOIN t USING (p_brand) WHERE k.p_brand = b.p_brand) AS shares, (SELECT string_agg(v, ',' ORDER BY n DESC, v) FROM w WHERE w.p_brand = b.p_brand) AS terms FROM (SELECT DISTINCT p_brand FROM part) b""")
def compositions(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select("p_brand", "p_type", F.element_at(F.split("p_name", " "), 1).alias("word"))
    out = choosing.compositions(rows, "p_brand", "p_type", "word")
    said = F.transform(F.map_entries("shares"), lambda x: F.concat(x["key"], F.lit("="), F.round(x["value"] * 1000).cast("long").cast("string")))
    return out.select("p_brand", F.array_join(said, ",").alias("shares"), F.array_join("terms", ",").alias("terms"))


@plans.query("""
WITH g AS (SELECT o_custkey, o_orderpriority AS v, max((o_orderstatus = 'F')::INT * 1000 + o_orderkey % 3) AS best, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, v AS o_orderpriority, n, (sum(n) OVER (PARTITION BY o_custkey) - n)::BIGINT AS others FROM g QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY best DESC, n DESC, v) = 1""")
def majority_priority(spark: SparkSession, sf: str) -> DataFrame:
    return choosing.majority(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", c("o_orderstatus") == "F", c("o_orderkey") % 3)


_PATCHED = """b AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment FROM customer), p AS (SELECT c_custkey, min(segment) AS segment FROM (SELECT s_suppkey AS c_custkey, 'S' || s_nationkey % 4 AS segment FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT -s_suppkey, 'none' FROM supplier WHERE s_suppkey % 9 = 0) GROUP BY 1),
q AS (SELECT c_custkey, c_mktsegment AS segment FROM customer WHERE c_custkey % 4 = 0),
m AS (SELECT c_custkey, b.segment AS was, p.segment AS p, coalesce(b.segment, p.segment) AS mid, q.segment AS q FROM b LEFT JOIN p USING (c_custkey) LEFT JOIN q USING (c_custkey))"""


def _patched(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    base = customer.select("c_custkey", F.when(c("c_custkey") % 3 != 0, c("c_mktsegment")).alias("segment"))
    filled = supplier.filter("s_suppkey % 2 = 0").select(c("s_suppkey").alias("c_custkey"), F.concat(F.lit("S"), (c("s_nationkey") % 4).cast("string")).alias("segment"))
    filled = filled.unionByName(supplier.filter("s_suppkey % 9 = 0").select((-c("s_suppkey")).alias("c_custkey"), F.lit("none").alias("segment")))
    mended = customer.filter("c_custkey % 4 = 0").select("c_custkey", c("c_mktsegment").alias("segment"))
    return merging.patched_in_turn(base, [("filled", filled, "segment", True), ("mended", mended, "segment", False)], ["c_custkey"])


@plans.query(f"WITH {_PATCHED} SELECT c_custkey, coalesce(q, mid) AS segment FROM m")
def patched_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _patched(spark, sf)[0]


@plans.query(f"""
WITH {_PATCHED} SELECT 'filled' AS patch, count(*) FILTER (p IS NOT NULL AND was IS NULL) AS applied, count(*) FILTER (p IS NOT NULL AND was IS NOT NULL) AS same, (SELECT count(DISTINCT c_custkey) FROM p WHERE c_custkey NOT IN (SELECT c_custkey FROM b)) AS unknown FROM m
UNION ALL SELECT 'mended', count(*) FILTER (q IS NOT NULL AND mid IS DISTINCT FROM q), count(*) FILTER (q IS NOT NULL AND mid = q), 0 FROM m""")
def patch_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _patched(spark, sf)[1]


@plans.query("""
WITH r(k, word, label, needs, without) AS (SELECT row_number() OVER (ORDER BY n_name), word, 'label ' || n_name, CASE WHEN n % 3 = 0 THEN 'small|large' END, CASE WHEN n % 4 = 0 THEN 'ring' END FROM (SELECT n_name, n_nationkey AS n, ['hot', 'red', 'blue', 'green', 'promo', 'bolt'][n_nationkey % 6 + 1] AS word FROM nation)),
x AS (SELECT p_partkey, p_name, p_type, p_brand, lower(p_name || chr(10) || p_type) AS whole FROM part),
m AS (SELECT p_partkey, f, k, label, CASE f WHEN 0 THEN 'p_name' ELSE 'p_type' END AS field FROM (SELECT *, 0 AS f, lower(p_name) AS said FROM x UNION ALL SELECT *, 1, lower(p_type) FROM x) JOIN r ON regexp_matches(said, '\\b' || word || '\\b') AND (needs IS NULL OR regexp_matches(whole, needs)) AND (without IS NULL OR NOT regexp_matches(whole, without)) WHERE p_brand NOT LIKE '%#1'),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY f, k) = 1)
SELECT p_partkey, label, field FROM x LEFT JOIN b USING (p_partkey)""")
def re_examined_labels(spark: SparkSession, sf: str) -> DataFrame:
    nation, n = table(spark, sf, "nation"), c("n_nationkey")
    words = F.array(*map(F.lit, ("hot", "red", "blue", "green", "promo", "bolt")))
    rules = nation.select(c("n_name").alias("order"), F.element_at(words, (n % 6 + 1).cast("int")).alias("word"), F.concat(F.lit("label "), "n_name").alias("label"), F.when(n % 3 == 0, "small|large").alias("needs"), F.when(n % 4 == 0, "ring").alias("without"))
    part = table(spark, sf, "part").withColumn("category", F.when(F.endswith("p_brand", F.lit("#1")), "Skipped").otherwise(c("p_brand")))
    return tiers.re_examined(part, "p_partkey", ["p_name", "p_type"], "category", ["skipped"], rules)


@plans.query("""
WITH x AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN ' ' || lower(p_type) END AS e, CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 7 <> 1 THEN p_type END AS said, CASE WHEN p_partkey % 10 = 0 THEN p_brand END AS o FROM part), v AS (SELECT * FROM (VALUES ('SMALL'), ('LARGE'), ('ECONOMY'), ('PROMO')) v(t))
SELECT p_partkey, coalesce(o, e.t, a.t, 'Other') AS value, CASE WHEN o IS NOT NULL THEN 'override' WHEN e.t IS NOT NULL THEN 'evidence' WHEN a.t IS NOT NULL THEN 'answer' WHEN said IS NOT NULL THEN 'not allowed' ELSE 'none' END AS source FROM x LEFT JOIN v e ON lower(trim(x.e)) = lower(e.t) LEFT JOIN v a ON lower(trim(x.said)) = lower(a.t)""")
def settled_answers(spark: SparkSession, sf: str) -> DataFrame:
    part, size = table(spark, sf, "part"), c("p_size")
    rows = part.select("p_partkey", F.when(size % 5 == 0, F.concat(F.lit(" "), F.lower("p_type"))).alias("evidence"), F.when(size % 3 == 0, c("p_name")).when(size % 7 != 1, c("p_type")).alias("answer"))
    overrides = part.filter("p_partkey % 10 = 0").select("p_partkey", c("p_brand").alias("value"))
    return tiers.settled_answers(rows, "p_partkey", "evidence", "answer", ["SMALL", "LARGE", "ECONOMY", "PROMO"], overrides, "Other")


@plans.query("""
WITH x AS (SELECT o_orderkey AS k FROM orders)
SELECT * FROM (SELECT 'unparseable' AS problem, '' AS field, count(*) FILTER (k % 50 = 1) AS n FROM x UNION ALL SELECT 'missing', 'name', count(*) FILTER (k % 50 <> 1 AND k % 7 = 0) FROM x UNION ALL SELECT 'null', 'price', count(*) FILTER (k % 50 <> 1 AND k % 11 = 0) FROM x
UNION ALL SELECT 'type', 'price', count(*) FILTER (k % 50 <> 1 AND k % 11 <> 0 AND k % 13 = 0) FROM x UNION ALL SELECT 'empty menu', 'menu', count(*) FILTER (k % 50 <> 1 AND k % 3 = 0) FROM x UNION ALL SELECT 'extra', 'more', count(*) FILTER (k % 50 <> 1 AND k % 17 = 0) FROM x
UNION ALL SELECT 'repeated key', 'id', count(*) FROM (SELECT k // 40 FROM x WHERE k % 50 <> 1 GROUP BY 1 HAVING count(*) > 1)) WHERE n > 0""")
def problem_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as lines of JSON with what goes wrong in captures."""
    k = c("o_orderkey")
    price = F.when(k % 11 == 0, "null").when(k % 13 == 0, '"12"').otherwise("12.5")
    body = F.concat(F.lit('{"id": "'), F.floor(k / 40).cast("string"), F.lit('", '), F.when(k % 7 != 0, '"name": "x", ').otherwise(""), F.lit('"price": '), price, F.when(k % 17 == 0, ', "more": 1').otherwise(""), F.lit(', "menu": '), F.when(k % 3 == 0, "[]").otherwise('[{"a": 1}]'), F.lit("}"))
    lines = table(spark, sf, "orders").select(F.when(k % 50 == 1, '{"id": 4').otherwise(body).alias("line"))
    return gates.line_problems(lines, "line", {"id": "string", "name": "string", "price": "number", "menu": "array"}, "id", "menu")


@plans.query("""SELECT o_orderkey, c_custkey, first FROM orders JOIN customer ON o_custkey = c_custkey AND o_orderpriority[1] = (c_custkey % 5 + 1)::VARCHAR LEFT JOIN (SELECT l_orderkey, l_partkey AS first FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) = 1) ON l_orderkey = o_orderkey""")
def matched_by_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that agree with a customer in two keys, with their first line's part: of lines of one number the first in the file."""
    orders = table(spark, sf, "orders").select("o_orderkey", c("o_custkey").alias("c_custkey"), F.substring("o_orderpriority", 1, 1).alias("digit"))
    side = table(spark, sf, "customer").select("c_custkey", (c("c_custkey") % 5 + 1).cast("string").alias("digit"))
    lines = table(spark, sf, "lineitem").select(c("l_orderkey").alias("o_orderkey"), c("l_partkey").alias("first"), "l_linenumber", c("_metadata.file_path").alias("_file"), c("_metadata.row_index").alias("_row"))
    matched, _ = choosing.split_by_match(orders, side, ["c_custkey", "digit"])
    return choosing.first_wins(matched, lines, ["o_orderkey"], [F.asc("l_linenumber"), F.asc("_file"), F.asc("_row")]).select("o_orderkey", "c_custkey", "first")
