"""Joins, aggregations, windows, samples and sets of the catalogue on the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshed.functions.values import band
from lakeshed.operators import choosing, merging, quantiles
from lakeshed.plans.base import Plans, mean_money, mean_money_sql, money, table

plans = Plans()
c = F.col


@plans.query("""
SELECT c_mktsegment, count(*) AS customers, count(o.n) AS with_orders, round(100.0::DOUBLE * count(o.n) / nullif(count(*), 0), 1) AS pct, coalesce(sum(o.n), 0)::BIGINT AS orders
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON c_custkey = o_custkey GROUP BY 1""")
def coverage_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    rows = table(spark, sf, "customer").join(counts, c("c_custkey") == c("o_custkey"), "left")
    pct = F.round(F.lit(100.0) * F.count("n") / F.nullif(F.count("*"), F.lit(0)), 1)
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("customers"), F.count("n").alias("with_orders"), pct.alias("pct"), F.coalesce(F.sum("n"), F.lit(0)).alias("orders"))


@plans.query(f"""
SELECT l_returnflag, l_linestatus, count(*) AS lines, count(DISTINCT l_suppkey) AS suppliers, count(*) FILTER (l_discount > 0.05) AS discounted,
 round(sum(l_quantity), 2) AS sum_qty, {mean_money_sql("l_extendedprice")} AS avg_price FROM lineitem GROUP BY 1, 2""")
def filtered_summary(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("lines"), F.countDistinct("l_suppkey").alias("suppliers"), F.count_if(c("l_discount") > 0.05).alias("discounted"), money(F.sum("l_quantity")).alias("sum_qty"), mean_money(c("l_extendedprice")).alias("avg_price")
    )


@plans.query("""SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(*) AS lines FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_partkey) > 1""")
def suppliers_of_several_parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"), F.count("*").alias("lines")).filter("parts > 1")


@plans.query("""
SELECT o_orderkey, coalesce(l.lines, '[]') AS lines, coalesce(l.n, 0)::BIGINT AS n FROM orders LEFT JOIN (
 SELECT l_orderkey, '[' || string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) || ']' AS lines, count(*) AS n FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey""")
def nested_lines(spark: SparkSession, sf: str) -> DataFrame:
    nested = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("items"))
    text = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"))), ","), F.lit("]"))
    rows = table(spark, sf, "orders").select("o_orderkey").join(nested, c("o_orderkey") == c("l_orderkey"), "left")
    return rows.select("o_orderkey", F.coalesce(text, F.lit("[]")).alias("lines"), F.coalesce(F.size("items").cast("long"), F.lit(0)).alias("n"))


@plans.query("""SELECT n_regionkey, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS nations FROM nation GROUP BY 1""")
def distinct_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_set("n_name")), ",").alias("nations"))


@plans.query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey, l_linenumber) = 1""")
def top_line_of_order(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.desc("l_quantity"), F.asc("l_partkey"), F.asc("l_linenumber")]
    return choosing.first_rows(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), ["l_orderkey"], order)


@plans.query("""
SELECT p_brand, p_partkey, p_retailprice, place FROM (SELECT p_brand, p_partkey, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey)::INTEGER AS place FROM part) WHERE place <= 3""")
def top_parts_of_brand(spark: SparkSession, sf: str) -> DataFrame:
    rows = choosing.numbered(table(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")], "place")
    return rows.filter("place <= 3")


@plans.query("""
SELECT p_brand, p_type, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY p_brand), 6) AS share, (sum(count(*)) OVER (PARTITION BY p_brand))::BIGINT AS total FROM part GROUP BY 1, 2""")
def share_of_group(spark: SparkSession, sf: str) -> DataFrame:
    counts = choosing.value_counts(table(spark, sf, "part"), ["p_brand"], "p_type").withColumn("total", F.sum("n").over(Window.partitionBy("p_brand")))
    return counts.withColumn("share", F.round(c("n") / c("total"), 6))


@plans.query("""
WITH shared AS (SELECT p_name FROM part WHERE p_name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT p_brand) > 1)
SELECT p_partkey, p_brand, CASE WHEN s.p_name IS NULL THEN p.p_name END AS own_name, s.p_name IS NOT NULL AS downgraded FROM part p LEFT JOIN shared s ON p.p_name = s.p_name""")
def shared_value_downgrade(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    shared = choosing.shared_by_others(part, "p_name", "p_brand").select(c("p_name").alias("shared"))
    rows = part.join(shared, c("p_name") == c("shared"), "left")
    return rows.select("p_partkey", "p_brand", F.when(c("shared").isNull(), c("p_name")).alias("own_name"), c("shared").isNotNull().alias("downgraded"))


_COUNTED = "WITH n AS (SELECT p_brand, p_type, count(*) AS n, (sum(count(*)) OVER (PARTITION BY p_brand))::BIGINT AS total FROM part GROUP BY 1, 2)"


@plans.query(f"{_COUNTED} SELECT p_brand, p_type, n, total FROM n QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) = 1")
def mode_of_group(spark: SparkSession, sf: str) -> DataFrame:
    return choosing.modes(table(spark, sf, "part"), ["p_brand"], "p_type")


@plans.query(f"{_COUNTED} SELECT p_brand, p_type, n, total, n::DOUBLE / total AS share, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type)::INTEGER AS place FROM n WHERE n::DOUBLE / total >= 0.05 QUALIFY place <= 8")
def value_profile(spark: SparkSession, sf: str) -> DataFrame:
    return choosing.profile(table(spark, sf, "part"), ["p_brand"], "p_type", 0.05, 8)


@plans.query(f"{_COUNTED} SELECT p_brand, CASE WHEN max(total) >= 70 THEN coalesce(string_agg(p_type, ',' ORDER BY p_type) FILTER (n::DOUBLE / total >= 0.15), '') END AS allowed FROM n GROUP BY 1")
def learned_value_sets(spark: SparkSession, sf: str) -> DataFrame:
    return choosing.allowed_values(table(spark, sf, "part"), ["p_brand"], "p_type", 70, 0.15).select("p_brand", F.array_join("allowed", ",").alias("allowed"))


@plans.query("""
WITH n AS (SELECT user_id, event_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY user_id) AS total FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2)
SELECT user_id, event_type FROM n WHERE total >= 3 AND n / total >= 0.5 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1""")
def dominant_event(spark: SparkSession, sf: str) -> DataFrame:
    return choosing.dominant(table(spark, sf, "events"), ["user_id"], "event_type", 3, 0.5)


@plans.query(f"""
SELECT l_returnflag, min(l_extendedprice) AS least, max(l_extendedprice) AS most, {mean_money_sql("l_extendedprice")} AS mean, round(median(l_extendedprice), 4) AS median,
 list_sort(list(l_extendedprice))[(count(l_extendedprice) // 2 + 1)] AS upper_median, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1""")
def price_statistics(spark: SparkSession, sf: str) -> DataFrame:
    x, lines = c("l_extendedprice"), table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    plain = lines.groupBy("l_returnflag").agg(F.min(x).alias("least"), F.max(x).alias("most"), mean_money(x).alias("mean"))
    # places between two neighbours, and the upper median, from one count of the values
    at = {"_m": 0.5, "_p": 0.9}
    edges = {f"{k}{e}": (lambda n, s=s, f=f: f((n - 1) * F.lit(s))) for k, s in at.items() for e, f in (("a", F.floor), ("b", F.ceil))}
    found = quantiles.by_rank(lines, ["l_returnflag"], "l_extendedprice", edges | {"upper_median": lambda n: F.floor(n / 2)})
    between = lambda k: F.round(c(f"{k}a") + (c(f"{k}b") - c(f"{k}a")) * ((c("n") - 1) * at[k] - F.floor((c("n") - 1) * at[k])), 4)
    ranks = found.select("l_returnflag", between("_m").alias("median"), "upper_median", between("_p").alias("p90"))
    return quantiles.joined([plain, ranks], ["l_returnflag"])


_BANDS = [(1000.0, "under 1k"), (50000.0, "1k to 50k"), (200000.0, "50k to 200k")]


@plans.query("""
SELECT CASE WHEN o_totalprice < 1000 THEN 'under 1k' WHEN o_totalprice < 50000 THEN '1k to 50k' WHEN o_totalprice < 200000 THEN '50k to 200k' ELSE 'over 200k' END AS band, o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1, 2""")
def price_bands(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").filter(c("o_totalprice").isNotNull()).withColumn("band", band(c("o_totalprice"), _BANDS, "over 200k"))
    return rows.groupBy("band", "o_orderpriority").agg(F.count("*").alias("n"))


@plans.query("""
SELECT o_orderstatus, count(*) FILTER (o_orderpriority LIKE '1%') AS urgent, count(*) FILTER (o_orderpriority LIKE '5%') AS low, count(*) AS every FROM orders GROUP BY 1""")
def status_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    p = c("o_orderpriority")
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count_if(p.startswith("1")).alias("urgent"), F.count_if(p.startswith("5")).alias("low"), F.count("*").alias("every"))


@plans.query(f"""
SELECT r_name, n_name, count(c_custkey) AS customers, {mean_money_sql("c_acctbal")} AS mean, round(median(c_acctbal), 4) AS median, min(c_acctbal) AS least, max(c_acctbal) AS most, count(DISTINCT c_mktsegment) AS segments
FROM region JOIN nation ON r_regionkey = n_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def overview_report(spark: SparkSession, sf: str) -> DataFrame:
    places = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), c("n_regionkey") == c("r_regionkey"))  # 25 and 5 rows at any scale
    rows = places.join(table(spark, sf, "customer"), c("c_nationkey") == c("n_nationkey"), "left")
    b = c("c_acctbal")
    return rows.groupBy("r_name", "n_name").agg(F.count("c_custkey").alias("customers"), mean_money(b).alias("mean"), F.round(F.median(b), 4).alias("median"), F.min(b).alias("least"), F.max(b).alias("most"), F.countDistinct("c_mktsegment").alias("segments"))


@plans.query("""
SELECT r_name, sum(n)::BIGINT AS customers, string_agg(n_name || '=' || n, ';' ORDER BY n DESC, n_name) AS parts FROM (
 SELECT r_name, n_name, count(*) AS n FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2) GROUP BY 1""")
def region_rollup(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    rows = counts.join(table(spark, sf, "nation"), c("c_nationkey") == c("n_nationkey")).join(table(spark, sf, "region"), c("n_regionkey") == c("r_regionkey"))
    parts = F.array_sort(F.collect_list(F.struct((-c("n")).alias("k"), "n_name", "n")))
    return rows.groupBy("r_name").agg(F.sum("n").alias("customers"), F.array_join(F.transform(parts, lambda x: F.concat_ws("=", x["n_name"], x["n"].cast("string"))), ";").alias("parts"))


@plans.query("""
SELECT round(avg((c_name IS NOT NULL)::INT) * 100, 2) AS name_pct, round(avg((c_acctbal > 0)::INT) * 100, 2) AS positive_pct, count(*) AS rows, count(DISTINCT c_nationkey) AS nations FROM customer""")
def completeness(spark: SparkSession, sf: str) -> DataFrame:
    pct = lambda x: F.round(F.avg(x.cast("int")) * 100, 2)
    return table(spark, sf, "customer").agg(pct(c("c_name").isNotNull()).alias("name_pct"), pct(c("c_acctbal") > 0).alias("positive_pct"), F.count("*").alias("rows"), F.countDistinct("c_nationkey").alias("nations"))


@plans.query("""SELECT c_custkey, c_nationkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def customers_without_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(table(spark, sf, "orders"), c("c_custkey") == c("o_custkey"), "left_anti")


@plans.query("""SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS known FROM customer""")
def known_flag(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(c("o_custkey").alias("k")).distinct()
    return table(spark, sf, "customer").join(known, c("c_custkey") == c("k"), "left").select("c_custkey", c("k").isNotNull().alias("known"))


@plans.query("""
SELECT coalesce(a.k, b.k) AS key, CASE WHEN b.k IS NULL THEN 'left' WHEN a.k IS NULL THEN 'right' ELSE 'both' END AS side
FROM (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0) a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders) b ON a.k = b.k""")
def compared_key_sets(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").filter("c_acctbal > 0").select(c("c_custkey").alias("key"))
    return merging.compared_keys(a, table(spark, sf, "orders").select(c("o_custkey").alias("key")), "key")


@plans.query("""
WITH s AS (SELECT l_suppkey AS k, 0 AS p FROM lineitem WHERE l_returnflag = 'R' UNION SELECT s_suppkey, 1 FROM supplier WHERE s_acctbal > 0 UNION SELECT s_suppkey, 2 FROM supplier)
SELECT k, ['returned', 'in credit', 'all'][min(p) + 1] AS source, count(*) AS sources FROM s GROUP BY 1""")
def first_seen_source(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier").select(c("s_suppkey").alias("k"), "s_acctbal")
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(c("l_suppkey").alias("k"))
    return merging.first_sources({"returned": returned, "in credit": supplier.filter("s_acctbal > 0"), "all": supplier}, "k")


@plans.query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders) AND o_orderkey <= (SELECT max(o_orderkey) FROM orders) - 100""")
def threshold_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    limits = orders.agg(F.avg("o_totalprice").alias("_mean"), (F.max("o_orderkey") - 100).alias("_last"))
    return orders.crossJoin(F.broadcast(limits)).filter("o_totalprice > _mean and o_orderkey <= _last").select(orders.columns)  # one row


@plans.query("""
WITH s AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey::VARCHAR), c_custkey) AS place FROM customer),
n AS (SELECT c_mktsegment, greatest(1, count(*) * 100 // sum(count(*)) OVER ()) AS quota FROM customer GROUP BY 1)
SELECT c_custkey, c_mktsegment FROM s JOIN n USING (c_mktsegment) WHERE place <= quota""")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return choosing.stratified(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "c_custkey", 100)


@plans.query("""SELECT c_custkey, ((row_number() OVER (ORDER BY c_custkey) - 1) % 7)::INTEGER AS "group" FROM customer""")
def round_robin_groups(spark: SparkSession, sf: str) -> DataFrame:
    return choosing.dealt_round(table(spark, sf, "customer").select("c_custkey"), [F.asc("c_custkey")], 7, F.floor(c("c_custkey") / 1000))


@plans.query("""SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(o_orderkey::VARCHAR), o_orderkey LIMIT 200""")
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey").orderBy(F.md5(c("o_orderkey").cast("string")), "o_orderkey").limit(200)


@plans.query("""
SELECT l_suppkey, returned, lines, round(returned::DOUBLE / lines, 6) AS rate, round(returned::DOUBLE / lines * qty, 4) AS yield FROM (
 SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) AS lines, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) ORDER BY yield DESC, l_suppkey LIMIT 50""")
def ranked_by_yield(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count_if(c("l_returnflag") == "R").alias("returned"), F.count("*").alias("lines"), F.sum("l_quantity").alias("qty"))
    rate = c("returned") / c("lines")
    return rows.select("l_suppkey", "returned", "lines", F.round(rate, 6).alias("rate"), F.round(rate * c("qty"), 4).alias("yield")).orderBy(F.desc("yield"), "l_suppkey").limit(50)


@plans.query("""
SELECT s_nationkey, n_name, arg_min(s_name, s_suppkey) FILTER (s_acctbal > 0) AS first_in_credit, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2""")
def first_value_of_group(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), c("s_nationkey") == c("n_nationkey"))
    return rows.groupBy("s_nationkey", "n_name").agg(F.min_by("s_name", F.when(c("s_acctbal") > 0, c("s_suppkey"))).alias("first_in_credit"), F.count("*").alias("n"))


@plans.query("""
WITH b AS (SELECT p_name, min(p_brand) AS canonical FROM (SELECT p_name, p_brand, rank() OVER (PARTITION BY p_name ORDER BY count(*) DESC) AS r FROM part WHERE p_name IS NOT NULL GROUP BY 1, 2) WHERE r = 1 GROUP BY 1)
SELECT p_partkey, coalesce(canonical, p_brand) AS p_brand FROM part LEFT JOIN b USING (p_name)""")
def uniform_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return choosing.uniform_values(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), "p_name", "p_brand").select("p_partkey", "p_brand")


@plans.query("""
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY 1)
SELECT month, n, value, coalesce(n - lag(n) OVER (ORDER BY month), 0)::BIGINT AS change FROM m""")
def month_to_month(spark: SparkSession, sf: str) -> DataFrame:
    months = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), money(F.sum("o_totalprice")).alias("value"))
    lagged = F.lag("n").over(Window.partitionBy(F.lit(0)).orderBy("month"))  # a row a month
    return months.withColumn("change", F.coalesce(c("n") - lagged, F.lit(0)))


@plans.query("""SELECT coalesce(n_regionkey, -1) AS region, coalesce(c_mktsegment, 'all') AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, c_mktsegment)""")
def rolled_up(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), c("c_nationkey") == c("n_nationkey"))
    out = rows.rollup("n_regionkey", "c_mktsegment").agg(F.count("*").alias("n"), money(F.sum("c_acctbal")).alias("balance"))
    return out.select(F.coalesce("n_regionkey", F.lit(-1)).alias("region"), F.coalesce("c_mktsegment", F.lit("all")).alias("segment"), "n", "balance")


@plans.query("""SELECT c_custkey, name, row_number() OVER (PARTITION BY name ORDER BY c_custkey)::INTEGER AS place FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment || (c_custkey % 50) END AS name FROM customer) WHERE name <> '' QUALIFY place = 1
UNION ALL SELECT c_custkey, '', 1::INTEGER FROM customer WHERE c_custkey % 5 = 0""")
def conditional_dedup(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(c("c_custkey") % 5 == 0, "").otherwise(F.concat("c_mktsegment", (c("c_custkey") % 50).cast("string")))
    rows = table(spark, sf, "customer").select("c_custkey", name.alias("name"))
    return choosing.first_filled_rows(rows, "name", [F.asc("c_custkey")], "c_custkey").withColumn("place", F.lit(1))

