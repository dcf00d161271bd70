"""Snapshots, upserts, gates and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.operators import gates, merging
from lakeshed.operators.storing import new_folder
from lakeshed.plans.base import Plans, mean_money, mean_money_sql, money, table
from lakeshed.streaming import retries, streams

plans = Plans()
c = F.col

_KEYS = ["l_orderkey", "l_linenumber"]
_FROM = "FROM lineitem"
_A = f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 83 <> 0 THEN l_extendedprice END AS price, CASE WHEN l_partkey % 41 <> 0 THEN l_returnflag END AS flag {_FROM} WHERE l_orderkey % 13 <> 0"
_B = f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN l_extendedprice * 1.05 WHEN l_partkey % 97 = 0 THEN l_extendedprice * 9 ELSE l_extendedprice END AS price,
 CASE WHEN l_partkey % 41 = 0 THEN '' WHEN l_partkey % 31 = 0 THEN 'X' WHEN l_partkey % 29 = 0 THEN l_returnflag || ' ☕' WHEN l_partkey % 23 = 0 THEN '  ' || l_returnflag ELSE l_returnflag END AS flag {_FROM} WHERE l_orderkey % 11 <> 0"""
_LAST = "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, price DESC NULLS LAST) = 1"


def _months(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two captures of the lines: prices change, come and go, flags change in earnest or in looks alone, orders come and go."""
    rows = table(spark, sf, "lineitem").select(*_KEYS, "l_partkey", c("l_extendedprice").alias("price"), c("l_returnflag").alias("flag"))
    k, flag = c("l_partkey"), c("flag")
    price = F.when(k % 89 == 0, None).when(k % 7 == 0, c("price") * 1.05).when(k % 97 == 0, c("price") * 9).otherwise(c("price"))
    said = F.when(k % 41 == 0, "").when(k % 31 == 0, "X").when(k % 29 == 0, F.concat(flag, F.lit(" ☕"))).when(k % 23 == 0, F.concat(F.lit("  "), flag)).otherwise(flag)
    before = rows.withColumns({"price": F.when(k % 83 != 0, c("price")), "flag": F.when(k % 41 != 0, flag)})
    after = rows.withColumns({"price": price, "flag": said})
    seq = F.struct("l_partkey", "price")
    return before.filter("l_orderkey % 13 <> 0").withColumn("seq", seq), after.filter("l_orderkey % 11 <> 0").withColumn("seq", seq)


_SEEN = r"trim(regexp_replace(regexp_replace(coalesce({x}, ''), '[\x{{1F000}}-\x{{1FAFF}}\x{{2600}}-\x{{27BF}}]', '', 'g'), '\s+', ' ', 'g'))"
_CHANGES = f"""
WITH a AS ({_A} {_LAST}), b AS ({_B} {_LAST}),
j AS (SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber, a.price AS p, b.price AS q, a.flag AS f, b.flag AS g, a.l_orderkey IS NOT NULL AS ina, b.l_orderkey IS NOT NULL AS inb FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber),
x AS (
 SELECT l_orderkey, l_linenumber, CASE WHEN ina THEN 'REMOVED' ELSE 'ADDED' END AS change, 'row' AS field, NULL::DOUBLE AS percent FROM j WHERE NOT ina OR NOT inb
 UNION ALL SELECT l_orderkey, l_linenumber, 'CHANGED', 'price', round((q - p) / nullif(p, 0) * 100, 2) FROM j WHERE ina AND inb AND (abs(p - q) > 0.01 OR (p IS NULL) <> (q IS NULL))
 UNION ALL SELECT l_orderkey, l_linenumber, 'CHANGED', 'flag', NULL FROM j WHERE ina AND inb AND {_SEEN.format(x='f')} <> {_SEEN.format(x='g')})
SELECT l_orderkey, l_linenumber, change, field, percent, coalesce(abs(percent) > 300, false) AS outlier FROM x"""


@plans.query(_CHANGES)
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Lines added, removed and changed between two captures."""
    before, after = _months(spark, sf)
    return merging.snapshot_changes(before, after, _KEYS, "price", ["flag"], "seq", group="l_orderkey").select(*_KEYS, "change", "field", "percent", "outlier")


@plans.query(f"""
WITH a AS (SELECT l_orderkey, string_agg(l_linenumber || ':' || coalesce(price::DECIMAL(18, 2)::VARCHAR, '') || ':' || coalesce(flag, ''), ',' ORDER BY l_linenumber, price, flag) AS x FROM ({_A}) GROUP BY 1),
b AS (SELECT l_orderkey, string_agg(l_linenumber || ':' || coalesce(price::DECIMAL(18, 2)::VARCHAR, '') || ':' || coalesce(flag, ''), ',' ORDER BY l_linenumber, price, flag) AS x FROM ({_B}) GROUP BY 1)
SELECT CASE WHEN a.x IS NULL THEN 'added' WHEN b.x IS NULL THEN 'removed' WHEN a.x = b.x THEN 'no_change' ELSE 'changed' END AS status, count(*) AS orders FROM a FULL JOIN b USING (l_orderkey) GROUP BY 1""")
def changed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose lines are the same in both captures, and others: the gate before the diff of lines."""
    shown = lambda df: df.select("l_orderkey", "l_linenumber", F.coalesce(c("price").cast("decimal(18,2)").cast("string"), F.lit("")).alias("price"), F.coalesce("flag", F.lit("")).alias("flag"))
    before, after = _months(spark, sf)
    out = merging.changed_groups(shown(before), shown(after), "l_orderkey", ["l_linenumber", "price", "flag"])
    return out.groupBy("status").agg(F.count("*").alias("orders"))


@plans.query(f"""
WITH d AS (SELECT * FROM ({_CHANGES}))
SELECT d.l_orderkey, o_custkey AS owner, 'run 2' AS run, o_orderpriority AS baseline_run, o_orderstatus AS cohort, round(date_diff('microsecond', o_orderdate::TIMESTAMP, TIMESTAMP '2000-01-01 12:00:00')::DOUBLE / 86400000000, 2) AS days_since_baseline, change AS change_type, l_linenumber,
 CASE change WHEN 'ADDED' THEN 'new_item' WHEN 'REMOVED' THEN 'removed_item' ELSE field END AS field_changed, percent AS price_change_pct, outlier AS price_outlier FROM d JOIN orders ON o_orderkey = d.l_orderkey""")
def change_records(spark: SparkSession, sf: str) -> DataFrame:
    """The changes with the cohort and the window of their order's baseline."""
    before, after = _months(spark, sf)
    changes = merging.snapshot_changes(before, after, _KEYS, "price", ["flag"], "seq", group="l_orderkey")
    about = table(spark, sf, "orders").select(c("o_orderkey").alias("l_orderkey"), c("o_custkey").alias("owner"), c("o_orderpriority").alias("baseline_run"), c("o_orderdate").alias("baseline_at"), c("o_orderstatus").alias("cohort"))
    out = merging.change_records(changes, "l_orderkey", "l_linenumber", "price", about, F.lit("run 2"), F.lit("2000-01-01 12:00:00").cast("timestamp"))
    return out.select("l_orderkey", "owner", "run", "baseline_run", "cohort", "days_since_baseline", "change_type", "l_linenumber", "field_changed", "price_change_pct", "price_outlier")


@plans.query(f"""
WITH a AS ({_A} {_LAST}), b AS ({_B} {_LAST}), j AS (SELECT a.flag AS f, b.flag AS g FROM a JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber)
SELECT 'flag' AS field, count(*) FILTER ({_SEEN.format(x='f')} = {_SEEN.format(x='g')}) AS cosmetic, count(*) FILTER ({_SEEN.format(x='f')} <> {_SEEN.format(x='g')}) AS changed FROM j WHERE trim(coalesce(f, '')) <> trim(coalesce(g, ''))""")
def cosmetic_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of texts in looks alone, counted beside the real ones."""
    before, after = _months(spark, sf)
    rows = merging.snapshot_changes(before, after, _KEYS, "price", ["flag"], "seq", group="l_orderkey", cosmetic=True).filter("field = 'flag'")
    return rows.groupBy("field").agg(F.count_if(c("change") == "COSMETIC").alias("cosmetic"), F.count_if(c("change") == "CHANGED").alias("changed"))


@plans.query(f"SELECT change, field, count(*) AS n, count(*) FILTER (outlier) AS outliers, coalesce({mean_money_sql('percent')}, 0) AS mean FROM ({_CHANGES}) GROUP BY 1, 2")
def change_counters(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot_diff(spark, sf).groupBy("change", "field").agg(F.count("*").alias("n"), F.count_if("outlier").alias("outliers"), F.coalesce(mean_money(c("percent")), F.lit(0.0)).alias("mean"))


@plans.query("""
WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS o_custkey, CASE WHEN b.n IS NOT NULL THEN CASE WHEN a.n IS NULL THEN 'new' ELSE 'ok' END WHEN coalesce(a.k, b.k) IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 'emptied' ELSE 'not_captured' END AS status, coalesce(a.n, 0)::BIGINT AS rows_before, coalesce(b.n, 0)::BIGINT AS rows_after FROM a FULL JOIN b ON a.k = b.k""")
def capture_statuses(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_custkey")
    seen = table(spark, sf, "customer").filter("c_acctbal > 0").select(c("c_custkey").alias("o_custkey"))
    return merging.capture_status(orders.filter("o_orderstatus <> 'O'"), orders.filter("o_orderstatus = 'O'"), seen, "o_custkey")


@plans.query("""
WITH d AS (SELECT c_custkey + 50 AS c_custkey, c_name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 6 = 0)
SELECT coalesce(c.c_custkey, d.c_custkey) AS c_custkey, CASE WHEN d.c_custkey IS NOT NULL THEN d.c_name ELSE c.c_name END AS c_name, coalesce(d.c_mktsegment, c.c_mktsegment) AS c_mktsegment FROM customer c FULL JOIN d ON c.c_custkey = d.c_custkey""")
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    new = base.filter("c_custkey % 6 = 0").select((c("c_custkey") + 50).alias("c_custkey"), "c_name", F.when(c("c_custkey") % 4 != 0, c("c_mktsegment")).alias("c_mktsegment"))
    return merging.upserted(base, new, ["c_custkey"], keep=["c_mktsegment"])


@plans.query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 97 = 0)
UNION ALL SELECT o_orderkey, o_custkey, round(o_totalprice * 2, 2) FROM orders WHERE o_orderkey % 97 = 0""")
def replaced_groups(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return merging.replaced(base, base.filter("o_orderkey % 97 = 0").withColumn("o_totalprice", money(c("o_totalprice") * 2)), "o_custkey")


@plans.query("""
WITH u AS (SELECT s_suppkey AS k, 0 AS p, s_name AS name FROM supplier WHERE s_acctbal > 0 UNION ALL SELECT c_custkey, 1, c_name FROM customer)
SELECT k, name FROM u QUALIFY row_number() OVER (PARTITION BY k ORDER BY p, name) = 1""")
def union_with_precedence(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "supplier").filter("s_acctbal > 0").select(c("s_suppkey").alias("k"), c("s_name").alias("name"))
    b = table(spark, sf, "customer").select(c("c_custkey").alias("k"), c("c_name").alias("name"))
    return merging.union_by_precedence([a, b], ["k"], [F.asc("name")])


@plans.query("""
SELECT p_partkey, field, before, after FROM (
 SELECT p_partkey, 'p_size' AS field, p_size::VARCHAR AS before, (p_size + CASE WHEN p_partkey % 9 = 0 THEN 1 ELSE 0 END)::VARCHAR AS after FROM part
 UNION ALL SELECT p_partkey, 'p_brand', p_brand, CASE WHEN p_partkey % 10 = 0 THEN 'own' ELSE p_brand END FROM part) WHERE before IS DISTINCT FROM after""")
def audit_trail(spark: SparkSession, sf: str) -> DataFrame:
    before = table(spark, sf, "part").select("p_partkey", "p_size", "p_brand")
    after = before.withColumns({"p_size": c("p_size") + F.when(c("p_partkey") % 9 == 0, 1).otherwise(0), "p_brand": F.when(c("p_partkey") % 10 == 0, "own").otherwise(c("p_brand"))})
    return merging.audited(before, after, "p_partkey", ["p_size", "p_brand"])


_GATES = (("price missing", "l_extendedprice IS NULL", 0), ("price negative", "l_extendedprice < 0", 0), ("discount above 10 %", "l_discount > 0.1", 0), ("shipped before 1993", "l_shipdate < TIMESTAMP '1993-01-01'", 1_000_000_000), ("quantity above 45", "l_quantity > 45", 100))


@plans.query(" UNION ALL ".join(f"SELECT '{n}' AS gate, count(*) FILTER ({w}) AS found, count(*) FILTER ({w}) <= {m} AS passed FROM lineitem" for n, w, m in _GATES))
def line_gates(spark: SparkSession, sf: str) -> DataFrame:
    return gates.checked(table(spark, sf, "lineitem"), [gates.Gate(n, F.expr(w), m) for n, w, m in _GATES])


@plans.query("""SELECT p_name, count(DISTINCT p_brand) AS "values" FROM part WHERE p_name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT p_brand) > 1""")
def broken_dependencies(spark: SparkSession, sf: str) -> DataFrame:
    return gates.broken_dependencies(table(spark, sf, "part"), "p_name", "p_brand")


@plans.query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def repeated_line_keys(spark: SparkSession, sf: str) -> DataFrame:
    return gates.repeated_keys(table(spark, sf, "lineitem"), _KEYS)


@plans.query("""
SELECT kind, key, count(*) AS n FROM (SELECT unnest(['name', 'brand and size']) AS kind, unnest([p_name, p_brand || '/' || p_size]) AS key FROM part) WHERE key IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")
def alternative_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return gates.alternative_groups(table(spark, sf, "part"), {"name": c("p_name"), "brand and size": F.concat_ws("/", "p_brand", c("p_size").cast("string"))})


@plans.query("""SELECT lower(x) AS lower, count(DISTINCT x) AS forms FROM (SELECT CASE WHEN s_suppkey % 5 = 0 THEN upper(n_name) ELSE n_name END AS x FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT lower(n_name) FROM nation) GROUP BY 1 HAVING count(DISTINCT x) > 1""")
def casing_twins(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    rows = table(spark, sf, "supplier").join(nation, c("s_nationkey") == c("n_nationkey")).select(F.when(c("s_suppkey") % 5 == 0, F.upper("n_name")).otherwise(c("n_name")).alias("x"))
    return gates.casing_twins(rows.unionAll(nation.select(F.lower("n_name").alias("x"))), "x")


@plans.query("""SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 0)""")
def orphan_lines(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "supplier").filter("s_acctbal > 0")
    return gates.orphans(table(spark, sf, "lineitem").select(*_KEYS, "l_suppkey"), known, "l_suppkey", "s_suppkey").select(*_KEYS, "l_suppkey")


# Streams -------------------------------------------------------------------

def _events(spark: SparkSession, sf: str) -> DataFrame:
    """The event table as a stream of files: written again in parts, as a collector leaves them."""
    folder = new_folder(spark, "stream")
    table(spark, sf, "events").repartition(8, "user_id").write.parquet(f"{folder}/in")
    return streams.file_stream(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema, 4)


@plans.query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def streamed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Running counts by micro-batch; the last batch's counts are the table's."""
    folder = new_folder(spark, "stream")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("number", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    streams.run_batches(streams.running_counts(_events(spark, sf), ["event_type"]), keep, f"{folder}/checkpoint")
    rows = spark.read.parquet(f"{folder}/out")
    return rows.groupBy("event_type").agg(F.max_by("n", "number").alias("n"))


@plans.query("SELECT DISTINCT user_id, event_type FROM events")
def streamed_once_by_key(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "stream")
    once = streams.once_by_key(_events(spark, sf).select("user_id", "event_type"), ["user_id", "event_type"])
    streams.run_once(once, "parquet", f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out")


@plans.query("SELECT epoch_us(date_trunc('day', ts)::TIMESTAMP) AS start, event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1, 2")
def tumbling_windows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("ts", c("ts").cast("timestamp"))
    return rows.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), money(F.sum("value")).alias("value")).select(F.unix_micros(c("w.start")).alias("start"), "event_type", "n", "value")


@plans.query("""
WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, epoch_us(min(ts)) AS start, count(*) AS n FROM s GROUP BY user_id, s""")
def session_windows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("ts", c("ts").cast("timestamp"))
    return rows.groupBy(F.session_window("ts", "6 hours").alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.unix_micros(c("w.start")).alias("start"), "n")


@plans.query("""
WITH e AS (SELECT user_id, event_id, ts, event_type = 'error' AS failed, count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS errors FROM events WHERE event_type IN ('error', 'purchase')),
f AS (SELECT user_id, arg_min(struct_pack(errors := errors, failed := failed), (ts, event_id)) AS x FROM e WHERE NOT failed OR errors = 3 GROUP BY 1), a AS (SELECT user_id, max(errors) AS errors FROM e GROUP BY 1)
SELECT user_id AS key, coalesce(f.x.errors, a.errors)::BIGINT AS attempts, CASE WHEN f.x IS NULL THEN 'retry' WHEN f.x.failed THEN 'dead' ELSE 'done' END AS status FROM a LEFT JOIN f USING (user_id)""")
def retried_users(spark: SparkSession, sf: str) -> DataFrame:
    """Errors as failed attempts of a user until a purchase: three micro-batches in order of time, each by a stream started anew on the same state."""
    folder = new_folder(spark, "stream")
    rows = table(spark, sf, "events").filter("event_type in ('error', 'purchase')").select("user_id", "event_id", c("ts").cast("timestamp").alias("at"), (c("event_type") == "error").alias("failed"))
    low, high = rows.agg(F.unix_micros(F.min("at")), F.unix_micros(F.max("at"))).first()
    share = (F.unix_micros("at") - F.lit(low)) * 3
    for part in range(3):
        span = F.lit(max(1, high - low))
        rows.filter((share >= span * part) & ((share < span * (part + 1)) | F.lit(part == 2))).coalesce(4).write.mode("append").parquet(f"{folder}/in")
        told = retries.attempts(streams.file_stream(spark, f"{folder}/in", rows.schema, 1000), "user_id", "at", "event_id", "failed", 3, "1 day", "36500 days")
        with retries.with_store(spark):
            streams.run_once(told, "parquet", f"{folder}/out", f"{folder}/checkpoint")
    return retries.last_status(spark.read.parquet(f"{folder}/out"))
