"""Sitemaps, stores in pages, surviving venues, planned counts and gates of a load on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.operators import gates, nearby, resolving, tiers
from lakeshed.plans.base import METRES_SQL, Plans, places, places_sql, table
from lakeshed.sources import html

plans = Plans()
c = F.col

_HOSTS = ("www.shop.example", "shop.example", "other.example")
_LINKS = "l AS (SELECT p_partkey AS parent, child FROM (SELECT p_partkey, unnest([p_partkey * 2, p_partkey * 2 + 1, p_partkey // 3, p_partkey]) AS child FROM part) WHERE child IN (SELECT p_partkey FROM part))"


@plans.query(f"""
WITH RECURSIVE {_LINKS}, r(url, depth) AS (SELECT 1::BIGINT, 0 UNION SELECT child, depth + 1 FROM r JOIN l ON url = parent WHERE depth < 6 AND url % 7 <> 6),
s AS (SELECT url, min(depth) AS depth FROM r WHERE url % 7 <> 6 GROUP BY 1),
e AS (SELECT p_partkey % (SELECT count(*) // 2 FROM part) + 1 AS sitemap, 'https://' || ['www.shop.example', 'shop.example', 'other.example'][p_partkey % 3 + 1] || CASE WHEN p_size % 2 = 0 THEN '/uae/' ELSE '/ksa/' END || CASE p_partkey % 4 WHEN 0 THEN 'restaurants/' WHEN 1 THEN 'Dubai/' ELSE '' END || p_partkey || '?p=/restaurant' AS loc, p_partkey AS k, p_size FROM part)
SELECT sitemap AS source_sitemap, depth, loc, k % 3 < 2 AND p_size % 2 = 0 AS in_region, k % 3 < 2 AND p_size % 2 = 0 AND k % 4 = 1 AS in_city, k % 4 = 0 AS restaurant FROM e JOIN s ON url = sitemap""")
def sitemap_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of the sitemaps (parts, here) that part 1 reaches within six steps; links form cycles, every seventh sitemap is not opened."""
    part, k = table(spark, sf, "part").select("p_partkey", "p_size"), c("p_partkey")
    to = F.explode(F.array(k * 2, k * 2 + 1, F.floor(k / 3), k))
    links = part.select(k.alias("parent"), to.alias("child")).join(part.select(k.alias("child")), "child", "left_semi")
    half = part.agg(F.floor(F.count("*") / 2).alias("half"))  # one row
    tail = F.when(k % 4 == 0, "restaurants/").when(k % 4 == 1, "Dubai/").otherwise("")
    loc = F.concat(F.lit("https://"), F.element_at(F.array(*map(F.lit, _HOSTS)), (k % 3 + 1).cast("int")), F.when(c("p_size") % 2 == 0, "/uae/").otherwise("/ksa/"), tail, k.cast("string"), F.lit("?p=/restaurant"))
    entries = part.crossJoin(F.broadcast(half)).select((k % c("half") + 1).alias("sitemap"), loc.alias("loc"))
    host, path = html.host_and_path(c("loc"))
    region = F.endswith(host, F.lit("shop.example")) & F.contains(path, F.lit("/uae/"))
    flags = {"in_region": region, "in_city": region & F.contains(F.lower("loc"), F.lit("dubai")), "restaurant": F.contains(F.lower(path), F.lit("/restaurant"))}
    roots = part.filter(k == 1).select(k.alias("url"))
    return html.sitemap_records(links, entries, roots, flags, 6, c("url") % 7 != 6)


@plans.query("""
WITH x AS (SELECT s_suppkey AS k, s_suppkey % 3 AS a, s_suppkey % 4 AS b FROM supplier), e AS (SELECT k, unnest(CASE WHEN a = 0 THEN [k, k + 3, k + 1, k + 2] ELSE [k, k + 1, k + 2] END) AS id, generate_subscripts(CASE WHEN a = 0 THEN [k, k + 3, k + 1, k + 2] ELSE [k, k + 1, k + 2] END, 1)::INT - 1 AS place FROM x)
SELECT k AS s_suppkey, place, id FROM e""")
def page_stores(spark: SparkSession, sf: str) -> DataFrame:
    """Stores of pages whose scripts list them in several forms, some of them broken."""
    k = c("s_suppkey").cast("string")
    plus = lambda n: (c("s_suppkey") + n).cast("string")
    page = F.concat(F.lit('<script>storedata = [{"id": '), plus(1), F.lit('}, {"id": '), plus(2), F.lit('}]; VAR Stores=\n[{"id": '), k, F.lit("}];"), F.when(c("s_suppkey") % 3 == 0, F.concat(F.lit(' x = {"Location" : [{"id": '), plus(3), F.lit("}]}"))).otherwise(""), F.when(c("s_suppkey") % 4 == 0, ' marker = [{"id": 1,}]; markers = [new Marker(1)];').otherwise(""), F.lit("</script>"))
    found = table(spark, sf, "supplier").select("s_suppkey", F.posexplode(html.stores(page)).alias("place", "store"))
    return found.select("s_suppkey", "place", F.get_json_object("store", "$.id").cast("long").alias("id"))


@plans.query(f"""
WITH RECURSIVE u AS (SELECT c_custkey, c_acctbal, {places_sql('c_custkey', 13)} FROM customer), e AS (SELECT a.c_custkey AS u, b.c_custkey AS v FROM u a, u b WHERE a.c_custkey <> b.c_custkey AND {METRES_SQL.format(a='a', b='b')} <= 500),
r AS (SELECT c_custkey AS u, c_custkey AS v FROM u UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u), k AS (SELECT u AS c_custkey, min(v) AS component FROM r GROUP BY 1),
b AS (SELECT component, c_custkey AS survivor FROM k JOIN u USING (c_custkey) QUALIFY row_number() OVER (PARTITION BY component ORDER BY c_acctbal > 0 DESC, c_custkey DESC) = 1)
SELECT c_custkey, component, survivor, c_custkey = survivor AS kept FROM k JOIN b USING (component)""")
def venue_survivors(spark: SparkSession, sf: str) -> DataFrame:
    """Customers within 500 m of each other, directly or by others, are one venue: those in credit stay first, then the newest."""
    people = places(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_custkey", 13)
    clusters = nearby.clustered(people, "c_custkey", 500.0).join(people.select("c_custkey", "c_acctbal"), "c_custkey")
    return nearby.with_survivors(clusters, "c_custkey", "component", c("c_acctbal") > 0).select("c_custkey", "component", "survivor", "kept")


@plans.query("""
WITH o AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1),
x AS (SELECT c_custkey AS k, n AS web, CASE WHEN c_custkey % 11 = 0 THEN n + 1 END AS official, CASE WHEN c_custkey % 6 <> 5 THEN n * (c_custkey % 4 + 1) END AS report, 2023 + c_custkey % 5 AS year, n + 2 AS maps, c_custkey % 7 = 0 AS published, c_custkey % 13 = 0 AS rejected, c_custkey % 17 = 0 AS reviewed, CASE WHEN c_custkey % 3 <> 0 THEN n * (c_custkey % 5) + 5 END AS mid, c_custkey % 2 = 0 AS by_maps FROM customer LEFT JOIN o ON k = c_custkey),
u AS (SELECT *, report IS NOT NULL AND year >= 2025 AND NOT rejected AS usable FROM x), v AS (SELECT *, usable AND web > 0 AND (report < 0.65 * web OR report > 1.5 * web) AND NOT reviewed AS against, coalesce(abs(report - mid) <= abs(web - mid), false) AS nearer FROM u),
s AS (SELECT *, CASE WHEN official IS NOT NULL THEN 'official' WHEN usable AND (NOT coalesce(against, false) OR nearer) THEN 'report' WHEN published THEN 'published' WHEN by_maps THEN 'maps' WHEN web > 0 THEN 'web' ELSE 'missing' END AS source FROM v)
SELECT k AS c_custkey, source, CASE source WHEN 'official' THEN official WHEN 'report' THEN report WHEN 'published' THEN web WHEN 'maps' THEN maps WHEN 'web' THEN web END AS planned,
 CASE WHEN against AND nearer THEN 'contradicted, report nearer to the estimate' WHEN against AND mid IS NOT NULL THEN 'contradicted, web nearer to the estimate' WHEN against AND by_maps THEN 'contradicted, counted on maps' WHEN against THEN 'contradicted, web used' WHEN source = 'web' AND report IS NOT NULL AND year < 2025 THEN 'older report' END AS note FROM s""")
def count_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Brands (customers, here) with counts made of their orders, so that each source and note occurs."""
    n = table(spark, sf, "orders").groupBy(c("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    k, low = c("c_custkey"), c("n") * (c("c_custkey") % 5)
    values = {"web": c("n"), "official": F.when(k % 11 == 0, c("n") + 1), "report": F.when(k % 6 != 5, c("n") * (k % 4 + 1)), "report_year": 2023 + k % 5, "maps": c("n") + 2, "published": k % 7 == 0, "rejected": k % 13 == 0, "reviewed": k % 17 == 0, "estimate_low": F.when(k % 3 != 0, low), "estimate_high": F.when(k % 3 != 0, low + 10)}
    rows = table(spark, sf, "customer").select("c_custkey").join(n, "c_custkey", "left").withColumns(values)
    return tiers.count_plan(rows, k % 2 == 0).select("c_custkey", "source", "planned", "note")


@plans.query("""
WITH f AS (SELECT l_suppkey AS k, l_returnflag AS country, count(*) AS n FROM lineitem GROUP BY 1, 2), t AS (SELECT k, sum(n) AS total, sum(CASE WHEN k % 4 = 0 AND country = 'A' THEN 7 WHEN k % 6 = 0 AND country = 'R' THEN 0 ELSE n END) AS s FROM f GROUP BY 1),
x AS (SELECT s_suppkey AS k, nullif(s, 0) AS s, CASE WHEN s_suppkey % 3 <> 0 AND s_suppkey % 10 <> 0 THEN total * (1 + s_suppkey % 2) END AS g, CASE WHEN s_suppkey % 7 = 0 THEN total // 2 END AS maps, CASE WHEN s_suppkey % 9 = 0 THEN 830 END AS published, CASE WHEN s_suppkey % 5 <> 0 THEN total * (2 + s_suppkey % 3) / 2 END AS mid FROM supplier LEFT JOIN t ON k = s_suppkey),
v AS (SELECT *, s IS NOT NULL AND g IS NOT NULL AND maps IS NULL AND published IS NULL AND mid IS NOT NULL AS chosen FROM x), w AS (SELECT *, chosen AND abs(g - mid) < abs(s - mid) AS nearer FROM v)
SELECT k AS s_suppkey, CASE WHEN published IS NOT NULL THEN 'published' WHEN maps IS NOT NULL THEN 'maps' WHEN s IS NOT NULL AND NOT nearer THEN 'sum' WHEN g IS NOT NULL THEN 'stated' ELSE 'missing' END AS source, coalesce(published, maps, CASE WHEN nearer THEN g END, s, g)::BIGINT AS planned, chosen AND greatest(s, g) > 1.35 * least(s, g) AS flagged FROM w""")
def region_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers' lines by return flag for outlets by country: mended, added up, and held against a stated total."""
    by = table(spark, sf, "lineitem").groupBy(c("l_suppkey").alias("s_suppkey"), c("l_returnflag").alias("country")).agg(F.count("*").alias("count"))
    total = by.groupBy("s_suppkey").agg(F.sum("count").alias("total"))
    k, all_ = c("s_suppkey"), c("total")
    brands = table(spark, sf, "supplier").select("s_suppkey").join(total, "s_suppkey", "left")
    fixes = by.filter((k % 4 == 0) & (c("country") == "A")).select("s_suppkey", "country", F.lit(7).cast("long").alias("count"))
    fixes = fixes.unionByName(by.filter((k % 6 == 0) & (c("country") == "R")).select("s_suppkey", "country", F.lit(None).cast("long").alias("count")))
    brands = brands.withColumns({"stated": F.when(k % 3 != 0, all_ * (1 + k % 2)), "rejected": k % 10 == 0, "maps": F.when(k % 7 == 0, F.floor(all_ / 2)), "published": F.when(k % 9 == 0, F.lit(830).cast("long")), "estimate_low": F.when(k % 5 != 0, all_), "estimate_high": F.when(k % 5 != 0, all_ * (1 + k % 3))})
    return tiers.region_plan(brands, "s_suppkey", by, fixes).select("s_suppkey", "source", "planned", "flagged")


@plans.query("""
WITH i AS (SELECT o_custkey AS branch, CASE WHEN o_custkey % 10 = 1 AND o_orderkey % 2 = 0 OR o_custkey % 5 = 0 THEN 'May' ELSE 'June' END AS run, CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS item_key FROM orders), d AS (SELECT CASE WHEN l_orderkey % 4 = 0 THEN 'May' ELSE 'June' END AS run, l_returnflag AS kind, CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS base FROM lineitem),
g AS (SELECT DISTINCT c_custkey AS branch FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 50 = 1), ji AS (SELECT count(*) AS n FROM i WHERE run = 'June'), jd AS (SELECT count(*) AS n FROM d WHERE run = 'June'),
r AS (SELECT 'items as stated' AS gate, n AS found, n AS wanted FROM ji UNION ALL SELECT 'deltas as stated', n, n + 1 FROM jd UNION ALL SELECT 'branches of several runs', (SELECT count(*) FROM (SELECT branch FROM i GROUP BY 1 HAVING count(DISTINCT run) > 1)), 0
UNION ALL SELECT 'emptied branches keep rows', (SELECT count(DISTINCT branch) FROM i WHERE branch IN (SELECT branch FROM g)), (SELECT count(*) FROM g) UNION ALL SELECT 'emptied branches get rows', (SELECT count(*) FROM i WHERE run = 'June' AND branch IN (SELECT branch FROM g)), 0
UNION ALL SELECT 'kinds of change beyond the list', (SELECT count(*) FROM d WHERE run = 'June' AND kind NOT IN ('A', 'R')), 0 UNION ALL SELECT 'items without item_key', (SELECT count(*) FROM i WHERE run = 'June' AND item_key IS NULL), 0 UNION ALL SELECT 'deltas without base', (SELECT count(*) FROM d WHERE run = 'June' AND base IS NULL), 0)
SELECT gate, found::BIGINT AS found, wanted::BIGINT AS wanted, found = wanted AS passed FROM r""")
def load_gates(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as items of branches and lines as deltas of two runs, with what a load must not have."""
    k, o = c("o_custkey"), c("o_orderkey")
    items = table(spark, sf, "orders").select(k.alias("branch"), F.when(((k % 10 == 1) & (o % 2 == 0)) | (k % 5 == 0), "May").otherwise("June").alias("run"), F.when(o % 97 != 0, o).alias("item_key"))
    deltas = table(spark, sf, "lineitem").select(F.when(c("l_orderkey") % 4 == 0, "May").otherwise("June").alias("run"), c("l_returnflag").alias("kind"), F.when(c("l_linenumber") != 7, c("l_suppkey")).alias("base"))
    emptied = table(spark, sf, "customer").filter("c_custkey % 5 = 0 or c_custkey % 50 = 1").select(c("c_custkey").alias("branch"))
    june = lambda df, name, more: df.filter("run = 'June'").agg((F.count("*") + more).alias(name))
    stated = june(items, "items", 0).crossJoin(june(deltas, "deltas", 1))  # one row each
    return gates.load_gates(items, deltas, "run", F.lit("June"), "branch", (["item_key"], ["base"]), "kind", ["A", "R"], emptied, stated)


@plans.query("""
WITH x AS (SELECT p_brand || '-' || p_size % 12 AS name, CASE p_size % 5 WHEN 0 THEN true WHEN 1 THEN false ELSE p_partkey % 2 = 0 END AS newer, CASE WHEN p_partkey % 3 = 0 THEN lower(p_type) ELSE p_type END AS term, string_split(p_name, ' ')[1:1 + (p_partkey % 2)::INT] AS list FROM part),
v AS (SELECT name, min(term) AS v FROM (SELECT p_brand || '-' || p_size % 12 AS name, ['small', 'large', 'economy', 'promo'][p_size % 4 + 1] AS term FROM part WHERE p_partkey % 2 = 0) GROUP BY 1),
k AS (SELECT name, newer, term, list, count(*) AS n, any_value(v) AS v, coalesce(lower(term) = any_value(v), false) AS backed FROM x LEFT JOIN v USING (name) GROUP BY 1, 2, 3, 4),
o AS (SELECT * FROM k WHERE NOT newer QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, term, list) = 1), w AS (SELECT * FROM k WHERE newer QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, term, list) = 1),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY name ORDER BY backed DESC, n DESC, term, list) = 1),
c AS (SELECT name FROM k GROUP BY 1 HAVING count(DISTINCT term || '|' || array_to_string(list, ' ')) > 1),
j AS (SELECT name, o.term AS ot, o.list AS ol, o.backed AS ob, w.term AS wt, w.list AS wl, w.backed AS wb, b.term AS bt, b.list AS bl, b.backed AS bb FROM c LEFT JOIN o USING (name) LEFT JOIN w USING (name) LEFT JOIN b USING (name)),
y AS (SELECT *, CASE WHEN ot IS NULL OR wt IS NULL THEN CASE WHEN bb THEN 'one month, backed' ELSE 'one month, most rows' END WHEN ob AND wb THEN 'same term, longer list' WHEN ob THEN 'neighbours back the old' WHEN wb THEN 'neighbours back the new' ELSE 'neighbours back neither' END AS why FROM j),
z AS (SELECT *, CASE WHEN why LIKE 'one%' THEN 'b' WHEN why = 'neighbours back the old' OR why LIKE 'same%' AND len(ol) >= len(wl) THEN 'o' ELSE 'w' END AS side FROM y)
SELECT name, CASE side WHEN 'b' THEN bt WHEN 'o' THEN ot ELSE wt END AS term, array_to_string(CASE side WHEN 'b' THEN bl WHEN 'o' THEN ol ELSE wl END, ' ') AS ingredients, why FROM z""")
def conflicts_settled(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of names (brand and size) over two months, arbitrated by a stated vote."""
    part, k, size = table(spark, sf, "part"), c("p_partkey"), c("p_size")
    name = F.concat("p_brand", F.lit("-"), (size % 12).cast("string")).alias("name")
    newer = F.when(size % 5 == 0, True).when(size % 5 == 1, False).otherwise(k % 2 == 0)
    rows = part.select(name, newer.alias("newer"), F.when(k % 3 == 0, F.lower("p_type")).otherwise(c("p_type")).alias("term"), F.slice(F.split("p_name", " "), 1, (1 + k % 2).cast("int")).alias("ingredients"))
    terms = F.array(*map(F.lit, ("small", "large", "economy", "promo")))
    voted = part.filter(k % 2 == 0).select(name, F.element_at(terms, (size % 4 + 1).cast("int")).alias("term"))
    out = resolving.settled_conflicts(rows, "name", voted)
    return out.select("name", "term", F.array_join("ingredients", " ").alias("ingredients"), "why")
