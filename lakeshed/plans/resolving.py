"""Composites of the catalogue cycle on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.functions import text as t
from lakeshed.operators import choosing, nearby, phrases, resolving
from lakeshed.plans.base import METRES_SQL, Plans, places, places_sql, table

plans = Plans()
c = F.col


@plans.query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey, l_returnflag ORDER BY l_linenumber, l_suppkey, l_returnflag) = 1)
SELECT o_orderkey, coalesce(string_agg(l_suppkey || l_returnflag, ',' ORDER BY l_linenumber, l_suppkey, l_returnflag), '') AS items FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1""")
def nested_menu_once(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_returnflag"))).alias("items"))
    menus = table(spark, sf, "orders").select("o_orderkey").join(lines, c("o_orderkey") == c("l_orderkey"), "left").drop("l_orderkey")
    once = resolving.nested_once(menus, "o_orderkey", "items", ["l_suppkey", "l_returnflag"])
    return once.select("o_orderkey", F.array_join(F.transform("items", lambda x: F.concat(x["l_suppkey"].cast("string"), x["l_returnflag"])), ",").alias("items"))


@plans.query("""
WITH r AS (SELECT l_orderkey, l_suppkey, l_returnflag AS section, min(l_linenumber) AS first FROM lineitem GROUP BY 1, 2, 3),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY section = 'N', section) = 1)
SELECT b.l_orderkey, b.l_suppkey, b.section, coalesce(string_agg(r.section, ', ' ORDER BY r.section) FILTER (r.section <> b.section), '') AS also_in FROM b JOIN r USING (l_orderkey, l_suppkey) GROUP BY 1, 2, 3""")
def promotions_merged(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", c("l_returnflag").alias("section")).distinct()
    return resolving.one_of_promotions(rows, ["l_orderkey", "l_suppkey"], "section", c("section") == "N", [F.asc("section")])


_C = f"SELECT c_custkey, c_nationkey, c_mktsegment, {places_sql('c_custkey', 13)} FROM customer"


_CITIES = ("Dubai", "Sharjah", "Ajman", "Al Ain")
#: Branches of segments with addresses that several share, that say only their area, or a city that isn't where they stand.
_BRANCHES = f"""b AS (SELECT c_custkey, c_mktsegment AS chain, 'Area ' || c_nationkey % 5 AS area, CASE WHEN c_nationkey % 6 = 0 THEN ' area  ' || c_nationkey % 5 ELSE 'Shop ' || c_nationkey || CASE WHEN c_nationkey % 3 = 1 THEN '' ELSE ' - ' || {list(_CITIES)}[c_nationkey % 4 + 1] END || CASE WHEN c_nationkey % 3 = 2 THEN ' - Mall' ELSE '' END END AS raw,
 'https://x/menu/' || replace(lower(c_name), '#', '') || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '-area-' || (c_nationkey + c_custkey % 3) % 7 END AS url, lat, lon, {list(_CITIES)}[c_custkey % 2 + 1] AS verified, c_name FROM (SELECT *, {places_sql('c_custkey', 13)} FROM customer))"""


def _smear_rows(spark: SparkSession, sf: str) -> DataFrame:
    n, k = c("c_nationkey"), c("c_custkey")
    city = lambda i: F.element_at(F.array(*map(F.lit, _CITIES)), (i + 1).cast("int"))
    digits = lambda x: x.cast("string")
    full = F.concat(F.lit("Shop "), digits(n), F.when(n % 3 == 1, "").otherwise(F.concat(F.lit(" - "), city(n % 4))), F.when(n % 3 == 2, " - Mall").otherwise(""))
    raw = F.when(n % 6 == 0, F.concat(F.lit(" area  "), digits(n % 5))).otherwise(full)
    url = F.concat(F.lit("https://x/menu/"), F.replace(F.lower("c_name"), F.lit("#"), F.lit("")), F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("-area-"), digits((n + k % 3) % 7))))
    rows = places(table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_name"), "c_custkey", 13)
    return rows.select("c_custkey", c("c_mktsegment").alias("chain"), F.concat(F.lit("Area "), digits(n % 5)).alias("area"), raw.alias("raw"), url.alias("url"), "lat", "lon", city(k % 2).alias("verified"), F.regexp_replace("c_name", "#", "").alias("name"))


_SMEARS = f"""{_BRANCHES}, k AS (SELECT *, lower(trim(regexp_replace(raw, '\\s+', ' ', 'g'))) AS address FROM b), g AS (SELECT * FROM k WHERE address <> lower(area)),
s AS (SELECT a.chain, a.address, count(DISTINCT a.c_custkey) AS branches, max({METRES_SQL.format(a='a', b='z')}) AS spread FROM g a JOIN g z ON a.chain = z.chain AND a.address = z.address GROUP BY 1, 2 HAVING count(DISTINCT a.c_custkey) > 1 AND max({METRES_SQL.format(a='a', b='z')}) > 20000)"""


@plans.query(f"WITH {_SMEARS} SELECT chain, address, branches, round(spread, 2) AS spread FROM s")
def smeared_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return resolving.smeared(_smear_rows(spark, sf), "c_custkey", "chain", "raw", "area", 20_000.0).withColumn("spread", F.round("spread", 2))


@plans.query(f"""
WITH {_SMEARS}, j AS (SELECT g.* FROM g JOIN s USING (chain, address)),
v AS (SELECT j.c_custkey, k.verified, sqrt(pow(j.lat - k.lat, 2) + pow(j.lon - k.lon, 2)) * 111 AS km, k.c_custkey AS other FROM j, k WHERE k.c_custkey % 3 = 0),
n AS (SELECT * FROM v WHERE km <= 2 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY km, other) <= 5),
m AS (SELECT c_custkey, verified AS place_city FROM n GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY count(*) DESC, verified) = 1),
e AS (SELECT j.*, place_city, list_filter(list_transform(string_split(raw, ' - '), lambda x: CASE WHEN list_contains({[x.lower() for x in _CITIES]}, lower(trim(x))) THEN trim(x) END), lambda x: x IS NOT NULL)[-1] AS stated,
  nullif(trim(substr(trim(replace(regexp_extract(url, '([^/]*)$', 1), '-', ' ')), len(replace(c_name, '#', ' ')) + 1)), '') AS tail, replace(lower(c_name), '#', '') AS nm FROM j LEFT JOIN m USING (c_custkey))
SELECT c_custkey, CASE WHEN place_city <> stated THEN 'wrong emirate' WHEN tail IN ('area 0', 'area 1', 'area 2', 'area 3', 'area 4') AND tail = lower(area) THEN 'consistent' WHEN tail IN ('area 0', 'area 1', 'area 2', 'area 3', 'area 4') THEN 'wrong area' ELSE 'unverified' END AS verdict FROM (SELECT * REPLACE (nullif(trim(substr(replace(regexp_extract(url, '([^/]*)$', 1), '-', ' '), len(nm) + 1)), '') AS tail) FROM e)""")
def smear_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """What the places around, the stated city and the page's own area say of each branch of a smeared address."""
    from lakeshed.functions.text import item_key, last_known_city, slug_tail
    from lakeshed.operators import nearby

    rows = _smear_rows(spark, sf)
    bad = resolving.smeared(rows, "c_custkey", "chain", "raw", "area", 20_000.0).select("chain", "address")
    held = rows.withColumn("address", item_key(c("raw"))).join(bad, ["chain", "address"])
    voted = nearby.vote(held.select("c_custkey", "lat", "lon"), rows.filter("c_custkey % 3 = 0").select(c("c_custkey").alias("known"), "lat", "lon", "verified"), "c_custkey", "known", "verified", 5, 2.0).select("c_custkey", c("verified").alias("place_city"))
    listed = rows.select(F.lower("area").alias("on_list")).distinct()
    held = held.join(voted, "c_custkey", "left").withColumn("tail", slug_tail(c("url"), c("name"))).join(listed, c("tail") == c("on_list"), "left")
    verdict = resolving.smear_verdict(c("place_city"), last_known_city(c("raw"), _CITIES), c("tail"), c("on_list").isNotNull(), F.lower("area"))
    return held.select("c_custkey", verdict.alias("verdict"))


@plans.query(f"""
WITH u AS ({_C}), s AS (SELECT s_suppkey, {places_sql('s_suppkey', 0)} FROM supplier),
j AS (SELECT c_custkey, s_suppkey, {METRES_SQL.format(a='u', b='s')} AS d FROM u JOIN s ON s_suppkey = c_custkey % (SELECT count(*) FROM supplier)),
r AS (SELECT *, count(*) OVER (PARTITION BY s_suppkey) AS n, row_number() OVER (PARTITION BY s_suppkey ORDER BY d, c_custkey) AS place FROM j)
SELECT c_custkey, s_suppkey::VARCHAR AS link, CASE WHEN n = 1 OR (place = 1 AND d <= 3000) THEN 'own' WHEN d > 10000 THEN 'drop' ELSE 'keep' END AS verdict FROM r""")
def shared_link_owners(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = places(table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey", 0).withColumnsRenamed({"lat": "olat", "lon": "olon"})
    n = suppliers.agg(F.count("*").alias("n"))
    rows = places(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 13).crossJoin(F.broadcast(n)).join(suppliers, c("c_custkey") % c("n") == c("s_suppkey"))  # n is one row
    return resolving.link_owners(rows.withColumn("link", c("s_suppkey").cast("string")), "c_custkey", "link", "olat", "olon", 3000.0, 10000.0)


@plans.query("""
WITH u AS (SELECT c_custkey, lower(c_mktsegment) AS name, floor((25.0::DOUBLE + (c_custkey % 90 * 7932 % 4001)::DOUBLE / 10000.0::DOUBLE) * 10000) AS y, floor((55.0::DOUBLE + (c_custkey % 90 * 6114 % 3989)::DOUBLE / 10000.0::DOUBLE) * 10000) AS x FROM customer)
SELECT c_custkey, name FROM u QUALIFY row_number() OVER (PARTITION BY name, y, x ORDER BY c_custkey) = 1""")
def places_once(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", F.lower("c_mktsegment").alias("name"), (c("c_custkey") % 90).alias("k"))
    return resolving.one_place(places(rows, "k", 13), c("name"), [F.asc("c_custkey")]).select("c_custkey", "name")


@plans.query("""
WITH b AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS brand FROM part)
SELECT p_partkey, brand, CASE WHEN p_name = brand THEN 'exact' WHEN starts_with(p_name, brand || ' ') THEN 'leading' ELSE 'contained' END AS step FROM part JOIN b ON list_contains(string_split(p_name, ' '), brand)""")
def brand_matches(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", t.match_key(c("p_name")).alias("name"))
    brands = part.select(F.element_at(F.split("name", " "), 1).alias("brand")).distinct()
    pairs = part.withColumn("brand", F.explode(F.array_distinct(F.split("name", " ")))).join(brands, "brand")
    return pairs.select("p_partkey", "brand", resolving.brand_steps(c("brand"), c("name")).alias("step")).filter("step is not null")


@plans.query("""
WITH r AS (SELECT l_suppkey, l_partkey, l_orderkey % 40 AS address, l_returnflag = 'R' AS closed, CASE WHEN l_discount > 0.08 THEN 'other kind' WHEN l_quantity < 3 THEN 'too small' END AS reason FROM lineitem),
k AS (SELECT * FROM r WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY CASE WHEN address = 0 THEN 'id:' || l_partkey ELSE address::VARCHAR END, closed) = 1),
u AS (SELECT l_suppkey, CASE WHEN address = 0 THEN 'id:' || l_partkey ELSE address::VARCHAR END AS own, bool_and(closed) AS shut FROM k GROUP BY 1, 2),
o AS (SELECT l_suppkey, count(*) AS outlets, count(*) FILTER (NOT shut) AS open FROM u GROUP BY 1),
t AS (SELECT l_suppkey, count(*) AS rows, count(*) FILTER (reason = 'other kind') AS other_kind, count(*) FILTER (reason = 'too small') AS too_small, count(*) >= 600 AS cut FROM r GROUP BY 1),
c AS (SELECT l_suppkey, rows, other_kind, too_small, coalesce(outlets, 0) AS outlets, coalesce(open, 0) AS open, cut FROM t LEFT JOIN o USING (l_suppkey))
SELECT *, NULL::VARCHAR AS shared_from FROM c UNION ALL SELECT s.s_suppkey, rows, other_kind, too_small, outlets, open, cut, l_suppkey::VARCHAR FROM supplier s JOIN c ON l_suppkey = s.s_suppkey % 7 WHERE s.s_suppkey % 10 = 0""")
def outlet_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as outlets of suppliers; every tenth supplier is said to be another one, and has its counts too."""
    address = F.when(c("l_orderkey") % 40 != 0, (c("l_orderkey") % 40).cast("string")).otherwise("")
    reasons = [("other kind", c("l_discount") > 0.08), ("too small", c("l_quantity") < 3)]
    rows = table(spark, sf, "lineitem").withColumn("address", address)
    counts = resolving.outlets(rows, ["l_suppkey"], reasons, "l_partkey", "address", c("l_returnflag") == "R", 600)
    same = table(spark, sf, "supplier").filter("s_suppkey % 10 = 0").select(c("s_suppkey").alias("l_suppkey"), (c("s_suppkey") % 7).alias("same_as"))
    return resolving.shared_counts(counts, "l_suppkey", same)


@plans.query(r"""
WITH h AS (SELECT page_id, split_part(split_part(regexp_replace(lower(trim(url)), '^[a-z]+://', ''), '/', 1), ':', 1) AS host, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title FROM pages),
d AS (SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS p, ' ' || trim(regexp_replace(replace(regexp_replace(replace(lower(strip_accents(coalesce(title, ''))), '&', ' and '), '[''.]', '', 'g'), '-', ' '), '\s+', ' ', 'g')) || ' ' AS said FROM h),
r AS (SELECT *, CASE WHEN len(p) >= 2 THEN array_to_string(p[-2:], '.') END AS domain FROM d),
m AS (SELECT domain, CASE WHEN contains(said, ' of ') THEN NULL WHEN contains(said, ' the ') OR contains(said, ' und ') THEN 'title' WHEN domain = 'example.org' THEN 'domain' END AS how FROM r)
SELECT domain, count(*) AS rows, count(*) FILTER (how IS NULL) AS noise, count(*) FILTER (how = 'title') AS by_title FROM m GROUP BY 1""")
def matched_outlets(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as a search's results, by registered domain: how many are a brand's by its words in the title or by its domain."""
    from lakeshed.sources import html

    rows = table(spark, sf, "pages").select("page_id", html.title(c("html")).alias("title"), "url")
    words = lambda *x: F.array(*map(F.lit, x))
    how = resolving.outlet_match(c("title"), c("url"), words("the", "und"), words("of"), F.lit("example.org"))
    return rows.withColumns({"domain": resolving.registrable_domain(c("url")), "how": how}).groupBy("domain").agg(F.count("*").alias("rows"), F.count_if(c("how").isNull()).alias("noise"), F.count_if(c("how") == "title").alias("by_title"))


@plans.query("""
WITH h AS (SELECT user_id, list(DISTINCT event_type) AS hints FROM events GROUP BY 1)
SELECT user_id, CASE WHEN s1 >= s2 AND s1 >= 0.5 THEN 'buyer' WHEN s2 >= 0.5 THEN 'looker' END AS kind FROM (SELECT user_id, len(list_intersect(hints, ['purchase', 'signup', 'error'])) / len(hints) AS s1, len(list_intersect(hints, ['view', 'click'])) / len(hints) AS s2 FROM h)""")
def types_from_hints(spark: SparkSession, sf: str) -> DataFrame:
    hints = table(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("hints"))
    return hints.select("user_id", resolving.type_of_hints(c("hints"), {"buyer": ["purchase", "signup", "error"], "looker": ["view", "click"]}, 0.5).alias("kind"))


@plans.query("""
WITH m AS (SELECT p_name, p_type, count(*) AS n FROM part GROUP BY 1, 2), v AS (SELECT p_name, p_type AS voted, n FROM m QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY n DESC, p_type) = 1),
x AS (SELECT a.p_partkey, a.p_type AS old, b.p_type AS new, v.voted, v.n FROM part a LEFT JOIN part b ON b.p_partkey = a.p_partkey + 7 AND a.p_partkey % 5 <> 0 JOIN v ON v.p_name = a.p_name)
SELECT p_partkey, CASE WHEN old = new OR new IS NULL THEN old WHEN n >= 3 AND voted = new THEN new WHEN n >= 3 AND voted = old THEN old ELSE new END AS label,
 CASE WHEN old = new THEN 'same' WHEN new IS NULL THEN 'only one' WHEN n >= 3 AND voted = new THEN 'neighbours back the new' WHEN n >= 3 AND voted = old THEN 'neighbours back the old' ELSE 'newer' END AS why FROM x""")
def label_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """A part's type against that of another month (the part seven on), arbitrated by the types of parts of its name."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    later = part.select((c("p_partkey") - 7).alias("p_partkey"), c("p_type").alias("new")).filter(c("p_partkey") % 5 != 0)
    votes = choosing.modes(part, ["p_name"], "p_type").select("p_name", c("p_type").alias("voted"), "n")
    rows = part.join(later, "p_partkey", "left").join(votes, "p_name")
    return rows.select("p_partkey", resolving.arbitrated(c("p_type"), c("new"), c("voted"), c("n"), 3).alias("x")).select("p_partkey", "x.label", "x.why")


_SAID = "[upper(a), b || 's', a || 'es', 'no ' || a, a || '/' || b, 'odd & ' || b || 's', a || ' (fresh)', '(' || b || ')', NULL, a || ' ' || b]"


@plans.query(f"""
WITH w AS (SELECT p_partkey, string_split(p_name, ' ')[1] AS a, string_split(p_name, ' ')[2] AS b, p_size, p_name FROM part), v AS (SELECT DISTINCT lower(term) AS low, term FROM (SELECT a AS term FROM w WHERE a < 'm' UNION SELECT b FROM w UNION SELECT p_name FROM w WHERE p_size % 7 = 0)),
x AS (SELECT p_partkey, unnest(list_zip(range(1, 4), list_filter(range(1, 11), lambda i: (i + p_size) % 4 = 0 OR i = p_partkey % 10 + 1)[:3])) AS z, a, b FROM w),
s AS (SELECT p_partkey, z[1] AS pos, {_SAID}[z[2]] AS value FROM x WHERE z[1] IS NOT NULL AND z[2] IS NOT NULL),
f AS (SELECT p_partkey, pos, value, lower(trim(value)) AS low FROM s),
g AS (SELECT *, list_concat([low, CASE WHEN low LIKE '%es' THEN regexp_replace(low, 'es$', '') END, CASE WHEN low LIKE '%s' THEN regexp_replace(low, 's$', '') END],
  flatten(list_transform(regexp_split_to_array(low, '[/&,]'), lambda q: [trim(q), CASE WHEN trim(q) LIKE '%es' THEN regexp_replace(trim(q), 'es$', '') END, CASE WHEN trim(q) LIKE '%s' THEN regexp_replace(trim(q), 's$', '') END])), [trim(regexp_replace(low, '\\(.*?\\)', '', 'g'))]) AS forms FROM f),
h AS (SELECT p_partkey, pos, value, unnest(forms) AS form, unnest(range(1, len(forms) + 1)) AS k FROM g),
r AS (SELECT p_partkey, pos, any_value(value) AS value, arg_min(term, k) AS term FROM h LEFT JOIN v ON form = low GROUP BY 1, 2),
t AS (SELECT p_partkey, term, min(pos) AS pos FROM r WHERE term IS NOT NULL GROUP BY 1, 2),
d AS (SELECT s.p_partkey, count(*) FILTER (s.value IS NOT NULL AND r.term IS NULL) AS dropped FROM s LEFT JOIN r ON r.p_partkey = s.p_partkey AND r.pos = s.pos GROUP BY 1)
SELECT d.p_partkey, coalesce((SELECT string_agg(term, ',' ORDER BY pos) FROM t WHERE t.p_partkey = d.p_partkey), '') AS terms, dropped FROM d""".replace("\\\\", "\\").replace("arg_min(term, k)", "arg_min(term, CASE WHEN term IS NOT NULL THEN k END)"))
def conformed_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Three of ten ways to write a part's words, as terms of a vocabulary: capitals, plurals, parts of a slash, parentheses, unknown ones."""
    w = F.split("p_name", " ")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", w[0].alias("a"), w[1].alias("b"))
    both = lambda *x: F.concat(*[c(y) if y in ("a", "b") else F.lit(y) for y in x])
    said = F.array(F.upper("a"), both("b", "s"), both("a", "es"), both("no ", "a"), both("a", "/", "b"), both("odd & ", "b", "s"), both("a", " (fresh)"), both("(", "b", ")"), F.lit(None).cast("string"), both("a", " ", "b"))
    picks = F.slice(F.filter(F.sequence(F.lit(1), F.lit(10)), lambda i: ((i + c("p_size")) % 4 == 0) | (i == c("p_partkey") % 10 + 1)), 1, 3)
    rows = part.select("p_partkey", F.transform(picks, lambda i: F.element_at(said, i)).alias("terms"))
    vocabulary = part.filter("a < 'm'").select(c("a").alias("term")).union(part.select("b")).union(part.filter("p_size % 7 = 0").select("p_name"))
    out = phrases.recovered(rows, "p_partkey", "terms", vocabulary, "term")
    return out.select("p_partkey", F.array_join("terms", ",").alias("terms"), "dropped")


#: Customers as places: areas are nations, cities their regions; k picks what each source says.
_PLACED = """x AS (SELECT c_custkey, c_custkey AS k, n_name, r_name, (SELECT min(n_name) FROM nation m WHERE m.n_regionkey <> n.n_regionkey) AS other FROM customer JOIN nation n ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    other = nation.select(c("n_name").alias("o_name"), c("n_regionkey").alias("o_region"))
    first = nation.select("n_regionkey").distinct().join(F.broadcast(other), c("n_regionkey") != c("o_region")).groupBy("n_regionkey").agg(F.min("o_name").alias("other"))  # regions by nations, at most 125 rows
    rows = table(spark, sf, "customer").join(nation, c("c_nationkey") == c("n_nationkey")).join(region, c("n_regionkey") == c("r_regionkey")).join(first, "n_regionkey")
    return rows.select("c_custkey", c("c_custkey").alias("k"), "n_name", "r_name", "other")


_ARABIC = "دبي القديمة"


@plans.query(rf"""
WITH {_PLACED}, w AS (SELECT c_custkey, k % 5 = 0 AS verified, r_name AS city, n_name, CASE k % 7 WHEN 0 THEN r_name WHEN 1 THEN lower(n_name) WHEN 2 THEN 'Old ' || n_name WHEN 3 THEN '{_ARABIC}' WHEN 4 THEN other END AS page, CASE WHEN k % 3 = 0 THEN ' ' || n_name END AS slug,
  CASE WHEN k % 11 = 0 THEN upper(n_name) WHEN k % 11 = 1 THEN '' END AS cleaned, CASE k % 4 WHEN 0 THEN n_name WHEN 1 THEN r_name WHEN 2 THEN 'Nowhere' ELSE '{_ARABIC}' END AS current, 'Shop ' || k || ' - ' || CASE WHEN k % 2 = 0 THEN n_name ELSE other END || ', ' || r_name AS raw FROM x),
t AS (SELECT c_custkey, city, unnest(CASE WHEN verified THEN list_concat([{{'k': 0, 'method': 'current', 'value': current}}], list_transform(range(1, len(regexp_split_to_array(raw, '\s+-\s+|,')) + 1), lambda i: {{'k': i::INT, 'method': 'address', 'value': trim(regexp_split_to_array(raw, '\s+-\s+|,')[i])}}))
  ELSE [{{'k': 0, 'method': 'page', 'value': page}}, {{'k': 1, 'method': 'slug', 'value': slug}}, {{'k': 2, 'method': 'cleaned', 'value': cleaned}}, {{'k': 3, 'method': 'current', 'value': current}}] END) AS t FROM w),
f AS (SELECT c_custkey, t.k AS k, v.n_name AS area, t.method AS method, trim(t.value) AS value, regexp_matches(t.value, '[\\x{{0600}}-\\x{{06FF}}]') AS arabic FROM t LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) v ON lower(v.n_name) = lower(trim(t.value)) AND v.r_name = city
  WHERE trim(t.value) <> '' AND lower(trim(t.value)) NOT IN (SELECT lower(r_name) FROM region)),
b AS (SELECT c_custkey, arg_min(struct_pack(area := coalesce(area, value), method := CASE WHEN area IS NULL THEN 'page, not listed' ELSE method END), k) AS x FROM f WHERE area IS NOT NULL OR (method = 'page' AND NOT arabic) GROUP BY 1)
SELECT c_custkey, CASE WHEN x IS NOT NULL THEN x.area WHEN k % 4 = 2 THEN 'Nowhere' WHEN k % 4 = 0 THEN w.current END AS area, CASE WHEN x IS NOT NULL THEN x.method WHEN w.k % 4 IN (0, 2) THEN 'kept, not listed' ELSE 'none' END AS method FROM (SELECT *, c_custkey AS k FROM w) w LEFT JOIN b USING (c_custkey)""".replace("\\\\x", "\\x"))
def area_ladder(spark: SparkSession, sf: str) -> DataFrame:
    """Areas of customers by what page, slug, file, current value and address say of them."""
    x, k = _placed(spark, sf), c("k")
    page = F.when(k % 7 == 0, c("r_name")).when(k % 7 == 1, F.lower("n_name")).when(k % 7 == 2, F.concat(F.lit("Old "), "n_name")).when(k % 7 == 3, _ARABIC).when(k % 7 == 4, c("other"))
    current = F.when(k % 4 == 0, c("n_name")).when(k % 4 == 1, c("r_name")).when(k % 4 == 2, "Nowhere").otherwise(_ARABIC)
    raw = F.concat(F.lit("Shop "), k.cast("string"), F.lit(" - "), F.when(k % 2 == 0, c("n_name")).otherwise(c("other")), F.lit(", "), "r_name")
    rows = x.select("c_custkey", (k % 5 == 0).alias("verified"), c("r_name").alias("city"), page.alias("page"), F.when(k % 3 == 0, F.concat(F.lit(" "), "n_name")).alias("slug"), F.when(k % 11 == 0, F.upper("n_name")).when(k % 11 == 1, "").alias("cleaned"), current.alias("current"), raw.alias("raw"))
    vocabulary = x.select(c("n_name").alias("area"), c("r_name").alias("city")).distinct()
    return resolving.rectified_areas(rows, "c_custkey", vocabulary, ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])  # the regions


@plans.query(f"""
WITH {_PLACED}, w AS (SELECT c_custkey, CASE WHEN k % 13 = 0 THEN 1 ELSE k END AS source, CASE k % 6 WHEN 0 THEN n_name WHEN 1 THEN ' big ' || lower(n_name) WHEN 2 THEN 'Shop 9 - ' || n_name || ' - ' || r_name WHEN 3 THEN 'Shop 9, ' || other WHEN 4 THEN 'Green Valley Villas, 12' END AS raw, r_name AS city, n_name, k FROM x),
m AS (SELECT source, count(*) AS n FROM w GROUP BY 1), v AS (SELECT n_name AS area, r_name AS city FROM nation JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT w.*, CASE WHEN m.n = 1 AND k % 8 = 1 THEN CASE k % 3 WHEN 0 THEN n_name WHEN 1 THEN 'Newtown' ELSE 'Refused' END END AS page FROM w JOIN m USING (source))
SELECT c_custkey, CASE WHEN k % 17 = 0 THEN 'Answered' WHEN k % 19 = 0 AND source = k THEN 'Direct' WHEN page = 'Refused' THEN NULL WHEN page IS NOT NULL THEN page WHEN k % 6 IN (0, 1, 2) THEN n_name WHEN k % 6 = 4 THEN 'Green Valley Villas' END AS area,
 CASE WHEN k % 17 = 0 THEN 'answer' WHEN k % 19 = 0 AND source = k THEN 'direct' WHEN page = 'Refused' THEN 'unresolved: rejected' WHEN page = 'Newtown' THEN 'page, new' WHEN page IS NOT NULL THEN 'page' WHEN k % 6 = 0 THEN 'exact' WHEN k % 6 = 1 THEN 'cleaned' WHEN k % 6 = 2 THEN 'rules' WHEN k % 6 = 4 THEN 'candidate, new' WHEN k % 6 = 3 THEN 'unresolved: other city' ELSE 'unresolved: empty' END AS method FROM p""")
def resolved_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Areas of customers by eight methods, each present."""
    x, k = _placed(spark, sf), c("k")
    raw = F.when(k % 6 == 0, c("n_name")).when(k % 6 == 1, F.concat(F.lit(" big "), F.lower("n_name"))).when(k % 6 == 2, F.concat(F.lit("Shop 9 - "), "n_name", F.lit(" - "), "r_name")).when(k % 6 == 3, F.concat(F.lit("Shop 9, "), "other")).when(k % 6 == 4, "Green Valley Villas, 12")
    rows = x.select("c_custkey", F.when(k % 13 == 0, 1).otherwise(k).alias("source"), raw.alias("raw"), c("r_name").alias("city"), "n_name", "k")
    answers = rows.filter("k % 17 = 0").select("c_custkey", F.lit("Answered").alias("area"))
    direct = rows.filter("k % 19 = 0 and source = k").select("source", F.lit("Direct").alias("area"))
    named = rows.filter("k % 8 = 1").select("source", F.when(k % 3 == 0, c("n_name")).when(k % 3 == 1, "Newtown").otherwise("Refused").alias("area"))
    cleaned = x.select(F.concat(F.lit("Big "), "n_name").alias("raw"), c("n_name").alias("area")).distinct()
    vocabulary = x.select(c("n_name").alias("area"), c("r_name").alias("city")).distinct()
    rejected = spark.range(1).select(F.lit("Refused").alias("area"))
    return resolving.resolved_areas(rows, "c_custkey", vocabulary, answers, direct, named, cleaned, rejected)


@plans.query("""
WITH m AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2), w AS (SELECT c_mktsegment, c_nationkey FROM m QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY n DESC, c_nationkey) = 1)
SELECT lower(c_mktsegment) AS term, count(*) AS branches, any_value(w.c_nationkey) AS c_nationkey, lower(c_mktsegment) IN ('building', 'machinery') AS known_chain FROM customer JOIN w USING (c_mktsegment) GROUP BY 1, 4""")
def lookup_terms(spark: SparkSession, sf: str) -> DataFrame:
    known = spark.createDataFrame([("BUILDING",), ("Machinery",)], "term string")
    return resolving.search_terms(table(spark, sf, "customer"), t.item_key(c("c_mktsegment")), "c_nationkey", known)


@plans.query("""
WITH x AS (SELECT s_suppkey, s_nationkey AS was, CASE WHEN s_nationkey % 3 = 0 THEN s_suppkey WHEN s_nationkey % 3 = 1 THEN s_suppkey % 2 ELSE 0 END AS now FROM supplier), g AS (SELECT was, count(*) AS members, count(DISTINCT now) AS groups FROM x GROUP BY 1 HAVING count(*) > 1)
SELECT was, members, groups, CASE WHEN groups = members THEN 'fully' WHEN groups > 1 THEN 'partly' ELSE 'not' END AS verdict FROM g""")
def separation_test(spark: SparkSession, sf: str) -> DataFrame:
    before = table(spark, sf, "supplier").select("s_suppkey", c("s_nationkey").cast("long").alias("g"))
    after = before.withColumn("g", F.when(c("g") % 3 == 0, c("s_suppkey")).when(c("g") % 3 == 1, c("s_suppkey") % 2).otherwise(0))
    return resolving.separated(before, after, "s_suppkey", "g").withColumn("was", c("was").cast("int"))


@plans.query(f"""
WITH u AS ({_C}), s AS (SELECT s_suppkey, s_nationkey AS nation, {places_sql('s_suppkey', 0)} FROM supplier),
d AS (SELECT s_suppkey, c_mktsegment, c_custkey, sqrt(pow(s.lat - u.lat, 2) + pow(s.lon - u.lon, 2)) * 111 AS km FROM s, u WHERE sqrt(pow(s.lat - u.lat, 2) + pow(s.lon - u.lon, 2)) * 111 <= 15),
k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY km, c_custkey) <= 3), m AS (SELECT s_suppkey, c_mktsegment, count(*) AS n FROM k GROUP BY 1, 2),
v AS (SELECT s_suppkey, c_mktsegment AS vote FROM m QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY n DESC, c_mktsegment) = 1),
g AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, sum(count(*)) OVER (PARTITION BY c_nationkey) AS total FROM customer GROUP BY 1, 2),
t AS (SELECT c_nationkey AS nation, c_mktsegment AS main FROM g QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) = 1 AND total >= 3 AND n >= 0.2 * total),
x AS (SELECT s.s_suppkey, s.nation, p.c_mktsegment AS city, coalesce(vote = main AND p.c_mktsegment IS DISTINCT FROM vote, false) AS corrected, vote FROM s LEFT JOIN customer p ON p.c_custkey = s.s_suppkey LEFT JOIN v USING (s_suppkey) LEFT JOIN t USING (nation))
SELECT s_suppkey, nation, CASE WHEN corrected THEN vote ELSE city END AS city, corrected FROM x""")
def corrected_cities(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers' cities (segments, here; stated by the customer of the same number) against the vote of near customers and their nation's dominant one."""
    people = places(table(spark, sf, "customer"), "c_custkey", 13)
    shops = places(table(spark, sf, "supplier").select("s_suppkey", c("s_nationkey").alias("nation")), "s_suppkey", 0)
    vote = nearby.vote(shops, people, "s_suppkey", "c_custkey", "c_mktsegment", 3, 15.0)
    main = choosing.dominant(people.withColumnRenamed("c_nationkey", "nation"), ["nation"], "c_mktsegment", 3, 0.2)
    stated = shops.join(people.select(c("c_custkey").alias("s_suppkey"), c("c_mktsegment").alias("city")), "s_suppkey", "left")
    return resolving.corrected_city(stated, "s_suppkey", "city", vote, main, "nation", "c_mktsegment").select("s_suppkey", "nation", "city", "corrected")
