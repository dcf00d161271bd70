"""Entities on the test tables: even parts are records, odd ones known; each pair stands close together under like names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.functions import text as t
from lakeshed.operators import entities
from lakeshed.operators.similarity import levenshtein_score
from lakeshed.plans.base import METRES_SQL, Plans, table

plans = Plans()
c = F.col

_LISTED = """n AS (SELECT p_partkey // 2 AS half, min(p_name) AS pair FROM part GROUP BY 1),
l AS (SELECT p_partkey AS id, n.half, p_brand AS brand, p_size AS size, p_type AS type, pair,
  CASE WHEN p_partkey % 2 = 1 OR p_partkey % 8 = 0 THEN pair || ' house' WHEN p_partkey % 8 = 2 THEN pair || ' houses' WHEN p_partkey % 8 = 4 THEN pair || ' mill' ELSE p_name END AS name,
  25.0::DOUBLE + (n.half * 7919 % 40009 + (p_partkey % 5) * (p_partkey % 5) * 14)::DOUBLE / 100000.0::DOUBLE AS lat, CASE WHEN p_partkey % 17 <> 0 THEN 55.0::DOUBLE + (n.half * 6101 % 39989)::DOUBLE / 100000.0::DOUBLE END AS lon,
  CASE WHEN p_partkey % 12 = 0 THEN p_partkey + 1 WHEN p_partkey % 30 = 2 THEN p_partkey + 10000000 END AS link FROM part JOIN n ON p_partkey // 2 = n.half),
r AS (SELECT * FROM l WHERE id % 2 = 0), k AS (SELECT id AS known_id, name, lat, lon, type, brand FROM l WHERE id % 2 = 1)"""
_LEV = "(round(100 * (1 - levenshtein({a}, {b})::DOUBLE / greatest(len({a}), len({b}), 1)), 2) / 100)"
_FAR, _SIM = METRES_SQL.format(a="r", b="k"), _LEV.format(a="r.name", b="k.name")


def _listed(spark: SparkSession, sf: str) -> DataFrame:
    k = c("p_partkey")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", F.floor(k / 2).alias("half"))
    rows = part.join(part.groupBy("half").agg(F.min("p_name").alias("pair")).hint("merge"), "half")  # half as many rows as parts, however few bytes the file takes
    name = F.when((k % 2 == 1) | (k % 8 == 0), F.concat("pair", F.lit(" house"))).when(k % 8 == 2, F.concat("pair", F.lit(" houses"))).when(k % 8 == 4, F.concat("pair", F.lit(" mill"))).otherwise(c("p_name"))
    return rows.select(
        k.alias("id"), "half", c("p_brand").alias("brand"), c("p_size").alias("size"), c("p_type").alias("type"), "pair", name.alias("name"), (25.0 + (c("half") * 7919 % 40009 + (k % 5) * (k % 5) * 14) / 100000.0).alias("lat"),
        F.when(k % 17 != 0, 55.0 + c("half") * 6101 % 39989 / 100000.0).alias("lon"), F.when(k % 12 == 0, k + 1).when(k % 30 == 2, k + 10_000_000).alias("link"),
    )


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = _listed(spark, sf)
    return rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1").select(c("id").alias("known_id"), "name", "lat", "lon", "type", "brand")


@plans.query(f"""
WITH {_LISTED}, x AS (SELECT r.id, link AS known_id, CASE WHEN k.known_id IS NULL THEN 'linked id, unknown' ELSE 'linked id' END AS method, CASE WHEN k.known_id IS NULL THEN 0.95 ELSE 1.0 END::DOUBLE AS confidence,
  CASE WHEN k.known_id IS NULL THEN 'to be captured' WHEN r.lon IS NULL OR k.lon IS NULL THEN 'no place' WHEN {_FAR} > 500 THEN 'place differs' WHEN {_SIM} < 0.5 THEN 'name differs' ELSE 'agrees' END AS verified FROM r LEFT JOIN k ON link = k.known_id WHERE link IS NOT NULL),
g AS (SELECT r.id, k.known_id, {_FAR} AS m, {_SIM} AS s FROM r, k WHERE link IS NULL AND {_FAR} <= 200), h AS (SELECT *, CASE WHEN m <= 30 AND s >= 0.85 THEN 1 WHEN m <= 100 AND s >= 0.90 THEN 2 WHEN s >= 0.95 THEN 3 END AS t FROM g),
b AS (SELECT id, known_id, ['30 m', '100 m', '200 m'][t] AS method, [0.99, 0.95, 0.80][t]::DOUBLE AS confidence, ['agrees', 'agrees', 'to review'][t] AS verified FROM h WHERE t IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY m, s DESC, known_id) = 1)
SELECT r.id, u.known_id, coalesce(method, 'none') AS method, coalesce(confidence, 0.0::DOUBLE) AS confidence, verified FROM r LEFT JOIN (SELECT * FROM x UNION ALL SELECT * FROM b) u USING (id)""")
def entity_matches(spark: SparkSession, sf: str) -> DataFrame:
    records, known = _sides(spark, sf)
    return entities.entity_matches(records, known, "id", "known_id", "link", "name", levenshtein_score)


@plans.query(f"""
WITH {_LISTED}, g AS (SELECT r.id, k.known_id, k.type, k.brand, r.name = k.name AS same, {_FAR} AS m, {_SIM} AS s FROM r, k WHERE {_FAR} <= 100),
h AS (SELECT *, CASE WHEN m <= 30 AND s >= 0.85 THEN '30 m' WHEN m <= 50 AND same THEN '50 m, same name' WHEN s >= 0.90 THEN '100 m' END AS method FROM g)
SELECT id, known_id, method, CASE WHEN method = '30 m' THEN 0.99 ELSE 0.95 END::DOUBLE AS confidence, type, brand FROM h WHERE method IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY method = '100 m', m, known_id) = 1""")
def transferred_labels(spark: SparkSession, sf: str) -> DataFrame:
    records, known = _sides(spark, sf)
    return entities.transferred(records.drop("type", "brand"), known, "id", "known_id", "name", ["type", "brand"], levenshtein_score)


@plans.query(f"""
WITH {_LISTED}, g AS (SELECT r.id, k.known_id, {_FAR} AS m, {_SIM} * 100 AS score FROM r, k WHERE {_FAR} <= 100 QUALIFY row_number() OVER (PARTITION BY r.id ORDER BY {_FAR}, k.known_id) <= 5),
b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, m, known_id) = 1)
SELECT r.id, known_id, round(score, 6) AS score, CASE WHEN score >= 60 THEN 'Matched' WHEN score >= 45 THEN 'Review' ELSE 'New' END AS verdict FROM r LEFT JOIN b USING (id)""")
def nearest_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    records, known = _sides(spark, sf)
    return entities.nearest_verdicts(records, known, "id", "known_id", "name", score=levenshtein_score).withColumn("score", F.round("score", 6))


@plans.query("""
WITH m AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2), b AS (SELECT p_brand, p_size AS canonical FROM m QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) = 1)
SELECT p_partkey, p_brand, p_size, canonical FROM part JOIN b USING (p_brand) WHERE p_size <> canonical""")
def brand_dissenters(spark: SparkSession, sf: str) -> DataFrame:
    return entities.brand_ids(table(spark, sf, "part").select("p_partkey", "p_brand", "p_size"), "p_brand", "p_size")[1]


@plans.query(f"""
WITH {_LISTED}, g AS (SELECT r.id, k.known_id, {_FAR} AS m FROM r JOIN k ON r.brand = k.brand WHERE {_FAR} <= 400 QUALIFY row_number() OVER (PARTITION BY r.id ORDER BY {_FAR}, k.known_id) = 1)
SELECT known_id, round(min(m), 3) AS distance FROM g GROUP BY 1""")
def listing_distances(spark: SparkSession, sf: str) -> DataFrame:
    records, known = _sides(spark, sf)
    return entities.listing_distances(known, records, "known_id", "id", "brand", 400.0).withColumn("distance", F.round("distance", 3))


_RESULTS = f"""{_LISTED}, f AS (SELECT half, id, CASE half % 5 WHEN 0 THEN pair || ' & Sons' WHEN 1 THEN 'Al ' || pair WHEN 2 THEN 'Old ' || pair WHEN 3 THEN replace(pair, ' ', ' and ') ELSE 'مطعم' END AS title, pair AS asked,
  CASE WHEN half % 7 = 0 THEN 25.5::DOUBLE ELSE lat END AS lat, CASE WHEN half % 7 = 0 THEN 55.5::DOUBLE ELSE lon END AS lon, CASE WHEN half % 11 = 0 THEN 'Muscat, Oman' ELSE brand END AS address FROM l WHERE id % 3 <> 0),
a AS (SELECT half, count(*) = 1 AS alone FROM f GROUP BY 1), kept AS (SELECT f.* FROM f JOIN a USING (half) WHERE address NOT LIKE '%Oman%' AND coalesce(lat BETWEEN 25.01 AND 25.39 AND lon BETWEEN 55.0 AND 55.4 OR half % 7 = 0, true) AND (half % 5 IN (0, 1) OR (half % 5 = 4 AND alone))),
o AS (SELECT * FROM kept WHERE lat IS NULL OR lon IS NULL UNION ALL (SELECT * FROM kept WHERE lat IS NOT NULL AND lon IS NOT NULL QUALIFY row_number() OVER (PARTITION BY half, round(lat, 4), round(lon, 4) ORDER BY id) = 1))"""


def _branches(spark: SparkSession, sf: str) -> DataFrame:
    """Search results for the names of pairs: with what follows, with an article, with a word before, with ``and``, in another script."""
    half = c("half")
    title = F.when(half % 5 == 0, F.concat("pair", F.lit(" & Sons"))).when(half % 5 == 1, F.concat(F.lit("Al "), "pair")).when(half % 5 == 2, F.concat(F.lit("Old "), "pair")).when(half % 5 == 3, F.replace("pair", F.lit(" "), F.lit(" and "))).otherwise("مطعم")
    from lakeshed.operators.records import in_country

    rows = _listed(spark, sf).filter("id % 3 <> 0").select(
        "half", "id", title.alias("title"), c("pair").alias("asked"), F.when(half % 7 == 0, 25.5).otherwise(c("lat")).alias("lat"), F.when(half % 7 == 0, 55.5).otherwise(c("lon")).alias("lon"), F.when(half % 11 == 0, "Muscat, Oman").otherwise(c("brand")).alias("address")
    )
    inside = (half % 7 == 0) | in_country(c("lat"), c("lon"), c("address"), (25.01, 25.39, 55.0, 55.4), "oman")
    return entities.places_of_brands(rows, "half", "asked", "title", inside & ~F.contains("address", F.lit("Oman")), [F.asc("id")])


@plans.query(f"WITH {_RESULTS} SELECT half, id, title FROM o")
def places_of_brands(spark: SparkSession, sf: str) -> DataFrame:
    return _branches(spark, sf).select("half", "id", "title")


@plans.query(f"WITH {_RESULTS} SELECT half, count(*) AS places, CASE WHEN bool_or(half % 9 = 0) THEN 'Global Chain' WHEN count(*) >= 2 THEN 'Local Chain' ELSE 'Independent' END AS type FROM o GROUP BY 1")
def brand_types(spark: SparkSession, sf: str) -> DataFrame:
    return entities.brand_types(_branches(spark, sf), "half", c("half") % 9 == 0)


_TITLES = ("{p} house", "house {p}", "{p} hose", "the old {p} house", "{p}", "{b}", "Main {p} House Cafe", "New-{p} house", "Pláte & {p} - Dubai", "Z {p} house", "{p} and house, Deira", "zaki")
_GENERIC_SQL = "|".join(w for w in entities.GENERIC if "." not in w)


def _core_sql(x: str) -> str:
    words = rf"array_to_string(regexp_extract_all(lower(regexp_split_to_array({x}, '\s+-\s+|,|\||\(')[1]), '[\p{{L}}\p{{N}}_''&]+'), ' ')"
    return rf"regexp_replace(regexp_replace(regexp_replace({words}, '(?:(?:^| )(?:{_GENERIC_SQL}))+$', ''), '^(?:the(?: |$))+', ''), '[^a-z0-9]', '', 'g')"


def _words_sql(x: str, dropped: tuple[str, ...]) -> str:
    plain = rf"regexp_replace(lower(regexp_split_to_array(regexp_replace(strip_accents({x}), '[^\x00-\x7F]+', ' ', 'g'), '\s+-\s+|,|\||\(')[1]), '\babu\s*dhabi\b', ' abudhabi ', 'g')"
    return f"list_filter(regexp_extract_all({plain}, '[a-z0-9]+'), lambda w: NOT list_contains({list(dropped)}, w))"


_BEGINS = "(len({a}) >= 4 AND len({b}) >= 4 AND (starts_with({a}, {b}) OR starts_with({b}, {a})))"


@plans.query(f"""
WITH {_LISTED}, f AS (SELECT half, replace(replace({list(_TITLES)}[half % {len(_TITLES)} + 1], '{{p}}', pair), '{{b}}', brand) AS title, lat + (half % 4)::DOUBLE / 1000.0::DOUBLE AS lat, lon FROM l WHERE id % 2 = 1 AND id % 10 <> 1),
p AS (SELECT r.id, r.name, k.title, CASE WHEN r.lon IS NOT NULL AND k.lon IS NOT NULL THEN {_FAR} END AS m FROM r LEFT JOIN f k ON r.half = k.half),
w AS (SELECT *, {_words_sql('name', entities.DROPPED)} AS a, {_words_sql('title', entities.DROPPED)} AS b, {_words_sql('name', ('and',))} AS ka, {_words_sql('title', ('and',))} AS kb,
  regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS ca, regexp_replace(lower(title), '[^a-z0-9]', '', 'g') AS cb, {_core_sql('name')} AS oa, {_core_sql('title')} AS ob FROM p),
j AS (SELECT *, array_to_string(a, '') AS x, array_to_string(b, '') AS y FROM w),
q AS (SELECT *, len(x) <= len(y) AS ours, CASE WHEN len(x) <= len(y) THEN x ELSE y END AS sj, CASE WHEN len(x) <= len(y) THEN y ELSE x END AS lj, CASE WHEN len(x) <= len(y) THEN a ELSE b END AS s, CASE WHEN len(x) <= len(y) THEN b ELSE a END AS lo FROM j),
u AS (SELECT *, list_filter(range(1, len(lo) + 1), lambda i: len(list_filter(range(i, len(lo) + 1), lambda j: array_to_string(lo[i:j], '') = sj)) > 0) AS run FROM q),
z AS (SELECT *, CASE WHEN title IS NULL THEN false ELSE {_BEGINS.format(a='ca', b='cb')} OR {_BEGINS.format(a='oa', b='ob')} OR (x <> '' AND y <> '' AND ((len(x) >= 3 AND ka = kb)
  OR (len(list_filter(s, lambda v: NOT list_contains({list(entities.FOOD_WORDS)}, v))) > 0 AND CASE WHEN x = y THEN len(x) >= 3 ELSE ((len(s) >= 2 OR len(sj) >= 7) AND starts_with(lj, sj)) OR (len(s) >= 2 AND list_sort(a) = list_sort(b))
   OR ((least(len(a), len(b)) >= 2 OR len(sj) >= 8) AND len(sj) >= 6 AND {_LEV.format(a='x', b='y')} * 100 >= 88)
   OR (len(s) >= 2 AND len(sj) >= 8 AND len(run) > 0 AND (NOT ours OR len(list_filter(lo[:run[1] - 1], lambda v: NOT list_contains({list(entities.LEADING)}, v))) = 0)) END))) END AS same FROM u),
e AS (SELECT id, count(title) AS n, min(CASE WHEN same THEN m END) AS metres, min(CASE WHEN same AND m IS NOT NULL THEN title END) AS title FROM z GROUP BY 1)
SELECT id, CASE WHEN metres <= 300 THEN 'found' WHEN metres IS NOT NULL THEN 'brand only elsewhere' WHEN n > 0 THEN 'no such brand' ELSE 'nothing found' END AS verdict, CASE WHEN metres <= 300 THEN title END AS title, round(metres, 3) AS metres FROM e""")
def branch_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    half = c("half")
    title = F.replace(F.replace(F.element_at(F.array(*map(F.lit, _TITLES)), (half % len(_TITLES) + 1).cast("int")), F.lit("{p}"), c("pair")), F.lit("{b}"), c("brand"))
    rows = _listed(spark, sf)
    found = rows.filter("id % 2 = 1 and id % 10 <> 1").select("half", title.alias("title"), (c("lat") + half % 4 / 1000.0).alias("place_lat"), c("lon").alias("place_lon"))
    branches = rows.filter("id % 2 = 0")
    found = branches.select("id", "half").join(found, "half").drop("half")
    same = lambda a, b: entities.same_brand(a, b, score=levenshtein_score)
    return entities.branch_verdicts(branches, found, "id", "name", "title", same=same).withColumn("metres", F.round("metres", 3))


@plans.query("""
WITH x AS (SELECT c_custkey, c_nationkey AS chain, c_mktsegment || c_custkey % 7 AS brand FROM customer), b AS (SELECT * FROM x WHERE c_custkey % 3 = 0 AND chain < 9 AND brand NOT LIKE '%4'), s AS (SELECT * FROM x WHERE c_custkey % 3 = 1 AND chain BETWEEN 5 AND 15 AND brand NOT LIKE '%5')
SELECT c_custkey, chain, brand, CASE WHEN chain IN (SELECT chain FROM b) THEN 'branch of known chain' WHEN brand IN (SELECT brand FROM b WHERE brand LIKE 'B%') THEN 'known brand, new chain' WHEN chain IN (SELECT chain FROM s) OR brand IN (SELECT brand FROM s WHERE brand LIKE 'F%') THEN 'found before' ELSE 'new brand' END AS found_as FROM x WHERE c_custkey % 3 = 2""")
def identity_class(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", c("c_nationkey").alias("chain"), F.concat("c_mktsegment", (c("c_custkey") % 7).cast("string")).alias("brand"))
    named = lambda df, letter: df.withColumn("brand", F.when(F.startswith("brand", F.lit(letter)), c("brand")))
    before = named(rows.filter("c_custkey % 3 = 0 and chain < 9 and brand not like '%4'"), "B")
    since = named(rows.filter("c_custkey % 3 = 1 and chain between 5 and 15 and brand not like '%5'"), "F")
    return entities.identity_class(rows.filter("c_custkey % 3 = 2"), before, since, "chain", "brand")


@plans.query("""
SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN c_name ELSE 'order ' || o_orderkey END AS name, c_mktsegment AS segment, c_custkey IS NOT NULL AS known, l_returnflag AS menu_category, l_partkey AS item, l_extendedprice AS price
FROM orders JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 <> 0) ON o_custkey = c_custkey""")
def flattened_menus(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as captures: lines by flag as menu sections, customers as the restaurants' table."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", c("l_returnflag").alias("category_name")).agg(F.collect_list(F.struct(c("l_partkey").alias("item"), c("l_extendedprice").alias("price"))).alias("items"))
    menus = lines.groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct("category_name", "items")).alias("menu"))
    orders = table(spark, sf, "orders").select("o_orderkey", c("o_custkey").alias("c_custkey"), F.struct(F.concat(F.lit("order "), c("o_orderkey").cast("string")).alias("name")).alias("restaurant"))
    told = table(spark, sf, "customer").filter("c_custkey % 4 <> 0").select("c_custkey", c("c_name").alias("name"), c("c_mktsegment").alias("segment"))
    return entities.flattened_menus(menus.join(orders, "o_orderkey").select("c_custkey", "restaurant", F.transform("menu", lambda m: F.struct(m["category_name"].alias("category_name"), F.transform(m["items"], lambda i: F.struct(c("o_orderkey").alias("o_orderkey"), i["item"].alias("item"), i["price"].alias("price"))).alias("items"))).alias("menu")), told, "c_custkey", ["name", "segment"]).drop("c_custkey")


_HEADS, _TAILS, _GOODS, _FOOD = ("ring", "rod", "bolt"), ("red", "blue", "small", "large"), r"\b(ring|plate|steel)\b", r"\b(hot|green)\b"


@plans.query(f"""
WITH x AS (SELECT p_partkey, p_name, p_size, CASE WHEN p_size % 9 = 0 THEN p_name WHEN p_size % 5 = 0 THEN p_type END AS said, CASE p_partkey % 10 WHEN 0 THEN 'Steel ' || p_brand WHEN 1 THEN 'Only ' || string_split(p_name, ' ')[-1] ELSE p_brand END AS section, list_filter(string_split(p_name, ' '), lambda w: w NOT IN {_TAILS}) AS plain FROM part),
h AS (SELECT *, coalesce(plain[-1], string_split(p_name, ' ')[1]) IN {_HEADS} AS head, regexp_matches(p_name, '{_GOODS}') AS named FROM x), v AS (SELECT section, CASE WHEN count(*) >= 5 THEN avg((p_size % 6 <> 1 AND p_partkey % 10 = 1)::INT) ELSE 0 END AS share FROM h GROUP BY 1),
e AS (SELECT h.*, share, coalesce(regexp_matches(lower(said), '{_GOODS}'), false) AS ns, coalesce(regexp_matches(lower(said), '{_FOOD}'), false) AS fs, regexp_matches(p_name, '{_FOOD}') OR regexp_matches(lower(section), '{_FOOD}') AS fn, regexp_matches(lower(section), '{_GOODS}') AS sn FROM h JOIN v USING (section))
SELECT p_partkey, CASE WHEN fs OR (NOT head AND fn) THEN NULL WHEN (head OR named) AND (sn OR share >= 0.8) THEN 'A' WHEN (head OR named)::INT + ns::INT + sn::INT >= 2 THEN 'B' WHEN head AND NOT fn THEN 'C' END AS tier FROM e""")
def non_food_tiers(spark: SparkSession, sf: str) -> DataFrame:
    said = F.when(c("p_size") % 9 == 0, c("p_name")).when(c("p_size") % 5 == 0, c("p_type"))
    section = F.when(c("p_partkey") % 10 == 0, F.concat(F.lit("Steel "), "p_brand")).when(c("p_partkey") % 10 == 1, F.concat(F.lit("Only "), F.element_at(F.split("p_name", " "), -1))).otherwise(c("p_brand"))
    labelled = (c("p_size") % 6 != 1) & (c("p_partkey") % 10 == 1)  # what a reviewer said of the item
    rows = table(spark, sf, "part").select("p_partkey", "p_name", labelled.alias("labelled"), said.alias("said"), section.alias("section"))
    return entities.non_food(rows, "p_name", "said", "section", c("labelled"), _HEADS, _TAILS, _GOODS, _FOOD).select("p_partkey", "tier")


@plans.query(f"""
WITH x AS (SELECT p_partkey, p_brand AS chain, CASE WHEN p_size % 4 <> 0 THEN p_type END AS area, CASE WHEN p_size % 3 = 0 THEN p_type || ' - 1' ELSE ' ' || upper(p_type) END AS raw, 25.0::DOUBLE + (p_partkey * 7919 % 4001)::DOUBLE / 10000.0::DOUBLE AS lat, 55.0::DOUBLE + (p_partkey * 6101 % 3989)::DOUBLE / 10000.0::DOUBLE AS lon FROM part),
g AS (SELECT *, lower(area) AS k FROM x WHERE lower(trim(raw)) = lower(area)), d AS (SELECT DISTINCT chain, k FROM g WHERE p_partkey % 101 = 0), s AS (SELECT a.chain, a.k, max({METRES_SQL.format(a='a', b='b')}) AS spread FROM g a JOIN g b ON a.chain = b.chain AND a.k = b.k GROUP BY 1, 2)
SELECT p_partkey, round(spread, 2) AS spread FROM g JOIN s USING (chain, k) WHERE spread > 1000 AND NOT EXISTS (SELECT 1 FROM d WHERE d.chain = g.chain AND d.k = g.k)""")
def area_smears(spark: SparkSession, sf: str) -> DataFrame:
    from lakeshed.plans.base import places

    raw = F.when(c("p_size") % 3 == 0, F.concat("p_type", F.lit(" - 1"))).otherwise(F.concat(F.lit(" "), F.upper("p_type")))
    rows = places(table(spark, sf, "part").select("p_partkey", c("p_brand").alias("chain"), F.when(c("p_size") % 4 != 0, c("p_type")).alias("area"), raw.alias("raw")), "p_partkey", 0)
    return entities.area_smears(rows, "p_partkey", "chain", "raw", "area", done=rows.filter("p_partkey % 101 = 0")).withColumn("spread", F.round("spread", 2))


@plans.query("""
WITH v AS (SELECT n_name AS area, n_nationkey, CASE WHEN n_nationkey % 3 <> 0 THEN r_name END AS city FROM nation JOIN region ON n_regionkey = r_regionkey),
x AS (SELECT s_suppkey, n_nationkey, area, CASE WHEN s_suppkey % 4 <> 0 THEN city END AS said_city, city AS own, s_suppkey % 7 AS form FROM supplier JOIN v ON s_nationkey = n_nationkey),
y AS (SELECT *, CASE WHEN s_suppkey % 9 = 0 AND said_city IS NOT NULL THEN 'Elsewhere' ELSE said_city END AS city FROM x), z AS (SELECT *, own IS NULL OR city IS NULL OR city = own AS ok FROM y)
SELECT s_suppkey, CASE form WHEN 0 THEN NULL WHEN 1 THEN area WHEN 2 THEN CASE WHEN ok THEN area ELSE 'Old ' || area END WHEN 3 THEN 'Green Quarter' WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE CASE WHEN ok THEN area ELSE lower(area) END END AS area,
 CASE form WHEN 0 THEN 'empty' WHEN 1 THEN CASE WHEN ok THEN 'exact' ELSE 'candidate' END WHEN 2 THEN CASE WHEN ok THEN 'part' ELSE 'candidate' END WHEN 3 THEN 'candidate' WHEN 4 THEN 'nothing left' WHEN 5 THEN 'no area' ELSE CASE WHEN ok THEN 'part' ELSE 'candidate' END END AS method FROM z""")
def ruled_areas(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    v = nation.join(region, c("n_regionkey") == c("r_regionkey")).select("n_nationkey", c("n_name").alias("area"), F.when(c("n_nationkey") % 3 != 0, c("r_name")).alias("city"))
    k = c("s_suppkey")
    said = (
        F.when(k % 7 == 0, " ").when(k % 7 == 1, c("area")).when(k % 7 == 2, F.concat(F.lit("Old "), "area", F.lit(" - "), "area", F.lit(", UAE"))).when(k % 7 == 3, "12 - Green Quarter - Shop 4")
        .when(k % 7 == 4, "GCQG+62J, UAE, b12").when(k % 7 == 5, "near the old tower").otherwise(F.concat(F.lit("Near Bay Street, "), F.lower("area")))
    )
    city = F.when(k % 4 != 0, c("city"))
    rows = table(spark, sf, "supplier").join(v, c("s_nationkey") == c("n_nationkey")).select("s_suppkey", said.alias("raw"), F.when((k % 9 == 0) & city.isNotNull(), "Elsewhere").otherwise(city).alias("city"))
    return entities.ruled_area(rows, "s_suppkey", "raw", "city", v.select("area", "city"))


@plans.query("""
WITH x AS (SELECT c_nationkey AS area, c_mktsegment AS city FROM customer WHERE c_custkey % 5 = 0 OR c_mktsegment <> 'BUILDING' OR c_nationkey % 2 = 0), y AS (SELECT area, city, count(*) AS n FROM x GROUP BY 1, 2), z AS (SELECT area, sum(n) AS total FROM y GROUP BY 1)
SELECT area, city, n FROM y JOIN z USING (area) WHERE total >= 10 AND n < 0.12::DOUBLE * total""")
def city_leaks(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").filter("c_custkey % 5 = 0 or c_mktsegment <> 'BUILDING' or c_nationkey % 2 = 0").select(c("c_nationkey").alias("area"), c("c_mktsegment").alias("city"))
    return entities.city_leaks(rows, "area", "city", 10, 0.12).groupBy("area", "city").agg(F.count("*").alias("n"))


_GATED = """x AS (SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN 'dubai' WHEN p_partkey % 53 = 0 THEN 'ديرة' WHEN p_partkey % 9 = 0 THEN lower(p_type) ELSE p_type END AS area, CASE WHEN p_size % 40 = 0 THEN 'Ajman' ELSE 'Dubai' END AS city, p_brand AS chain,
 CASE WHEN p_partkey % 6 = 0 THEN 'm' || p_partkey // 12 END AS link, 25.0::DOUBLE + (p_partkey * 7919 % 4001)::DOUBLE / 10000.0::DOUBLE AS lat, 55.0::DOUBLE + (p_partkey * 6101 % 3989)::DOUBLE / 10000.0::DOUBLE AS lon FROM part)"""


def _apart(keys: str) -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    return f"(SELECT count(*) FROM (SELECT {', '.join('a.' + k for k in keys.split(', '))} FROM x a JOIN x b ON {on} GROUP BY {', '.join(str(i + 1) for i in range(len(keys.split(', '))))} HAVING max({METRES_SQL.format(a='a', b='b')}) > 1000))"


@plans.query(f"""
WITH {_GATED}, y AS (SELECT area, city, count(*) AS n FROM x GROUP BY 1, 2), z AS (SELECT area, sum(n) AS total FROM y GROUP BY 1)
SELECT 'city as area' AS gate, count(*) AS found FROM x WHERE area = 'dubai' UNION ALL SELECT 'spelling twins', count(*) FROM (SELECT lower(area) FROM x WHERE regexp_replace(lower(area), '[^a-z0-9]', '', 'g') <> '' GROUP BY regexp_replace(lower(area), '[^a-z0-9]', '', 'g'), lower(area) HAVING count(DISTINCT area) > 1)
UNION ALL SELECT 'area in Arabic', count(*) FROM x WHERE area = 'ديرة' UNION ALL SELECT 'city leaks', coalesce(sum(n), 0)::BIGINT FROM y JOIN z USING (area) WHERE total >= 10 AND n < 0.05::DOUBLE * total
UNION ALL SELECT 'chain and area apart', {_apart('chain, area')} UNION ALL SELECT 'link apart', {_apart('link')}""")
def cross_gates(spark: SparkSession, sf: str) -> DataFrame:
    from lakeshed.plans.base import places

    k = c("p_partkey")
    area = F.when(k % 50 == 0, "dubai").when(k % 53 == 0, "ديرة").when(k % 9 == 0, F.lower("p_type")).otherwise(c("p_type"))
    link = F.when(k % 6 == 0, F.concat(F.lit("m"), F.floor(k / 12).cast("string")))
    rows = table(spark, sf, "part").select("p_partkey", area.alias("area"), F.when(c("p_size") % 40 == 0, "Ajman").otherwise("Dubai").alias("city"), c("p_brand").alias("chain"), link.alias("link"))
    return entities.cross_gates(places(rows, "p_partkey", 0), "p_partkey", ["Dubai", "Ajman"], ["link"])


@plans.query("""
WITH x AS (SELECT c_nationkey AS area, count(*) AS listings, round(avg(CASE WHEN c_acctbal > 3000 THEN 1.0 ELSE 0.0 END), 4) AS r, count(*) // 10 AS pages, count(*) // 10 - c_nationkey % 4 AS done FROM customer GROUP BY 1),
y AS (SELECT *, CASE WHEN area % 6 <> 0 THEN r ELSE 0 END AS rate, CASE WHEN area % 5 <> 0 THEN done ELSE 0 END AS d FROM x)
SELECT area, pages - d AS pages_left, round(listings * rate)::BIGINT AS expected, round(listings * rate / greatest(pages - d, 1), 2) AS efficiency FROM y WHERE pages > 0 AND d < pages * 0.95::DOUBLE""")
def area_priorities(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").groupBy(c("c_nationkey").alias("area")).agg(F.count("*").alias("listings"), F.round(F.avg(F.when(c("c_acctbal") > 3000, 1.0).otherwise(0.0)), 4).alias("rate"))
    pages = F.floor(c("listings") / 10)
    return entities.area_priorities(rows.select("area", "listings", F.when(c("area") % 6 != 0, c("rate")).alias("new_rate"), pages.alias("pages"), F.when(c("area") % 5 != 0, pages - c("area") % 4).alias("pages_done")))


@plans.query("""
WITH b AS (SELECT o_custkey AS zone, count(*) AS n FROM orders WHERE o_orderkey % 8 <> 0 GROUP BY 1), a AS (SELECT o_custkey AS zone, count(*) AS n FROM orders GROUP BY 1)
SELECT zone, CASE WHEN b.n IS NULL THEN 'no baseline' WHEN a.n <> b.n THEN 'changed' ELSE 'unchanged' END AS status, a.n - b.n AS delta FROM a LEFT JOIN b USING (zone)""")
def zone_changes(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(c("o_custkey").alias("zone"), "o_orderkey")
    total = lambda df: df.groupBy("zone").agg(F.count("*").alias("total"))
    return entities.zone_changes(total(orders.filter("o_orderkey % 8 <> 0")), total(orders), "zone", "total")


@plans.query()
def items_matched(spark: SparkSession, sf: str) -> DataFrame:
    """Names of even parts against those of odd ones of the same brand."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand", c("p_name").alias("name"))
    return entities.items_matched(part.filter("p_partkey % 2 = 0"), part.filter("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "other"), "p_brand", "p_partkey", "other", "name")


_ADDRESSES = (
    "Al Ain, United Arab Emirates", "Kalba", "Deira, Dubai", "Khalifa City, abu dhabi", "Muscat", "Dubai Road - Al Majaz - Sharjah", "Al Ain Street, Deira, Dubai", "Abu Dhabi Gate, Ajman", "Al Ain Society - Abu Dhabi",
    "Al Ain Road - Abu Dhabi - U.A.E.", "Shop 3, Ras Al-Khaimah", "khorfakkan beach - Sharjah", "Umm al Qaiwain - UAE", "Old Fujairah Fort", "Kalba corniche, Sharjah, UAE", "", "a, b, Dubai, c, d, e, f, g, h", "al ain hwy only",
)
_LOW = [x.lower() for x in t.CITIES]


def _replaced(x: str, pairs: list[tuple[str, str]]) -> str:
    for pattern, to in pairs:
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return x


@plans.query(f"""
WITH a AS (SELECT p_partkey, p_name, p_type, p_brand, CASE WHEN p_partkey % 11 <> 0 THEN p_brand || ' ' || {list(_ADDRESSES)}[p_partkey % {len(_ADDRESSES)} + 1] WHEN p_partkey % 2 = 0 THEN {list(_ADDRESSES)}[p_partkey % {len(_ADDRESSES)} + 1] END AS x FROM part),
n AS (SELECT *, {_replaced("coalesce(x, '')", [(chr(92).join(["(", "w)-(", "w)"]), r"\1 \2")] * 2 + [("(?i)" + f, to) for f, to in t.CITY_FORMS])} AS said FROM a),
b AS (SELECT *, trim({_replaced("said", [("(?i)" + t.COUNTRY_END, "")])}, ', -') AS bare, {_replaced("said", [("(?i)" + t.CITY_ROADS, " ")])} AS scrubbed FROM n),
s AS (SELECT *, list_filter(list_transform(regexp_split_to_array(bare, '\\s*[-,]\\s*'), lambda y: trim(y)), lambda y: y <> '')[-6:] AS tail FROM b),
k AS (SELECT *, coalesce(list_max(list_transform(range(1, len(tail) + 1), lambda i: CASE WHEN list_contains({_LOW}, lower(tail[i])) THEN i ELSE 0 END)), 0) AS pos FROM s),
c AS (SELECT *, CASE WHEN pos > 0 THEN {list(t.CITIES)}[list_position({_LOW}, lower(tail[pos]))] END AS city, {_replaced("array_to_string(tail[:pos - 1], ' ')", [("(?i)" + t.CITY_ROADS, "")])} AS before_ FROM k)
SELECT p_partkey, coalesce({', '.join(f"CASE WHEN city = '{y}' AND pos > 1 AND regexp_matches(before_, '(?i){z}') THEN '{town}' END" for y, town, z in t.TOWNS)}, city, {', '.join(f"CASE WHEN regexp_matches(scrubbed, '(?i){chr(92)}b{y}{chr(92)}b') THEN '{y}' END" for y in t.CITIES)}, 'Unknown') AS emirate,
 contains(p_name, 'hot') AS popular, lower(trim(p_type)) <> lower(trim(p_brand)) AS beyond FROM c""".replace("\\\\s", "\\s"))
def emirates(spark: SparkSession, sf: str) -> DataFrame:
    k = c("p_partkey")
    said = F.element_at(F.array(*map(F.lit, _ADDRESSES)), (k % len(_ADDRESSES) + 1).cast("int"))
    address = F.when(k % 11 != 0, F.concat_ws(" ", "p_brand", said)).when(k % 2 == 0, said)
    section = F.when(F.contains("p_name", F.lit("hot")), F.concat(F.lit("Most POPULAR "), "p_name")).otherwise(c("p_name"))
    return table(spark, sf, "part").select("p_partkey", t.emirate(address).alias("emirate"), t.popular(section).alias("popular"), entities.beyond_area(c("p_type"), c("p_brand")).alias("beyond"))
