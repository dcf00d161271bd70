"""Geography, fuzzy matching, neighbours and tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshed.functions.values import metres
from lakeshed.operators import choosing, nearby, quantiles, similarity, tfidf, tiers
from lakeshed.plans.base import METRES_SQL, Plans, places, places_sql, table

plans = Plans()
c = F.col

_S = f"SELECT s_suppkey, s_nationkey, {places_sql('s_suppkey', 0)} FROM supplier"
_C = f"SELECT c_custkey, c_nationkey, c_mktsegment, {places_sql('c_custkey', 13)} FROM customer"


def _suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return places(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey", 0)


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return places(table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey", 13)


@plans.query(f"WITH s AS ({_S}), u AS ({_C}) SELECT s_suppkey, c_custkey, round({METRES_SQL.format(a='s', b='u')}, 3) AS distance FROM s, u WHERE {METRES_SQL.format(a='s', b='u')} <= 800")
def radius_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = nearby.within(_suppliers(spark, sf), _customers(spark, sf), "s_suppkey", "c_custkey", 800.0)
    return rows.withColumn("distance", F.round("distance", 3))


@plans.query(f"""
WITH s AS ({_S}), u AS ({_C}) SELECT c_custkey, s_suppkey, round({METRES_SQL.format(a='u', b='s')}, 3) AS distance FROM u JOIN s ON s_nationkey = c_nationkey WHERE {METRES_SQL.format(a='u', b='s')} <= 5000
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY {METRES_SQL.format(a='u', b='s')}, s_suppkey) = 1""")
def nearest_of_brand(spark: SparkSession, sf: str) -> DataFrame:
    near = nearby.nearest_within(_customers(spark, sf).withColumnRenamed("c_nationkey", "nation"), _suppliers(spark, sf).withColumnRenamed("s_nationkey", "nation"), "c_custkey", "s_suppkey", 5000.0, on=["nation"])
    return near.select("c_custkey", "s_suppkey", F.round("distance", 3).alias("distance"))


@plans.query(f"""
WITH s AS ({_S}), u AS ({_C}),
p AS (SELECT s_suppkey, c_custkey, c_mktsegment, sqrt(pow(s.lat - u.lat, 2) + pow(s.lon - u.lon, 2)) * 111 AS km FROM s, u),
k AS (SELECT * FROM p WHERE km <= 15 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY km, c_custkey) <= 3)
SELECT s_suppkey, c_mktsegment, count(*) AS n FROM k GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY count(*) DESC, c_mktsegment) = 1""")
def neighbours_vote(spark: SparkSession, sf: str) -> DataFrame:
    return nearby.vote(_suppliers(spark, sf), _customers(spark, sf), "s_suppkey", "c_custkey", "c_mktsegment", 3, 15.0)


@plans.query(f"""
WITH u AS ({_C}) SELECT a.c_custkey AS a, b.c_custkey AS b, a.c_mktsegment, round({METRES_SQL.format(a='a', b='b')}, 3) AS distance FROM u a JOIN u b ON a.c_mktsegment = b.c_mktsegment AND a.c_custkey < b.c_custkey WHERE {METRES_SQL.format(a='a', b='b')} <= 500""")
def close_pairs_of_block(spark: SparkSession, sf: str) -> DataFrame:
    return nearby.close_pairs(_customers(spark, sf).select("c_custkey", "c_mktsegment", "lat", "lon"), "c_custkey", 500.0, ["c_mktsegment"]).select("a", "b", "c_mktsegment", F.round("distance", 3).alias("distance"))


@plans.query(f"""
WITH RECURSIVE s AS ({_S}), e AS (SELECT a.s_suppkey AS u, b.s_suppkey AS v FROM s a, s b WHERE a.s_suppkey <> b.s_suppkey AND {METRES_SQL.format(a='a', b='b')} <= 1000),
r AS (SELECT s_suppkey AS u, s_suppkey AS v FROM s UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT u AS s_suppkey, min(v) AS component FROM r GROUP BY 1""")
def venue_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return nearby.clustered(_suppliers(spark, sf), "s_suppkey", 1000.0)


@plans.query(f"""
WITH s AS ({_S}) SELECT a.s_nationkey, round(max({METRES_SQL.format(a='a', b='b')}), 2) AS spread FROM s a JOIN s b ON a.s_nationkey = b.s_nationkey GROUP BY 1""")
def group_spread(spark: SparkSession, sf: str) -> DataFrame:
    return nearby.exact_spread(_suppliers(spark, sf), "s_nationkey", "s_suppkey").withColumn("spread", F.round("spread", 2))


@plans.query(f"""
WITH s AS ({_S}), u AS ({_C}), m AS (SELECT c_nationkey, median(lat) AS lat, median(lon) AS lon FROM u GROUP BY 1)
SELECT s_suppkey, round({METRES_SQL.format(a='s', b='m')}, 2) AS off, {METRES_SQL.format(a='s', b='m')} > 20000 AS suspect FROM s JOIN m ON s_nationkey = c_nationkey""")
def distance_from_centre(spark: SparkSession, sf: str) -> DataFrame:
    middle = lambda x: quantiles.quantiles(_customers(spark, sf), ["c_nationkey"], x, {f"m{x}": 0.5}).drop("n")
    centre = quantiles.joined([middle("lat"), middle("lon")], ["c_nationkey"])
    off = metres(c("lat"), c("lon"), c("mlat"), c("mlon"))
    return _suppliers(spark, sf).join(centre, c("s_nationkey") == c("c_nationkey")).select("s_suppkey", F.round(off, 2).alias("off"), (off > 20000).alias("suspect"))


@plans.query(f"""
WITH n AS (SELECT DISTINCT p_name FROM part), q AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || 's' WHEN 1 THEN 'x' || substr(p_name, 2) WHEN 2 THEN replace(p_name, ' ', '') ELSE substr(p_name, 1, len(p_name) - 2) END AS said FROM part),
s AS (SELECT p_partkey, said, n.p_name AS found, round(100 * (1 - levenshtein(said, n.p_name)::DOUBLE / greatest(len(said), len(n.p_name), 1)), 2) AS score FROM q, n)
SELECT * FROM s WHERE score >= 80 QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, found) = 1""")
def closest_name(spark: SparkSession, sf: str) -> DataFrame:
    """Names with a letter more, a first letter that differs, no spaces or two letters less, and the closest one by edits."""
    part, k = table(spark, sf, "part"), c("p_partkey") % 4
    names = part.select(c("p_name").alias("b")).distinct()
    said = F.when(k == 0, F.concat("p_name", F.lit("s"))).when(k == 1, F.concat(F.lit("x"), F.substring("p_name", 2, 10_000))).when(k == 2, F.replace("p_name", F.lit(" "), F.lit(""))).otherwise(F.expr("left(p_name, length(p_name) - 2)"))
    asked = part.select("p_partkey", said.alias("a"))
    # edits of up to a fifth of the longer name leave at least 77 of a hundred characters in common
    pairs = similarity.near_texts(asked, names, 77.0).withColumn("score", similarity.levenshtein_score(c("a"), c("b"))).filter("score >= 80")
    best = choosing.first_rows(pairs, ["a"], [F.desc("score"), F.asc("b")])
    return asked.join(best, "a").select("p_partkey", c("a").alias("said"), c("b").alias("found"), "score")


@plans.query()
def fuzzy_best_match(spark: SparkSession, sf: str) -> DataFrame:
    """Each part's name with its words turned round against the list of names: best by sorted words."""
    part = table(spark, sf, "part")
    names = part.groupBy("p_name").agg(F.min("p_partkey").alias("ref")).withColumnRenamed("p_name", "name")
    asked = part.select("p_partkey", F.array_join(F.reverse(F.split("p_name", " ")), " ").alias("said"))
    return similarity.best_match(asked, names, "p_partkey", "said", "ref", "name", similarity.token_sort_score, 85.0)


@plans.query()
def tfidf_label_vote(spark: SparkSession, sf: str) -> DataFrame:
    """The quality of every hundredth document by the vote of its five most similar labelled ones."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select(c("doc_id").alias("ref"), c("quality").cast("string").alias("label"))
    known = docs.withColumnRenamed("doc_id", "ref").join(labels, "ref", "left_semi")
    asked = docs.filter("doc_id % 100 = 0")
    near = tfidf.nearest_texts(known, asked, "ref", "doc_id", "text", 5)
    return tfidf.voted(near, labels, "doc_id", "ref", "label", 4, 0.6)


@plans.query("""
WITH q AS (SELECT vec_id AS q, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0), r AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT q, vec_id, round(list_cosine_similarity(q.e, r.e), 6) AS similarity FROM q, r WHERE q <> vec_id)
SELECT q, vec_id, similarity FROM s QUALIFY row_number() OVER (PARTITION BY q ORDER BY similarity DESC, vec_id) <= 5""")
def nearest_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    asked = e.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "q")
    near = tfidf.nearest_vectors(asked, e, "q", "vec_id", "embedding", 6).filter("q <> vec_id")
    return choosing.first_rows(near, ["q"], [F.desc("similarity"), F.asc("vec_id")], 5)


@plans.query("""
WITH q AS (SELECT vec_id AS q, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0), r AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT q, vec_id, label, round(list_cosine_similarity(q.e, r.e), 6) AS similarity FROM q, r WHERE q <> vec_id),
k AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY q ORDER BY similarity DESC, vec_id) <= 5), m AS (SELECT q, label, count(*) AS n FROM k GROUP BY 1, 2)
SELECT q, label, n AS votes FROM m QUALIFY row_number() OVER (PARTITION BY q ORDER BY n DESC, label) = 1""")
def embedding_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The label that most of a vector's five most similar ones have."""
    near = nearest_embeddings(spark, sf).join(table(spark, sf, "embeddings").select("vec_id", "label"), "vec_id")
    return choosing.modes(near, ["q"], "label").select("q", "label", c("n").alias("votes"))


_LISTINGS = f"""SELECT p_partkey AS id, p_brand || p_size % 5 AS slug, CASE WHEN p_partkey % 6 <> 0 THEN p_brand END AS chain, p_name AS name, p_type AS listed, p_size % 10 AS area, CASE WHEN p_partkey % 5 = 0 THEN [] ELSE ['k' || p_size % 3, 'k' || p_partkey % 4] END AS cuisines,
 CASE WHEN p_partkey % 11 <> 0 THEN lat END AS lat, CASE WHEN p_partkey % 11 <> 0 THEN lon END AS lon FROM (SELECT *, 25.0::DOUBLE + (p_partkey // 2 * 7919 % 40009 + p_partkey % 5 * 20)::DOUBLE / 100000.0::DOUBLE AS lat, 55.0::DOUBLE + (p_partkey // 2 * 6101 % 39989)::DOUBLE / 100000.0::DOUBLE AS lon FROM part)"""
_SORTED = "list_reduce(list_sort(string_split({x}, ' ')), lambda a, b: a || ' ' || b)"
_PAIRS_SQL = f"""
WITH l AS ({_LISTINGS}), x AS (SELECT *, {_SORTED.format(x="name")} AS words FROM l WHERE id % 2 = 0), y AS (SELECT *, {_SORTED.format(x="name")} AS words FROM l WHERE id % 2 = 1),
p AS (SELECT x.id AS new_id, y.id AS old_id, coalesce(x.slug = y.slug, false) AS same_slug, coalesce(x.chain = y.chain, false) AS same_chain, x.name = y.name AS same_name, x.listed = y.listed AND x.name <> y.name AS same_listed_name, x.area = y.area AS same_area,
  len(list_intersect(x.cuisines, y.cuisines)) > 0 AS shared_cuisine, len(x.cuisines) = 0 OR len(y.cuisines) = 0 AS cuisine_open, round(100 * (1 - levenshtein(x.words, y.words) / greatest(len(x.words), len(y.words))), 2) AS fuzzy, CASE WHEN x.lat IS NOT NULL AND y.lat IS NOT NULL THEN {METRES_SQL.format(a='x', b='y')} END AS metres FROM x, y),
s AS (SELECT *, CASE WHEN same_slug AND metres <= 100 THEN 0.99 WHEN same_chain AND metres <= 30 THEN 0.98 WHEN same_chain AND metres <= 120 THEN 0.93 WHEN same_name AND metres <= 50 THEN 0.95 WHEN same_listed_name AND metres <= 50 THEN 0.94 WHEN same_name AND metres <= 250 THEN 0.85
  WHEN fuzzy >= 90 AND metres <= 150 AND (shared_cuisine OR cuisine_open) THEN 0.80 WHEN fuzzy >= 95 AND same_area AND shared_cuisine THEN 0.70 WHEN same_slug AND metres IS NULL THEN 0.60 WHEN same_slug THEN 0.25 END::DOUBLE AS confidence FROM p WHERE metres <= 250 OR same_slug OR same_chain)
SELECT new_id, old_id, confidence, confidence >= 0.8 AS accepted FROM s WHERE confidence IS NOT NULL QUALIFY row_number() OVER (PARTITION BY new_id ORDER BY confidence DESC, CASE WHEN metres <= 250 THEN round(metres, 3) END NULLS LAST, old_id) = 1"""


@plans.query(_PAIRS_SQL)
def relisted(spark: SparkSession, sf: str) -> DataFrame:
    """New (even) against old (odd) listings: candidates by place, slug and chain, the ladder of ways to be the same place, the best candidate of each."""
    k, part = c("p_partkey"), table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    half = F.floor(k / 2)
    place = lambda base, at: F.when(k % 11 != 0, F.lit(base) + at / 100000.0)
    cuisines = F.when(k % 5 != 0, F.array(F.concat(F.lit("k"), (c("p_size") % 3).cast("string")), F.concat(F.lit("k"), (k % 4).cast("string")))).otherwise(F.array().cast("array<string>"))
    rows = part.select(
        k.alias("id"), F.concat("p_brand", (c("p_size") % 5).cast("string")).alias("slug"), F.when(k % 6 != 0, c("p_brand")).alias("chain"), c("p_name").alias("name"), c("p_type").alias("listed"), (c("p_size") % 10).alias("area"),
        cuisines.alias("cuisines"), F.array_join(F.array_sort(F.split("p_name", " ")), " ").alias("words"), place(25.0, half * 7919 % 40009 + k % 5 * 20).alias("lat"), place(55.0, half * 6101 % 39989).alias("lon"),
    )
    new, old = rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1")
    same = lambda name: F.coalesce(c(f"x_{name}") == c(f"y_{name}"), F.lit(False))
    off = metres(c("x_lat"), c("x_lon"), c("y_lat"), c("y_lon"))

    def judged(pairs: DataFrame) -> DataFrame:
        asked = F.when((off <= 150) | same("area"), similarity.levenshtein_score(c("x_words"), c("y_words")))  # no rule on words goes beyond
        pairs = pairs.select(
            "new_id", "old_id", same("slug").alias("same_slug"), same("chain").alias("same_chain"), same("name").alias("same_name"), (same("listed") & ~same("name")).alias("same_listed_name"), same("area").alias("same_area"),
            F.arrays_overlap("x_cuisines", "y_cuisines").alias("shared_cuisine"), ((F.size("x_cuisines") == 0) | (F.size("y_cuisines") == 0)).alias("cuisine_open"), asked.alias("fuzzy"), off.alias("metres"),
        )
        return pairs.withColumn("_l", tiers.laddered(tiers.relisting_steps())).withColumn("confidence", c("_l.confidence")).filter("confidence > 0")

    x, y = (df.select(*[c(k).alias(f"{p}_{k}") for k in df.columns]) for df, p in ((new, "x"), (old, "y")))
    pairs = tiers.relisting_candidates(new, old, ["cuisines"], "words", kept=judged)
    found = judged(pairs.join(x, c("new_id") == c("x_id")).join(y, c("old_id") == c("y_id")))
    order = [F.desc("confidence"), F.asc_nulls_last(F.when(c("metres") <= 250, F.round("metres", 3))), F.asc("old_id")]
    return tiers.best_candidate(found, "new_id", order, 0.8).select("new_id", "old_id", "confidence", "accepted")


@plans.query("""
SELECT doc_id, CASE WHEN text LIKE '%|%' THEN 'table' WHEN lang = 'en' THEN 'english' WHEN n_chars < 500 THEN 'short' END AS label, CASE WHEN text LIKE '%|%' THEN 'rule' WHEN lang = 'en' THEN 'exact' WHEN n_chars < 500 THEN 'length' ELSE 'unknown' END AS tier FROM documents""")
def tier_ladder(spark: SparkSession, sf: str) -> DataFrame:
    steps = [("rule", F.when(c("text").contains("|"), "table")), ("exact", F.when(c("lang") == "en", "english")), ("length", F.when(c("n_chars") < 500, "short"))]
    return tiers.by_tiers(table(spark, sf, "documents"), "doc_id", steps, "label")


@plans.query("""
WITH v AS (SELECT DISTINCT n_name AS term FROM nation), s AS (SELECT s_suppkey, s_name || ', ' || CASE WHEN s_suppkey % 2 = 0 THEN n_name ELSE lower(n_name) END || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE ', ' || s_suppkey END AS said, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, n_name AS term, 'part' AS method FROM s""")
def vocabulary_terms(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    said = F.concat(c("s_name"), F.lit(", "), F.when(c("s_suppkey") % 2 == 0, c("n_name")).otherwise(F.lower("n_name")), F.when(c("s_suppkey") % 3 == 0, "").otherwise(F.concat(F.lit(", "), c("s_suppkey").cast("string"))))
    rows = table(spark, sf, "supplier").join(nation, c("s_nationkey") == c("n_nationkey")).select("s_suppkey", said.alias("said"))
    return tiers.vocabulary_value(rows, "s_suppkey", "said", nation.select(c("n_name").alias("term")), "term", F.lower)


@plans.query("""
WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN upper(p_name) ELSE p_name END AS form FROM part), n AS (SELECT lower(form) AS f, form, count(*) AS n FROM x GROUP BY 1, 2), b AS (SELECT f, form AS best FROM n QUALIFY row_number() OVER (PARTITION BY f ORDER BY n DESC, form DESC) = 1)
SELECT p_partkey, best AS form FROM x JOIN b ON lower(form) = f""")
def canonical_names(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select("p_partkey", F.when(c("p_partkey") % 7 == 0, F.upper("p_name")).otherwise(c("p_name")).alias("form"))
    return tiers.canonical_forms(rows, F.lower("form"), "form")


@plans.query("""
WITH a AS (SELECT c_nationkey AS k, count(*) AS official FROM customer WHERE c_nationkey % 3 <> 0 GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) * 12 AS reported FROM supplier GROUP BY 1), e AS (SELECT n_nationkey AS k, (SELECT count(*) FROM customer) // (SELECT count(*) FROM nation) + n_nationkey AS estimate FROM nation),
x AS (SELECT e.k, official, reported, estimate FROM e LEFT JOIN a USING (k) LEFT JOIN b USING (k))
SELECT k, CASE WHEN official IS NULL THEN reported WHEN reported IS NULL THEN official WHEN greatest(official, reported) - least(official, reported) <= 0.1 * greatest(official, reported) THEN official WHEN abs(official - estimate) <= abs(reported - estimate) THEN official ELSE reported END AS planned,
 greatest(official, reported) - least(official, reported) <= 0.1 * greatest(official, reported) AS agreed FROM x""")
def planned_counts(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").filter("c_nationkey % 3 <> 0").groupBy(c("c_nationkey").alias("k")).agg(F.count("*").alias("official"))
    b = table(spark, sf, "supplier").groupBy(c("s_nationkey").alias("k")).agg((F.count("*") * 12).alias("reported"))
    usual = table(spark, sf, "customer").agg(F.count("*").alias("people")).crossJoin(table(spark, sf, "nation").agg(F.count("*").alias("nations")))  # one row
    nation = table(spark, sf, "nation").crossJoin(F.broadcast(usual))
    rows = nation.select(c("n_nationkey").alias("k"), (F.floor(c("people") / c("nations")) + c("n_nationkey")).alias("estimate")).join(a, "k", "left").join(b, "k", "left")
    return tiers.planned_counts(rows, ["official", "reported"], "estimate").select("k", "planned", "agreed")


@plans.query("""
WITH RECURSIVE l AS (SELECT s_suppkey AS child, s_suppkey // 2 AS parent FROM supplier WHERE s_suppkey > 1), r AS (SELECT child, parent AS top FROM l UNION SELECT r.child, l.parent FROM r JOIN l ON r.top = l.child)
SELECT child, min(top) AS owner FROM r GROUP BY 1""")
def ultimate_owners(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").filter("s_suppkey > 1").select(c("s_suppkey").alias("child"), F.floor(c("s_suppkey") / 2).alias("parent"))
    return nearby.owners(rows, "child", "parent")


@plans.query("""
WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part), v AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS term FROM part)
SELECT p_partkey, count(DISTINCT word) AS terms FROM w JOIN v ON word = term GROUP BY 1""")
def contained_terms(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    terms = part.select(F.element_at(F.split("p_name", " "), 1).alias("word")).distinct()
    words = part.select("p_partkey", F.explode(F.array_distinct(F.split("p_name", " "))).alias("word"))
    return words.join(terms, "word").groupBy("p_partkey").agg(F.count("*").alias("terms"))


@plans.query("""
SELECT b.s_suppkey, CASE WHEN n = 0 THEN 'unmatched' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS verdict, CASE WHEN n = 1 THEN first ELSE -1 END AS c_custkey FROM (
 SELECT s_suppkey, count(c_custkey) AS n, min(c_custkey) AS first FROM supplier LEFT JOIN customer ON s_nationkey = c_nationkey AND floor(s_acctbal / 500) = floor(c_acctbal / 500) GROUP BY 1) b""")
def narrowed_matches(spark: SparkSession, sf: str) -> DataFrame:
    from lakeshed.operators.merging import narrowed

    a = table(spark, sf, "supplier").select("s_suppkey", c("s_nationkey").alias("nation"), F.floor(c("s_acctbal") / 500).alias("step"))
    b = table(spark, sf, "customer").select("c_custkey", c("c_nationkey").alias("nation"), F.floor(c("c_acctbal") / 500).alias("step"))
    return narrowed(a, b, ["nation", "step"], "c_custkey", "s_suppkey").select("s_suppkey", "verdict", F.coalesce("c_custkey", F.lit(-1)).alias("c_custkey"))


@plans.query("""SELECT s_suppkey, n_name, count(*) OVER (PARTITION BY n_name) > 4 AS crowded FROM supplier JOIN nation ON s_name LIKE '%' || (n_nationkey % 10)""")
def pattern_join(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_name", (c("n_nationkey") % 10).cast("string").alias("ending"))  # at most 25 rows
    rows = table(spark, sf, "supplier").join(F.broadcast(nation), F.endswith("s_name", "ending"))
    return rows.select("s_suppkey", "n_name", (F.count("*").over(Window.partitionBy("n_name")) > 4).alias("crowded"))
