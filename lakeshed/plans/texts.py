"""Scalar functions, pages and JSON on the text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.functions import text as t
from lakeshed.functions import values as v
from lakeshed.operators import gates, tiers
from lakeshed.plans.base import Plans, table
from lakeshed.sources import html as h

plans = Plans()
c = F.col


@plans.query(r"""
SELECT p_partkey, trim(regexp_replace(lower(p_name), '\s+', ' ', 'g')) AS key, regexp_replace(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug,
 list_reduce(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), lambda x, y: x || ' ' || y) AS title, CASE WHEN string_split(p_name, ' ')[-1] = 'plate' THEN string_split(p_name, ' ')[-2] ELSE string_split(p_name, ' ')[-1] END AS head FROM part""")
def part_keys(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return part.select("p_partkey", t.item_key(c("p_name")).alias("key"), t.slug(F.concat_ws(" ", "p_name", "p_brand"), fold=False).alias("slug"), t.title_case(c("p_name"), ()).alias("title"), t.head_noun(c("p_name")).alias("head"))


@plans.query(r"""
SELECT doc_id, len(text)::BIGINT AS chars, md5(trim(regexp_replace(lower(coalesce(text, '')), '[ \t\n\r\f\v]+', ' ', 'g'))) AS key, len(regexp_extract_all(text, '[A-Z][a-z]+'))::BIGINT AS capitals, sha256(coalesce(text, '')) AS digest, md5(coalesce(text, '')) AS short_digest FROM documents""")
def document_keys(spark: SparkSession, sf: str) -> DataFrame:
    x = c("text")
    full = F.coalesce(x, F.lit(""))
    key = F.md5(F.trim(F.regexp_replace(F.lower(full), r"[ \t\n\r\f\x0B]+", " ")))
    return table(spark, sf, "documents").select("doc_id", F.length(x).cast("long").alias("chars"), key.alias("key"), F.regexp_count(x, F.lit("[A-Z][a-z]+")).cast("long").alias("capitals"), F.sha2(full, 256).alias("digest"), F.md5(full).alias("short_digest"))


@plans.query(r"""
SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '^www\.', '') AS domain, regexp_replace(url, '[?#].*$', '') AS plain,
 try_cast(nullif(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([0-9]+)[^0-9]*$', 1), '') AS BIGINT) AS number FROM pages""")
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    u = c("url")
    return table(spark, sf, "pages").select("page_id", F.lower(F.regexp_extract(u, "^[a-z]+://([^/:?#]+)", 1)).alias("host"), t.domain(u).alias("domain"), t.without_query(u).alias("plain"), t.last_number(u).alias("number"))


@plans.query(r"""
SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title, len(regexp_extract_all(html, 'href="([^"]*)"', 1))::BIGINT AS links,
 regexp_extract_all(html, 'href="([^"]*)"', 1)[1] AS first_link, coalesce(list_max(list_transform(regexp_extract_all(html, '[?&]page=([0-9]+)', 1), lambda x: x::INTEGER)), 1)::INTEGER AS last_page FROM pages""")
def page_fields(spark: SparkSession, sf: str) -> DataFrame:
    x = c("html")
    return table(spark, sf, "pages").select("page_id", h.title(x).alias("title"), F.size(h.links(x)).cast("long").alias("links"), F.try_element_at(h.links(x), F.lit(1)).alias("first_link"), h.last_page(x).alias("last_page"))


@plans.query(r"""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)
SELECT link, count(DISTINCT page_id) AS pages, count(*) AS n FROM l GROUP BY 1 HAVING count(DISTINCT page_id) > 1""")
def shared_links(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "pages").select("page_id", F.explode(h.links(c("html"))).alias("link"))
    return rows.groupBy("link").agg(F.countDistinct("page_id").alias("pages"), F.count("*").alias("n")).filter("pages > 1")


@plans.query(r"""
SELECT page_id, '{"name":"' || lower(host) || '","n":' || page_id || '}' AS node, lower(host) AS name, page_id AS n FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages)""")
def linked_data_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Pages wrapped around a linked-data node made of their url, and the node read back."""
    host = F.lower(F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1))
    node = F.concat(F.lit('{"name":"'), host, F.lit('","n":'), c("page_id").cast("string"), F.lit("}"))
    wrapped = F.concat(c("html"), F.lit('<script type="application/ld+json">{"@graph":['), node, F.lit("]}</script>"))
    found = table(spark, sf, "pages").select("page_id", F.element_at(h.json_ld(wrapped), -1).alias("node"))
    return found.select("page_id", "node", F.get_json_object("node", "$.name").alias("name"), F.get_json_object("node", "$.n").try_cast("long").alias("n"))


@plans.query(r"""
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k, coalesce(nullif(json_extract_string(props, '$.name'), ''), event_type) AS name, CASE WHEN value < 1 THEN 'low' WHEN value < 10 THEN 'middle' ELSE 'high' END AS band FROM events""")
def json_properties(spark: SparkSession, sf: str) -> DataFrame:
    props = c("props")
    return table(spark, sf, "events").select("event_id", F.get_json_object(props, "$.k").try_cast("int").alias("k"), v.first_filled(F.get_json_object(props, "$.name"), c("event_type")).alias("name"), v.band(c("value"), [(1.0, "low"), (10.0, "middle")], "high").alias("band"))


@plans.query(r"""
SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice * (1 - l_discount) - l_extendedprice) / nullif(l_extendedprice, 0) * 100, 2) AS pct, CASE WHEN l_extendedprice IS NULL THEN 'missing' WHEN l_extendedprice < 0 THEN 'negative' WHEN l_extendedprice = 0 THEN 'zero' WHEN l_extendedprice > 90000 THEN 'too high' END AS issue,
 abs(l_discount - l_tax) > 0.01 AS differs FROM lineitem""")
def price_arithmetic(spark: SparkSession, sf: str) -> DataFrame:
    p = c("l_extendedprice")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", v.percent_change(p, p * (1 - c("l_discount"))).alias("pct"), v.price_issue(p, 90000.0).alias("issue"), v.differs(c("l_discount"), c("l_tax")).alias("differs"))


@plans.query(r"""
SELECT o_orderkey, ('0x' || substr(sha256(o_orderkey::VARCHAR), 1, 13))::BIGINT AS id52, 'MK-' || substr(sha256(o_orderpriority || o_orderkey), 1, 12) AS review_id, round((epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1992-01-01')) / 86400000000.0::DOUBLE, 2) AS days, (year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS month FROM orders""")
def stable_ids_and_dates(spark: SparkSession, sf: str) -> DataFrame:
    k = c("o_orderkey").cast("string")
    start = F.lit("1992-01-01").cast("timestamp")
    return table(spark, sf, "orders").select("o_orderkey", v.id52(k).alias("id52"), v.review_id(F.concat("o_orderpriority", k)).alias("review_id"), v.days_between(start, c("o_orderdate").cast("timestamp")).alias("days"), (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month"))


@plans.query(r"""
SELECT s_suppkey, '+971' || (500000000 + s_suppkey) AS phone, regexp_matches((500000000 + s_suppkey)::VARCHAR, '0{6}|1{6}|2{6}|3{6}|4{6}|5{6}|6{6}|7{6}|8{6}|9{6}|012345|123456|234567|345678|456789|567890|678901|789012|890123|901234|543210|654321|765432|876543|987654|098765|109876|210987|321098|432109') AS made_up FROM supplier""")
def phone_numbers(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("00971 "), (c("s_suppkey") + 500_000_000).cast("string"))
    own = (c("s_suppkey") + 500_000_000).cast("string")
    return table(spark, sf, "supplier").select("s_suppkey", t.phone(raw).alias("phone"), t.made_up_phone(own).alias("made_up"))


@plans.query(r"""
SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]{16}') THEN 'number' WHEN text LIKE '%|%' THEN 'table' WHEN regexp_matches(text, '[A-Z]{4,}!!') THEN 'shouting' WHEN regexp_matches(text, '(?i)all rights reserved') THEN 'licence' WHEN text IS NOT NULL THEN 'prose' END AS kind FROM documents""")
def rule_classes(spark: SparkSession, sf: str) -> DataFrame:
    rules = [("[0-9]{16}", "number"), (r"\|", "table"), ("[A-Z]{4,}!!", "shouting"), ("(?i)all rights reserved", "licence")]
    return table(spark, sf, "documents").select("doc_id", F.when(c("text").isNotNull(), t.first_of(c("text"), rules, F.lit("prose"))).alias("kind"))


@plans.query(r"""
WITH w AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS part FROM benchmark) SELECT part, count(*) AS df FROM w GROUP BY 1 HAVING count(*) >= 3""")
def document_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return tiers.document_frequency(table(spark, sf, "benchmark"), "item_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)), 3)


@plans.query(r"""
SELECT 'text' AS field, k AS kind, n FROM (SELECT count(*) FILTER (regexp_matches(text, '[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{FE0F}\x{20E3}]')) AS emoji, count(*) FILTER (regexp_matches(text, '[\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]')) AS arabic,
 count(*) FILTER (regexp_matches(text, '[\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}]')) AS cjk, count(*) FILTER (regexp_matches(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{80}-\x{9F}]')) AS control,
 count(*) FILTER (regexp_matches(text, '[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}\x{00AD}]')) AS invisible, count(*) FILTER (regexp_matches(text, 'Ã[\x{80}-\x{BF}]|â€')) AS mangled FROM documents) UNPIVOT (n FOR k IN (emoji, arabic, cjk, control, invisible, mangled))""")
def text_hygiene(spark: SparkSession, sf: str) -> DataFrame:
    return gates.hygiene(table(spark, sf, "documents"), ["text"])


@plans.query(r"""
SELECT lower(n_name) AS n_name, string_agg(x, '' ORDER BY i) AS key FROM (SELECT n_name, unnest(string_split(lower(n_name), '')) AS x, unnest(generate_series(1, len(n_name))) AS i FROM nation) WHERE regexp_matches(x, '[a-z0-9]') GROUP BY n_name""")
def area_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.lower("n_name").alias("n_name"), t.area_key(c("n_name"), fold=False).alias("key"))


@plans.query()
def folded_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the pages' titles without marks, with their counts."""
    rows = table(spark, sf, "pages").select("page_id", t.folded(t.match_key(h.title(c("html")))).alias("title"))
    return rows.select("page_id", F.explode(F.split("title", " ")).alias("word")).filter("word <> ''").groupBy("word").agg(F.countDistinct("page_id").alias("pages"))


@plans.query()
def repaired_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as they are shown: composed, repaired, without invisible characters; and what of them changed."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    fixed = docs.withColumn("clean", t.finished(t.unmangled(t.composed(F.col("text")))))
    return fixed.select("doc_id", F.length("clean").alias("chars"), (~c("clean").eqNullSafe(c("text"))).alias("changed"), F.sha1(F.coalesce("clean", F.lit(""))).alias("digest"))


@plans.query(r"""
SELECT conv_id, count(*) AS turns, count(DISTINCT role) AS roles, arg_min(role, turn) AS first_role, sum(len(coalesce(text, '')))::BIGINT AS chars FROM conversations GROUP BY 1""")
def conversation_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.countDistinct("role").alias("roles"), F.min_by("role", "turn").alias("first_role"), F.sum(F.length(F.coalesce("text", F.lit("")))).cast("long").alias("chars"))


@plans.query(r"""
SELECT doc_id, n > 0 AS grounded, n FROM (SELECT doc_id, coalesce(len(regexp_extract_all(text, '[0-9]{3}-[0-9]{4}')), 0)::BIGINT AS n FROM documents)""")
def evidence_numbers(spark: SparkSession, sf: str) -> DataFrame:
    n = F.coalesce(F.regexp_count("text", F.lit("[0-9]{3}-[0-9]{4}")), F.lit(0)).cast("long")
    return table(spark, sf, "documents").select("doc_id", (n > 0).alias("grounded"), n.alias("n"))


@plans.query("""
WITH w AS (SELECT a.p_partkey, list_distinct(list_filter(string_split(lower(a.p_name || ' ' || a.p_type), ' '), lambda x: len(x) > 2)) AS words, b.p_name AS e1, lower(b.p_type || ' ' || a.p_name) AS e2 FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)
SELECT p_partkey, greatest(len(list_intersect(words, string_split(e1, ' '))), len(list_intersect(words, string_split(e2, ' ')))) >= len(words) AS grounded FROM w""")
def grounded_claims(spark: SparkSession, sf: str) -> DataFrame:
    """Whether what a part says of itself is held by one of two texts of the next one."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    after = part.select((c("p_partkey") - 1).alias("p_partkey"), c("p_name").alias("e1"), c("p_type").alias("t"))
    rows = part.join(after, "p_partkey").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("claim"), F.array("e1", F.concat_ws(" ", "t", "p_name")).alias("evidence"))
    return tiers.grounded(rows, "claim", "evidence", t.significant).select("p_partkey", "grounded")
