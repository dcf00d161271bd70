"""Composites of the catalogue cycle: menus, promotions, smeared addresses, shared links, outlets, brands, areas, conformance, publishing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshed.functions.text import ARABIC, collapsed, item_key, latin_folded
from lakeshed.functions.values import metres
from lakeshed.operators.choosing import first_rows, modes
from lakeshed.operators.entities import beyond_area, ruled_area
from lakeshed.operators.nearby import exact_spread
from lakeshed.operators.storing import stored

c = F.col


# Nested menus --------------------------------------------------------------


def nested_once(df: DataFrame, key: str, items: str, fields: list[str]) -> DataFrame:
    """Keeps an array's first item for each combination of fields, in the order there was; each row by itself, without a shuffle."""
    held = F.transform(items, lambda x, k: F.struct(F.struct(*[x[f].alias(f) for f in fields]).alias("of"), k.alias("at")))
    rows = df.withColumn("_s", F.array_sort(held)).withColumnRenamed(items, "_items")
    firsts = F.filter("_s", lambda x, k: (k == 0) | ~x["of"].eqNullSafe(F.get("_s", k - 1)["of"]))
    places = F.array_sort(F.transform(firsts, lambda x: x["at"]))
    kept = F.transform(places, lambda k: F.get("_items", k))
    return rows.withColumn(items, F.coalesce(kept, F.array().cast(df.schema[items].dataType))).drop("_items", "_s")


def refreshed(base: DataFrame, new: DataFrame, key: str, menu: str) -> DataFrame:
    """A cohort's records with the menus of a later one, where it has them; records of the later one alone are added."""
    later = new.select(c(key).alias("_key"), c(menu).alias("_menu"))
    kept = base.join(later, c(key) == c("_key"), "left").withColumn(menu, F.coalesce("_menu", menu)).drop("_key", "_menu")
    return kept.unionByName(new.join(base.select(key), key, "left_anti"), allowMissingColumns=True)


def one_of_promotions(df: DataFrame, keys: list[str], section: str, promoted: Column, order: list[Column]) -> DataFrame:
    """Of an item listed under several sections the first that is no promotion; ``also_in`` has the others."""
    rows = df.withColumn("_promoted", promoted)
    best = first_rows(rows, keys, [F.asc("_promoted"), *order])
    sections = rows.groupBy(*keys).agg(F.collect_set(section).alias("_all"))
    out = best.join(sections, keys).withColumn("also_in", F.array_join(F.array_sort(F.array_except("_all", F.array(section))), ", "))
    return out.drop("_promoted", "_all")


# Addresses and links -------------------------------------------------------


def smeared(df: DataFrame, identity: str, chain: str, raw: str, area: str, most: float = 1000.0) -> DataFrame:
    """(chain, address, branches, spread): addresses that one chain uses for places farther apart than one address can be.

    Addresses that say no more than their area don't count; an address is one in
    whatever case and spacing.  The spread is the largest distance of two places.
    """
    rows = df.filter(c(chain).isNotNull() & (F.trim(raw) != "") & (F.trim(raw) != "NA") & beyond_area(c(raw), c(area)))
    rows = rows.select(identity, "lat", "lon", F.struct(c(chain).alias("chain"), item_key(c(raw)).alias("address")).alias("_g"))
    several = rows.groupBy("_g").agg(F.countDistinct(identity).alias("branches")).filter("branches > 1")
    far = exact_spread(rows.join(several, "_g", "left_semi"), "_g", identity).filter(c("spread") > most)
    return several.join(far, "_g").select(c("_g.chain").alias(chain), c("_g.address").alias("address"), "branches", "spread")


def smear_verdict(place_city: Column, stated_city: Column, slug_area: Column, slug_listed: Column, file_area: Column) -> Column:
    """What independent evidence says of a branch of a smeared address.

    ``place_city`` is what verified points around it say, ``stated_city`` what the
    address says; ``slug_area`` what its page's address says and whether that is a
    listed area; ``file_area`` the file's own, if it is listed.  Without evidence it is unverified.
    """
    listed = F.coalesce(slug_listed, F.lit(False))
    return F.when(place_city != stated_city, "wrong emirate").when(listed & (slug_area == file_area), "consistent").when(listed, "wrong area").otherwise("unverified")


def link_owners(df: DataFrame, identity: str, link: str, owner_lat: str, owner_lon: str, near: float = 300.0, far: float = 1000.0) -> DataFrame:
    """Places that share a link: the one nearest to the link's own place keeps it where it is near; the others lose it if they lie far off.

    Columns: identity, link, verdict (own, keep, drop).
    """
    rows = df.filter(c(link).isNotNull()).withColumn("_off", metres(c("lat"), c("lon"), c(owner_lat), c(owner_lon)))
    by = Window.partitionBy(link)
    rows = rows.withColumns({"_n": F.count("*").over(by), "_place": F.row_number().over(by.orderBy(F.asc_nulls_last("_off"), F.asc(identity)))})
    verdict = F.when(c("_n") == 1, "own").when((c("_place") == 1) & (c("_off") <= near), "own").when(c("_off") > far, "drop").otherwise("keep")
    return rows.select(identity, link, verdict.alias("verdict"))


def one_place(df: DataFrame, name_key: Column, order: list[Column], digits: int = 4) -> DataFrame:
    """One record for each name and rounded place."""
    cell = lambda x: F.floor(c(x) * 10**digits)
    return first_rows(df.withColumns({"_n": name_key, "_y": cell("lat"), "_x": cell("lon")}), ["_n", "_y", "_x"], order).drop("_n", "_y", "_x")


# Brands and outlets --------------------------------------------------------


def brand_steps(brand: Column, name: Column) -> Column:
    """How a place's name carries a brand's (both are match keys): exact, leading, contained, or its words with one miss for four and more."""
    b, n = F.split(brand, " "), F.split(name, " ")
    hits = F.size(F.array_intersect(b, n))
    need = F.when(F.size(F.array_distinct(b)) >= 4, F.size(F.array_distinct(b)) - 1).otherwise(F.size(F.array_distinct(b)))
    return F.when(name == brand, "exact").when(F.startswith(name, F.concat(brand, F.lit(" "))), "leading").when(F.contains(F.concat(F.lit(" "), name, F.lit(" ")), F.concat(F.lit(" "), brand, F.lit(" "))), "contained").when(hits >= need, "words")


#: Public suffixes of two labels.
TWO_LEVEL = ("co.uk", "org.uk", "me.uk", "ltd.uk", "plc.uk", "net.uk", "sch.uk", "ac.uk", "gov.uk", "com.au", "co.nz", "co.za", "com.br", "com.tr", "com.sa", "com.kw", "com.qa", "com.bh", "co.in")


def registrable_domain(url: Column, suffixes: Sequence[str] = TWO_LEVEL) -> Column:
    """The domain that is registered: two labels, three under a suffix of two; null without a dot."""
    host = F.split(F.split(F.regexp_replace(F.lower(F.trim(url)), "^[a-z]+://", ""), "/")[0], ":")[0]
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.when(F.array_join(F.slice(labels, -2, 2), ".").isin(*suffixes) & (F.size(labels) >= 3), 3).otherwise(2)
    return F.when(F.size(labels) >= 2, F.array_join(F.slice(labels, -n, n), "."))


def outlet_match(title: Column, site: Column, keywords: Column, excluded: Column, domain: Column) -> Column:
    """How a result is a brand's: by ``title`` (one of its keywords, whole, first), by ``domain``, or null; excluded words refuse it."""
    name = lambda x: collapsed(F.regexp_replace(F.regexp_replace(F.replace(F.lower(latin_folded(x)), F.lit("&"), F.lit(" and ")), "['.]", ""), "-", " "))
    said = name(title)
    within = lambda words: F.exists(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.contains(F.concat(F.lit(" "), said, F.lit(" ")), F.concat(F.lit(" "), w, F.lit(" "))))
    refused = F.coalesce(within(excluded), F.lit(False))
    return F.when(~refused, F.when(F.coalesce(within(keywords), F.lit(False)), "title").when(registrable_domain(site) == domain, "domain"))


def outlets(df: DataFrame, keys: list[str], reasons: list[tuple[str, Column]], place: str, address: str, closed: Column, cap: int) -> DataFrame:
    """Outlets of a brand: rows dropped by the first reason that holds, each counted; one for each place id, then address; open ones; whether the capture was cut at its cap.

    Of a place's rows the one with the first address, then an open one, counts; an address is open if one of its places is.
    """
    holds = [F.when(F.coalesce(x, F.lit(False)), F.lit(name)) for name, x in reasons]
    rows = df.withColumns({"_reason": F.coalesce(*holds, F.lit(None).cast("string")) if holds else F.lit(None).cast("string"), "_closed": F.coalesce(closed, F.lit(False))})
    counted = rows.groupBy(*keys).agg(F.count("*").alias("rows"), *[F.count_if(c("_reason") == n).alias(n.replace(" ", "_")) for n, _ in reasons])
    own = F.coalesce(F.nullif(c(address), F.lit("")), F.concat(F.lit("id:"), c(place).cast("string")))
    kept = first_rows(rows.filter(c("_reason").isNull() & c(place).isNotNull()).withColumn("_own", own), [*keys, place], [F.asc("_own"), F.asc("_closed")])
    unique = kept.groupBy(*keys, "_own").agg(F.bool_and("_closed").alias("_closed"))
    found = unique.groupBy(*keys).agg(F.count("*").alias("outlets"), F.count_if(~c("_closed")).alias("open"))
    return counted.join(found, keys, "left").withColumns({"outlets": F.coalesce("outlets", F.lit(0)), "open": F.coalesce("open", F.lit(0)), "cut": c("rows") >= cap})


def shared_counts(counts: DataFrame, brand: str, same_as: DataFrame) -> DataFrame:
    """Adds the brands that are another one under a further name (brand, same_as) with that one's counts; ``shared_from`` says whose."""
    own = counts.withColumn("shared_from", F.lit(None).cast("string"))
    rows = same_as.select(c(brand).alias("_new"), c("same_as").alias(brand)).join(counts, brand)
    return own.unionByName(rows.withColumn("shared_from", c(brand).cast("string")).withColumn(brand, c("_new")).drop("_new"))


# Labels --------------------------------------------------------------------


def type_of_hints(hints: Column, types: dict[str, Sequence[str]], least_share: float) -> Column:
    """The type that the largest share of hints speaks for, the first on a tie; null if none has the share."""
    shares = F.array(*[F.struct((F.size(F.array_intersect(hints, F.array(*map(F.lit, words)))) / F.greatest(F.size(hints), F.lit(1))).alias("s"), F.lit(-k).alias("k"), F.lit(name).alias("name")) for k, (name, words) in enumerate(types.items())])
    best = F.array_max(shares)
    return F.when(best["s"] >= least_share, best["name"])


def arbitrated(old: Column, new: Column, voted: Column, votes: Column, least: int) -> Column:
    """struct(label, why) of two months' labels: agreement, the one that neighbours back, else the newer."""
    return (
        F.when(old.eqNullSafe(new), F.struct(new.alias("label"), F.lit("same").alias("why")))
        .when(old.isNull() | new.isNull(), F.struct(F.coalesce(new, old).alias("label"), F.lit("only one").alias("why")))
        .when((votes >= least) & (voted == new), F.struct(new.alias("label"), F.lit("neighbours back the new").alias("why")))
        .when((votes >= least) & (voted == old), F.struct(old.alias("label"), F.lit("neighbours back the old").alias("why")))
        .otherwise(F.struct(new.alias("label"), F.lit("newer").alias("why")))
    )


def settled_conflicts(df: DataFrame, name: str, voted: DataFrame) -> DataFrame:
    """(name, term, ingredients, why) for names with several labels (term, ingredients) over two months.

    ``df`` has name, newer (whether the row is of the later month; null rows are
    left out), term, ingredients (an array); ``voted`` has name and term, what the name's neighbours
    say (the smallest, if several).  A month's label is the one of most rows, ties
    go to the smallest.  With both months: the one whose term the neighbours back;
    if both have that term, the longer list, the older month's where they are as
    long; else the later month's.  With one month: the most frequent of its labels
    that the neighbours back, else the most frequent.  Terms are compared without
    case and outer blanks.
    """
    plain = lambda x: F.lower(F.trim(x))
    label = F.struct(c("term"), F.coalesce("ingredients", F.array().cast("array<string>")).alias("ingredients"))
    counts = df.filter("newer is not null").groupBy(name, "newer", label.alias("label")).agg(F.count("*").alias("n"))
    said = voted.groupBy(name).agg(F.min(plain(c("term"))).alias("_voted"))
    counts = counts.join(said, name, "left").withColumn("backed", F.coalesce(plain(c("label.term")) == c("_voted"), F.lit(False)))
    best = lambda which: F.min_by("label", F.when(which, F.struct(-c("n"), c("label"))))
    by_name = counts.groupBy(name).agg(F.countDistinct("label").alias("labels"), best(~c("newer")).alias("old"), best(c("newer")).alias("new"), best(c("backed")).alias("backed"), best(F.lit(True)).alias("most"), F.min("_voted").alias("_voted"))
    backs = lambda x: F.coalesce(plain(c(f"{x}.term")) == c("_voted"), F.lit(False))
    longer = F.when(F.size("old.ingredients") >= F.size("new.ingredients"), c("old")).otherwise(c("new"))
    result = lambda x, why: F.struct(x.alias("label"), F.lit(why).alias("why"))
    one = F.when(c("backed").isNotNull(), result(c("backed"), "one month, backed")).otherwise(result(c("most"), "one month, most rows"))
    both = F.when(backs("old") & backs("new"), result(longer, "same term, longer list")).when(backs("old"), result(c("old"), "neighbours back the old")).when(backs("new"), result(c("new"), "neighbours back the new")).otherwise(result(c("new"), "neighbours back neither"))
    out = by_name.filter("labels > 1").withColumn("_x", F.when(c("old").isNull() | c("new").isNull(), one).otherwise(both))
    return out.select(name, "_x.label.term", "_x.label.ingredients", "_x.why")


def resolved_areas(df: DataFrame, identity: str, vocabulary: DataFrame, answers: DataFrame, direct: DataFrame, named: DataFrame, cleaned: DataFrame, rejected: DataFrame) -> DataFrame:
    """(identity, area, method): the area of each row (identity, source, raw, city) by eight methods in their order.

    An answer given for the row; the source's own area of an earlier month; its page's
    name for the area, where the source has one row, if it is known (else it is new, or was rejected);
    the raw text as a known area; its cleaned form; its longest part that is a known
    area; its part shaped like one, to approve.  Tables have (identity, area),
    (source, area), (source, area), (raw, area), (area); the vocabulary area and city.
    """
    once = lambda t, key, name: t.groupBy(c(key).alias(f"_{name}_key")).agg(F.min("area").alias(f"_{name}"))
    rows = df.select(identity, "source", F.nullif(F.trim("raw"), F.lit("")).alias("raw"), "city")
    many = rows.groupBy("source").agg(F.count("*").alias("_rows")).withColumnRenamed("source", "_s")
    known = vocabulary.select(c("area").alias("_v")).distinct()
    rows = rows.join(once(answers, identity, "answer"), c(identity) == c("_answer_key"), "left").join(once(direct, "source", "direct"), c("source") == c("_direct_key"), "left")
    rows = rows.join(once(named, "source", "page"), c("source") == c("_page_key"), "left").join(many, c("source") == c("_s"), "left").withColumn("_page", F.when(c("_rows") == 1, c("_page")))
    rows = rows.join(known.withColumnRenamed("_v", "_page_known"), c("_page") == c("_page_known"), "left").join(rejected.select(c("area").alias("_no")).distinct(), c("_page") == c("_no"), "left")
    rows = rows.join(known.withColumnRenamed("_v", "_raw_known"), c("raw") == c("_raw_known"), "left").join(once(cleaned.withColumn("raw", F.lower("raw")), "raw", "clean"), F.lower("raw") == c("_clean_key"), "left")
    pick = lambda area, name: F.struct(area.alias("area"), F.lit(name).alias("method"))
    none = F.lit(None).cast("string")
    found = (
        F.when(c("_answer").isNotNull(), pick(c("_answer"), "answer")).when(c("_direct").isNotNull(), pick(c("_direct"), "direct"))
        .when(c("_page_known").isNotNull(), pick(c("_page"), "page")).when(c("_no").isNotNull(), pick(none, "unresolved: rejected")).when(c("_page").isNotNull(), pick(c("_page"), "page, new"))
        .when(c("_raw_known").isNotNull(), pick(c("raw"), "exact")).when(c("_clean").isNotNull(), pick(c("_clean"), "cleaned")).when(c("raw").isNull(), pick(none, "unresolved: empty"))
    )
    rows = stored(rows.withColumn("_f", found).select(identity, "raw", "city", "_f"), "areas")
    ruled = ruled_area(rows.filter("_f is null"), identity, "raw", "city", vocabulary)
    ruled = ruled.join(known, c("area") == c("_v"), "left")
    elsewhere = (c("method") == "candidate") & c("_v").isNotNull()  # a known area, but of another city
    method = F.when(c("method").isin("exact", "part"), "rules").when(elsewhere, "unresolved: other city").when(c("method") == "candidate", "candidate, new").otherwise(F.concat(F.lit("unresolved: "), "method"))
    late = ruled.select(identity, F.when(~elsewhere & ~F.startswith(method, F.lit("unresolved")), c("area")).alias("area"), method.alias("method"))
    return rows.filter("_f is not null").select(identity, "_f.area", "_f.method").unionByName(late)


def rectified_areas(df: DataFrame, identity: str, vocabulary: DataFrame, cities: Sequence[str]) -> DataFrame:
    """(identity, area, method): each row's area as the vocabulary spells it, never a guess and never a city.

    Rows have verified, page, slug, cleaned, current, raw (the address) and city.  A
    verified place's own area counts, then a segment of its address; of others the page's
    value, kept even if it isn't listed unless it is in Arabic script, the slug's, the
    cleaned file's, the current one.  A listed area of another city is refused.
    What is left is null where it is a city or in Arabic script, else kept, not listed.
    """
    low = [x.lower() for x in cities]
    is_city = lambda x: (F.trim(x) == "") | F.lower(F.trim(x)).isin(*low)
    tries = lambda *names: F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("method"), c(n).alias("value")) for k, n in enumerate(names)])
    segments = F.transform(F.split(F.coalesce("raw", F.lit("")), r"\s+-\s+|,"), lambda x, k: F.struct((k + 1).alias("k"), F.lit("address").alias("method"), F.trim(x).alias("value")))
    every = F.when(F.coalesce("verified", F.lit(False)), F.concat(tries("current"), segments)).otherwise(tries("page", "slug", "cleaned", "current"))
    rows = df.select(identity, "city", F.explode(every).alias("_t")).filter(c("_t.value").isNotNull() & ~is_city(c("_t.value")))
    known = vocabulary.groupBy(F.lower("area").alias("_low")).agg(F.min(F.struct("area", "city")).alias("_v"))
    rows = rows.join(known, F.lower(F.trim("_t.value")) == c("_low"), "left").withColumn("_v", F.when(c("city").isNull() | c("_v.city").isNull() | (c("city") == c("_v.city")), c("_v")))
    kept = F.when((c("_t.method") == "page") & ~c("_t.value").rlike(ARABIC), F.struct(F.trim("_t.value").alias("area"), F.lit("page, not listed").alias("method")))
    found = F.coalesce(F.when(c("_v").isNotNull(), F.struct(c("_v.area").alias("area"), c("_t.method").alias("method"))), kept)
    best = rows.withColumn("_f", found).filter("_f is not null").groupBy(identity).agg(F.min_by("_f", "_t.k").alias("_f"))
    current = F.nullif(F.trim("current"), F.lit(""))
    gone = current.isNull() | is_city(current) | current.rlike(ARABIC)
    rest = F.when(gone, F.struct(F.lit(None).cast("string").alias("area"), F.lit("none").alias("method"))).otherwise(F.struct(current.alias("area"), F.lit("kept, not listed").alias("method")))
    return df.select(identity, "current").join(best, identity, "left").withColumn("_f", F.coalesce("_f", rest)).select(identity, "_f.area", "_f.method")


def corrected_city(df: DataFrame, identity: str, stated: str, voted: DataFrame, dominant: DataFrame, area: str, city: str) -> DataFrame:
    """A stated city gives way where the neighbours' vote and the area's dominant city agree on another."""
    rows = df.join(voted.select(identity, c(city).alias("_vote")), identity, "left").join(dominant.select(area, c(city).alias("_area_city")), area, "left")
    other = c("_vote").isNotNull() & (c("_vote") == c("_area_city")) & ~c(stated).eqNullSafe(c("_vote"))
    return rows.withColumns({"corrected": F.coalesce(other, F.lit(False)), stated: F.when(other, c("_vote")).otherwise(c(stated))}).drop("_vote", "_area_city")


def search_terms(df: DataFrame, name: Column, region: str, known: DataFrame) -> DataFrame:
    """Names to look up: one row for each cleaned name, its branches, most frequent region, and whether the chain is known."""
    rows = df.withColumn("term", name)
    where = modes(rows, ["term"], region).select("term", region)
    out = rows.groupBy("term").agg(F.count("*").alias("branches")).join(where, "term", "left")
    return out.join(known.select(F.lower("term").alias("_known")).distinct(), F.lower("term") == c("_known"), "left").select("term", "branches", region, c("_known").isNotNull().alias("known_chain"))


def separated(before: DataFrame, after: DataFrame, identity: str, group: str) -> DataFrame:
    """Groups that shared a value before: fully, partly or not apart after."""
    was = before.filter(c(group).isNotNull()).select(identity, c(group).alias("was"))
    now = was.join(after.select(identity, c(group).alias("now")), identity)
    counts = now.groupBy("was").agg(F.count("*").alias("members"), F.countDistinct(F.coalesce(c("now").cast("string"), F.concat(F.lit("row:"), c(identity).cast("string")))).alias("groups")).filter("members > 1")
    verdict = F.when(c("groups") == c("members"), "fully").when(c("groups") > 1, "partly").otherwise("not")
    return counts.select("was", "members", "groups", verdict.alias("verdict"))
