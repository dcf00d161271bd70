"""Which known entity a record is: by id, place and name; verdicts on branches, brands, areas, goods and zones.

Scorers are columns of two texts from 0 to 100; candidates come from joins on
place, key or shared words first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshed.functions.text import ARABIC, area_shaped, collapsed, item_key, latin_folded, match_key
from lakeshed.functions.values import metres
from lakeshed.operators.choosing import first_rows, modes
from lakeshed.operators.nearby import exact_spread, nearest_within, within
from lakeshed.operators.similarity import covered_texts, indel_score, near_texts, sorted_text, token_set_score, token_sort_score

Scorer = Callable[[Column, Column], Column]
c = F.col


# Records and known entities --------------------------------------------------


def _named(pairs: DataFrame, left: DataFrame, right: DataFrame, lid: str, rid: str, name: str, score: Scorer) -> DataFrame:
    rows = pairs.join(left.select(lid, c(name).alias("_a")), lid).join(right.select(rid, c(name).alias("_b")), rid)
    return rows.withColumn("similarity", score(c("_a"), c("_b")) / 100)


def _near_named(left: DataFrame, right: DataFrame, lid: str, rid: str, reach: float, name: str, score: Scorer) -> DataFrame:
    """Pairs within reach with both names, which go along with the places."""
    rows = within(left.withColumn("_a", c(name)), right.withColumn("_b", c(name)), lid, rid, reach, own=["_a"], other=["_b"])
    return rows.withColumn("similarity", score(c("_a"), c("_b")) / 100)


def entity_matches(df: DataFrame, known: DataFrame, identity: str, known_id: str, link: str, name: str, score: Scorer = token_sort_score) -> DataFrame:
    """The known entity of each record: by the id in its link, else the nearest that a tier of distance and name accepts.

    Both sides have ``name`` (normalised), lat, lon; ``known_id`` is unique.  A
    linked id counts even if it is unknown; its place and name are only checked.
    Columns: identity, known_id, method, confidence, verified.
    """
    own = known.select(c(known_id).alias(link), F.lit(True).alias("_known"), c(name).alias("_b"), c("lat").alias("_lat"), c("lon").alias("_lon"))
    off, near = metres(c("lat"), c("lon"), c("_lat"), c("_lon")), score(c(name), c("_b")) / 100
    check = F.when(off.isNull(), "no place").when(off > 500, "place differs").when(near < 0.5, "name differs").otherwise("agrees")
    linked = df.filter(c(link).isNotNull()).join(own, link, "left")
    by_link = linked.select(
        identity, c(link).alias(known_id), F.when(c("_known"), "linked id").otherwise("linked id, unknown").alias("method"), F.when(c("_known"), 1.0).otherwise(0.95).alias("confidence"), F.when(c("_known"), check).otherwise("to be captured").alias("verified")
    )
    rest = df.filter(c(link).isNull())
    rows = _near_named(rest, known, identity, known_id, 200.0, name, score)
    far, sim = c("distance"), c("similarity")
    tier = F.when((far <= 30) & (sim >= 0.85), 1).when((far <= 100) & (sim >= 0.90), 2).when(sim >= 0.95, 3)
    found = first_rows(rows.withColumn("_t", tier).filter("_t is not null"), [identity], [F.asc("distance"), F.desc("similarity"), F.asc(known_id)])
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), c("_t"))
    by_place = found.select(identity, known_id, pick("30 m", "100 m", "200 m").alias("method"), pick(0.99, 0.95, 0.80).alias("confidence"), pick("agrees", "agrees", "to review").alias("verified"))
    return df.select(identity).join(by_link.unionByName(by_place), identity, "left").select(identity, known_id, F.coalesce("method", F.lit("none")).alias("method"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "verified")


def transferred(df: DataFrame, known: DataFrame, identity: str, known_id: str, name: str, labels: list[str], score: Scorer = token_sort_score) -> DataFrame:
    """Labels of a known entity for records without: close by and of a close name.

    Within 30 m a similar name or within 50 m the same one counts first, then the
    nearest within 100 m of a very similar name.  Columns: identity, known_id,
    method, confidence, the labels; records without a match are left out.
    """
    rows = _near_named(df, known, identity, known_id, 100.0, name, score)
    far, sim = c("distance"), c("similarity")
    method = F.when((far <= 30) & (sim >= 0.85), "30 m").when((far <= 50) & (c("_a") == c("_b")), "50 m, same name").when(sim >= 0.90, "100 m")
    order = [F.asc(c("method") == "100 m"), F.asc("distance"), F.asc(known_id)]
    best = first_rows(rows.withColumn("method", method).filter("method is not null"), [identity], order)
    return best.join(known.select(known_id, *labels), known_id).select(identity, known_id, "method", F.when(c("method") == "30 m", 0.99).otherwise(0.95).alias("confidence"), *labels)


def best_of_set_and_sort(a: Column, b: Column) -> Column:
    return F.greatest(token_set_score(a, b), token_sort_score(a, b))


def nearest_verdicts(df: DataFrame, known: DataFrame, identity: str, known_id: str, name: str, reach: float = 100.0, k: int = 5, high: float = 60.0, low: float = 45.0, score: Scorer = best_of_set_and_sort) -> DataFrame:
    """Matched, Review or New: of the k nearest known places within reach the one of the best name, as one spot may hold several brands.

    Columns: identity, known_id, score, verdict.  Without a place in reach, or a name alike, it is new.
    """
    near = nearest_within(df, known, identity, known_id, reach, k)
    rows = _named(near, df, known, identity, known_id, name, score).withColumn("score", F.coalesce(c("similarity") * 100, F.lit(0.0)))
    best = first_rows(rows, [identity], [F.desc("score"), F.asc("distance"), F.asc(known_id)]).select(identity, known_id, "score")
    verdict = F.when(c("score") >= high, "Matched").when(c("score") >= low, "Review").otherwise("New")
    return df.select(identity).join(best, identity, "left").select(identity, known_id, "score", verdict.alias("verdict"))


# Brands ----------------------------------------------------------------------


def brand_ids(listings: DataFrame, brand: str, brand_id: str) -> tuple[DataFrame, DataFrame]:
    """(brand, id) by most listings, the smallest on a tie; and the listings that say another id."""
    ids = modes(listings, [brand], brand_id).select(brand, c(brand_id).alias("canonical"))
    return ids, listings.join(ids, brand).filter(c(brand_id) != c("canonical"))


def listing_distances(places: DataFrame, listings: DataFrame, place: str, listing: str, brand: str, reach: float = 100.0) -> DataFrame:
    """(place, distance): places that are a listing's nearest of its brand within reach, with the least such distance."""
    near = nearest_within(listings, places, listing, place, reach, on=[brand])
    return near.groupBy(place).agg(F.min("distance").alias("distance"))


def _latin(x: Column, amp: str) -> Column:
    out = F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(x, F.lit("")), ARABIC, " ")), "&", amp)
    return collapsed(F.regexp_replace(out, "[^a-z0-9]+", " "))


def leads(brand: Column, title: Column) -> Column:
    """Whether a title begins with a brand; only words after it may be added.

    In a brand of several words ``&`` and ``and`` part words, in one of a single word ``&`` joins them.
    The article before a title doesn't count.
    """

    def first(b: Column, t: Column) -> Column:
        bare = F.regexp_replace(t, "^al ", "")
        return (b != "") & F.exists(F.array(t, bare), lambda x: F.startswith(F.concat(x, F.lit(" ")), F.concat(b, F.lit(" "))))

    parted = lambda x: collapsed(F.regexp_replace(_latin(x, " "), r"\band\b", " "))
    return F.when(F.contains(_latin(brand, " and "), F.lit(" ")), first(parted(brand), parted(title))).otherwise(first(_latin(brand, ""), _latin(title, "")))


def places_of_brands(found: DataFrame, query: str, brand: str, title: str, inside: Column, order: list[Column]) -> DataFrame:
    """Search results that are branches: in the country, the brand leading the title, one for each place of four digits.

    The whole brand, with ``&`` as ``and``, also has to stand in the title.  A title in Arabic script alone counts if the search found nothing else.
    """
    alone = found.groupBy(query).agg((F.count("*") == 1).alias("_alone"))
    foreign = (_latin(c(title), " ") == "") & c("_alone")
    whole = lambda x: F.concat(F.lit(" "), _latin(x, " and "), F.lit(" "))
    named = leads(c(brand), c(title)) & F.contains(whole(c(title)), whole(c(brand)))
    kept = found.join(alone, query).filter(inside & (named | foreign)).drop("_alone")
    unknown = c("lat").isNull() | c("lon").isNull()
    own = first_rows(kept.filter(~unknown).withColumns({"_y": F.round("lat", 4), "_x": F.round("lon", 4)}), [query, "_y", "_x"], order).drop("_y", "_x")
    return own.unionByName(kept.filter(unknown))


def brand_types(found: DataFrame, query: str, known_chain: Column) -> DataFrame:
    """(query, places, type): a known chain, several places or one."""
    out = found.groupBy(query).agg(F.count("*").alias("places"), F.max(known_chain).alias("_known"))
    return out.select(query, "places", F.when(c("_known"), "Global Chain").when(c("places") >= 2, "Local Chain").otherwise("Independent").alias("type"))


#: Words that say nothing of a brand, wherever they stand; words that may stand before a brand.
GENERIC = ("restaurant", "restaurants", "resturant", "cafe", "café", "cafeteria", "llc", "l.l.c", "co", "company", "trading", "branch", "est", "the")
DROPPED = (*GENERIC, "and", "al", "el", "of", "dubai", "sharjah", "ajman", "fujairah", "uae", "abudhabi", "cafteria")
LEADING = ("main", "branch", "new", "gelateria", "patisserie", "pizzeria", "trattoria", "dine", "in", "delivery")
#: A name of these words alone is a description.
FOOD_WORDS = tuple("""
juice juices center centre shawarma shawerma grill grills grilled pizza pizzeria burger burgers biryani
biriyani mandi mandy madhbi kitchen sweets sweet bakery bakers bake coffee tea house corner express food
foods chicken fried broast broasted kabab kebab kababs kebabs noodle noodles sushi bar lounge shop cake
cakes dining oriental cuisine fresh healthy diet meal meals plans plan star royal grand new time spot
point palace garden hut box bowl bowls salad salads shake shakes ice cream falafel falafil karak chai
sandwich sandwiches fish seafood bbq pasta tandoor tandoori dosa chaat pastries pastry patisserie
confectionery chocolate chocolates dessert desserts waffle waffles crepe crepes donut donuts fries wings
taco tacos steak steaks rolls roll wraps wrap platter mix fusion bistro deli market mart grocery butchery
yemen yemeni lebanese lebanon turkish indian india pakistani pakistan syrian iranian persian arabic
arabian emirati egyptian chinese thai filipino korean japanese italian mexican american british german
russian afghan kerala malabar hyderabadi hyd bombay mumbai delhi punjabi nepali nepalese sri lankan
ethiopian african moroccan iraqi jordanian palestinian saudi kuwaiti gulf asian continental
international special original famous best taste tasty delight delights hot spicy golden city world
family first one by for la le
""".split())
_SEPARATOR = r"\s+-\s+|,|\||\("


def _compact(x: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(x, F.lit("")), ARABIC, " ")), "[^a-z0-9]", "")


def _core(x: Column) -> Column:
    """The words before a branch's separator, without generic ones at the end and the article before, joined."""
    words = F.array_join(F.regexp_extract_all(F.lower(F.split(F.coalesce(x, F.lit("")), _SEPARATOR)[0]), F.lit(r"(?U)[\w'&]+"), F.lit(0)), " ")
    bare = F.regexp_replace(F.regexp_replace(words, rf"(?:(?:^| )(?:{'|'.join(w for w in GENERIC if '.' not in w)}))+$", ""), "^(?:the(?: |$))+", "")
    return F.regexp_replace(bare, "[^a-z0-9]", "")


def _brand_words(x: Column, dropped: Sequence[str]) -> Column:
    """Words of a name before a branch's separator: accents folded, other scripts out, without ``dropped`` ones."""
    plain = F.regexp_replace(latin_folded(F.coalesce(x, F.lit(""))), r"[^\x00-\x7F]+", " ")
    said = F.regexp_replace(F.lower(F.split(plain, _SEPARATOR)[0]), r"\babu\s*dhabi\b", " abudhabi ")
    return F.filter(F.regexp_extract_all(said, F.lit("[a-z0-9]+"), F.lit(0)), lambda w: ~w.isin(*dropped))


def same_brand(name: Column, title: Column, areas: Sequence[str] = (), food: Sequence[str] = FOOD_WORDS, score: Scorer = indel_score) -> Column:
    """Whether two names are one brand, given that their places are the same.

    One begins with the other, as they stand or without generic words, from four
    letters on; or one is a variant of the other: the same but for ``&`` and accents,
    a branch's suffix, the order of words, a spelling of the whole name, or a whole name of several
    words inside the other, before which the title may have only words of
    ``LEADING`` and ``areas``.  A name of ``food`` words alone has no variants.
    """
    begins = lambda a, b: (F.length(a) >= 4) & (F.length(b) >= 4) & (F.startswith(a, b) | F.startswith(b, a))
    a, b = _brand_words(name, DROPPED), _brand_words(title, DROPPED)
    x, y = F.array_join(a, ""), F.array_join(b, "")
    ours = F.length(x) <= F.length(y)  # the shorter is the name
    s, long = F.when(ours, a).otherwise(b), F.when(ours, b).otherwise(a)
    sj, lj, n = F.array_join(s, ""), F.array_join(long, ""), F.size(s)
    spelt = ((F.least(F.size(a), F.size(b)) >= 2) | (F.length(sj) >= 8)) & (F.length(sj) >= 6) & (score(x, y) >= 88)
    upto = F.when(F.size(long) > 0, F.sequence(F.lit(1), F.size(long))).otherwise(F.array().cast("array<int>"))
    run = F.filter(upto, lambda i: F.exists(upto, lambda j: (j >= i) & (F.array_join(F.slice(long, i, F.greatest(j - i + 1, F.lit(1))), "") == sj)))
    before = F.slice(long, F.lit(1), F.greatest(F.coalesce(F.try_element_at(run, F.lit(1)), F.lit(1)) - 1, F.lit(0)))
    inside = (n >= 2) & (F.length(sj) >= 8) & (F.size(run) > 0) & (~ours | F.forall(before, lambda w: w.isin(*LEADING, *areas)))
    like = F.when(x == y, F.length(x) >= 3).otherwise((((n >= 2) | (F.length(sj) >= 7)) & F.startswith(lj, sj)) | ((n >= 2) & (F.array_sort(a) == F.array_sort(b))) | spelt | inside)
    identical = (F.length(x) >= 3) & (_brand_words(name, ("and",)) == _brand_words(title, ("and",)))
    variant = (x != "") & (y != "") & (identical | (~F.forall(s, lambda w: w.isin(*food)) & like))
    return F.coalesce(begins(_compact(name), _compact(title)) | begins(_core(name), _core(title)) | variant, F.lit(False))


def branch_verdicts(branches: DataFrame, found: DataFrame, identity: str, name: str, title: str, most: float = 300.0, same: Callable[[Column, Column], Column] = same_brand) -> DataFrame:
    """Whether a branch is listed where it stands: found, brand only elsewhere, no such brand, nothing found.

    ``found`` has rows (identity, title, place_lat, place_lon).  Columns: identity,
    verdict, title, metres of the nearest place of the brand.
    """
    rows = branches.select(identity, name, "lat", "lon").join(found, identity, "left")
    off = F.when(same(c(name), c(title)), metres(c("lat"), c("lon"), c("place_lat"), c("place_lon")))
    best = rows.withColumn("metres", off).groupBy(identity).agg(F.count(title).alias("_n"), F.min(F.when(c("metres").isNotNull(), F.struct("metres", title))).alias("_x"))
    verdict = F.when(c("_x.metres") <= most, "found").when(c("_x").isNotNull(), "brand only elsewhere").when(c("_n") > 0, "no such brand").otherwise("nothing found")
    return best.select(identity, verdict.alias("verdict"), F.when(c("_x.metres") <= most, c(f"_x.{title}")).alias(title), c("_x.metres").alias("metres"))


def identity_class(new: DataFrame, before: DataFrame, since: DataFrame, chain: str, brand: str) -> DataFrame:
    """Adds ``found_as``: a branch of a known chain, a known brand's new chain, found by an earlier batch, a new brand."""

    def flag(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
        return df.join(other.filter(c(key).isNotNull()).select(key).distinct().withColumn(name, F.lit(True)), key, "left")

    rows = flag(flag(new, before, chain, "_c"), before, brand, "_b")
    rows = flag(flag(rows, since, chain, "_sc"), since, brand, "_sb")
    kind = F.when(c("_c"), "branch of known chain").when(c("_b"), "known brand, new chain").when(c("_sc") | c("_sb"), "found before").otherwise("new brand")
    return rows.withColumn("found_as", kind).select(*new.columns, "found_as")


# Menus and goods -------------------------------------------------------------


def flattened_menus(menus: DataFrame, restaurants: DataFrame, key: str, told: list[str]) -> DataFrame:
    """A row for each item of each category, with what the restaurants' table says, else the menu's own capture.

    ``menus`` has the key, a struct ``restaurant`` and ``menu`` (category_name, items);
    fields of ``told`` that the capture lacks are null where the table has no such restaurant.
    """
    own = menus.schema["restaurant"].dataType.names
    known = restaurants.select(key, *[c(f).alias(f"_{f}") for f in told], F.lit(True).alias("known"))
    rows = menus.join(first_rows(known, [key], [F.asc_nulls_last(f"_{f}") for f in told]), key, "left")
    said = [(F.when(c("known"), c(f"_{f}")).otherwise(c(f"restaurant.{f}")) if f in own else c(f"_{f}")).alias(f) for f in told]
    rows = rows.select(key, *said, F.coalesce("known", F.lit(False)).alias("known"), F.explode("menu").alias("_m"))
    return rows.select(key, *told, "known", c("_m.category_name").alias("menu_category"), F.explode("_m.items").alias("_i")).select(key, *told, "known", "menu_category", "_i.*")


def items_matched(ours: DataFrame, theirs: DataFrame, venue: str, ours_id: str, theirs_id: str, name: str, least: float = 80.0) -> DataFrame:
    """Each of our items' match of the same venue: by key, else the best by sets of words, at least ``least``.

    Two names reach it only if shared words make up most of one or they are close as
    sorted words; both kinds of pairs are joined, so that none is lost.  Columns: ours_id, theirs_id,
    method, score; the smallest id on a tie.
    """
    x, y = ours.select(venue, ours_id, match_key(c(name)).alias("_a")), theirs.select(venue, theirs_id, match_key(c(name)).alias("_b"))
    y = y.groupBy(venue, "_b").agg(F.min(theirs_id).alias(theirs_id))
    exact = x.join(y, (x[venue] == y[venue]) & (c("_a") == c("_b"))).select(ours_id, theirs_id, F.lit("exact").alias("method"), F.lit(100.0).alias("score"))
    rest = x.join(exact.select(ours_id), ours_id, "left_anti").filter("_a <> ''")
    once = lambda t: sorted_text(F.array_join(F.array_distinct(F.split(t, " ")), " "))
    mine = rest.select(c(venue).alias("_g"), c(ours_id).alias("_x"), once(c("_a")).alias("a"))
    other = y.filter("_b <> ''").select(c(venue).alias("_g"), c(theirs_id).alias("_y"), once(c("_b")).alias("b"))
    pairs = near_texts(mine, other, least, ["_g"]).unionByName(covered_texts(mine, other, least, ["_g"])).distinct()
    scored = pairs.withColumn("score", token_set_score("a", "b")).filter(c("score") >= least)
    rows = mine.join(scored, ["_g", "a"]).join(other, ["_g", "b"]).select(c("_x").alias(ours_id), c("_y").alias(theirs_id), "score")
    best = first_rows(rows, [ours_id], [F.desc("score"), F.asc(theirs_id)])
    matched = exact.unionByName(best.select(ours_id, theirs_id, F.lit("fuzzy").alias("method"), "score"))
    return ours.select(ours_id).join(matched, ours_id, "left").withColumn("method", F.coalesce("method", F.lit("unmatched")))


def last_noun(x: Column, tails: Sequence[str], sizes: str = "") -> Column:
    """The last word that is no container, size or colour; the first one if all are.  ``sizes`` is a pattern of what is cut first."""
    words = F.regexp_extract_all(F.lower(F.regexp_replace(x, sizes, " ") if sizes else x), F.lit("[a-z]+"), F.lit(0))
    return F.coalesce(F.try_element_at(F.filter(words, lambda w: ~w.isin(*tails)), F.lit(-1)), F.try_element_at(words, F.lit(1)), F.lit(""))


def non_food(df: DataFrame, name: str, said: str, section: str, labelled: Column, heads: Sequence[str], tails: Sequence[str], goods: str, food: str, sizes: str = "", least: int = 5) -> DataFrame:
    """Adds ``tier``: A, the name speaks of goods and its section too; B, two fields do; C, the head noun alone; null for food.

    What the description says of food outranks all, what the name or section says
    all but a head noun among ``heads``.  A section of at least ``least`` items of which four fifths are
    ``labelled`` as goods speaks of goods.
    """
    holds = lambda f, p: F.coalesce(F.lower(f).rlike(p), F.lit(False))
    own = F.coalesce(section, F.lit(""))  # items without a section are one
    share = df.groupBy(own.alias("_s")).agg(F.when(F.count("*") >= least, F.avg(F.coalesce(labelled, F.lit(False)).cast("int"))).otherwise(0.0).alias("_share"))
    rows = df.withColumns({"_head": last_noun(c(name), tails, sizes).isin(*heads), "_named": holds(name, goods)}).join(share, own == c("_s"))
    in_said, in_section = holds(said, goods), holds(section, goods)
    fields = (c("_head") | c("_named")).cast("int") + in_said.cast("int") + in_section.cast("int")
    eaten = holds(said, food) | (~c("_head") & (holds(name, food) | holds(section, food)))
    plain = c("_head") & ~holds(name, food) & ~holds(section, food)
    tier = F.when(~eaten, F.when((c("_head") | c("_named")) & (in_section | (c("_share") >= 0.8)), "A").when(fields >= 2, "B").when(plain, "C"))
    return rows.withColumn("tier", tier).select(*df.columns, "tier")


# Areas and zones -------------------------------------------------------------


def beyond_area(raw: Column, area: Column) -> Column:
    """Whether a raw address says more than its area."""
    return ~item_key(raw).eqNullSafe(item_key(area))


def area_smears(df: DataFrame, identity: str, chain: str, raw: str, area: str, most: float = 1000.0, done: DataFrame | None = None) -> DataFrame:
    """(identity, spread): branches of a chain that have only one area between them for places farther apart than ``most``.

    Groups that hold a branch of ``done`` are left out.
    """
    rows = df.filter(c(chain).isNotNull() & c(area).isNotNull() & ~beyond_area(c(raw), c(area)) & c("lat").isNotNull() & c("lon").isNotNull())
    rows = rows.select(identity, "lat", "lon", F.struct(c(chain).alias("chain"), item_key(c(area)).alias("area")).alias("_g"))
    if done is not None:
        rows = rows.join(rows.join(done.select(identity), identity, "left_semi").select("_g").distinct(), "_g", "left_anti")
    far = exact_spread(rows, "_g", identity).filter(c("spread") > most)
    return rows.join(far, "_g").select(identity, "spread")


def ruled_area(df: DataFrame, identity: str, raw: str, city: str, vocabulary: DataFrame) -> DataFrame:
    """(identity, area, method): the whole text as a known area, its longest part that is one, else the longest part shaped like one, to approve.

    ``vocabulary`` has area and, where it is known, its city: an area of another city is refused.
    """
    part = lambda s: collapsed(F.regexp_replace(F.regexp_replace(s, r"\b[23456789CFGHJMPQRVWX]{4,}\+[23456789CFGHJMPQRVWX]{2,}\b", " "), r"(?i)\b(united arab emirates|u\.?a\.?e\.?)\b", " "))
    bare = lambda s: F.regexp_replace(part(s), r"^[ \-,.،]+|[ \-,.،]+$", "")
    parts = F.filter(F.transform(F.split(c(raw), r"\s+-\s+|،|,"), bare), lambda s: (s != "") & ~s.rlike(r"(?i)^[\d\s\-.,#]+$|^[a-z]{1,2}\d{1,4}$"))
    rows = df.select(identity, c(city).alias("_city"), F.trim(raw).alias("_raw"), F.coalesce(parts, F.array().cast("array<string>")).alias("_parts"))
    said = F.concat(F.array(F.struct(F.lit(-1).alias("k"), c("_raw").alias("part"))), F.transform("_parts", lambda s, k: F.struct(k.alias("k"), s.alias("part"))))
    known = vocabulary.groupBy(F.lower("area").alias("_low")).agg(F.min(F.struct("area", "city")).alias("_v"))
    hits = rows.withColumn("_p", F.explode(said)).join(known, F.lower("_p.part") == c("_low"))
    hits = hits.filter(c("_city").isNull() | c("_v.city").isNull() | (c("_city") == c("_v.city")))
    best = hits.groupBy(identity).agg(F.min_by(F.struct(c("_v.area").alias("area"), c("_p.k").alias("k")), F.struct(c("_p.k") >= 0, -F.length("_v.area"), "_p.k")).alias("_x"))
    shaped = F.filter("_parts", lambda s: area_shaped(s) & (F.length(s) >= 3))
    longest = F.array_min(F.transform(shaped, lambda s, k: F.struct((-F.length(s)).alias("n"), k.alias("k"), s.alias("s"))))["s"]
    empty = F.coalesce(c("_raw"), F.lit("")) == ""
    method = F.when(empty, "empty").when(c("_x.k") < 0, "exact").when(c("_x").isNotNull(), "part").when(F.size("_parts") == 0, "nothing left").when(longest.isNotNull(), "candidate").otherwise("no area")
    return rows.join(best, identity, "left").select(identity, F.when(~empty, F.coalesce("_x.area", longest)).alias("area"), method.alias("method"))


def city_leaks(df: DataFrame, area: str, city: str, least: int = 10, share: float = 0.05) -> DataFrame:
    """Rows whose city has less than ``share`` of their area's rows, where the area has ``least`` rows and more."""
    counts = df.filter(c(area).isNotNull() & c(city).isNotNull()).groupBy(area, city).agg(F.count("*").alias("n"))
    total = counts.groupBy(area).agg(F.sum("n").alias("total"))
    few = counts.join(total, area).filter((c("total") >= least) & (c("n") < share * c("total"))).select(area, city)
    return df.join(few, [area, city], "left_semi")


def cross_gates(df: DataFrame, identity: str, cities: Sequence[str], links: Sequence[str] = (), far: float = 1000.0) -> DataFrame:
    """(gate, found): what only several fields together show wrong.

    Rows with area, city, chain, lat, lon and ``links``: cities used as areas, areas that
    differ in spelling alone, areas in Arabic script, rows of a city that their area isn't in,
    and groups that share a link, or a chain and an area, over more than ``far``.
    """
    key = F.regexp_replace(F.lower("area"), "[^a-z0-9]", "")
    twins = df.filter(key != "").groupBy(key.alias("k")).agg(F.countDistinct("area").alias("forms")).filter("forms > 1")
    n = lambda rows, gate: rows.agg(F.count("*").alias("found")).select(F.lit(gate).alias("gate"), "found")
    spread = lambda keys: exact_spread(df.dropna(subset=[*keys, "lat", "lon"]).select(identity, "lat", "lon", F.struct(*keys).alias("_g")), "_g", identity).filter(c("spread") > far)
    gates = [
        n(df.filter(F.lower("area").isin(*[x.lower() for x in cities])), "city as area"), n(twins, "spelling twins"), n(df.filter(c("area").rlike(ARABIC)), "area in Arabic"),
        n(city_leaks(df, "area", "city"), "city leaks"), n(spread(["chain", "area"]), "chain and area apart"), *[n(spread([x]), f"{x} apart") for x in links],
    ]
    return reduce(DataFrame.unionByName, gates)


def area_priorities(areas: DataFrame, enough: float = 0.95) -> DataFrame:
    """Areas still to crawl, by expected new listings for each page left.

    Columns in: area, listings, new_rate (null: 0), pages, pages_done (null: 0); those
    done to ``enough`` and those without pages are left out.  Adds pages_left, expected, efficiency.
    """
    done, left = F.coalesce("pages_done", F.lit(0)), c("pages") - F.coalesce("pages_done", F.lit(0))
    gain = F.coalesce("listings", F.lit(0)) * F.coalesce("new_rate", F.lit(0.0))
    rows = areas.filter((c("pages") > 0) & (done < c("pages") * enough))
    return rows.select("area", left.alias("pages_left"), F.round(gain).cast("long").alias("expected"), F.round(gain / F.greatest(left, F.lit(1)), 2).alias("efficiency")).orderBy(F.desc("efficiency"), F.asc("area"))


def zone_changes(before: DataFrame, now: DataFrame, zone: str, total: str) -> DataFrame:
    """(zone, status, delta): zones whose total changed are to crawl, others not; those without a total before have no baseline."""
    rows = now.filter(c(total).isNotNull()).join(before.select(zone, c(total).alias("_was")), zone, "left")
    delta = c(total) - c("_was")
    return rows.select(zone, F.when(delta.isNull(), "no baseline").when(delta != 0, "changed").otherwise("unchanged").alias("status"), delta.alias("delta"))
