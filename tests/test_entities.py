"""Entities: brands, branches, menus, goods and areas, case by case."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeshed.functions import text as t
from lakeshed.operators import entities as e
from lakeshed.operators.similarity import token_set

SAME = [
    ("Salt & Spice", "Salt and Spice", True), ("Nayaab Handi", "Nayaab Haandi", True), ("Burger King", "Burger King Marina Mall", True), ("Teyyar Cake & Flower", "Teyyar Flower & Cake", True), ("Laduree", "Ladur\u00e9e Marina Mall", True),
    ("Tacos", "Cafteria Tacos", False), ("The Korean Restaurant", "Hanok Korean Restaurant", False), ("Artisan Bakery", "Bloomsbury's Boutique Cafe & Artisan Bakery", False), ("ab", "ab", False), (None, "x", False), ("", "", False),
    ("zaki", "zaki grill", True), ("Zaki Restaurant", "The Zaki - Deira", True), ("Juice Center", "Haji Ali Juice Center", False), ("Zaki Handi House", "Gelateria Zaki Handi House", True), ("Zaki Handi House", "Old Zaki Handi House", True), ("Zaki Handi House", "Wonderful Zaki Handi House", False),
    ("Mix Bubble Zaki Handi", "Zaki Handi", True), ("Mix Bubble Zaki", "Zaki", False), ("Mix Bubble Zaki Handi House", "Zaki Handi House", True), ("Sushi Art", "SushiArt - \u0633\u0648\u0634\u064a - Mirdif", True),
]


def test_same_brand(spark):
    rows = spark.createDataFrame([(k, *x) for k, x in enumerate(SAME)], "k int, a string, b string, want boolean")
    got = rows.select("k", e.same_brand(F.col("a"), F.col("b"), ["old"]).alias("got")).collect()
    assert {r["k"]: r["got"] for r in got} == {k: x[2] for k, x in enumerate(SAME)}


@pytest.mark.parametrize(
    ("brand", "title", "want"),
    [("Kyoto", "Kyoto burger", True), ("Kyoto", "A Kyoto Sip", False), ("Leo", "Leo&Loona", False), ("Trigo & Taco", "TRIGO&TACO", True), ("Trigo & Taco", "Trigo and Taco LLC", True), ("Khafaief Cafeteria", "Al Khafaief Cafeteria", True), ("Juice Center", "Haji Ali Juice Center", False), ("", "x", False), (None, "x", False), ("Kyoto", None, False)],
)
def test_leads(spark, brand, title, want):
    assert spark.createDataFrame([(brand, title)], "b string, t string").select(e.leads(F.col("b"), F.col("t"))).first()[0] is want


def test_places_of_brands(spark):
    rows = [(1, "q", "Kyoto", "Kyoto one", 25.0, 55.0), (2, "q", "Kyoto", "Kyoto two", 25.00001, 55.0), (3, "q", "Kyoto", "Kyoto", None, None), (4, "q", "Kyoto", "Kyoto", None, None), (5, "q", "Kyoto", "My Kyoto", 26.0, 55.0), (6, "z", "Leo", "ليو", 25.0, 55.0), (7, "t", "Trigo and Taco", "Trigo Taco House", 25.0, 55.0), (8, "t", "Trigo and Taco", "Trigo & Taco House", 25.0, 55.1)]
    df = spark.createDataFrame(rows, "id int, q string, brand string, title string, lat double, lon double")
    assert sorted(r["id"] for r in e.places_of_brands(df, "q", "brand", "title", F.lit(True), [F.asc("id")]).collect()) == [1, 3, 4, 6, 8]


def test_items_matched_against_all_pairs(spark):
    words = ["chicken", "chiken", "burger", "beef", "hot", "rolls", "roll", "tea"]
    names = [f"{a} {b}" for a in words for b in words] + ["", None, "teaa", "Chicken  Burger!"]
    ours = [(k, v, n) for v in (1, 2) for k, n in enumerate(names[v::2], 1000 * v)]
    theirs = [(k, v, n) for v in (1, 2, 3) for k, n in enumerate(names[3 - v :: 3], 10_000 * v)]
    got = e.items_matched(spark.createDataFrame(ours, "a int, v int, name string"), spark.createDataFrame(theirs, "b int, v int, name string"), "v", "a", "b", "name")
    import re

    key = lambda s: None if s is None else " ".join(re.sub(r"[^\w\s]|_", " ", s.lower()).split())
    want = {}
    for a, v, n in ours:
        x = key(n)
        pairs = [(b, key(m)) for b, w, m in theirs if w == v and m is not None]
        same = [b for b, y in pairs if y == x]
        scored = [(-token_set(x, y), b) for b, y in pairs] if x else []
        best = min(scored, default=(0, None))
        want[a] = (min(same), "exact", 100.0) if same else ((best[1], "fuzzy", -best[0]) if best[0] <= -80 else (None, "unmatched", None))
    assert {r["a"]: (r["b"], r["method"], r["score"]) for r in got.collect()} == want


def test_non_food(spark):
    rows = [
        (1, "Red Rose Bouquet", None, "Flowers", False, "A"), (2, "Cake Knife", None, "Tools", False, "C0"), (3, "Black Tray With Flower", "Edible chocolate", "Gifts", False, None), (4, "Teddy 30 Cm Red", None, "Misc", False, "C"), (5, "Chicken Rice", None, "Misc", False, None),
        (6, "Soap", "a bouquet", "Misc", False, None), (7, "Vase Bouquet", "bouquet of roses", "Misc", False, "B"), (8, None, None, None, None, None), (9, "Gift Box", None, "Misc", False, None),
        (10, "Teddy", None, "Shelf", False, "A"), *((k, f"thing {k}", None, "Shelf", True, None) for k in range(11, 15)),
    ]
    rows = [(*r[:5], None if r[5] == "C0" else r[5]) for r in rows]
    df = spark.createDataFrame([r[:5] for r in rows], "id int, name string, said string, section string, labelled boolean")
    out = e.non_food(df, "name", "said", "section", F.col("labelled"), ["bouquet", "knife", "teddy"], ["red", "cm", "box"], r"\b(bouquet|flowers)", r"\b(cake|chocolate|chicken|rice)\b", r"(?i)\b\d+\s*cm\b")
    assert {r["id"]: r["tier"] for r in out.collect()} == {r[0]: r[5] for r in rows}


def test_last_noun(spark):
    got = spark.createDataFrame([("Teddy 30 Cm Red",), ("red",), (None,), ("12",)], "x string").select(e.last_noun(F.col("x"), ["red", "cm"])).collect()
    assert [r[0] for r in got] == ["teddy", "red", "", ""]


def test_listings_and_brands(spark):
    df = spark.createDataFrame([(1, "a", 7), (2, "a", 7), (3, "a", 8), (4, "b", None), (5, "c", 2), (6, "c", 1)], "id int, brand string, bid int")
    ids, off = e.brand_ids(df, "brand", "bid")
    assert {tuple(r) for r in ids.collect()} == {("a", 7), ("c", 1)}
    assert sorted(r["id"] for r in off.collect()) == [3, 5]


def test_nulls_and_empty_tables(spark):
    place = "id int, name string, lat double, lon double"
    a, none = spark.createDataFrame([(1, None, 25.0, 55.0), (2, "x", None, None)], place), spark.createDataFrame([], place).withColumnRenamed("id", "k")
    assert [r["verdict"] for r in e.nearest_verdicts(a, none, "id", "k", "name").collect()] == ["New", "New"]
    linked = a.withColumn("link", F.lit(None).cast("int"))
    assert {r["method"] for r in e.entity_matches(linked, none, "id", "k", "link", "name").collect()} == {"none"}
    assert e.transferred(a, none.withColumn("kind", F.lit("z")), "id", "k", "name", ["kind"]).count() == 0
    near = spark.createDataFrame([(9, "x", 25.0, 55.0)], place).withColumnRenamed("id", "k")
    assert {(r["id"], r["k"], r["verdict"]) for r in e.nearest_verdicts(a, near, "id", "k", "name").collect()} == {(1, 9, "New"), (2, None, "New")}


def test_address_words(spark):
    cases = [
        ("Al Ain, Abu Dhabi, UAE", "Al Ain"), ("Khorfakkan, Sharjah", "Khor Fakkan"), ("marina, DUBAI, U.A.E.", "Dubai"), ("Muscat", "Unknown"), (None, "Unknown"), ("", "Unknown"), ("Dubai Road - Al Majaz - Sharjah", "Sharjah"), ("Al Ain Street, Deira, Dubai", "Dubai"),
        ("Abu Dhabi Gate, Ajman", "Ajman"), ("Al Ain Rd - Abu Dhabi - United Arab Emirates", "Abu Dhabi"), ("x - Ras Al-Khaimah", "Ras Al Khaimah"), ("Old Fujairah Fort", "Fujairah"), ("al ain highway", "Unknown"),
    ]
    found = [("Shop 1 - Deira - Dubai - The Mall", "Dubai"), ("Kalba", "Kalba"), ("Dubai Mall", None), (None, None)]
    assert [r[0] for r in spark.createDataFrame(found, "a string, w string").select(t.last_known_city(F.col("a"))).collect()] == [w for _, w in found]
    tails = [("https://x/uae/menu/zaki-grill-al-barsha?aid=1", "Zaki Grill!", "al barsha"), ("https://x/zaki", "Zaki", None), ("https://x/other-place", "Zaki", None), (None, "x", None), ("https://x/a", None, None)]
    assert [r[0] for r in spark.createDataFrame(tails, "u string, n string, w string").select(t.slug_tail(F.col("u"), F.col("n"))).collect()] == [w for *_, w in tails]
    assert [r[0] for r in spark.createDataFrame(cases, "a string, w string").select(t.emirate(F.col("a"))).collect()] == [w for _, w in cases]
    pop = [("Picks for you 🔥", True), ("Best Sellers", True), ("Soups", False), (None, False)]
    assert [r[0] for r in spark.createDataFrame(pop, "a string, w boolean").select(t.popular(F.col("a"))).collect()] == [w for _, w in pop]


def test_smears_by_spread_and_address(spark):
    """Three places within 850 m of each other whose box is wider; rows that say only their area; a real smear."""
    from lakeshed.operators import resolving as r

    near = [(25.0, 55.0), (25.0072, 55.0), (25.0036, 55.00735)]
    rows = [(k, 1, "Shop 1", "Deira", *p) for k, p in enumerate(near)] + [(k + 10, 2, " deira ", "Deira", 25.0 + k, 55.0) for k in range(2)] + [(k + 20, 3, ("Shop 9", "SHOP  9")[k], "Deira", 25.0 + k / 10, 55.0) for k in range(2)] + [(30, None, "Shop 9", "Deira", 25.0, 55.0), (31, 4, None, None, 25.0, 55.0), (32, 5, "Shop 3", None, None, None)]
    df = spark.createDataFrame(rows, "id int, chain int, raw string, area string, lat double, lon double")
    out = r.smeared(df, "id", "chain", "raw", "area").collect()
    assert [(x["chain"], x["address"], x["branches"]) for x in out] == [(3, "shop 9", 2)] and 11_000 < out[0]["spread"] < 11_300
    cases = [("Dubai", "Ajman", None, None, None, "wrong emirate"), ("Dubai", None, "a", True, "a", "consistent"), (None, None, "a", True, "b", "wrong area"), (None, "Dubai", "a", False, "a", "unverified"), (None, None, None, None, None, "unverified")]
    got = spark.createDataFrame(cases, "p string, s string, t string, l boolean, f string, w string").select(r.smear_verdict(*[F.col(x) for x in "pstlf"]), "w").collect()
    assert all(x[0] == x[1] for x in got)


def test_outlets_in_any_order(spark):
    """One place and address, one row closed: open whatever the order of rows."""
    from lakeshed.operators import resolving as r

    rows = [("b", 1, "x", True), ("b", 1, "x", False), ("b", 2, "", True), ("b", None, "y", False), ("c", 3, None, None)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "brand string, place int, address string, closed boolean").coalesce(1)
        out = {x["brand"]: (x["rows"], x["outlets"], x["open"], x["cut"]) for x in r.outlets(df, ["brand"], [], "place", "address", F.col("closed"), 4).collect()}
        assert out == {"b": (4, 2, 1, True), "c": (1, 1, 1, False)}
    sites = [("https://Shop.Brand.co.uk:80/x", "brand.co.uk"), ("www.brand.com", "brand.com"), ("localhost", None), ("co.uk", "co.uk"), (None, None)]
    assert [x[0] for x in spark.createDataFrame(sites, "u string, w string").select(r.registrable_domain(F.col("u"))).collect()] == [w for _, w in sites]
    cases = [("C\u00f4te & Co", "x.com", "title"), ("Laundry cote", "x.com", None), ("Other", "https://cote.com/1", "domain"), (None, None, None)]
    how = r.outlet_match(F.col("t"), F.col("u"), F.array(F.lit("cote")), F.array(F.lit("laundry")), F.lit("cote.com"))
    assert [x[0] for x in spark.createDataFrame(cases, "t string, u string, w string").select(how).collect()] == [w for *_, w in cases]


def test_relisting_through_the_chain(spark):
    """Same chain, area, name and cuisine, other slug, 2.2 km apart is a candidate; a chain's other names are none."""
    from lakeshed.operators import tiers

    schema = "id int, slug string, chain int, area int, words string, cuisines array<string>, lat double, lon double"
    new = spark.createDataFrame([(1, "a", 7, 3, "grill zaki", ["x"], 25.0, 55.0), (2, None, None, None, None, None, None, None)], schema)
    old = spark.createDataFrame([(9, "b", 7, 3, "grill zaki", ["x"], 25.02, 55.0), (10, "c", 7, 3, "tea time", ["x"], 25.5, 55.0), (11, "d", 7, 4, "grill zaki", ["x"], 25.02, 55.0), (12, None, None, None, None, None, None, None)], schema)
    assert {tuple(x) for x in tiers.relisting_candidates(new, old, ["cuisines"], "words").collect()} == {(1, 9)}


def test_areas_by_eight_methods(spark):
    from lakeshed.operators import resolving as r

    rows = [(1, "a", None, None), (2, "b", None, None), (3, "c", None, None), (4, "d", None, None), (5, "e", None, None), (6, "f", "Deira", None), (7, "f", " old deira ", None), (8, "f", "x - Deira - y", "Dubai"), (9, "f", "Deira, 4", "Ajman"), (10, "f", "Green Valley Villas", None), (11, "f", " ", None), (12, "f", "12", None)]
    df = spark.createDataFrame(rows, "id int, source string, raw string, city string")
    make = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    out = r.resolved_areas(
        df, "id", make([("Deira", "Dubai"), ("Corniche", None)], ["area", "city"]), spark.createDataFrame([(1, "Answered")], "id int, area string"), make([("b", "Direct")], ["source", "area"]),
        make([("c", "Deira"), ("d", "Newtown"), ("e", "No"), ("f", "Deira")], ["source", "area"]), make([("Old Deira", "Deira")], ["raw", "area"]), make([("No",)], ["area"]),
    )
    got = {x["id"]: (x["area"], x["method"]) for x in out.collect()}
    assert got == {
        1: ("Answered", "answer"), 2: ("Direct", "direct"), 3: ("Deira", "page"), 4: ("Newtown", "page, new"), 5: (None, "unresolved: rejected"), 6: ("Deira", "exact"), 7: ("Deira", "cleaned"), 8: ("Deira", "rules"), 9: (None, "unresolved: other city"), 10: ("Green Valley Villas", "candidate, new"),
        11: (None, "unresolved: empty"), 12: (None, got[12][1]),
    }
    assert got[12][1].startswith("unresolved")


def test_rectified_areas(spark):
    from lakeshed.operators import resolving as r

    schema = "id int, verified boolean, page string, slug string, cleaned string, current string, raw string, city string"
    rows = [
        (1, False, "deira", None, None, "x", None, "Dubai"), (2, False, "Deira", "Corniche", None, "x", None, "Ajman"), (3, False, "Old Town", "Deira", None, "x", None, None), (4, False, "\u062f\u0628\u064a", None, "CORNICHE", "x", None, None), (5, None, "Dubai", None, None, "Dubai", None, None),
        (6, True, "Corniche", None, None, "x", "Shop 1 - Deira, Dubai", "Dubai"), (7, True, None, None, None, "Nowhere", "Shop 1", None), (8, None, None, None, None, None, None, None), (9, True, None, None, None, "corniche", None, None), (10, False, None, None, None, "\u062f\u064a\u0631\u0629", None, None),
    ]
    words = spark.createDataFrame([("Deira", "Dubai"), ("Corniche", None)], "area string, city string")
    got = {x["id"]: (x["area"], x["method"]) for x in r.rectified_areas(spark.createDataFrame(rows, schema), "id", words, ["Dubai", "Ajman"]).collect()}
    assert got == {
        1: ("Deira", "page"), 2: ("Deira", "page, not listed"), 3: ("Old Town", "page, not listed"), 4: ("Corniche", "cleaned"), 5: (None, "none"), 6: ("Deira", "address"), 7: ("Nowhere", "kept, not listed"), 8: (None, "none"), 9: ("Corniche", "current"), 10: (None, "none"),
    }


def test_many_rules_by_what_they_hold(spark):
    """Above the number that is sent, rules are joined; the results are the same."""
    from lakeshed.operators import tiers

    rules = spark.createDataFrame([(k, f"(?i)dish{k}\\b", f"l{k}") for k in range(60)] + [(60, "(?i)tea", "drink")], "order int, pattern string, label string")
    rows = spark.createDataFrame([(1, "Dish7 and dish3", None), (2, "x", "iced TEA"), (3, None, None), (4, "dish70", "dish5")], "id int, name string, category string")
    for sent in (1000, 5):
        got = {r["id"]: (r["label"], r["field"]) for r in tiers.rule_value(rows, "id", ["name", "category"], rules, sent).collect()}
        assert got == {1: ("l3", "name"), 2: ("drink", "category"), 3: (None, None), 4: ("l5", "category")}
