"""Sitemaps, stores, survivors, planned counts and gates of a load, case by case."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshed.operators import gates, nearby, resolving, tiers
from lakeshed.sources import html


def test_sitemaps_with_cycles(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e"), (None, "z"), ("b", "shut"), ("shut", "f")], "parent string, child string")
    entries = spark.createDataFrame([("a", "https://X.org/uae/1"), ("c", "https://x.org/uae/1"), ("c", None), ("e", "late"), ("f", "never"), ("z", "never")], "sitemap string, loc string")
    host, path = html.host_and_path(F.col("loc"))
    flags = {"ours": (host == "x.org") & F.contains(path, F.lit("/uae/"))}
    roots = spark.createDataFrame([("a",), ("a",)], "url string")
    got = html.sitemap_records(links, entries, roots, flags, 2, F.col("url") != "shut")
    assert {tuple(r) for r in got.collect()} == {("a", 0, "https://X.org/uae/1", True), ("c", 1, None, False), ("c", 1, "https://x.org/uae/1", True)}
    deep = html.sitemap_records(links, entries, roots, {}, None, F.col("url") != "shut")
    assert {(r["source_sitemap"], r["depth"]) for r in deep.collect()} == {("a", 0), ("c", 1), ("e", 3)}
    assert html.sitemap_records(links, entries, roots.limit(0), flags).count() == 0


def test_stores_of_all_forms(spark):
    pages = ['var store = [{"a": 1}]; window.STORES = ["x", 2];', '"locations": [{"b": [1]}], var stores = [broken];', "", None, 'markers=[];storeData = [{"c": "d"}];']
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "k int, html string").select("k", html.stores(F.col("html")).alias("s"))
    assert {r["k"]: r["s"] for r in rows.collect()} == {0: ['{"a":1}', "x", "2"], 1: [], 2: [], 3: None, 4: ['{"c":"d"}']}


def test_survivors(spark):
    df = spark.createDataFrame([(1, 1, True), (5, 1, False), (4, 1, True), (7, 7, None), (9, 7, None)], "id int, component int, ok boolean")
    out = nearby.with_survivors(df, "id", "component", F.col("ok"))
    assert {r["id"]: (r["survivor"], r["kept"]) for r in out.collect()} == {1: (4, False), 5: (4, False), 4: (4, True), 7: (9, False), 9: (9, True)}


def test_count_plan(spark):
    names = "k string, official long, report long, report_year int, web long, maps long, published boolean, rejected boolean, reviewed boolean, estimate_low long, estimate_high long, on_maps boolean"
    rows = [
        ("official", 5, 9, 2026, 9, 1, True, None, None, None, None, True),
        ("agreed", None, 100, 2025, 150, 1, True, None, None, None, None, True),
        ("edge", None, 65, 2025, 100, 1, None, None, None, None, None, True),
        ("nearer", None, 1000, 2026, 100, 1, None, None, None, 700, 900, False),
        ("web nearer", None, 1000, 2026, 100, None, None, None, None, 100, 300, False),
        ("reviewed", None, 1000, 2026, 100, None, None, None, True, None, None, False),
        ("rejected", None, 100, 2026, 100, 7, True, True, None, None, None, True),
        ("maps", None, 1000, 2026, 100, 7, None, None, None, None, None, True),
        ("not counted", None, None, None, None, None, None, None, None, None, None, True),
        ("older", None, 100, 2024, 90, 7, None, None, None, None, None, False),
        ("no web", None, 100, 2026, 0, None, None, None, None, None, None, None),
        ("missing", None, None, None, None, None, None, None, None, None, None, None),
    ]
    out = tiers.count_plan(spark.createDataFrame(rows, names), F.col("on_maps"))
    assert {r["k"]: (r["source"], r["planned"], r["note"]) for r in out.collect()} == {
        "official": ("official", 5, None), "agreed": ("report", 100, None), "edge": ("report", 65, None), "nearer": ("report", 1000, "contradicted, report nearer to the estimate"),
        "web nearer": ("web", 100, "contradicted, web nearer to the estimate"), "reviewed": ("report", 1000, None), "rejected": ("published", 100, None), "maps": ("maps", 7, "contradicted, counted on maps"),
        "not counted": ("maps", None, None), "older": ("web", 90, "older report"), "no web": ("report", 100, None), "missing": ("missing", None, None),
    }


def test_region_plan(spark):
    brands = spark.createDataFrame([("sum", 500, None, None, None, 90, 110), ("stated", 500, None, None, None, 400, 500), ("tie", 140, False, None, None, 120, 120), ("no estimate", 500, None, None, None, None, None), ("rejected", 500, True, None, None, 500, 500), ("maps", 500, None, 3, None, 1, 1), ("said", 500, None, 3, 8, 1, 1), ("only stated", 5, None, None, None, 1, 1), ("none", None, None, None, None, None, None)], "b string, stated long, rejected boolean, maps long, published long, estimate_low long, estimate_high long")
    each = [(b, n, v) for b in ("sum", "stated", "tie", "no estimate", "rejected", "maps", "said") for n, v in (("x", 60), ("y", 400), ("z", 9))]
    fixes = [(b, n, v) for b in ("sum", "stated", "tie", "no estimate", "rejected") for n, v in (("y", 40), ("z", None))]
    out = tiers.region_plan(brands, "b", spark.createDataFrame(each, "b string, country string, count long"), spark.createDataFrame(fixes, "b string, country string, count long"))
    assert {r["b"]: (r["source"], r["planned"], r["flagged"]) for r in out.collect()} == {
        "sum": ("sum", 100, True), "stated": ("stated", 500, True), "tie": ("sum", 100, True), "no estimate": ("sum", 100, False), "rejected": ("sum", 100, False),
        "maps": ("maps", 3, False), "said": ("published", 8, False), "only stated": ("stated", 5, False), "none": ("missing", None, False),
    }


def test_load_gates(spark):
    items = spark.createDataFrame([("a", "2", "k"), ("a", "2", None), ("b", "1", "k"), ("c", "1", None), ("c", "2", "k"), ("d", None, "k")], "branch string, run string, key string")
    deltas = spark.createDataFrame([("2", "ADDED", "x"), ("2", "OTHER", None), ("2", None, "x"), ("1", "OTHER", None)], "run string, kind string, base string")
    emptied = spark.createDataFrame([("b",), ("c",), ("gone",), ("b",)], "branch string")
    stated = spark.createDataFrame([(3, 9)], "items long, deltas long")
    run = lambda i, d, e: {r["gate"]: (r["found"], r["wanted"], r["passed"]) for r in gates.load_gates(i, d, "run", F.lit("2"), "branch", (["key"], ["base"]), "kind", ["ADDED"], e, stated).collect()}
    assert run(items, deltas, emptied) == {
        "items as stated": (3, 3, True), "deltas as stated": (3, 9, False), "branches of several runs": (1, 0, False), "emptied branches keep rows": (2, 3, False), "emptied branches get rows": (1, 0, False),
        "kinds of change beyond the list": (1, 0, False), "items without key": (1, 0, False), "deltas without base": (1, 0, False),
    }
    empty = run(items.limit(0), deltas.limit(0), emptied.limit(0))
    assert empty["items as stated"] == (0, 3, False) and empty["branches of several runs"] == (0, 0, True) and empty["emptied branches get rows"] == (0, 0, True)


def test_conflicts(spark):
    rows = []
    add = lambda name, newer, term, *goods, n=1: rows.extend([(name, newer, term, list(goods) or None)] * n)
    for name in ("old", "new", "neither", "unvoted"):
        add(name, False, "Soup", "x", n=2), add(name, False, "Other"), add(name, True, "Tea", "y")
    add("longer", True, "soup", "x"), add("longer", False, "Soup ", "x", "y")
    add("as long", True, "Soup", "b"), add("as long", False, "Soup", "a")
    add("one", True, "Soup", n=3), add("one", True, "Tea", "x"), add("most", True, "Soup", n=3), add("most", True, "Tea", "x")
    add("agreed", True, "Tea"), add("agreed", False, "Tea"), add("gone", None, "Tea"), add("gone", None, "Soup")
    votes = [("old", " SOUP"), ("new", "tea"), ("neither", "Cake"), ("longer", "soup"), ("as long", "soup"), ("one", "tea"), ("most", None), ("agreed", "x")]
    out = resolving.settled_conflicts(spark.createDataFrame(rows, "name string, newer boolean, term string, ingredients array<string>"), "name", spark.createDataFrame(votes, "name string, term string"))
    assert {r["name"]: (r["term"], r["ingredients"], r["why"]) for r in out.collect()} == {
        "old": ("Soup", ["x"], "neighbours back the old"), "new": ("Tea", ["y"], "neighbours back the new"), "neither": ("Tea", ["y"], "neighbours back neither"), "unvoted": ("Tea", ["y"], "neighbours back neither"),
        "longer": ("Soup ", ["x", "y"], "same term, longer list"), "as long": ("Soup", ["a"], "same term, longer list"), "one": ("Tea", ["x"], "one month, backed"), "most": ("Soup", [], "one month, most rows"),
    }
