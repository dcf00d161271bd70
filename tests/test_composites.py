"""Composites: menus, outlets, publishing, patches, streams that resume and set failures aside."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshed.operators import merging, nearby, resolving, similarity, tiers
from lakeshed.operators.gates import Gate, changed_fields, orphans
from lakeshed.sources import html as h
from lakeshed.streaming import streams


def test_menus(spark):
    item = "array<struct<name:string,price:double>>"
    base = spark.createDataFrame([(1, [("a", 1.0), ("a", 1.0), ("b", 2.0)]), (2, None), (3, [("z", 9.0)])], f"id int, menu {item}")
    once = {r["id"]: [tuple(x) for x in r["menu"]] for r in resolving.nested_once(base, "id", "menu", ["name", "price"]).collect()}
    assert once == {1: [("a", 1.0), ("b", 2.0)], 2: [], 3: [("z", 9.0)]}
    new = spark.createDataFrame([(2, [("c", 3.0)]), (4, [("d", 4.0)])], f"id int, menu {item}")
    assert {r["id"]: len(r["menu"] or []) for r in resolving.refreshed(base, new, "id", "menu").collect()} == {1: 3, 2: 1, 3: 1, 4: 1}


def test_patches(spark):
    base = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, city string")
    side = spark.createDataFrame([(2, "b"), (3, "x"), (9, "y")], "id int, city string")
    out = merging.patched(base, side, ["id"], "city")
    assert {r["id"]: r["city"] for r in out.collect()} == {1: "a", 2: "b", 3: "x"}
    assert {r["field"]: r["n"] for r in changed_fields(base, out, "id", ["city"]).collect()} == {"city": 2}
    assert orphans(side, base, "id", "id").count() == 1
    assert {tuple(r) for r in merging.inserted(base, side, ["id"]).collect()} == {(1, "a"), (2, None), (3, "c"), (9, "y")}
    assert merging.last_written(spark.createDataFrame([(1, 1), (1, 2)], "k int, s int"), ["k"], "s").first()["s"] == 2


def test_narrowing(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "x", "y"), (3, "q", "q")], "id int, a string, b string")
    k = spark.createDataFrame([("x", None, 7), ("x", "y", 8), ("x", "y", 9)], "a string, b string, v int")
    assert {r["id"]: (r["verdict"], r["v"]) for r in merging.narrowed(a, k, ["a", "b"], "v", "id").collect()} == {1: ("matched", 7), 2: ("ambiguous", None), 3: ("unmatched", None)}


def test_rules_and_ladders(spark):
    rules = spark.createDataFrame([(1, "(?i)soup", "soup"), (2, "(?i)tea", "drink")], "order int, pattern string, label string")
    rows = spark.createDataFrame([(1, "Iced TEA", "soups"), (2, "x", "hot tea"), (3, None, None)], "id int, name string, category string")
    got = {r["id"]: (r["label"], r["field"]) for r in tiers.rule_value(rows, "id", ["name", "category"], rules).collect()}
    assert got == {1: ("drink", "name"), 2: ("drink", "category"), 3: (None, None)}


def test_relisting_ladder(spark):
    """Each rule in its order, as the ladder's own cases have them."""
    names = ["same_slug", "same_chain", "same_name", "same_listed_name", "same_area", "shared_cuisine", "cuisine_open", "fuzzy", "metres"]
    case = lambda **x: tuple(x.get(n, {"fuzzy": 0.0, "metres": None}.get(n, False)) for n in names)
    cases = [
        (0.99, case(same_slug=True, same_chain=True, metres=100.0)), (0.98, case(same_chain=True, metres=30.0)), (0.93, case(same_chain=True, same_name=True, metres=45.0)), (0.95, case(same_name=True, metres=50.0)), (0.94, case(same_listed_name=True, metres=50.0)),
        (0.85, case(same_name=True, metres=250.0)), (0.80, case(fuzzy=92.0, metres=100.0, cuisine_open=True)), (0.80, case(fuzzy=90.0, metres=150.0, shared_cuisine=True)), (0.0, case(fuzzy=92.0, metres=100.0)), (0.70, case(fuzzy=95.0, same_area=True, shared_cuisine=True)),
        (0.0, case(fuzzy=99.0, same_area=True)), (0.60, case(same_slug=True)), (0.25, case(same_slug=True, metres=5000.0)), (0.0, case()),
    ]
    rows = spark.createDataFrame([(i, *x) for i, (_, x) in enumerate(cases)], "i int, same_slug boolean, same_chain boolean, same_name boolean, same_listed_name boolean, same_area boolean, shared_cuisine boolean, cuisine_open boolean, fuzzy double, metres double")
    got = {r["i"]: r["c"] for r in rows.select("i", tiers.laddered(tiers.relisting_steps())["confidence"].alias("c")).collect()}
    assert got == {i: want for i, (want, _) in enumerate(cases)}


def test_close_vocabulary(spark):
    words = spark.createDataFrame([("Hor Al Anz", ["Dubai"]), ("Al Barsha 1", ["Dubai"]), ("Al Barsha 3", None), ("Marina View", ["Dubai"]), ("Khalidiya Street", ["Abu Dhabi"]), ("Green Park East", None), ("Green Park Easy", None)], "term string, cities array<string>")
    said = [(1, "anz hor al", "Dubai"), (2, "Al Barsha 2", None), (3, "Khalidiya Stret", "Dubai"), (4, "Khalidiya Stret", "Abu Dhabi"), (5, "Green Park Eas", None), (6, "nothing like it", None), (7, None, None), (8, "Marina Vieew", None)]
    out = tiers.close_vocabulary_value(spark.createDataFrame(said, "id int, said string, city string"), "id", "said", "city", words, "term")
    assert {r["id"]: (r["term"], r["method"]) for r in out.collect()} == {
        1: ("Hor Al Anz", "close"), 2: (None, "tie"), 3: (None, "wrong city"), 4: ("Khalidiya Street", "close"), 5: (None, "tie"), 6: (None, "none"), 7: (None, "none"), 8: ("Marina View", "close"),
    }
    one = tiers.close_vocabulary_value(spark.createDataFrame([(2, "Al Barsha 2", None)], "id int, said string, city string"), "id", "said", "city", words.filter("term = 'Al Barsha 1'"), "term")
    assert one.first()["method"] == "numbered"


def test_owners_and_sitemaps(spark):
    pairs = [("a", "b"), ("b", "c"), ("x", "x"), ("p", "q"), ("q", "p"), ("u", "v"), ("v", "w"), ("w", "u"), ("aa", "w"), ("two", "k"), ("two", "c")] + [(f"n{k}", f"n{k + 1}") for k in range(40)]
    links = spark.createDataFrame(pairs, "child string, parent string")
    want = {("a", "c"), ("b", "c"), ("x", "x"), ("p", "p"), ("q", "p"), ("u", "u"), ("v", "u"), ("w", "u"), ("aa", "u"), ("two", "c")} | {(f"n{k}", "n40") for k in range(40)}
    assert {tuple(r) for r in nearby.owners(links, "child", "parent").collect()} == want
    edges = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "r")], "parent string, child string")
    assert {tuple(r) for r in h.sitemap_closure(edges, spark.createDataFrame([("r",)], "url string")).collect()} == {("r", 0), ("a", 1), ("b", 2)}
    deep = spark.createDataFrame([(f"u{k}", f"u{k + 1}") for k in range(11)], "parent string, child string")
    assert h.sitemap_closure(deep, spark.createDataFrame([("u0",)], "url string")).count() == 12


def test_streams(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write = lambda rows: spark.createDataFrame(rows, "k int, v string").coalesce(1).write.mode("append").parquet(source)
    write([(1, "a"), (2, "b"), (1, "c")])
    once = lambda: streams.run_once(streams.once_by_key(streams.file_stream(spark, source, "k int, v string"), ["k"]), "parquet", out, checkpoint)
    once()
    write([(2, "again"), (3, "d")])
    once()  # goes on where it stopped: 2 is known
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    stream = streams.file_stream(spark, source, "k int, v string")
    streams.run_batches(stream, lambda batch, n: streams.split_failures(batch, F.length("v") > 1, good, bad, n), str(tmp_path / "c2"), "append")
    assert [r["v"] for r in spark.read.parquet(bad).collect()] == ["again"]
    assert streams.to_retry(spark.read.parquet(bad), spark.read.parquet(good), "k").count() == 0


def test_best_match_with_a_hot_word(spark):
    """A misspelt rare word beside a word that a third of rows have, against brute force."""
    right = [(0, "alpha cafe bar"), (1, "alfa restaurant"), (2, "a"), (3, "bb restaurant")] + [(10 + k, f"place{k} {'restaurant' if k % 3 == 0 else 'shop'}") for k in range(60)]
    left = [(0, "alpha restaurant"), (1, "restaurant plaze12"), (2, "bar alpha cafe"), (3, "a"), (4, "zzz qqq"), (5, "restaurants"), (6, None), (7, "shop pace7")]
    want = {}
    for i, a in left:
        found = [(-similarity.token_sort(a, b), j) for j, b in right if a is not None and similarity.token_sort(a, b) >= 85]
        if found:
            want[i] = min(found)[1]
    got = similarity.best_match(spark.createDataFrame(left, "l int, a string"), spark.createDataFrame(right, "r int, b string"), "l", "a", "r", "b", similarity.token_sort_score, 85.0)
    assert {x["l"]: x["r"] for x in got.collect()} == want
    assert want[0] == 1
