"""Unit cases of scalar functions, scorers and composites."""

from __future__ import annotations

import math
import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lakeshed.functions import text as t
from lakeshed.functions import values as v
from lakeshed.operators import choosing, gates, merging, nearby, quantiles, similarity, tiers
from lakeshed.sources import html as h
from lakeshed.sources import readers


def value(spark, column, **cells):
    row = spark.range(1).select(*[F.lit(x).alias(k) for k, x in cells.items()])
    return row.select(column.alias("out")).first()[0]


@pytest.mark.parametrize(
    ("make", "given", "wanted"),
    [
        (t.item_key, "  Chicken   TIKKA ", "chicken tikka"),
        (t.match_key, "Al-Safa_Café's", "al safa café s"),
        (t.brand_key, "Café Déli LLC - Marina", "deli"),
        (t.area_key, "Al Barsha First", "barsha1"),
        (t.area_key, "Barsha 1st", "barsha1"),
        (t.address_key, "12 Main St., Dubai, UAE", "12 main st dubai"),
        (t.owner_key, "Acme Foods Holdings Ltd", "acme foods"),
        (t.shown, "Tea \U0001f375​  ،hot", "Tea ,hot"),
        (t.shown, " ​ ", None),
        (t.finished, " - Burger () ,", "Burger"),
        (t.english_part, "Pizza | بيتزا", "Pizza"),
        (t.title_case, "joe's BBQ house", "Joe's BBQ House"),
        (t.slug, "Crème Brûlée & Co.", "creme-brulee-co"),
        (t.german_city, "Hauptstr. 1, 10115 Berlin", "Berlin"),
        (t.cid_only, "https://maps.example/x?a=1&cid=77&b=2", "https://maps.example/x?cid=77"),
        (t.domain, "https://WWW.Example.com:80/a?b", "example.com"),
        (t.last_number, "https://x.example/menu/42/item-7?aid=9", 7),
        (t.phone, "00971 50 123 4567", "+971501234567"),
        (t.phone, "12", None),
        (t.made_up_phone, "050 1234567", True),
        (t.made_up_phone, "050 7318264", False),
        (t.no_junk, "mailto:a@b.example\r\n x", "a@b.example x"),
        (t.singular, "cherries", "cherry"),
        (t.singular, "dishes", "dish"),
        (t.singular, "hummus", "hummus"),
        (t.head_noun, "chicken burger box with fries", "burger"),
        (v.price, "AED 1,048.5", 1048.5),
        (v.price, "free", None),
        (h.title, "<html><title> A page </title>", "A page"),
        (h.last_page, '<a href="/x?page=2"><a href="/x?page=11">', 11),
        (h.page_data, '<script id="__NEXT_DATA__" type="application/json">{"a":1}</script>', '{"a":1}'),
    ],
)
def test_scalar(spark, make, given, wanted):
    assert value(spark, make(F.col("x")), x=given) == wanted


def test_nulls_pass(spark):
    row = spark.range(1).select(F.lit(None).cast("string").alias("x"))
    for make in (t.item_key, t.match_key, t.brand_key, t.area_key, t.shown, t.finished, t.title_case, t.slug, t.domain, t.phone, v.price, h.title):
        assert row.select(make(F.col("x"))).first()[0] is None


def plainly_finished(x):
    """``finished`` by Python's own expressions."""
    if x is None:
        return None
    out = re.sub("[\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff\u00ad\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", "", x)
    out = " ".join(out.translate(str.maketrans(t.ARABIC_MARKS, t.PLAIN_MARKS)).split())
    out = re.sub(r"\( ?\)|\[ ?\]", "", out).strip(" ,;|/-")
    return re.sub(" +", " ", out) or x


def test_finished_as_plainly(spark):
    """Random texts of marks, brackets, white space, hidden characters and pictures; nulls, empty texts and long runs of separators."""
    r = random.Random(19)
    marks = [*"ab é()()[]  ,;|/-،؛؟٪ \n\t\r", "\x00", "\x0b", "\x1f", "\x7f", "\x85", "\xa0", "\xad", "\u1680", "\u2009", "\u200b", "\u2028", "\u2029", "\u202e", "\u2063", "\u3000", "\ufeff", "\U0001f375", "\U0002005c"]
    texts = ["".join(r.choices(marks, k=r.randint(0, 12))) for _ in range(20_000)]
    texts += [None, "", " ", "()", "-", "(())", "(( ))", "a () b", "a -", "x" + "-" * 300_000 + "y", "- " * 150_000 + "y" + " ()" * 100_000]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string").select("k", t.finished(F.col("x")).alias("y"))
    assert dict(map(tuple, rows.collect())) == {k: plainly_finished(x) for k, x in enumerate(texts)}


def test_finished_steps_once(spark):
    """No step of the cleaning stands in the plan more than once, after a Python function too, where the optimizer shares nothing."""
    plan = spark.range(1).select(t.finished(t.unmangled(t.composed(F.col("id").cast("string")))).alias("y"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\x{FEFF}") == 1


def test_numbers(spark):
    assert value(spark, v.percent_change(F.lit(20.0), F.lit(25.0))) == 25.0
    assert value(spark, v.percent_change(F.lit(0.0), F.lit(5.0))) is None
    assert value(spark, v.differs(F.lit(20.0), F.lit(20.005))) is False
    assert value(spark, v.number_range(F.lit("1,200-1,500"))).asDict() == {"least": 1200, "most": 1500}
    assert str(value(spark, v.long_date(F.lit("June 2, 2026")))) == "2026-06-02"
    assert value(spark, v.id52(F.lit("some-chain"))) < 2**52
    assert value(spark, v.month_of_path(F.lit("/data/August_menu/x"), 2026)) == 202608
    assert value(spark, v.translated(F.lit("Montag bis Freitag"), [("Montag", "Monday"), ("Freitag", "Friday")])) == "Monday bis Friday"


def test_distance(spark):
    d = value(spark, v.metres(F.lit(25.0), F.lit(55.0), F.lit(25.0), F.lit(55.001)))
    assert math.isclose(d, 100.78, abs_tol=0.05)
    assert value(spark, v.or_far(v.metres(F.lit(None).cast("double"), F.lit(55.0), F.lit(25.0), F.lit(55.0)))) == float("inf")


def test_scorers():
    rng = random.Random(7)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(12))) for _ in "xy")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        want = 200 * table[-1][-1] / (len(a) + len(b)) if a or b else 100
        assert similarity.indel(a, b) == pytest.approx(want)
    assert similarity.token_sort("b a", "a b") == 100
    assert similarity.token_set("burger king", "burger king marina") == 100
    assert similarity.partial("king", "burger king") == 100
    assert similarity.sequence_ratio("abcd", "abxd") == SequenceMatcher(None, "abcd", "abxd").ratio()


def test_choices(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("a", 1, 3), ("a", 2, 4), ("b", None, 5)], "k string, v int, i int")
    assert [tuple(r) for r in choosing.modes(df, ["k"], "v").collect()] == [("a", 1, 2, 4)]
    assert choosing.first_rows(df, ["k"], [F.desc("i")]).orderBy("k").select("i").collect()[0][0] == 4
    median = quantiles.upper_medians(df.filter("k = 'a'"), ["k"], "v").first()["upper_median"]
    assert median == 2
    empty = df.filter("false")
    for out in (choosing.modes(empty, ["k"], "v"), choosing.profile(empty, ["k"], "v", 0.1, 3), choosing.dominant(empty, ["k"], "v", 1, 0.5), choosing.stratified(empty, "k", "i", 5)):
        assert out.count() == 0


def test_snapshot_cases(spark):
    schema = "k int, price double, name string, seq int"
    before = spark.createDataFrame([(1, 20.0, "a", 1), (2, 20.0, "b", 1), (3, 1.0, "c", 1), (4, 5.0, "d", 1), (6, 0.0, "f", 1)], schema)
    after = spark.createDataFrame([(1, 25.0, "a", 1), (2, 20.005, "b2", 1), (3, 159.0, "c", 1), (5, 7.0, "e", 1), (6, 3.0, "f", 1)], schema)
    got = {(r["k"], r["change"], r["field"]): (r["percent"], r["outlier"]) for r in merging.snapshot_changes(before, after, ["k"], "price", ["name"], "seq").collect()}
    assert got == {
        (1, "CHANGED", "price"): (25.0, False), (2, "CHANGED", "name"): (None, False), (3, "CHANGED", "price"): (15800.0, True), (4, "REMOVED", "row"): (None, False), (5, "ADDED", "row"): (None, False), (6, "CHANGED", "price"): (None, False),
    }
    # prices that come or go; texts that differ in looks alone, a real rename, a change of case, null and empty
    texts = [("tea", "tea 🍵"), ("a  b ", "a\u00a0b"), ("Ｆｕｌｌ", "Full"), ("x", "y"), ("Tea", "tea"), (None, ""), (None, "new"), ("🍵", None)]
    before = spark.createDataFrame([(k, 1.0, x, 1) for k, (x, _) in enumerate(texts)] + [(20, None, "p", 1), (21, 4.0, "p", 1), (22, None, "p", 1)], schema)
    after = spark.createDataFrame([(k, 1.0, y, 1) for k, (_, y) in enumerate(texts)] + [(20, 3.0, "p", 1), (21, None, "p", 1), (22, None, "p", 1)], schema)
    got = {(r["k"], r["field"], r["before"], r["after"]) for r in merging.snapshot_changes(before, after, ["k"], "price", ["name"], "seq").collect()}
    assert got == {(3, "name", "x", "y"), (4, "name", "Tea", "tea"), (6, "name", "", "new"), (20, "price", None, "3.0"), (21, "price", "4.0", None)}
    # the gate: order and repeats
    gate = lambda x, y: {r["k"]: r["status"] for r in merging.changed_groups(spark.createDataFrame(x, "k int, v string"), spark.createDataFrame(y, "k int, v string"), "k", ["v"]).collect()}
    assert gate([(1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, None)], [(1, "b"), (1, "a"), (2, "a"), (4, "x")]) == {1: "no_change", 2: "changed", 3: "removed", 4: "added"}
    a = spark.createDataFrame([(1, 1.0), (1, 2.0)], "b int, p double")
    hashes = [merging.multiset_hash(x, "b", ["p"]).first()["hash"] for x in (a, a.orderBy(F.desc("p")))]
    assert hashes[0] == hashes[1]


def test_places(spark):
    rng = random.Random(3)
    points = [(i, 25 + rng.random() / 50, 55 + rng.random() / 50) for i in range(120)] + [(900, None, 55.0)]
    df = spark.createDataFrame(points, "id int, lat double, lon double")

    def far(a, b):
        x = math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * v.EARTH_M * math.asin(math.sqrt(x))

    want = {(a[0], b[0]) for a in points[:-1] for b in points[:-1] if far(a, b) <= 250}
    got = {(r["a"], r["b"]) for r in nearby.within(df.withColumnRenamed("id", "a"), df.withColumnRenamed("id", "b"), "a", "b", 250.0).collect()}
    assert got == want
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a int, b int")
    nodes = spark.createDataFrame([(i,) for i in (1, 2, 3, 7, 8, 9)], "id int")
    assert {tuple(r) for r in nearby.connected(edges, nodes, "id").collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 9)}


def test_vocabulary(spark):
    v_ = spark.createDataFrame([("Al Barsha 1",), ("Marina",)], "term string")
    df = spark.createDataFrame([(1, "Marina"), (2, "AL BARSHA FIRST"), (3, "Shop 2, marina"), (4, "nowhere"), (5, "marina / al barsha 1")], "id int, said string")
    got = {r["id"]: (r["term"], r["method"]) for r in tiers.vocabulary_value(df, "id", "said", v_, "term", lambda x: t.area_key(x, fold=False)).collect()}
    assert got == {1: ("Marina", "exact"), 2: ("Al Barsha 1", "key"), 3: ("Marina", "part"), 4: (None, "none"), 5: ("Al Barsha 1", "part")}


def test_evidence(spark):
    row = spark.createDataFrame([("Blue Ocean Grill", ["Blue Ocean Grill opens", "x"]), ("Ocean", ["Grill"])], "claim string, found array<string>")
    assert [r["grounded"] for r in tiers.grounded(row, "claim", "found", t.significant).collect()] == [True, False]
    said = value(spark, tiers.stated_counts(F.lit("There are 1,234 cafes in Dubai as of June 2, 2026.")))
    assert (said["count"], said["place"], said["as_of"]) == (1234, "Dubai", "June 2, 2026")


def test_linked_data(spark):
    page = '<script type="application/ld+json">{"@graph":[{"@type":"Restaurant","name":"A","address":"Main 1"},{"@type":["Cafe","Place"],"name":"B","geo":{"latitude":"1.5","longitude":2}}]}</script><script type="application/ld+json">{bad</script>'
    nodes = h.json_ld(F.lit(page))
    assert value(spark, F.size(nodes)) == 2
    place = value(spark, h.place_of(F.element_at(h.of_type(nodes, "Cafe"), 1)))
    assert (place["name"], place["lat"], place["lon"]) == ("B", 1.5, 2.0)
    assert value(spark, h.place_of(F.element_at(nodes, 1)))["street"] == "Main 1"
    assert value(spark, h.script_variable(F.lit("var stores = [1,2];"), ["shops", "stores"])) == "[1,2]"


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1, "b": "x"}\n\n{bad\n')
    rows = readers.json_lines(spark, str(tmp_path / "a.jsonl"), "a int, b string").collect()
    assert len(rows) == 2 and sum(r["_corrupt_record"] is not None for r in rows) == 1
    (tmp_path / "b.csv").write_text("﻿id,name\n1,x\n", encoding="utf-8")
    assert readers.csv_text(spark, str(tmp_path / "b.csv")).columns == ["id", "name"]
    df = spark.createDataFrame([(1, [1, 2], "a\x01b")], "id int, xs array<int>, s string")
    readers.write_csv(df, str(tmp_path / "out"))
    back = readers.csv_text(spark, str(tmp_path / "out")).first()
    assert (back["xs"], back["s"]) == ("[1,2]", "ab")
    readers.write_partitions(spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string"), str(tmp_path / "t"), ["p"])
    readers.write_partitions(spark.createDataFrame([(3, "y")], "v int, p string"), str(tmp_path / "t"), ["p"])
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).select("v", "p").collect()} == {(1, "x"), (3, "y")}
    assert readers.inventory(spark, str(tmp_path)).count() > 3


def test_gates(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0)], "id int, p double")
    got = {r["gate"]: (r["found"], r["passed"]) for r in gates.checked(df, [gates.Gate("negative", F.col("p") < 0), gates.Gate("null", F.col("p").isNull())]).collect()}
    assert got == {"negative": (1, False), "null": (0, True)}
    assert gates.missing_columns(df, {"id": "int", "q": "string"}) == {"q": "missing"}
    with pytest.raises(ValueError):
        gates.accounted(3, kept=1, removed=1)


def test_quantiles_by_counts(spark):
    """Against sorted lists: skewed values far apart, one value, ties, nulls, negative ones, no keys."""
    import random

    rng = random.Random(2)
    rows = [("a", float(rng.randrange(50))) for _ in range(300)] + [("b", rng.random() ** 30 * 1e9) for _ in range(501)] + [("c", 7.0)] * 9 + [("d", None)] * 3 + [("e", -5.0), ("e", 1e300)] + [("f", 1.0 + k * 2**-52) for k in range(4)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in quantiles.quantiles(df, ["k"], "v", {"p50": 0.5, "p90": 0.9, "least": 0.0, "most": 1.0}).collect()}
    upper = {r["k"]: r["upper_median"] for r in quantiles.upper_medians(df, ["k"], "v").collect()}
    for k in "abcef":
        values = sorted(v for g, v in rows if g == k)
        assert upper[k] == values[len(values) // 2] and (got[k]["least"], got[k]["most"], got[k]["n"]) == (values[0], values[-1], len(values))
        for name, share in (("p50", 0.5), ("p90", 0.9)):
            at = (len(values) - 1) * share
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert got[k][name] == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-12)
    assert "d" not in got
    assert quantiles.upper_medians(df, [], "v").first()["upper_median"] == sorted(v for _, v in rows if v is not None)[(len(rows) - 3) // 2]
    assert quantiles.upper_medians(df.limit(0), ["k"], "v").count() == 0


def test_changes_behind_the_gate(spark):
    """The cases of a menu's diff: unchanged groups never come to it, looks alone are counted."""
    schema = "b int, k string, price double, text string, seq int"
    old = spark.createDataFrame([(1, "x", 5.0, "same", 1), (2, "fries", 8.0, "", 1), (2, "burger", 20.0, "Caf\u00e9", 1), (2, "tea", 1.0, "hot  tea", 1), (2, "cake", 4.0, "old", 1), (2, "soup", 3.0, None, 1), (2, "rice", 20.0, "a", 1), (4, "gone", 1.0, "", 1)], schema)
    new = spark.createDataFrame([(1, "x", 5.0, "same", 1), (2, "cola", 5.0, "", 1), (2, "burger", 25.0, "Cafe\u0301 \u2615", 1), (2, "tea", 159.0, "hot tea", 1), (2, "cake", 4.004, "new", 1), (2, "soup", None, None, 1), (2, "rice", 20.0, "a", 1), (3, "add", 2.0, "", 1)], schema)
    want = {
        (2, "cola", "ADDED", "row", None), (2, "fries", "REMOVED", "row", None), (2, "burger", "CHANGED", "price", 25.0), (2, "tea", "CHANGED", "price", 15800.0), (2, "cake", "CHANGED", "text", None), (2, "soup", "CHANGED", "price", None), (3, "add", "ADDED", "row", None), (4, "gone", "REMOVED", "row", None),
    }
    for group in ("b", None):
        got = merging.snapshot_changes(old, new, ["b", "k"], "price", ["text"], "seq", group, True).collect()
        assert {(r["b"], r["k"], r["change"], r["field"], r["percent"]) for r in got if r["change"] != "COSMETIC"} == want
        assert {(r["k"], r["field"]) for r in got if r["change"] == "COSMETIC"} == {("burger", "text"), ("tea", "text")}
        assert [r["k"] for r in got if r["outlier"]] == ["tea"]
    kept, _, gate = merging.gated(old, new, "b", ["k", "price", "text"])
    assert {r["b"] for r in kept.collect()} == {2, 4} and {r["b"]: r["status"] for r in gate.collect()} == {1: "no_change", 2: "changed", 3: "added", 4: "removed"}
    assert merging.snapshot_changes(old, old, ["b", "k"], "price", ["text"], "seq", "b").count() == 0
    nulls = [spark.createDataFrame([(1, *x)], "b int, p string, q string") for x in ((None, "a"), ("a", None))]
    assert [r["status"] for r in merging.changed_groups(*nulls, "b", ["p", "q"]).collect()] == ["changed"]
