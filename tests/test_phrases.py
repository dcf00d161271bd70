"""Dictionaries and patterns against plain loops."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from lakeshed.operators import phrases

WORDS = ["olive", "oil", "extra", "virgin", "salt", "sea", "of", "the", "red"]


def plain_phrases(text, terms):
    words = re.findall(r"\w+", (text or "").lower())
    known = {}
    for t in sorted(x for x in terms if x):
        if key := tuple(re.findall(r"\w+", t.lower())):
            known.setdefault(key, t)
    out, at = [], 0
    while at < len(words):
        found = max((k for k in known if tuple(words[at : at + len(k)]) == k), key=len, default=None)
        if found:
            out.append((known[found], at))
        at += len(found) if found else 1
    return out


@pytest.mark.parametrize("sent", [200_000, 3])
def test_phrases_of_several_words(spark, sent):
    """The tree that is sent and the join of runs give what a scan gives."""
    rng = random.Random(4)
    terms = ["Olive oil", "extra-virgin olive oil", "oil", "sea salt", "SEA SALT", "red", "salt of the sea", "", None, "?!", "virgin"]
    texts = [rng.choice([" ", ", ", "/"]).join(rng.choices(WORDS, k=rng.randrange(0, 14))).title() for _ in range(120)] + [None, "", "Extra virgin olive oil (red)"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = phrases.phrases_found(df, "id", "text", spark.createDataFrame([(t,) for t in terms], "term string"), "term", sent)
    want = {(i, t, at) for i, x in enumerate(texts) for t, at in plain_phrases(x, terms)}
    assert {(r["id"], r["term"], r["start"]) for r in got.collect()} == want and len(want) > 100
    assert phrases.phrases_found(df.limit(0), "id", "text", spark.createDataFrame([("a",)], "term string"), "term", sent).count() == 0


def test_recovered_terms(spark):
    vocabulary = spark.createDataFrame([("Egg",), ("Tomato",), ("Black Pepper",), ("Salt",)], "term string")
    rows = [(1, ["eggs", "EGG", "tomatoes"]), (2, ["salt/pepper", "lime & salts", "black pepper (ground)"]), (3, ["unknown", None, ""]), (4, []), (5, None), (6, ["peppers, eggs"])]
    got = {r["id"]: (r["terms"], r["dropped"]) for r in phrases.recovered(spark.createDataFrame(rows, "id int, terms array<string>"), "id", "terms", vocabulary, "term").collect()}
    assert got == {1: (["Egg", "Tomato"], 0), 2: (["Salt", "Black Pepper"], 0), 3: ([], 2), 4: ([], 0), 5: ([], 0), 6: (["Egg"], 0)}


@pytest.mark.parametrize(
    ("pattern", "want"),
    [("burger king", "burger king"), ("(?i)Starbucks?", "starbuck"), ("a|bcd", None), ("(abc|abd)efg", "efg"), ("x{2,}longer.*bit", "longer"), ("(?:pizza)+hut", "pizza"), ("(?:pizza)?hut", "hut"), (r"\bkfc\b", "kfc"), ("[abc]{3}", None), ("(unclosed", None), (None, None), (r"\Qa.b.c\E", None), ("a(bcd)e", "abcde")],
)
def test_anchors(pattern, want):
    assert phrases.anchor_of(pattern) == want


def test_fifty_thousand_patterns(spark):
    """No join without a key, and the matches of all pairs."""
    rng = random.Random(3)
    patterns = [(k, rf"(?i)brand{k}\b") for k in range(50_000)] + [(50_000, "^$"), (50_001, "(tea|ice)"), (50_002, None), (50_003, "Brand77x?")]
    texts = [f"The BRAND{rng.randrange(60_000)} shop" for _ in range(300)] + ["iced tea brand7", "", None, "Brand77"]
    df, table = spark.createDataFrame(list(enumerate(texts)), "id int, text string"), spark.createDataFrame(patterns, "rule int, pattern string")
    out = phrases.pattern_hits(df, "id", "text", table, "pattern")
    got = {(r["id"], r["rule"]) for r in out.collect()}
    number = lambda t: {int(x) for x in re.findall(r"brand(\d+)\b", t.lower())}
    want = {(i, k) for i, t in enumerate(texts) if t is not None for k in number(t) if k < 50_000} | {(i, 50_000) for i, t in enumerate(texts) if t == ""} | {(i, 50_001) for i, t in enumerate(texts) if t and re.search("tea|ice", t)} | {(i, 50_003) for i, t in enumerate(texts) if t and "Brand77" in t}
    assert got == want
    plan = phrases.pattern_hits(df, "id", "text", table.filter("rule < 50000"), "pattern")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        phrases.pattern_hits(df, "id", "text", table.withColumn("pattern", F.lit("a.")), "pattern")


def joined_rows(plan):
    """Rows that each join of an executed plan gave."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        yield from joined_rows(plan.executedPlan())
    elif plan.nodeName().endswith("QueryStage"):
        yield from joined_rows(plan.plan())
    elif "Join" in plan.nodeName():
        yield plan.metrics().apply("numOutputRows").value()
    for k in range(plan.children().size()):
        yield from joined_rows(plan.children().apply(k))


def test_patterns_of_long_numbers_meet_few_texts(spark):
    """Numbers share their runs of three digits; what meets must follow texts and patterns, not their product."""
    n = 20_000
    number = "cast(100000 + id * 7919 % 900000 as string)"
    rows = spark.range(n).selectExpr("id", f"concat('https://x.org/en/', {number}, '?page=2') as url")
    rules = spark.range(n).selectExpr("id as rule", f"concat('/en/', {number}, '(\\\\D|$)') as pattern")
    out = phrases.pattern_hits(rows, "id", "url", rules, "pattern")
    assert {(r["id"], r["rule"]) for r in out.collect()} == {(k, k) for k in range(n)}
    assert max(joined_rows(out._jdf.queryExecution().executedPlan())) < 8 * n


def test_anchors_of_every_length(spark):
    """Anchors between and beyond the lengths of runs, with other letters around them, find what a scan finds."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abé", k=rng.randrange(3, 40))) for _ in range(80)] + ["ab" * 20, "abc", "😀abc", ""]
    rules = [(k, re.sub("[^a-c]", ".", w[: rng.randrange(3, 40)])) for k, w in enumerate(words) if len(w) > 2 and re.search("[abc]{3}", w[:3])]
    df, table = spark.createDataFrame(list(enumerate([*words, None])), "id int, text string"), spark.createDataFrame(rules, "rule int, pattern string")
    got = {(r["id"], r["rule"]) for r in phrases.pattern_hits(df, "id", "text", table, "pattern").collect()}
    assert got == {(i, k) for i, t in enumerate(words) for k, p in rules if re.search(p, t)} and len(got) > 20
