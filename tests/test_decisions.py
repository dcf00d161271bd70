"""Lines with problems, rules with needs, answers and patches, case by case."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshed.operators import choosing, gates, merging, tiers


def test_line_problems(spark):
    lines = ['{"id": "1", "p": 2.5, "menu": [1]}', '{"id": "1", "p": null, "menu": []}', "", "  ", None, "[1, 2]", "{broken", '{"id": 3, "p": "x", "menu": [1], "z": 1}', '{"menu": {}}']
    out = gates.line_problems(spark.createDataFrame([(x,) for x in lines], "t string"), "t", {"id": "string", "p": "number", "menu": "array"}, "id", "menu")
    assert {(r["problem"], r["field"]): r["n"] for r in out.collect()} == {
        ("unparseable", ""): 2, ("missing", "id"): 1, ("missing", "p"): 1, ("null", "p"): 1, ("type", "id"): 1, ("type", "p"): 1, ("type", "menu"): 1, ("empty menu", "menu"): 2, ("extra", "z"): 1, ("repeated key", "id"): 1,
    }
    assert gates.line_problems(spark.createDataFrame([], "t string"), "t", {"id": "string"}, "id", "menu").count() == 0


def test_re_examined(spark):
    rules = spark.createDataFrame([(1, "Soup", "Soup", "broth|lentil", None), (2, "tea", "Tea", None, "steam"), (3, "a.b", "Dot", None, None)], "order int, word string, label string, needs string, without string")
    rows = [(1, "Lentil SOUP", None, "x"), (2, "Soup bowl", "none", "x"), (3, "Steak", "green tea", "x"), (4, "steamed tea", None, "x"), (5, "Tea", None, "Skip"), (6, None, None, None), (7, "axb", "a.b", None), (8, "tea", "lentil soup", "x")]
    out = tiers.re_examined(spark.createDataFrame(rows, "id int, name string, said string, cat string"), "id", ["name", "said"], "cat", ["skip"], rules)
    assert {r["id"]: (r["label"], r["field"]) for r in out.collect()} == {1: ("Soup", "name"), 2: (None, None), 3: ("Tea", "said"), 4: (None, None), 5: (None, None), 6: (None, None), 7: ("Dot", "said"), 8: ("Tea", "name")}


def test_patches_in_turn(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    side = lambda *x: spark.createDataFrame(list(x), "k int, v string")
    out, counts = merging.patched_in_turn(df, [("one", side((1, "z"), (2, "b"), (9, "q"), (3, None)), "v", True), ("two", side((2, "b"), (3, "y"), (3, "x")), "v", False)], ["k"])
    assert {tuple(r) for r in out.collect()} == {(1, "a"), (2, "b"), (3, "x")}
    assert {tuple(r) for r in counts.select("patch", "applied", "same", "unknown").collect()} == {("one", 1, 1, 1), ("two", 1, 1, 0)}


def test_majority_and_compositions(spark):
    df = spark.createDataFrame([(1, "a", False, 1), (1, "a", False, 1), (1, "b", True, 0), (2, None, True, 1), (3, "y", False, 1), (3, "x", False, 1)], "k int, v string, c boolean, r int")
    out = choosing.majority(df, ["k"], "v", F.col("c"), F.col("r"))
    assert {tuple(r) for r in out.collect()} == {(1, "b", 1, 2), (3, "x", 1, 1)}
    made = {r["k"]: (r["shares"], r["terms"]) for r in choosing.compositions(df, "k", "v", "v", 1, 2).collect()}
    assert made[1][0] == {"a": 2 / 3} and made[1][1] == ["a", "b"] and 2 not in made
