"""Kept results, file hashes, added columns; functions of texts, values and sources, case by case."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from lakeshed.functions import text as t
from lakeshed.functions import values as v
from lakeshed.operators import choosing
from lakeshed.sources import cached, readers
from lakeshed.streaming import streams


def test_reused(spark, tmp_path):
    df, made = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string"), []

    def make(rows):
        made.append(1)
        return rows.agg(F.count("*").alias("n"))

    for _ in range(2):
        assert cached.report_cache(spark, str(tmp_path / "r"), df, ["k", "s"], make).first()["n"] == 2
    assert len(made) == 1
    assert cached.report_cache(spark, str(tmp_path / "r"), df.filter("k = 1"), ["k", "s"], make).first()["n"] == 1
    assert len(made) == 2
    turned = df.orderBy(F.desc("k"))
    assert cached.signature(df, ["k", "s"]) == cached.signature(turned.union(turned), ["k", "s"]) != cached.signature(df.fillna("b"), ["k", "s"])
    assert cached.signature(df.filter("k > 9"), ["k"]) == "0-0-0-0-0"
    # written by half: made again
    (tmp_path / "h" / "key=x").mkdir(parents=True)
    assert cached.reused(spark, str(tmp_path / "h"), "x", lambda: df).count() == 2


def test_files(spark, tmp_path):
    for name, text in (("a.txt", "one"), ("b.txt", "two"), ("c.txt", "three"), ("d.txt", "four")):
        (tmp_path / name).write_text(text)
    before = cached.of_files(spark, str(tmp_path))
    found = cached.file_hashes(spark, str(tmp_path))
    rows = {r["path"].rsplit("/", 1)[1]: r for r in found.collect()}
    assert rows["a.txt"]["sha256"] == hashlib.sha256(b"one").hexdigest()
    path = lambda n: rows["a.txt"]["path"].replace("a.txt", n)
    listed = [(path("a.txt"), 3, rows["a.txt"]["sha256"]), (path("b.txt"), 9, "x"), (path("c.txt"), 5, "x"), (path("z.txt"), 1, "x")]
    out = cached.verified_files(spark.createDataFrame(listed, "path string, bytes long, sha256 string"), found)
    assert {r["path"].rsplit("/", 1)[1]: r["verdict"] for r in out.collect()} == {"a.txt": "ok", "b.txt": "size differs", "c.txt": "contents differ", "d.txt": "unlisted", "z.txt": "missing"}
    (tmp_path / "e.txt").write_text("five")
    assert cached.of_files(spark, str(tmp_path)) != before


def test_added_columns(spark):
    df = spark.createDataFrame([(3, "x"), (7, None)], "id int, s string")
    out = cached.with_added(df, {"s": F.lit("none"), "double": F.col("id") * 2})
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(3, "x", 6), (7, "none", 14)]
    assert cached.next_number(df, "id") == 8 and cached.next_number(df.filter("id > 9"), "id") == 1


def _one(spark, column, *values, schema):
    return spark.createDataFrame([values], schema).select(column).first()[0]


def test_text_functions(spark):
    one = lambda f, x: _one(spark, f(F.col("x")), x, schema="x string")
    assert one(t.name_of_slug, "royal-sweets-house") == "Royal Sweets House"
    assert one(t.name_of_slug, None) is None
    got = spark.createDataFrame([("royal-sweets-deira", "Royal Sweets"), ("other", "Royal"), (None, "x")], "u string, n string").select(t.slug_tail(F.col("u"), F.col("n"))).collect()
    assert [r[0] for r in got] == ["deira", None, None]
    parts = one(lambda x: t.address_parts(x, ("dubai", "ajman")), "Shop 4, Al Rigga, Deira, Dubai, UAE")
    assert (parts["city"], parts["area"], parts["sublocality"]) == ("Dubai", "Deira", "Al Rigga")
    assert one(lambda x: t.address_parts(x, ("dubai",)), "Nowhere")["city"] is None
    diff = spark.createDataFrame([("a b", "a c"), ("a", "a"), (None, "x")], "b string, a string").select(t.text_diff(F.col("b"), F.col("a"))).collect()
    assert diff[0][0] and len(diff) == 3


def test_value_functions(spark):
    rows = spark.createDataFrame([([1, 2, 3], [3, 2, 1]), ([1], [1, 2]), ([], []), (None, [1])], "a array<int>, b array<int>")
    got = rows.select(v.same_items(F.col("a"), F.col("b")), v.overlap_share(F.col("a"), F.col("b")), v.jaccard(F.col("a"), F.col("b"))).collect()
    assert [g[0] for g in got[:3]] == [True, False, True] and got[0][2] == 1.0 and got[1][2] == 0.5
    place = spark.createDataFrame([("25.2, 55.3",), ("x",), (None,)], "x string").select(v.lat_lng(F.col("x")).alias("p")).select("p.*").collect()
    assert [tuple(p) for p in place] == [(25.2, 55.3), (None, None), (None, None)]
    nums = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (None,)], "x double").select(v.finite(F.col("x"))).collect()
    assert [n[0] for n in nums] == [1.5, None, None, None]


def test_first_values(spark):
    df = spark.createDataFrame([(1, 1, None, "x"), (1, 2, "b", "y"), (1, 3, "c", None), (2, 1, None, None)], "k int, o int, p string, q string")
    assert {tuple(r) for r in choosing.first_values(df, ["k"], ["p", "q"], F.col("o")).collect()} == {(1, "b", "x"), (2, None, None)}


def test_readers(spark, tmp_path):
    for n, rows in (("a", [{"k": 1}, {"k": 2}]), ("b", [{"k": 3}])):
        (tmp_path / f"{n}.json").write_text(json.dumps(rows))
    assert sorted(r["k"] for r in readers.json_documents(spark, str(tmp_path), "k int").collect()) == [1, 2, 3]
    for n in ("run_1", "run_2", "run_3_merged"):
        spark.createDataFrame([(n,)], "s string").coalesce(1).write.mode("overwrite").json(str(tmp_path / "f" / n))
    lines = tmp_path / "lines"
    lines.mkdir()
    for n in ("x_1.json", "x_2.json", "x_merged.json"):
        (lines / n).write_text(json.dumps({"s": n}))
    assert {r["s"] for r in readers.united_files(spark, str(lines), "x_*.json", "merged").collect()} == {"x_1.json", "x_2.json"}
    assert {r["s"] for r in readers.latest_file(spark, str(lines), "x_?.json", "json").collect()} == {"x_2.json"}
    df = spark.createDataFrame([(1, "q", None)], "a int, b string, c string")
    assert [tuple(r) for r in readers.with_na(df, ["b", "c"]).collect()] == [(1, "q", "NA")]
    assert readers.with_columns(df, {"a": "long", "z": "string", "b": "int"}).dtypes == [("a", "bigint"), ("z", "string"), ("b", "int")]
    readers.write_json(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_windowed_stream(spark, tmp_path):
    spark.createDataFrame([("2026-01-01 00:00:10", "a"), ("2026-01-01 00:00:50", "a"), ("2026-01-01 00:01:10", "b")], "at string, k string").withColumn("at", F.to_timestamp("at")).write.parquet(str(tmp_path / "in"))
    stream = streams.windowed(streams.file_stream(spark, str(tmp_path / "in"), "at timestamp, k string"), "at", "1 minute", ["k"])
    query = stream.writeStream.outputMode("complete").format("memory").queryName("windowed_out").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r["k"], r["n"]) for r in spark.table("windowed_out").collect()) == [("a", 2), ("b", 1)]
