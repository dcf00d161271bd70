"""Steps whose work must not grow with the pairs of rows, and ties that the order of a file settles."""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from lakeshed.operators import nearby
from lakeshed.plans import registry


def test_first_line_of_a_tie(spark, tmp_path):
    """Lines of one number: the first in the file counts, however many tasks read it."""
    (tmp_path / "lineitem.parquet").mkdir()
    for name, rows in (("0", range(200)), ("1", range(200, 20_000))):  # Spark begins with the larger file
        lines = {"l_orderkey": [k * 7919 % 50 for k in rows], "l_partkey": list(rows), "l_linenumber": [1 for _ in rows]}
        pq.write_table(pa.table(lines), tmp_path / "lineitem.parquet" / f"{name}.parquet")
    pq.write_table(pa.table({"o_orderkey": list(range(50)), "o_custkey": [k * 5 for k in range(50)], "o_orderpriority": ["1-URGENT"] * 50}), tmp_path / "orders.parquet")
    pq.write_table(pa.table({"c_custkey": list(range(250))}), tmp_path / "customer.parquet")
    con = duckdb.connect()
    con.execute("SET threads = 1")
    for name, path in (("lineitem", "lineitem.parquet/*.parquet"), ("orders", "orders.parquet"), ("customer", "customer.parquet")):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{path}'")
    got = registry.queries()["matched_by_two_keys"](spark, str(tmp_path)).select("o_orderkey", "c_custkey", "first").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(registry.oracle_sql()["matched_by_two_keys"]).fetchall())


def test_clusters_of_dense_places(spark):
    """Thousands of places at one spot, chains of sparse ones, places without a place."""
    r = random.Random(4)
    rows = [(k, 25.0 + r.random() * 0.002, 55.0 + r.random() * 0.002) for k in range(10, 3010)]  # within 300 m
    rows += [(5000 - k, 25.1 + k * 0.004, 55.0) for k in range(150)]  # steps of 445 m
    rows += [(9000 + k, 25.1 + k * 0.005, 55.5) for k in range(3)] + [(3, None, 55.0)]  # steps of 556 m
    got = dict(map(tuple, nearby.clustered(spark.createDataFrame(rows, "id long, lat double, lon double"), "id", 500.0).collect()))
    want = {k: 10 for k in range(10, 3010)} | {5000 - k: 4851 for k in range(150)} | {k: k for k in (9000, 9001, 9002, 3)}
    assert got == want


def test_components_of_a_long_chain(spark):
    """A chain of 400 nodes settles in few rounds, whatever the order of its names."""
    names = random.Random(2).sample(range(10_000), 400)
    edges = spark.createDataFrame(list(zip(names, names[1:], strict=False)), "a long, b long")
    found = nearby.connected(edges, spark.createDataFrame([(k,) for k in names], "id long"), "id").collect()
    assert {r["component"] for r in found} == {min(names)}
    assert len(found) == 400


def test_joins_in_even_tasks(spark):
    """A hot cell is cut into parts of both sides; no pair is lost or given twice."""
    a = spark.createDataFrame([(k % 7 % 3, k) for k in range(200)], "g int, x int")
    b = spark.createDataFrame([(k % 5 % 4, k) for k in range(150)], "g int, y int")
    want = sorted((r["x"], r["y"]) for r in a.join(b, "g").collect())
    for pairs in (1, 50, 1000, 10**9):
        assert sorted((r["x"], r["y"]) for r in nearby.met(a, b, ["g"], pairs).select("x", "y").collect()) == want


def test_nearest_of_crowds(spark):
    """Thousands of places around one another: the k nearest of a group, without all pairs within the radius."""
    r = random.Random(6)
    spots = [(k, k % 2, 25.0 + r.random() ** 3 * 0.05, 55.0 + r.random() ** 3 * 0.05) for k in range(1500)]
    left = spark.createDataFrame(spots[:300], "l long, g int, lat double, lon double")
    right = spark.createDataFrame(spots + [(5000 + k, *spots[0][1:]) for k in range(20)], "r long, g int, lat double, lon double")
    plain = nearby.first_rows(nearby.within(left, right, "l", "r", 4000.0, ["g"]), ["l"], [nearby.F.asc("distance"), nearby.F.asc("r")], 3)
    got = nearby.nearest_within(left, right, "l", "r", 4000.0, 3, ["g"])
    rows = lambda df: sorted((x["l"], x["r"], round(x["distance"], 6)) for x in df.collect())
    assert rows(got) == rows(plain)


def test_narrowed_without_pairs(spark):
    """Groups of a thousand rows on either side: one row each is joined."""
    from lakeshed.operators.merging import narrowed

    known = spark.range(3000).selectExpr("id % 2 as g", "id as v").unionByName(spark.createDataFrame([(5, 9), (None, 4)], "g long, v long"))
    asked = spark.range(2000).selectExpr("id", "nullif(id % 4, 3) as g").unionByName(spark.createDataFrame([(7001, 5)], "id long, g long"))
    out = {x["id"]: (x["verdict"], x["v"]) for x in narrowed(asked, known, ["g"], "v", "id").collect()}
    assert (out[0], out[2], out[3], out[7001], len(out)) == (("ambiguous", None), ("unmatched", None), ("matched", 4), ("matched", 9), 2001)


def test_items_once_with_nulls(spark):
    from lakeshed.operators.resolving import nested_once

    df = spark.sql("SELECT 1 AS k, array(named_struct('n', 3, 'a', 'x', 'b', 1), named_struct('n', 2, 'a', null, 'b', 1), named_struct('n', 1, 'a', 'x', 'b', 1), named_struct('n', 9, 'a', null, 'b', 1)) AS items UNION ALL SELECT 2, null")
    assert {x["k"]: [y["n"] for y in x["items"]] for x in nested_once(df, "k", "items", ["a", "b"]).collect()} == {1: [3, 2], 2: []}
    assert "Exchange" not in nested_once(df, "k", "items", ["a"])._jdf.queryExecution().executedPlan().toString()


def test_close_texts_are_not_broadcast(spark):
    """Segments of texts are joined by a shuffle, whatever Spark expects of their size."""
    from lakeshed.operators.similarity import near_texts

    a, b = spark.createDataFrame([("large ring",)], "a string"), spark.createDataFrame([("large rings",)], "b string")
    out = near_texts(a, b, 88.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert [tuple(r) for r in out.collect()] == [("large ring", "large rings")]


def test_spread_sorts_no_places(spark):
    """Sums by group are hashed: one that holds rows would sort all places of a task; the farthest pair is that of all pairs."""
    from lakeshed.functions.values import metres

    r = random.Random(12)
    rows = [(k, k % 3, 25.0 + r.random(), 55.0 + r.random()) for k in range(600)] + [(900, 7, 25.0, 55.0), (901, 7, 25.0, 55.0), (902, 8, None, 55.0)]
    rows += [(1000 + k, 9, 25.0 + k // 40 * 0.01, 55.0 + k % 40 * 0.01) for k in range(1600)]  # a grid: many share an end
    df = spark.createDataFrame(rows, "id long, g long, lat double, lon double")
    c = nearby.F.col
    pairs = df.alias("a").join(df.alias("b"), "g").groupBy("g").agg(nearby.F.max(metres(c("a.lat"), c("a.lon"), c("b.lat"), c("b.lon"))).alias("far")).filter("far is not null")
    assert dict(map(tuple, nearby.exact_spread(df, "g", "id").collect())) == dict(map(tuple, pairs.collect()))
    bound = nearby.spread(df, "g", "id")
    assert "SortAggregate" not in bound._jdf.queryExecution().executedPlan().toString()
    assert {x["g"] for x in bound.collect()} == {0, 1, 2, 7, 9}


def test_planar_nearest_in_even_tasks(spark):
    """More spots make more tasks, not larger ones, and the same neighbours."""
    r = random.Random(3)
    places = [(k, 25.0 + r.random() ** 2 * 0.1, 55.0 + r.random() * 0.1, k % 4) for k in range(900)]
    df = spark.createDataFrame(places, "id long, lat double, lon double, kind long")
    few, whole = (nearby.planar_nearest(df, df.withColumnRenamed("id", "known"), "known", ["kind"], 3, 5.0, pairs=n) for n in (2000, 10**9))
    rows = lambda x: sorted(map(tuple, x.collect()))
    assert rows(few) == rows(whole) and whole.count() == 2700
    assert "REPARTITION_BY_NUM" in few._jdf.queryExecution().executedPlan().toString()


def test_nearest_sends_no_side_whole(spark, monkeypatch, tmp_path):
    """No join of places is by broadcast, however few bytes stored places take up: neither in the steps that are stored nor in the last."""
    plans, kept = [], nearby.stored
    shown = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    monkeypatch.setattr(nearby, "stored", lambda df, *x: kept(shown(df), *x))
    for name in ("nearest_of_brand", "listing_distances"):
        shown(registry.queries()[name](spark, "/root/testdata/sf0.001"))
    shown(nearby.met(spark.range(30), spark.range(30), ["id"], 10))  # in tasks of ten pairs
    assert len(plans) >= 8 and "SortMergeJoin" in plans[-1] and not [x for x in plans if "BroadcastHashJoin" in x]
