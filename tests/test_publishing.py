"""Databases, versions and retries: what others see while something is written, fails or runs again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeshed.operators import publishing
from lakeshed.operators.gates import Gate
from lakeshed.sources import database
from lakeshed.streaming import retries, streams

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture(scope="module")
def url(spark):
    """A table of 1,000 rows in a database in memory, keys 3, 6, ... and one row without a key."""
    where = "jdbc:derby:memory:lakeshed;create=true"
    rows = [(3 * k, f"name {k}", float(k)) for k in range(1, 1001)]
    spark.createDataFrame([*rows, (None, "none", None)], "ID long, NAME string, PRICE double").write.option("createTableColumnTypes", "NAME varchar(40)").jdbc(where, "items", properties=DRIVER)
    return where


def test_ranges_and_keys(spark, url, monkeypatch):
    assert database.bounds(spark, url, "items", "id", DRIVER) == (3, 3000) and database.bounds(spark, url, "items", "id", DRIVER, 3000) is None
    rows = database.by_ranges(spark, url, "items", "id", DRIVER, 4)
    assert rows.count() == 1000 and rows.rdd.getNumPartitions() == 4
    assert database.by_ranges(spark, url, "items", "id", DRIVER, 4, after=2990, where="price > 998").count() == 2
    keys = spark.createDataFrame([(3,), (6,), (6,), (7,), (None,), (3000,)], "k long")
    for sent in (50_000, 2):
        monkeypatch.setattr(database, "SENT_KEYS", sent)
        monkeypatch.setattr(database, "KEYS_A_QUERY", 2)
        assert {r["ID"] for r in database.of_keys(spark, url, "items", "id", keys, DRIVER).collect()} == {3, 6, 3000}
    monkeypatch.setattr(database, "SENT_KEYS", 50_000)
    assert database.of_keys(spark, url, "items", "id", keys.limit(0), DRIVER).count() == 0


def test_resumed_copy(spark, url, tmp_path):
    path = str(tmp_path / "copy")
    assert database.resumed(spark, url, "items", "id", path, DRIVER, 3) == 1000
    assert database.resumed(spark, url, "items", "id", path, DRIVER, 3) == 0
    spark.createDataFrame([(4000, "later", 1.0), (4001, "later", 2.0)], "ID long, NAME string, PRICE double").write.mode("append").jdbc(url, "items", properties=DRIVER)
    assert database.resumed(spark, url, "items", "id", path, DRIVER, 3) == 2
    assert spark.read.parquet(path).count() == 1002 and spark.read.parquet(path).select("id").distinct().count() == 1002


def test_staged_writes(spark, url):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 2).alias("twice"))
    for rows in (df, df.limit(10)):
        database.staged(rows, url, "staging", DRIVER, parts=3, batch=100)
        assert spark.read.jdbc(url, "staging", properties=DRIVER).count() == rows.count()


def test_a_reader_sees_whole_versions(spark, tmp_path):
    folder = str(tmp_path / "table")
    one = spark.createDataFrame([(1, 5.0), (2, 6.0)], "id int, p double")
    gates = [Gate("negative", F.col("p") < 0)]
    with pytest.raises(FileNotFoundError):
        publishing.current(spark, folder)
    assert publishing.published(one, folder, "r1", gates) == []
    reader = publishing.current(spark, folder)  # opened before what follows
    first = publishing.version(spark, folder)
    assert publishing.published(one.withColumn("p", -F.col("p")), folder, "r2", gates) == ["negative"] and publishing.version(spark, folder) == first
    assert publishing.published(one.limit(1), folder, "r3", gates, dry_run=True) == [] and publishing.version(spark, folder) == first
    broken = one.withColumn("p", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        publishing.published(broken, folder, "r4")
    assert publishing.version(spark, folder) == first and publishing.current(spark, folder).count() == 2
    assert publishing.published(one.limit(1), folder, "r5", gates) == []
    assert publishing.published(one.limit(1), folder, "r5", gates) == []  # again
    assert publishing.current(spark, folder).count() == 1 and reader.count() == 2


def test_a_log_has_each_run_once(spark, tmp_path):
    folder = str(tmp_path / "log")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "branch string, v int")
    for part in (rows, rows, rows.filter("branch = 'b'").withColumn("v", F.lit(9)), rows.filter("branch = 'c'")):
        assert publishing.appended(part, folder, "run1", "branch") == []
    publishing.appended(rows.limit(0).unionByName(spark.createDataFrame([("a", 7)], "branch string, v int")), folder, "run2", "branch")
    assert {tuple(r) for r in publishing.logged(spark, folder, ["run1", "run2"]).collect()} == {("a", 1, "run1"), ("a", 2, "run1"), ("b", 9, "run1"), ("a", 7, "run2")}
    assert publishing.appended(rows.withColumn("v", F.lit(-1)), folder, "run1", "branch", [Gate("negative", F.col("v") < 0)]) == ["negative"]
    assert publishing.current(spark, f"{folder}/run=run1").count() == 3


def test_retries_over_restarts(spark, tmp_path):
    """Three failures are dead, a success ends, keys are forgotten after an hour, late rows are left out."""
    schema = "k long, at timestamp, n long, failed boolean"
    day = "2024-01-01 "
    batches = [
        [(1, "00:00", 1, True), (1, "00:00", 2, True), (2, "00:01", 3, True), (3, "00:02", 4, False), (None, "00:02", 5, True), (5, "00:02", 6, True)],
        [(1, "00:10", 7, True), (1, "00:11", 8, False), (2, "00:10", 9, False), (2, "00:12", 10, True)],
        [(4, "09:00", 11, True)],
        [(4, "09:01", 12, True), (5, "09:02", 13, True), (1, "01:00", 14, True)],
        [(5, "09:03", 15, True)],
    ]
    for k, rows in enumerate(batches):
        frame = spark.createDataFrame([(key, day + at, n, f) for key, at, n, f in rows], "k long, at string, n long, failed boolean").withColumn("at", F.col("at").cast("timestamp"))
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        with retries.with_store(spark):
            told = retries.attempts(streams.file_stream(spark, str(tmp_path / "in"), schema), "k", "at", "n", "failed", 3, "10 minutes", "1 hour")
            streams.run_once(told, "parquet", str(tmp_path / "out"), str(tmp_path / "state"))
    got = {r["key"]: (r["attempts"], r["status"]) for r in retries.last_status(spark.read.parquet(str(tmp_path / "out"))).collect()}
    assert got == {1: (3, "dead"), 2: (1, "done"), 3: (0, "done"), 4: (2, "retry"), 5: (2, "retry")}  # the first failure of 5 is forgotten
