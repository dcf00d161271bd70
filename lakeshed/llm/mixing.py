"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order that repeats up to
``max_repeats`` times.  A document's virtual finish time is its source's
cumulative words divided by the source's target; all queues are served by
finish time until the budget is spent, the last document in part.

Defined results: null sources are one source, the last; a null or empty text has
size 0 and is never taken; repeated rows are documents of their own; an empty
table gives an empty mix; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshed.llm.common import bucket_count, stored, table, totals_before, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: Finish times of 0 to 4 in at least so many ranges, more for many rows; the mix ends near time 1.
LEAST_RANGES = 4096
#: A number that ``mixed`` takes for the row's, if there is such a column.
ROW = "row number for mixing"


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target: the budget (all words) shared by weight, none above ``max_repeats`` times its source.

    A source is full where its limit for each unit of weight lies below the level
    of those after it.  There is one row for each source.
    """
    by_source = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.partitionBy(F.lit(0)).orderBy("ratio", F.col("source").asc_nulls_last())
    before, every = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_source) - 1) % len(weights) + 1).cast("int"))
    out = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    out = out.withColumn("limit", F.col("source_size") * max_repeats).withColumn("ratio", F.col("limit") / F.col("weight"))
    out = out.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    out = out.withColumn("place", F.row_number().over(by_limit))
    out = out.withColumn("first_open", F.min(F.when(F.col("ratio") >= F.col("level"), F.col("place"))).over(every))
    out = out.withColumn("open_level", F.max(F.when(F.col("place") == F.col("first_open"), F.col("level"))).over(every))
    target = F.when(F.col("place") < F.col("first_open"), F.col("limit").cast("double")).otherwise(F.col("weight") * F.col("open_level"))
    return out.select("source", "source_size", target.alias("target"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = "") -> DataFrame:
    """One row for each document and pass that the queues hold, with the words taken of it.

    Columns: _row (a number of the document's row), doc_id, source, size,
    source_size, target, pass, finish (virtual time), start_word (its place in
    the mix; null past the end), taken.
    """
    order = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(seed)))
    row = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), row.alias("_row"), F.coalesce(order, F.lit("")).alias("shuffle"))
    sizes = stored(sizes, "mix-sizes")
    facts = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    rows, budget = facts[0], facts[1]
    buckets = bucket_count(rows)
    ranges = bucket_count(4 * rows, least=LEAST_RANGES, most=1 << 20)
    digits = 5  # hex digits of the shuffle key that choose a bucket
    sizes = sizes.withColumn("bucket", F.floor(F.coalesce(F.conv(F.substring("shuffle", 1, digits), 16, 10).cast("long"), F.lit(0)) / (16**digits // min(buckets, 16**digits))))
    queued = totals_before(sizes, ["source"], "bucket", [F.col("shuffle"), F.col("doc_id"), F.col("size"), F.col("_row")], F.col("size"), "before")
    targets = source_targets(sizes, weights, max_repeats).withColumnRenamed("source", "_source")
    queued = queued.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "bucket")
    passes = F.when(F.col("source_size") > 0, F.sequence(F.lit(0), F.greatest(F.ceil(F.col("target") / F.col("source_size")), F.lit(1)).cast("int") - 1)).otherwise(F.array(F.lit(0)))
    queued = queued.withColumn("pass", F.explode(passes))
    finish = F.when(F.col("target") > 0, (F.col("pass") * F.col("source_size") + F.col("before") + F.col("size")) / F.col("target"))
    queued = queued.withColumn("finish", F.when(F.col("size") > 0, finish)).withColumn("range", F.least(F.floor(F.col("finish") * (ranges / 4)), F.lit(ranges)).cast("int"))
    queued = stored(queued.drop("before"), "mix-queue")
    by_range = queued.filter("size > 0").groupBy("range").agg(F.sum("size").alias("words"))
    cumulative = by_range.select("range", F.sum("words").over(Window.partitionBy(F.lit(0)).orderBy("range")).alias("through"))
    end = cumulative.filter(F.col("through") >= budget).agg(F.min("range")).first()[0]
    end = ranges if end is None else end
    served = queued.filter((F.col("size") > 0) & (F.col("range") <= end))
    served = totals_before(served, [], "range", [F.col("finish"), F.col("source").asc_nulls_last(), F.col("shuffle"), F.col("doc_id"), F.col("pass"), F.col("_row")], F.col("size"), "start_word")
    taken = F.greatest(F.least(F.col("size"), F.lit(budget) - F.col("start_word")), F.lit(0)).cast("long")
    served = served.withColumn("start_word", F.when(F.col("start_word") < budget, F.col("start_word"))).withColumn("taken", F.when(F.col("start_word").isNull(), F.lit(0)).otherwise(taken))
    rest = queued.filter((F.col("size") == 0) | (F.col("range") > end)).withColumns({"start_word": F.lit(None).cast("long"), "taken": F.lit(0).cast("long")})
    return served.unionByName(rest).drop("shuffle", "range")


def words_taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row for each row of ``docs``."""
    one = mixed(docs).groupBy("_row").agg(*[F.first(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target")], F.sum("taken").alias("taken"))
    return one.select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which the mix takes at least a word, each as often as it takes it.

    Rows are written with a number of their own first, so that repeated ids and
    rows without one are taken apart.
    """
    numbered = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "mix-docs")
    times = mixed(numbered).filter("taken > 0").groupBy("_row").agg(F.count("*").cast("int").alias("times"))
    joined = numbered.join(times, numbered[ROW] == times["_row"])
    again = joined.select(*[numbered[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), times["times"])).alias("turn of the mix"))
    return again.drop("turn of the mix")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_taken(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


ORACLE = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(doc_id::VARCHAR) AS shuffle FROM documents),
weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM sizes GROUP BY source),
limited AS (SELECT *, source_size * 3 AS lim, (source_size * 3)::DOUBLE / weight AS ratio FROM weighed),
leveled AS (
  SELECT *, row_number() OVER o AS place,
    (sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM limited WINDOW o AS (ORDER BY ratio, source NULLS LAST)),
opened AS (SELECT *, min(CASE WHEN ratio >= level THEN place END) OVER () AS first_open FROM leveled),
targets AS (
  SELECT source, source_size, CASE WHEN place < first_open THEN lim::DOUBLE ELSE weight * max(CASE WHEN place = first_open THEN level END) OVER () END AS target FROM opened),
queued AS (
  SELECT s.doc_id, s.source, s.size, s.shuffle, t.source_size, t.target, sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffle, s.doc_id) AS through
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
passes AS (
  SELECT q.*, p.n, (p.n * q.source_size + q.through)::DOUBLE / q.target AS finish
  FROM queued q, (VALUES (0), (1), (2)) p(n) WHERE q.size > 0 AND p.n < greatest(ceil(q.target / q.source_size), 1)),
served AS (
  SELECT doc_id, size, (sum(size) OVER (ORDER BY finish, source NULLS LAST, shuffle, doc_id, n) - size)::BIGINT AS start_word FROM passes),
taken AS (
  SELECT doc_id, sum(greatest(least(size, (SELECT sum(size) FROM sizes)::BIGINT - start_word), 0))::BIGINT AS taken FROM served GROUP BY doc_id)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, coalesce(t.taken, 0)::BIGINT AS taken FROM queued q LEFT JOIN taken t USING (doc_id)
"""
