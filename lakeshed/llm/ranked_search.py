"""Ranked lexical search: term at a time with a limited number of accumulators.

Terms are runs of letters, digits and bytes beyond ASCII, A-Z in lower case.  The
terms of all queries are numbered in sorted pieces in the shared folder; one scan
of the documents keeps each one's length and its counts of these terms, and from
these come the number of documents, of words, and of the documents that hold each
term.  Queries are dealt to blocks, written to the shared folder too.

A task takes its documents' counts a slice at a time, turns them into inverted
lists with each list's largest contribution, and runs every query over them:
terms come rarest first; each document of a term's list gets an accumulator; as
soon as what the remaining terms can give at most lies below the k-th partial
score (of this slice, or of slices before), no new accumulators are made, and the
lists that remain only add to those there are.  So scores are exact, and whoever
could still reach the best k is kept; a document that could only tie with the
k-th keeps its accumulator, as its id may be the smaller.  The best k of each
task are merged by query, by groups of tasks first.

Nothing but totals, the sizes of pieces and the numbers of blocks reaches the
driver.  A slice has at most ``SLICE`` counts or one document's.

Defined results: null and empty texts have no terms and don't count as
documents; repeated rows are documents of their own; equal scores are in order of
the id, null first; queries of equal id and text are one, of equal id and other
text are ranked each by itself; a query without terms, and an empty table, give
no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakeshed.llm.common import new_path, stored, table
from lakeshed.llm.store import Store
from lakeshed.llm.words import chunks, word_hashes

K = 10
SLICE = 4_000_000
#: Terms in a piece of the vocabulary and queries in a block, about.
PIECE, BLOCK = 1 << 20, 4096

#: Everything but letters, digits and bytes beyond ASCII parts terms.
PARTS = np.ones(256, bool)
for _range in (range(ord("0"), ord("9") + 1), range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1), range(0x80, 0x100)):
    PARTS[list(_range)] = False
_U = np.uint64


@dataclass(frozen=True)
class Vocabulary:
    """Sorted pieces of term hashes by their upper bits; a term's number is its place in all of them."""

    folder: str
    bits: int
    before: tuple[int, ...]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each of these sorted hashes, -1 for others."""
        out = np.full(len(hashes), -1)
        cuts = np.searchsorted(hashes, [_U(p << (64 - self.bits)) for p in range(1, 1 << self.bits)]) if self.bits else []
        for piece, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(hashes)], strict=True)):
            terms = _piece(self.folder, piece, self.before[piece + 1] - self.before[piece])
            if a < b and len(terms):
                at = np.searchsorted(terms, hashes[a:b])
                at[at == len(terms)] = 0
                out[a:b] = np.where(terms[at] == hashes[a:b], at + self.before[piece], -1)
        return out


@lru_cache(maxsize=4096)
def _piece(folder: str, piece: int, size: int) -> np.ndarray:
    return Store(folder).read(f"terms-{piece}", np.uint64) if size else np.zeros(0, np.uint64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    return pa.array(values, pa.list_(pa.int64()))


def vocabulary_of(queries: DataFrame) -> Vocabulary:
    """Of all terms (signed hashes) in the column ``terms``."""
    folder = new_path(queries.sparkSession, "search-terms")
    terms = stored(queries.select(F.explode("terms").alias("term")).distinct(), "search-vocabulary")
    bits = max(0, (terms.count() // PIECE).bit_length())

    def write(group: pa.Table) -> pa.Table:
        piece = group.column("piece")[0].as_py()
        Store(folder).write(f"terms-{piece}", np.sort(group.column("term").to_numpy().view(np.uint64)))
        return pa.table({"piece": pa.array([piece], pa.int64()), "size": pa.array([len(group)], pa.int64())})

    piece = F.shiftrightunsigned("term", 64 - bits) if bits else F.lit(0).cast("long")
    sizes = dict(terms.withColumn("piece", piece).groupBy("piece").applyInArrow(write, "piece long, size long").toPandas().itertuples(index=False, name=None))
    before = np.concatenate([[0], np.cumsum([int(sizes.get(p, 0)) for p in range(1 << bits)])])
    return Vocabulary(folder, bits, tuple(map(int, before)))


def counted(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, words, terms, times: documents with at least one word, and their counts of the vocabulary's terms by number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in chunks(batch.column(1)):
                hashes, first = word_hashes(data, offsets, PARTS)
                names, which = np.unique(hashes, return_inverse=True)
                number = vocabulary.find(names)[which]
                doc = np.repeat(np.arange(end - at), np.diff(first))[number >= 0]
                order = np.lexsort((number[number >= 0], doc))
                doc, number = doc[order], number[number >= 0][order]
                start = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])])) if len(doc) else np.zeros(0, int)
                times, cuts = np.diff(np.append(start, len(doc))), np.searchsorted(doc[start], np.arange(end - at + 1))
                words = np.diff(first)
                full = np.flatnonzero(words)
                listed = lambda x: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x, pa.int64()))  # noqa: E731,B023
                columns = [batch.column(0).slice(at, end - at), pa.array(words, pa.int64()), listed(number[start]), listed(times)]
                yield pa.RecordBatch.from_arrays([x.take(pa.array(full)) for x in columns], ["doc_id", "words", "terms", "times"])

    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {dict(docs.dtypes)['doc_id']}, words long, terms array<long>, times array<long>")


def held_by(postings: DataFrame) -> DataFrame:
    """term, df: in how many documents each term is, summed up within tasks first."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for batch in batches:
            now = np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64), minlength=len(held))
            now[: len(held)] += held
            held = now
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(held[some], pa.int64())], ["term", "df"])

    return postings.select("terms").mapInArrow(sums, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _with_terms(items: DataFrame) -> DataFrame:
    """item_id, number, terms: distinct items with their distinct terms' hashes; written, so that numbers stay."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for _, _, data, offsets in chunks(batch.column(2)) for h, first in [word_hashes(data, offsets, PARTS)] for x in (np.unique(h[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:], strict=True))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(found)], ["item_id", "number", "terms"])

    numbered = stored(items.filter("text is not null").select("item_id", "text").distinct().withColumn("number", F.monotonically_increasing_id()), "search-items")
    return stored(numbered.select("item_id", "number", "text").mapInArrow(terms, f"item_id {dict(items.dtypes)['item_id']}, number long, terms array<long>"), "search-queries")


@dataclass(frozen=True)
class Queries:
    """Blocks of queries: their numbers, and their terms' numbers and weights, rarest first."""

    folder: str
    blocks: tuple[int, ...]


_ARRAYS = {"numbers": np.int64, "first": np.int64, "terms": np.int64, "weights": np.int64}


def queries_of(queries: DataFrame, vocabulary: Vocabulary, held: DataFrame, docs: int) -> Queries:
    """Weighs the queries' terms by the number of documents that hold them, and writes blocks."""
    folder = new_path(queries.sparkSession, "search-blocks")

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vocabulary.find(np.sort(np.array(x, np.int64).view(np.uint64))) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found)], ["number", "terms"])

    weight = F.floor(1000 * F.log((2.0 * docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    one = queries.select("number", "terms").mapInArrow(numbers, "number long, terms array<long>").select("number", F.explode("terms").alias("term"))
    weighed = one.join(held, "term").withColumn("weight", weight).filter("weight > 0")
    lists = weighed.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("df", "term", "weight"))).alias("x"))  # a query's terms, no more than its text
    blocks = max(1, -(-queries.count() // BLOCK))
    dealt = lists.select("number", F.col("x.term").alias("terms"), F.col("x.weight").alias("weights"), F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int").alias("block"))

    def write(group: pa.Table) -> pa.Table:
        group = group.sort_by("number")
        block, terms, weights = group.column("block")[0].as_py(), group.column("terms").combine_chunks(), group.column("weights").combine_chunks()
        arrays = {"numbers": group.column("number").to_numpy(), "first": np.concatenate([[0], np.cumsum(pc.list_value_length(terms).to_numpy())]), "terms": terms.flatten().to_numpy(), "weights": weights.flatten().to_numpy()}
        for name, kind in _ARRAYS.items():
            Store(folder).write(f"{name}-{block}", np.ascontiguousarray(arrays[name], kind))
        return pa.table({"block": pa.array([block], pa.int32())})

    built = dealt.groupBy("block").applyInArrow(write, "block int").collect()
    return Queries(folder, tuple(sorted(r["block"] for r in built)))


@lru_cache(maxsize=256)
def _block(folder: str, block: int) -> dict[str, np.ndarray]:
    return {name: Store(folder).read(f"{name}-{block}", kind) for name, kind in _ARRAYS.items()}


def _damped(words: np.ndarray, docs: int, total: int) -> np.ndarray:
    """A tenth of the length's weight, and nine tenths of it in proportion to the mean length, in hundredths."""
    if len(words) and 90 * int(words.max()) * docs >= 1 << 63:
        return np.array([10 + 90 * int(n) * docs // total for n in words], np.int64)
    return 10 + 90 * words * docs // total


class Lists:
    """A slice's inverted lists, with each list's largest contribution for a unit of weight."""

    def __init__(self, words: np.ndarray, first: np.ndarray, terms: np.ndarray, times: np.ndarray, docs: int, total: int):
        self.count = len(words)
        doc = np.repeat(np.arange(self.count), np.diff(first))
        order = np.argsort(terms, kind="stable")
        self.docs, times, terms = doc[order], times[order], terms[order]
        self.gains = 1_000_000_000 * times // (1000 * times + 8 * _damped(words, docs, total)[self.docs])
        self.start = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
        self.names = terms[self.start]
        self.most = np.maximum.reduceat(self.gains, self.start) if len(terms) else self.gains
        self.start = np.append(self.start, len(terms))
        self.score = np.zeros(self.count, np.int64)
        self.live = np.zeros(self.count, bool)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that may be among the best k, all scores exact; ``least`` is the k-th score known from elsewhere, or 0."""
        at = np.searchsorted(self.names, terms)
        at[at == len(self.names)] = 0
        held = self.names[at] == terms if len(self.names) else np.zeros(len(terms), bool)
        at, weights = at[held], weights[held]
        rest = np.concatenate([np.cumsum((weights * self.most[at])[::-1])[::-1], [0]])
        made, making = [], True
        for step, (t, w) in enumerate(zip(at.tolist(), weights.tolist(), strict=True)):
            docs, gains = self.docs[self.start[t] : self.start[t + 1]], self.gains[self.start[t] : self.start[t + 1]]
            if making:
                kth = least
                if rest[step] >= kth and sum(map(len, made)) >= k:
                    live = np.concatenate(made)
                    kth = max(kth, int(np.partition(self.score[live], len(live) - k)[len(live) - k]))
                making = rest[step] >= kth
            if making:
                new = docs[~self.live[docs]]
                self.live[new] = True
                made.append(new)
            else:
                keep = self.live[docs]
                docs, gains = docs[keep], gains[keep]
            self.score[docs] += w * gains
        live = np.concatenate(made) if made else np.zeros(0, np.int64)
        scores = self.score[live]
        self.score[live], self.live[live] = 0, False
        if len(live) > k:
            good = scores >= max(1, least, int(np.partition(scores, len(live) - k)[len(live) - k]))
        else:
            good = scores >= max(1, least)
        return live[good], scores[good]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
        yield at, end
        at = end


def _order(found: tuple[int, object]) -> tuple:
    """By score downwards, then by id, null first."""
    return (found[0], False) if found[1] is None else (found[0], True, found[1])


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents."""
    queries = _with_terms(items)
    vocabulary = vocabulary_of(queries)
    postings = stored(counted(docs, vocabulary), "search-postings")
    kind, kind_of_id = dict(docs.dtypes)["doc_id"], to_arrow_type(docs.schema["doc_id"].dataType)
    facts = postings.agg(F.count("*"), F.coalesce(F.sum("words"), F.lit(0))).first()
    total_docs, total_words = int(facts[0]), int(facts[1])
    blocks = queries_of(queries, vocabulary, held_by(postings), total_docs)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, object]]] = {}  # (-score, doc_id)
        for batch in batches:
            for a, b in _slices(batch):
                part = batch.slice(a, b - a)
                sizes = pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False)
                flat = lambda c: part.column(c).flatten().to_numpy(zero_copy_only=False)  # noqa: E731,B023
                lists = Lists(part.column(1).to_numpy(), np.concatenate([[0], np.cumsum(sizes)]), flat(2), flat(3), total_docs, total_words)
                place = pc.rank(part.column(0), sort_keys="ascending", null_placement="at_start", tiebreaker="first").to_numpy()
                for name in blocks.blocks:
                    block = _block(blocks.folder, name)
                    first = block["first"]
                    for j, item in enumerate(block["numbers"].tolist()):
                        have = best.get(item, [])
                        found, scores = lists.best(block["terms"][first[j] : first[j + 1]], block["weights"][first[j] : first[j + 1]], k, -have[-1][0] if len(have) == k else 0)
                        if len(found):
                            top = np.lexsort((place[found], -scores))[:k]
                            ids = part.column(0).take(pa.array(found[top])).to_pylist()
                            best[item] = sorted([*have, *zip((-scores[top]).tolist(), ids, strict=True)], key=_order)[:k]
        rows = [(item, i, -s) for item, top in best.items() for s, i in top]
        numbers, ids, scores = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(ids, kind_of_id), pa.array(scores, pa.int64())], ["number", "doc_id", "score"])

    found = postings.mapInArrow(search, f"number long, doc_id {kind}, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    by_group = Window.partitionBy("number", "_group").orderBy(*order)
    by_item = Window.partitionBy("number").orderBy(*order)
    few = found.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(64))).withColumn("rank", F.row_number().over(by_group)).filter(F.col("rank") <= k)
    top = few.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= k)
    return top.join(queries.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ASCII = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("text")}, '{_ASCII}') AS terms FROM documents WHERE text IS NOT NULL),
asked AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all({_LOWER.format("text")}, '{_ASCII}')) AS term FROM benchmark),
long_ AS (SELECT r, doc_id, terms, len(terms) AS n FROM docs WHERE len(terms) > 0),
facts AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM long_),
tf AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM long_) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
weights AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w FROM df, facts),
scores AS (
  SELECT a.item_id, a.text, tf.r, tf.doc_id, sum(w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * tf.n * facts.docs) // facts.total))))::BIGINT AS score
  FROM asked a JOIN weights USING (term) JOIN tf USING (term), facts GROUP BY 1, 2, 3, 4),
placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM placed WHERE rank <= 10
"""
