"""Benchmark decontamination: BM25 over test items with block-max WAND, then an overlap check.

Items are indexed by word (runs of letters, digits and bytes beyond ASCII, in
lower case).  An item's scores are divided by what its own text scores, so one
threshold serves short and long items.  Documents are cut into overlapping
passages of twice the longest item, so that a whole item always lies in one.

A passage is a query of its distinct words.  Bounds in the manner of block-max
WAND come first, for all passages of a chunk at once: the sum of the words'
largest contributions over all items, then over each block of items.  Items of
the blocks whose bound reaches the threshold are scored from the posting lists,
and those above it are checked: the share of the question's three-word runs, and
of the answer's words in order, that the passage holds.  The answer is what
follows ``answer:``, else the last sentence, else the last fifth of the words.

Rarity, mean length and longest item are taken over all items.  Items are dealt
to parts of about ``PART_BYTES`` of text; a task builds each part's index and
writes it to the shared folder, from where workers map it: documents are scanned
once, nothing but totals and the parts' numbers reaches the driver, and results
don't depend on the size of parts.

Defined results: null and empty texts match nothing, nor do items without a
word; an item without an item_id counts, with a null one; there is one row for
each doc_id and item_id that match, with the best score, whatever rows repeat
either; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.llm.common import new_path, stored, table
from lakeshed.llm.store import Store
from lakeshed.llm.words import chunks, runs_of, word_hashes

K1, B = 1.2, 0.75
THRESHOLD = 0.65
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.6, 0.6
RUN = 3
#: A part's items lie in at most so many blocks of at least 8.
BLOCKS = 64
PART_BYTES = 4 << 20
LEAST_PASSAGE = 64

#: Everything but letters, digits and bytes beyond ASCII parts words.
_PARTS = np.ones(256, bool)
for _range in (range(ord("0"), ord("9") + 1), range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1), range(0x80, 0x100)):
    _PARTS[list(_range)] = False
_U = np.uint64


def _words_of(text: str) -> np.ndarray:
    data = np.frombuffer(pc.utf8_lower(text).as_py().encode(), np.uint8)
    return word_hashes(data, np.array([0, len(data)]), _PARTS)[0]


def question_and_answer(text: str) -> tuple[str, str]:
    """Cuts an item: at ``answer:``, else before its last sentence, else before the last fifth of its words."""
    if m := re.search(r"(?i)\banswer\s*:", text):
        return text[: m.start()], text[m.end() :]
    if sentences := [m.end() for m in re.finditer(r"[.!?]\s+", text.rstrip())]:
        return text[: sentences[-1]], text[sentences[-1] :]
    words = text.split()
    at = len(words) - max(1, len(words) // 5)
    return " ".join(words[:at]), " ".join(words[at:])


@dataclass(frozen=True)
class Totals:
    """What scores need of all items together, and where the parts of the index lie."""

    items: int
    mean: float
    longest: int
    folder: str = ""
    parts: tuple[int, ...] = ()


_ARRAYS = {
    "items": np.int64, "terms": np.uint64, "start": np.int64, "holders": np.int32, "gains": np.float64, "most": np.float64, "block_most": np.float32,
    "runs": np.uint64, "runs_at": np.int64, "asked": np.int64, "answers": np.uint64, "answers_at": np.int64,
}


def _parts_of(texts: list[str]) -> tuple[list[np.ndarray], list[int], list[np.ndarray]]:
    """Each item's question's distinct word runs, its number of words, and the answer's words."""
    split = [tuple(map(_words_of, question_and_answer(t))) for t in texts]
    return [np.unique(runs_of(q, min(RUN, len(q)))) if len(q) else np.zeros(0, np.uint64) for q, _ in split], [len(q) for q, _ in split], [a for _, a in split]


def indexed(items: np.ndarray, texts: list[str], terms: list[np.ndarray], times: list[np.ndarray], held: list[np.ndarray], totals: Totals) -> dict[str, np.ndarray]:
    """The arrays of an index of these items: ``terms`` are an item's distinct words in order, ``times`` their counts in it, ``held`` in how many items each is."""
    shares = []
    for n, df in zip(times, held, strict=True):
        part = np.log1p((totals.items - df + 0.5) / (df + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * n.sum() / totals.mean))
        shares.append(part / part.sum())
    flat = np.concatenate(terms) if terms else np.zeros(0, np.uint64)
    names, which = np.unique(flat, return_inverse=True)
    holder = np.repeat(np.arange(len(terms)), [len(x) for x in terms])
    order = np.lexsort((holder, which))
    gains = np.concatenate(shares)[order] if shares else np.zeros(0)
    which, holder = which[order], holder[order]
    start = np.searchsorted(which, np.arange(len(names) + 1))
    block = max(8, -(-len(terms) // BLOCKS))
    block_most = np.zeros((len(names), -(-max(1, len(terms)) // block)), np.float32)
    np.maximum.at(block_most, (which, holder // block), gains.astype(np.float32))
    runs, asked, answers = _parts_of(texts)
    at = lambda lists: np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    joined = lambda lists: np.concatenate(lists) if lists else np.zeros(0, np.uint64)
    out = (items, names, start, holder, gains, np.maximum.reduceat(gains, start[:-1]) if len(names) else gains, block_most.ravel(), joined(runs), at(runs), asked, joined(answers), at(answers))
    return {name: np.asarray(x, kind) for (name, kind), x in zip(_ARRAYS.items(), out, strict=True)}


class Index:
    """Inverted lists in order of items, with each block's largest contribution."""

    def __init__(self, arrays: dict[str, np.ndarray], longest: int):
        for name, values in arrays.items():
            setattr(self, name, values)
        self.longest = longest
        count = len(self.items)
        self.block = max(8, -(-count // BLOCKS))
        self.block_most = self.block_most.reshape(len(self.terms), -(-max(1, count) // self.block))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.terms & _U(0xFFFF)).astype(np.int64)] = True

    def find(self, words: np.ndarray) -> np.ndarray:
        """The number of each word in the index, -1 for others."""
        out = np.full(len(words), -1)
        some = np.flatnonzero(self.maybe[(words & _U(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.terms, words[some])
        at[at == len(self.terms)] = 0
        ok = self.terms[at] == words[some]
        out[some[ok]] = at[ok]
        return out

    def above(self, terms: np.ndarray, blocks: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """(item, score) of all items of these blocks to which these distinct terms give at least ``threshold``."""
        score = np.zeros(len(blocks) * self.block)
        for place, block in enumerate(blocks):
            low = block * self.block
            for t in terms[self.block_most[terms, block] > 0]:
                first = self.start[t]
                a, b = first + np.searchsorted(self.holders[first : self.start[t + 1]], (low, low + self.block))
                score[place * self.block + self.holders[a:b] - low] += self.gains[a:b]
        good = np.flatnonzero(score >= threshold)
        return [(int(blocks[k // self.block] * self.block + k % self.block), float(score[k])) for k in good]

    def verified(self, item: int, passage: np.ndarray) -> tuple[float, float]:
        """Shares of the question's word runs, and of the answer's words in their order, that the passage holds; the second is 0 below its threshold, and not looked for where the first is below its own."""
        runs, asked = self.runs[self.runs_at[item] : self.runs_at[item + 1]], int(self.asked[item])
        question = float(np.isin(runs, runs_of(passage, min(RUN, asked))).mean()) if asked else 1.0
        answer = self.answers[self.answers_at[item] : self.answers_at[item + 1]]
        if question < QUESTION_OVERLAP or not len(answer):
            return question, 1.0
        return question, _in_order(answer, passage, max(1, int(np.ceil(ANSWER_OVERLAP * len(answer) - 1e-9)))) / len(answer)


@lru_cache(maxsize=4096)
def _mapped(folder: str, part: int, longest: int) -> Index:
    store = Store(folder)
    return Index({name: store.read(f"{name}-{part}", kind) for name, kind in _ARRAYS.items()}, longest)


def _common(masks: dict[int, int], size: int, words: list[int], enough: int) -> tuple[int, int]:
    """The longest common subsequence of an answer and these words, a bit for each word of the answer; and after how many words it has ``enough``."""
    full = (1 << size) - 1
    free, at = full, len(words)
    for k, word in enumerate(words):
        if hit := free & masks.get(word, 0):
            free = ((free + hit) | (free - hit)) & full
            if at == len(words) and size - free.bit_count() >= enough:
                at = k + 1
    return size - free.bit_count(), at


def _in_order(short: np.ndarray, long: np.ndarray, need: int = 1) -> int:
    """The length of the longest common subsequence within any stretch of twice the answer's length; 0 if it is below ``need``.

    Stretches of twice that, half over each other, hold every such one and bound it.
    Within one whose bound is above the best so far, the tightest place that reaches
    the bound is tried, then starts in order; as a step of a start changes the length
    by one at most, starts that can't get above the best are passed over.
    """
    size, width = len(short), 2 * len(short)
    masks, back = {}, {}
    for k, word in enumerate(short.tolist()):
        masks[word] = masks.get(word, 0) | 1 << k
        back[word] = back.get(word, 0) | 1 << (size - 1 - k)
    hits = np.flatnonzero(np.isin(long, short))
    words, best = long[hits].tolist(), need - 1
    between = lambda a, b: slice(*np.searchsorted(hits, (a, b)))
    for left in range(0, len(long), width):
        part = between(left, left + 2 * width)
        bound, _ = _common(masks, size, words[part], size + 1)
        if bound <= best:
            continue
        _, end = _common(masks, size, words[part], bound)
        _, start = _common(back, size, words[part][:end][::-1], bound)
        first = int(hits[part][end - start])
        best = max(best, _common(masks, size, words[between(first, first + width)], size + 1)[0])
        at = left
        while best < bound and at < min(left + width, len(long)):
            found, _ = _common(masks, size, words[between(at, at + width)], size + 1)
            at += max(1, best - found + 1)
            best = max(best, found)
        if best == size:
            break
    return best if best >= need else 0


def _matches(index: Index, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
    """(document, item, score, question overlap, answer overlap) of a chunk: each item's best passage."""
    length = max(LEAST_PASSAGE, 2 * index.longest)
    step = length // 2
    terms = index.find(words)
    counts = np.maximum(1, -(-(np.diff(first) - step) // step))
    doc = np.repeat(np.arange(len(counts)), counts)
    begin = first[doc] + step * (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts))
    end = np.minimum(begin + length, first[doc + 1])
    hits = np.flatnonzero(terms >= 0)
    held = terms[hits].astype(np.uint16 if len(index.terms) < 1 << 16 else np.int64)
    order = np.argsort(held, kind="stable")
    before = np.full(len(hits), -1)  # where the same word was last
    same = held[order][1:] == held[order][:-1]
    before[order[1:][same]] = hits[order[:-1][same]]
    low, high = np.searchsorted(hits, begin), np.searchsorted(hits, end)
    passage = np.repeat(np.arange(len(doc)), high - low)
    at = np.arange(len(passage)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[passage]
    new = before[at] < begin[passage]
    passage, held = passage[new], held[at[new]].astype(np.int64)
    bound = np.bincount(passage, index.most[held], len(doc))
    ok = bound[passage] >= THRESHOLD - 1e-6
    passage, held = passage[ok], held[ok]
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    if len(passage):
        start = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        bounds = np.add.reduceat(index.block_most[held], start, axis=0)
        stop = np.append(start[1:], len(passage))
        for k in np.flatnonzero(bounds.max(1) >= THRESHOLD - 1e-4):
            p = passage[start[k]]
            for item, score in index.above(np.sort(held[start[k] : stop[k]]), np.flatnonzero(bounds[k] >= THRESHOLD - 1e-4), THRESHOLD - 1e-9):
                question, answer = index.verified(item, words[begin[p] : end[p]])
                if question >= QUESTION_OVERLAP and answer >= ANSWER_OVERLAP:
                    key = int(doc[p]), item
                    best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (score, question, answer))
    for (d, item), found in best.items():
        yield d, item, *found


def index_of(items: DataFrame, part_bytes: int = PART_BYTES) -> Totals:
    """Builds the index in the shared folder; ``items`` gets a column ``number`` and has item_id and text."""
    folder = new_path(items.sparkSession, "benchmark-index")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(_words_of(t), return_counts=True) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array([int(n.sum()) for _, n in found], pa.int64()), pa.array([x.view(np.int64) for x, _ in found], pa.list_(pa.int64())), pa.array([n for _, n in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["number", "text", "words", "terms", "times"])

    rows = stored(items.select("number", "text").mapInArrow(measure, "number long, text string, words long, terms array<long>, times array<long>").filter("words > 0"), "benchmark-words")
    facts = rows.agg(F.count("*"), F.sum("words"), F.max("words"), F.sum(F.octet_length("text"))).first()
    if not facts[0]:
        return Totals(0, 1.0, 0)
    totals = Totals(facts[0], facts[1] / facts[0], facts[2])
    parts = max(1, -(-facts[3] // part_bytes))
    one = rows.select("number", F.explode(F.arrays_zip("terms", "times")).alias("x")).select("number", "x.terms", "x.times")
    held = one.groupBy("terms").agg(F.count("*").alias("held"))
    lists = one.join(held, "terms").groupBy("number").agg(F.array_sort(F.collect_list(F.struct("terms", "times", "held"))).alias("x"))  # one item's words, no more than its text
    dealt = rows.select("number", "text").join(lists, "number").select("number", "text", F.col("x.terms").alias("terms"), F.col("x.times").alias("times"), F.col("x.held").alias("held"), F.pmod(F.xxhash64("number"), F.lit(parts)).cast("int").alias("part"))

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("number")
        part, column = group.column("part")[0].as_py(), lambda name: [np.array(x, np.int64) for x in group.column(name).to_pylist()]
        terms = [x.view(np.uint64) for x in column("terms")]
        order = [np.argsort(x) for x in terms]
        sort = lambda lists: [x[o] for x, o in zip(lists, order, strict=True)]
        arrays = indexed(group.column("number").to_numpy(), group.column("text").to_pylist(), sort(terms), sort(column("times")), sort(column("held")), totals)
        for name, values in arrays.items():
            Store(folder).write(f"{name}-{part}", values)
        return pa.table({"part": pa.array([part], pa.int32())})

    built = dealt.groupBy("part").applyInArrow(build, "part int").collect()
    return Totals(totals.items, totals.mean, totals.longest, folder, tuple(sorted(r["part"] for r in built)))


def _numbered(items: DataFrame) -> DataFrame:
    """item_id, text and number of distinct items with a text; written, so that numbers stay."""
    return stored(items.filter("text is not null").select("item_id", "text").distinct().withColumn("number", F.monotonically_increasing_id()), "benchmark-items")


def _matched(totals: Totals, text: pa.Array) -> Iterator[tuple[int, int, float, float, float]]:
    """(row, item's number, score, question overlap, answer overlap) of a column of texts."""
    if totals.parts:
        for at, _, data, offsets in chunks(pc.utf8_lower(text)):
            words, first = word_hashes(data, offsets, _PARTS)
            for part in totals.parts:
                index = _mapped(totals.folder, part, totals.longest)
                for row, item, *rest in _matches(index, words, first):
                    yield at + row, int(index.items[item]), *rest


def contaminated(docs: DataFrame, items: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: documents that hold a test item."""
    numbered = _numbered(items)
    totals = index_of(numbered, part_bytes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if rows := list(_matched(totals, batch.column(1))):
                which, item, *rest = zip(*rows, strict=True)
                columns = [batch.column(0).take(pa.array(which)), pa.array(item, pa.int64()), *(pa.array(x, pa.float64()) for x in rest)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "number", "score", "question_overlap", "answer_overlap"])

    found = docs.select("doc_id", "text").mapInArrow(search, f"doc_id {dict(docs.dtypes)['doc_id']}, number long, score double, question_overlap double, answer_overlap double")
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("x")
    named = found.join(numbered.select("number", "item_id"), "number")
    return named.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.*")


def clean_documents(docs: DataFrame, items: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no test item; a filter of one scan, without a shuffle."""
    text = docs.columns.index("text")
    totals = index_of(_numbered(items), part_bytes)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[row for row, *_ in _matched(totals, batch.column(text))]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
