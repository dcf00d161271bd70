"""LM scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by workers.

Words are numbered by their place among the sorted hashes of the training
vocabulary; a bigram's key is its context's place in its shard, then the word's
number, in 64 bits (where they don't fit, words are counted again in twice as
many shards).  Counting goes in shards, one for each 24 MB of text:

* each task counts its documents' words (then bigrams) in sorted arrays and
  sends one binary row to each shard; a shard merges its rows and writes sorted
  arrays to the shared folder, under a name of its own and then renamed, so that
  a task that runs again leaves the same files;
* a bigram's shard is that of its context, but a context with more than
  1/``HOT`` of all tokens is dealt over all shards by its whole key; what shards
  know in part (continuation counts of words, totals of such contexts) is summed
  by the shard of the word.  A row goes only where there is something to send.

Workers map the arrays and search them with a batch's sorted distinct keys, shard
by shard, with at most ``MAPPED`` arrays mapped at a time.  No task holds more
than a shard, a batch and the pages it touches; only totals, shard sizes and the
few hot contexts reach the driver.

With n1..n4 the counts of counts, Y = n1 / (n1 + 2 n2), D1 = 1 - 2 Y n2 / n1,
D2 = 2 - 3 Y n3 / n2 and D3 = 3 - 4 Y n4 / n3 (clipped to lie above 0 and
below the count),

  p(w | v) = max(c(v w) - D(c(v w)), 0) / c(v) + gamma(v) p(w)
  p(w)     = max(N(w) - D(N(w)), 0) / N + gamma / (V + 1)

where N(w) counts the distinct contexts of w.  The (V + 1)-th word is any that
training lacks.  A context that training lacks has gamma 1.

Defined results: null and empty texts are the end token alone; repeated rows
count each time; with nothing to learn from, each token has probability 1;
an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.llm.common import new_path, table
from lakeshed.llm.language_id import is_held_out
from lakeshed.llm.store import Store
from lakeshed.llm.words import hashed_words, mix

#: The end token's hash; no word of a text has it but by a chance of 2**-64.
END = 0x5F3759DF5F3759DF
#: Words' bytes of text for each shard; shards are a power of two.
SHARD_BYTES = 24 << 20
LEAST_SHARDS = 8
HOT = 200
#: Bits of a bigram's key: a context's place in its shard, then a word's number.
KEY_BITS = 64
#: Arrays that a worker maps at a time; each holds a file open.
MAPPED = 512
#: Counts from here on lie in a list of their own, those below in 32 bits.
MANY = (1 << 32) - 1
#: Pairs that a counting task gathers before it merges them.
GATHER = 4_000_000
COUNTS = "shard int, keys binary, counts binary"
_U = np.uint64


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    if not len(key):
        return key, count
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[start], np.add.reduceat(count, start)


def _blobs(group: pa.Table, name: str, dtype: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype) for x in group.column(name)]


def _rows(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """One binary row for each shard, by which the keys are sorted."""
    parts = list(_by_shard(shard))
    columns = (pa.array([k for k, _ in parts], pa.int32()), pa.array([keys[at].tobytes() for _, at in parts], pa.binary()), pa.array([counts[at].tobytes() for _, at in parts], pa.binary()))
    return pa.RecordBatch.from_arrays(list(columns), ["shard", "keys", "counts"])


def _distinct(shard: np.ndarray, key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of each shard, sorted, and their summed counts."""
    order = np.lexsort((key, shard))
    shard, key, count = shard[order], key[order], count[order]
    if not len(key):
        return shard, key, count
    start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (shard[1:] != shard[:-1])]))
    return shard[start], key[start], np.add.reduceat(count, start)


class _Gathered:
    """Counts of shards' keys, merged whenever GATHER of them have come together; given out when they get many."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = self.settled = 0

    def add(self, shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> bool:
        """Whether it is time to give out what is held."""
        self.parts.append((shard.astype(np.int32), keys, counts.astype(np.uint32)))
        self.held += len(keys)
        if self.held < self.settled + GATHER:
            return False
        self.settle()
        return self.settled >= GATHER

    def settle(self) -> None:
        if self.parts:
            self.parts = [_distinct(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))]
            self.held = self.settled = len(self.parts[0][1])

    def rows(self) -> pa.RecordBatch:
        """All that is held, a binary row for each shard that it has keys of."""
        self.settle()
        shard, keys, counts = self.parts[0] if self.parts else (np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        self.__init__()
        return _rows(shard, keys, counts.astype(np.uint32))


def _tokens(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's words with an end token after each document, and where documents begin (one more at the end)."""
    begin = first + np.arange(len(first))
    out = np.full(begin[-1], _U(END))
    inside = np.ones(len(out), bool)
    inside[begin[1:] - 1] = False
    out[inside] = words
    return out, begin


@lru_cache(maxsize=MAPPED)
def _array(folder: str, name: str, dtype: type) -> np.ndarray:
    """An array of the store, mapped; empty where no task had anything to write."""
    store = Store(folder)
    return store.read(name, dtype) if store.has(name) else np.zeros(0, dtype)


@dataclass(frozen=True)
class Keys:
    """How words are numbered and bigrams put in keys.

    ``fullest`` is the number of words of the fullest shard: places from there on
    stand for the contexts in ``hot``, which all shards share.
    """

    folder: str
    shards: int
    vocabulary: int
    fullest: int
    hot: tuple[int, ...]

    @property
    def shift(self) -> np.uint64:
        """Bits of a word's number; the vocabulary's size stands for words that training lacks."""
        return _U(self.vocabulary.bit_length())

    @property
    def fits(self) -> bool:
        return self.vocabulary.bit_length() + (self.fullest + HOT).bit_length() <= KEY_BITS

    @property
    def offsets(self) -> np.ndarray:
        """The number of each shard's first word, and the vocabulary's size."""
        return _array(self.folder, "offsets", np.uint64)

    def of(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard and key of bigrams; the shard is ``shards`` where training lacks the context."""
        offsets, hot = self.offsets, np.array(self.hot, np.uint64)
        shard = np.searchsorted(offsets[1:], context, "right").astype(np.int64)
        place = context - offsets[np.minimum(shard, self.shards - 1)]
        if len(hot):
            at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
            spread = hot[at] == context
            place[spread] = _U(self.fullest) + at[spread].astype(np.uint64)
            shard[spread] = (mix(place[spread] << self.shift | word[spread]) % _U(self.shards)).astype(np.int64)
        return shard, place << self.shift | word

    def apart(self, shard: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of context and word of a shard's keys."""
        place, word = keys >> self.shift, keys & ((_U(1) << self.shift) - _U(1))
        context = place + self.offsets[shard]
        shared = place >= _U(self.fullest)
        if len(self.hot):
            context[shared] = np.array(self.hot, np.uint64)[(place[shared] - _U(self.fullest)).astype(np.int64)]
        return context, word


@dataclass(frozen=True)
class Model:
    """What workers need besides the arrays in ``folder``."""

    folder: str
    keys: Keys
    tokens: int
    discounts: tuple[float, float, float]
    low_discounts: tuple[float, float, float]
    contexts: int
    low_gamma: float

    @property
    def vocabulary(self) -> int:
        return self.keys.vocabulary


def _discounts(n: list[float]) -> tuple[float, float, float]:
    """D1, D2, D3+ from n1..n4, above zero so that no probability is; where no count is of the kind, half of it."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [k - (k + 1) * y * b / a if a else k / 2 for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
    return tuple(min(max(d, 0.01), k - 0.01) for k, d in enumerate(raw, 1))


def _discounted(count: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *discounts])[np.minimum(count, 3).astype(np.int64)]


def _numbers(words: np.ndarray, keys: Keys) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the distinct words, and which of them each word is.

    A number is found in the sorted hashes of the shard that the hash's top bits name; others get the vocabulary's size.
    """
    names, back = np.unique(words, return_inverse=True)
    out = np.full(len(names), keys.vocabulary, np.uint64)
    for k, at_names in _by_shard(names >> _U(64 - int(np.log2(keys.shards)))):
        part, have = names[at_names], _array(keys.folder, f"words-{k}", np.uint64)
        if len(have):
            at = np.minimum(np.searchsorted(have, part), len(have) - 1)
            ok = have[at] == part
            out[at_names][ok] = at[ok].astype(np.uint64) + keys.offsets[k]
    return out, back


def _pairs(which: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Context and word of each token in one number, by their places among the chunk's distinct words; a document's first context is its end token."""
    context = np.empty_like(which)
    context[1:] = which[:-1]
    context[begin[:-1]] = which[begin[1:] - 1]
    return context << 32 | which


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Slices of rows sorted by shard."""
    which, start = np.unique(shard, return_index=True)
    for k, a, b in zip(which.tolist(), start, np.append(start, len(shard))[1:], strict=True):
        yield k, slice(a, b)


def _counted_words(docs: DataFrame, shards: int) -> tuple[Keys, int]:
    """Counts words, numbers them; with the number of all tokens."""
    folder = new_path(docs.sparkSession, "kneser-ney")
    shift = _U(64 - int(np.log2(shards)))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Gathered()
        for batch in batches:
            for _, _, words, first in hashed_words(batch.column(0)):
                said, counts = np.unique(_tokens(words, first)[0], return_counts=True)
                if held.add(said >> shift, said, counts):
                    yield held.rows()
        yield held.rows()

    def merge_words(group: pa.Table) -> pa.Table:
        keys, counts = _merged(_blobs(group, "keys", np.uint64), [x.astype(np.int64) for x in _blobs(group, "counts", np.uint32)])
        shard = group.column("shard")[0].as_py()
        store = Store(folder)
        store.write(f"words-{shard}", keys)
        store.write(f"counts-{shard}", counts)
        often = counts * HOT > counts.sum()  # at least all that are hot overall
        return pa.table({"shard": pa.array([shard], pa.int32()), "words": [len(keys)], "tokens": [int(counts.sum())], "often": pa.array([np.flatnonzero(often).tolist()], pa.list_(pa.int64())), "often_counts": pa.array([counts[often].tolist()], pa.list_(pa.int64()))})

    facts = docs.select("text").mapInArrow(count_words, COUNTS).repartition(4 * shards, "shard").groupBy("shard").applyInArrow(merge_words, "shard int, words long, tokens long, often array<long>, often_counts array<long>").collect()
    sizes = np.zeros(shards, np.uint64)
    for r in facts:
        sizes[r["shard"]] = r["words"]
    offsets = np.concatenate([np.zeros(1, np.uint64), np.cumsum(sizes, dtype=np.uint64)])
    Store(folder).write("offsets", offsets)
    tokens = sum(r["tokens"] for r in facts)
    hot = tuple(sorted(int(offsets[r["shard"]]) + i for r in facts for i, n in zip(r["often"], r["often_counts"], strict=True) if n * HOT > tokens))
    return Keys(folder, shards, int(offsets[-1]), int(sizes.max()), hot), tokens


def trained(docs: DataFrame) -> Model:
    """Counts all of ``docs`` and leaves the model's arrays in the shared folder."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = LEAST_SHARDS
    while shards * SHARD_BYTES < size:
        shards *= 2
    numbered, tokens = _counted_words(docs, shards)
    while not numbered.fits:
        shards *= 2
        numbered, tokens = _counted_words(docs, shards)
    folder = numbered.folder
    if not tokens:
        return Model(folder, numbered, 0, (0.0,) * 3, (0.0,) * 3, 0, 1.0)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Gathered()
        for batch in batches:
            for _, _, found, first in hashed_words(batch.column(0)):
                said, begin = _tokens(found, first)
                numbers, which = _numbers(said, numbered)
                pairs, counts = np.unique(_pairs(which, begin), return_counts=True)
                if held.add(*numbered.of(numbers[pairs >> 32], numbers[pairs & 0xFFFFFFFF]), counts):
                    yield held.rows()
        yield held.rows()

    def merge_pairs(group: pa.Table) -> pa.Table:
        """Writes the shard's bigrams; sends on, by the shard of the word, contexts of words and what contexts have followed by."""
        keys, counts = _merged(_blobs(group, "keys", np.uint64), [x.astype(np.int64) for x in _blobs(group, "counts", np.uint32)])
        shard, store = group.column("shard")[0].as_py(), Store(folder)
        many = np.flatnonzero(counts >= MANY)
        store.write(f"pairs-{shard}", keys)
        store.write(f"pair-counts-{shard}", np.minimum(counts, MANY).astype(np.uint32))
        store.write(f"pairs-of-many-{shard}", np.concatenate([many, counts[many]]))
        offsets = numbered.offsets
        of_context, of_word = numbered.apart(shard, keys)
        word, before = np.unique(of_word, return_counts=True)
        start = np.flatnonzero(np.concatenate([[True], of_context[1:] != of_context[:-1]]))
        kinds = np.stack([np.add.reduceat((counts == c) if c < 3 else (counts >= 3), start).astype(np.uint32) for c in (1, 2, 3)])
        order = np.argsort(of_context[start])
        context, kinds = of_context[start][order], kinds[:, order]
        words = dict(_by_shard(np.searchsorted(offsets[1:], word, "right")))
        contexts = dict(_by_shard(np.searchsorted(offsets[1:], context, "right")))
        none, columns = slice(0, 0), {k: [] for k in ("shard", "word", "before", "context", "kinds", "tally")}
        for k in sorted(words.keys() | contexts.keys()):
            own, led = words.get(k, none), contexts.get(k, none)
            columns["shard"].append(k)
            columns["word"].append((word[own] - offsets[k]).astype(np.uint32).tobytes())
            columns["before"].append(before[own].astype(np.uint32).tobytes())
            columns["context"].append((context[led] - offsets[k]).astype(np.uint32).tobytes())
            columns["kinds"].append(kinds[:, led].tobytes())
            columns["tally"].append([0] * 4 if len(columns["tally"]) else [int((counts == c).sum()) for c in (1, 2, 3, 4)])
        schema = pa.schema([("shard", pa.int32()), ("word", pa.binary()), ("before", pa.binary()), ("context", pa.binary()), ("kinds", pa.binary()), ("tally", pa.list_(pa.int64()))])
        return pa.table(columns, schema=schema)

    def merge_words_again(group: pa.Table) -> pa.Table:
        """For the shard's words: N(w), and as contexts how many words follow them once, twice, more often."""
        shard, store = group.column("shard")[0].as_py(), Store(folder)
        n = int(numbered.offsets[shard + 1] - numbered.offsets[shard])
        before, kinds = np.zeros(n, np.int64), np.zeros((3, n), np.int64)
        for word, count in zip(_blobs(group, "word", np.uint32), _blobs(group, "before", np.uint32), strict=True):
            before[word] += count
        for context, three in zip(_blobs(group, "context", np.uint32), _blobs(group, "kinds", np.uint32), strict=True):
            kinds[:, context] += three.reshape(3, -1)
        store.write(f"before-{shard}", before)
        store.write(f"kinds-{shard}", kinds)
        tally = np.array(group.column("tally").to_pylist(), np.int64).sum(0).tolist()
        own = [int((before == c).sum()) for c in (1, 2, 3, 4)] + [int((before >= 3).sum())]
        return pa.table({"shard": pa.array([shard], pa.int32()), "tally": [tally], "own": [own], "pairs": [int(before.sum())]})

    pairs = docs.select("text").mapInArrow(count_pairs, COUNTS).repartition(4 * shards, "shard").groupBy("shard").applyInArrow(merge_pairs, "shard int, word binary, before binary, context binary, kinds binary, tally array<long>")
    facts = pairs.groupBy("shard").applyInArrow(merge_words_again, "shard int, tally array<long>, own array<long>, pairs long").collect()
    lacks = set(np.flatnonzero(np.diff(numbered.offsets.astype(np.int64))).tolist()) - {r["shard"] for r in facts}
    if lacks:
        raise RuntimeError(f"shards without counts: {sorted(lacks)}")
    tally, own = (np.array([r[k] for r in facts], np.int64).sum(0).tolist() for k in ("tally", "own"))
    contexts = sum(r["pairs"] for r in facts)
    low = _discounts(own[:4])
    low_gamma = (low[0] * own[0] + low[1] * own[1] + low[2] * own[4]) / contexts
    return Model(folder, numbered, tokens, _discounts(tally), low, contexts, low_gamma)


class _Mapped:
    """Searches in the model's arrays, which are mapped as they are needed."""

    def __init__(self, model: Model):
        self.model = model

    def _read(self, name: str, shard: int, dtype: type) -> np.ndarray:
        return _array(self.model.folder, f"{name}-{shard}", dtype)

    def _known(self, names: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Shard, positions and places in the shard of word numbers; those that training lacks are left out."""
        offsets = self.model.keys.offsets
        known = np.flatnonzero(names < _U(self.model.vocabulary))  # in the order of their hashes, which is that of numbers
        for k, part in _by_shard(np.searchsorted(offsets[1:], names[known], "right")):
            yield k, known[part], (names[known[part]] - offsets[k]).astype(np.int64)

    def seen(self, names: np.ndarray) -> np.ndarray:
        out = np.zeros(len(names), np.int64)
        for k, part, at in self._known(names):
            out[part] = self._read("counts", k, np.int64)[at]
        return out

    def low(self, names: np.ndarray) -> np.ndarray:
        """p(w) for numbers of distinct words in the order of their hashes."""
        m, n = self.model, np.zeros(len(names), np.int64)
        for k, part, at in self._known(names):
            n[part] = self._read("before", k, np.int64)[at]
        return np.maximum(n - _discounted(n, m.low_discounts), 0) / m.contexts + m.low_gamma / (m.vocabulary + 1)

    def context(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """c(v) and gamma(v) for numbers of distinct words in the order of their hashes; 1 and 1 for those that training lacks."""
        total, gamma = np.ones(len(names)), np.ones(len(names))
        for k, part, at in self._known(names):
            total[part] = self._read("counts", k, np.int64)[at]
            gamma[part] = np.array(self.model.discounts) @ self._read("kinds", k, np.int64).reshape(3, -1)[:, at] / total[part]
        return total, gamma

    def pair(self, shard: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """c(v w) of bigrams' keys in their shards."""
        out, order = np.zeros(len(keys), np.int64), np.lexsort((keys, shard))
        for k, at_shard in _by_shard(shard[order]):
            part = order[at_shard]
            have = self._read("pairs", k, np.uint64) if k < self.model.keys.shards else ()
            if len(have):
                at = np.minimum(np.searchsorted(have, keys[part]), len(have) - 1)
                count, (place, exact) = self._read("pair-counts", k, np.uint32)[at].astype(np.int64), self._read("pairs-of-many", k, np.int64).reshape(2, -1)
                if len(place):
                    count[np.isin(at, place)] = exact[np.searchsorted(place, at[np.isin(at, place)])]
                out[part] = np.where(have[at] == keys[part], count, 0)
        return out


@lru_cache(maxsize=1)
def _mapped(model: Model) -> _Mapped:
    return _Mapped(model)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score (add-one unigrams), score (the model), perplexity: log10, whole texts and their end token."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, words, first in hashed_words(batch.column(1)):
                said, begin = _tokens(words, first)
                size = np.diff(begin)
                if not model.tokens:
                    zero = np.zeros(end - at)
                    columns = (size, zero.astype(np.int64), zero, zero, zero + 1)
                else:
                    m = _mapped(model)
                    numbers, back = _numbers(said, model.keys)
                    seen = m.seen(numbers)
                    base = np.log10((seen + 1) / (model.tokens + model.vocabulary + 1))[back]
                    pairs, of = np.unique(_pairs(back, begin), return_inverse=True)
                    before, word = pairs >> 32, pairs & 0xFFFFFFFF
                    total, gamma = m.context(numbers)
                    count = m.pair(*model.keys.of(numbers[before], numbers[word]))
                    p = np.maximum(count - _discounted(count, model.discounts), 0) / total[before] + gamma[before] * m.low(numbers)[word]
                    full = np.add.reduceat(np.log10(p)[of], begin[:-1])
                    columns = (size, np.add.reduceat((seen > 0)[back].astype(np.int64), begin[:-1]), np.add.reduceat(base, begin[:-1]), full, 10 ** (-full / size))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:end], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, n_known long, base_score double, score double, perplexity double")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = is_held_out(F.col("doc_id"), 7, 2)
    model = trained(docs.filter(~held_out))
    out = scored(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
