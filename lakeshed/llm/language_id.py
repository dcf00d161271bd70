"""Language ID by bit-sliced Bloom filters of character n-grams.

N-grams are runs of three and four bytes of words in lower case with a space at
either end.  Training counts all of them by language.  A language has a filter
for each of ``SHARES``: it holds the n-grams with at least that share of the
language's own, the first one all that ever came.  All filters lie in one array
of bit masks, a bit for each language and share: ANDing an n-gram's rows gives
all languages that hold it, and how often it comes there.  A text's count of hits
by language, less those its filters would give by chance, decides.

The array has ``BITS_A_GRAM`` rows for each n-gram of the language with most of
them, however many they are.  Tasks set the bits of a slice each and write it to
the shared folder, from where workers map it; the driver learns how full each
filter is, nothing else.

Defined results: a null text or one without a letter is ``und`` with score 0; a
text none of whose n-grams is known gets the language with most training
documents and score 0; ties go to the language that comes first by code point;
rows without a language teach nothing; repeated rows count each time; an empty
table gives no rows; with no language learned all are ``und``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.llm.common import new_path, stored, table
from lakeshed.llm.store import Store
from lakeshed.llm.words import CHUNK_BYTES, chunks, mix, stretches

#: A language's filters: n-grams with at least this share of its own.
SHARES = (0.0, 2e-6, 3e-5, 4e-4)
LEVELS = len(SHARES)
HASHES = 3
BITS_A_GRAM = 16
#: Bytes of masks that one task sets, about.
SLICE_BYTES = 16 << 20
UNKNOWN = "und"
#: More languages than this are taken for a mistake in the column; it bounds what is broadcast and collected.
MOST_LANGUAGES = 4096
#: Score that a text needs for the pipeline to keep it.
LEAST_SCORE = 0.35
#: Texts of fewer n-grams are too short to be rejected by their score.
LEAST_GRAMS = 20

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 256)
_GAPS = _FOLD == 0x20
_U = np.uint64


def is_held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id's text leaves this remainder; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts == part


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All documents' n-grams as numbers (four-byte ones and three-byte ones apart), and each one's document."""
    rows = len(offsets) - 1
    # Each document gets a space before and after it.
    place = np.arange(len(data)) + 2 * np.repeat(np.arange(rows), np.diff(offsets)) + 1
    wide = np.full(len(data) + 2 * rows + 3, 0x20, np.uint8)
    wide[place] = _FOLD[data]
    owner = np.repeat(np.arange(rows), np.diff(offsets) + 2)
    inside = wide != 0x20
    w = wide.astype(np.uint32)
    n = len(owner)
    three = w[:n] | w[1 : n + 1] << 8 | w[2 : n + 2] << 16
    ok3 = inside[1 : n + 1] & (inside[:n] | inside[2 : n + 2])
    ok4 = inside[1 : n + 1] & inside[2 : n + 2]
    four = three | w[3 : n + 3] << 24
    found = np.concatenate([three[ok3].astype(np.uint64) | _U(1 << 40), four[ok4].astype(np.uint64)])
    return found, np.concatenate([owner[ok3], owner[ok4]])


def pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of documents; a long one comes in stretches, which no n-gram crosses."""
    for at, end, data, offsets in chunks(column):
        if len(data) <= 2 * CHUNK_BYTES:
            yield at, end, data, offsets
        else:
            for a, b, _ in stretches(data, _GAPS):
                yield at, end, data[a:b], np.array([0, b - a])


def _places(found: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """An n-gram's rows in an array of ``bits`` rows, one for each hash."""
    h, step = mix(found), mix(found ^ _U(0xA5A5A5A5A5A5A5A5)) | _U(1)
    for k in range(HASHES):
        yield ((h + _U(k) * step) & _U(bits - 1)).astype(np.int64)


@dataclass(frozen=True)
class Slices:
    """An array of masks in the shared folder, read like one in memory; slices that no n-gram falls in aren't there."""

    folder: str
    bits: int
    size: int
    width: int
    kind: str
    there: frozenset[int]

    def __len__(self) -> int:
        return self.bits

    def __getitem__(self, place: np.ndarray) -> np.ndarray:
        out = np.zeros((len(place), self.width), self.kind)
        if self.size == self.bits:
            return _mapped(self)[0][place] if 0 in self.there else out
        order = np.argsort(place, kind="stable")
        sorted_, maps = place[order], _mapped(self)
        for k in np.unique(sorted_ // self.size).tolist():
            if k in self.there:
                a, b = np.searchsorted(sorted_, (k * self.size, (k + 1) * self.size))
                out[order[a:b]] = maps[k][sorted_[a:b] - k * self.size]
        return out


@lru_cache(maxsize=2)
def _mapped(slices: Slices) -> dict[int, np.ndarray]:
    return {k: Store(slices.folder).read(f"masks-{k}", slices.kind).reshape(-1, slices.width) for k in slices.there}


@dataclass
class Filters:
    """rows[i] has bit LEVELS * k + l set if language k has set bit i of its filter l; chance[k, l] is a filter's share of false hits."""

    languages: list[str]
    most_common: int
    rows: np.ndarray | Slices
    chance: np.ndarray

    def masks(self, found: np.ndarray) -> np.ndarray:
        """Bit masks (in as many columns as it takes) of the filters that hold each n-gram."""
        out = None
        for place in _places(found, len(self.rows)):
            out = self.rows[place] if out is None else out & self.rows[place]
        return out

    def levels(self, masks: np.ndarray, language: int) -> np.ndarray:
        """A language's bits of each mask as a number below 2**LEVELS."""
        each = 8 * masks.dtype.itemsize // LEVELS
        return (masks[:, language // each] >> masks.dtype.type(LEVELS * (language % each))) & masks.dtype.type((1 << LEVELS) - 1)


def _narrow(languages: int) -> type:
    """The narrowest kind of number that holds a mask; 64 bits, in several columns, for many languages."""
    return next((t for t in (np.uint8, np.uint16, np.uint32) if languages * LEVELS <= 8 * np.dtype(t).itemsize), np.uint64)


def filled(rows: np.ndarray, languages: int) -> np.ndarray:
    """How many rows have the bit of each language and share."""
    each = 8 * rows.dtype.itemsize
    bit = lambda b: np.count_nonzero(rows[:, b // each] & rows.dtype.type(1 << b % each))
    return np.array([[bit(k * LEVELS + level) for level in range(LEVELS)] for k in range(languages)], np.int64).reshape(-1, LEVELS)


def build(languages: list[str], rows: np.ndarray, most_common: int) -> Filters:
    """Filters from an array of 64-bit masks, kept as narrow as the languages allow."""
    rows = rows.astype(_narrow(len(languages)))
    return Filters(languages, most_common, rows, (filled(rows, len(languages)) / len(rows)) ** HASHES)


def set_bits(found: np.ndarray, language: np.ndarray, level: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, mask) of the bits that n-grams set: all of a language's filters up to the level."""
    mask = ((_U(1) << (level + 1).astype(np.uint64)) - _U(1)) << (language * LEVELS % 64).astype(np.uint64)
    return np.concatenate(list(_places(found, bits))), np.tile(language * LEVELS // 64, HASHES), np.tile(mask, HASHES)


def sliced(counts: DataFrame, languages: list[str], totals: dict[str, int], bits: int) -> tuple[Slices, np.ndarray]:
    """The array of masks of (lang, gram, n) rows, and how full each filter is; tasks OR their slices together and write them."""
    number, width = {x: k for k, x in enumerate(languages)}, -(-max(1, len(languages)) * LEVELS // 64)
    kind, folder = np.dtype(_narrow(len(languages))), new_path(counts.sparkSession, "language-filters")
    size = bits
    while size > 1024 and size * width * 8 > SLICE_BYTES:
        size //= 2
    each = np.array([totals.get(x, 1) for x in languages], float)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            langs = np.array([number[x] for x in batch.column(0).to_pylist()])
            level = np.searchsorted(SHARES, batch.column(2).to_numpy() / each[langs], "right") - 1
            row, column, mask = set_bits(batch.column(1).to_numpy().view(np.uint64), langs, level, bits)
            order = np.argsort(row, kind="stable")
            row, column, mask = row[order], column[order], mask[order]
            some, first = np.unique(row // size, return_index=True)
            cuts = np.append(first, len(row))
            packed = lambda x, kind: pa.array([x[a:b].astype(kind).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), packed(row % size, np.uint32), packed(column, np.uint16), packed(mask, np.uint64)], ["slice", "row", "column", "mask"])

    def together(group: pa.Table) -> pa.Table:
        out = np.zeros((size, width), np.uint64)
        for row, column, mask in zip(*(group.column(c) for c in ("row", "column", "mask")), strict=True):
            np.bitwise_or.at(out, (np.frombuffer(row.as_buffer(), np.uint32), np.frombuffer(column.as_buffer(), np.uint16)), np.frombuffer(mask.as_buffer(), np.uint64))
        part, out = group.column("slice")[0].as_py(), out.astype(kind)
        Store(folder).write(f"masks-{part}", out)
        return pa.table({"slice": pa.array([part], pa.int64()), "full": pa.array([filled(out, len(languages)).ravel().tolist()], pa.list_(pa.int64()))})

    parts = counts.select("lang", "gram", "n").mapInArrow(deal, "slice long, row binary, column binary, mask binary").groupBy("slice").applyInArrow(together, "slice long, full array<long>")
    full, there = np.zeros(len(languages) * LEVELS, np.int64), []
    for r in parts.toLocalIterator():
        full += np.array(r["full"], np.int64)
        there.append(r["slice"])
    return Slices(folder, bits, size, width, kind.str, frozenset(there)), full.reshape(-1, LEVELS)


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n: counts over the whole texts of documents with a language, summed in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        waiting: dict[int, list] = defaultdict(list)

        def settled(k: int) -> tuple[np.ndarray, np.ndarray]:
            found, n = (np.concatenate(x) for x in zip(*waiting[k], strict=True))
            found, at = np.unique(found, return_inverse=True)
            return found, np.bincount(at, n).astype(np.int64)

        for batch in batches:
            langs = np.array([names.setdefault(x, len(names)) for x in batch.column(0).to_pylist()])
            for at, end, data, offsets in pieces(batch.column(1)):
                found, owner = grams(data, offsets)
                of = langs[at:end][owner]
                for k in np.unique(of):
                    waiting[k].append(np.unique(found[of == k], return_counts=True))
                    if len(waiting[k]) > 16:
                        waiting[k] = [settled(k)]
        for name, k in names.items():
            if waiting[k]:
                found, n = settled(k)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    return docs.filter("lang is not null").select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learned(docs: DataFrame) -> Filters:
    """Filters from all documents with a language; no n-gram is left out."""
    sizes = docs.filter("lang is not null").groupBy("lang").agg(F.count("*").alias("docs")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = [r["lang"] for r in sizes]
    counts = stored(gram_counts(docs), "grams")
    facts = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("grams")).collect()
    most = max((r["grams"] for r in facts), default=1)
    bits = 1 << 10
    while bits < most * BITS_A_GRAM:
        bits *= 2
    most_common = max(range(len(sizes)), key=lambda k: (sizes[k]["docs"], -k), default=0)
    slices, full = sliced(counts, languages, {r["lang"]: r["total"] for r in facts}, bits)
    return Filters(languages, most_common, slices, (full / bits) ** HASHES)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    def any_of(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[offsets[1:]] > total[offsets[:-1]]

    folded = _FOLD[data]
    ascii_letter, other = any_of((folded != 0x20) & (data < 0x80)), any_of(data >= 0x80)
    for i in np.flatnonzero(other & ~ascii_letter):
        ascii_letter[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return ascii_letter


def predicted(text: pa.Array, filters: Filters) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, scores and numbers of n-grams of a column of texts.

    A filter with false hits at rate c gives hits = true + c (all - true); the
    true ones are what its popcount says.  A language's score is the mean over its
    filters of their true hits' share of the text's n-grams.
    """
    rows, languages = len(text), range(len(filters.languages))
    total, letters = np.zeros(rows, np.int64), np.zeros(rows, bool)
    extra = np.zeros((rows, max(1, len(filters.languages))))
    bits = np.arange(1 << LEVELS)[:, None] >> np.arange(LEVELS) & 1
    weight = [bits @ (1 / (1 - filters.chance[k])) for k in languages]
    by_chance = [float((filters.chance[k] / (1 - filters.chance[k])).sum()) for k in languages]
    for at, end, data, offsets in pieces(text):
        found, owner = grams(data, offsets)
        letters[at:end] |= _has_letter(data, offsets)
        count = np.bincount(owner, minlength=end - at)
        total[at:end] += count
        masks = filters.masks(found)
        for k in languages:
            extra[at:end, k] += np.bincount(owner, weight[k][filters.levels(masks, k)], end - at) - count * by_chance[k]
    extra = np.maximum(extra, 0) / LEVELS
    best = np.where(extra.max(1) > 0, extra.argmax(1), filters.most_common)
    known = letters & bool(filters.languages)
    named = [filters.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
    return named, np.where(known, np.clip(extra.max(1) / np.maximum(total, 1), 0, 1), 0.0), total


def identified(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred, score (the share of the text's n-grams, less chance, that the language's filters hold, on average), n_grams."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, scores, counts = predicted(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(named, pa.string()), pa.array(scores), pa.array(counts)], ["doc_id", "lang_pred", "score", "n_grams"])

    return docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double, n_grams long")


def kept_languages(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the filters recognise; those without letters or like no language are rejected.

    Learns from the four fifths of ``docs`` that are not held out.
    """
    filters = learned(docs.filter(~is_held_out(F.col("doc_id"), 5, 0)))
    shared, text = docs.sparkSession.sparkContext.broadcast(filters), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, scores, counts = predicted(batch.column(text), shared.value)
            yield batch.filter(pa.array((np.array(named, object) != UNKNOWN) & ((scores >= LEAST_SCORE) | (counts < LEAST_GRAMS))))

    return docs.mapInArrow(keep, docs.schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identified(docs, learned(docs.filter(~is_held_out(F.col("doc_id"), 5, 0))))
    return found.select("doc_id", is_held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")
