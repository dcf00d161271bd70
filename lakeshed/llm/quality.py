"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins; cyclic boosting visits the features in turn and
fits a tree of at most four leaves on the bins, whose steps add up to a lookup
table.  The pairs that explain most of the rest get tables of their own the same
way.  A score is a sum of table entries, one gather for each feature and pair.

Learning takes at most ``SAMPLE`` labelled rows, those with the smallest hashes of
their ids; all rows are scored.  Defined results: a null text counts as the empty
text; rows with a null label teach nothing; with rows of one label only, the
score is that label's share, smoothed; repeated rows count each time; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.llm.common import stored, table
from lakeshed.llm.language_id import is_held_out
from lakeshed.llm.words import chunks, mix, word_bounds, word_hashes

#: The most labelled rows that learning reads.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 64, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.08
ACCEPT = 0.7
FEATURES = (
    "bytes", "words", "mean_word", "long_words", "short_words", "upper", "digits", "not_ascii", "pipes", "exclamations", "symbols", "full_stops", "commas",
    "other_marks", "newlines", "distinct_words", "top_word", "distinct_lines", "shouted_words", "odd_ends", "longest_word",
)
_U = np.uint64


def _flags(**sets: str) -> dict[str, np.ndarray]:
    out = {}
    for name, chars in sets.items():
        out[name] = np.zeros(256, bool)
        out[name][[ord(c) for c in chars]] = True
    return out


_SET = _flags(
    upper="ABCDEFGHIJKLMNOPQRSTUVWXYZ", digits="0123456789", pipes="|", exclamations="!", symbols="#$%&*@^~<>{}[]=+_\\/", full_stops=".", commas=",", other_marks=";:?()\"'-`", newlines="\n"
)
_NOT_ASCII = np.arange(256) >= 0x80


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each document of a chunk; shares are of bytes, words or lines."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    per = lambda n, d: n / np.maximum(d, 1)

    def count(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[offsets[1:]] - total[offsets[:-1]]

    starts, ends, first = word_bounds(data, offsets)
    words = np.diff(first)
    owner = np.repeat(np.arange(rows), words)
    length = ends - starts
    by_word = lambda flag: np.bincount(owner[flag], minlength=rows)
    upper = np.concatenate([[0], np.cumsum(_SET["upper"][data])])
    shouted = (upper[ends] - upper[starts] >= 2) & (2 * (upper[ends] - upper[starts]) > length) if len(starts) else np.zeros(0, bool)
    odd = (_SET["symbols"] | _SET["exclamations"])[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    hashes, _ = word_hashes(data, offsets)
    order = np.lexsort((hashes, owner))
    new = np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])]) if len(order) else np.zeros(0, bool)
    runs = np.diff(np.append(np.flatnonzero(new), len(order)))
    top = np.zeros(rows)
    np.maximum.at(top, owner[order][new], runs)
    # Lines, as sums of position-weighted words: equal lines have equal sums.
    line_of = np.concatenate([[0], np.cumsum(_SET["newlines"][data])])[starts] if len(starts) else np.zeros(0, np.int64)
    lines = distinct = np.zeros(rows)
    if len(starts):
        edge = np.flatnonzero(np.concatenate([[True], (line_of[1:] != line_of[:-1]) | (owner[1:] != owner[:-1])]))
        place = (np.arange(len(starts)) - np.repeat(edge, np.diff(np.append(edge, len(starts))))).astype(np.uint64)
        sums = np.add.reduceat(mix(hashes + place * _U(0x9E3779B97F4A7C15)), edge)
        line_owner = owner[edge]
        lines = np.bincount(line_owner, minlength=rows)
        again = np.lexsort((sums, line_owner))
        fresh = np.concatenate([[True], (sums[again][1:] != sums[again][:-1]) | (line_owner[again][1:] != line_owner[again][:-1])])
        distinct = np.bincount(line_owner[again][fresh], minlength=rows)
    longest = np.zeros(rows)
    np.maximum.at(longest, owner, length)
    columns = {name: per(count(flag[data]), size) for name, flag in _SET.items()}
    columns |= {
        "bytes": np.log1p(size), "words": np.log1p(words), "mean_word": per(np.bincount(owner, length, rows), words), "long_words": per(by_word(length >= 12), words), "short_words": per(by_word(length <= 3), words),
        "not_ascii": per(count(_NOT_ASCII[data]), size), "distinct_words": per(by_word_distinct(owner, order, new, rows), words), "top_word": per(top, words), "distinct_lines": per(distinct, lines),
        "shouted_words": per(by_word(shouted), words), "odd_ends": per(by_word(odd), words), "longest_word": np.log1p(longest),
    }
    return np.column_stack([columns[name] for name in FEATURES])


def by_word_distinct(owner: np.ndarray, order: np.ndarray, new: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(owner[order][new], minlength=rows)


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id, features: array of doubles from the whole text alone."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in chunks(batch.column(1)):
                found = features(data, offsets)
                lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, len(FEATURES), dtype=np.int32), found.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:end], lists], ["doc_id", "features"])

    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {dict(docs.dtypes)['doc_id']}, features array<double>")


@dataclass
class Model:
    """score = logistic(base + sum of tables[f][bin] + sum of pair tables)."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (cuts, values) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += values[np.searchsorted(cuts, x[:, f], "right")]
        if self.pairs:
            coarse = [np.searchsorted(cuts, x[:, f], "right") for f, cuts in enumerate(self.pair_cuts)]
            for (f, g), values in zip(self.pairs, self.pair_tables, strict=True):
                total += values[coarse[f], coarse[g]]
        return 1 / (1 + np.exp(-total))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins, method="nearest"))


_PENALTY, _LEAST = 1.0, 5.0


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + _PENALTY)


def _steps(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """A tree on ordered bins: cuts the range whose cut gains most until it has ``leaves``; each bin's step."""
    ranges = [(0, len(g))]
    while len(ranges) < leaves:
        best = (1e-9, None, None)
        for a, b in ranges:
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gain = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            gain = np.where((left_h * 4 >= _LEAST) & ((all_h - left_h) * 4 >= _LEAST), gain, 0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (a, b), a + k + 1)
        if best[1] is None:
            break
        ranges.remove(best[1])
        ranges += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for a, b in ranges:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + _PENALTY)
    return out


def _pair_steps(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of depth two on a grid: one cut of the first axis, then one of the second in each half."""
    best = (-1.0, None)
    for k in range(1, g.shape[0]):
        halves, gain = [], 0.0
        for part in (slice(0, k), slice(k, None)):
            steps = _steps(g[part].sum(0), h[part].sum(0), 2)
            gain += float((2 * steps * g[part].sum(0) - steps**2 * h[part].sum(0)).sum())
            halves.append((part, steps))
        if gain > best[0]:
            best = (gain, halves)
    out = np.zeros_like(g)
    for part, steps in best[1] or ():
        out[part] = steps
    return out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boosts the features in turn, then the pairs; the same rows in the same order give the same model."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    model.cuts = [_cuts(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for f, at in enumerate(bins):
            p = 1 / (1 + np.exp(-total))
            step = RATE * _steps(np.bincount(at, y - p, len(model.tables[f])), np.bincount(at, p * (1 - p), len(model.tables[f])))
            model.tables[f] += step
            total += step[at]
    model.pair_cuts = [_cuts(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(model.pair_cuts)]
    width = [len(c) + 1 for c in model.pair_cuts]

    def grid(f: int, g: int, weight: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[f] * width[g] + coarse[g], weight, width[f] * width[g]).reshape(width[f], width[g])

    p = 1 / (1 + np.exp(-total))
    explained = {(f, g): float(_gain(grid(f, g, y - p), grid(f, g, p * (1 - p))).sum()) for f, g in combinations(range(x.shape[1]), 2)}
    model.pairs = sorted(explained, key=lambda k: (-explained[k], k))[:PAIRS]
    model.pair_tables = [np.zeros((width[f], width[g])) for f, g in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (f, g) in enumerate(model.pairs):
            p = 1 / (1 + np.exp(-total))
            step = RATE * _pair_steps(grid(f, g, y - p), grid(f, g, p * (1 - p)))
            model.pair_tables[k] += step
            total += step[coarse[f], coarse[g]]
    return model


def learned(measured: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled rows of (doc_id, features)."""
    known = labels.filter(F.col(target).isNotNull()).select(F.col("doc_id").alias("_id"), F.col(target).cast("int").alias("_y"))
    rows = measured.join(known, F.col("doc_id") == F.col("_id")).select("features", "_y", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)).alias("_hash"), "doc_id")
    # The smallest hashes lie below this with room to spare, so that tasks send few rows beyond the sample.
    count = max(1, rows.count())
    rows = rows.filter(F.col("_hash") < math.ceil((1 << 20) * (1.1 * sample + 1000) / count))
    rows = rows.orderBy("_hash", "doc_id", "_y").limit(sample).toPandas()
    x = np.array(rows["features"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, rows["_y"].to_numpy(float))


def scored(measured: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for (doc_id, features)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    return measured.mapInArrow(score, f"doc_id {dict(measured.dtypes)['doc_id']}, score double")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(with_features(table(spark, sf_dir, "documents")), "features")
    held_out = is_held_out(F.col("doc_id"), 4, 2)
    model = learned(measured.filter(~held_out), table(spark, sf_dir, "labels"))
    return scored(measured, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
