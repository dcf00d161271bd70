"""Words of Arrow string columns as numpy arrays of 64-bit hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D; only A-Z are
lower-cased.  All functions take whole texts; null counts as the empty text.
Work is done on runs of documents of about ``CHUNK_BYTES``; a longer document is
cut between words, and a longer word is summed up in parts, so that memory
beyond the text and its hashes is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and each row's offsets into them; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole documents."""
    data, offsets = raw_bytes(column)
    at, rows = 0, len(offsets) - 1
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each document the index of its first word (one more at the end)."""
    inside = np.empty(len(data) + 1, bool)
    np.logical_not(separator[data], out=inside[:-1])
    inside[-1] = False
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    starts = inside & ~before
    starts[cut] = inside[cut]
    ends = before & ~inside
    ends[offsets[1:-1]] |= before[offsets[1:-1]]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return starts, ends, np.searchsorted(starts, offsets)


def _hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_bounds(data, offsets, separator)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[LOWER[data]] * _power(_BASE, len(data)), out=total[1:])
    words = (total[ends] - total[starts]) * _power(_BASE_INVERSE, len(data))[starts]
    return mix(words + (ends - starts).astype(np.uint64)), first


def _one_word(word: np.ndarray) -> np.ndarray:
    """The hash of a word of any length."""
    total, mask = 0, (1 << 64) - 1
    for at in range(0, len(word), CHUNK_BYTES):
        part = word[at : at + CHUNK_BYTES]
        part = int(np.sum(_BYTE_CODE[LOWER[part]] * _power(_BASE, len(part)), dtype=np.uint64))
        total = (total + part * pow(_BASE, at, 1 << 64)) & mask
    return mix(np.array([(total + len(word)) & mask], np.uint64))


def stretches(data: np.ndarray, separator: np.ndarray) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whether it is one long word) of parts of a text of about CHUNK_BYTES, cut after separators alone."""
    at = 0
    while at < len(data):
        end, long = min(len(data), at + CHUNK_BYTES), False
        if end < len(data):
            gaps = np.flatnonzero(separator[data[at:end]])
            long = not len(gaps)
            end = end if long else at + int(gaps[-1]) + 1
            while long and end < len(data) and not separator[data[end]]:
                gaps = np.flatnonzero(separator[data[end : end + CHUNK_BYTES]])
                end = end + int(gaps[0]) if len(gaps) else min(len(data), end + CHUNK_BYTES)
        yield at, end, long
        at = end


def _long_text(data: np.ndarray, separator: np.ndarray) -> np.ndarray:
    """The hashes of one text's words, a stretch at a time."""
    out = [_one_word(data[a:b]) if long else _hashes(data[a:b], np.array([0, b - a]), separator)[0] for a, b, long in stretches(data, separator)]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and for each document the index of its first word (one more at the end)."""
    if len(data) <= 2 * CHUNK_BYTES:
        return _hashes(data, offsets, separator)
    parts = [_long_text(data[a:b], separator) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


def hashed_words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, index of each document's first word) by chunk."""
    for at, end, data, offsets in chunks(column):
        yield at, end, *word_hashes(data, offsets)


def one_hash(word: bytes) -> int:
    """The hash that ``word_hashes`` gives this word."""
    return int(_one_word(np.frombuffer(word, np.uint8))[0])


def runs_of(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words, in order."""
    runs = np.full(max(0, len(words) - width + 1), _U(width))
    for k in range(width):
        runs = (runs ^ words[k : len(words) - width + 1 + k]) * _U(0xD6E8FEB86659FD93)
        runs ^= runs >> _U(32)
    return mix(runs)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of a document's runs of ``size`` words; of the whole if it has fewer; none if it has none."""
    return np.unique(runs_of(words, min(size, len(words)))) if len(words) else np.zeros(0, np.uint64)
