"""Telephony audio in media columns: mu-law and A-law by lookup table, IMA ADPCM block-wise, resampled to PCM.

A media value is a WAV file of one channel at 8 kHz.  mu-law and A-law hold one
8-bit sample a byte; ADPCM holds 64-byte blocks (a 4-byte header with the first
sample and the step index, then two samples a byte).  Blocks are independent, so
they are decoded side by side: one numpy step for each of a block's 121 samples,
over all blocks of a batch.  Long files are decoded, resampled and measured in
windows, so that memory follows what is stored of them.

Defined results: a text whose PCM would pass 2 GB (280 MB and more) is beyond one
value and raises; a null text counts as the empty text; equal texts give equal
values; repeated rows give repeated results; an empty table gives no rows; other
columns are left out.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakeshed.llm.common import table

RATE, STORED_RATE = 8_000, 16_000
BLOCK = 64
#: WAV format tags.
FORMATS = {"pcm": 1, "alaw": 6, "mulaw": 7, "ima_adpcm": 17}
CODECS = ("mulaw", "alaw", "ima_adpcm")
#: Bytes decoded at once.
STEP_BYTES = 4 << 20

#: IMA ADPCM.
_STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066,
    2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
_INDEX_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def _mulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = ((((code & 0x0F) << 3) + 0x84) << ((code >> 4) & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    part, low = (code >> 4) & 7, (code & 0x0F) << 4
    size = np.where(part == 0, low + 8, (low + 0x108) << np.maximum(part - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


LAWS = {"mulaw": _mulaw_table(), "alaw": _alaw_table()}


def decode_adpcm(data: np.ndarray) -> np.ndarray:
    """Samples (one row for each 64-byte block) of IMA ADPCM blocks."""
    blocks = data.reshape(-1, BLOCK)
    value = blocks[:, 0].astype(np.int32) | (blocks[:, 1].astype(np.int8).astype(np.int32) << 8)
    index = np.minimum(blocks[:, 2].astype(np.int32), len(_STEPS) - 1)
    codes = np.empty((2 * (BLOCK - 4), len(blocks)), np.uint8)
    codes[0::2], codes[1::2] = (blocks[:, 4:] & 0x0F).T, (blocks[:, 4:] >> 4).T
    out = np.empty((1 + len(codes), len(blocks)), np.int16)
    out[0] = value
    # The change for each step and code, and the next step's index, as tables.
    sizes = np.arange(8, dtype=np.int32)
    change = (_STEPS[:, None] >> 3) + np.where(sizes & 4, _STEPS[:, None], 0) + np.where(sizes & 2, _STEPS[:, None] >> 1, 0) + np.where(sizes & 1, _STEPS[:, None] >> 2, 0)
    change = np.concatenate([change, -change], axis=1).ravel()
    moved = np.clip(np.arange(len(_STEPS))[:, None] + np.tile(_INDEX_MOVES, 2), 0, len(_STEPS) - 1).astype(np.int32).ravel()
    for k, code in enumerate(codes):
        at = index * 16 + code
        value += change[at]
        np.clip(value, -32768, 32767, out=value)
        index = moved[at]
        out[k + 1] = value
    return out.T


def wav(codec: str, data: bytes, rate: int = RATE) -> bytes:
    """A WAV file of one channel around the codec's bytes."""
    if codec == "pcm":
        form = struct.pack("<HHIIHH", FORMATS[codec], 1, rate, rate * 2, 2, 16)
    elif codec == "ima_adpcm":
        form = struct.pack("<HHIIHHHH", FORMATS[codec], 1, rate, rate * BLOCK // 121, BLOCK, 4, 2, 121)
    else:
        form = struct.pack("<HHIIHHH", FORMATS[codec], 1, rate, rate, 1, 8, 0)
    body = b"WAVE" + b"fmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> tuple[str, int, bytes]:
    """(codec, rate, data) of a WAV file; raises ValueError for what isn't one."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, codec, rate = 12, "", 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        if name == b"fmt ":
            tag, _, rate = struct.unpack("<HHI", media[at + 8 : at + 16])
            codec = next((k for k, v in FORMATS.items() if v == tag), "")
        elif name == b"data":
            if not codec:
                raise ValueError("unknown format")
            return codec, rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data")


def resample(pcm: np.ndarray, rate: int = RATE, to: int = STORED_RATE, then: int | None = None) -> np.ndarray:
    """Linear resampling to a multiple of the rate, in whole numbers, towards the sample ``then`` after the last; without one the last is held."""
    times = to // rate
    if times * rate != to:
        raise ValueError("only whole multiples of the rate")
    wide = pcm.astype(np.int32)
    after = np.concatenate([wide[1:], wide[-1:] if then is None else np.array([then], np.int32)])
    out = np.empty(len(wide) * times, np.int16)
    for k in range(times):
        out[k::times] = (wide * (times - k) + after * k) // times
    return out


def _windows(codec: str, data: bytes) -> Iterator[np.ndarray]:
    """8 kHz PCM of STEP_BYTES of the codec's bytes at a time."""
    for at in range(0, len(data), STEP_BYTES):
        part = np.frombuffer(data, np.uint8, min(STEP_BYTES, len(data) - at), at)
        yield decode_adpcm(part).ravel() if codec == "ima_adpcm" else part.view(np.int16) if codec == "pcm" else LAWS[codec][part]


def long_pcm(media: bytes, rate: int = STORED_RATE) -> bytes:
    """What ``decode_all`` and ``resample`` give, for one long file in windows."""
    codec, _, data = read_wav(media)
    out, held = bytearray(), None
    for part in _windows(codec, data):
        if held is not None:
            out += resample(held, RATE, rate, int(part[0])).tobytes()
        held = part
    if held is not None:
        out += resample(held, RATE, rate).tobytes()
    return wav("pcm", out, rate)


def decode_all(media: list[bytes]) -> list[tuple[bytes, np.ndarray]]:
    """(data, 8 kHz PCM) of each WAV file; the ADPCM blocks of all of them are decoded together, some megabytes at a time."""
    out: list = []
    waiting: list[tuple[int, bytes]] = []

    def flush() -> None:
        if waiting:
            samples = decode_adpcm(np.frombuffer(b"".join(data for _, data in waiting), np.uint8))
            at = 0
            for i, data in waiting:
                out[i] = data, samples[at : at + len(data) // BLOCK].ravel()
                at += len(data) // BLOCK
            waiting.clear()

    held = 0
    for one in media:
        codec, _, data = read_wav(one)
        if codec == "ima_adpcm":
            waiting.append((len(out), data))
            out.append(None)
            held += len(data)
            if held >= STEP_BYTES:
                flush()
                held = 0
        elif codec == "pcm":
            out.append((data, np.frombuffer(data, np.int16)))
        else:
            out.append((data, LAWS[codec][np.frombuffer(data, np.uint8)]))
    flush()
    return out


def _encoded(batches: Iterator[pa.RecordBatch], codec: str | None) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) as (doc_id, n_bytes, media)."""
    for batch in batches:
        ids, texts = batch.columns
        for at, end in _runs(texts):
            files, sizes = [], []
            for x in texts[at:end].to_pylist():
                data = (x or "").encode()
                sizes.append(len(data))
                data += b"\0" * (max(BLOCK, -len(data) % BLOCK + len(data)) - len(data))
                files.append(wav(codec or CODECS[zlib.crc32(data) % len(CODECS)], data))
            yield pa.RecordBatch.from_arrays([ids[at:end], pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], ["doc_id", "n_bytes", "media"])


def with_media(docs: DataFrame, codec: str | None = None) -> DataFrame:
    """doc_id, n_bytes, media: each text's bytes, zeros up to a positive multiple of 64, as a WAV file.

    Without ``codec`` the payload's CRC chooses among mu-law, A-law and ADPCM, as
    a collection of calls mixes them.
    """
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _encoded(batches, codec), f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, media binary")


def _runs(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, end) rows of about STEP_BYTES."""
    at, held = 0, 0
    for i, x in enumerate(column):
        held += x.as_buffer().size if x.is_valid else 0
        if held >= STEP_BYTES:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(column):
        yield at, len(column)


def _decoded(batches: Iterator[pa.RecordBatch], rate: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_bytes, media) with codec and pcm."""
    for batch in batches:
        for at, end in _runs(batch.column(2)):
            files = batch.column(2)[at:end].to_pylist()
            together = iter(decode_all([x for x in files if len(x) <= STEP_BYTES]))
            pcm = [wav("pcm", resample(next(together)[1], RATE, rate).tobytes(), rate) if len(x) <= STEP_BYTES else long_pcm(x, rate) for x in files]
            codecs = [read_wav(x)[0] for x in files]
            yield pa.RecordBatch.from_arrays([*(c[at:end] for c in batch.columns), pa.array(codecs, pa.string()), pa.array(pcm, pa.binary())], ["doc_id", "n_bytes", "media", "codec", "pcm"])


def with_pcm(media: DataFrame, rate: int = STORED_RATE) -> DataFrame:
    """Adds to (doc_id, n_bytes, media) the columns codec and pcm: a WAV file of the decoded audio resampled to ``rate``."""
    return media.mapInArrow(lambda batches: _decoded(batches, rate), f"doc_id {dict(media.dtypes)['doc_id']}, n_bytes long, media binary, codec string, pcm binary")


def with_media_and_pcm(docs: DataFrame, codec: str | None = None, rate: int = STORED_RATE) -> DataFrame:
    """``with_pcm`` of ``with_media``, by the same Python worker."""
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _decoded(_encoded(batches, codec), rate), f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, media binary, codec string, pcm binary")


#: Samples that features are computed of at once.
SAMPLES = 1 << 20


def features(pcm: bytes) -> str:
    """Samples, peak, crossings of zero and mean square of a stored PCM file, in windows."""
    audio = np.frombuffer(read_wav(pcm)[2], np.int16)
    peak = crossings = squares = 0
    for at in range(0, len(audio), SAMPLES):
        part = audio[max(0, at - 1) : at + SAMPLES]  # one sample of the window before, for a crossing between them
        below = part < 0
        crossings += int(np.count_nonzero(below[1:] != below[:-1]))
        wide = part[min(at, 1) :].astype(np.int64)
        peak, squares = max(peak, int(np.abs(wide).max())), squares + int(np.dot(wide, wide))
    return f"n={len(audio)};peak={peak};zc={crossings};ms={squares // max(1, len(audio))}"


def media_digest(media: DataFrame) -> DataFrame:
    """Reads the columns of ``with_pcm`` back: checksums of payload, media and PCM files, and features of the PCM."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "pcm_bytes", "pcm_sha256", "feature"]
        for batch in batches:
            for at, end in _runs(batch.column(2)):
                rows = []
                for one, pcm in zip(batch.column(2)[at:end], batch.column(4)[at:end], strict=True):
                    one, pcm = one.as_py(), pcm.as_py()
                    codec, _, data = read_wav(one)
                    rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-BLOCK:]), len(one), hashlib.sha256(one).hexdigest(), len(pcm), hashlib.sha256(pcm).hexdigest(), f"{codec};{features(pcm)}"))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:end], batch.column(1)[at:end], *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names)

    return media.mapInArrow(digest, f"doc_id {dict(media.dtypes)['doc_id']}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, pcm_bytes long, pcm_sha256 string, feature string")


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digest(with_media_and_pcm(table(spark, sf_dir, "documents")))
