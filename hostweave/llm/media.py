"""Media columns: texts stored as WAV samples and fingerprinted by spectral-peak pairs.

The UTF-8 bytes of a text, padded with zero bytes to a positive multiple of 64, become
the 8-bit mono samples of a WAV file held in a binary column. Reading goes through the
``wave`` module, block by block. Features: short-time Fourier transforms (Hann window),
the strongest bins of each frame that also top their band's neighbours in time, and
pairs of each such peak with the next few. A pair is stored as an integer code (first
bin, second bin, time between) in one array and the frame of its first peak in another.

Defined results: null text is the empty text (64 zero bytes, whose silent frames have no
peaks); a very long text takes memory in proportion to its bytes, not to its transform;
peaks of equal height in a frame go by band, lower first; equal texts have equal values;
repeated rows repeat; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostweave.llm.common import documents, map_batches, raw

RATE = 8000
FRAME, HOP = 256, 128
#: Bins of each band, first one included and last one not.
BANDS = ((2, 16), (16, 40), (40, 80), (80, 129))
PEAKS, FAN, REACH = 2, 3, 15
#: Frames that are transformed at once.
BLOCK = 2048
WINDOW = np.hanning(FRAME).astype(np.float32)


def pad(data: bytes) -> bytes:
    """The bytes and zeros up to the least positive multiple of 64."""
    return data + bytes(-len(data) % 64 or (0 if data else 64))


def write_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(RATE)
        f.writeframes(payload)
    return out.getvalue()


def read_wav(media: bytes, block: int = BLOCK * HOP) -> Iterator[bytes]:
    """The samples of a WAV file in blocks of so many bytes."""
    with wave.open(io.BytesIO(media), "rb") as f:
        if (f.getnchannels(), f.getsampwidth()) != (1, 1):
            raise ValueError("8-bit mono samples are needed")
        while part := f.readframes(block):
            yield part


def _spectra(blocks: Iterator[bytes]) -> Iterator[np.ndarray]:
    """Magnitudes of overlapping frames; the last frame is filled up with silence."""
    rest = np.zeros(0, dtype=np.float32)
    empty, ended = True, False
    while not ended:
        block = next(blocks, b"")
        ended = not block
        rest = np.concatenate([rest, (np.frombuffer(block, dtype=np.uint8).astype(np.float32) - 128) / 128])
        if ended and len(rest) and (empty or len(rest) > FRAME - HOP):
            n = max(0, -(-(len(rest) - FRAME) // HOP)) + 1
            rest = np.concatenate([rest, np.zeros((n - 1) * HOP + FRAME - len(rest), dtype=np.float32)])
        if len(rest) >= FRAME:
            frames = np.lib.stride_tricks.sliding_window_view(rest, FRAME)[::HOP]
            yield np.abs(np.fft.rfft(frames * WINDOW, axis=1))
            rest, empty = rest[len(frames) * HOP :], False


def peak_pairs(blocks: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and times (frames) of the spectral-peak pairs, in order of time."""
    heights, places = [], []
    for spectrum in _spectra(blocks):
        best = [spectrum[:, a:b].argmax(axis=1) + a for a, b in BANDS]
        at = np.arange(len(spectrum))
        heights.append(np.stack([spectrum[at, k] for k in best], axis=1))
        places.append(np.stack(best, axis=1).astype(np.int32))
    if not heights:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    height, place = np.concatenate(heights), np.concatenate(places)
    around = np.pad(height, ((1, 1), (0, 0)), constant_values=-1)
    top = (height >= around[:-2]) & (height > around[2:]) & (height > 1e-6)
    ranked = np.where(top, height, -1)
    order = np.argsort(-ranked, axis=1, kind="stable")[:, :PEAKS]
    frame = np.repeat(np.arange(len(height)), PEAKS)
    band = order.ravel()
    held = ranked[frame, band] > 0
    frame, bins = frame[held], place[frame, band][held]
    sort = np.lexsort((bins, frame))
    frame, bins = frame[sort], bins[sort]
    codes, times, first = [], [], []
    for k in range(1, FAN + 1):
        gap = frame[k:] - frame[:-k]
        ok = (gap <= REACH) & (gap > 0)
        codes.append((bins[:-k].astype(np.int64) << 12 | bins[k:].astype(np.int64) << 4 | gap)[ok])
        times.append(frame[:-k][ok])
        first.append(np.flatnonzero(ok) * FAN + k)
    turn = np.argsort(np.concatenate(first), kind="stable")
    return np.concatenate(codes)[turn].astype(np.int32), np.concatenate(times)[turn].astype(np.int32)


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """``(doc_id, media binary, n_bytes, peak_codes array<int>, peak_times array<int>)``.

    With ``digests``, columns that describe the stored bytes instead of the bytes, and the
    features' digest beside the arrays.
    """

    def full(batch: pa.RecordBatch) -> pa.RecordBatch:
        media, n, codes, times = [], [], [], []
        for data in raw(batch, "text"):
            media.append(write_wav(pad(data)))
            n.append(len(data))
            c, t = peak_pairs(read_wav(media[-1]))
            codes.append(c)
            times.append(t)
        kind = pa.list_(pa.int32())
        return pa.record_batch([batch.column(0), pa.array(media, pa.binary()), pa.array(n, pa.int64()), pa.array(codes, kind), pa.array(times, kind)], ["doc_id", "media", "n_bytes", "peak_codes", "peak_times"])

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [_described(data) for data in raw(batch, "text")]
        columns = [pa.array(list(c), KINDS[k]) for c, k in zip(zip(*rows, strict=True), DIGEST_TYPES, strict=True)]
        return pa.record_batch([batch.column(0), *columns], ["doc_id", *DIGESTS])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if digests:
        return map_batches(rows, digest, "doc_id long, " + ", ".join(f"{n} {k}" for n, k in zip(DIGESTS, DIGEST_TYPES, strict=True)))
    return map_batches(rows, full, "doc_id long, media binary, n_bytes long, peak_codes array<int>, peak_times array<int>")


DIGESTS = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_pairs", "peak_codes", "peak_times")
DIGEST_TYPES = ("long", "long", "string", "long", "long", "string", "string", "long", "array<int>", "array<int>")
KINDS = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def _described(data: bytes) -> tuple:
    media = write_wav(pad(data))
    payload, size, tail = hashlib.sha256(), 0, b""
    for block in read_wav(media):
        payload.update(block)
        size += len(block)
        tail = (tail + block)[-64:]
    codes, times = peak_pairs(read_wav(media))
    feature = hashlib.sha256(codes.astype("<i4").tobytes() + times.astype("<i4").tobytes()).hexdigest()
    return len(data), size, payload.hexdigest(), zlib.crc32(tail), len(media), hashlib.sha256(media).hexdigest(), feature, len(codes), codes, times


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(documents(spark, sf_dir), digests=True)
