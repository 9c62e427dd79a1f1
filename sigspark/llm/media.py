"""Media columns: bytes stored as WAV, read back, and fingerprinted.

``encode_wav`` stores a payload as the samples of a mono 8-bit WAV (lossless:
one byte, one sample). ``fingerprint`` reads the stored form with the ``wave``
module, takes short-time Fourier transforms in blocks of bounded size, finds
the strongest spectral peaks of each frame and pairs each with the peaks of
the next frames: the pairs are returned as two arrays, time and code.

Cases: null text is empty; an empty payload is padded to 64 zero bytes; equal
payloads have equal values; rows are kept one by one; an empty table gives no
rows; extra columns are ignored; a very long text is transformed block by
block.
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

from .common import bounded_batches, table, tidy

UNIT = 64
RATE = 8000
FRAME, HOP = 1024, 512
PEAKS, AHEAD = 3, 3
BLOCK_FRAMES = 2048

FEATURES = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("n_frames", pa.int64()), ("pair_times", pa.list_(pa.int32())), ("pair_codes", pa.list_(pa.int32()))])
FEATURES_DDL = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_frames long, pair_times array<int>, pair_codes array<int>"


def pad(payload: bytes) -> bytes:
    return payload + bytes(UNIT - len(payload) % UNIT if len(payload) % UNIT or not payload else 0)


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def frame_peaks(samples: np.ndarray) -> np.ndarray:
    """int32 (frames, PEAKS): bins of the strongest local maxima, strongest first, -1 where there are fewer."""
    x = samples.astype(np.float32) - np.float32(128)
    n = 1 if len(x) <= FRAME else 1 + -(-(len(x) - FRAME) // HOP)
    x = np.pad(x, (0, (n - 1) * HOP + FRAME - len(x)))
    shape = np.hanning(FRAME).astype(np.float32)
    out = np.empty((n, PEAKS), np.int32)
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    for at in range(0, n, BLOCK_FRAMES):
        mag = np.abs(np.fft.rfft(frames[at : at + BLOCK_FRAMES] * shape, axis=1))
        mid = mag[:, 1:-1]
        top = np.where((mid > mag[:, :-2]) & (mid >= mag[:, 2:]), mid, np.float32(0))
        rows = np.arange(len(top))
        for k in range(PEAKS):
            best = top.argmax(1)
            out[at : at + len(top), k] = np.where(top[rows, best] > 0, best + 1, -1)
            top[rows, best] = 0
    return out


def peak_pairs(peaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Time (frame) and code (bin, later bin, distance) of each pair of peaks at most AHEAD frames apart."""
    times, codes = [], []
    for dt in range(1, AHEAD + 1):
        a, b = np.broadcast_arrays(peaks[:-dt, :, None], peaks[dt:, None, :])
        t = np.broadcast_to(np.arange(len(a), dtype=np.int32)[:, None, None], a.shape)
        good = (a >= 0) & (b >= 0)
        times.append(t[good])
        codes.append((a[good] << 16) | (b[good] << 4) | dt)
    times, codes = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((codes, times))
    return times[order], codes[order]


@tidy
def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array([to_wav(pad(t or b"")) for t in texts], pa.binary())],
            names=["doc_id", "n_bytes", "media"],
        )


@tidy
def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, n, media in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            payload = from_wav(media)
            peaks = frame_peaks(np.frombuffer(payload, np.uint8))
            times, codes = peak_pairs(peaks)
            rows.append((doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), len(peaks), times, codes))
        columns = list(zip(*rows, strict=True)) or [()] * len(FEATURES)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, FEATURES, strict=True)], schema=FEATURES)


def encode_wav(df: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media) of df(doc_id, text)."""
    bounded_batches(df.sparkSession)
    return df.select("doc_id", "text").mapInArrow(_encode, "doc_id long, n_bytes long, media binary")


def fingerprint(media: DataFrame) -> DataFrame:
    """Digests and peak-pair arrays of media(doc_id, n_bytes, media)."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_features, FEATURES_DDL)


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the stored form and, beside ``feature``, the time-coded arrays that it stands for."""
    found = fingerprint(encode_wav(table(spark, sf_dir, "documents")))
    pairs = F.transform(F.arrays_zip("pair_times", "pair_codes"), lambda p: F.concat_ws(":", p["pair_times"].cast("string"), p["pair_codes"].cast("string")))
    feature = F.concat_ws("/", F.col("n_frames").cast("string"), F.size("pair_codes").cast("string"), F.sha2(F.array_join(pairs, ","), 256))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"), "pair_times", "pair_codes")
