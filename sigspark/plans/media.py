"""Offline audio and video of a session, and the live preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.functions import columns as C
from sigspark.functions.kernels import BAD_PIXELS
from sigspark.operators import frames as V
from sigspark.operators import signals as S
from sigspark.sources import dat, wav
from sigspark.sources import frames as frame_source
from sigspark.streaming import live

AUDIO_RATE, VIDEO_RATE, MP3_RATE = 160_000, 16, 48_000


def audio(spark: SparkSession, path: str, cutoff: float = 1.0) -> DataFrame:
    """(session, sample_idx, pcm): high-passed signed samples; a session's audio is one sequence."""
    raw = dat.read_audio(spark, path).select("session", "sample_idx", F.col("pcm").cast("double").alias("value"))
    return S.zero_phase_filter(raw, ["session"], "sample_idx", "value", cutoff, AUDIO_RATE).select("session", "sample_idx", C.saturate_int16("y").alias("pcm"))


def slow_audio(samples: DataFrame) -> DataFrame:
    """The samples at the rate of the compressed form."""
    return S.resample(samples, ["session"], "sample_idx", "pcm", MP3_RATE, AUDIO_RATE).select("session", "sample_idx", C.saturate_int16("y").alias("pcm"))


def save_wav(samples: DataFrame, path: str) -> None:
    wav.write_wav(samples, path, AUDIO_RATE)


def video(spark: SparkSession, path: str, bad_pixels: list[int] | None = BAD_PIXELS, target: float = 160.0) -> DataFrame:
    """(path, frame_idx, t, rgb) of a file of raw frames; the listed pixels are repaired (None: none)."""
    out = V.decode_frames(frame_source.read_frames(spark, path), bad_pixels, target)
    return out.select("path", "frame_idx", C.seconds_of("frame_idx", VIDEO_RATE).alias("t"), "rgb")


def with_audio(images: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples with the number of the frame shown while they play."""
    return S.attach_frames(samples, images.select("frame_idx", "t"), [], "sample_idx", AUDIO_RATE // VIDEO_RATE)


def preview(spark: SparkSession, path: str) -> DataFrame:
    """A stream of decoded frames of a growing file."""
    return live.decode_live(frame_source.stream_frames(spark, path))
