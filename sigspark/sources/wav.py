"""WAV sink: mono 16-bit PCM."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dat import write_dat

RATE = 160_000


def write_wav(samples: DataFrame, path: str, rate: int = RATE, value: str = "pcm") -> None:
    """samples(sample_idx, value) in order of sample; tasks write their parts, which are joined behind the header."""
    write_dat(samples.select("sample_idx", F.array(value).alias("x")), path, wav_rate=rate)
