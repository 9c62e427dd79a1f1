"""Frame operators: raw camera frames to images, frames are independent of each other."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.functions import kernels as K


#: Raw frames, and pixels, that are worked on at once.
FRAMES_AT_ONCE = 16
PIXELS_AT_ONCE = 1 << 21


def decode_frames(frames: DataFrame, bad_pixels: list[int] | None = None, target: float | None = 160.0, raw: str = "raw") -> DataFrame:
    """frames with ``rgb``: 320 x 320 x 3 bytes, row by row; truncated frames are null."""
    out = frames.withColumn("rgb", F.lit(None).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, FRAMES_AT_ONCE):
                batch = whole.slice(at, FRAMES_AT_ONCE)
                raws = batch.column(raw).to_pylist()
                good = [i for i, r in enumerate(raws) if r is not None and len(r) >= K.SIDE * K.LINE_BYTES]
                made: list[bytes | None] = [None] * len(raws)
                for i, rgb in zip(good, K.decode_stack([raws[i] for i in good], bad_pixels, target) if good else (), strict=True):
                    made[i] = rgb.tobytes()
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.binary())], names=batch.schema.names)

    return out.mapInArrow(run, out.schema)


def _images(pixels: pa.ListArray, width: int, kernel) -> pa.ListArray:
    """kernel(stack of images) for the images of each size; nulls stay."""
    sizes = pixels.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    groups = [(n, np.flatnonzero(sizes == n)) for n in np.unique(sizes[sizes >= 0])]
    made: list[np.ndarray] = []
    lengths = np.zeros(len(sizes), np.int64)
    for n, rows in groups:
        step = max(1, PIXELS_AT_ONCE // max(1, int(n)))
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            x = pixels.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(own), -1, width)
            y = np.asarray(kernel(x), float).reshape(len(own), -1)
            made.append(y.reshape(-1))
            lengths[own] = y.shape[1]
    # results stand by size: a take brings them back into the rows' order
    order = np.concatenate([rows for _, rows in groups] or [np.zeros(0, np.int64)])
    offsets = np.concatenate(([0], np.cumsum(lengths[order]))).astype(np.int32)
    stacked = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(made or [np.zeros(0)])))
    place = np.full(len(sizes), -1, np.int64)
    place[order] = np.arange(len(order))
    return stacked.take(pa.array(place, mask=place < 0))


def map_images(df: DataFrame, pixels: str, width: int, kernel, name: str = "image") -> DataFrame:
    """df with ``name``: kernel(stack of 2-D images) flattened image by image, for arrays of pixels; null images stay null."""
    out = df.withColumn(name, F.lit(None).cast("array<double>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _images(batch.column(pixels), width, kernel)], names=batch.schema.names)

    return out.mapInArrow(run, out.schema)


def repair_pixels(df: DataFrame, pixels: str, width: int, bad: list[int]) -> DataFrame:
    return map_images(df, pixels, width, lambda m: K.repair(m, bad))


def demosaic(df: DataFrame, pixels: str, width: int) -> DataFrame:
    return map_images(df, pixels, width, K.demosaic)
