"""Chunks of consecutive samples: dealt by arithmetic on the index, with what a kernel reaches on both sides, and worked on in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Samples of a chunk: what a task holds of a channel, beside what its kernel reaches.
CHUNK = 1 << 18
#: The same for rows that hold all channels.
WIDE_CHUNK = 1 << 17
#: What is left of a filter's start after its reach, as a part of the signal.
REST = 1e-15


def reach_of(a: np.ndarray) -> int | None:
    """Samples after which a causal filter has forgotten its start; None if it never does."""
    poles = np.roots(np.trim_zeros(np.asarray(a, float), "b"))
    largest = float(np.abs(poles).max()) if len(poles) else 0.0
    if largest >= 1:
        return None
    # a double pole decays as n * r^n: a few more samples
    return 8 + (0 if largest == 0 else math.ceil(1.25 * math.log(REST) / math.log(largest)))


def with_halo(df: DataFrame, index: str, chunk: int, before: int, after: int) -> DataFrame:
    """df with ``_chunk`` and ``_own``: the samples at most ``before`` ahead of a chunk and ``after`` behind it are also sent to it, not its own."""
    if max(before, after) > chunk:
        raise ValueError("a chunk is to be at least as long as the kernel's reach")
    own, place = F.floor(F.col(index) / chunk).cast("long"), F.pmod(F.col(index), F.lit(chunk))
    reach = [own]
    if after:
        reach.append(F.when((place < after) & (own > 0), own - 1))
    if before:
        reach.append(F.when(place >= chunk - before, own + 1))
    dealt = df.withColumn("_chunk", F.explode(F.array_compact(F.array(*reach))) if len(reach) > 1 else own)
    return dealt.withColumn("_own", F.col("_chunk") == own)


def starts_of(tab: pa.Table, names: list[str]) -> np.ndarray:
    """Rows at which a column of a sorted table changes, the first included; nulls are equal."""
    n = tab.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for name in names:
        column = tab.column(name).combine_chunks()
        a, b = column.slice(1), column.slice(0, n - 1)
        other = pc.fill_null(pc.not_equal(a, b), False)
        new[1:] |= other.to_numpy(zero_copy_only=False) | pc.xor(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def in_groups(names: list[str], work: Callable[[pa.Table, list[tuple[int, int]]], pa.Table]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over rows sorted by names: work(rows, groups as (from, until)) sees whole groups, as many as a batch ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(tab: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
            yield from work(tab, list(zip(cuts[:-1], cuts[1:], strict=True))).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            # a batch that only goes on with the group that is open is put aside
            if held and len(starts_of(pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch]), names)) == 1:
                held.append(batch)
                continue
            tab = pa.Table.from_batches([*held, batch])
            starts = starts_of(tab, names)
            if len(starts) > 1:
                yield from done(tab.slice(0, starts[-1]), starts.tolist())
            held = tab.slice(starts[-1]).combine_chunks().to_batches()
        if held:
            tab = pa.Table.from_batches(held)
            yield from done(tab, [0, tab.num_rows])

    return run


def consecutive(at: np.ndarray) -> None:
    """An index that steps by other than one is an error."""
    if len(at) and at[-1] - at[0] + 1 != len(at) or (np.diff(at) != 1).any():
        raise ValueError("the samples of a channel are not numbered one by one")


def dealt(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Chunks dealt to tasks and sorted, for ``in_groups([*keys, "_chunk"], ...)``."""
    return df.repartition(*keys, "_chunk").sortWithinPartitions(*keys, "_chunk", index)
