"""Operators on whole signals: selection, zipping, calibration, statistics, filters, resampling."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigspark.functions import columns as C
from sigspark.functions import kernels as K

from . import chunks as H
from . import selection
from .chunks import CHUNK
from .joins import same_keys


def sample_range(df: DataFrame, index: str, n: int, start: float, until: float) -> DataFrame:
    """Samples start..until, the end included; a negative start counts from the end, and then until 0 means the end."""
    first, last = resolve_range(n, start, until)
    return df.where(F.col(index).between(first, last))


def resolve_range(n: int, start: float, until: float) -> tuple[int, int]:
    start = round(start)
    if start < 0:
        start += n
        until = n if until == 0 else until
    last = n - 1 if until == float("inf") else min(round(until), n - 1)
    return max(start, 0), last


def zip_signals(left: DataFrame, right: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Both signals side by side, as long as the shorter one."""
    return same_keys(left, right, [*keys, index])


def pivot_channels(df: DataFrame, keys: list[str], channel: str, value: str, channels: list) -> DataFrame:
    """A column for each of the listed channels; one aggregation, no pass to find them."""
    return df.groupBy(*keys).pivot(channel, channels).agg(F.sum(value))


def attach_frames(samples: DataFrame, frames: DataFrame, keys: list[str], index: str, per_frame: int, frame: str = "frame_idx") -> DataFrame:
    """Samples with the frame that is shown while they play."""
    return samples.withColumn(frame, F.floor(F.col(index) / per_frame).cast("long")).transform(lambda df: same_keys(df, frames, [*keys, frame]))


def with_statistic(df: DataFrame, keys: list[str], **statistics: Column) -> DataFrame:
    """df with statistics of its group on each row: aggregated first, then joined back.

    The aggregation combines before its shuffle where the function allows; the
    join can be split by Spark where a key is common. Rows with null keys are a
    group, null values do not count in a statistic, and no row is lost.
    """
    groups = df.groupBy(*keys).agg(*(c.alias(n) for n, c in statistics.items()))
    return same_keys(df, groups, keys)


def medians(df: DataFrame, keys: list[str], values: dict[str, str]) -> DataFrame:
    """(keys, names): exact medians of columns by group, of any size; nulls do not count."""
    return selection.medians(df, keys, {n: F.col(v) for n, v in values.items()})


def mean_std(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, mean, std): rows, mean and sample standard deviation by group."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def remove_median(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Gyroscope bias, gravity: values less the median of their group."""
    out = same_keys(df, selection.medians(df, keys, {f"_m{i}": F.col(v) for i, v in enumerate(values)}), keys)
    return out.withColumns({v: F.col(v) - F.col(f"_m{i}") for i, v in enumerate(values)}).drop(*(f"_m{i}" for i in range(len(values))))


def calibrate_gain(df: DataFrame, keys: list[str], axes: list[str], target: float = C.GRAVITY) -> DataFrame:
    """Axes scaled so that the median of their norm is ``target``."""
    out = same_keys(df, selection.medians(df, keys, {"_g": C.norm(*axes)}), keys)
    return out.withColumns({a: F.col(a) / F.col("_g") * target for a in axes}).drop("_g")


def calibrate(df: DataFrame, keys: list[str], gain: list[str], bias: list[str], target: float = C.GRAVITY) -> DataFrame:
    """``calibrate_gain`` of some axes and ``remove_median`` of others, by one search for all their medians."""
    found = selection.medians(df, keys, {"_g": C.norm(*gain)} | {f"_m{i}": F.col(v) for i, v in enumerate(bias)})
    out = same_keys(df, found, keys)
    out = out.withColumns({a: F.col(a) / F.col("_g") * target for a in gain} | {v: F.col(v) - F.col(f"_m{i}") for i, v in enumerate(bias)})
    return out.drop("_g", *(f"_m{i}" for i in range(len(bias))))


def histogram(df: DataFrame, keys: list[str], value: str, low: float, high: float, n: int) -> DataFrame:
    """(keys, bin, n): counts of equal bins 1..n, 0 below, n + 1 from high on."""
    return df.groupBy(*keys, F.width_bucket(F.col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(n)).alias("bin")).agg(F.count("*").alias("n"))


def equalise_histogram(df: DataFrame, keys: list[str], value: str, name: str = "equalised") -> DataFrame:
    """8-bit values mapped through the cumulative histogram of their group (256 rows a group); a null stays null and does not count."""
    from pyspark.sql import Window as W

    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    w = W.partitionBy(*keys).orderBy(value)
    cdf = counts.withColumn("_cdf", F.sum("_n").over(w)).withColumn("_low", F.first("_cdf").over(w))
    whole = W.partitionBy(*keys)
    cdf = cdf.withColumn("_all", F.max("_cdf").over(whole))
    even = F.when(F.col("_all") == F.col("_low"), F.col(value)).otherwise(F.round((F.col("_cdf") - F.col("_low")) * 255.0 / F.nullif(F.col("_all") - F.col("_low"), F.lit(0))).cast("int"))
    return same_keys(df, cdf.select(*keys, value, even.alias(name)), [*keys, value], "left")


def _schema(df: DataFrame, keys: list[str], index: str, wide: bool = False) -> str:
    return ", ".join([*(f"{k} {dict(df.dtypes)[k]}" for k in keys), f"{index} long", "y array<double>" if wide else "y double"])


def _samples(df: DataFrame, keys: list[str], index: str, value: str) -> DataFrame:
    """(keys, index, value) as doubles, or arrays of doubles with an element for each channel."""
    of = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    if dict(df.dtypes)[value].startswith("array"):
        of = F.transform(value, lambda v: F.coalesce(v.cast("double"), F.lit(0.0)))
    return df.select(*keys, F.col(index).cast("long").alias(index), of.alias(value))


def _matrix(tab: pa.Table, value: str) -> np.ndarray:
    """Samples by channels."""
    x = tab.column(value).combine_chunks()
    if not pa.types.is_list(x.type):
        return x.to_numpy(zero_copy_only=False)[:, None]
    sizes = x.value_lengths()
    if sizes.null_count or pa.compute.min_max(sizes)["min"] != pa.compute.min_max(sizes)["max"]:
        raise ValueError("all samples of a recording have the same channels")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _column(y: np.ndarray, wide: bool) -> pa.Array:
    if not wide:
        return pa.array(y.reshape(-1))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]), pa.array(np.ascontiguousarray(y).reshape(-1)))


def zero_phase_filter(df: DataFrame, keys: list[str], index: str, value: str, cutoff: float, fs: float, kind: str = "high", design_fs: float | None = None, chunk: int | None = None) -> DataFrame:
    """(keys, index, y): second-order Butterworth, forward and backward; design_fs reproduces a cutoff designed at another rate.

    The value is a number, or an array with an element for each channel.
    A channel may start at any index and is many chunks, each filtered from as
    many samples before and after it as the filter remembers (to 1e-15 of the
    signal), in one pass and one shuffle. A null counts as 0. A hole in the
    index is an error, or an end and a start where it takes whole chunks.
    """
    b, a = K.butter2(cutoff, design_fs or fs, kind)
    edge, start, reach = K.edge_length(b, a), K.steady_state(b, a), H.reach_of(a)
    if reach is None:
        raise ValueError("the filter is not stable")
    reach = max(reach, edge) + 1
    wide = dict(df.dtypes)[value].startswith("array")
    chunk = max(chunk or (H.WIDE_CHUNK if wide else CHUNK), reach)
    cut = H.with_halo(_samples(df, keys, index, value), index, chunk, reach, reach)

    def filtered(at: np.ndarray, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """y of a chunk's rows: a chunk has as many neighbours as the filter reaches unless the channel ends there, which is then prolonged."""
        H.consecutive(at)
        if len(x) < 2:
            return x
        first, last = int(own.argmax()), len(own) - int(own[::-1].argmax())
        pad = min(edge, len(x) - 1)
        y = np.empty_like(x)
        for k in range(x.shape[1]):
            v = np.ascontiguousarray(x[:, k])
            before = after = v[:0]
            if first < reach:
                before = 2 * v[0] - v[pad:0:-1]
            if len(v) - last < reach:
                after = 2 * v[-1] - v[-2 : -pad - 2 : -1]
            whole = np.concatenate((before, v, after))
            out, _ = K.iir(b, a, whole, start * whole[0])
            out, _ = K.iir(b, a, out[::-1], start * out[-1])
            y[:, k] = out[::-1][len(before) : len(before) + len(v)]
        return y

    def work(tab: pa.Table, groups: list[tuple[int, int]]) -> pa.Table:
        at, own = (tab.column(c).to_numpy(zero_copy_only=False) for c in (index, "_own"))
        x = _matrix(tab, value)
        made = [filtered(at[i:j], x[i:j], own[i:j])[own[i:j]] for i, j in groups if own[i:j].any()]
        y = np.concatenate(made) if made else x[:0]
        return tab.select([*keys, index]).filter(pa.array(own)).append_column("y", _column(y, wide))

    return H.dealt(cut, keys, index).mapInArrow(H.in_groups([*keys, "_chunk"], work), _schema(df, keys, index, wide))


def resample(df: DataFrame, keys: list[str], index: str, value: str, p: int, q: int, chunk: int | None = None, first: int | None = None) -> DataFrame:
    """(keys, index, y): rate changed by p/q with the kernel's own low-pass.

    The value is a number, or an array with an element for each channel. A
    chunk gets, beside its samples, those that the kernel reaches on both
    sides, and makes the output samples that fall into it. The output of a
    channel that starts at index f is that of the same samples from 0 on, numbered
    from f * p // q; f is found by a pass over the index, unless ``first`` gives it
    for all channels. A null counts as 0.
    """
    g = math.gcd(p, q)
    p, q = p // g, q // g
    wide = dict(df.dtypes)[value].startswith("array")
    rows = _samples(df, keys, index, value)
    if p == q:
        return rows.withColumnRenamed(value, "y")
    taps = K.resample_taps(p, q)
    halo = len(taps) // (2 * p) + 1
    chunk = q * max(1, -(-max(chunk or (H.WIDE_CHUNK if wide else CHUNK), halo) // q))
    if first is None:
        rows = same_keys(rows, rows.groupBy(*keys).agg(F.min(index).alias("_first")), keys)
    else:
        rows = rows.withColumn("_first", F.lit(first).cast("long"))
    cut = H.with_halo(rows.withColumn(index, F.col(index) - F.col("_first")), index, chunk, halo, halo)

    def work(tab: pa.Table, groups: list[tuple[int, int]]) -> pa.Table:
        at, own, origin = (tab.column(c).to_numpy(zero_copy_only=False) for c in (index, "_own", "_first"))
        x = _matrix(tab, value)
        rows, numbers, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [x[:0]]
        for i, j in groups:
            if not own[i:j].any():
                continue
            H.consecutive(at[i:j])
            a = i + int(own[i:j].argmax())
            b = j - int(own[i:j][::-1].argmax())
            if at[a] < 0 or at[a] % chunk or (at[a] > 0 and a == i):
                raise ValueError("the samples of a channel are not numbered one by one from its first")
            start = int(at[a]) // q * p
            end = -(-int(at[b - 1] + 1) * p // q) if b == j else int(at[b - 1] + 1) // q * p
            y.append(K.resample_part(x[i:j], int(at[i]), p, q, taps, start, end))
            numbers.append(np.arange(start, end) + int(origin[i]) * p // q)
            rows.append(np.full(end - start, i))
        heads = tab.select(keys).take(pa.array(np.concatenate(rows)))
        return pa.Table.from_arrays([*heads.columns, pa.array(np.concatenate(numbers)), _column(np.concatenate(y), wide)], names=[*keys, index, "y"])

    return H.dealt(cut, keys, index).mapInArrow(H.in_groups([*keys, "_chunk"], work), _schema(df, keys, index, wide))


def pitch_shift(df: DataFrame, keys: list[str], index: str, value: str, semitones: float, steps: int = 1024) -> DataFrame:
    """(keys, index, y): pitch changed, length kept (``kernels.Vocoder``); a null counts as 0.

    A channel is many chunks of ``steps`` output steps, dealt with the samples that
    their frames reach. A pass sums the phases' turns in each chunk (a row a chunk);
    with the sums of the chunks before it, each chunk makes its own part.
    """
    v = K.Vocoder(semitones)
    span, pad = steps * v.rate, v.n / v.hop + 2 + (v.overlap + 1) * v.rate
    rows = _samples(df, keys, index, value)
    sizes = rows.groupBy(*keys).agg(F.min(index).alias("_first"), F.max(index).alias("_last"))
    rows = same_keys(rows, sizes, keys).withColumn(index, F.col(index) - F.col("_first"))
    # a chunk of steps reaches the frames beside its own; a few samples more do no harm
    frame = F.col(index) / v.hop
    low, high = F.floor(F.greatest(frame - pad, F.lit(0.0)) / span), F.floor((frame + pad) / span)
    cut = rows.withColumn("_chunk", F.explode(F.sequence(low.cast("long"), high.cast("long"))))
    by = [*keys, "_chunk"]
    width = v.n // 2 + 1

    def chunks(tab: pa.Table, groups: list[tuple[int, int]]) -> Iterator[tuple]:
        at, x, first, last = (tab.column(c).to_numpy(zero_copy_only=False) for c in (index, value, "_first", "_last"))
        number = tab.column("_chunk").to_numpy()
        for i, j in groups:
            H.consecutive(at[i:j])
            length = int(last[i] - first[i]) + 1
            n = v.steps(length)
            a, b = int(number[i]) * steps, min((int(number[i]) + 1) * steps, n)
            if a < b:
                yield i, j, x[i:j], int(at[i]), a, b, n, length, int(first[i])

    def totals(tab: pa.Table, groups: list[tuple[int, int]]) -> pa.Table:
        made = [(i, v.total(x, start, a, b).tolist()) for i, _, x, start, a, b, *_ in chunks(tab, groups)]
        heads = tab.select(by).take(pa.array([i for i, _ in made], pa.int64()))
        return heads.append_column("_turn", pa.array([t for _, t in made], pa.list_(pa.float64())))

    def follow(tab: pa.Table) -> pa.Table:
        """The phase that each of a channel's chunks starts with; null for the first."""
        tab = tab.take(pa.array(np.argsort(tab.column("_chunk").to_numpy())))
        phase, out = np.zeros(width), []
        for k, turn in zip(tab.column("_chunk").to_pylist(), tab.column("_turn").to_pylist(), strict=True):
            out.append(phase.tolist() if k else None)
            phase = phase + np.array(turn)
        return tab.select(by).append_column("_phase", pa.array(out, pa.list_(pa.float64())))

    def shifted(tab: pa.Table, starts: pa.Table) -> pa.Table:
        tab = tab.sort_by(index)
        for _, _, x, start, a, b, n, length, first in chunks(tab, [(0, tab.num_rows)] if starts.num_rows else []):
            phase = starts.column("_phase")[0].as_py()
            m = v.owned(a, b, n, length)
            stretched, place = v.part(x, start, a, b, n, None if phase is None else np.array(phase))
            heads = tab.select(keys).take(pa.array(np.zeros(len(m), np.int64)))
            return pa.Table.from_arrays([*heads.columns, pa.array(m + first), pa.array(v.back(stretched, place, m))], names=[*keys, index, "y"])
        none = tab.select(keys).slice(0, 0)
        return pa.Table.from_arrays([*none.columns, pa.array([], pa.int64()), pa.array([], pa.float64())], names=[*keys, index, "y"])

    kinds = _kind(cut, by)
    sums = H.dealt(cut, keys, index).mapInArrow(H.in_groups(by, totals), f"{kinds}, _turn array<double>")
    phases = sums.groupBy(*(keys or [F.lit(0).alias("_all")])).applyInArrow(follow, f"{kinds}, _phase array<double>")
    return cut.groupBy(*by).cogroup(phases.groupBy(*by)).applyInArrow(shifted, _schema(df, keys, index))


def _kind(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {dict(df.dtypes)[n]}" for n in names)


def resample_by_join(df: DataFrame, keys: list[str], index: str, value: str, p: int, q: int, taps: list[float]) -> DataFrame:
    """(keys, index, y): the same as a relation: samples meet the taps, products are summed by output sample.

    Any length of signal, no group in one task; y[m] = sum of taps[k] * x[n] with n * p + k - mid = m * q.
    """
    mid, n_taps = len(taps) // 2, len(taps)
    weights = F.array(*(F.lit(float(t)) for t in taps))
    length = df.groupBy(*keys).agg((F.max(index) + 1).alias("_n"))
    place = F.col("_i") * p - mid
    # the taps k for which place + k is a multiple of q
    first = F.pmod(-place, F.lit(q))
    met = same_keys(df, length, keys).select(*keys, "_n", F.col(index).alias("_i"), F.col(value).alias("_x"))
    met = met.withColumn("_k", F.explode(F.when(first < n_taps, F.sequence(first.cast("int"), F.lit(n_taps - 1), F.lit(q)))))
    at = place + F.col("_k")
    met = met.where((at >= 0) & (at < F.ceil(F.col("_n") * p / F.lit(q)) * q))
    return met.groupBy(*keys, F.floor(at / q).cast("long").alias(index)).agg(F.sum(F.col("_x") * F.get(weights, F.col("_k"))).alias("y"))


def _orientations(x: np.ndarray, fs: float, method: str, gain: float, state: object) -> tuple[list[list[float] | None], object]:
    """Orientations along rows of nine axes, and the state to go on with; a row with a missing axis keeps the last one."""
    if method == "kalman":
        state = K.Ahrs(fs) if state is None else state
        return state.follow(x), state
    whole = np.isfinite(x).all(1)
    part = K.orientation(x[whole, :3], x[whole, 3:6], x[whole, 6:], fs, gain, state).tolist()
    place = np.cumsum(whole) - 1
    before = None if state is None else state.tolist()
    return [part[i] if i >= 0 else before for i in place.tolist()], np.array(part[-1]) if part else state


def fuse_orientation(df: DataFrame, keys: list[str], index: str, fs: float, method: str = "kalman", gain: float = 0.1, chunk: int | None = None, warm: int = 3000) -> DataFrame:
    """(keys, index, q): quaternion by sample from acc_*, gyr_* and mag_*; a row with a missing axis keeps the last one, null before the first.

    method is kalman (``kernels.Ahrs``) or complementary (``kernels.orientation``, with its gain).
    Without ``chunk`` a state is carried along each key, and rows stream. With it a key is
    many tasks: each chunk of a dense index starts from the compass ``warm``
    samples before its own. What the start leaves is measured in the tests: after 3,000 samples
    at 100 Hz at most half a degree from the sequential filter, a tenth in the median.
    """
    if method not in ("kalman", "complementary"):
        raise ValueError(f"unknown method {method!r}")
    names = [f"{s}_{a}" for s in ("acc", "gyr", "mag") for a in "xyz"]
    axes = lambda rows: np.stack([rows.column(n).to_numpy(zero_copy_only=False) for n in names], 1).astype(float)
    rows = df.select(*keys, index, *names)
    schema = rows.withColumn("q", F.lit(None).cast("array<double>")).schema
    kind = pa.list_(pa.float64())

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            tab = pa.Table.from_batches([batch])
            starts = H.starts_of(tab, keys).tolist()
            if last is not None and len(H.starts_of(pa.Table.from_batches([last, batch.slice(0, 1)]), keys)) > 1:
                state = None
            x, out = axes(batch), []
            for i, j in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                state = None if i else state
                part, state = _orientations(x[i:j], fs, method, gain, state)
                out += part
            last = batch.slice(batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, "q"])

    def by_chunk(tab: pa.Table, groups: list[tuple[int, int]]) -> pa.Table:
        own, at, x = tab.column("_own").to_numpy(zero_copy_only=False), tab.column(index).to_numpy(), axes(tab)
        out: list = []
        for i, j in groups:
            if own[i:j].any():
                H.consecutive(at[i:j])
                part, _ = _orientations(x[i:j], fs, method, gain, None)
                out += [q for q, mine in zip(part, own[i:j].tolist(), strict=True) if mine]
        return tab.filter(pa.array(own)).select([*keys, index, *names]).append_column("q", pa.array(out, kind))

    if chunk is None:
        dealt = rows.repartition(*keys) if keys else rows.coalesce(1)
        made = dealt.sortWithinPartitions(*keys, index).mapInArrow(along, schema)
    else:
        cut = H.with_halo(rows, index, max(chunk, warm), warm, 0)
        made = H.dealt(cut, keys, index).mapInArrow(H.in_groups([*keys, "_chunk"], by_chunk), schema)
    return made.select(*keys, index, "q", *names)


def envelope(df: DataFrame, keys: list[str], index: str, value: str, name: str = "envelope") -> DataFrame:
    """Size of the analytic signal: a Hilbert filter beside the signal delayed by half its length."""
    from .ordered import fir

    taps = K.hilbert_taps().tolist()
    half = len(taps) // 2
    out = fir(df, keys, index, value, taps, "_turned")
    out = fir(out, keys, index, value, [0.0] * half + [1.0], "_delayed")
    return out.withColumn(name, F.sqrt(F.col("_turned") * F.col("_turned") + F.col("_delayed") * F.col("_delayed"))).drop("_turned", "_delayed")


def dsp_mode(df: DataFrame, keys: list[str], index: str, value: str, mode: str, a: tuple, b: tuple, level: float, seed: int = 0) -> DataFrame:
    """df with ``dsp1``, ``dsp2`` and ``trigger`` in one of the device's modes; the index is dense.

    Modes: disabled, single, single_hilbert, double, double_hilbert, cascade,
    gated, random. a and b are (b, a) coefficients of the two causal filters;
    in the Hilbert modes the envelope of a filter's output is compared with the
    level, in place of the output.
    """
    from .ordered import iir_filter

    if mode.endswith("_hilbert"):
        out, fired = df, []
        for name, (num, den) in zip(("dsp1", "dsp2"), (a, b), strict=True):
            if name == "dsp2" and mode == "single_hilbert":
                out = out.withColumn("dsp2", F.lit(0.0))
                continue
            out = iir_filter(out, keys, [index], value, num, den, "_band", dense=True)
            out = envelope(out, keys, index, "_band", name).drop("_band")
            fired.append(F.col(name) > level)
        return out.withColumn("trigger", fired[0] if len(fired) == 1 else fired[0] | fired[1])

    if mode == "disabled":
        return df.withColumns({"dsp1": F.lit(0.0), "dsp2": F.lit(0.0), "trigger": F.lit(False)})
    if mode == "random":
        return df.withColumns({"dsp1": F.lit(0.0), "dsp2": F.lit(0.0)}).withColumn("trigger", (F.pmod(F.xxhash64(*keys, index, F.lit(seed)), F.lit(1_000_000)) / 1e6) < level)
    out = iir_filter(df, keys, [index], value, *a, "dsp1", dense=True)
    if mode == "single":
        return out.withColumn("dsp2", F.lit(0.0)).withColumn("trigger", F.col("dsp1") > level)
    out = iir_filter(out, keys, [index], "dsp1" if mode == "cascade" else value, *b, "dsp2", dense=True)
    one, two = F.col("dsp1") > level, F.col("dsp2") > level
    return out.withColumn("trigger", {"double": one | two, "cascade": two, "gated": one & two}[mode])
