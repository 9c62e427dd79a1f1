"""Live forms: frame decoding, throughput, windows, and stateful event operators on Structured Streaming.

Stateful operators sort each micro-batch and carry one small state a key;
across batches, input is expected in order of time (the pattern of a growing
recording). ``with_event_time`` plus Spark's watermark serve late data where
windows are aggregated.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sigspark.functions import kernels as K
from sigspark.operators.frames import decode_frames


def decode_live(frames: DataFrame) -> DataFrame:
    """Frames as the preview shows them: no pixel repair, no brightness."""
    return decode_frames(frames, None, None)


def with_event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermark over a timestamp; a timestamp without zone is read as UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def frames_per_second(df: DataFrame, column: str, delay: str = "5 seconds") -> DataFrame:
    """(window, n_frames) by whole second."""
    return with_event_time(df, column, delay).groupBy(F.window(column, "1 second")).agg(F.count("*").alias("n_frames"))


def preview(df: DataFrame, column: str, seconds: int, values: list[Column], slide: int | None = None, delay: str = "10 seconds") -> DataFrame:
    """Aggregates over display windows of 1, 2, 5 or 10 seconds, tumbling or sliding."""
    if seconds not in (1, 2, 5, 10):
        raise ValueError("preview windows last 1, 2, 5 or 10 seconds")
    return with_event_time(df, column, delay).groupBy(F.window(column, f"{seconds} seconds", f"{slide or seconds} seconds")).agg(*values)


class _Fold(StatefulProcessor):
    """step(state, row) -> (state, rows) over the rows of each key in order; state is a tuple of doubles."""

    def __init__(self, order: list[str], width: int, step: Callable, columns: list[str]):
        self.order, self.width, self.step, self.columns = order, width, step, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("fold", ", ".join(f"s{i} double" for i in range(self.width)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        state = self.state.get() if self.state.exists() else None
        out = []
        for row in batch.to_dict("records"):
            state, made = self.step(state, row)
            out += made
        if state is not None:
            self.state.update(tuple(float(x) for x in state))
        yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass


class _Whole(_Fold):
    """step(state, rows as a table) -> (state, table): all rows of a key and batch at once, for streams of samples."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(self.order, kind="stable", ignore_index=True)
        state, made = self.step(self.state.get() if self.state.exists() else None, batch)
        self.state.update(tuple(float(x) for x in state))
        if len(made):
            yield made[self.columns]


def _folded(df: DataFrame, keys: list[str], order: list[str], width: int, step: Callable, schema: str, fold: type[_Fold] = _Fold) -> DataFrame:
    columns = [c.strip().split(" ")[0] for c in schema.split(",")]
    return df.groupBy(*keys).transformWithStateInPandas(fold(order, width, step, columns), schema, "Append", "None")


def _schema(df: DataFrame, extra: str = "") -> str:
    return ", ".join(f"{c} {t}" for c, t in df.dtypes) + extra


def refractory_stream(df: DataFrame, keys: list[str], time: str, least: float) -> DataFrame:
    """Events at least ``least`` after the last one kept, across micro-batches."""

    def step(state, row):
        keep = state is None or row[time] >= state[0] + least
        return ((row[time],), [row]) if keep else (state, [])

    return _folded(df, keys, [time], 1, step, _schema(df))


def iir_stream(df: DataFrame, keys: list[str], index: str, value: str, b: list[float], a: list[float]) -> DataFrame:
    """df with ``y``: the causal filter, its delays carried from batch to batch; a null sample counts as 0."""
    width = max(len(a), len(b)) - 1

    def step(state, batch):
        y, state = K.iir(np.array(b), np.array(a), batch[value].astype(float).fillna(0.0).to_numpy(), None if state is None else np.array(state))
        return state, batch.assign(y=y)

    return _folded(df, keys, [index], width, step, _schema(df, ", y double"), _Whole)


def edge_stream(df: DataFrame, keys: list[str], index: str, word: str, n_bits: int = 16) -> DataFrame:
    """(keys, bit, phase, tick): edges as they happen; a run that is still open has no end yet."""
    kinds = dict(df.dtypes)

    def step(state, batch):
        now = batch[word].fillna(0).to_numpy().astype(np.int64) & ((1 << n_bits) - 1)
        changed = now ^ np.concatenate(([int(state[0]) if state else 0], now[:-1]))
        at, bit = np.nonzero(changed[:, None] >> np.arange(n_bits) & 1)
        phase = np.where(now[at] >> bit & 1, "start", "end")
        head = {k: batch[k].to_numpy()[at] for k in keys}
        return (now[-1],), pd.DataFrame(head | {"bit": bit.astype(np.int32), "phase": phase, "tick": batch[index].to_numpy().astype(np.int64)[at] + 1})

    return _folded(df, keys, [index], 1, step, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "bit int", "phase string", "tick long"]), _Whole)


def closed_loop(df: DataFrame, keys: list[str], time: str, value: str, level: float, delay: float, width: float, count: int, period: float, jitter: float = 0.0) -> DataFrame:
    """(keys, time, phase): a train of ``count`` pulses, ``delay`` (plus a repeatable jitter) after each upward crossing outside a train."""
    kinds = dict(df.dtypes)

    def step(state, row):
        high, busy = (state or (0.0, float("-inf")))
        now = float(row[value] > level)
        made = []
        if now and not high and row[time] >= busy:
            start = row[time] + delay + jitter * ((hash(round(row[time], 9)) % 1000) / 1000)
            for i in range(count):
                at = start + i * period
                made += [{k: row[k] for k in keys} | {"time": at, "phase": "start"}, {k: row[k] for k in keys} | {"time": at + width, "phase": "end"}]
            busy = start + (count - 1) * period + width
        return (now, busy), made

    return _folded(df, keys, [time], 2, step, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "time double", "phase string"]))


def _tail(df: DataFrame, keys: list[str], index: str, value: str, width: int, fill: float, made: str, of: Callable[[np.ndarray], np.ndarray], null: float = 0.0) -> DataFrame:
    """df with ``made``: of(the last ``width`` samples and a batch's, one after another) gives the batch's; they are kept from batch to batch."""

    def step(state, batch):
        x = np.concatenate((np.full(width, fill) if state is None else np.array(state), batch[value].astype(float).fillna(null).to_numpy()))
        return x[len(x) - width :], batch.assign(**{made: of(x)})

    return _folded(df, keys, [index], width, step, _schema(df, f", {made} double"), _Whole)


def fir_stream(df: DataFrame, keys: list[str], index: str, value: str, taps: list[float], name: str = "y") -> DataFrame:
    """As ``ordered.fir``: the causal weighted sum, its last samples carried from batch to batch; a null counts as 0."""
    if len(taps) < 2:
        return df.withColumn(name, F.coalesce(F.col(value), F.lit(0.0)) * float(taps[0]))
    return _tail(df, keys, index, value, len(taps) - 1, 0.0, name, lambda x: np.convolve(x, taps, "valid"))


def moving_average_stream(df: DataFrame, keys: list[str], index: str, value: str, n: int, name: str = "y") -> DataFrame:
    """As ``ordered.moving_average``: nulls do not count, there are fewer samples at the start."""

    def mean(x: np.ndarray) -> np.ndarray:
        there = np.lib.stride_tricks.sliding_window_view(np.isfinite(x), n).sum(1)
        sums = np.lib.stride_tricks.sliding_window_view(np.nan_to_num(x), n).sum(1)
        return np.where(there > 0, sums / np.maximum(there, 1), np.nan)

    if n < 2:
        return df.withColumn(name, F.col(value).cast("double"))
    out = _tail(df, keys, index, value, n - 1, np.nan, name, mean, np.nan)
    return out.withColumn(name, F.when(~F.isnan(name), F.col(name)))


def envelope_stream(df: DataFrame, keys: list[str], index: str, value: str, name: str = "envelope") -> DataFrame:
    """As ``signals.envelope``: the Hilbert filter beside the delayed signal."""
    taps = K.hilbert_taps()
    half = len(taps) // 2

    def size(x: np.ndarray) -> np.ndarray:
        return np.hypot(np.convolve(x, taps, "valid"), x[len(taps) - 1 - half : len(x) - half])

    return _tail(df, keys, index, value, len(taps) - 1, 0.0, name, size)


def resample_stream(df: DataFrame, keys: list[str], index: str, value: str, p: int, q: int) -> DataFrame:
    """(keys, index, y): as ``signals.resample`` of channels numbered from 0, each output sample as soon as all that its kernel reaches has come.

    State: the samples that later outputs reach. The last half kernel of a
    channel stays open, since a stream has no end.
    """
    g = math.gcd(p, q)
    p, q = p // g, q // g
    taps = K.resample_taps(p, q)
    halo = len(taps) // (2 * p) + 1
    width = 2 * halo + q + 2
    kinds = dict(df.dtypes)

    def step(state, batch):
        # the state: number of samples so far, then the last of them, zeros before the first
        n, held = (0, np.zeros(width)) if state is None else (int(state[0]), np.array(state[1:]))
        x = np.concatenate((held, batch[value].astype(float).fillna(0.0).to_numpy()))
        done = lambda m: max(0, -(-(m - halo) * p // q))  # noqa: E731  outputs whose kernels end within m samples
        start, end = done(n), done(n + len(batch))
        y = K.resample_part(x, n - width, p, q, taps, start, end)
        n += len(batch)
        head = {k: [batch[k].iloc[0]] * (end - start) for k in keys}
        return (n, *x[len(x) - width :]), pd.DataFrame(head | {index: np.arange(start, end), "y": y})

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), f"{index} long", "y double"])
    return _folded(df, keys, [index], width + 1, step, schema, _Whole)


def orientation_stream(df: DataFrame, keys: list[str], index: str, fs: float) -> DataFrame:
    """(keys, index, qw, qx, qy, qz): as ``signals.fuse_orientation`` by the Kalman filter, whose quaternion, offsets and variances are kept from batch to batch."""
    names = [f"{s}_{a}" for s in ("acc", "gyr", "mag") for a in "xyz"]
    kinds = dict(df.dtypes)
    parts = ["qw", "qx", "qy", "qz"]

    def step(state, batch):
        known = K.Ahrs.of_state(fs, None if state is None or state[0] != state[0] else list(state))
        q = np.array([[np.nan] * 4 if r is None else r for r in known.follow(batch[names].to_numpy(float))])
        return known.state() or [np.nan] * K.AHRS_STATE, batch[[*keys, index]].assign(**{n: q[:, i] for i, n in enumerate(parts)})

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in [*keys, index]), *(f"{n} double" for n in parts)])
    return _folded(df, keys, [index], K.AHRS_STATE, step, schema, _Whole)


def zip_live(left: DataFrame, right: DataFrame, keys: list[str], index: str, left_time: str, right_time: str, delay: str, apart: str) -> DataFrame:
    """Two streams side by side by sample or frame number, as ``signals.zip_signals``.

    A sample waits for its other half as long as the watermarks (``delay``) and
    the distance of their times (``apart``) allow, and is then forgotten.
    """
    other = with_event_time(right, right_time, delay).withColumnsRenamed({k: f"_right_{k}" for k in [*keys, index]})
    mine = with_event_time(left, left_time, delay)
    same = [F.col(k) == F.col(f"_right_{k}") for k in [*keys, index]]
    near = F.col(right_time).between(F.col(left_time) - F.expr(f"INTERVAL {apart}"), F.col(left_time) + F.expr(f"INTERVAL {apart}"))
    on = near
    for condition in same:
        on = on & condition
    return mine.join(other, on).drop(*(f"_right_{k}" for k in [*keys, index]))


def attach_frames_live(samples: DataFrame, frames: DataFrame, keys: list[str], index: str, per_frame: int, sample_time: str, frame_time: str, delay: str, apart: str, frame: str = "frame_idx") -> DataFrame:
    """Samples with the frame that is shown while they play, as ``signals.attach_frames``, of two streams."""
    numbered = samples.withColumn(frame, F.floor(F.col(index) / per_frame).cast("long"))
    return zip_live(numbered, frames, keys, frame, sample_time, frame_time, delay, apart)


def activity(df: DataFrame, keys: list[str], time: str, gap: str | Column, delay: str = "10 seconds") -> DataFrame:
    """(keys, start, last, n): runs of events less than ``gap`` apart, each once the watermark has passed its end.

    A gap may differ from event to event (a column of intervals); late events that
    still belong to an open run join it, or join two.
    """
    timed = with_event_time(df, time, delay)
    return timed.groupBy(*keys, F.session_window(time, gap)).agg(F.min(time).alias("start"), F.max(time).alias("last"), F.count("*").alias("n")).drop("session_window")


class _Trains(StatefulProcessor):
    """Rows wait for the watermark, are then looked at in order of time, and pulses leave when event time has reached them."""

    def __init__(self, keys: list[str], time: str, value: str, level: float, plan: Callable[[int], list[int]], width_us: int, quiet_us: int):
        self.keys, self.time, self.value, self.level, self.plan, self.width, self.quiet = keys, time, value, level, plan, width_us, quiet_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "us long, high boolean")
        self.pulses = handle.getListState("pulses", "us long")
        self.last = handle.getValueState("last", "high boolean, busy long")

    def _all(self, state) -> list[tuple]:
        return [tuple(r) for r in state.get()] if state.exists() else []

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))
        us = batch[self.time].astype("datetime64[us]").astype("int64")
        high = (batch[self.value].astype(float) > self.level).to_numpy()
        new = [(int(t), bool(h)) for t, h in zip(us, high, strict=True)]
        self.rows.appendList(new)
        self._wake(min(new)[0])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        rows, pulses = sorted(self._all(self.rows)), [p[0] for p in self._all(self.pulses)]
        high, busy = tuple(self.last.get()) if self.last.exists() else (False, None)
        at = 0
        while at < len(rows) and rows[at][0] <= now:
            us, now_high = rows[at]
            if now_high and not high and (busy is None or us >= busy):
                train = self.plan(us)
                pulses += train
                busy = max([us, *(t + self.width for t in train)]) + self.quiet
            high, at = now_high, at + 1
        due = sorted(p for p in pulses if p <= now)
        rows, pulses = rows[at:], [p for p in pulses if p > now]
        for state, held in ((self.rows, rows), (self.pulses, [(p,) for p in pulses])):
            if held:
                state.put(held)
            else:
                state.clear()
        self.last.update((high, -(1 << 62) if busy is None else busy))
        for waiting in ([rows[0][0]] if rows else []) + ([min(pulses)] if pulses else []):
            self._wake(max(waiting, now + 1000))
        made = [(p + d, phase) for p in due for d, phase in ((0, "start"), (self.width, "end"))]
        if made:
            head = dict(zip(self.keys, key, strict=True))
            times = pd.to_datetime([t for t, _ in made], unit="us", utc=True)
            yield pd.DataFrame({k: [v] * len(made) for k, v in head.items()} | {"time": times, "phase": [p for _, p in made]})

    def close(self) -> None:
        pass


def train(us: int, delay: float, count: int, period: float, random_delay: float = 0.0, train_start: float = 0.0, train_duration: float | None = None, seed: int = 0) -> list[int]:
    """Times (microseconds) of the pulses after a trigger: ``count`` of them every ``period`` seconds, ``delay`` plus a repeatable part of ``random_delay``
    behind it; only those from ``train_start`` on and before it is ``train_duration`` old."""
    part = int.from_bytes(hashlib.blake2b(f"{seed}:{us}".encode(), digest_size=4).digest(), "little") / (1 << 32)
    first = us + round((delay + random_delay * part) * 1_000_000)
    pulses = [first + round(i * period * 1_000_000) for i in range(count)]
    low = us + round(train_start * 1_000_000)
    high = None if train_duration is None else low + round(train_duration * 1_000_000)
    return [t for t in pulses if t >= low and (high is None or t < high)]


def closed_loop_trains(df: DataFrame, keys: list[str], time: str, value: str, level: float, width: float, delay: float, count: int, period: float, watermark: str = "1 second", quiet: float = 0.0, **more: float) -> DataFrame:
    """(keys, time, phase): pulse trains after upward crossings outside a train, each pulse when event time reaches it.

    ``time`` is a timestamp. Rows that come out of order within the watermark are
    looked at in order; later ones are left out. Triggers within ``quiet`` seconds
    of a train's end are passed over. See ``train`` for the delays and the train's
    start and duration. State: rows and pulses that the watermark has not reached.
    """
    kinds = dict(df.dtypes)
    plan = lambda us: train(us, delay, count, period, **more)
    processor = _Trains(keys, time, value, level, plan, round(width * 1_000_000), round(quiet * 1_000_000))
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "time timestamp", "phase string"])
    return with_event_time(df, time, watermark).groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "EventTime")


def use_state_store(spark) -> None:
    """Stateful operators keep their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
