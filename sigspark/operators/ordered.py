"""Ordered operators on signals: neighbours, edges, runs, running sums, sequential state.

Signals carry a dense sample index, so a long session is cut into chunks of
consecutive samples and no task needs a whole session. Operators without such
an index use windows over the keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigspark.functions import kernels as K

from . import chunks as H
from .joins import same_keys

CHUNK = 1 << 20


def with_index(df: DataFrame, keys: list[str], order: list[str], name: str = "sample_idx", span: Column | None = None) -> DataFrame:
    """Dense 0-based index by key; recordings have theirs from the scan, tables get it here.

    ``span`` is an expression that does not fall along the order (the day of a
    time, say): rows are then numbered by key and span, and the numbers of the
    rows in earlier spans are added, so that a long session is many tasks.
    """
    place = lambda by: F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("long") - 1
    if span is None:
        return df.withColumn(name, place(keys))
    cut, by = df.withColumn("_span", span), [*keys, "_span"]
    counts = cut.groupBy(*by).agg(F.count("*").alias("_n"))
    earlier = W.partitionBy(*keys).orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(*by, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return same_keys(cut.withColumn(name, place(by)), before, by).withColumn(name, F.col(name) + F.col("_before")).drop("_span", "_before")


def with_lag(df: DataFrame, keys: list[str], order: list[str], value: str, start: object = None, name: str = "prev", span: Column | None = None) -> DataFrame:
    """df with the value one row before; ``start`` for the first. With ``span`` (see ``with_index``) only the last row of each span is looked for beyond it."""
    if span is None:
        return df.withColumn(name, F.lag(value, 1, start).over(W.partitionBy(*keys).orderBy(*order)))
    cut, by = df.withColumn("_span", span), [*keys, "_span"]
    # in a struct, a null value is not the lack of a row
    held = F.struct(F.col(value).alias("v"))
    lasts = cut.groupBy(*by).agg(F.max_by(held, F.struct(*order)).alias("_last"))
    lasts = lasts.select(*by, F.lag("_last").over(W.partitionBy(*keys).orderBy("_span")).alias("_last"))
    inside = F.lag(held).over(W.partitionBy(*by).orderBy(*order))
    out = same_keys(cut.withColumn("_inside", inside), lasts, by)
    found = F.coalesce("_inside", "_last")
    return out.withColumn(name, F.when(found.isNull(), F.lit(start)).otherwise(found["v"])).drop("_span", "_inside", "_last")


def with_neighbours(df: DataFrame, keys: list[str], index: str, value: str, pad: object = 0, chunk: int = CHUNK) -> DataFrame:
    """df with ``prev`` and ``next``: the value one sample before and after, ``pad`` beyond the ends.

    The first and last sample of each chunk are also sent to the chunk beside it.
    """
    own = F.floor(F.col(index) / chunk).cast("long")
    place = F.pmod(F.col(index), F.lit(chunk))
    beside = F.array(own, F.when(place == 0, own - 1), F.when(place == chunk - 1, own + 1))
    dealt = df.withColumn("_own", own).withColumn("_chunk", F.explode(F.array_compact(beside)))
    w = W.partitionBy(*keys, "_chunk").orderBy(index)
    out = dealt.withColumns({"prev": F.lag(value, 1).over(w), "next": F.lead(value, 1).over(w)})
    out = out.where("_own = _chunk").drop("_own", "_chunk")
    return out.withColumns({"prev": F.coalesce("prev", F.lit(pad)), "next": F.coalesce("next", F.lit(pad))})


def first_difference(df: DataFrame, keys: list[str], order: list[str], value: str, start: object = 0, name: str = "step", span: Column | None = None) -> DataFrame:
    """Value minus its predecessor; the first is compared with ``start``. ``span`` as in ``with_index``."""
    return with_lag(df, keys, order, value, start, "_lag", span).withColumn(name, F.col(value) - F.col("_lag")).drop("_lag")


def word_edges(df: DataFrame, keys: list[str], index: str, word: str, n_bits: int = 16, chunk: int = CHUNK) -> DataFrame:
    """(keys, bit, phase, tick) of each edge of each bit of a digital word; both ends count as low.

    Neighbours are found once for the word, so the shuffle moves words, not
    bits. tick is 1-based: the first high sample for starts, the first low
    sample after it for ends.
    """
    near = with_neighbours(df.select(*keys, index, word), keys, index, word, 0, chunk)
    mask = (1 << n_bits) - 1
    now, prev, after = (F.col(c).cast("long").bitwiseAND(F.lit(mask)) for c in (word, "prev", "next"))
    near = near.select(*keys, index, now.bitwiseAND(F.bitwise_not(prev)).alias("rise"), now.bitwiseAND(F.bitwise_not(after)).alias("fall"))
    near = near.where("rise <> 0 OR fall <> 0")
    bits = F.sequence(F.lit(0), F.lit(n_bits - 1))
    on = lambda c: F.transform(F.filter(bits, lambda i: F.call_function("shiftright", F.col(c), i).bitwiseAND(F.lit(1)) == 1), lambda i: F.struct(i.alias("bit"), F.lit("start" if c == "rise" else "end").alias("phase"), (F.col(index) + (1 if c == "rise" else 2)).alias("tick")))
    return near.select(*keys, F.explode(F.concat(on("rise"), on("fall"))).alias("e")).select(*keys, "e.bit", "e.phase", "e.tick")


def runs(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start_tick, end_tick, ticks): each start with the end that follows it."""
    w = W.partitionBy(*keys).orderBy("tick", F.col("phase"))
    paired = edges.withColumn("end_tick", F.lead("tick").over(w)).where("phase = 'start'")
    return paired.select(*keys, F.col("tick").alias("start_tick"), "end_tick", (F.col("end_tick") - F.col("tick")).alias("ticks"))


def threshold_edges(df: DataFrame, keys: list[str], index: str, value: str, level: float, chunk: int = CHUNK) -> DataFrame:
    """(keys, phase, tick) where a signal goes above a level or returns."""
    return word_edges(df.withColumn("_high", (F.col(value) > level).cast("int")), keys, index, "_high", 1, chunk).drop("bit")


def running_sum(df: DataFrame, keys: list[str], index: str, value: Column | str, name: str, chunk: int = CHUNK) -> DataFrame:
    """Cumulative sum along the index: sums inside chunks, plus the total of the chunks before. A null adds nothing; rows with null keys are a group."""
    v = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0.0))
    cut = df.withColumn("_v", v).withColumn("_chunk", F.floor(F.col(index) / chunk).cast("long"))
    totals = cut.groupBy(*keys, "_chunk").agg(F.sum("_v").alias("_t"))
    before = totals.withColumn("_before", F.coalesce(F.sum("_t").over(W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))).drop("_t")
    inside = F.sum("_v").over(W.partitionBy(*keys, "_chunk").orderBy(index).rowsBetween(W.unboundedPreceding, W.currentRow))
    out = cut.withColumn(name, inside).transform(lambda x: same_keys(x, before, [*keys, "_chunk"]))
    return out.withColumn(name, F.col(name) + F.col("_before")).drop("_v", "_chunk", "_before")


def _with_halo(df: DataFrame, index: str, before: int, chunk: int) -> DataFrame:
    """df with ``_own`` and ``_chunk``: the last ``before`` samples of a chunk are also sent to the next one."""
    chunk = max(chunk, before)
    own = F.floor(F.col(index) / chunk).cast("long")
    after = F.when(F.pmod(F.col(index), F.lit(chunk)) >= chunk - before, own + 1)
    return df.withColumn("_own", own).withColumn("_chunk", F.explode(F.array_compact(F.array(own, after))))


def fir(df: DataFrame, keys: list[str], index: str, value: str, taps: list[float], name: str = "y", chunk: int = CHUNK) -> DataFrame:
    """Causal weighted sum of the last samples of a dense index; zeros before the first, and for nulls."""
    w = W.partitionBy(*keys, "_chunk").orderBy(index)
    x = F.coalesce(F.col(value), F.lit(0.0))
    y = sum((F.lit(t) * F.lag(x, k, 0.0).over(w) for k, t in enumerate(taps[1:], 1)), F.lit(taps[0]) * x)
    return _with_halo(df, index, len(taps) - 1, chunk).withColumn(name, y).where("_own = _chunk").drop("_own", "_chunk")


def moving_average(df: DataFrame, keys: list[str], index: str, value: str, n: int, name: str = "y", chunk: int = CHUNK) -> DataFrame:
    """Mean of the last n samples of a dense index, fewer at the start; nulls do not count."""
    w = W.partitionBy(*keys, "_chunk").orderBy(index).rowsBetween(1 - n, 0)
    return _with_halo(df, index, n - 1, chunk).withColumn(name, F.avg(value).over(w)).where("_own = _chunk").drop("_own", "_chunk")


def every_other(df: DataFrame, keys: list[str], order: list[str], span: Column | None = None) -> DataFrame:
    """Rows 1, 3, 5, ... by key. ``span`` as in ``with_index``."""
    return with_index(df, keys, order, "_n", span).where("_n % 2 = 0").drop("_n")


def sequential(df: DataFrame, keys: list[str], order: list[str], value: str, step: Callable[[object, float], tuple[object, object]], start: Callable[[], object], name: str, kind: str) -> DataFrame:
    """Fold along the order of each key, keeping each step's result.

    Rows are dealt by key, sorted in their partition and streamed: a task holds
    one state, never a whole key.
    """
    slots = df.withColumn(name, F.lit(None).cast(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            held = zip(*(batch.column(k).to_pylist() for k in keys), strict=True)
            out = []
            for key, v in zip(held, batch.column(value).to_pylist(), strict=True):
                if key != now:
                    now, state = key, start()
                state, y = step(state, v)
                out.append(y)
            made = pa.array(out, batch.schema.field(name).type)
            yield pa.RecordBatch.from_arrays([made if n == name else c for n, c in zip(batch.schema.names, batch.columns, strict=True)], names=batch.schema.names)

    return slots.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, slots.schema)


def iir_first_order(df: DataFrame, keys: list[str], order: list[str], value: str, gain: float, name: str = "y") -> DataFrame:
    """y[n] = gain * x[n] + (1 - gain) * y[n - 1], from y[-1] = 0."""
    return iir_filter(df, keys, order, value, [gain], [1.0, gain - 1.0], name)


def _iir_by_chunk(df: DataFrame, keys: list[str], index: str, value: str, b: np.ndarray, a: np.ndarray, name: str, chunk: int, reach: int) -> DataFrame:
    """As ``iir_filter`` over a dense index: each chunk is filtered from as many samples before it as the filter remembers."""
    cut = H.with_halo(df, index, max(chunk, reach), reach, 0)
    made = df.withColumn(name, F.lit(None).cast("double")).schema

    def work(tab: pa.Table, groups: list[tuple[int, int]]) -> pa.Table:
        own, at = tab.column("_own").to_numpy(zero_copy_only=False), tab.column(index).to_numpy()
        x = tab.column(value).combine_chunks().cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
        y = np.zeros(len(x))
        for i, j in groups:
            if own[i:j].any():
                H.consecutive(at[i:j])
                y[i:j] = K.iir(b, a, x[i:j])[0]
        out = tab.drop_columns(["_chunk", "_own"])
        out = out.set_column(out.schema.get_field_index(name), name, pa.array(y)) if name in out.schema.names else out.append_column(name, pa.array(y))
        return out.filter(pa.array(own))

    return H.dealt(cut, keys, index).mapInArrow(H.in_groups([*keys, "_chunk"], work), made)


def iir_filter(df: DataFrame, keys: list[str], order: list[str], value: str, b: list[float], a: list[float], name: str = "y", dense: bool = False, chunk: int = H.CHUNK) -> DataFrame:
    """Causal filter of any order, its state carried along each key; a null sample counts as 0.

    Rows stream sorted by key; the samples of one key in an Arrow batch are filtered at once. Where
    the order is one dense index (``dense``), a key is many chunks, unless the filter never forgets.
    """
    slots = df.withColumn(name, F.lit(None).cast("double"))
    b, a = np.asarray(b, float), np.asarray(a, float)
    if dense and (reach := H.reach_of(a)) is not None:
        return _iir_by_chunk(df, keys, order[0], value, b, a, name, chunk, max(reach, len(b)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            held = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True)) or [()] * batch.num_rows
            x = batch.column(value).cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
            y, at = np.empty(len(x)), 0
            for key, rows in groupby(held):
                end = at + sum(1 for _ in rows)
                y[at:end], state = K.iir(b, a, x[at:end], state if key == now else None)
                now, at = key, end
            yield pa.RecordBatch.from_arrays([pa.array(y) if n == name else c for n, c in zip(batch.schema.names, batch.columns, strict=True)], names=batch.schema.names)

    dealt = slots.repartition(*keys) if keys else slots.coalesce(1)
    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(run, slots.schema)


#: Refractory times that a chunk of events spans.
SPANS = 1024


def _successors(t: np.ndarray, least: float) -> np.ndarray:
    """For each of sorted times the first event at least ``least`` later; their number where there is none."""
    return np.maximum(np.searchsorted(t, t + least, "left"), np.arange(1, len(t) + 1))


def _last_of_chain(nxt: np.ndarray) -> np.ndarray:
    """For each event the last that follows from it, by doubling the pointers."""
    n = len(nxt)
    here = np.append(np.where(nxt < n, nxt, np.arange(n)), n)
    while True:
        further = here[here]
        if (further == here).all():
            return here[:n]
        here = further


def greedy_refractory(df: DataFrame, keys: list[str], order: list[str], time: str, least: float, chunk: float | None = None) -> DataFrame:
    """Events at least ``least`` after the last one kept; a row without a time is no event and is left out.

    The time is cut into chunks (``SPANS`` times ``least``, or ``chunk``). What a chunk makes of the
    last event kept before it is a few steps: the chains of its first events, of which most
    meet, found by successor pointers. A key's steps (a row a chunk) are followed one
    after another, and each chunk then keeps its chain: a key is many tasks.
    """
    if not least > 0:
        return df.where(F.col(time).isNotNull())
    size = float(chunk or SPANS * least)
    if size < least:
        raise ValueError("a chunk is to be at least as long as the refractory time")
    value = F.col(time).cast("double")
    rows = df.where(F.col(time).isNotNull()).withColumns({"_t": value, "_chunk": F.floor(value / F.lit(size)).cast("long")})
    by = [*keys, "_chunk"]
    kinds = dict(rows.dtypes)
    head = ", ".join(f"`{k}` {kinds[k]}" for k in by)

    def steps(tab: pa.Table, groups: list[tuple[int, int]]) -> pa.Table:
        """Per chunk: for an event kept before, ``upto`` has the last starts (sorted) that end in the chain's last event ``ends``."""
        t = tab.column("_t").to_numpy()
        upto, ends = [], []
        for i, j in groups:
            own = t[i:j]
            # the first event that an earlier one lets pass is among these
            first = int(np.searchsorted(own, own[0] + least, "right")) + 1
            last = own[_last_of_chain(_successors(own, least))[:first]]
            final = np.append(last[1:] != last[:-1], True)
            upto.append(own[:first][final].tolist())
            ends.append(last[final].tolist())
        heads = tab.select(by).take(pa.array([i for i, _ in groups], pa.int64()))
        return heads.append_column("upto", pa.array(upto, pa.list_(pa.float64()))).append_column("ends", pa.array(ends, pa.list_(pa.float64())))

    def follow(tab: pa.Table) -> pa.Table:
        """The last event kept before each of a key's chunks; null before the first."""
        at = np.argsort(tab.column("_chunk").to_numpy())
        tab = tab.take(pa.array(at))
        last, before = None, []
        for upto, ends in zip(tab.column("upto").to_pylist(), tab.column("ends").to_pylist(), strict=True):
            before.append(last)
            i = 0 if last is None else int(np.searchsorted(upto, last + least, "left"))
            # beyond the listed starts is the chain of the last of them, unless nothing in the chunk is late enough
            last = ends[i] if i < len(ends) else last
        return tab.select(by).append_column("_last", pa.array(before, pa.float64()))

    def kept(tab: pa.Table, groups: list[tuple[int, int]]) -> pa.Table:
        t, last = tab.column("_t").to_numpy(), tab.column("_last").to_numpy(zero_copy_only=False)
        keep = np.zeros(len(t), bool)
        for i, j in groups:
            own = t[i:j]
            nxt = _successors(own, least)
            at = 0 if np.isnan(last[i]) else int(np.searchsorted(own, last[i] + least, "left"))
            while at < len(own):
                keep[i + at] = True
                at = nxt[at]
        return tab.drop_columns(["_t", "_chunk", "_last"]).filter(pa.array(keep))

    dealt = lambda d: d.repartition(*by).sortWithinPartitions(*by, "_t", *order)
    maps = dealt(rows.select(*by, "_t", *(c for c in order if c not in by))).mapInArrow(H.in_groups(by, steps), f"{head}, upto array<double>, ends array<double>")
    starts = maps.groupBy(*(keys or [F.lit(0).alias("_all")])).applyInArrow(follow, f"{head}, _last double")
    out = dealt(same_keys(rows, starts, by)).mapInArrow(H.in_groups(by, kept), df.schema)
    return out
