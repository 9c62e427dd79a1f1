"""Event algebra: interval filters, set difference, interleaving, text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigspark.functions import columns as C

from .ordered import first_difference


def interval_filter(events: DataFrame, keys: list[str], time: str, least: float, span: Column | None = None) -> DataFrame:
    """Events more than ``least`` after the previous raw one; the first is compared with time 0. A row without a time is no event. ``span`` as in ``ordered.with_index``."""
    return first_difference(events.where(F.col(time).isNotNull()), keys, [time], time, 0, "_gap", span).where(F.col("_gap") > least).drop("_gap")


def detect_only(detected: DataFrame, stimulated: DataFrame, on: list[str]) -> DataFrame:
    """Detections without a stimulation at the same key; order and duplicates of the left stay."""
    return detected.join(stimulated.select(*on).distinct(), on, "left_anti")


def interleave(runs: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, phase, time): a row for each start and each end."""
    return runs.select(*keys, F.explode(F.array(F.struct(F.lit("start").alias("phase"), F.col(start).alias("time")), F.struct(F.lit("end").alias("phase"), F.col(end).alias("time")))).alias("e")).select(*keys, "e.phase", "e.time")


def starts(events: DataFrame) -> DataFrame:
    return events.where("phase = 'start'")


def labelled(edges: DataFrame, kind: str, channel: str = "channel") -> DataFrame:
    return edges.withColumn("description", C.event_label(F.lit(kind), F.col("phase"), F.col(channel)))


def to_text(events: DataFrame, time: str = "time", description: str = "description") -> DataFrame:
    return events.select(C.event_line(time, description).alias("value"))


def from_text(lines: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """(keep, time, description, kind, phase, channel) of event lines."""
    keep = keep or []
    out = lines.select(*keep, C.event_time(value).alias("time"), C.event_text(value).alias("description"))
    part = lambda k: F.nullif(F.regexp_extract("description", r"^(\S+) (start|end) ([0-9]+)$", k), F.lit(""))
    return out.select(*keep, "time", "description", part(1).alias("kind"), part(2).alias("phase"), part(3).cast("int").alias("channel"))


def after_last(events: DataFrame, others: DataFrame, time: str, keys: list[str] | None = None) -> DataFrame:
    """Events not before the last of the others; one number is broadcast, or with keys one a key is joined."""
    if keys:
        last = others.groupBy(*keys).agg(F.max(time).alias("_last"))
        joined = events.join(last, keys, "left").where(F.col("_last").isNull() | (F.col(time) >= F.col("_last")))
        return joined.select(*events.columns)
    last = others.agg(F.max(time).alias("_last"))
    return events.join(F.broadcast(last), F.col("_last").isNull() | (F.col(time) >= F.col("_last"))).drop("_last")


def time_parts(events: DataFrame, time: str, size: int, before: int, after: int, part: str = "part") -> DataFrame:
    """events with ``part`` (time // size) and ``own``: a row near a border is also sent to the part beside it, there not own.

    What reaches at most ``before`` back and ``after`` ahead (both at most ``size``, the
    ends included) can then be computed for each part's own rows by itself, so
    that a long session is many tasks. Rows without a time are left out.
    """
    if not (0 <= before <= size and 0 <= after <= size):
        raise ValueError("a part is to be at least as long as what is looked back and ahead")
    own = F.floor(F.col(time) / F.lit(size)).cast("long")
    place = F.pmod(F.col(time), F.lit(size))
    reach = F.array_compact(F.array(own, F.when(place <= after, own - 1), F.when(place >= size - before, own + 1)))
    dealt = events.where(F.col(time).isNotNull()).withColumn(part, F.explode(reach))
    return dealt.withColumn("own", F.col(part) == own)


def with_previous(events: DataFrame, keys: list[str], order: list[str], which: Column, name: str) -> DataFrame:
    """events with ``name``: the first of ``order`` (the time) of the last row before each that ``which`` holds for; null where there is none."""
    before = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return events.withColumn(name, F.last(F.when(which, F.col(order[0])), ignorenulls=True).over(before))


def with_next(events: DataFrame, keys: list[str], time: str, which: Column, name: str) -> DataFrame:
    """events with ``name``: the time of the first row at or after each that ``which`` holds for; null where there is none.

    Read backward, so that each row looks at what is behind it once; shares the shuffle of ``with_previous``.
    """
    behind = W.partitionBy(*keys).orderBy(F.col(time).desc()).rangeBetween(W.unboundedPreceding, W.currentRow)
    return events.withColumn(name, F.last(F.when(which, F.col(time)), ignorenulls=True).over(behind))
