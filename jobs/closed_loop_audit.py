"""Closed-loop audit: which detections of a session were answered by a stimulation, by day.

    python -m jobs.closed_loop_audit --events PATH --out PATH [--summary PATH] [--config FILE] [--first-day D] [--last-day D]

Reads the event table, keeps the detections that come more than ``gap_s`` after
the detection before them, finds the first stimulation at or after each within
``window_s``, and writes a row for each kept detection, with its line of an
event file, as Parquet partitioned by day:

    day, user_id, event_id, t_us, gap_us, stim_us, latency_us, outcome, line

``outcome`` is ``closed`` or ``detected_only``; times are microseconds, gap_us
is null where no detection came before on the same day, and the line's time
is milliseconds from midnight.

With a summary path, a row for each session and day goes there as well, from
what was written: detections, answers, and mean, deviation and exact median of
the answers' latencies.

With days given, only they are read (and as much before and after as the gap
and the window reach) and only their partitions are replaced; a day that has
no detection any more loses its rows. A run that is repeated, or that follows
a broken one, leaves the same files' contents. Sessions are cut by day, so
that one that holds a third of all events is many tasks. Rows without a time
are no events; a null user is a session.
"""

from __future__ import annotations

import argparse
import json
import logging
from datetime import date, datetime, timedelta
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.functions import columns as C
from sigspark.operators import events as E
from sigspark.operators import signals as S
from sigspark.operators.joins import same_keys

log = logging.getLogger("closed_loop_audit")
CONFIG = Path(__file__).with_suffix(".json")
DAY_US = 86_400_000_000
SCHEMA = "user_id long, event_id long, t_us long, gap_us long, stim_us long, latency_us long, outcome string, line string, day date"
SUMMARY = "user_id long, detections long, answered long, mean_us double, deviation_us double, median_us double, day date"


def read_config(path: str | Path = CONFIG) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def micros(time: str) -> Column:
    """Microseconds since 1970 of a time without zone, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(time).cast("timestamp_ntz"))


def audit(events: DataFrame, detect: str, deliver: str, gap_s: int, window_s: int) -> DataFrame:
    """The rows of SCHEMA for events(user_id, event_id, ts, event_type)."""
    gap, window = gap_s * 1_000_000, window_s * 1_000_000
    timed = events.where(F.col("event_type").isin(detect, deliver)).select("user_id", "event_id", "event_type", micros("ts").alias("t_us"))
    parts = E.time_parts(timed, "t_us", DAY_US, gap, window, "_day")
    keys, detection = ["user_id", "_day"], F.col("event_type") == detect
    # what came before the rows of a part is not within the gap of its own rows
    out = E.with_previous(parts, keys, ["t_us", "event_id"], detection, "_last")
    out = E.with_next(out, keys, "t_us", F.col("event_type") == deliver, "_next").where(detection & F.col("own"))
    since, latency = F.col("t_us") - F.col("_last"), F.col("_next") - F.col("t_us")
    same_day = F.when(F.col("_last") >= F.col("_day") * DAY_US, since)
    out = out.where(F.col("_last").isNull() | (since > gap)).withColumns({"gap_us": same_day, "latency_us": F.when(latency <= window, latency)})
    out = out.withColumn("stim_us", F.col("t_us") + F.col("latency_us"))
    out = out.withColumn("outcome", F.when(F.col("latency_us").isNull(), "detected_only").otherwise("closed"))
    label = F.when(F.col("outcome") == "closed", C.event_label(F.lit("StimOn"), F.lit("start"), F.lit(1))).otherwise(C.event_label(F.lit("Detect"), F.lit("start"), F.lit(1)))
    line = C.event_line((F.col("t_us") - F.col("_day") * DAY_US) / 1e6, label)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.col("_day").cast("int"))
    return out.select("user_id", "event_id", "t_us", "gap_us", "stim_us", "latency_us", "outcome", line.alias("line"), day.alias("day"))


def _within(df: DataFrame, column: str, first: date | None, last: date | None, before_s: int = 0, after_s: int = 0) -> DataFrame:
    """Rows of the days first..last, and as many seconds beside them; the bounds reach the scan."""
    kind = "date" if dict(df.dtypes)[column] == "date" else "timestamp_ntz"
    if first is not None:
        low = datetime.combine(first, datetime.min.time()) - timedelta(seconds=before_s)
        df = df.where(F.col(column) >= F.lit(str(low)).cast(kind))
    if last is not None:
        high = datetime.combine(last, datetime.min.time()) + timedelta(days=1, seconds=after_s)
        df = df.where(F.col(column) <= F.lit(str(high)).cast(kind) if after_s else F.col(column) < F.lit(str(high)).cast(kind))
    return df


def read_output(spark: SparkSession, out: str, schema: str = SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(out)


def summarised(detections: DataFrame) -> DataFrame:
    """The rows of SUMMARY for rows of SCHEMA."""
    keys = ["user_id", "day"]
    counts = detections.groupBy(*keys).agg(F.count("*").alias("detections"), F.count("latency_us").alias("answered"), F.avg("latency_us").alias("mean_us"), F.stddev_samp("latency_us").alias("deviation_us"))
    middle = S.medians(detections, keys, {"median_us": "latency_us"})
    return same_keys(counts, middle, keys).select("user_id", "detections", "answered", "mean_us", "deviation_us", "median_us", "day")


def _written(rows: DataFrame, out: str, schema: str, first: date | None, last: date | None) -> DataFrame:
    """rows in the place of all that is at ``out``, or of its days first..last, as read back."""
    spark, ranged = rows.sparkSession, first is not None or last is not None
    before = _days_before(spark, out, schema, first, last) if ranged else set()
    rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if ranged else "static").partitionBy("day").parquet(out)
    if before:
        # days of this run that have rows from an earlier one only
        for day in sorted(before - _days(rows)):
            rows.drop("day").limit(0).write.mode("overwrite").parquet(f"{out.rstrip('/')}/day={day}")
    return _within(read_output(spark, out, schema), "day", first, last)


def _days(df: DataFrame) -> set[date]:
    """Days that have rows: as many rows as there are days."""
    return {r["day"] for r in df.select("day").distinct().collect()}


def _days_before(spark: SparkSession, out: str, schema: str, first: date | None, last: date | None) -> set[date]:
    try:
        return _days(_within(read_output(spark, out, schema), "day", first, last))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()  # the first run


def run(spark: SparkSession, events: str, out: str, config: dict, summary: str | None = None) -> dict:
    """One run over a path of events into ``out``, and its summary; returns what was read and written."""
    first, last = (date.fromisoformat(config[k]) if config.get(k) else None for k in ("first_day", "last_day"))
    gap, window = int(config["gap_s"]), int(config["window_s"])
    if not 0 <= gap <= 86_400 or not 0 <= window <= 86_400:
        raise ValueError("gap_s and window_s are 0 to 86400 seconds")
    table = spark.read.parquet(events).select("user_id", "event_id", "ts", "event_type").where(F.col("event_type").isin(config["detect"], config["deliver"]))
    read = _within(table, "ts", first, last, gap, window)
    rows = _within(audit(read, config["detect"], config["deliver"], gap, window), "day", first, last)
    # a run over all days replaces all there is, another one its days
    made = _written(rows, out, SCHEMA, first, last)
    n, closed = made.agg(F.count("*"), F.count_if(F.col("outcome") == "closed")).first()
    said = {"read": read.count(), "written": n, "closed": closed}
    if summary:
        said["sessions"] = _written(summarised(made), summary, SUMMARY, first, last).count()
        log.info("wrote %d summaries of a session's day to %s", said["sessions"], summary)
    log.info("read %d events of %s, days %s to %s", said["read"], events, first or "first", last or "last")
    log.info("wrote %d detections, %d of them answered, to %s", said["written"], said["closed"], out)
    return said


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Which detections were answered by a stimulation, by day.")
    p.add_argument("--events", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--summary")
    p.add_argument("--config", default=CONFIG)
    p.add_argument("--first-day")
    p.add_argument("--last-day")
    a = p.parse_args(args)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    config = read_config(a.config) | {k: v for k, v in (("first_day", a.first_day), ("last_day", a.last_day)) if v}
    spark = SparkSession.builder.appName("closed_loop_audit").getOrCreate()
    try:
        run(spark, a.events, a.out, config, a.summary)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
