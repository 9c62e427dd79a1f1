"""The closed-loop audit against plain Python, and reruns."""

import datetime as dt
import json
import sys

import pytest
from pyspark.sql import functions as F

from jobs import closed_loop_audit as job

DDL = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
DAY = dt.timedelta(days=1)
EPOCH = dt.datetime(1970, 1, 1)


def plain(rows, detect, deliver, gap_s, window_s):
    us = lambda t: (t - EPOCH) // dt.timedelta(microseconds=1)
    out = []
    by = {}
    for event, ts, user, kind, *_ in rows:
        if ts is not None:
            by.setdefault(user, []).append((us(ts), event, kind, ts.date()))
    for user, own in by.items():
        found = sorted(r for r in own if r[2] == detect)
        for i, (t, event, _, day) in enumerate(found):
            if i and t - found[i - 1][0] <= gap_s * 10**6:
                continue
            gap = t - found[i - 1][0] if i and found[i - 1][3] == day else None
            after = [s[0] for s in own if s[2] == deliver and t <= s[0] <= t + window_s * 10**6]
            stim = min(after, default=None)
            ms = (t - us(dt.datetime.combine(day, dt.time()))) / 1000
            line = f"{ms:.6f}\t{'Detect' if stim is None else 'StimOn'} start 1"
            out.append((user, event, t, gap, stim, None if stim is None else stim - t, "detected_only" if stim is None else "closed", line, day))
    return sorted(out, key=str)


def random_rows(seed, n=400, days=4):
    import random

    rng = random.Random(seed)
    start = dt.datetime(2024, 3, 30)
    rows = [(i, start + dt.timedelta(seconds=rng.randrange(days * 86_400)), rng.choice([1, 1, 1, 2, None]), rng.choice(["view", "click", "other"]), 0.0, None) for i in range(n)]
    midnight = start + DAY
    edge = [(n + k, midnight + dt.timedelta(microseconds=us), 7, kind, 0.0, None) for k, (us, kind) in enumerate([(-600_000_000, "view"), (0, "view"), (0, "click"), (-1, "click"), (1, "click"), (600_000_000, "view"), (1_200_000_000, "view"), (1_800_000_001, "view"), (1_800_000_001, "view")])]
    return rows + edge + [(9_999, None, 1, "view", 0.0, None)]


def store(spark, rows, path, **extra):
    df = spark.createDataFrame(rows, DDL)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    df.write.mode("overwrite").parquet(path)
    return path


def rows_at(spark, out):
    return sorted((tuple(r) for r in job.read_output(spark, out).select("user_id", "event_id", "t_us", "gap_us", "stim_us", "latency_us", "outcome", "line", "day").collect()), key=str)


CONFIG = {"detect": "view", "deliver": "click", "gap_s": 600, "window_s": 3600, "first_day": None, "last_day": None}


@pytest.mark.parametrize("gap,window", [(600, 3600), (0, 0), (86_400, 86_400)])
def test_against_plain_python(spark, tmp_path, gap, window):
    rows = random_rows(gap)
    src = store(spark, rows, f"{tmp_path}/events", own="x", _day="y", part=1)
    out = f"{tmp_path}/out"
    said = job.run(spark, src, out, CONFIG | {"gap_s": gap, "window_s": window})
    want = plain(rows, "view", "click", gap, window)
    assert rows_at(spark, out) == want
    assert said == {"read": sum(r[3] in ("view", "click") for r in rows), "written": len(want), "closed": sum(r[6] == "closed" for r in want)}


def test_a_rerun_leaves_the_same(spark, tmp_path):
    rows = random_rows(3)
    src, out = store(spark, rows, f"{tmp_path}/events"), f"{tmp_path}/out"
    for _ in range(2):
        job.run(spark, src, out, CONFIG)
        assert rows_at(spark, out) == plain(rows, "view", "click", 600, 3600)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_days_are_replaced_by_themselves(spark, tmp_path):
    rows, out = random_rows(5), f"{tmp_path}/out"
    src = store(spark, rows, f"{tmp_path}/events")
    whole = plain(rows, "view", "click", 600, 3600)
    for day in sorted({r[8] for r in whole}):
        job.run(spark, src, out, CONFIG | {"first_day": str(day), "last_day": str(day)})
        assert rows_at(spark, out) == [r for r in whole if r[8] <= day]
    # corrected input: a day loses its detections, another gains one; only the second is run, then the first
    gone = dt.date(2024, 3, 31)
    fixed = [r for r in rows if r[1] is None or r[1].date() != gone] + [(5_000, dt.datetime(2024, 4, 1, 12), 88, "view", 0.0, None)]
    src = store(spark, fixed, f"{tmp_path}/fixed")
    want = plain(fixed, "view", "click", 600, 3600)
    job.run(spark, src, out, CONFIG | {"first_day": "2024-04-01", "last_day": "2024-04-02"})
    assert rows_at(spark, out) == sorted([r for r in want if r[8] >= dt.date(2024, 4, 1)] + [r for r in whole if r[8] <= gone], key=str)
    job.run(spark, src, out, CONFIG | {"first_day": str(gone), "last_day": str(gone)})
    assert [r for r in rows_at(spark, out) if r[8] != dt.date(2024, 3, 30)] == [r for r in want if r[8] != dt.date(2024, 3, 30)]


def test_only_the_days_are_read(spark, tmp_path):
    src = store(spark, random_rows(1), f"{tmp_path}/events")
    df = job._within(spark.read.parquet(src), "ts", dt.date(2024, 3, 31), dt.date(2024, 3, 31), 60, 60)
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(ts,2024-03-30T23:59)" in pushed and "LessThanOrEqual(ts,2024-04-01T00:01)" in pushed


def test_one_scan_one_shuffle(spark, tmp_path):
    src = store(spark, random_rows(1), f"{tmp_path}/events")
    plan = job.audit(spark.read.parquet(src), "view", "click", 600, 3600)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(user_id" in plan and "_day" in plan[plan.index("hashpartitioning") :][:80]


def test_empty_input_and_bad_settings(spark, tmp_path):
    src = store(spark, [], f"{tmp_path}/events")
    assert job.run(spark, src, f"{tmp_path}/out", CONFIG) == {"read": 0, "written": 0, "closed": 0}
    assert rows_at(spark, f"{tmp_path}/out") == []
    with pytest.raises(ValueError):
        job.run(spark, src, f"{tmp_path}/out", CONFIG | {"gap_s": 86_401})


def test_command_line(spark, tmp_path, monkeypatch):
    seen = {}

    class Fake:
        @staticmethod
        def stop():
            seen["stopped"] = True

    monkeypatch.setattr(job.SparkSession.Builder, "getOrCreate", lambda self: Fake)
    monkeypatch.setattr(job, "run", lambda *a: seen.update(args=a))
    (tmp_path / "c.json").write_text(json.dumps(CONFIG))
    job.main(["--events", "e", "--out", "o", "--config", str(tmp_path / "c.json"), "--first-day", "2024-01-02"])
    assert seen["stopped"] and seen["args"][1:] == ("e", "o", CONFIG | {"first_day": "2024-01-02"}, None)


def test_nothing_of_the_text_operators_is_imported():
    import subprocess

    code = "import sys, jobs.queries; assert not [m for m in sys.modules if m.startswith('sigspark.llm') or m == 'corpus_pipeline']"
    subprocess.run([sys.executable, "-c", code], check=True)


def test_summary(spark, tmp_path):
    import statistics

    rows, out, summary = random_rows(11), f"{tmp_path}/out", f"{tmp_path}/summary"
    src = store(spark, rows, f"{tmp_path}/events")
    want = plain(rows, "view", "click", 600, 3600)
    said = job.run(spark, src, out, CONFIG, summary)
    got = {(r.user_id, r.day): r for r in job.read_output(spark, summary, job.SUMMARY).collect()}
    assert set(got) == {(r[0], r[8]) for r in want} and said["sessions"] == len(got)
    for key, r in got.items():
        own = [w for w in want if (w[0], w[8]) == key]
        waits = [w[5] for w in own if w[5] is not None]
        assert (r.detections, r.answered) == (len(own), len(waits))
        assert r.median_us == (statistics.median(waits) if waits else None)
        assert r.mean_us == (pytest.approx(statistics.mean(waits)) if waits else None)
        assert r.deviation_us == (pytest.approx(statistics.stdev(waits)) if len(waits) > 1 else None)
    # a day by itself replaces its own part only, and leaves the same
    job.run(spark, src, out, CONFIG | {"first_day": "2024-03-31", "last_day": "2024-03-31"}, summary)
    assert {(r.user_id, r.day): r for r in job.read_output(spark, summary, job.SUMMARY).collect()} == got


def test_a_broken_run_is_mended_by_the_next(spark, tmp_path, monkeypatch):
    rows, out = random_rows(2), f"{tmp_path}/out"
    src = store(spark, rows, f"{tmp_path}/events")
    job.run(spark, src, out, CONFIG | {"first_day": "2024-03-30", "last_day": "2024-03-31"})
    monkeypatch.setattr(job, "_within", lambda df, column, *a: (_ for _ in ()).throw(RuntimeError("stopped")) if column == "ts" else df)
    with pytest.raises(RuntimeError):
        job.run(spark, src, out, CONFIG)
    monkeypatch.undo()
    job.run(spark, src, out, CONFIG)
    assert rows_at(spark, out) == plain(rows, "view", "click", 600, 3600)
