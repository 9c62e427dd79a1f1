"""Order within a session without a session in one task."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.operators import events as E
from sigspark.operators import ordered as O


def greedy(times, least):
    last, out = None, []
    for t in times:
        if last is None or t >= last + least:
            out.append(t)
            last = t
    return out


@pytest.mark.parametrize("seed", range(4))
def test_greedy_refractory_by_chunks(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in ("a", "b", None):
        t = rng.choice([-50.0, 0.0, 1e6])
        for i in range(rng.choice([1, 40, 400])):
            t += rng.choice([0.0, 0.0, 0.1, 0.4, 1.0, 3.0, 40.0]) * rng.random()
            rows.append((k, round(t, 3), i))
    rows.append(("a", None, 0))
    df = spark.createDataFrame(rows, "k string, t double, i long").repartition(3)
    for least, chunk in ((1.0, 1.0), (1.0, 2.5), (0.25, 7.0), (5.0, None), (100.0, 100.0)):
        got = sorted(map(str, ((r.k, r.t, r.i) for r in O.greedy_refractory(df, ["k"], ["t", "i"], "t", least, chunk).collect())))
        want = []
        for k in ("a", "b", None):
            own = sorted((t, i) for j, t, i in rows if j == k and t is not None)
            last = None
            for t, i in own:
                if last is None or t >= last + least:
                    want.append((k, t, i))
                    last = t
        assert got == sorted(map(str, want))
    assert O.greedy_refractory(df, ["k"], ["t"], "t", 0.0).count() == len(rows) - 1
    with pytest.raises(ValueError):
        O.greedy_refractory(df, ["k"], ["t"], "t", 2.0, 1.0)


def test_greedy_refractory_without_keys_and_with_whole_times(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("t"), F.lit("x").alias("_chunk2"))
    got = sorted(r.t for r in O.greedy_refractory(df, [], ["t"], "t", 10, 20).collect())
    assert got == greedy(range(100), 10)
    assert O.greedy_refractory(df.limit(0), [], ["t"], "t", 10).count() == 0


def test_a_million_events_of_one_key_are_many_tasks(spark):
    n = 1_000_000
    df = spark.range(0, n, 1, 8).select(F.lit("a").alias("k"), (F.col("id") * 0.01 + F.pmod(F.col("id") * 7919, F.lit(13)) * 0.0001).alias("t"))
    out = O.greedy_refractory(df, ["k"], ["t"], "t", 0.5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert dealt and all("_chunk" in d or "FlatMapGroupsInArrow" in plan for d in dealt)
    times = np.arange(n) * 0.01 + np.arange(n) * 7919 % 13 * 0.0001
    want = greedy(sorted(times.tolist()), 0.5)
    got = out.agg(F.count("*"), F.sum("t")).first()
    assert got[0] == len(want) and got[1] == pytest.approx(sum(want), rel=1e-12)


@pytest.fixture(scope="module")
def sessions(spark):
    rng = random.Random(8)
    rows = [(k, rng.randrange(50), i, None if rng.random() < 0.2 else rng.random()) for k in ("a", "b", None) for i in range(120)]
    return spark.createDataFrame(rows, "k string, t long, i long, v double").repartition(3)


SPAN = "floor(t / 7)"


@pytest.mark.parametrize("span", [SPAN, "t", "0"])
def test_spans_give_what_sessions_give(spark, sessions, span):
    span = F.expr(span)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    k, order = ["k"], ["t", "i"]
    assert same(O.with_index(sessions, k, order), O.with_index(sessions, k, order, span=span))
    assert same(O.with_lag(sessions, k, order, "v", 9.0), O.with_lag(sessions, k, order, "v", 9.0, span=span))
    assert same(O.with_lag(sessions, k, order, "v"), O.with_lag(sessions, k, order, "v", span=span))
    assert same(O.first_difference(sessions, k, order, "v"), O.first_difference(sessions, k, order, "v", span=span))
    assert same(O.every_other(sessions, k, order), O.every_other(sessions, k, order, span=span))
    assert same(E.interval_filter(sessions, k, "t", 1), E.interval_filter(sessions, k, "t", 1, span=span))
    assert O.with_index(sessions.where("false"), k, order, span=span).count() == 0


def test_no_sort_of_a_whole_session(spark, sessions):
    for out in (O.with_index(sessions, ["k"], ["t", "i"], span=F.expr(SPAN)), O.first_difference(sessions, ["k"], ["t", "i"], "v", span=F.expr(SPAN))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        # windows over a key alone see a row for each span
        for w in re.findall(r"Window \[([^\n]*)\n", plan):
            assert "_span" in w


def test_time_parts(spark):
    df = spark.createDataFrame([(t,) for t in (-11, -10, -1, 0, 1, 9, 10, 19, 20)] + [(None,)], "t long")
    got = sorted((r.part, r.t) for r in E.time_parts(df, "t", 10, 1, 0).where("NOT own").collect())
    # the last of a part is also seen by the next one, the first of a part by the one before
    assert got == sorted([(-1, -11), (0, -1), (1, 9), (2, 19), (-2, -10), (-1, 0), (0, 10), (1, 20)])
    assert E.time_parts(df, "t", 10, 10, 10).where("own").count() == 9
    with pytest.raises(ValueError):
        E.time_parts(df, "t", 10, 11, 0)


def test_previous_and_next(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "x"), ("a", 5, "x"), ("a", 7, "y"), (None, 3, "y"), (None, 4, "x")]
    df = spark.createDataFrame(rows, "k string, t long, c string")
    got = {(r.k, r.t, r.c): r.n for r in E.with_next(df, ["k"], "t", F.col("c") == "y", "n").collect()}
    assert got == {("a", 1, "x"): 2, ("a", 2, "y"): 2, ("a", 2, "x"): 2, ("a", 5, "x"): 7, ("a", 7, "y"): 7, (None, 3, "y"): 3, (None, 4, "x"): None}
    got = {(r.k, r.t, r.c): r.n for r in E.with_previous(df, ["k"], ["t", "c"], F.col("c") == "x", "n").collect()}
    assert got == {("a", 1, "x"): None, ("a", 2, "x"): 1, ("a", 2, "y"): 2, ("a", 5, "x"): 2, ("a", 7, "y"): 5, (None, 3, "y"): None, (None, 4, "x"): None}


def test_a_join_without_keys_takes_one_row(spark):
    from sigspark.operators.joins import same_keys

    df = spark.range(5)
    assert sorted(map(tuple, same_keys(df, spark.range(1).select(F.lit(7).alias("m"), F.lit(None).cast("int").alias("n")), []).collect())) == [(i, 7, None) for i in range(5)]
    assert same_keys(df, spark.range(0).select(F.lit(7).alias("m")), []).count() == 0
    with pytest.raises(Exception, match="one row"):
        same_keys(df, spark.range(2).select(F.col("id").alias("m")), []).collect()
