"""Exact medians by counting bits, against numpy."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.operators import selection as X
from sigspark.operators import signals as S


def bits(x: float) -> int:
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def test_keys_are_the_bits_of_doubles(spark):
    rng = random.Random(2)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf, 0.1, 1 / 3]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values += [v for e in range(-1074, 1024) for v in (2.0**e, math.nextafter(2.0**e, 0), -math.nextafter(2.0**e, math.inf))]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in [*values, math.nan, None]], "v double")
    rows = X.with_order_key(df, "v", "k").collect()
    assert all(r["k"] == bits(r["v"]) for r in rows if r["v"] is not None and not math.isnan(r["v"]))
    assert [r["k"] for r in rows if r["v"] is None] == [None]
    assert [r["k"] for r in rows if r["v"] is not None and math.isnan(r["v"])] == [(1 << 63) - 1]


@pytest.mark.parametrize("seed", range(3))
def test_medians(spark, seed):
    rng = random.Random(seed)
    draw = [lambda: rng.gauss(0, 1), lambda: float(rng.randrange(4)), lambda: 1e300 * rng.random(), lambda: -0.0, lambda: 7.0 + rng.random() * 1e-12]
    rows = [(k, rng.choice([0, 1, 2, None]), None if rng.random() < 0.1 else draw[k or 0](), rng.random()) for k in (0, 1, 2, 3, 4, None) for _ in range(rng.choice([1, 2, 101, 300]))]
    rows += [(9, 1, None, None)]
    df = spark.createDataFrame(rows, "k int, j int, v double, w double").repartition(5)
    got = {(r["k"], r["j"]): (r["a"], r["b"]) for r in X.medians(df, ["k", "j"], {"a": F.col("v"), "b": F.col("w") * 2}).collect()}
    assert set(got) == {r[:2] for r in rows}
    for key, (a, b) in got.items():
        for found, own in ((a, [r[2] for r in rows if r[:2] == key]), (b, [r[3] * 2 for r in rows if r[:2] == key and r[3] is not None])):
            own = [x for x in own if x is not None]
            assert (found is None) == (not own) and (not own or found == np.median(own))


def test_whole_tables_and_columns_of_the_same_name(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (10.0, None), (None, "z")], "v double, _c string").withColumn("j", F.lit("a"))
    assert X.medians(df, [], {"m": F.col("v")}).collect()[0]["m"] == 2.0
    assert sorted(r["v"] for r in S.remove_median(df, [], ["v"]).collect() if r["v"] is not None) == [-1.0, 0.0, 8.0]
    assert X.medians(df.where("false"), [], {"m": F.col("v")}).collect()[0]["m"] is None
    assert X.medians(df.where("false"), ["j"], {"m": F.col("v")}).count() == 0


def test_infinite_values_and_nan(spark):
    rows = [("a", math.inf), ("a", -math.inf), ("a", 3.0), ("b", math.nan), ("b", 1.0), ("b", 2.0), ("c", math.nan), ("c", 1.0)]
    got = {r["k"]: r["m"] for r in X.medians(spark.createDataFrame(rows, "k string, v double"), ["k"], {"m": F.col("v")}).collect()}
    assert got["a"] == 3.0 and got["b"] == 2.0 and math.isnan(got["c"])


def test_no_group_in_one_task(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    plan = S.remove_median(df, ["k"], ["v"])._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "median(" not in plan and "percentile" not in plan and "collect_list" not in plan
    assert "shiftright" in plan


def test_values_are_counted_before_anything_is_joined(spark):
    """One shuffle of counted values is used by all rounds; rows are neither joined nor sorted."""
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = X.middle_values(df, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Range (") == 1 and plan.count("ReusedExchange") >= X.ROUNDS - 1
    assert "SortAggregate" not in plan
