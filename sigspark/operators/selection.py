"""Exact distributed selection: medians of any number of rows without a group in one task.

The rows of each value of a group are counted first, combined before the
shuffle, so that ties are counted, never listed. The values, doubles, become
64-bit whole numbers in the same order (sign, exponent, mantissa), by
arithmetic that Spark compiles. Four rounds count 16 bits each: a round sums,
in each group, the counts of the values that share the bits found so far by
their next 16 bits, and goes on with the sum that holds the wanted rank. What
is joined and ordered by key is at most 65,536 sums for the same bits of a
group. The plan is lazy; all rounds use the one shuffle of the values, so that
the input is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import same_keys

BITS, ROUNDS = 16, 4
#: Of the layout of doubles: mantissa bits, the bias and the least exponent of a normal number.
MANTISSA, BIAS, LEAST = 52, 1023, -1022


def with_order_key(df: DataFrame, value: str, name: str) -> DataFrame:
    """df with a long that is ordered as the double is; zeros are equal, NaN comes last, null stays null."""
    x, a, two = F.col(value), F.abs(value), F.lit(2.0)
    size = F.when((a > 0) & (a < float("inf")), a).otherwise(1.0)
    # a logarithm may be off by one beside a power of two; powers of two themselves are exact
    steps = df.withColumn("_size", size).withColumn("_near", F.greatest(F.floor(F.log2("_size")), F.lit(LEAST)).cast("int"))
    more = (F.col("_near") < BIAS) & (F.col("_size") >= F.pow(two, F.least(F.col("_near") + 1, F.lit(BIAS))))
    steps = steps.withColumn("_e", F.col("_near") + F.when(F.col("_size") < F.pow(two, "_near"), -1).when(more, 1).otherwise(0))
    steps = steps.withColumn("_e", F.greatest(F.least("_e", F.lit(BIAS)), F.lit(LEAST)))
    # below the least exponent the part is less than 1, which takes the one off the exponent field
    bits = (F.col("_e") + BIAS).cast("long") * (1 << MANTISSA) + ((F.col("_size") / F.pow(two, "_e") - 1.0) * float(1 << MANTISSA)).cast("long")
    bits = F.when(a == 0, F.lit(0).cast("long")).when(a == float("inf"), F.lit((2 * BIAS + 1) << MANTISSA)).otherwise(bits)
    key = F.when(x.isNull(), F.lit(None).cast("long")).when(F.isnan(x), F.lit((1 << 63) - 1)).when(x < 0, -bits).otherwise(bits)
    return steps.withColumn(name, key).drop("_size", "_near", "_e")


def _counted(df: DataFrame, keys: list[str], values: list[Column]) -> DataFrame:
    """(keys, _c, _v, _n, _key): a row for each different value that is not null, with its number of rows."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("c"), v.cast("double").alias("v")) for i, v in enumerate(values))))
    rows = df.select(*keys, each.alias("_e")).where("_e.v IS NOT NULL").select(*keys, F.col("_e.c").alias("_c"), F.col("_e.v").alias("_v"))
    return with_order_key(rows.groupBy(*keys, "_c", "_v").agg(F.count("*").alias("_n")), "_v", "_key")


def middle_values(df: DataFrame, keys: list[str], values: list[Column]) -> DataFrame:
    """(keys, _c, _m): the median of each column by its number; groups without values have no row."""
    by = [*keys, "_c"]
    rows = _counted(df, keys, values)
    state: DataFrame | None = None
    for r in range(ROUNDS):
        shift = BITS * (ROUNDS - 1 - r)
        if r < ROUNDS - 1:
            counts = rows.groupBy(*by, F.shiftright("_key", shift).alias("_next")).agg(F.sum("_n").alias("_n"))
        else:
            counts = rows.select(*by, F.col("_key").alias("_next"), "_n", "_v")
        parts = by if state is None else [*by, "_bits"]
        if state is not None:
            counts = same_keys(counts.withColumn("_bits", F.shiftright("_next", BITS)), state, parts)
        counts = counts.withColumn("_upto", F.sum("_n").over(W.partitionBy(*parts).orderBy("_next")))
        if state is None:
            # ranks from 0: one for an odd number of values, two for an even one
            counts = counts.withColumn("_all", F.sum("_n").over(W.partitionBy(*parts)))
            counts = counts.withColumn("_ranks", F.array_distinct(F.array(F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2))))
        below = F.col("_upto") - F.col("_n")
        held = F.transform(F.filter("_ranks", lambda k: (k >= below) & (k < F.col("_upto"))), lambda k: k - below)
        state = counts.select(*by, F.col("_next").alias("_bits"), held.alias("_ranks"), *(["_v"] if r == ROUNDS - 1 else [])).where(F.size("_ranks") > 0)
    return state.groupBy(*by).agg((F.min("_v") * 0.5 + F.max("_v") * 0.5).alias("_m"))


def medians(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """(keys, names): exact medians by group, of the middle two where there are two; null where a group has no values. Null keys are a group."""
    names = list(values)
    found = middle_values(df, keys, list(values.values()))
    wide = found.groupBy(*keys).agg(*(F.max(F.when(F.col("_c") == i, F.col("_m"))).alias(n) for i, n in enumerate(names)))
    return same_keys(df.select(*keys).distinct(), wide, keys, "left") if keys else wide
