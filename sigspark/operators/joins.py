"""Joins that lose no row to a null key."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that keeps rows with null keys: a null is equal to a null. The columns of right follow those of left.

    Without keys, right is one row of statistics; more are an error, none gives no rows.
    """
    if not keys:
        # the aggregate is one row whatever right is, so that nothing unbounded is broadcast
        one = right.agg(F.count("*").alias("_rows"), *(F.first(c).alias(c) for c in right.columns))
        too_many = F.raise_error(F.lit("without keys, the right side of a join is one row")).cast("boolean")
        return left.crossJoin(F.broadcast(one.where(F.when(F.col("_rows") > 1, too_many).otherwise(F.col("_rows") == 1)).drop("_rows")))
    other = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    on = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    return left.join(other, on, how).drop(*(f"_key_{k}" for k in keys))
