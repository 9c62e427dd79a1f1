"""Columns over long arrays and texts whose cost does not grow with the square of their length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What tells a decoder that four bytes are one code point, the highest byte first.
_MARK = bytes([0, 0, 0xFE, 0xFF])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """The values of an array combined up to each place, by doubling the reach: n log n steps.

    A fold that appends to its result would copy it at each step.
    """

    def scan(array: Column) -> Column:
        def double(acc: Column, k: Column) -> Column:
            step = F.call_function("shiftleft", F.lit(1), k)
            return F.transform(acc, lambda v, i: F.when(i < step, v).otherwise(join(F.get(acc, i - step), v)))

        rounds = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(F.size(array))).cast("int") - 1, F.lit(0)))
        return F.when(F.size(array) > 1, F.aggregate(rounds, array, double)).otherwise(array)

    return let(values, scan)


def running_sum(values: Column) -> Column:
    return running(values, lambda a, b: a + b)


def cut(text: Column, stretches: Column) -> Column:
    """Substrings of text for array<struct<start, end>>: code points, 0-based, end exclusive.

    Over four bytes a code point, a place is found without a walk from the start.
    """

    def pieces(raw: Column) -> Column:
        return F.transform(stretches, lambda s: F.decode(F.concat(F.lit(_MARK), F.substring(raw, 4 * s["start"] + 1, 4 * (s["end"] - s["start"]))), "UTF-32"))

    return let(F.encode(text, "UTF-32"), pieces)
