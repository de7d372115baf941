"""Column expressions shared by the operators that use DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
#: Elements of a running sum that are added up one by one before their totals are.
STRIDE = 256


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """Maximal runs of anything but the six blanks; an empty array for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def array_total(values: Column) -> Column:
    """Sum of a long array; 0 if empty."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def running_total(values: Column) -> Column:
    """Sums of the elements before each element, for a long array.

    Sums grow by appending, which copies; so they are taken inside strides and the strides are then shifted.
    """
    def inside(part: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("sums"))
        return F.aggregate(part, start, lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["sums"], F.array(a["at"])).alias("sums")))

    def shifted(array: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(array), F.lit(1)), F.lit(STRIDE))
        parts = F.transform(firsts, lambda i: inside(F.slice(array, i, STRIDE)))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<array<bigint>>").alias("sums"))
        whole = F.aggregate(parts, start, lambda a, p: F.struct(
            (a["at"] + p["at"]).alias("at"),
            F.concat(a["sums"], F.array(F.transform(p["sums"], lambda s: s + a["at"]))).alias("sums")))
        return F.flatten(whole["sums"])

    return bind(values, shifted)
