"""Folds over long arrays whose cost is in proportion to their length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements of one fold: a fold copies what it has made so far at every step.
FOLD = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def folds(values: Column, fold: int = FOLD) -> Column:
    """The array cut into arrays of ``fold`` elements, the last one shorter; none of an empty array."""
    count = F.ceil(F.size(values) / fold).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(values, i * fold + 1, F.lit(fold)))


def running(values: Column, fold: int = FOLD) -> Column:
    """The sums of an array of whole numbers up to each of its elements."""
    none = F.array().cast("array<bigint>")

    def sums(part: Column, start: Column) -> Column:
        zero = F.struct(start.cast("bigint").alias("at"), none.alias("out"))
        return F.aggregate(part, zero, lambda a, x: F.struct((a["at"] + x).cast("bigint").alias("at"), F.concat(a["out"], F.array((a["at"] + x).cast("bigint"))).alias("out")), lambda a: a["out"])

    def of(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("bigint"), lambda a, x: (a + x).cast("bigint")))
        # the totals are few: one for each fold
        before = let(sums(totals, F.lit(0)), lambda t: F.concat(F.array(F.lit(0).cast("bigint")), F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0)))))
        return F.flatten(F.zip_with(parts, before, sums))

    return F.when(F.size(values) > 0, let(folds(values, fold), of)).otherwise(none)
