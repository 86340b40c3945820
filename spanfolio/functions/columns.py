"""Expressions shared by the operators; all stay inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column | str, digits: int) -> Column:
    """Round half to even, as numpy does; adding zero turns -0.0 into 0.0."""
    return F.bround(value, digits) + F.lit(0.0)


def half_life_decay(position: Column, half_life: float) -> Column:
    """``2 ** (-position / half_life)``, not normalised."""
    return F.exp(position * F.lit(-math.log(2.0) / half_life))


def is_missing(value: Column) -> Column:
    """Null or NaN. NaN compares as larger than any number, so it needs its own test."""
    return value.isNull() | F.isnan(value)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` with IEEE results where ``bottom`` is 0, instead of an error."""
    return (
        F.when(bottom != 0, F.try_divide(top, bottom))
        .when(top > 0, F.lit(float("inf")))
        .when(top < 0, F.lit(float("-inf")))
        .when(bottom == 0, F.lit(float("nan")))
    )


def tail_probability(n: Column, k: Column, p: float) -> Column:
    """Chance of ``k`` or more successes in ``n`` trials of chance ``p``.

    One pass over j = 0..n that carries the logarithm of the j-th term, so that
    long records do not underflow.
    """
    log_odds = math.log(p / (1.0 - p))
    start = F.struct(
        (n * F.lit(math.log(1.0 - p))).cast("double").alias("log_term"), F.lit(0.0).alias("total")
    )

    def add_term(acc: Column, j: Column) -> Column:
        total = acc["total"] + F.when(j >= k, F.exp(acc["log_term"])).otherwise(F.lit(0.0))
        step = F.when(
            j < n, F.log((n - j).cast("double") / (j + 1).cast("double")) + F.lit(log_odds)
        ).otherwise(F.lit(0.0))
        return F.struct((acc["log_term"] + step).alias("log_term"), total.alias("total"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), n.cast("long")), start, add_term)["total"]


def best_of(tail: Column, m: Column) -> Column:
    """Chance that the best of ``m`` independent records does that well."""
    return -F.expm1(m.cast("double") * F.log1p(-tail))
