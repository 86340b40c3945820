"""Exact elements of sorted groups without sorting a whole group.

A sketch of each large group, mergeable and of bounded size, gives a value range that
holds the wanted rank; exact counts then tell how many rows lie below the range, and only
the distinct values inside it are put in order. While that is still too much, a range is
refined by a sketch of the rows inside. Groups of at most SMALL rows are their own range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanfolio.sources.workspace import materialise

#: Rows of a group, or of a range, that one task may put in order.
SMALL = 200_000
#: A sketch finds a rank to one part in so many of its rows.
ACCURACY = 10_000

Rank = Callable[[Column], Column]


def _same(a: str, b: str, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def _with(rows: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    extra = [c for c in ranges.columns if c not in keys]
    return rows.alias("x").join(ranges.alias("y"), _same("x", "y", keys)).select("x.*", *(f"y.{c}" for c in extra))


def ranges(rows: DataFrame, keys: list[str], value: str, rank: Rank, last: Rank, small: int = SMALL, accuracy: int = ACCURACY, sizes: DataFrame | None = None) -> DataFrame | None:
    """``keys, n, below, low, high``: ranges of values that hold the elements from ``rank`` to ``last``, one for each group.

    ``below`` rows of the group are less than ``low``; null bounds are open. None if no
    group has more than ``small`` rows.
    """
    if sizes is None:
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    left = sizes.agg(F.max("n")).first()[0] or 0
    if left <= small:
        return None
    found = None
    while left > small:
        # relative places wanted among the rows that are still inside
        part = _inside(rows, found, keys, value) if found is not None else rows
        held = materialise(sizes.withColumns({"inside": F.col("n"), "below": F.lit(0).cast("long")}) if found is None else found, "ranges")
        margin = 2.0 / accuracy
        # the sketch answers for a grid of shares; the wanted ones differ by group
        grid = [i / 1000 for i in range(1001)]
        marks = part.groupBy(*keys).agg(F.percentile_approx(value, grid, accuracy).alias("marks"))
        places = _with(held, marks, keys)
        share = lambda k: (k - F.col("below")) / F.col("inside")
        low = F.greatest(F.floor((share(rank(F.col("n"))) - margin) * 1000), F.lit(0)).cast("int")
        high = F.least(F.ceil((share(last(F.col("n"))) + margin) * 1000), F.lit(1000)).cast("int")
        big = F.col("inside") > small
        bounds = {
            "low": F.when(big & (low > 0), F.get("marks", low)).otherwise(F.lit(None) if found is None else F.col("low")),
            "high": F.when(big & (high < 1000), F.get("marks", high)).otherwise(F.lit(None) if found is None else F.col("high")),
        }
        bounded = places.withColumns(bounds).select(*keys, "n", "low", "high")
        bounded = materialise(bounded, "ranges")
        counted = _with(rows, bounded, keys).groupBy(*keys).agg(
            F.first("n").alias("n"),
            F.first("low").alias("low"),
            F.first("high").alias("high"),
            F.count_if(F.col(value) < F.col("low")).alias("below"),
            F.count_if(F.coalesce(F.col(value) >= F.col("low"), F.lit(True)) & F.coalesce(F.col(value) <= F.col("high"), F.lit(True))).alias("inside"),
        )
        counted = materialise(counted, "ranges")
        distinct = _inside(rows, counted, keys, value).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
        now = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("d")).agg(F.max("d")).first()[0] or 0
        found, stuck, left = counted, now >= left, now
        if stuck:  # as many values between two marks as before: the range can't get smaller this way
            break
    return found


def _inside(rows: DataFrame, found: DataFrame, keys: list[str], value: str) -> DataFrame:
    kept = _with(rows, found.select(*keys, "low", "high"), keys)
    return kept.where((F.col("low").isNull() | (F.col(value) >= F.col("low"))) & (F.col("high").isNull() | (F.col(value) <= F.col("high")))).drop("low", "high")


def elements(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, Rank], small: int = SMALL, accuracy: int = ACCURACY, sizes: DataFrame | None = None) -> DataFrame:
    """``keys, n`` and for each name of ``wanted`` the element of that rank (from 1) among the group's sorted values.

    A rank is a function of the column ``n``; the ranks of a group must lie close to each
    other, the least first. ``sizes`` (``keys, n``) spares counting the rows if it is known. Null values aren't counted; NaN is greater than any number.
    """
    rows = rows.select(*keys, value).where(F.col(value).isNotNull())
    ranks = list(wanted.values())
    found = ranges(rows, keys, value, ranks[0], ranks[-1], small, accuracy, sizes)
    part = rows if found is None else _inside(rows, found, keys, value)
    values = part.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    group = Window.partitionBy(*keys)
    if found is None:
        values = values.withColumns({"n": F.sum("c").over(group), "below": F.lit(0)})
    else:
        values = _with(values, found.select(*keys, "n", "below"), keys)
    upto = F.col("below") + F.sum("c").over(group.orderBy(value))
    values = values.withColumn("upto", upto)
    picked = {name: F.max(F.when((F.col("upto") >= k(F.col("n"))) & (F.col("upto") - F.col("c") < k(F.col("n"))), F.col(value))) for name, k in wanted.items()}
    out = values.groupBy(*keys).agg(F.max("n").alias("n"), *(v.alias(f"{name}_") for name, v in picked.items()))
    checked = {name: F.when(F.col(f"{name}_").isNull(), F.raise_error(F.lit("a rank lies outside its range")).cast("double")).otherwise(F.col(f"{name}_")) for name in wanted}
    return out.select(*keys, "n", *(v.alias(name) for name, v in checked.items()))
