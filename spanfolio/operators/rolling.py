"""Rolling statistics and forward fill of one dated series per universe.

A series has one row per universe and date, at most 366 per calendar year, so
a window partitioned by universe stays small whatever the size of the panel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _trailing(n: int, keys: list[str]):
    return Window.partitionBy(*keys).orderBy("dt").rowsBetween(1 - n, 0)


def rolling_mean(value: str, n: int, keys: list[str] | None = None) -> Column:
    """Mean of the last ``n`` rows, null until there are ``n`` values."""
    frame = _trailing(n, keys or ["universe"])
    return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))


def rolling_std(value: str, n: int, keys: list[str] | None = None) -> Column:
    """Sample deviation of the last ``n`` rows, null until there are ``n`` values."""
    frame = _trailing(n, keys or ["universe"])
    return F.when(F.count(value).over(frame) == n, F.stddev_samp(value).over(frame))


def refresh_row(ix: Column, start: int, step: int, refresh: int) -> Column:
    """Row of the last refresh at or before an evaluated row; a refresh is due every ``refresh`` steps."""
    period = step * refresh
    return ix - (ix - start) % period


def carry_forward(
    grid: DataFrame, scheduled: DataFrame, start: int, step: int, refresh: int
) -> DataFrame:
    """Values of ``scheduled`` on every row of ``grid`` until the next refresh.

    The refresh a row depends on follows from its number, so this is an equality
    join and needs no ordered window.
    """
    ref = scheduled.drop("dt").withColumnRenamed("ix", "ref_ix")
    due = grid.withColumn("ref_ix", refresh_row(F.col("ix"), start, step, refresh))
    return due.join(ref, ["universe", "ref_ix"], "left")


def fill_last(series: DataFrame, value: str) -> DataFrame:
    """Last known value for rows without one, for schedules that are not regular."""
    before = Window.partitionBy("universe").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return series.withColumn(value, F.last(value, ignorenulls=True).over(before))


def cumulative_share(ranked: DataFrame, keys: list[str], value: str = "lambda") -> DataFrame:
    """Running share of a ranked vector: sum up to rank ``k`` over the whole sum."""
    upto = Window.partitionBy(*keys).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    share = F.try_divide(F.sum(value).over(upto), F.sum(value).over(whole))
    return ranked.withColumn("share", share)


def ranks_needed(shares: DataFrame, keys: list[str], threshold: float = 0.8) -> DataFrame:
    """First rank whose running share reaches the threshold; one past the last if none does."""
    reached = F.min(F.when(F.col("share") >= threshold, F.col("k")))
    return shares.groupBy(*keys).agg(F.coalesce(reached, F.max("k") + 1).alias("components"))
