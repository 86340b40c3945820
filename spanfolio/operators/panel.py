"""Alignment, returns, standardisation and weights on long panels.

A panel is ``(universe, dt DATE, asset, value)`` with unique keys. Windows here
are partitioned by universe and asset; since ``dt`` is a date, such a group is
one series of at most 366 rows per calendar year, whatever the table holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanfolio.functions.columns import half_life_decay, is_missing


def drop_missing(panel: DataFrame, value: str = "price") -> DataFrame:
    return panel.where(~is_missing(F.col(value)))


def exclude_asset(panel: DataFrame, name: str) -> DataFrame:
    """Leave out one asset (the index) by name."""
    return panel.where(F.col("asset") != name)


def assert_absent(panel: DataFrame, name: str) -> DataFrame:
    """The panel, made to fail at run time if the asset is in it."""
    guard = F.when(
        F.col("asset") == name, F.raise_error(F.lit(f"asset {name} must not be in the panel"))
    ).otherwise(F.col("asset"))
    return panel.withColumn("asset", guard)


def complete_dates(panel: DataFrame) -> DataFrame:
    """``(universe, dt, n_assets)``: dates on which every asset of the universe has a value.

    Both counts combine map-side; the panel itself is not moved.
    """
    sizes = (
        panel.groupBy("universe", "asset").agg(F.lit(1).alias("one"))
        .groupBy("universe").agg(F.count("one").alias("n_assets"))
    )
    per_date = panel.groupBy("universe", "dt").agg(F.count(F.lit(1)).alias("n"))
    return per_date.join(sizes, "universe").where("n = n_assets").select("universe", "dt", "n_assets")


def calendar(dates: DataFrame) -> DataFrame:
    """Number the dates of each universe from 0 in column ``ix``.

    ``dates`` has one row per universe and date, so the sort sees dates only,
    never panel rows.
    """
    order = Window.partitionBy("universe").orderBy("dt")
    return dates.withColumn("ix", F.row_number().over(order).cast("long") - 1)


def aligned(panel: DataFrame, value: str = "price", dates: DataFrame | None = None) -> DataFrame:
    """Complete dates only, with ``ix`` and ``n_assets``: one join does both.

    ``dates`` is ``calendar(complete_dates(panel))`` where the caller has it as a
    written table; its known size then decides how the panel is joined.
    """
    present = drop_missing(panel, value)
    numbered = calendar(complete_dates(present)) if dates is None else dates
    return present.join(numbered, ["universe", "dt"]).select(
        "universe", "dt", "ix", "asset", "n_assets", value
    )


def return_dates(price_dates: DataFrame) -> DataFrame:
    """Calendar of the returns of an aligned panel: its first date has none."""
    return price_dates.where("ix > 0").select("universe", "dt", (F.col("ix") - 1).alias("ix"))


def _by_date():
    return Window.partitionBy("universe", "asset").orderBy("dt")


def _returns(panel: DataFrame, r) -> DataFrame:
    """First date dropped, so that the first return has ``ix`` 0."""
    kept = panel.withColumn("r", r).where("r IS NOT NULL")
    if "ix" in panel.columns:
        kept = kept.withColumn("ix", F.col("ix") - 1)
    return kept.drop("price")


def simple_returns(prices: DataFrame, pad: bool = False) -> DataFrame:
    """Relative price change from the date before.

    ``pad`` carries the last known price over gaps first; a gap is a row whose
    price is null or NaN.
    """
    price = F.col("price")
    if pad:
        known = F.when(~is_missing(price), price)
        filled = F.last(known, ignorenulls=True).over(
            _by_date().rowsBetween(Window.unboundedPreceding, 0)
        )
        prices = prices.withColumn("price", filled)
    before = F.lag("price").over(_by_date())
    return _returns(prices, F.try_divide(F.col("price"), before) - 1)


def log_returns(prices: DataFrame) -> DataFrame:
    before = F.lag("price").over(_by_date())
    return _returns(prices, F.log("price") - F.log(before))


def fill_grid(panel: DataFrame, value: str = "price") -> DataFrame:
    """A row for each asset on each date of its universe, null where there was none.

    Dates of a universe are gathered once per universe (one array of at most
    366 dates a year) and exploded next to each asset.
    """
    dates = panel.groupBy("universe").agg(F.collect_set("dt").alias("dts"))
    assets = panel.select("universe", "asset").distinct()
    grid = assets.join(dates, "universe").select(
        "universe", "asset", F.explode("dts").alias("dt")
    )
    return grid.join(panel.select("universe", "asset", "dt", value), ["universe", "asset", "dt"], "left")


def padded_returns(prices: DataFrame, skip: int = 0) -> DataFrame:
    """``(universe, dt, ix, asset, r)`` over filled gaps, from the date numbered ``skip`` on.

    ``ix`` numbers all dates of a universe from 0, whether every asset has a price or
    not. An asset has a return from the date after its first price on.
    """
    grid = fill_grid(prices)
    dates = calendar(prices.select("universe", "dt").distinct())
    returns = simple_returns(grid, pad=True)
    return skip_rows(returns.join(dates, ["universe", "dt"]), skip).select("universe", "dt", "ix", "asset", "r")


def standardise(returns: DataFrame, by: str = "sample") -> DataFrame:
    """Subtract the mean of each asset and divide by its sample deviation.

    ``by='sample'`` uses all dates, later ones too. ``by='past'`` uses the dates
    up to and including each row. An asset without deviation gets null.
    """
    if by == "sample":
        stats = returns.groupBy("universe", "asset").agg(
            F.avg("r").alias("m"), F.stddev_samp("r").alias("s")
        )
        joined = returns.join(stats, ["universe", "asset"])
    elif by == "past":
        past = _by_date().rowsBetween(Window.unboundedPreceding, 0)
        joined = returns.withColumns(
            {"m": F.avg("r").over(past), "s": F.stddev_samp("r").over(past)}
        )
    else:
        raise ValueError(f"unknown way to standardise: {by}")
    z = F.try_divide(F.col("r") - F.col("m"), F.col("s"))
    return joined.withColumn("r", z).drop("m", "s")


def half_life_weights(dates: DataFrame, half_life: float = 252.0) -> DataFrame:
    """Weight of each numbered date, halved every ``half_life`` rows, summing to 1 by universe.

    The row with ``ix`` 0 gets the largest weight.
    """
    raw = dates.withColumn("raw", half_life_decay(F.col("ix"), half_life))
    total = raw.groupBy("universe").agg(F.sum("raw").alias("total"))
    return raw.join(total, "universe").withColumn("w", F.col("raw") / F.col("total")).drop("raw", "total")


def skip_rows(panel: DataFrame, n: int) -> DataFrame:
    """Leave out the first ``n`` dates."""
    return panel.where(F.col("ix") >= n)


def evaluation_grid(dates: DataFrame, start: int, stop: int | None, step: int) -> DataFrame:
    """Every ``step``-th date from ``start`` up to but not including ``stop``."""
    grid = dates.where((F.col("ix") >= start) & ((F.col("ix") - start) % step == 0))
    return grid if stop is None else grid.where(F.col("ix") < stop)


def asset_head(panel: DataFrame, asset: str, n: int = 50) -> DataFrame:
    """The first ``n`` rows of one asset."""
    return panel.where(F.col("asset") == asset).orderBy("universe", "dt").limit(n)
