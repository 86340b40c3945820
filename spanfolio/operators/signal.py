"""From the absorption ratio to weights and a backtest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanfolio.functions.columns import is_missing, safe_ratio
from spanfolio.operators.rolling import rolling_mean, rolling_std

EQUITY = "EQ"
BONDS = "FI"


def standardised_shift(series: DataFrame, short: int = 15, long: int = 252) -> DataFrame:
    """``(mean of the last short rows - mean of the last long) / deviation of the last long``.

    Rows without a full long window, or with an undefined ratio, are dropped;
    an infinite ratio stays.
    """
    gap = F.col("ar_short") - F.col("ar_long")
    return (
        series.withColumns(
            {
                "ar_short": rolling_mean("ar", short),
                "ar_long": rolling_mean("ar", long),
                "ar_sd": rolling_std("ar", long),
            }
        )
        .withColumn("ar_shift", safe_ratio(gap, F.col("ar_sd")))
        .where(~is_missing(F.col("ar_shift")))
        .select("universe", "dt", "ar_short", "ar_long", "ar_shift")
    )


def regime_weight(shift: Column) -> Column:
    """Equity weight: 0 above 1, 1 below -1, otherwise one half, also when unknown."""
    return (
        F.when(is_missing(shift), F.lit(0.5))
        .when(shift > 1, F.lit(0.0))
        .when(shift < -1, F.lit(1.0))
        .otherwise(F.lit(0.5))
    )


def regime_weights(shift: DataFrame) -> DataFrame:
    """``(universe, dt, asset, w)`` with one row for each of the two funds."""
    equity = regime_weight(F.col("ar_shift"))
    pair = F.array(
        F.struct(F.lit(EQUITY).alias("asset"), equity.alias("w")),
        F.struct(F.lit(BONDS).alias("asset"), (1 - equity).alias("w")),
    )
    return shift.select("universe", "dt", F.inline(pair))


def backtest(
    weights: DataFrame, returns: DataFrame, periods_per_year: int = 252, lag: int = 0
) -> DataFrame:
    """``(universe, n, n_unmatched, ann_ret, ann_vol, sharpe)`` of dated weights.

    The definition is this library's own: growth compounded to a year, sample
    deviation times the root of the periods, and their ratio. ``lag`` applies a
    weight that many of its own dates later; 0 uses the same date. A date on which
    some weight meets no return has no result: ``n`` counts dates with one,
    ``n_unmatched`` the others. A return of -1 or less ends in a total loss.
    """
    if lag:
        order = Window.partitionBy("universe", "asset").orderBy("dt")
        weights = weights.withColumn("dt", F.lead("dt", lag).over(order)).where("dt IS NOT NULL")
    daily = (
        weights.join(returns.select("universe", "dt", "asset", "r"), ["universe", "dt", "asset"], "left")
        .groupBy("universe", "dt")
        .agg(F.when(F.count("r") == F.count(F.lit(1)), F.sum(F.col("w") * F.col("r"))).alias("r"))
    )
    n = F.col("n")
    return (
        daily.groupBy("universe")
        .agg(
            F.count("r").alias("n"),
            F.count(F.when(F.col("r").isNull(), 1)).alias("n_unmatched"),
            F.sum(F.log1p("r")).alias("growth"),
            F.coalesce(F.max(F.col("r") <= -1), F.lit(False)).alias("lost"),
            F.stddev_samp("r").alias("sd"),
        )
        .withColumn("ann_ret", F.when(F.col("lost"), -1.0).otherwise(F.exp(F.col("growth") * F.try_divide(F.lit(float(periods_per_year)), n)) - 1))
        .withColumn("ann_vol", F.col("sd") * F.sqrt(F.lit(float(periods_per_year))))
        .withColumn("sharpe", safe_ratio(F.col("ann_ret"), F.col("ann_vol")))
        .select("universe", "n", "n_unmatched", "ann_ret", "ann_vol", "sharpe")
    )
