"""Means, tail risk, performance and luck."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanfolio.functions.columns import best_of, tail_probability
from spanfolio.operators.ranks import elements
from spanfolio.sources.workspace import materialise

ASSET = ["universe", "asset"]


def asset_mean(returns: DataFrame) -> DataFrame:
    return returns.groupBy(*ASSET).agg(F.avg("r").alias("mu"))


def shrink_mean(mu: DataFrame, alpha: float = 0.9) -> DataFrame:
    """``alpha`` times the mean plus ``1 - alpha`` times the mean of the means."""
    grand = mu.groupBy("universe").agg(F.avg("mu").alias("grand"))
    return mu.join(grand, "universe").select(
        *ASSET, "mu", (alpha * F.col("mu") + (1 - alpha) * F.col("grand")).alias("shrunk")
    )


def tail_risk(
    returns: DataFrame, keys: list[str], q: float = 0.1, approximate: bool = False
) -> DataFrame:
    """Variance, lower quantile (``var_q``) and mean of returns at or below it (``cvar_q``).

    The exact quantile interpolates between the two elements next to ``q * (n - 1)``,
    which are found without sorting a whole group (``ranks``); ``approximate`` uses a
    bounded sketch and returns an element.
    """
    if approximate:
        stats = returns.groupBy(*keys).agg(F.var_samp("r").alias("variance"), F.percentile_approx("r", q, 10000).alias("var_q"))
    else:
        place = lambda n: (n - 1) * F.lit(q)
        whole = materialise(returns.groupBy(*keys).agg(F.count("r").alias("n"), F.var_samp("r").alias("variance")), "variance")
        wanted = {"lower": lambda n: F.floor(place(n)) + 1, "upper": lambda n: F.ceil(place(n)) + 1}
        near = elements(returns, keys, "r", wanted, sizes=whole.select(*keys, "n"))
        up = place(F.col("n")) - F.floor(place(F.col("n")))
        quantile = F.when(up == 0, F.col("lower")).otherwise((1 - up) * F.col("lower") + up * F.col("upper"))
        stats = whole.drop("n").join(near.select(*keys, quantile.alias("var_q")), keys)
    tail = (
        returns.join(stats.select(*keys, "var_q"), keys)
        .where("r <= var_q")
        .groupBy(*keys)
        .agg(F.avg("r").alias("cvar_q"))
    )
    return stats.join(tail, keys)


def extremes(report: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Assets with the largest variance, the lowest quantile and the lowest tail mean.

    Ties go to the first name.
    """
    keys = by or ["universe"]

    def first(order: Column) -> Column:
        return F.min(F.struct(order.alias("o"), F.col("asset").alias("asset")))["asset"]

    return report.groupBy(*keys).agg(
        first(-F.col("variance")).alias("max_variance"),
        first(F.col("var_q")).alias("worst_var"),
        first(F.col("cvar_q")).alias("worst_cvar"),
    )


def ceiling_risk(losses: DataFrame, keys: list[str], p: float = 0.9) -> DataFrame:
    """``(n, ceiling_var, ceiling_cvar)`` of losses by the ceiling rule.

    The first is element number ``ceil(p * n)`` of the sorted losses; the second
    is the sum from that element upward over ``(1 - p) * n``. The tail has one
    element more than that divisor counts, which is kept as defined.
    """
    last = lambda n: F.ceil(F.lit(p) * n)
    found = elements(losses, keys, "loss", {"ceiling_var": last})
    # equal losses below the element's own place don't belong to the tail
    upto = losses.join(found, keys).groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.max("ceiling_var").alias("ceiling_var"),
        F.sum(F.when(F.col("loss") > F.col("ceiling_var"), F.col("loss"))).alias("above"),
        F.count_if(F.col("loss") <= F.col("ceiling_var")).alias("upto"),
    )
    own = (F.col("upto") - last(F.col("n")) + 1) * F.col("ceiling_var")
    tail = F.coalesce(F.col("above"), F.lit(0.0)) + own
    return upto.select(*keys, "n", "ceiling_var", (tail / ((1 - F.lit(p)) * F.col("n"))).alias("ceiling_cvar"))


def portfolio_series(returns: DataFrame, weights: DataFrame) -> DataFrame:
    """Return of the portfolio on each date; ``weights`` is ``(universe, asset, w)``."""
    return (
        returns.join(weights.select("universe", "asset", "w"), ASSET)
        .groupBy("universe", "dt")
        .agg(F.sum(F.col("w") * F.col("r")).alias("r"))
    )


def equal_weight_series(returns: DataFrame) -> DataFrame:
    """The portfolio with the same weight in each asset: a mean per date."""
    return returns.groupBy("universe", "dt").agg(F.avg("r").alias("r"))


def realised_performance(
    series: DataFrame, periods: int = 12, riskless: Column | None = None
) -> DataFrame:
    """Mean and population deviation per period and per year.

    ``riskless`` is a constant return per period that is added to each row.
    """
    r = F.col("r") if riskless is None else F.col("r") + riskless
    return series.groupBy("universe").agg(
        F.avg(r).alias("mean"), F.stddev_pop(r).alias("vol")
    ).select(
        "universe",
        "mean",
        "vol",
        (periods * F.col("mean")).alias("annual_mean"),
        (math.sqrt(periods) * F.col("vol")).alias("annual_vol"),
    )


def luck_screen(records: DataFrame, p: float = 0.5) -> DataFrame:
    """``records`` with ``tail``, the chance of that many wins or more by luck.

    A column of each record: almost all share a few pairs of trials and wins, so a join
    on the pair would meet in a few tasks.
    """
    return records.withColumn("tail", tail_probability(F.col("n"), F.col("wins"), p))


def best_of_group(screened: DataFrame, by: str = "grp") -> DataFrame:
    """The best record per group and the chance that the best of so many does that well."""
    best = screened.groupBy(by).agg(
        F.count(F.lit(1)).alias("m"), F.min("tail").alias("tail")
    )
    return best.withColumn("best_of", best_of(F.col("tail"), F.col("m")))
