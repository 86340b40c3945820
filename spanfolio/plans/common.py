"""Inputs shared by the queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfolio.functions.columns import rounded
from spanfolio.operators.moments import deviations
from spanfolio.operators.panel import (
    aligned,
    calendar,
    complete_dates,
    drop_missing,
    return_dates,
    simple_returns,
)
from spanfolio.sources.tables import PanelSpec, price_panel
from spanfolio.sources.workspace import materialise


def prices_of(spark: SparkSession, sf_dir: str, spec: PanelSpec) -> DataFrame:
    """The price panel, written once: several branches of a plan read it."""
    return materialise(price_panel(spark, sf_dir, spec), "prices")


def calendar_of(prices: DataFrame) -> DataFrame:
    """Numbered complete dates, written so that joins with them know their size."""
    return materialise(calendar(complete_dates(drop_missing(prices))), "calendar")


def aligned_prices(spark: SparkSession, sf_dir: str, spec: PanelSpec) -> DataFrame:
    prices = prices_of(spark, sf_dir, spec)
    return aligned(prices, dates=calendar_of(prices))


@dataclass(frozen=True)
class Returns:
    """Aligned returns with their calendar, both written tables."""

    rows: DataFrame
    dates: DataFrame

    @property
    def deviation(self) -> DataFrame:
        return materialise(deviations(self.rows), "deviation")


def returns_of_prices(prices: DataFrame) -> Returns:
    dates = calendar_of(prices)
    rows = materialise(simple_returns(aligned(prices, dates=dates)), "returns")
    return Returns(rows, return_dates(dates))


def panel_of(spark: SparkSession, sf_dir: str, spec: PanelSpec) -> Returns:
    return returns_of_prices(prices_of(spark, sf_dir, spec))


def returns_of(spark: SparkSession, sf_dir: str, spec: PanelSpec) -> DataFrame:
    return panel_of(spark, sf_dir, spec).rows


def dates_of(panel: DataFrame) -> DataFrame:
    """The calendar of an aligned panel that came without one."""
    return panel.select("universe", "dt", "ix").distinct()


def show(df: DataFrame, plain: list[str], **digits: int) -> DataFrame:
    """Plain columns, then the named columns rounded to the given digits."""
    return df.select(*plain, *[rounded(F.col(f"`{c}`"), d).alias(c) for c, d in digits.items()])
