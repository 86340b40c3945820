"""Headline jobs on the widest panel the tables give: 25 assets by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanfolio.operators import autoencoder_rows as B
from spanfolio.operators import moments as M
from spanfolio.operators import risk as K
from spanfolio.operators import spectrum as C
from spanfolio.plans import spectrum_queries
from spanfolio.plans.common import panel_of, returns_of
from spanfolio.sources.tables import BRANDS_DAY, TYPES_DAY
from spanfolio.sources.workspace import materialise

#: Queries whose names end in ``_wide_panel`` and the auto-encoder job are here; the rest are registered ones.
HEADLINE = [
    "asset_risk_report_wide_panel",
    "rolling_cov_wide_panel",
    "absorption_series_wide_panel",
    "absorption_series",
    "backtest",
    "covariance",
    "min_variance",
    "short_budget",
    "autoencoder_series",
    "luck_screen",
    "swaption_book",
    "bond_book",
]


def asset_risk_report_wide_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.tail_risk(returns_of(spark, sf_dir, BRANDS_DAY), ["universe", "asset"], 0.1)


def rolling_cov_wide_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panel_of(spark, sf_dir, BRANDS_DAY)
    return M.standardised_cov(M.rolling_cov(p.rows, p.dates, 504, 21, 1512), p.deviation)


def absorption_series_wide_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panel_of(spark, sf_dir, BRANDS_DAY)
    return C.absorption_series(p.rows, p.dates, 504, 1512, deviation=p.deviation)


def autoencoder_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job of the query ``autoencoder_ratio`` without its comparison with the codes."""
    p = panel_of(spark, sf_dir, TYPES_DAY)
    rows = materialise(B.date_rows(p.rows, p.deviation), "date-rows")
    models = materialise(B.fit_models(rows, B.asset_names(p.rows), p.dates, 504, 1512), "models")
    return B.ratio(rows, p.dates, models, 504, 1512)


def warm_up(spark: SparkSession, sf_dir: str) -> None:
    spectrum_queries.spectrum_by_universe(spark, sf_dir).write.format("noop").mode("overwrite").save()


QUERIES = {
    f.__name__: f
    for f in (
        asset_risk_report_wide_panel, rolling_cov_wide_panel, absorption_series_wide_panel, autoencoder_series,
    )
}
