"""Eigenvalue spectra of many covariance matrices and what is read off them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from spanfolio.functions.arrow import once
from spanfolio.operators.moments import matrix_rows, rolling_cov, standardised_cov, unpack
from spanfolio.operators.panel import evaluation_grid
from spanfolio.operators.rolling import carry_forward, cumulative_share, ranks_needed

WINDOW = ["universe", "dt", "ix"]


def _spectra(method: str):
    """Arrow function from packed matrices to descending eigenvalues, a stack at a time.

    A matrix with an unknown entry has unknown eigenvalues.
    """

    @pandas_udf("array<double>")
    def spectra(size: pd.Series, packed: pd.Series) -> pd.Series:
        out = [None] * len(size)
        for at, stack in unpack(size, list(packed)):
            if method == "pca_of_cov":
                centred = stack - stack.mean(axis=1, keepdims=True)
                rows = stack.shape[1]
                stack = np.swapaxes(centred, 1, 2) @ centred / max(rows - 1, 1)
            known = np.isfinite(stack).all(axis=(1, 2))
            values = np.full(stack.shape[:2], np.nan)
            values[known] = np.linalg.eigvalsh(stack[known])[:, ::-1]
            for i, v in zip(at, values):
                out[i] = v
        return pd.Series(out)

    return once(spectra)


def eigenvalues(cov: DataFrame, keys: list[str], method: str = "eig") -> DataFrame:
    """``(keys, v ARRAY<DOUBLE>)``, the eigenvalues of each key in descending order.

    ``method='eig'`` takes the eigenvalues of the matrix itself;
    ``'pca_of_cov'`` those of the covariance of the matrix's own rows.
    """
    if method not in ("eig", "pca_of_cov"):
        raise ValueError(f"unknown method: {method}")
    rows = matrix_rows(cov, keys)
    return rows.select(*keys, _spectra(method)(F.size("assets"), "cov").alias("v"))


def spectrum(cov: DataFrame, keys: list[str], method: str = "eig") -> DataFrame:
    """``(keys, k, lambda)``, k = 1 for the largest eigenvalue; see :func:`eigenvalues`."""
    values = eigenvalues(cov, keys, method)
    return values.select(*keys, F.posexplode("v").alias("p", "lambda")).select(
        *keys, (F.col("p") + 1).cast("long").alias("k"), "lambda"
    )


def absorption_ratio(spectra: DataFrame, keys: list[str], frac: float = 0.2) -> DataFrame:
    """Share of the largest ``int(frac * n)`` eigenvalues, at least one of them."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    top = F.greatest(F.floor(F.lit(frac) * n), F.lit(1).cast("long"))
    return (
        spectra.withColumn("top", top)
        .groupBy(*keys)
        .agg(
            F.try_divide(
                F.sum(F.when(F.col("k") <= F.col("top"), F.col("lambda"))), F.sum("lambda")
            ).alias("ar")
        )
    )


def components_needed(spectra: DataFrame, keys: list[str], threshold: float = 0.8) -> DataFrame:
    """How many of the largest eigenvalues reach the threshold of the total."""
    return ranks_needed(cumulative_share(spectra, keys), keys, threshold)


def absorption_and_components(
    values: DataFrame, keys: list[str], frac: float = 0.2, threshold: float = 0.8
) -> DataFrame:
    """Both measures from rows of :func:`eigenvalues`, as array expressions without a shuffle.

    A matrix without variance has neither.
    """
    top = F.greatest(F.floor(F.lit(frac) * F.size("v")), F.lit(1).cast("long")).cast("int")
    total = "aggregate(v, 0D, (s, x) -> s + x)"
    before = F.expr(
        f"""aggregate(v, named_struct('sum', 0D, 'k', 0L),
            (s, x) -> named_struct('sum', s.sum + x,
                'k', s.k + IF(try_divide(s.sum + x, total) >= {threshold}D, 0L, 1L))).k"""
    )
    return (
        values.select(*keys, "v", top.alias("top"), F.expr(total).alias("total"))
        .select(
            *keys,
            F.expr("try_divide(aggregate(slice(v, 1, top), 0D, (s, x) -> s + x), total)").alias("ar"),
            F.when(F.col("total") != 0, before + 1).alias("components"),
        )
    )


def absorption_series(
    returns: DataFrame,
    dates: DataFrame,
    lookback: int = 504,
    start: int = 1512,
    stop: int | None = None,
    step: int = 1,
    refresh: int = 21,
    frac: float = 0.2,
    threshold: float = 0.8,
    method: str = "eig",
    deviation: DataFrame | None = None,
) -> DataFrame:
    """``(universe, dt, ix, ar, components)`` for every evaluated date.

    Spectra are taken every ``refresh`` steps only, and a date carries the values
    of its last refresh. The schedule is applied before the matrix step. With
    ``deviation`` the returns count as standardised by it.
    """
    cov = rolling_cov(returns, dates, lookback, step * refresh, start, stop)
    if deviation is not None:
        cov = standardised_cov(cov, deviation)
    found = absorption_and_components(eigenvalues(cov, WINDOW, method), WINDOW, frac, threshold)
    grid = evaluation_grid(dates, start, stop, step).select("universe", "dt", "ix")
    carried = carry_forward(grid, found, start, step, refresh)
    return carried.select("universe", "dt", "ix", "ar", "components")
