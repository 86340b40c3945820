"""Portfolios for many keys at once: one small dense solve per key, in Arrow batches.

Moments are Spark aggregates; :func:`moments.matrix_rows` puts one matrix in a
row, and a batch of rows is solved as one stack. A key is any combination of
columns, for instance a universe, a window and a target.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from spanfolio.functions.arrow import once
from spanfolio.functions.quadratic import least_variance
from spanfolio.operators.moments import unpack

METHODS = (
    "min_variance",
    "return_floor",
    "long_only",
    "short_budget",
    "target_vol",
    "tangency",
)

OK = "ok"
#: Least over largest eigenvalue below which a matrix counts as singular.
SINGULAR = 1e-12
#: Share of the largest eigenvalue added to the variances of a singular matrix where weights are bounded.
RIDGE = 1e-9


def _directions(stack: np.ndarray, mu: np.ndarray):
    """``inv(S) 1`` and ``inv(S) mu`` for a stack of matrices."""
    rhs = np.stack([np.ones_like(mu), mu], axis=-1)
    solved = np.linalg.solve(stack, rhs)
    return solved[..., 0], solved[..., 1]


def _closed_form(method: str, stack: np.ndarray, mu: np.ndarray, target: np.ndarray):
    """Weights and status per matrix for the methods that have a formula."""
    to_one, to_mu = _directions(stack, mu)
    a = to_one.sum(axis=1)
    lowest = to_one / a[:, None]
    status = np.full(len(mu), OK, dtype=object)
    if method == "min_variance":
        return lowest, status
    if method == "tangency":
        raw = to_mu - target[:, None] * to_one
        total = raw.sum(axis=1)
        flat = np.abs(total) <= 1e-12 * np.abs(raw).sum(axis=1)
        status[flat] = "no_tangency"
        return raw / np.where(flat, 1.0, total)[:, None], status
    # Zero-sum direction along which return grows fastest for the variance added.
    tilt = to_mu - (to_mu.sum(axis=1) / a)[:, None] * to_one
    gain = (tilt * mu).sum(axis=1)
    flat = gain <= 0
    safe = np.where(flat, 1.0, gain)
    if method == "return_floor":
        short_by = target - (lowest * mu).sum(axis=1)
        status[flat & (short_by > 0)] = "infeasible"
        amount = np.maximum(short_by, 0.0) / safe
    else:
        room = target**2 - 1.0 / a
        status[room < 0] = "below_minimum"
        status[flat & (room > 0)] = "no_direction"
        amount = np.sqrt(np.maximum(room, 0.0) / safe)
    return lowest + amount[:, None] * tilt, status


def _bounded(method: str, cov: np.ndarray, mu: np.ndarray, target: float, limit: float):
    bounds = [] if np.isnan(target) else [(mu, target)]
    if method == "long_only":
        bounds += [(row, 0.0) for row in np.eye(len(mu))]
        return least_variance(cov, bounds)
    return least_variance(cov, bounds, limit)


def _solver(method: str):
    @pandas_udf("status string, w array<double>")
    def solve_batch(
        size: pd.Series, packed: pd.Series, mu: pd.Series, target: pd.Series, limit: pd.Series
    ) -> pd.DataFrame:
        status = np.full(len(size), OK, dtype=object)
        weights: list = [None] * len(size)
        targets, limits = target.to_numpy(float), limit.to_numpy(float)
        for at, stack in unpack(size, list(packed)):
            means = np.stack([mu[i] for i in at])
            known = np.isfinite(stack).all(axis=(1, 2)) & np.isfinite(means).all(axis=1)
            status[at[~known]] = "undefined"
            at, stack, means = at[known], stack[known], means[known]
            if len(at) == 0:
                continue
            spectrum = np.linalg.eigvalsh(stack)
            solvable = (spectrum[:, -1] > 0) & (spectrum[:, 0] > SINGULAR * spectrum[:, -1])
            if method in ("long_only", "short_budget"):
                # bounds make the least variance finite without an inverse; of equal portfolios the evenest is taken
                flat = ~solvable & (spectrum[:, -1] > 0) & (spectrum[:, 0] > -1e-9 * spectrum[:, -1])
                stack = stack + (flat * RIDGE * spectrum[:, -1])[:, None, None] * np.eye(stack.shape[1])
                solvable |= flat
            status[at[~solvable]] = "singular"
            at, stack, means = at[solvable], stack[solvable], means[solvable]
            if len(at) == 0:
                continue
            if method in ("long_only", "short_budget"):
                for i, c, m in zip(at, stack, means):
                    weights[i], status[i] = _bounded(method, c, m, targets[i], limits[i])
            else:
                found, state = _closed_form(method, stack, means, targets[at])
                for i, w, s in zip(at, found, state):
                    status[i] = s
                    weights[i] = w if s == OK else None
        return pd.DataFrame({"status": status, "w": weights})

    return once(solve_batch)


def _value(v: Column | float | None) -> Column:
    if isinstance(v, Column):
        return v.cast("double")
    return F.lit(float("nan") if v is None else float(v))


def solve(
    rows: DataFrame,
    method: str,
    target: Column | float | None = None,
    limit: Column | float | None = None,
) -> DataFrame:
    """Solve each row of :func:`moments.matrix_rows` (with ``mu``); adds ``status`` and ``w``.

    ``min_variance``: smallest variance, fully invested. ``return_floor``: the
    same with return at least ``target``, short sales allowed. ``long_only``:
    the same without short sales. ``short_budget``: total short at most
    ``limit``. ``target_vol``: highest return at volatility ``target``.
    ``tangency``: highest ratio of return above ``target`` to volatility.
    ``target`` and ``limit`` may be columns. A key without a solution gets a
    status other than ``ok`` and null weights. A matrix counts as singular by its
    least eigenvalue relative to the largest; ``long_only`` and ``short_budget`` solve such a
    key too, with fewer dates than assets for instance, as their bounds keep it finite.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    answer = _solver(method)(F.size("assets"), "cov", "mu", _value(target), _value(limit))
    kept = [c for c in rows.columns if c not in ("cov", "mu")]
    return rows.withColumn("s", answer).select(*kept, "s.status", "s.w")


def weights_long(solved: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, status, asset, w)``; a key without a solution keeps its assets with null weights."""
    return solved.select(
        *keys, "status", "w", F.posexplode("assets").alias("p", "asset")
    ).select(*keys, "status", "asset", F.get("w", F.col("p")).alias("w"))


def portfolio_stats(
    weights: DataFrame, mu: DataFrame, cov: DataFrame, keys: list[str], rf: float = 0.0
) -> DataFrame:
    """``(keys, ret, variance, vol, sharpe)`` of given weights.

    ``mu`` and ``cov`` are keyed by ``universe``; ``keys`` must contain it.
    Equality joins only: each covariance entry meets the two weights it needs.
    """
    w = weights.select(*keys, "asset", "w")
    ret = (
        w.join(mu.select("universe", "asset", "mu"), ["universe", "asset"])
        .groupBy(*keys)
        .agg(F.sum(F.col("w") * F.col("mu")).alias("ret"))
    )
    left = w.withColumnsRenamed({"asset": "ai", "w": "wi"})
    right = w.withColumnsRenamed({"asset": "aj", "w": "wj"})
    twice = F.when(F.col("ai") == F.col("aj"), 1.0).otherwise(2.0)
    variance = (
        cov.select("universe", "ai", "aj", "cov")
        .join(left, ["universe", "ai"])
        .join(right, [*keys, "aj"])
        .groupBy(*keys)
        .agg(F.sum(twice * F.col("wi") * F.col("wj") * F.col("cov")).alias("variance"))
    )
    vol = F.sqrt("variance")
    return ret.join(variance, keys).select(
        *keys,
        "ret",
        "variance",
        vol.alias("vol"),
        F.try_divide(F.col("ret") - rf, vol).alias("sharpe"),
    )


def scale_to_volatility(weights: DataFrame, stats: DataFrame, keys: list[str], vol: float) -> DataFrame:
    """Weights times ``vol`` over the portfolio's own volatility, and the riskless rest ``w_rf``."""
    scale = stats.select(*keys, (F.lit(vol) / F.col("vol")).alias("scale"))
    scaled = weights.join(scale, keys).withColumn("w", F.col("w") * F.col("scale"))
    rest = scaled.groupBy(*keys).agg((1 - F.sum("w")).alias("w_rf"))
    return scaled.drop("scale").join(rest, keys)


def two_fund_frontier(
    first: DataFrame, second: DataFrame, mu: DataFrame, cov: DataFrame, points: int = 200,
    low: float = -2.0, high: float = 2.0,
) -> DataFrame:
    """``(universe, phi, ret, variance)`` of ``phi * first + (1 - phi) * second``.

    Two returns, two variances and one covariance per universe are summed once;
    each of the ``points`` mixtures is then a column expression.
    """
    pair = (
        first.select("universe", "asset", F.col("w").alias("u"))
        .join(second.select("universe", "asset", F.col("w").alias("v")), ["universe", "asset"])
    )
    rets = (
        pair.join(mu.select("universe", "asset", "mu"), ["universe", "asset"])
        .groupBy("universe")
        .agg(
            F.sum(F.col("u") * F.col("mu")).alias("ru"),
            F.sum(F.col("v") * F.col("mu")).alias("rv"),
        )
    )
    left = pair.withColumnsRenamed({"asset": "ai", "u": "ui", "v": "vi"})
    right = pair.withColumnsRenamed({"asset": "aj", "u": "uj", "v": "vj"})
    both = F.when(F.col("ai") == F.col("aj"), 1.0).otherwise(2.0) * F.col("cov")
    cross = (F.col("ui") * F.col("vj") + F.col("uj") * F.col("vi")) / 2
    seconds = (
        cov.join(left, ["universe", "ai"])
        .join(right, ["universe", "aj"])
        .groupBy("universe")
        .agg(
            F.sum(both * F.col("ui") * F.col("uj")).alias("uu"),
            F.sum(both * F.col("vi") * F.col("vj")).alias("vv"),
            F.sum(both * cross).alias("uv"),
        )
    )
    width = (high - low) / (points - 1)
    phi = F.col("phi")
    rest = 1 - phi
    return (
        rets.join(seconds, "universe")
        .withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("phi", low + F.col("p") * width)
        .select(
            "universe",
            F.col("p").cast("long").alias("point"),
            "phi",
            (phi * F.col("ru") + rest * F.col("rv")).alias("ret"),
            (phi * phi * F.col("uu") + 2 * phi * rest * F.col("uv") + rest * rest * F.col("vv")).alias(
                "variance"
            ),
        )
    )


def solution_diff(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Absolute difference of two sets of weights, asset by asset."""
    a = first.select(*keys, "asset", F.col("w").alias("w_first"))
    b = second.select(*keys, "asset", F.col("w").alias("w_second"))
    return a.join(b, [*keys, "asset"]).withColumn("diff", F.abs(F.col("w_first") - F.col("w_second")))
