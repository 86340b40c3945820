"""Acceptance numbers on the fixed inputs."""

import datetime as dt
import math

import numpy as np
import pytest
from fixed_values import BOND, COV3, LEVELS, MONTHLY, MU3, RF3, SWAP_STATES, SWAPTION
from pyspark.sql import functions as F

from spanfolio.functions.columns import best_of, tail_probability
from spanfolio.operators import moments as M
from spanfolio.operators import portfolio as O
from spanfolio.operators import rates as L
from spanfolio.operators import risk as K
from spanfolio.sources.tables import BASE_SPOT

KEY = ["universe"]


def moments_of(spark, mu, cov, names=None):
    names = names or [f"a{i:02d}" for i in range(len(mu))]
    mu_df = spark.createDataFrame(
        [("U", a, float(m)) for a, m in zip(names, mu)], "universe string, asset string, mu double"
    )
    entries = [
        ("U", names[i], names[j], float(cov[i][j]))
        for i in range(len(mu))
        for j in range(i, len(mu))
    ]
    return mu_df, spark.createDataFrame(entries, "universe string, ai string, aj string, cov double")


def weights(solved):
    return [r.w for r in O.weights_long(solved, KEY).orderBy("asset").collect()]


@pytest.fixture(scope="module")
def monthly(spark):
    day = dt.date(2020, 1, 1)
    rows = [
        ("U", day + dt.timedelta(days=31 * i), i, a, 3, x)
        for a, xs in MONTHLY.items()
        for i, x in enumerate(xs)
    ]
    return spark.createDataFrame(
        rows, "universe string, dt date, ix long, asset string, n_assets long, r double"
    )


@pytest.fixture(scope="module")
def yearly(spark, monthly):
    """Means in percent per year, covariance in decimals per year rounded to 4."""
    mu = K.asset_mean(monthly).withColumn("mu", 12 * F.col("mu"))
    return mu.cache(), M.annualise_cov(M.covariance(monthly)).drop("n").cache()


def test_min_variance_of_three(spark):
    mu, cov = moments_of(spark, MU3, COV3)
    solved = O.solve(M.matrix_rows(cov, KEY, mu), "min_variance")
    assert weights(solved) == pytest.approx([1 / 6, 2 / 3, 1 / 6], rel=1e-8)
    stats = O.portfolio_stats(O.weights_long(solved, KEY), mu, cov, KEY).first()
    assert (stats.ret, stats.variance) == pytest.approx((0.03, 0.000666666667), rel=1e-8)


def test_tangency_of_three(spark):
    mu, cov = moments_of(spark, MU3, COV3)
    solved = O.solve(M.matrix_rows(cov, KEY, mu), "tangency", RF3)
    assert weights(solved) == pytest.approx([0.29166667, 0.58333333, 0.125], rel=1e-7)
    s = O.portfolio_stats(O.weights_long(solved, KEY), mu, cov, KEY, RF3).first()
    assert (s.ret, s.variance, s.sharpe) == pytest.approx(
        (0.0341666667, 0.000805555556, 0.8514693183), rel=1e-8
    )


def test_yearly_moments(yearly):
    mu, cov = yearly
    assert [r.mu for r in mu.orderBy("asset").collect()] == pytest.approx(
        [-0.51864, 4.70574, -0.69862], rel=1e-6
    )
    assert [r["cov"] for r in cov.orderBy("ai", "aj").collect()] == pytest.approx(
        [0.0056, -0.0020, 0.0037, 0.0022, -0.0022, 0.0074], abs=1e-12
    )


def test_best_return_at_volatility(monthly, yearly):
    mu, cov = yearly
    solved = O.solve(M.matrix_rows(cov, KEY, mu), "target_vol", 0.05)
    assert weights(solved) == pytest.approx([-0.03111017, 1.03398849, -0.00287833], abs=1e-8)
    held = O.weights_long(solved, KEY)
    assert O.portfolio_stats(held, mu, cov, KEY).first().ret == pytest.approx(4.883826837, rel=1e-8)
    realised = K.realised_performance(K.portfolio_series(monthly, held)).first()
    assert realised.annual_vol == pytest.approx(4.945933769, rel=1e-8)
    assert realised.annual_mean == pytest.approx(4.883826837, rel=1e-8)


def test_tangency_with_riskless_rest(monthly, yearly):
    mu, cov = yearly
    tangent = O.weights_long(O.solve(M.matrix_rows(cov, KEY, mu), "tangency", 1.0), KEY)
    stats = O.portfolio_stats(tangent, mu, cov, KEY, 1.0)
    scaled = O.scale_to_volatility(tangent, stats, KEY, 0.05)
    rows = scaled.orderBy("asset").collect()
    assert [r.w for r in rows] == pytest.approx([0.2142823, 1.32340509, 0.15341045], abs=1e-8)
    assert rows[0].w_rf == pytest.approx(-0.6910978407, rel=1e-8)
    ret = scaled.join(mu, ["universe", "asset"]).agg((1 + F.sum(F.expr("w * (mu - 1)"))).alias("v"))
    assert ret.first().v == pytest.approx(5.3181914702, rel=1e-8)
    riskless = F.lit(rows[0].w_rf / 12)
    realised = K.realised_performance(K.portfolio_series(monthly, scaled), 12, riskless).first()
    assert realised.annual_vol == pytest.approx(4.9166065049, rel=1e-8)
    assert realised.annual_mean == pytest.approx(5.3181914702, rel=1e-8)


def test_ceiling_rule(monthly):
    losses = K.equal_weight_series(monthly).select("universe", (-F.col("r")).alias("loss"))
    found = K.ceiling_risk(losses, KEY, 0.9).first()
    assert found.n == 60
    assert (found.ceiling_var, found.ceiling_cvar) == pytest.approx(
        (1.2922666667, 2.1618166667), rel=1e-8
    )


@pytest.fixture(scope="module")
def levels(spark):
    curve = spark.createDataFrame([(1, BASE_SPOT)], "curve_id long, spot array<double>")
    return L.calibrate(curve).cache()


def test_levels_and_repricing(levels):
    row = levels.first()
    assert row.status == "ok"
    assert row.level == pytest.approx(LEVELS, abs=1e-9)
    both = levels.select(
        L.discount_prices(F.col("spot")).alias("market"),
        F.array(*[L.zero_coupon("level", str(m)) for m in range(1, 11)]).alias("model"),
    ).first()
    assert both.model == pytest.approx(both.market, rel=1e-13)


def test_swap_and_swaption(spark, levels):
    contract = spark.createDataFrame(
        [(1, 1, "D", 1e6, 9, 3)],
        "contract_id long, curve_id long, desk string, notional double, strike_step long, exercise long",
    )
    strike = F.lit(0.03) + 0.001 * F.col("strike_step")
    row = L.price_swaps(contract, levels, strike).first()
    assert [row.notional * s for s in row.states] == pytest.approx(SWAP_STATES, abs=1e-5)
    assert row.notional * row.unit == pytest.approx(SWAPTION, abs=1e-5)


def test_curve_that_cannot_be_fitted_gets_a_status(spark):
    curve = spark.createDataFrame(
        [(1, [0.03, 0.03]), (2, [0.03, -0.5]), (3, [0.02])], "curve_id long, spot array<double>"
    )
    rows = {r.curve_id: r for r in L.calibrate(curve).collect()}
    assert rows[1].status == rows[3].status == "ok"
    assert (rows[2].status, rows[2].level) == ("no_bracket", None)


def test_defaultable_bond(spark):
    bond = spark.createDataFrame([(0.2, 10)], "recovery double, maturity int")
    value = bond.select((100 * L.defaultable_bond("recovery", "maturity")).alias("v")).first().v
    assert value == pytest.approx(BOND, rel=1e-12)
    values = [
        bond.select(L.defaultable_bond("recovery", "maturity", a=a).alias("v")).first().v
        for a in (0.0, 0.01, 0.05)
    ]
    assert values == sorted(values, reverse=True)


def test_luck(spark):
    rows = spark.createDataFrame([(15, 12), (15, 14), (15, 0), (3000, 1500)], "n long, k long")
    tails = [
        r.t
        for r in rows.select("k", tail_probability(F.col("n"), F.col("k"), 0.5).alias("t")).collect()
    ]
    assert tails[0] == pytest.approx(0.017578125, rel=1e-10)
    assert tails[1] == pytest.approx(0.00048828125, rel=1e-10)
    assert tails[2] == pytest.approx(1.0, rel=1e-12)
    exact = sum(math.comb(3000, j) for j in range(1500, 3001)) / 2**3000
    assert tails[3] == pytest.approx(exact, rel=1e-9)
    best = spark.range(1).select(best_of(F.lit(0.00048828125), F.lit(100)).alias("b")).first().b
    assert best == pytest.approx(0.04766655657, rel=1e-9)


def test_frontier_ends_and_floor(spark):
    mu, cov = moments_of(spark, MU3, COV3)
    rows = M.matrix_rows(cov, KEY, mu)
    low = O.weights_long(O.solve(rows, "return_floor", 0.035), KEY)
    high = O.weights_long(O.solve(rows, "return_floor", 0.05), KEY)
    points = O.two_fund_frontier(low, high, mu, cov).orderBy("point").collect()
    assert len(points) == 200
    assert (points[0].phi, points[-1].phi) == pytest.approx((-2.0, 2.0))
    assert min(p.variance for p in points) >= 0.000666666667 - 1e-12
    for p in points[::37]:
        w = p.phi * np.array([r.w for r in low.orderBy("asset").collect()]) + (1 - p.phi) * np.array(
            [r.w for r in high.orderBy("asset").collect()]
        )
        assert p.variance == pytest.approx(w @ np.array(COV3) @ w, rel=1e-9)
        assert p.ret == pytest.approx(w @ np.array(MU3), rel=1e-9)
