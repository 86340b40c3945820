"""Shift, weights, backtest and the auto-encoder."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spanfolio.operators import autoencoder as E
from spanfolio.operators import signal as G
from spanfolio.operators.moments import rolling_cov
from test_moments import dates, panel

DAY = dt.date(2020, 1, 1)


def series(spark, values):
    rows = [("U", DAY + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "universe string, dt date, ar double")


def test_shift_matches_rolling_statistics(spark):
    values = np.random.default_rng(1).uniform(0.3, 0.7, 60)
    s = pd.Series(values)
    want = ((s.rolling(5).mean() - s.rolling(20).mean()) / s.rolling(20).std()).dropna()
    got = G.standardised_shift(series(spark, [float(v) for v in values]), 5, 20).orderBy("dt").collect()
    assert [r.ar_shift for r in got] == pytest.approx(list(want), rel=1e-9)


def test_shift_without_deviation(spark):
    """0 / 0 is dropped."""
    assert G.standardised_shift(series(spark, [0.5] * 30), 5, 20).count() == 0


def test_regimes(spark):
    shifts = [1.0, 1.01, -1.0, -1.01, 0.0, float("nan"), None, float("inf"), float("-inf")]
    rows = [("U", DAY + dt.timedelta(days=i), v) for i, v in enumerate(shifts)]
    df = spark.createDataFrame(rows, "universe string, dt date, ar_shift double")
    got = G.regime_weights(df).groupBy("dt").pivot("asset", ["EQ", "FI"]).agg(F.first("w")).orderBy("dt").collect()
    assert [r.EQ for r in got] == [0.5, 0.0, 0.5, 1.0, 0.5, 0.5, 0.5, 0.0, 1.0]
    assert all(r.EQ + r.FI == 1.0 for r in got)


def test_backtest_and_lag(spark):
    n = 12
    rng = np.random.default_rng(5)
    r = rng.normal(0, 0.02, (n, 2))
    w = rng.uniform(0, 1, n)
    days = [DAY + dt.timedelta(days=i) for i in range(n)]
    weights = spark.createDataFrame(
        [("U", d, a, float(x if a == "EQ" else 1 - x)) for d, x in zip(days, w) for a in ("EQ", "FI")],
        "universe string, dt date, asset string, w double")
    returns = spark.createDataFrame(
        [("U", d, a, float(r[i, j])) for i, d in enumerate(days) for j, a in enumerate(("EQ", "FI"))],
        "universe string, dt date, asset string, r double")
    for lag in (0, 1):
        p = w[: n - lag] * r[lag:, 0] + (1 - w[: n - lag]) * r[lag:, 1]
        got = G.backtest(weights, returns, 252, lag).first()
        ret = np.prod(1 + p) ** (252 / len(p)) - 1
        vol = p.std(ddof=1) * np.sqrt(252)
        assert got.n == n - lag
        assert (got.ann_ret, got.ann_vol, got.sharpe) == pytest.approx((ret, vol, ret / vol), rel=1e-9)


@pytest.fixture(scope="module")
def cov(spark):
    x = np.random.default_rng(9).normal(size=(60, 4)) * [1, 2, 3, 4]
    r = panel(spark, x)
    return rolling_cov(r, dates(r), 20, 1, 20).cache()


def test_models_train_on_the_ring(cov):
    models = E.fit_models(cov, 20, 1, 13).orderBy("ref_ix").collect()
    assert [m.ref_ix for m in models] == [20, 33, 46, 59]
    assert [m.n_train for m in models] == [1, 4, 2, 5]
    for m in models:
        assert m.loss_last < m.loss_first


def test_models_can_be_repeated(cov):
    a, b = (E.fit_models(cov, 20, 1, 13).orderBy("ref_ix").collect() for _ in range(2))
    assert a == b


def test_training_parameters(cov):
    spec = E.TrainSpec(codes=3, epochs=200, batch=5)
    better = E.fit_models(cov, 20, 1, 13, spec).orderBy("ref_ix").collect()
    for m, base in zip(better, E.fit_models(cov, 20, 1, 13).orderBy("ref_ix").collect()):
        assert len(m.enc_bias) == 3
        assert m.loss_last < base.loss_last


def test_ratio_is_the_model_applied(cov):
    models = E.fit_models(cov, 20, 1, 13, E.TrainSpec(codes=2, epochs=20))
    model = {m.ref_ix: m for m in models.collect()}
    mats = {}
    for row in cov.collect():
        c = mats.setdefault(row.ix, np.zeros((4, 4)))
        i, j = int(row.ai[1:]), int(row.aj[1:])
        c[i, j] = c[j, i] = row["cov"]
    ratios = {r.ix: r.ae_ratio for r in E.autoencoder_ratio(cov, models, 20, 1, 13).collect()}
    assert sorted(ratios) == sorted(mats)
    for ix, c in mats.items():
        m = model[ix - (ix - 20) % 13]
        out = (c @ np.reshape(m.enc, (4, 2)) + m.enc_bias) @ np.reshape(m.dec, (2, 4)) + m.dec_bias
        assert ratios[ix] == pytest.approx(np.trace(out) / np.trace(c), rel=1e-9)
    codes = E.codings(cov, models).collect()
    assert len(codes) == 4 * 4 * 2
    for r in codes:
        m = model[r.ix]
        want = mats[r.ix][int(r.asset[1:])] @ np.reshape(m.enc, (4, 2))[:, r.k - 1] + m.enc_bias[r.k - 1]
        assert r.code == pytest.approx(want, rel=1e-9)
