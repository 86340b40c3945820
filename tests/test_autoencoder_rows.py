"""The auto-encoder from rows of dates against matrices, and at a width where matrices by date would be too many."""

import datetime

import numpy as np
import pytest

from spanfolio.operators import autoencoder as E
from spanfolio.operators import autoencoder_rows as B
from spanfolio.operators import moments as M

DAY = datetime.date(2020, 1, 1)


def panel(spark, n_dates, n_assets, seed=0, universes=("U",)):
    r = np.random.default_rng(seed)
    common = r.normal(size=(n_dates, 2))
    out = {}
    rows = []
    for u in universes:
        x = common @ r.normal(size=(2, n_assets)) + r.normal(size=(n_dates, n_assets))
        out[u] = x
        rows += [(u, DAY + datetime.timedelta(i), i, f"a{j:04d}", float(x[i, j]), n_assets) for i in range(n_dates) for j in range(n_assets)]
    returns = spark.createDataFrame(rows, "universe string, dt date, ix int, asset string, r double, n_assets int")
    return returns, out


def dates(returns):
    return returns.select("universe", "dt", "ix").distinct()


@pytest.mark.parametrize("step,refresh", [(1, 13), (3, 4), (1, 2)])
def test_same_models_and_ratios_as_from_matrices(spark, step, refresh):
    returns, _ = panel(spark, 70, 5, 1, ("U", "V"))
    deviation = M.deviations(returns)
    cov = M.standardised_cov(M.rolling_cov(returns, dates(returns), 12, step, 24), deviation)
    spec = E.TrainSpec(codes=2, epochs=10)
    rows = B.date_rows(returns, deviation)
    models = B.fit_models(rows, B.asset_names(returns), dates(returns), 12, 24, step, refresh, spec)
    want = {(m.universe, m.ref_ix): m for m in E.fit_models(cov, 24, step, refresh, spec).collect()}
    got = {(m.universe, m.ref_ix): m for m in models.collect()}
    assert want.keys() == got.keys()
    for key, m in want.items():
        assert (m.n_train, m.assets) == (got[key].n_train, got[key].assets)
        assert got[key].enc == pytest.approx(m.enc, abs=1e-4) and got[key].loss_last == pytest.approx(m.loss_last, rel=1e-3)
    ratios = {(r.universe, r.ix): r.ae_ratio for r in E.autoencoder_ratio(cov, models, 24, step, refresh).collect()}
    found = {(r.universe, r.ix): r.ae_ratio for r in B.ratio(rows, dates(returns), models, 12, 24, step, refresh).collect()}
    assert ratios.keys() == found.keys() and found == pytest.approx(ratios, rel=1e-9)
    codes = B.ratio_by_codes(returns, deviation, models, 12, 24, step, refresh).collect()
    assert {(r.universe, r.ix): r.by_codes for r in codes if (r.universe, r.ix) in found} == pytest.approx(found, rel=1e-9)


def test_six_hundred_assets(spark):
    returns, x = panel(spark, 90, 600, 2)
    rows = B.date_rows(returns, M.deviations(returns))
    models = B.fit_models(rows, B.asset_names(returns), dates(returns), 40, 44, 1, 20, E.TrainSpec(codes=3, epochs=1))
    ratio = B.ratio(rows, dates(returns), models, 40, 44, 1, 20)
    plan = ratio._jdf.queryExecution().optimizedPlan().toString()
    assert " ai#" not in plan and " aj#" not in plan  # no row for a pair of assets
    model = {m.ref_ix: m for m in models.collect()}
    found = {r.ix: r.ae_ratio for r in ratio.collect()}
    assert sorted(found) == list(range(44, 90))
    z = x["U"] / x["U"].std(axis=0, ddof=1)
    for ix in (44, 63, 64, 89):
        m = model[ix - (ix - 44) % 20]
        c = np.cov(z[ix - 40 : ix].T)
        out = (c @ np.reshape(m.enc, (600, 3)) + m.enc_bias) @ np.reshape(m.dec, (3, 600)) + m.dec_bias
        assert found[ix] == pytest.approx(np.trace(out) / np.trace(c), rel=1e-9)


def test_incomplete_rows_have_no_ratio(spark):
    returns, _ = panel(spark, 40, 3, 3)
    constant = returns.withColumn("r", returns.r * 0)
    rows = B.date_rows(constant, M.deviations(constant))
    models = B.fit_models(B.date_rows(returns, M.deviations(returns)), B.asset_names(returns), dates(returns), 10, 20, 1, 10)
    assert {r.ae_ratio for r in B.ratio(rows, dates(returns), models, 10, 20, 1, 10).collect()} == {None}
    assert B.ratio(rows.where("ix != 15"), dates(returns), models, 10, 20, 1, 10).where("ix < 26").count() == 0
    assert B.ratio(rows.where("false"), dates(returns), models, 10, 20, 1, 10).count() == 0


def test_one_step_of_training_by_hand():
    """Adam's first step moves every parameter with a gradient by the learning rate, against its sign."""
    matrix = np.array([[[2.0, 0.0], [0.0, 1.0]]], np.float32)
    start = E.train(matrix, 1, E.TrainSpec(epochs=0))
    end = E.train(matrix, 1, E.TrainSpec(epochs=1, batch=1))
    enc, dec = (np.array(start[k]) for k in ("enc", "dec"))
    error = np.outer(matrix[0] @ enc, dec) - matrix[0]
    assert start["loss_first"] == pytest.approx(float((error**2).mean()), rel=1e-5)
    back = error @ dec
    for name, gradient in (("enc", matrix[0].T @ back), ("enc_bias", [back.sum()]), ("dec", (matrix[0] @ enc) @ error), ("dec_bias", error.sum(0))):
        want = np.array(start[name]) - 0.01 * np.sign(gradient)
        assert end[name] == pytest.approx(want, abs=1e-5)
