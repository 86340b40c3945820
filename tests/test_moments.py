"""Covariance windows against brute force on small panels."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanfolio.operators import moments as M
from spanfolio.operators import spectrum as C
from spanfolio.operators.panel import half_life_weights, standardise

SCHEMA = "universe string, dt date, ix long, asset string, n_assets long, r double"
DAY = dt.date(2020, 1, 1)


def panel(spark, x, universe="U"):
    """A panel from a dates-by-assets matrix."""
    rows = [
        (universe, DAY + dt.timedelta(days=i), i, f"a{j:03d}", x.shape[1], float(x[i, j]))
        for i in range(x.shape[0])
        for j in range(x.shape[1])
    ]
    return spark.createDataFrame(rows, SCHEMA)


def dates(returns):
    return returns.select("universe", "dt", "ix").distinct()


def matrix(rows, n):
    out = np.full((n, n), np.nan)
    for r in rows:
        i, j = int(r.ai[1:]), int(r.aj[1:])
        assert i <= j
        assert np.isnan(out[i, j])
        out[i, j] = out[j, i] = r["cov"]
    return out


def by_ix(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.ix, []).append(r)
    return found


@pytest.fixture(scope="module")
def x():
    rng = np.random.default_rng(7)
    return rng.normal(size=(130, 5)) @ rng.normal(size=(5, 5)) + 3.0


@pytest.fixture(scope="module")
def returns(spark, x):
    return panel(spark, x).cache()


def test_sample_covariance(returns, x):
    found = M.covariance(returns).collect()
    assert np.allclose(matrix(found, 5), np.cov(x, rowvar=False), rtol=1e-12)
    assert {r.n for r in found} == {130}


@pytest.mark.parametrize("tile", [1, 2, 3])
def test_tiles_give_the_same_moments(returns, tile):
    keys = ["universe", "block", "ai", "aj", "n"]
    whole = {tuple(r[k] for k in keys): r for r in M.block_moments(returns, 10).collect()}
    tiled = M.block_moments(returns, 10, tile).collect()
    assert len(tiled) == len(whole) == 13 * 15
    for r in tiled:
        w = whole[tuple(r[k] for k in keys)]
        assert (r.sx, r.sy, r.cxy) == pytest.approx((w.sx, w.sy, w.cxy), abs=1e-12)


@pytest.mark.parametrize(
    "lookback, step, start, stop", [(24, 6, 30, 120), (24, 1, 24, None), (7, 1, 9, None), (20, 7, 31, 100), (30, 10, 10, None)]
)
def test_rolling_windows(returns, x, lookback, step, start, stop):
    found = by_ix(M.rolling_cov(returns, dates(returns), lookback, step, start, stop))
    due = [i for i in range(start, stop or 130, step) if i >= lookback]
    assert sorted(found) == due
    for ix, rows in found.items():
        assert rows[0].dt == DAY + dt.timedelta(days=ix)
        assert np.allclose(matrix(rows, 5), np.cov(x[ix - lookback : ix], rowvar=False), rtol=1e-10, atol=1e-12)


def test_long_lookback_over_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(M, "CHUNK_ROWS", 32)
    x = np.random.default_rng(3).normal(size=(300, 2))
    r = panel(spark, x)
    found = by_ix(M.rolling_cov(r, dates(r), 100, 20, 100))
    assert sorted(found) == list(range(100, 300, 20))
    for ix, rows in found.items():
        assert np.allclose(matrix(rows, 2), np.cov(x[ix - 100 : ix], rowvar=False))


def test_growing_windows(returns, x):
    found = by_ix(M.expanding_cov(returns, dates(returns), 10, 20))
    assert sorted(found) == list(range(20, 130, 10))
    for ix, rows in found.items():
        assert np.allclose(matrix(rows, 5), np.cov(x[:ix], rowvar=False))


@pytest.mark.parametrize("decay", ["as_reference", "recent_first"])
def test_weighted_windows(spark, returns, x, decay):
    found = by_ix(M.weighted_window_cov(returns, dates(returns), 24, 6, 30, 10.0, decay))
    w = 2.0 ** (-np.arange(24) / 10.0)
    w /= w.sum()
    if decay == "recent_first":
        w = w[::-1]
    assert sorted(found) == list(range(30, 130, 6))
    for ix, rows in found.items():
        want = np.cov(x[ix - 24 : ix] * w[:, None], rowvar=False)
        assert np.allclose(matrix(rows, 5), want, rtol=1e-10)


@pytest.mark.parametrize("decay", ["as_reference", "recent_first"])
@pytest.mark.parametrize("lookback,step,start,half_life", [(24, 1, 25, 0.02), (60, 7, 60, 0.5), (12, 12, 24, 3.0), (50, 5, 50, 1e6)])
def test_weighted_windows_of_any_half_life(returns, x, decay, lookback, step, start, half_life):
    df = M.weighted_window_cov(returns, dates(returns), lookback, step, start, half_life, decay)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "posexplode" not in plan
    found = by_ix(df)
    w = 2.0 ** (-np.arange(lookback) / half_life)
    w = (w / w.sum())[:: -1 if decay == "recent_first" else 1]
    assert sorted(found) == list(range(start, 130, step))
    for ix, rows in found.items():
        want = np.cov(x[ix - lookback : ix] * w[:, None], rowvar=False)
        assert np.allclose(matrix(rows, 5), want, rtol=1e-9, atol=1e-14)


def test_unknown_decay_is_refused(returns):
    with pytest.raises(ValueError):
        M.weighted_window_cov(returns, dates(returns), 24, 6, 30, 10.0, "sideways")


def test_half_life_weights(spark, returns):
    w = [r.w for r in half_life_weights(dates(returns), 40.0).orderBy("ix").collect()]
    assert sum(w) == pytest.approx(1.0)
    assert w[0] == max(w)
    assert w[40] == pytest.approx(w[0] / 2)


def test_one_universe_with_most_rows(spark):
    """A third of all rows and more in one universe: same results, universe by universe."""
    rng = np.random.default_rng(11)
    sizes = {"big": (400, 6), "mid": (90, 3), "one": (2, 2)}
    data = {u: rng.normal(size=s) for u, s in sizes.items()}
    everything = None
    for u, x in data.items():
        part = panel(spark, x, u)
        everything = part if everything is None else everything.unionByName(part)
    found = M.covariance(everything).collect()
    for u, x in data.items():
        mine = [r for r in found if r.universe == u]
        assert np.allclose(matrix(mine, x.shape[1]), np.cov(x, rowvar=False))


def test_spectrum_measures(spark, returns, x):
    keys = ["universe"]
    cov = M.covariance(returns)
    spectra = C.spectrum(cov, keys).cache()
    want = np.linalg.eigvalsh(np.cov(x, rowvar=False))[::-1]
    got = [r["lambda"] for r in spectra.orderBy("k").collect()]
    assert got == pytest.approx(want, rel=1e-10)
    trace = M.trace(cov, keys).first().trace
    assert sum(got) == pytest.approx(trace)
    share = np.cumsum(want) / want.sum()
    last = 0.0
    for frac in (0.2, 0.4, 0.6, 1.0):
        ar = C.absorption_ratio(spectra, keys, frac).first().ar
        assert ar == pytest.approx(share[max(1, int(frac * 5)) - 1])
        assert last < ar <= 1 + 1e-12
        last = ar
    for t in (0.5, 0.8, 0.99):
        need = C.components_needed(spectra, keys, t).first().components
        assert need == int(np.searchsorted(share, t) + 1)
    assert C.components_needed(spectra, keys, 1.5).first().components == 6
    both = C.absorption_and_components(C.eigenvalues(cov, keys), keys, 0.4, 0.8).first()
    assert both.ar == pytest.approx(share[1])
    assert both.components == int(np.searchsorted(share, 0.8) + 1)
    never = C.absorption_and_components(C.eigenvalues(cov, keys), keys, 0.4, 1.5).first()
    assert never.components == 6


def test_pca_of_the_matrix_rows(spark, returns, x):
    c = np.cov(x, rowvar=False)
    want = np.linalg.eigvalsh(np.cov(c, rowvar=False))[::-1]
    spectra = C.spectrum(M.covariance(returns), ["universe"], "pca_of_cov")
    got = [r["lambda"] for r in spectra.orderBy("k").collect()]
    assert np.allclose(got, want, atol=1e-9 * want[0])


def test_absorption_series_carries_values(spark, returns, x):
    series = C.absorption_series(returns, dates(returns), 24, 30, 100, refresh=21).orderBy("ix").collect()
    assert [r.ix for r in series] == list(range(30, 100))
    for r in series:
        ref = r.ix - (r.ix - 30) % 21
        values = np.linalg.eigvalsh(np.cov(x[ref - 24 : ref], rowvar=False))[::-1]
        assert r.ar == pytest.approx(values[0] / values.sum())


def test_standardised_windows_equal_windows_of_standardised_rows(returns):
    a = by_ix(M.rolling_cov(standardise(returns), dates(returns), 24, 6, 30))
    b = by_ix(M.standardised_cov(M.rolling_cov(returns, dates(returns), 24, 6, 30), M.deviations(returns)))
    assert sorted(a) == sorted(b)
    for ix in a:
        assert np.allclose(matrix(a[ix], 5), matrix(b[ix], 5), rtol=1e-10)


def test_asset_without_deviation_gives_unknown_spectrum(spark):
    x = np.random.default_rng(2).normal(size=(30, 3))
    x[:, 1] = 0.5
    r = panel(spark, x)
    cov = M.standardised_cov(M.covariance(r), M.deviations(r))
    assert [v["lambda"] for v in C.spectrum(cov, ["universe"]).collect()] == [None] * 3


def test_trace_and_mirror(spark, returns, x):
    cov = M.covariance(returns)
    full = M.both_halves(cov).collect()
    assert len(full) == 25
    ratio = M.trace_ratio(cov.withColumn("cov", F.col("cov") * 0.25), cov, ["universe"])
    assert ratio.first().trace_ratio == pytest.approx(0.25)
