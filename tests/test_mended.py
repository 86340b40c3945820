"""Cases that used to be cut, hidden or wrong."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanfolio.operators import moments as M
from spanfolio.operators import panel as P
from spanfolio.operators import portfolio as O
from spanfolio.operators import rates as L
from spanfolio.operators import signal as G
from spanfolio.operators import spectrum as C
from spanfolio.sources import sheets, workspace

DAY = dt.date(2000, 1, 1)


def test_series_longer_than_2520_rows(spark):
    n = 2700
    r = np.random.default_rng(0).normal(size=(n, 3))
    days = [DAY + dt.timedelta(days=i) for i in range(n)]
    rows = [("U", d, i, a, 3, float(r[i, k])) for i, d in enumerate(days) for k, a in enumerate("ABC")]
    returns = spark.createDataFrame(rows, "universe string, dt date, ix long, asset string, n_assets long, r double")
    dates = returns.select("universe", "dt", "ix").distinct()
    series = C.absorption_series(returns, dates, 504, 1512)
    assert series.count() == n - 1512 and series.agg(F.max("ix")).first()[0] == n - 1


def test_windows_without_variance_are_kept(spark):
    cov = spark.createDataFrame([("U", DAY, 5, "A", "A", 0.0)], "universe string, dt date, ix long, ai string, aj string, cov double")
    found = C.absorption_and_components(C.eigenvalues(cov, C.WINDOW), C.WINDOW).collect()
    assert [(f["ar"], f["components"]) for f in found] == [(None, None)]


def book(spark, weights, returns):
    w = spark.createDataFrame([("U", DAY + dt.timedelta(days=i), a, x) for i, a, x in weights], "universe string, dt date, asset string, w double")
    r = spark.createDataFrame([("U", DAY + dt.timedelta(days=i), a, x) for i, a, x in returns], "universe string, dt date, asset string, r double")
    return G.backtest(w, r).first()


def test_a_date_with_one_fund_missing_has_no_result(spark):
    weights = [(i, a, 0.5) for i in range(4) for a in ("EQ", "FI")]
    returns = [(i, a, 0.01 * (i + 1)) for i in range(4) for a in ("EQ", "FI") if (i, a) != (2, "FI")]
    got = book(spark, weights, returns)
    assert (got["n"], got["n_unmatched"]) == (3, 1)
    assert got["ann_ret"] == pytest.approx((1.01 * 1.02 * 1.04) ** (252 / 3) - 1)


def test_total_loss(spark):
    got = book(spark, [(i, "EQ", 1.0) for i in range(3)], [(0, "EQ", 0.01), (1, "EQ", -1.0), (2, "EQ", 0.01)])
    assert got["ann_ret"] == -1.0 and got["n"] == 3


def test_padded_returns_number_all_dates(spark):
    prices = [("A", 0, 1.0), ("A", 1, 2.0), ("A", 3, 3.0), ("B", 1, 5.0), ("B", 2, 10.0)]
    panel = spark.createDataFrame([("U", DAY + dt.timedelta(days=i), a, p) for a, i, p in prices], "universe string, dt date, asset string, price double")
    got = {(r["asset"], r["ix"]): r["r"] for r in P.padded_returns(panel, 1).collect()}
    assert got == {("A", 1): 1.0, ("A", 2): 0.0, ("A", 3): 0.5, ("B", 2): 1.0, ("B", 3): 0.0}


def test_keys_fail_alone(spark):
    r = np.random.default_rng(1).normal(size=(40, 3))
    columns = {"good": {"A": r[:, 0], "B": r[:, 1], "C": r[:, 2]}, "twice": {"A": r[:, 0], "B": r[:, 0], "C": r[:, 2]}}
    columns["near"] = {"A": r[:, 0], "B": r[:, 0] * (1 + 1e-9), "C": r[:, 2]}
    columns["short"] = {a: v[:2] for a, v in columns["good"].items()}
    rows = [(u, DAY + dt.timedelta(days=i), i, a, 3, float(x)) for u, c in columns.items() for a, v in c.items() for i, x in enumerate(v)]
    returns = spark.createDataFrame(rows, "universe string, dt date, ix long, asset string, n_assets long, r double")
    matrices = M.matrix_rows(M.covariance(returns), ["universe"]).withColumn("mu", F.array_repeat(F.lit(0.0), 3))
    free = {r["universe"]: r["status"] for r in O.solve(matrices, "min_variance").collect()}
    assert free == {"good": "ok", "twice": "singular", "near": "singular", "short": "singular"}
    for method, limit in (("long_only", None), ("short_budget", 0.1)):
        bound = {r["universe"]: r for r in O.solve(matrices, method, None, limit).collect()}
        assert all(b["status"] == "ok" and sum(b["w"]) == pytest.approx(1) for b in bound.values())
        w = np.array(bound["twice"]["w"])
        cov = np.cov(np.array([columns["twice"][a] for a in "ABC"]))
        pair = np.cov(np.array([columns["twice"][a] for a in "AC"]))
        best = min(np.array([x, 1 - x]) @ pair @ np.array([x, 1 - x]) for x in np.linspace(0, 1, 2001))
        assert w @ cov @ w == pytest.approx(best, rel=1e-4) and w[0] == pytest.approx(w[1], abs=1e-4)


def test_books_tell_what_has_no_price(spark):
    contracts = spark.createDataFrame([(1, 1, "d", 100.0, 0, 2), (2, 2, "d", 50.0, 0, 2), (3, 2, "e", 7.0, 0, 3)],
        "contract_id long, curve_id long, desk string, notional double, strike_step long, exercise long")
    spots = [0.03] * 10, [-0.5] * 10
    curves = spark.createDataFrame([(1, spots[0]), (2, spots[1])], "curve_id long, spot array<double>")
    levels = L.calibrate(curves)
    assert {r["curve_id"]: r["status"] == "ok" for r in levels.collect()} == {1: True, 2: False}
    priced = L.price_swaps(contracts, levels, F.lit(0.03))
    options = {(r["desk"], r["curve_id"]): (r["notional"], r["unpriced"], r["value"] is None) for r in L.swaption_values(priced).collect()}
    assert options == {("d", 1): (100.0, 0.0, False), ("d", 2): (50.0, 50.0, True), ("e", 2): (7.0, 7.0, True)}
    swaps = [(r["desk"], r["state"], r["unpriced"]) for r in L.swap_values(priced).collect()]
    assert sorted(s for s in swaps if s[0] == "d") == [("d", i, 50.0) for i in range(3)]
    assert [s for s in swaps if s[0] == "e"] == [("e", None, 7.0)]


def test_sheets_go_by_their_header(spark, tmp_path):
    (tmp_path / "s.csv").write_text("date,B,A\n2020-01-01,1,2\n2020-01-02,,x\n")
    path = str(tmp_path / "s.csv")
    assert sheets.header(spark, path) == ["B", "A"]
    rows = sheets.read_wide_csv(spark, path, ["A", "B"]).orderBy("dt").collect()
    assert [(r["A"], r["B"]) for r in rows] == [(2.0, 1.0), (None, None)]
    with pytest.raises(ValueError):
        sheets.read_wide_csv(spark, path, ["C"])


def test_row_range_is_applied_before_the_matrix_step(spark):
    schema = "universe string, dt date, ix long, asset string, n_assets long, r double"
    returns = spark.createDataFrame([("U", DAY, 0, "A", 1, 0.0)], schema)
    text = M.rolling_cov(returns, returns.select("universe", "ix", "dt"), 504, 21, 1512, 1600)._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.index("FlatMapGroupsInArrow"):]
    assert ">= 1008" in below and "< 1600" in below


def test_tables_of_a_run_can_be_dropped(spark):
    table = workspace.materialise(spark.range(3).toDF("x"))
    assert table.count() == 3 and table.inputFiles()[0].split("://")[-1].lstrip("/").startswith(workspace.run_folder(spark).split("://")[-1].lstrip("/"))
