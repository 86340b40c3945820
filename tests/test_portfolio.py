"""Bounded portfolios: optimality, bounds that bind or not, keys without a solution."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanfolio.functions.quadratic import least_variance
from spanfolio.operators import moments as M
from spanfolio.operators import portfolio as O
from test_golden import KEY, moments_of


def weights_of(*problem):
    w, status = least_variance(*problem)
    assert (w is not None) == (status == "ok") and status != "not_converged"
    return w


def problem(seed, n):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n, n + 6))
    return a @ a.T / n, rng.normal(size=n) * 0.1 + 0.05


@pytest.mark.parametrize("seed", range(25))
def test_long_only_is_optimal(seed):
    n = 2 + seed
    cov, mu = problem(seed, n)
    floor = float(np.quantile(mu, 0.4 + 0.6 * (seed % 5) / 4))
    w = weights_of(cov, [(mu, floor)] + [(e, 0.0) for e in np.eye(n)])
    assert w.sum() == pytest.approx(1.0)
    assert w.min() > -1e-9 and w @ mu > floor - 1e-9
    # No direction towards another allowed portfolio lowers the variance.
    g = cov @ w
    rng = np.random.default_rng(seed)
    best = np.eye(n)[int(np.argmax(mu))]
    for y in [best, *(best * t + rng.dirichlet(np.ones(n)) * (1 - t) for t in rng.uniform(0, 1, 200))]:
        if y @ mu >= floor:
            assert g @ (y - w) >= -1e-8 * abs(g).max()


@pytest.mark.parametrize("seed", range(12))
def test_short_limits(seed):
    n = 3 + seed
    cov, mu = problem(seed, n)
    floor = float(np.quantile(mu, 0.7))
    variance = []
    for limit in (0.0, 0.05, 0.2, 1e6):
        w = weights_of(cov, [(mu, floor)], limit)
        assert -w[w < 0].sum() <= limit + 1e-9
        variance.append(w @ cov @ w)
    assert all(a >= b - 1e-12 for a, b in zip(variance, variance[1:]))
    long_only = weights_of(cov, [(mu, floor)] + [(e, 0.0) for e in np.eye(n)])
    free = weights_of(cov, [(mu, floor)])
    assert variance[0] == pytest.approx(long_only @ cov @ long_only, rel=1e-8)
    assert variance[-1] == pytest.approx(free @ cov @ free, rel=1e-8)


@pytest.mark.parametrize("seed", range(60))
def test_short_limit_is_feasible_up_to_the_best_return(seed):
    """With shorts s the best return is (1 + s) times the largest mean less s times the smallest."""
    rng = np.random.default_rng(1000 + seed)
    n = int(rng.integers(2, 9))
    cov, mu = problem(seed, n)
    if seed % 2:
        mu = 0.037 + 0.003 * rng.uniform(size=n)
    limit = float(rng.choice([0.0, 0.05, 0.1, 0.3]))
    best = (1 + limit) * mu.max() - limit * mu.min()
    width = best - mu.mean()
    for share in (0.2, 0.9, 0.999, 1.001, 1.1, 3.0):
        floor = float(mu.mean() + share * width)
        w = weights_of(cov, [(mu, floor)], limit)
        if share > 1:
            assert w is None
        else:
            assert w.sum() == pytest.approx(1.0, abs=1e-9)
            assert w @ mu >= floor - 1e-9 and -w[w < 0].sum() <= limit + 1e-9
        long = weights_of(cov, [(mu, floor)] + [(e, 0.0) for e in np.eye(n)])
        if floor > mu.max() + 1e-6:
            assert long is None
        elif floor < mu.max() - 1e-6:
            assert long.sum() == pytest.approx(1.0, abs=1e-9) and long.min() > -1e-9


def test_floor_out_of_reach_of_close_means():
    packed = [0.07536971907366981, -0.011171480888217657, -0.0017808319531060616,
              0.07855935329455684, 0.01570672468609328, 0.08972998675768222]
    cov = np.empty((3, 3))
    cov[np.triu_indices(3)] = packed
    cov.T[np.triu_indices(3)] = packed
    mu = np.array([0.034388070364178236, 0.03966376547990472, 0.04000820392647216])
    assert weights_of(cov, [(mu, 0.04182201458253688)], 0.1) is None


def test_many_keys_with_and_without_solution(spark):
    cov, mu = problem(4, 6)
    mu_df, cov_df = moments_of(spark, mu, cov)
    rows = M.matrix_rows(cov_df, KEY, mu_df).withColumn(
        "target", F.explode(F.array(*[F.lit(float(t)) for t in (mu.min(), mu.mean(), mu.max() + 0.1)]))
    )
    bound = O.solve(rows, "long_only", F.col("target")).orderBy("target").collect()
    assert [r.status for r in bound] == ["ok", "ok", "infeasible"]
    assert bound[2].w is None
    free = O.solve(rows, "return_floor", F.col("target")).orderBy("target").collect()
    assert [r.status for r in free] == ["ok"] * 3
    long = O.weights_long(O.solve(rows, "long_only", F.col("target")), ["universe", "target"])
    assert long.count() == 18 and long.where("w is null").count() == 6


def test_statuses(spark):
    cov, mu = problem(8, 4)
    mu_df, cov_df = moments_of(spark, mu, cov)
    rows = M.matrix_rows(cov_df, KEY, mu_df)
    assert O.solve(rows, "target_vol", 1e-6).first().status == "below_minimum"
    balance = float(np.linalg.solve(cov, mu).sum() / np.linalg.solve(cov, np.ones(4)).sum())
    assert O.solve(rows, "tangency", balance).first().status == "no_tangency"
    flat = M.matrix_rows(cov_df.withColumn("cov", F.lit(1.0)), KEY, mu_df)
    assert O.solve(flat.withColumn("cov", F.transform("cov", lambda c: c * 0)), "min_variance").first().status == "singular"
    with pytest.raises(ValueError):
        O.solve(rows, "guess")


def test_keys_of_different_size_in_one_batch(spark):
    parts = []
    for i, n in enumerate((2, 5, 3, 5, 1)):
        cov, mu = problem(i, n)
        m, c = moments_of(spark, mu, cov)
        parts.append((m.withColumn("universe", F.lit(f"u{i}")), c.withColumn("universe", F.lit(f"u{i}")), cov))
    mu_df, cov_df = parts[0][0], parts[0][1]
    for m, c, _ in parts[1:]:
        mu_df, cov_df = mu_df.unionByName(m), cov_df.unionByName(c)
    solved = O.solve(M.matrix_rows(cov_df, KEY, mu_df).coalesce(1), "min_variance").collect()
    assert len(solved) == 5
    for r in solved:
        cov = parts[int(r.universe[1:])][2]
        want = np.linalg.solve(cov, np.ones(len(cov)))
        assert r.w == pytest.approx(want / want.sum(), rel=1e-9)


def test_same_answer_when_no_bound_binds(spark):
    cov, mu = np.diag([1.0, 2.0, 4.0]), np.array([0.1, 0.2, 0.3])
    mu_df, cov_df = moments_of(spark, mu, cov)
    rows = M.matrix_rows(cov_df, KEY, mu_df)
    free = O.weights_long(O.solve(rows, "return_floor", 0.0), KEY)
    bound = O.weights_long(O.solve(rows, "long_only", 0.0), KEY)
    assert O.solution_diff(free, bound, KEY).agg(F.max("diff")).first()[0] == pytest.approx(0.0, abs=1e-12)
