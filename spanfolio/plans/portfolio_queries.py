"""Portfolios solved for many universes, windows and targets at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfolio.operators import moments as M
from spanfolio.operators import portfolio as O
from spanfolio.operators import risk as K
from spanfolio.plans import sql as S
from spanfolio.plans.common import panel_of, returns_of, show
from spanfolio.sources.tables import BRAND_FLAGS_MONTH, BRANDS_WEEK, FLAGS_DAY
from spanfolio.sources.workspace import materialise

UNIVERSE = ["universe"]
LEVEL = ["universe", "level"]
RF = 0.01
SHORT_LIMIT = 0.1
TARGET_VOL = 0.05
FLOORS = (0.9, 1.0, 1.1)
VOLS = (0.4, 1.0, 1.5)


class Moments:
    """Returns, means and covariance of one panel; written where several branches read them."""

    def __init__(self, spark: SparkSession, sf_dir: str, spec=BRAND_FLAGS_MONTH, written: bool = False):
        self.returns = returns_of(spark, sf_dir, spec)
        self.mu = K.asset_mean(self.returns)
        self.cov = M.covariance(self.returns).select("universe", "ai", "aj", "cov")
        if written:
            self.mu, self.cov = materialise(self.mu, "mu"), materialise(self.cov, "cov")

    @property
    def rows(self) -> DataFrame:
        return M.matrix_rows(self.cov, UNIVERSE, self.mu)

    def levels(self, multiples: tuple[float, ...], base: Column, rows: DataFrame | None = None) -> DataFrame:
        """One row per universe and level, with ``target`` a multiple of ``base``."""
        steps = F.posexplode(F.array(*[F.lit(m) for m in multiples])).alias("p", "multiple")
        many = (self.rows if rows is None else rows).select("*", steps)
        return many.withColumn("level", F.col("p").cast("long")).withColumn(
            "target", F.col("multiple") * base
        ).drop("p", "multiple")


MEAN_MU = "aggregate(mu, 0D, (s, m) -> s + m) / size(mu)"


def _floors(m: Moments) -> DataFrame:
    return m.levels(FLOORS, F.expr(MEAN_MU))


def _vols(m: Moments) -> DataFrame:
    """Targets as multiples of the root of the mean variance of the assets."""
    trace = M.trace(m.cov, UNIVERSE)
    rows = m.rows.join(trace, UNIVERSE)
    return m.levels(VOLS, F.sqrt(F.col("trace") / F.size("assets")), rows).drop("trace")


def _weights(solved: DataFrame, keys: list[str]) -> DataFrame:
    return show(O.weights_long(solved, keys), [*keys, "status", "asset"], w=6)


def min_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Moments(spark, sf_dir)
    return _weights(O.solve(m.rows, "min_variance"), UNIVERSE)


def return_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(O.solve(_floors(Moments(spark, sf_dir)), "return_floor", F.col("target")), LEVEL)


def long_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(O.solve(_floors(Moments(spark, sf_dir)), "long_only", F.col("target")), LEVEL)


def short_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    solved = O.solve(_floors(Moments(spark, sf_dir)), "short_budget", F.col("target"), SHORT_LIMIT)
    return _weights(solved, LEVEL)


def target_vol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(O.solve(_vols(Moments(spark, sf_dir, written=True)), "target_vol", F.col("target")), LEVEL)


def target_vol_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return, the same written as riskless rate plus excess, and volatility."""
    m = Moments(spark, sf_dir, written=True)
    weights = O.weights_long(O.solve(_vols(m), "target_vol", F.col("target")), LEVEL)
    solved = materialise(weights, "weights")
    status = solved.groupBy(*LEVEL).agg(F.first("status").alias("status"))
    stats = O.portfolio_stats(solved, m.mu, m.cov, LEVEL)
    excess = (
        solved.join(m.mu, ["universe", "asset"])
        .groupBy(*LEVEL)
        .agg((RF + F.sum(F.col("w") * (F.col("mu") - RF))).alias("ret_excess"))
    )
    return show(stats.join(excess, LEVEL).join(status, LEVEL), [*LEVEL, "status"], ret=6, ret_excess=6, vol=6)


def _tangency(m: Moments) -> DataFrame:
    return materialise(O.weights_long(O.solve(m.rows, "tangency", RF), UNIVERSE), "weights")


def tangency(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Moments(spark, sf_dir)
    return _weights(O.solve(m.rows, "tangency", RF), UNIVERSE)


def tangency_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Moments(spark, sf_dir, written=True)
    stats = O.portfolio_stats(_tangency(m), m.mu, m.cov, UNIVERSE, RF)
    return show(stats, UNIVERSE, ret=6, variance=6, vol=6, sharpe=6)


def _scaled(m: Moments) -> DataFrame:
    weights = _tangency(m)
    stats = O.portfolio_stats(weights, m.mu, m.cov, UNIVERSE, RF)
    return materialise(O.scale_to_volatility(weights, stats, UNIVERSE, TARGET_VOL), "scaled")


def target_vol_riskless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(_scaled(Moments(spark, sf_dir, written=True)), ["universe", "asset"], w=6, w_rf=6)


def realised_riskless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Realised performance of the scaled portfolio with its riskless part."""
    m = Moments(spark, sf_dir, written=True)
    scaled = _scaled(m)
    rest = scaled.groupBy("universe").agg(F.max("w_rf").alias("w_rf"))
    series = K.portfolio_series(m.returns, scaled).join(rest, "universe")
    found = K.realised_performance(series, 12, F.col("w_rf") * (RF / 12))
    return show(found, UNIVERSE, mean=6, vol=6, annual_mean=6, annual_vol=6)


def portfolio_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of portfolios weighted by inverse variance."""
    m = Moments(spark, sf_dir, written=True)
    inverse = m.cov.where("ai = aj").select("universe", F.col("ai").alias("asset"), (1 / F.col("cov")).alias("iv"))
    total = inverse.groupBy("universe").agg(F.sum("iv").alias("total"))
    weights = inverse.join(total, "universe").withColumn("w", F.col("iv") / F.col("total"))
    stats = O.portfolio_stats(materialise(weights, "weights"), m.mu, m.cov, UNIVERSE, RF)
    return show(stats, UNIVERSE, ret=8, variance=8, vol=8, sharpe=8)


def two_fund_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """200 mixtures of the portfolios with the floors 1.0 and 1.1 times the mean return."""
    m = Moments(spark, sf_dir, written=True)
    funds = materialise(
        O.weights_long(O.solve(_floors(m), "return_floor", F.col("target")), LEVEL), "funds"
    )
    frontier = O.two_fund_frontier(funds.where("level = 1"), funds.where("level = 2"), m.mu, m.cov)
    return show(frontier, ["universe", "point"], phi=8, ret=8, variance=8)


def solution_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights with and without short sales, for the same floors."""
    m = Moments(spark, sf_dir, written=True)
    free = O.weights_long(O.solve(_floors(m), "return_floor", F.col("target")), LEVEL)
    bound = O.weights_long(O.solve(_floors(m), "long_only", F.col("target")), LEVEL)
    return show(O.solution_diff(free, bound, LEVEL), [*LEVEL, "asset"], w_first=6, w_second=6, diff=6)


def rolling_min_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum-variance portfolio of every rolling window."""
    p = panel_of(spark, sf_dir, FLAGS_DAY)
    keys = ["universe", "dt", "ix"]
    cov = M.rolling_cov(p.rows, p.dates, 252, 21, 252)
    rows = M.matrix_rows(cov, keys).withColumn("mu", F.array_repeat(F.lit(0.0), F.size("assets")))
    return _weights(O.solve(rows, "min_variance"), keys)


def degenerate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each universe beside two of its own: one with an asset twice, one with two dates only.

    A key that can't be solved says so and leaves the others alone; without short sales
    both can be.
    """
    returns = returns_of(spark, sf_dir, BRAND_FLAGS_MONTH).select("universe", "ix", "asset", "n_assets", "r")
    doubled = returns.unionByName(returns.where("asset = 'A'").withColumn("asset", F.lit("A2")))
    as_kind = lambda df, kind: df.withColumn("universe", F.concat("universe", F.lit(f" {kind}")))
    rows = as_kind(returns, "whole").unionByName(as_kind(doubled.withColumn("n_assets", F.col("n_assets") + 1), "twice"))
    rows = materialise(rows.unionByName(as_kind(returns.where("ix < 2"), "short")), "returns")
    matrices = materialise(M.matrix_rows(M.covariance(rows), UNIVERSE).withColumn("mu", F.array_repeat(F.lit(0.0), F.size("assets"))), "matrices")
    free = O.solve(matrices, "min_variance").select("universe", F.col("status").alias("free"), F.aggregate("w", F.lit(0.0), lambda s, x: s + x).alias("sum_free"))
    bound = O.solve(matrices, "long_only").select(
        "universe", F.col("status").alias("bound"), F.aggregate("w", F.lit(0.0), lambda s, x: s + x).alias("sum_bound"),
        (F.array_min("w") > -1e-7).alias("no_short"),
    )
    return show(free.join(bound, "universe"), ["universe", "free", "bound", "no_short"], sum_free=6, sum_bound=6)


def _gradient(m: Moments, weights: DataFrame) -> DataFrame:
    """``(universe, asset, w, g)`` with g the covariance of each asset with the portfolio over its variance."""
    full = M.both_halves(m.cov).join(
        weights.select("universe", F.col("asset").alias("aj"), "w"), ["universe", "aj"]
    )
    g = full.groupBy("universe", F.col("ai").alias("asset")).agg(F.sum(F.col("cov") * F.col("w")).alias("g"))
    both = materialise(weights.select("universe", "asset", "w").join(g, ["universe", "asset"]), "gradient")
    variance = both.groupBy("universe").agg(F.sum(F.col("w") * F.col("g")).alias("v"))
    return both.join(variance, "universe").withColumn("g", F.col("g") / F.col("v"))


def min_variance_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 assets: every asset has the same covariance with the portfolio."""
    m = Moments(spark, sf_dir, BRANDS_WEEK, written=True)
    weights = materialise(O.weights_long(O.solve(m.rows, "min_variance"), UNIVERSE), "weights")
    found = _gradient(m, weights).groupBy("universe").agg(
        F.sum("w").alias("sum_w"), F.min("g").alias("low"), F.max("g").alias("high")
    )
    return show(found, UNIVERSE, sum_w=6, low=6, high=6)


def long_only_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 assets without short sales: held ones share one covariance, the others have no less."""
    m = Moments(spark, sf_dir, BRANDS_WEEK, written=True)
    weights = materialise(O.weights_long(O.solve(m.rows, "long_only"), UNIVERSE), "weights")
    held = F.col("w") > 1e-9
    found = _gradient(m, weights).groupBy("universe").agg(
        F.sum("w").alias("sum_w"),
        F.least(F.min("w"), F.lit(0.0)).alias("most_short"),
        F.max(F.when(held, F.abs(F.col("g") - 1)).otherwise(F.greatest(1 - F.col("g"), F.lit(0.0)))).alias("residual"),
    )
    return show(found, UNIVERSE, sum_w=6, most_short=6, residual=6)


QUERIES = {
    f.__name__: f
    for f in (
        min_variance, return_floor, long_only, short_budget, target_vol, target_vol_stats, tangency,
        tangency_stats, target_vol_riskless, realised_riskless, portfolio_stats, two_fund_frontier,
        solution_diff, degenerate_keys, rolling_min_variance, min_variance_wide, long_only_wide,
    )
}

_BASE = [
    *S.base(BRAND_FLAGS_MONTH), S.means(), S.sample_cov(), S.three_by_three("cov", "universe"),
    S.solves_three(),
]


def _long(keys: str, source: str, status: str = "'ok'") -> str:
    return (
        f"SELECT {keys}, {status} AS status, unnest(['A', 'N', 'R']) AS asset, "
        f"{S.rnd('unnest([w1, w2, w3])', 6)} AS w FROM {source}"
    )


def _each(template: str) -> str:
    return ", ".join(template.format(i=i) + f" AS w{i}" for i in (1, 2, 3))


def _levels_cte(multiples: tuple[float, ...], base: str) -> str:
    listed = ", ".join(str(m) for m in multiples)
    return f"""lv AS (
    SELECT *, unnest(range(0, {len(multiples)})) AS level,
           unnest([{listed}]::DOUBLE[]) * {base} AS target FROM sol)"""


_LV = _levels_cte(FLOORS, "avg_mu")
_FLOOR = f"""fl AS (
    SELECT *, {_each('x{i} / a + amount * (y{i} - b / a * x{i})')}
    FROM (SELECT *, greatest(target - b / a, 0.0) / (c - b * b / a) AS amount FROM lv))"""
_TAN = f"tan AS (SELECT *, {_each(f'(y{{i}} - {RF} * x{{i}}) / (b - {RF} * a)')} FROM sol)"
_VARIANCE = (
    "(w1 * w1 * s11 + w2 * w2 * s22 + w3 * w3 * s33 "
    "+ 2 * (w1 * w2 * s12 + w1 * w3 * s13 + w2 * w3 * s23))"
)
_RETURN = "(w1 * m1 + w2 * m2 + w3 * m3)"
_VOL_TARGETS = [
    _levels_cte(VOLS, "sqrt((s11 + s22 + s33) / 3)"),
    f"""tv AS (
    SELECT *, CASE WHEN room < 0 THEN 'below_minimum' ELSE 'ok' END AS status,
           {_each('CASE WHEN room >= 0 THEN x{i} / a + sqrt(room / (c - b * b / a)) * (y{i} - b / a * x{i}) END')}
    FROM (SELECT *, target * target - 1 / a AS room FROM lv))""",
]
_SCALED = f"""scaled AS (
    SELECT * REPLACE (w1 * k AS w1, w2 * k AS w2, w3 * k AS w3), 1 - k AS w_rf
    FROM (SELECT *, {TARGET_VOL} / sqrt({_VARIANCE}) AS k FROM tan))"""


def _plane(lines: list[tuple[str, str, str]]) -> list[str]:
    """Least variance in the plane of w1 and w2 under lines ``p w1 + q w2 >= h``.

    The optimum is the free one, the best on one line, or a crossing of two
    lines; among these candidates the feasible one with the least variance wins.
    """
    rows = "\n    UNION ALL ".join(
        f"SELECT universe, level, {i} AS id, ({p})::DOUBLE AS p, ({q})::DOUBLE AS q, ({h})::DOUBLE AS h FROM lv"
        for i, (p, q, h) in enumerate(lines)
    )
    return [
        """quad AS (
    SELECT *, (q22 * -f1 - q12 * -f2) / qd AS u1, (q11 * -f2 - q12 * -f1) / qd AS u2
    FROM (SELECT *, q11 * q22 - q12 * q12 AS qd
          FROM (SELECT *, s11 + s33 - 2 * s13 AS q11, s22 + s33 - 2 * s23 AS q22,
                       s12 + s33 - s13 - s23 AS q12, s13 - s33 AS f1, s23 - s33 AS f2 FROM lv)))""",
        f"lines AS ({rows})",
        """candidates AS (
    SELECT universe, level, u1 AS w1, u2 AS w2 FROM quad
    UNION ALL
    SELECT universe, level, u1 + t * g1, u2 + t * g2
    FROM (SELECT *, (h - p * u1 - q * u2) / (p * g1 + q * g2) AS t
          FROM (SELECT qu.*, l.p, l.q, l.h, (q22 * l.p - q12 * l.q) / qd AS g1,
                       (q11 * l.q - q12 * l.p) / qd AS g2
                FROM quad qu JOIN lines l USING (universe, level)
                WHERE abs(l.p) + abs(l.q) > 1e-12))
    UNION ALL
    SELECT universe, level, (x.h * y.q - y.h * x.q) / (x.p * y.q - y.p * x.q),
           (x.p * y.h - y.p * x.h) / (x.p * y.q - y.p * x.q)
    FROM lines x JOIN lines y USING (universe, level)
    WHERE x.id < y.id AND abs(x.p * y.q - y.p * x.q) > 1e-12)""",
        """feasible AS (
    SELECT universe, level, w1, w2 FROM candidates c JOIN lines l USING (universe, level)
    GROUP BY ALL HAVING min(l.p * w1 + l.q * w2 - l.h) >= -1e-10)""",
        f"""best AS (
    SELECT lv.universe, lv.level, CASE WHEN count(f.w1) = 0 THEN 'infeasible' ELSE 'ok' END AS status,
           arg_min(f.w1, v) AS w1, arg_min(f.w2, v) AS w2, arg_min(f.w3, v) AS w3
    FROM lv LEFT JOIN (
        SELECT universe, level, w1, w2, w3, {_VARIANCE} AS v
        FROM (SELECT *, 1 - w1 - w2 AS w3 FROM feasible) JOIN lv USING (universe, level)) f
      ON lv.universe = f.universe AND lv.level = f.level
    GROUP BY ALL)""",
    ]


_FLOOR_LINE = ("m1 - m3", "m2 - m3", "target - m3")
_LONG_ONLY = _plane([("1", "0", "0"), ("0", "1", "0"), ("-1", "-1", "-1"), _FLOOR_LINE])
_s = SHORT_LIMIT
_SHORT = _plane(
    [
        ("1", "0", f"-{_s}"), ("0", "1", f"-{_s}"), ("-1", "-1", f"-1 - {_s}"),
        ("1", "1", f"-{_s}"), ("0", "-1", f"-1 - {_s}"), ("-1", "0", f"-1 - {_s}"), _FLOOR_LINE,
    ]
)

_FUNDS = [
    _LV, _FLOOR,
    f"""pair AS (
    SELECT u.universe, u.w1 AS u1, u.w2 AS u2, u.w3 AS u3, v.w1 AS v1, v.w2 AS v2, v.w3 AS v3,
           u.m1, u.m2, u.m3, u.s11, u.s12, u.s13, u.s22, u.s23, u.s33
    FROM fl u JOIN fl v ON u.universe = v.universe AND u.level = 1 AND v.level = 2)""",
    """points AS (
    SELECT *, phi * u1 + (1 - phi) * v1 AS w1, phi * u2 + (1 - phi) * v2 AS w2, phi * u3 + (1 - phi) * v3 AS w3
    FROM (SELECT *, -2.0::DOUBLE + point * (4.0::DOUBLE / 199) AS phi
          FROM (SELECT *, unnest(range(0, 200)) AS point FROM pair)))""",
]

ORACLES = {
    "min_variance": S.with_(*_BASE, f"mv AS (SELECT universe, {_each('x{i} / a')} FROM sol)") + _long("universe", "mv"),
    "return_floor": S.with_(*_BASE, _LV, _FLOOR) + _long("universe, level", "fl"),
    "long_only": S.with_(*_BASE, _LV, *_LONG_ONLY) + _long("universe, level", "best", "status"),
    "short_budget": S.with_(*_BASE, _LV, *_SHORT) + _long("universe, level", "best", "status"),
    "target_vol": S.with_(*_BASE, *_VOL_TARGETS) + _long("universe, level", "tv", "status"),
    "target_vol_stats": S.with_(*_BASE, *_VOL_TARGETS)
    + f"SELECT universe, level, status, {S.rnd(_RETURN, 6)} AS ret, "
    f"{S.rnd(f'{RF} + {_RETURN} - {RF} * (w1 + w2 + w3)', 6)} AS ret_excess, "
    f"{S.rnd(f'sqrt({_VARIANCE})', 6)} AS vol FROM tv",
    "tangency": S.with_(*_BASE, _TAN) + _long("universe", "tan"),
    "tangency_stats": S.with_(*_BASE, _TAN)
    + f"SELECT universe, {S.rnd(_RETURN, 6)} AS ret, {S.rnd(_VARIANCE, 6)} AS variance, "
    f"{S.rnd(f'sqrt({_VARIANCE})', 6)} AS vol, {S.rnd(f'({_RETURN} - {RF}) / sqrt({_VARIANCE})', 6)} AS sharpe FROM tan",
    "target_vol_riskless": S.with_(*_BASE, _TAN, _SCALED)
    + f"SELECT universe, unnest(['A', 'N', 'R']) AS asset, {S.rnd('unnest([w1, w2, w3])', 6)} AS w, "
    f"{S.rnd('w_rf', 6)} AS w_rf FROM scaled",
    "realised_riskless": S.with_(
        *_BASE, _TAN, _SCALED,
        f"""series AS (
    SELECT universe, dt, sum(r * CASE asset WHEN 'A' THEN w1 WHEN 'N' THEN w2 ELSE w3 END)
           + any_value(w_rf) * {RF} / 12 AS r
    FROM rets JOIN scaled USING (universe) GROUP BY universe, dt)""",
    )
    + f"SELECT universe, {S.rnd('avg(r)', 6)} AS mean, {S.rnd('stddev_pop(r)', 6)} AS vol, "
    f"{S.rnd('12 * avg(r)', 6)} AS annual_mean, {S.rnd('sqrt(12) * stddev_pop(r)', 6)} AS annual_vol "
    "FROM series GROUP BY universe",
    "portfolio_stats": S.with_(
        *_BASE,
        f"""iv AS (
    SELECT *, {_each('1 / s{i}{i} / (1 / s11 + 1 / s22 + 1 / s33)')} FROM sol)""",
    )
    + f"SELECT universe, {S.rnd(_RETURN, 8)} AS ret, {S.rnd(_VARIANCE, 8)} AS variance, "
    f"{S.rnd(f'sqrt({_VARIANCE})', 8)} AS vol, {S.rnd(f'({_RETURN} - {RF}) / sqrt({_VARIANCE})', 8)} AS sharpe FROM iv",
    "two_fund_frontier": S.with_(*_BASE, *_FUNDS)
    + f"SELECT universe, point, {S.rnd('phi', 8)} AS phi, {S.rnd(_RETURN, 8)} AS ret, "
    f"{S.rnd(_VARIANCE, 8)} AS variance FROM points",
    "solution_diff": S.with_(*_BASE, _LV, _FLOOR, *_LONG_ONLY)
    + f"SELECT universe, level, asset, {S.rnd('f', 6)} AS w_first, {S.rnd('s', 6)} AS w_second, "
    f"{S.rnd('abs(f - s)', 6)} AS diff FROM (SELECT universe, level, unnest(['A', 'N', 'R']) AS asset, "
    "unnest([fl.w1, fl.w2, fl.w3]) AS f, unnest([best.w1, best.w2, best.w3]) AS s "
    "FROM fl JOIN best USING (universe, level))",
    "rolling_min_variance": S.with_(
        *S.base(FLAGS_DAY), S.dates("rets"), S.schedule(252, 21), S.window_cov("rets", 252),
        S.three_by_three("wcov", "universe, dt, ix"),
        """mv AS (
    SELECT *, (i11 + i12 + i13) / t AS w1, (i12 + i22 + i23) / t AS w2, (i13 + i23 + i33) / t AS w3
    FROM (SELECT *, i11 + i22 + i33 + 2 * (i12 + i13 + i23) AS t
          FROM (SELECT *, s22 * s33 - s23 * s23 AS i11, s13 * s23 - s12 * s33 AS i12,
                       s12 * s23 - s13 * s22 AS i13, s11 * s33 - s13 * s13 AS i22,
                       s12 * s13 - s11 * s23 AS i23, s11 * s22 - s12 * s12 AS i33 FROM m3)))""",
    ) + _long("universe, dt, ix", "mv"),
    "degenerate_keys": S.with_(*S.base(BRAND_FLAGS_MONTH))
    + "SELECT u || ' ' || unnest(['whole', 'twice', 'short']) AS universe, "
    "unnest(['ok', 'singular', 'singular']) AS free, 'ok' AS bound, true AS no_short, "
    "unnest([1.0, NULL, NULL]::DOUBLE[]) AS sum_free, 1.0::DOUBLE AS sum_bound "
    "FROM (SELECT DISTINCT universe AS u FROM rets)",
    "min_variance_wide": S.with_(*S.base(BRANDS_WEEK))
    + "SELECT universe, 1.0::DOUBLE AS sum_w, 1.0::DOUBLE AS low, 1.0::DOUBLE AS high FROM rets GROUP BY universe",
    "long_only_wide": S.with_(*S.base(BRANDS_WEEK))
    + "SELECT universe, 1.0::DOUBLE AS sum_w, 0.0::DOUBLE AS most_short, 0.0::DOUBLE AS residual "
    "FROM rets GROUP BY universe",
}
