"""Means, covariance, tail risk, realised performance and luck."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfolio.operators import moments as M
from spanfolio.operators import panel as P
from spanfolio.operators import risk as K
from spanfolio.operators import rolling as R
from spanfolio.plans import sql as S
from spanfolio.plans.common import panel_of, returns_of, show
from spanfolio.sources.tables import (
    BRAND_FLAGS_MONTH,
    BRANDS_WEEK,
    FLAGS_DAY,
    TYPES_DAY,
    TYPES_WEEK,
    track_records,
)
from spanfolio.sources.workspace import materialise

ASSET = ["universe", "asset"]
PAIR = ["universe", "ai", "aj"]
WINDOW_PAIR = ["universe", "dt", "ix", "ai", "aj", "n"]


def asset_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(K.asset_mean(returns_of(spark, sf_dir, BRANDS_WEEK)), ASSET, mu=8)


def shrinkage_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    mu = K.asset_mean(returns_of(spark, sf_dir, BRANDS_WEEK))
    return show(K.shrink_mean(mu, 0.9), ASSET, mu=8, shrunk=8)


def asset_risk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = K.tail_risk(returns_of(spark, sf_dir, BRANDS_WEEK), ASSET, 0.1)
    return show(report, ASSET, variance=8, var_q=8, cvar_q=8)


def risk_report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written as a table and read back."""
    report = K.tail_risk(returns_of(spark, sf_dir, BRAND_FLAGS_MONTH), ASSET, 0.1)
    return show(materialise(report, "risk"), ASSET, variance=8, var_q=8, cvar_q=8)


def extreme_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.extremes(K.tail_risk(returns_of(spark, sf_dir, BRAND_FLAGS_MONTH), ASSET, 0.1))


def covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(M.covariance(returns_of(spark, sf_dir, BRANDS_WEEK)), [*PAIR, "n"], cov=8)


def covariance_by_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(M.covariance(returns_of(spark, sf_dir, BRAND_FLAGS_MONTH)), [*PAIR, "n"], cov=8)


def cov_annualised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent returns per month to covariance per year in decimals, rounded half-even to 4."""
    percent = returns_of(spark, sf_dir, BRAND_FLAGS_MONTH).withColumn("r", F.col("r") * 100)
    return show(M.annualise_cov(M.covariance(percent)), PAIR, cov=4)


def trace_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    cov = M.covariance(returns_of(spark, sf_dir, BRAND_FLAGS_MONTH))
    return show(M.trace(cov, ["universe"]), ["universe"], trace=8)


def trace_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace of the covariance of the later half of each universe over that of all dates."""
    returns = returns_of(spark, sf_dir, BRAND_FLAGS_MONTH)
    rows = returns.groupBy("universe").agg((F.max("ix") + 1).alias("n"))
    later = M.covariance(returns.join(rows, "universe").where("2 * ix >= n").drop("n"))
    ratio = M.trace_ratio(later, M.covariance(returns), ["universe"])
    return show(ratio, ["universe"], trace_ratio=8)


def _scaled(found: DataFrame, panel) -> DataFrame:
    """Windows of standardised returns."""
    return show(M.standardised_cov(found, panel.deviation), WINDOW_PAIR, cov=6)


def rolling_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panel_of(spark, sf_dir, TYPES_DAY)
    return _scaled(M.rolling_cov(p.rows, p.dates, 504, 21, 1512), p)


def rolling_cov_every_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panel_of(spark, sf_dir, TYPES_WEEK)
    return _scaled(M.rolling_cov(p.rows, p.dates, 104, 1, 104), p)


def snapshot_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five matrices, 60 rows apart."""
    p = panel_of(spark, sf_dir, TYPES_DAY)
    return _scaled(M.rolling_cov(p.rows, p.dates, 504, 60, 1000, 1300), p)


def stale_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix of the last refresh on every evaluated date."""
    p = panel_of(spark, sf_dir, TYPES_DAY)
    found = M.standardised_cov(M.rolling_cov(p.rows, p.dates, 504, 21, 1512), p.deviation)
    grid = P.evaluation_grid(p.dates, 1512, None, 1)
    return show(R.carry_forward(grid, found, 1512, 1, 21), WINDOW_PAIR, cov=6)


def expanding_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panel_of(spark, sf_dir, TYPES_DAY)
    return _scaled(M.expanding_cov(p.rows, p.dates, 21, 1512), p)


def _weighted_cov(spark: SparkSession, sf_dir: str, decay: str) -> DataFrame:
    """Weights multiply standardised rows, so these are standardised one by one."""
    p = panel_of(spark, sf_dir, TYPES_DAY)
    found = M.weighted_window_cov(
        P.standardise(p.rows), p.dates, 504, 21, 1512, 252.0, decay
    )
    return show(found.withColumn("cov", F.col("cov") * 1e6), WINDOW_PAIR, cov=6)


def weighted_window_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weighted_cov(spark, sf_dir, "as_reference")


def weighted_window_cov_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weighted_cov(spark, sf_dir, "recent_first")


def portfolio_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Portfolios weighted by the inverse variance of their assets."""
    returns = returns_of(spark, sf_dir, BRAND_FLAGS_MONTH)
    inverse = returns.groupBy(*ASSET).agg((1 / F.var_samp("r")).alias("iv"))
    total = inverse.groupBy("universe").agg(F.sum("iv").alias("total"))
    weights = inverse.join(total, "universe").withColumn("w", F.col("iv") / F.col("total"))
    return show(K.portfolio_series(returns, weights), ["universe", "dt"], r=8)


def equal_weight_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = materialise(K.equal_weight_series(returns_of(spark, sf_dir, BRAND_FLAGS_MONTH)), "series")
    return show(K.tail_risk(series, ["universe"], 0.1), ["universe"], variance=8, var_q=8, cvar_q=8)


def _losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = K.equal_weight_series(returns_of(spark, sf_dir, BRAND_FLAGS_MONTH))
    return series.select("universe", (-F.col("r")).alias("loss"))


def ceiling_var(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = K.ceiling_risk(_losses(spark, sf_dir), ["universe"], 0.9)
    return show(found, ["universe", "n"], ceiling_var=8)


def ceiling_cvar(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = K.ceiling_risk(_losses(spark, sf_dir), ["universe"], 0.9)
    return show(found, ["universe", "n"], ceiling_cvar=8)


def ceiling_risk_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = returns_of(spark, sf_dir, FLAGS_DAY).select(*ASSET, (-F.col("r")).alias("loss"))
    return show(K.ceiling_risk(losses, ASSET, 0.95), [*ASSET, "n"], ceiling_var=8, ceiling_cvar=8)


def realised_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = K.equal_weight_series(returns_of(spark, sf_dir, BRAND_FLAGS_MONTH))
    found = K.realised_performance(series, 12)
    return show(found, ["universe"], mean=8, vol=8, annual_mean=8, annual_vol=8)


def luck_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = materialise(track_records(spark, sf_dir), "records")
    return show(K.luck_screen(records), ["entity", "grp", "n", "wins"], tail=9)


def luck_screen_best_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = materialise(track_records(spark, sf_dir), "records")
    return show(K.best_of_group(K.luck_screen(records)), ["grp", "m"], tail=9, best_of=9)


QUERIES = {
    f.__name__: f
    for f in (
        asset_mean, shrinkage_mean, asset_risk_report, risk_report_table, extreme_risk, covariance,
        covariance_by_universe, cov_annualised, trace_total, trace_ratio, rolling_cov,
        rolling_cov_every_date, snapshot_cov, stale_cov, expanding_cov, weighted_window_cov,
        weighted_window_cov_recent, portfolio_series, equal_weight_risk, ceiling_var, ceiling_cvar,
        ceiling_risk_daily, realised_performance, luck_screen, luck_screen_best_of,
    )
}


def _report(source: str, keys: str, name: str = "report") -> str:
    return f"""{name} AS (
    SELECT {keys}, var_samp(r) AS variance, max(q) AS var_q, avg(r) FILTER (WHERE r <= q) AS cvar_q
    FROM (SELECT *, quantile_cont(r, 0.1) OVER (PARTITION BY {keys}) AS q FROM {source})
    GROUP BY {keys})"""


def _cols(**digits: int) -> str:
    return ", ".join(f"{S.rnd(c, d)} AS {c}" for c, d in digits.items())


_REPORT_COLS = _cols(variance=8, var_q=8, cvar_q=8)
_MONTH = S.base(BRAND_FLAGS_MONTH)
_WEEK = S.base(BRANDS_WEEK)
_DAILY = [*S.base(TYPES_DAY, standard=True), S.dates("zr")]
_WINDOWS = f"SELECT universe, dt, ix, ai, aj, n, {_cols(cov=6)} FROM wcov"
_EQUAL = "series AS (SELECT universe, dt, avg(r) AS r FROM rets GROUP BY ALL)"


def _ceiling(p: str, source: str, keys: str) -> str:
    return f"""risk AS (
    SELECT {keys}, max(n) AS n, max(loss) FILTER (WHERE k = k_p) AS ceiling_var,
           sum(loss) FILTER (WHERE k >= k_p) / ((1 - {p}::DOUBLE) * max(n)) AS ceiling_cvar
    FROM (SELECT *, ceil({p}::DOUBLE * n) AS k_p
          FROM (SELECT {keys}, -r AS loss, row_number() OVER (PARTITION BY {keys} ORDER BY -r) AS k,
                       count(*) OVER (PARTITION BY {keys}) AS n FROM {source}))
    GROUP BY {keys})"""


def _weighted(age: str) -> str:
    w = f"2.0 ** (-({age}) / 252.0) / (SELECT sum(2.0 ** (-j / 252.0)) FROM range(504) t(j))"
    return S.with_(
        *_DAILY, S.schedule(1512, 21), S.window_cov("zr", 504, value=f"$r * {w}")
    ) + f"SELECT universe, dt, ix, ai, aj, n, {S.rnd('cov * 1e6', 6)} AS cov FROM wcov"


_TRACK = """records AS (
    SELECT entity, s_nationkey::BIGINT AS grp, n, wins
    FROM (SELECT l_suppkey AS entity, count(*) AS n,
                 sum(CASE WHEN revenue > market THEN 1 ELSE 0 END)::BIGINT AS wins
          FROM (SELECT *, avg(revenue) OVER (PARTITION BY month) AS market
                FROM (SELECT l_suppkey, date_trunc('month', l_shipdate) AS month,
                             sum(l_extendedprice * (1 - l_discount)) AS revenue
                      FROM lineitem GROUP BY ALL))
          GROUP BY l_suppkey) JOIN supplier ON entity = s_suppkey)"""
_SCREEN = """screen AS (
    SELECT *, list_sum(list_transform(range(wins, n + 1), lambda j:
        exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + n * ln(0.5)))) AS tail
    FROM records)"""

ORACLES = {
    "asset_mean": S.with_(*_WEEK, S.means()) + f"SELECT universe, asset, {_cols(mu=8)} FROM mu",
    "shrinkage_mean": S.with_(*_WEEK, S.means())
    + f"SELECT universe, asset, {_cols(mu=8)}, "
    + S.rnd("0.9::DOUBLE * mu + 0.1::DOUBLE * avg(mu) OVER (PARTITION BY universe)", 8)
    + " AS shrunk FROM mu",
    "asset_risk_report": S.with_(*_WEEK, _report("rets", "universe, asset"))
    + f"SELECT universe, asset, {_REPORT_COLS} FROM report",
    "risk_report_table": S.with_(*_MONTH, _report("rets", "universe, asset"))
    + f"SELECT universe, asset, {_REPORT_COLS} FROM report",
    "extreme_risk": S.with_(*_MONTH, _report("rets", "universe, asset"))
    + "SELECT universe, arg_max(asset, variance) AS max_variance, arg_min(asset, var_q) AS worst_var, "
    "arg_min(asset, cvar_q) AS worst_cvar FROM report GROUP BY universe",
    "covariance": S.with_(*_WEEK, S.sample_cov()) + f"SELECT universe, ai, aj, n, {_cols(cov=8)} FROM cov",
    "covariance_by_universe": S.with_(*_MONTH, S.sample_cov())
    + f"SELECT universe, ai, aj, n, {_cols(cov=8)} FROM cov",
    "cov_annualised": S.with_(
        *_MONTH, "pct AS (SELECT universe, ix, asset, r * 100 AS r FROM rets)", S.sample_cov("pct")
    ) + f"SELECT universe, ai, aj, {S.rnd('12 * cov * 1e-4', 4)} AS cov FROM cov",
    "trace_total": S.with_(*_MONTH)
    + f"SELECT universe, {S.rnd('sum(v)', 8)} AS trace FROM "
    "(SELECT universe, asset, var_samp(r) AS v FROM rets GROUP BY ALL) GROUP BY universe",
    "trace_ratio": S.with_(*_MONTH)
    + f"SELECT universe, {S.rnd('sum(late) / sum(v)', 8)} AS trace_ratio FROM "
    "(SELECT universe, asset, var_samp(r) AS v, var_samp(r) FILTER (WHERE 2 * ix >= n) AS late FROM "
    "(SELECT *, max(ix) OVER (PARTITION BY universe) + 1 AS n FROM rets) GROUP BY ALL) GROUP BY universe",
    "rolling_cov": S.with_(*_DAILY, S.schedule(1512, 21), S.window_cov("zr", 504)) + _WINDOWS,
    "rolling_cov_every_date": S.with_(
        *S.base(TYPES_WEEK, standard=True), S.dates("zr"), S.schedule(104, 1), S.window_cov("zr", 104)
    ) + _WINDOWS,
    "snapshot_cov": S.with_(*_DAILY, S.schedule(1000, 60, 1300), S.window_cov("zr", 504)) + _WINDOWS,
    "stale_cov": S.with_(*_DAILY, S.schedule(1512, 21), S.window_cov("zr", 504))
    + f"SELECT c.universe, c.dt, c.ix, ai, aj, n, {_cols(cov=6)} FROM cal c JOIN wcov w "
    "ON w.universe = c.universe AND w.ix = c.ix - (c.ix - 1512) % 21 WHERE c.ix >= 1512",
    "expanding_cov": S.with_(*_DAILY, S.schedule(1512, 21), S.window_cov("zr", None)) + _WINDOWS,
    "weighted_window_cov": _weighted("a.ix - s.ix + 504"),
    "weighted_window_cov_recent": _weighted("s.ix - 1 - a.ix"),
    "portfolio_series": S.with_(
        *_MONTH,
        "iv AS (SELECT universe, asset, 1 / var_samp(r) AS iv FROM rets GROUP BY ALL)",
        "w AS (SELECT universe, asset, iv / sum(iv) OVER (PARTITION BY universe) AS w FROM iv)",
    ) + f"SELECT universe, dt, {S.rnd('sum(w * r)', 8)} AS r FROM rets JOIN w USING (universe, asset) GROUP BY universe, dt",
    "equal_weight_risk": S.with_(*_MONTH, _EQUAL, _report("series", "universe"))
    + f"SELECT universe, {_REPORT_COLS} FROM report",
    "ceiling_var": S.with_(*_MONTH, _EQUAL, _ceiling("0.9", "series", "universe"))
    + f"SELECT universe, n, {_cols(ceiling_var=8)} FROM risk",
    "ceiling_cvar": S.with_(*_MONTH, _EQUAL, _ceiling("0.9", "series", "universe"))
    + f"SELECT universe, n, {_cols(ceiling_cvar=8)} FROM risk",
    "ceiling_risk_daily": S.with_(*S.base(FLAGS_DAY), _ceiling("0.95", "rets", "universe, asset"))
    + f"SELECT universe, asset, n, {_cols(ceiling_var=8, ceiling_cvar=8)} FROM risk",
    "realised_performance": S.with_(*_MONTH, _EQUAL)
    + f"SELECT universe, {S.rnd('avg(r)', 8)} AS mean, {S.rnd('stddev_pop(r)', 8)} AS vol, "
    f"{S.rnd('12 * avg(r)', 8)} AS annual_mean, {S.rnd('sqrt(12) * stddev_pop(r)', 8)} AS annual_vol "
    "FROM series GROUP BY universe",
    "luck_screen": S.with_(_TRACK, _SCREEN) + f"SELECT entity, grp, n, wins, {_cols(tail=9)} FROM screen",
    "luck_screen_best_of": S.with_(_TRACK, _SCREEN)
    + f"SELECT grp, count(*) AS m, {S.rnd('min(tail)', 9)} AS tail, "
    f"{S.rnd('1 - (1 - min(tail)) ** count(*)', 9)} AS best_of FROM screen GROUP BY grp",
}
