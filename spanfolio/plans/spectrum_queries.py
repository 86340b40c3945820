"""Spectra, absorption ratio, auto-encoder, signal and backtest.

The panel of three flags has eigenvalues in closed form, so whole chains can be
checked in SQL; for the six types the power sums of the eigenvalues are checked
against traces of matrix powers, which determine the spectrum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfolio.operators import autoencoder as E
from spanfolio.operators import autoencoder_rows as B
from spanfolio.operators import moments as M
from spanfolio.operators import panel as P
from spanfolio.operators import rolling as R
from spanfolio.operators import signal as G
from spanfolio.operators import spectrum as C
from spanfolio.plans import sql as S
from spanfolio.plans.common import panel_of, prices_of, returns_of, returns_of_prices, show
from spanfolio.sources.tables import (
    BRAND_FLAGS_MONTH,
    FLAGS_DAY,
    TYPES_DAY,
    TYPES_WEEK,
    with_benchmark,
)
from spanfolio.sources.workspace import materialise

WINDOW = C.WINDOW
#: Fixed values of the rolling jobs: rows of a window, and the first row evaluated.
LOOKBACK, START = 504, 1512
#: Types before this name stand for equity in the backtests, the others for fixed income.
FIRST_BOND = "PROMO"


def _window_cov(spark: SparkSession, sf_dir: str, spec, step: int = 21) -> DataFrame:
    p = panel_of(spark, sf_dir, spec)
    return M.standardised_cov(M.rolling_cov(p.rows, p.dates, LOOKBACK, step, START), p.deviation)


def spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    spectra = C.spectrum(_window_cov(spark, sf_dir, FLAGS_DAY), WINDOW)
    return show(spectra.withColumnRenamed("lambda", "eigenvalue"), [*WINDOW, "k"], eigenvalue=6)


def spectrum_by_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    cov = M.covariance(returns_of(spark, sf_dir, BRAND_FLAGS_MONTH))
    spectra = C.spectrum(cov, ["universe"])
    return show(spectra.withColumnRenamed("lambda", "eigenvalue"), ["universe", "k"], eigenvalue=6)


def spectrum_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power sums 1 to 6 of the six eigenvalues of each window."""
    spectra = C.spectrum(_window_cov(spark, sf_dir, TYPES_DAY), WINDOW)
    sums = spectra.groupBy(*WINDOW).agg(
        *[F.sum(F.pow("lambda", F.lit(p))).alias(f"power_{p}") for p in range(1, 7)]
    )
    return show(sums, WINDOW, **{f"power_{p}": 6 for p in range(1, 7)})


def spectrum_pca_of_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    spectra = C.spectrum(_window_cov(spark, sf_dir, FLAGS_DAY), WINDOW, "pca_of_cov")
    return show(spectra.withColumnRenamed("lambda", "eigenvalue"), [*WINDOW, "k"], eigenvalue=6)


def cumulative_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    spectra = C.spectrum(_window_cov(spark, sf_dir, FLAGS_DAY), WINDOW)
    return show(R.cumulative_share(spectra, WINDOW), [*WINDOW, "k"], share=6)


def components_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cov = M.covariance(returns_of(spark, sf_dir, BRAND_FLAGS_MONTH))
    return C.components_needed(C.spectrum(cov, ["universe"]), ["universe"], 0.8)


def absorption_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    cov = M.covariance(returns_of(spark, sf_dir, BRAND_FLAGS_MONTH))
    return show(C.absorption_ratio(C.spectrum(cov, ["universe"]), ["universe"]), ["universe"], ar=6)


def _flag_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panel_of(spark, sf_dir, FLAGS_DAY)
    return C.absorption_series(p.rows, p.dates, LOOKBACK, START, deviation=p.deviation)


def absorption_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(_flag_series(spark, sf_dir), [*WINDOW, "components"], ar=6)


def absorption_series_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six assets beside a benchmark that is left out by name before the spectrum."""
    prices = materialise(with_benchmark(prices_of(spark, sf_dir, TYPES_DAY)), "prices")
    p = returns_of_prices(P.assert_absent(P.exclude_asset(prices, "MKT"), "MKT"))
    series = C.absorption_series(p.rows, p.dates, LOOKBACK, START, deviation=p.deviation)
    return show(series, [*WINDOW, "components"], ar=6)


def ar_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = G.standardised_shift(_flag_series(spark, sf_dir))
    return show(shift, ["universe", "dt"], ar_short=6, ar_long=6, ar_shift=5)


def regime_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.regime_weights(G.standardised_shift(_flag_series(spark, sf_dir)))


def _funds(spark: SparkSession, sf_dir: str, spec) -> DataFrame:
    """Returns of two funds that stand for equity and fixed income: the types of each, in equal parts.

    Gaps are filled on the grid of all dates first, so both funds have a return on each.
    """
    fund = F.when(F.col("asset") < F.lit(FIRST_BOND), G.EQUITY).otherwise(G.BONDS)
    returns = P.padded_returns(prices_of(spark, sf_dir, spec)).withColumn("asset", fund)
    return returns.groupBy("universe", "dt", "asset").agg(F.avg("r").alias("r"))


def _performance(found: DataFrame) -> DataFrame:
    """Logs of the growth and, with its sign, of the ratio: the derived prices swing far more than real ones."""
    sign = F.signum("sharpe").cast("int").alias("sign")
    logged = found.withColumns(
        {"log_ret": F.log1p("ann_ret"), "log_sharpe": F.log(F.abs("sharpe")), "sign": sign}
    )
    return show(logged, ["universe", "n", "n_unmatched", "sign"], log_ret=6, ann_vol=6, log_sharpe=6)


def backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights from the flags' absorption ratio applied to the two funds."""
    weights = G.regime_weights(G.standardised_shift(_flag_series(spark, sf_dir)))
    found = G.backtest(weights, _funds(spark, sf_dir, TYPES_DAY))
    return _performance(found)


def backtest_lagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with each weight applied on the following date."""
    weights = G.regime_weights(G.standardised_shift(_flag_series(spark, sf_dir)))
    found = G.backtest(weights, _funds(spark, sf_dir, TYPES_DAY), lag=1)
    return _performance(found)


def weekly_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole chain on weekly prices with windows short enough for the smallest tables."""
    p = panel_of(spark, sf_dir, TYPES_WEEK)
    series = C.absorption_series(p.rows, p.dates, 42, 42, None, refresh=1, deviation=p.deviation)
    shift = G.standardised_shift(series, 15, 63)
    weights = G.regime_weights(shift)
    strategy = G.backtest(weights, _funds(spark, sf_dir, TYPES_WEEK), periods_per_year=52)
    return _performance(strategy)


def _types_cov_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(_window_cov(spark, sf_dir, TYPES_DAY, step=1), "cov")


def _checked(cov: DataFrame, models: DataFrame, ratio: DataFrame, start: int, step: int = 1, refresh: int = 252) -> DataFrame:
    """``ratio`` with its difference from the same number taken from the codes of every matrix by joins."""
    due = cov.select("universe", "ix").distinct().withColumn("due", R.refresh_row(F.col("ix"), start, step, refresh))
    own = models.withColumnRenamed("ref_ix", "due").join(due, ["universe", "due"]).drop("due")
    own = materialise(own.withColumnRenamed("ix", "ref_ix"), "models-by-date")
    weight = own.select(
        "universe", F.col("ref_ix").alias("ix"), F.posexplode("dec").alias("p", "weight"), "assets"
    ).selectExpr("universe", "ix", "assets[p % size(assets)] AS asset", "p div size(assets) + 1 AS k", "weight")
    shift = own.selectExpr("universe", "ref_ix AS ix", "aggregate(dec_bias, 0D, (s, x) -> s + x) AS shift")
    trace = cov.where("ai = aj").groupBy("universe", "ix").agg(F.sum("cov").alias("trace"))
    out = E.codings(cov, own).join(weight, ["universe", "ix", "asset", "k"]).groupBy("universe", "ix").agg(
        F.sum(F.col("code") * F.col("weight")).alias("out")
    )
    by_codes = out.join(shift, ["universe", "ix"]).join(trace, ["universe", "ix"])
    error = F.abs(F.col("ae_ratio") - (F.col("out") + F.col("shift")) / F.col("trace"))
    return ratio.join(by_codes, ["universe", "ix"]).select("universe", "dt", "ix", error.alias("error"))


def _row_models(spark: SparkSession, sf_dir: str):
    """The panel of types, its rows by date and the models of every refresh."""
    p = panel_of(spark, sf_dir, TYPES_DAY)
    deviation = p.deviation
    rows = materialise(B.date_rows(p.rows, deviation), "date-rows")
    models = materialise(B.fit_models(rows, B.asset_names(p.rows), p.dates, LOOKBACK, START), "models")
    return p, deviation, rows, models


def autoencoder_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrices that each model was trained on, and whether training lowered its loss."""
    models = _row_models(spark, sf_dir)[-1]
    return models.select("universe", "ref_ix", "n_train", (F.col("loss_last") < F.col("loss_first")).alias("learned"))


def autoencoder_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratio on every date, with its difference from the one of codes and windows."""
    p, deviation, rows, models = _row_models(spark, sf_dir)
    ratio = B.ratio(rows, p.dates, models, LOOKBACK, START)
    codes = B.ratio_by_codes(p.rows, deviation, models, LOOKBACK, START)
    both = ratio.join(codes, ["universe", "ix"]).withColumn("error", F.abs(F.col("ae_ratio") - F.col("by_codes")))
    return show(both, WINDOW, error=6)


def autoencoder_ratio_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrices every 21 rows only; the ratio, like the matrix, holds until the next one."""
    p = panel_of(spark, sf_dir, TYPES_DAY)
    cov = materialise(
        M.standardised_cov(M.rolling_cov(p.rows, p.dates, LOOKBACK, 21, START), p.deviation), "cov"
    )
    models = materialise(E.fit_models(cov, START, 21, 12), "models")
    ratio = _checked(cov, models, E.autoencoder_ratio(cov, models, START, 21, 12), START, 21, 12)
    grid = P.evaluation_grid(p.dates, START, None, 1)
    return show(R.carry_forward(grid, ratio, START, 1, 21), WINDOW, error=6)


def autoencoder_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model on the first three of five matrices, applied to all five."""
    p = panel_of(spark, sf_dir, TYPES_DAY)
    cov = materialise(
        M.standardised_cov(M.rolling_cov(p.rows, p.dates, LOOKBACK, 60, 1000, 1300), p.deviation), "cov"
    )
    models = materialise(E.fit_stack(cov, 1000, 60, 3, E.TrainSpec(codes=200, epochs=10, batch=5)), "models")
    ratio = E.autoencoder_ratio(cov, models, 1000, 60, 5)
    return show(_checked(cov, models, ratio, 1000, 60, 5), WINDOW, error=6)


def autoencoder_codings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cov = _types_cov_daily(spark, sf_dir)
    models = materialise(E.fit_models(cov, START), "models")
    at = cov.join(models.select("universe", F.col("ref_ix").alias("ix")), ["universe", "ix"])
    ratio = E.autoencoder_ratio(at, models, START)
    error = _checked(at, models, ratio, START).select("universe", "ix", "error")
    codes = E.codings(cov, models).where("code IS NOT NULL")
    return show(codes.join(error, ["universe", "ix"]), [*WINDOW, "asset", "k"], error=6)


QUERIES = {
    f.__name__: f
    for f in (
        spectrum, spectrum_by_universe, spectrum_invariants, spectrum_pca_of_cov, cumulative_share,
        components_needed, absorption_ratio, absorption_series, absorption_series_types, ar_shift,
        regime_weights, backtest, backtest_lagged, weekly_strategy, autoencoder_fit,
        autoencoder_ratio, autoencoder_ratio_scheduled, autoencoder_snapshot, autoencoder_codings,
    )
}

_KEYS = "universe, dt, ix"
_FLAG_WINDOWS = [
    *S.base(FLAGS_DAY, standard=True), S.dates("zr"), S.schedule(START, 21),
    S.window_cov("zr", LOOKBACK),
]
_FLAG_EIGEN = [*_FLAG_WINDOWS, S.three_by_three("wcov", _KEYS), S.eigen_three("m3", _KEYS)]
_UNIVERSE_EIGEN = [
    *S.base(BRAND_FLAGS_MONTH), S.sample_cov(), S.three_by_three("cov", "universe"),
    S.eigen_three("m3", "universe"),
]
_COMPONENTS = (
    "CASE WHEN l1 / (l1 + l2 + l3) >= 0.8 THEN 1::BIGINT "
    "WHEN (l1 + l2) / (l1 + l2 + l3) >= 0.8 THEN 2::BIGINT ELSE 3::BIGINT END"
)


def _ranked(keys: str, source: str = "eig") -> str:
    return (
        f"SELECT {keys}, k, {S.rnd('v', 6)} AS eigenvalue FROM (SELECT {keys}, "
        f"unnest([1, 2, 3])::BIGINT AS k, unnest([l1, l2, l3]) AS v FROM {source})"
    )


def _series(start: int, stop: int | None, period: int, name: str = "ar") -> list[str]:
    upper = "" if stop is None else f" AND ix < {stop}"
    return [
        f"""{name} AS (
    SELECT c.universe, c.dt, c.ix, l1 / (l1 + l2 + l3) AS ar, {_COMPONENTS} AS components
    FROM (SELECT * FROM cal WHERE ix >= {start}{upper}) c
    JOIN eig e ON e.universe = c.universe AND e.ix = c.ix - (c.ix - {start}) % {period})"""
    ]


def _shift(short: int, long: int) -> str:
    w = "OVER (PARTITION BY universe ORDER BY dt ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
    return f"""shift AS (
    SELECT universe, dt, ar_short, ar_long, (ar_short - ar_long) / ar_sd AS ar_shift
    FROM (SELECT universe, dt, avg(ar) {w.format(short - 1)} AS ar_short,
                 avg(ar) {w.format(long - 1)} AS ar_long, stddev_samp(ar) {w.format(long - 1)} AS ar_sd,
                 count(*) {w.format(long - 1)} AS n FROM ar)
    WHERE n = {long})"""


_WEIGHTS = """weights AS (
    SELECT universe, dt, unnest(['EQ', 'FI']) AS asset, unnest([eq, 1 - eq]) AS w
    FROM (SELECT universe, dt, CASE WHEN ar_shift > 1 THEN 0.0::DOUBLE WHEN ar_shift < -1 THEN 1.0::DOUBLE
                                    ELSE 0.5::DOUBLE END AS eq FROM shift))"""


def _backtest(periods: int) -> str:
    return f"""SELECT universe, n, n_unmatched, sign(ann_ret / ann_vol)::INTEGER AS sign,
       {S.rnd('CASE WHEN ann_ret > -1 THEN ln(1 + ann_ret) END', 6)} AS log_ret, {S.rnd('ann_vol', 6)} AS ann_vol,
       {S.rnd('ln(abs(ann_ret / ann_vol))', 6)} AS log_sharpe
FROM (SELECT universe, count(r) AS n, count(*) - count(r) AS n_unmatched,
             CASE WHEN min(r) <= -1 THEN -1.0 ELSE exp(sum(ln(1 + r)) * {periods} / count(r)) - 1 END AS ann_ret,
             stddev_samp(r) * sqrt({periods}) AS ann_vol
      FROM (SELECT universe, dt, CASE WHEN bool_and(r IS NOT NULL) THEN sum(w * r) END AS r
            FROM weights LEFT JOIN fund USING (universe, dt, asset) GROUP BY ALL) GROUP BY universe)"""


def _fund(spec) -> list[str]:
    return [
        S.prices(spec, "fund_prices"), *S.padded("fund_prices"),
        f"""fund AS (
    SELECT universe, dt, CASE WHEN asset < '{FIRST_BOND}' THEN 'EQ' ELSE 'FI' END AS asset, avg(r) AS r
    FROM padded_rets GROUP BY ALL)""",
    ]


_AR = [*_FLAG_EIGEN, *_series(START, None, 21)]
_SIGNAL = [*_AR, _shift(15, 252), _WEIGHTS]
_POWERS = [
    """full_cov AS (
    SELECT universe, dt, ix, ai, aj, cov FROM wcov
    UNION ALL SELECT universe, dt, ix, aj, ai, cov FROM wcov WHERE ai <> aj)""",
    *[
        f"""c{p} AS (
    SELECT a.universe, a.dt, a.ix, a.ai, b.aj, sum(a.cov * b.cov) AS cov
    FROM {'full_cov' if p == 2 else f'c{p - 1}'} a
    JOIN full_cov b ON a.universe = b.universe AND a.ix = b.ix AND a.aj = b.ai GROUP BY ALL)"""
        for p in range(2, 7)
    ],
]
_SIX = [
    *_POWERS,
    "powers AS (SELECT * FROM "
    + " JOIN ".join(
        f"(SELECT {_KEYS}, sum(cov) AS t{p} FROM {'full_cov' if p == 1 else f'c{p}'} "
        f"WHERE ai = aj GROUP BY {_KEYS})" + ("" if p == 1 else f" USING ({_KEYS})")
        for p in range(1, 7)
    )
    + ")",
    # Newton's identities: elementary symmetric sums, hence the characteristic polynomial.
    f"""sym AS (
    SELECT *, (e5 * t1 - e4 * t2 + e3 * t3 - e2 * t4 + e1 * t5 - t6) / 6 AS e6
    FROM (SELECT *, (e4 * t1 - e3 * t2 + e2 * t3 - e1 * t4 + t5) / 5 AS e5
    FROM (SELECT *, (e3 * t1 - e2 * t2 + e1 * t3 - t4) / 4 AS e4
    FROM (SELECT *, (e2 * t1 - e1 * t2 + t3) / 3 AS e3
    FROM (SELECT *, (e1 * t1 - t2) / 2 AS e2 FROM (SELECT *, t1 AS e1 FROM powers))))))""",
    # Largest root by Newton steps from above, then division by it; six times.
    f"""roots({_KEYS}, k, trace, poly, found) AS (
    SELECT {_KEYS}, 0, t1, [1.0, -e1, e2, -e3, e4, -e5, e6]::DOUBLE[], []::DOUBLE[] FROM sym
    UNION ALL
    SELECT {_KEYS}, k + 1, trace,
           list_reduce(list_transform(poly[1:6 - k], lambda c: [c]),
                       lambda s, c: list_append(s, c[1] + x * s[len(s)])),
           list_append(found, x)
    FROM (SELECT *, list_reduce(list_transform(range(120), lambda z: trace),
              lambda r, z: r - list_reduce(poly, lambda s, c: s * r + c)
                  / list_reduce(list_transform(poly[1:6 - k], lambda c, i: c * (7 - k - i)),
                                lambda s, c: s * r + c)) AS x
          FROM roots WHERE k < 6))""",
    f"""eig AS (
    SELECT {_KEYS}, found[1] / trace AS top_share, 1 + len(list_filter(range(1, 7),
           lambda j: list_sum(found[1:j]) / trace < 0.8)) AS components
    FROM roots WHERE k = 6)""",
]


def _six_series(start: int, stop: int | None, period: int) -> str:
    upper = "" if stop is None else f" AND ix < {stop}"
    return f"""ar AS (
    SELECT c.universe, c.dt, c.ix, top_share AS ar, components
    FROM (SELECT * FROM cal WHERE ix >= {start}{upper}) c
    JOIN eig e ON e.universe = c.universe AND e.ix = c.ix - (c.ix - {start}) % {period})"""


_PCA = [
    *_FLAG_WINDOWS,
    """full_cov AS (
    SELECT universe, dt, ix, ai, aj, cov FROM wcov
    UNION ALL SELECT universe, dt, ix, aj, ai, cov FROM wcov WHERE ai <> aj)""",
    """pcov AS (
    SELECT a.universe, a.dt, a.ix, a.aj AS ai, b.aj AS aj, covar_samp(a.cov, b.cov) AS cov
    FROM full_cov a JOIN full_cov b
      ON a.universe = b.universe AND a.ix = b.ix AND a.ai = b.ai AND a.aj <= b.aj GROUP BY ALL)""",
    S.three_by_three("pcov", _KEYS), S.eigen_three("m3", _KEYS),
]

_AE_DATES = S.with_(*S.base(TYPES_DAY), S.dates("rets"))
_NO_ERROR = f"SELECT {_KEYS}, 0.0::DOUBLE AS error FROM "

ORACLES = {
    # values depend on the random start; what SQL can state is which models and rows there are, that
    # training helped, and that ratio and codes agree with each other (difference 0)
    "autoencoder_fit": _AE_DATES
    + f"SELECT universe, ix AS ref_ix, (ix - {START}) % {E.TrainSpec().buffer} + 1 AS n_train, true AS learned "
    f"FROM cal WHERE ix >= {START} AND (ix - {START}) % 252 = 0",
    "autoencoder_ratio": _AE_DATES + _NO_ERROR + f"cal WHERE ix >= {START}",
    "autoencoder_ratio_scheduled": _AE_DATES + _NO_ERROR + f"cal WHERE ix >= {START}",
    "autoencoder_snapshot": _AE_DATES + _NO_ERROR + "cal WHERE ix >= 1000 AND ix < 1300 AND (ix - 1000) % 60 = 0",
    "autoencoder_codings": S.with_(*S.base(TYPES_DAY))
    + f"SELECT {_KEYS}, asset, 1::BIGINT AS k, 0.0::DOUBLE AS error FROM rets "
    f"WHERE ix >= {START} AND (ix - {START}) % 252 = 0",
    "spectrum": S.with_(*_FLAG_EIGEN) + _ranked(_KEYS),
    "spectrum_by_universe": S.with_(*_UNIVERSE_EIGEN) + _ranked("universe"),
    "spectrum_invariants": S.with_(
        *S.base(TYPES_DAY, standard=True), S.dates("zr"), S.schedule(START, 21),
        S.window_cov("zr", LOOKBACK), *_POWERS,
    )
    + f"SELECT {_KEYS}, "
    + ", ".join(f"{S.rnd(f't{p}', 6)} AS power_{p}" for p in range(1, 7))
    + " FROM "
    + " JOIN ".join(
        f"(SELECT {_KEYS}, sum(cov) AS t{p} FROM {'full_cov' if p == 1 else f'c{p}'} "
        f"WHERE ai = aj GROUP BY {_KEYS})" + ("" if p == 1 else f" USING ({_KEYS})")
        for p in range(1, 7)
    ),
    "spectrum_pca_of_cov": S.with_(*_PCA) + _ranked(_KEYS),
    "cumulative_share": S.with_(*_FLAG_EIGEN)
    + f"SELECT {_KEYS}, k, {S.rnd('v', 6)} AS share FROM (SELECT {_KEYS}, unnest([1, 2, 3])::BIGINT AS k, "
    "unnest([l1 / (l1 + l2 + l3), (l1 + l2) / (l1 + l2 + l3), 1.0]) AS v FROM eig)",
    "components_needed": S.with_(*_UNIVERSE_EIGEN) + f"SELECT universe, {_COMPONENTS} AS components FROM eig",
    "absorption_ratio": S.with_(*_UNIVERSE_EIGEN)
    + f"SELECT universe, {S.rnd('l1 / (l1 + l2 + l3)', 6)} AS ar FROM eig",
    "absorption_series": S.with_(*_AR) + f"SELECT {_KEYS}, components, {S.rnd('ar', 6)} AS ar FROM ar",
    "absorption_series_types": S.with_(
        *S.base(TYPES_DAY, standard=True), S.dates("zr"), S.schedule(START, 21),
        S.window_cov("zr", LOOKBACK), *_SIX, _six_series(START, None, 21), recursive=True,
    ) + f"SELECT {_KEYS}, components, {S.rnd('ar', 6)} AS ar FROM ar",
    "weekly_strategy": S.with_(
        *S.base(TYPES_WEEK, standard=True), S.dates("zr"), S.schedule(42, 1),
        S.window_cov("zr", 42), *_SIX, _six_series(42, None, 1), _shift(15, 63), _WEIGHTS,
        *_fund(TYPES_WEEK), recursive=True,
    ) + _backtest(52),
    "ar_shift": S.with_(*_AR, _shift(15, 252))
    + f"SELECT universe, dt, {S.rnd('ar_short', 6)} AS ar_short, {S.rnd('ar_long', 6)} AS ar_long, "
    f"{S.rnd('ar_shift', 5)} AS ar_shift FROM shift",
    "regime_weights": S.with_(*_SIGNAL) + "SELECT universe, dt, asset, w FROM weights",
    "backtest": S.with_(*_SIGNAL, *_fund(TYPES_DAY)) + _backtest(252),
    "backtest_lagged": S.with_(
        *_AR, _shift(15, 252), _WEIGHTS.replace("weights AS", "same_day AS"),
        "weights AS (SELECT * FROM (SELECT universe, lead(dt) OVER (PARTITION BY universe, asset ORDER BY dt) "
        "AS dt, asset, w FROM same_day) WHERE dt IS NOT NULL)",
        *_fund(TYPES_DAY),
    ) + _backtest(252),
}
