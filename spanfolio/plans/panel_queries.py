"""Loading, shaping, returns, weights and rolling statistics of panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfolio.operators import panel as P
from spanfolio.operators import rolling as R
from spanfolio.plans import sql as S
from spanfolio.plans.common import aligned_prices, dates_of, panel_of, prices_of, returns_of, show
from spanfolio.sources import sheets
from spanfolio.sources.tables import (
    BRAND_FLAGS_MONTH,
    BRANDS_WEEK,
    FLAGS_DAY,
    TYPES_DAY,
    TYPES_WEEK,
    period_start,
    price_panel,
    read_table,
    with_benchmark,
)
from spanfolio.sources.workspace import materialise, new_path

#: Names in the SQL of wide results, which must write them out.
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
KEY = ["universe", "dt", "asset"]


def _logged(panel: DataFrame, plain: list[str]) -> DataFrame:
    """Log prices: averages of a few round prices often end in the digit 5, their logs do not."""
    return show(panel.withColumn("log_price", F.log("price")), plain, log_price=8)



def load_wide_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the panel as a wide sheet, read it back with the sheet reader."""
    path = new_path(spark, "sheet")
    sheets.write_wide_csv(sheets.to_wide(price_panel(spark, sf_dir, TYPES_DAY), "price"), path)
    wide = sheets.drop_incomplete(sheets.read_wide_csv(spark, path))
    return _logged(sheets.to_long(wide), KEY)


def complete_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logged(aligned_prices(spark, sf_dir, TYPES_DAY), [*KEY, "ix"])


def panel_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet of texts, some of them no numbers: drop the date column, coerce, rename, drop gaps."""
    cells = (
        read_table(spark, sf_dir, "lineitem")
        .join(read_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(period_start(F.col("l_shipdate"), "week").alias("dt"), F.col("p_type").alias("asset"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col("l_extendedprice") / F.nullif("l_quantity", F.lit(0.0))).alias("p"),
        )
        .select("dt", "asset", F.when(F.col("n") % 7 == 0, "n/a").otherwise(F.col("p").cast("string")).alias("cell"))
    )
    raw = sheets.drop_leading(sheets.to_wide(cells, "cell"))
    named = sheets.name_by_position(raw, [f"stock_{i}" for i in range(1, 24)])
    clean = sheets.drop_incomplete(sheets.coerce_numeric(named, named.columns))
    return show(clean.withColumns({c: F.log(c) for c in clean.columns}), [], **{c: 8 for c in clean.columns})


def asset_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    returns = P.simple_returns(aligned_prices(spark, sf_dir, TYPES_DAY))
    return show(P.asset_head(returns, "ECONOMY", 50), [*KEY, "ix"], r=6)


def exclude_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = with_benchmark(prices_of(spark, sf_dir, TYPES_DAY))
    kept = P.assert_absent(P.exclude_asset(prices, "MKT"), "MKT")
    return _logged(kept, KEY)


def panel_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = sheets.to_wide(price_panel(spark, sf_dir, TYPES_WEEK), "price")
    return _logged(sheets.to_long(wide), KEY)


def panel_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = sheets.to_wide(price_panel(spark, sf_dir, TYPES_DAY), "price")
    types = wide.columns[1:]
    return show(wide.withColumns({t: F.log(f"`{t}`") for t in types}), ["dt"], **{t: 8 for t in types})


def stack_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separate series of dates and values, one for each type, under their names."""
    prices = prices_of(spark, sf_dir, TYPES_DAY)
    funds = {f"{t} FUND": prices.where(F.col("asset") == t).select("dt", "price") for t in sheets.to_wide(prices, "price").columns[1:]}
    return _logged(sheets.stack_series(funds, "price"), KEY)


def skip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    returns = P.simple_returns(aligned_prices(spark, sf_dir, TYPES_DAY))
    return show(P.skip_rows(returns, 1450), [*KEY, "ix"], r=6)


def evaluation_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.evaluation_grid(panel_of(spark, sf_dir, TYPES_DAY).dates, 1512, 2520, 5)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_of(aligned_prices(spark, sf_dir, BRAND_FLAGS_MONTH))


def simple_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(P.simple_returns(aligned_prices(spark, sf_dir, TYPES_DAY)), [*KEY, "ix"], r=6)


def log_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(P.log_returns(aligned_prices(spark, sf_dir, TYPES_DAY)), [*KEY, "ix"], r=6)


def load_wide_csv_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet with gaps, whose columns are in another order than the schema asked for; no row is dropped."""
    path = new_path(spark, "sheet")
    sheets.write_wide_csv(sheets.to_wide(price_panel(spark, sf_dir, BRANDS_WEEK), "price"), path)
    names = sheets.header(spark, path)
    wide = sheets.read_wide_csv(spark, path, sorted(names, reverse=True))
    return _logged(sheets.to_long(wide), KEY)


def padded_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns over filled gaps from row 100 of the calendar of all dates on."""
    return show(P.padded_returns(prices_of(spark, sf_dir, BRANDS_WEEK), 100), [*KEY, "ix"], r=6)


def padded_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns of 25 assets over gaps, each carrying its last price."""
    grid = P.fill_grid(prices_of(spark, sf_dir, BRANDS_WEEK))
    return show(P.simple_returns(grid, pad=True), KEY, r=6)


def standardised_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(P.standardise(returns_of(spark, sf_dir, BRANDS_WEEK)), [*KEY, "ix"], r=6)


def past_standardised_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    returns = P.simple_returns(aligned_prices(spark, sf_dir, TYPES_WEEK))
    return show(P.standardise(returns, by="past"), [*KEY, "ix"], r=6)


def half_life_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = panel_of(spark, sf_dir, BRAND_FLAGS_MONTH).dates
    return show(P.half_life_weights(dates, 24.0), ["universe", "dt", "ix"], w=9)


def _market_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dated series: the average return of the flags."""
    returns = P.simple_returns(aligned_prices(spark, sf_dir, FLAGS_DAY))
    return returns.groupBy("universe", "dt").agg(F.avg("r").alias("r"))


def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _market_series(spark, sf_dir)
    return show(
        series.withColumns({"mean_15": R.rolling_mean("r", 15), "mean_252": R.rolling_mean("r", 252)}),
        ["universe", "dt"], mean_15=6, mean_252=6,
    )


def rolling_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _market_series(spark, sf_dir)
    return show(series.withColumn("sd_252", R.rolling_std("r", 252)), ["universe", "dt"], sd_252=6)


def scheduled_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean return of each 21st row, carried to the rows after it."""
    returns = P.simple_returns(aligned_prices(spark, sf_dir, FLAGS_DAY))
    per_date = materialise(returns.groupBy("universe", "dt", "ix").agg(F.avg("r").alias("r")), "series")
    grid = P.evaluation_grid(per_date.select("universe", "dt", "ix"), 1512, None, 1)
    due = P.evaluation_grid(per_date, 1512, None, 21)
    carried = R.carry_forward(grid, due, 1512, 1, 21)
    return show(carried, ["universe", "dt", "ix"], r=6)


def irregular_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of dates that have one, carried to the dates that do not."""
    series = _market_series(spark, sf_dir)
    sparse = series.withColumn("r", F.when(F.dayofmonth("dt") <= 3, F.col("r")))
    return show(R.fill_last(sparse, "r"), ["universe", "dt"], r=6)


QUERIES = {
    f.__name__: f
    for f in (
        load_wide_csv, complete_panel, panel_clean, asset_head, exclude_benchmark, panel_unpivot,
        panel_pivot, stack_series, skip_rows, evaluation_grid, calendar, simple_returns, log_returns,
        padded_returns, padded_skip, load_wide_csv_incomplete, standardised_returns, past_standardised_returns, half_life_weights,
        rolling_mean, rolling_std, scheduled_ffill, irregular_ffill,
    )
}

_KEYS = "universe, dt, asset"
_PRICE = S.rnd("ln(price)", 8) + " AS log_price"
_RET = S.rnd("r", 6) + " AS r"
_SERIES = "series AS (SELECT universe, dt, avg(r) AS r FROM rets GROUP BY ALL)"


def _cells(template: str, sep: str = ", ") -> str:
    return sep.join(template.format(t=t, i=i + 1) for i, t in enumerate(TYPES))


def _full(value: str, agg: str, n: int) -> str:
    frame = f"OVER (PARTITION BY universe ORDER BY dt ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({value}) {frame} = {n} THEN {agg}({value}) {frame} END"


ORACLES = {
    "load_wide_csv": S.with_(S.prices(TYPES_DAY), S.aligned()) + f"SELECT {_KEYS}, {_PRICE} FROM px",
    "complete_panel": S.with_(S.prices(TYPES_DAY), S.aligned()) + f"SELECT {_KEYS}, ix, {_PRICE} FROM px",
    "panel_clean": "WITH cells AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS dt, p_type, "
    "CASE WHEN count(*) % 7 = 0 THEN 'n/a' "
    "ELSE avg(l_extendedprice / nullif(l_quantity, 0))::VARCHAR END AS cell "
    "FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL), wide AS (SELECT dt, "
    + _cells("TRY_CAST(max(cell) FILTER (WHERE p_type = '{t}') AS DOUBLE) AS stock_{i}")
    + " FROM cells GROUP BY dt) SELECT "
    + _cells("(round_even(ln(stock_{i}), 8) + 0.0) AS stock_{i}") + " FROM wide WHERE " + _cells("stock_{i} IS NOT NULL", " AND "),
    "asset_head": S.with_(*S.base(TYPES_DAY))
    + f"SELECT {_KEYS}, ix, {_RET} FROM rets WHERE asset = 'ECONOMY' ORDER BY dt LIMIT 50",
    "exclude_benchmark": S.with_(S.prices(TYPES_DAY)) + f"SELECT {_KEYS}, {_PRICE} FROM prices",
    "panel_unpivot": S.with_(S.prices(TYPES_WEEK)) + f"SELECT {_KEYS}, {_PRICE} FROM prices",
    "panel_pivot": S.with_(S.prices(TYPES_DAY)) + "SELECT dt, "
    + _cells("(round_even(ln(max(price) FILTER (WHERE asset = '{t}')), 8) + 0.0) AS \"{t}\"")
    + " FROM prices GROUP BY dt",
    "stack_series": S.with_(S.prices(TYPES_DAY))
    + f"SELECT universe, dt, asset || ' FUND' AS asset, {_PRICE} FROM prices",
    "skip_rows": S.with_(*S.base(TYPES_DAY)) + f"SELECT {_KEYS}, ix, {_RET} FROM rets WHERE ix >= 1450",
    "evaluation_grid": S.with_(*S.base(TYPES_DAY), S.dates("rets"), S.schedule(1512, 5, 2520))
    + "SELECT universe, dt, ix FROM sched",
    "calendar": S.with_(S.prices(BRAND_FLAGS_MONTH), S.aligned(), S.dates("px"))
    + "SELECT universe, dt, ix FROM cal",
    "simple_returns": S.with_(*S.base(TYPES_DAY)) + f"SELECT {_KEYS}, ix, {_RET} FROM rets",
    "log_returns": S.with_(S.prices(TYPES_DAY), S.aligned())
    + f"SELECT {_KEYS}, ix, {_RET} FROM (SELECT {_KEYS}, ix - 1 AS ix, ln(price) "
    "- ln(lag(price) OVER (PARTITION BY universe, asset ORDER BY dt)) AS r FROM px) WHERE r IS NOT NULL",
    "padded_returns": S.with_(S.prices(BRANDS_WEEK), *S.padded()) + f"SELECT {_KEYS}, {_RET} FROM padded_rets",
    "padded_skip": S.with_(S.prices(BRANDS_WEEK), *S.padded())
    + f"SELECT {_KEYS}, ix, {_RET} FROM padded_rets WHERE ix >= 100",
    "load_wide_csv_incomplete": S.with_(S.prices(BRANDS_WEEK)) + f"SELECT {_KEYS}, {_PRICE} FROM prices",
    "standardised_returns": S.with_(*S.base(BRANDS_WEEK, standard=True)) + f"SELECT {_KEYS}, ix, {_RET} FROM zr",
    "past_standardised_returns": S.with_(*S.base(TYPES_WEEK))
    + f"SELECT {_KEYS}, ix, {S.rnd('z', 6)} AS r FROM (SELECT {_KEYS}, ix, "
    "(r - avg(r) OVER w) / stddev_samp(r) OVER w AS z FROM rets WINDOW w AS (PARTITION BY universe, asset "
    "ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
    "half_life_weights": S.with_(*S.base(BRAND_FLAGS_MONTH), S.dates("rets"))
    + f"SELECT universe, dt, ix, {S.rnd('2.0 ** (-ix / 24.0) / sum(2.0 ** (-ix / 24.0)) OVER (PARTITION BY universe)', 9)} AS w FROM cal",
    "rolling_mean": S.with_(*S.base(FLAGS_DAY), _SERIES)
    + f"SELECT universe, dt, {S.rnd(_full('r', 'avg', 15), 6)} AS mean_15, "
    f"{S.rnd(_full('r', 'avg', 252), 6)} AS mean_252 FROM series",
    "rolling_std": S.with_(*S.base(FLAGS_DAY), _SERIES)
    + f"SELECT universe, dt, {S.rnd(_full('r', 'stddev_samp', 252), 6)} AS sd_252 FROM series",
    "scheduled_ffill": S.with_(
        *S.base(FLAGS_DAY), S.dates("rets"), S.schedule(1512, 1),
        "series AS (SELECT universe, ix, avg(r) AS r FROM rets GROUP BY ALL)",
    )
    + f"SELECT s.universe, s.dt, s.ix, {S.rnd('v.r', 6)} AS r FROM sched s "
    "JOIN series v ON v.universe = s.universe AND v.ix = s.ix - (s.ix - 1512) % 21",
    "irregular_ffill": S.with_(*S.base(FLAGS_DAY), _SERIES)
    + f"SELECT universe, dt, {S.rnd('v', 6)} AS r FROM (SELECT universe, dt, last_value(CASE WHEN day(dt) <= 3 "
    "THEN r END IGNORE NULLS) OVER (PARTITION BY universe ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) AS v FROM series)",
}
