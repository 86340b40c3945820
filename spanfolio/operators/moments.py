"""Covariance from block moments: full sample, rolling, growing and weighted windows.

Rows are cut into blocks of consecutive dates. For each block and pair of assets
the count, the sums and the centred cross product are computed once; any window
that is a whole number of blocks is then a sum of block rows. The cost is one
pass over the panel however far the windows overlap.

The pair products of a block come from one matrix product in an Arrow function.
A group holds a bounded number of dates times at most two tiles of assets, so
neither a long history nor a wide or dominant universe makes a large group, and
no row per date and pair is ever produced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.functions.columns import half_life_decay

#: Assets per tile; a group sees two tiles at most.
TILE = 256
#: Dates per group, unless a single block is longer.
CHUNK_ROWS = 1024
#: Moment rows one group may emit, unless a single block has more.
MAX_EMITTED = 500_000

MOMENT_SCHEMA = (
    "universe string, block long, ai string, aj string, "
    "n long, sx double, sy double, cxy double"
)
_ARROW_SCHEMA = pa.schema(
    [
        ("universe", pa.string()),
        ("block", pa.int64()),
        ("ai", pa.string()),
        ("aj", pa.string()),
        ("n", pa.int64()),
        ("sx", pa.float64()),
        ("sy", pa.float64()),
        ("cxy", pa.float64()),
    ]
)


def _dense(ix: np.ndarray, names: np.ndarray, r: np.ndarray, dates: np.ndarray):
    """Dates-by-assets matrix and the asset names of its columns."""
    assets, col = np.unique(names, return_inverse=True)
    matrix = np.full((len(dates), len(assets)), np.nan)
    matrix[np.searchsorted(dates, ix), col] = r
    return matrix, assets


def _tile_moments(key: tuple, table: pa.Table, block_rows: int) -> pa.Table:
    universe, _, left_tile, right_tile = (k.as_py() for k in key)
    ix = table["ix"].to_numpy()
    tile = table["tile"].to_numpy()
    r = table["r"].to_numpy()
    names = table["asset"].to_numpy(zero_copy_only=False).astype(str)
    dates = np.unique(ix)
    on_left = tile == left_tile
    x, x_names = _dense(ix[on_left], names[on_left], r[on_left], dates)
    if left_tile == right_tile:
        y, y_names = x, x_names
        row, col = np.triu_indices(len(x_names))
    else:
        on_right = ~on_left
        y, y_names = _dense(ix[on_right], names[on_right], r[on_right], dates)
        row, col = (a.ravel() for a in np.indices((len(x_names), len(y_names))))
    swap = x_names[row] > y_names[col]
    ai = np.where(swap, y_names[col], x_names[row])
    aj = np.where(swap, x_names[row], y_names[col])
    blocks, first = np.unique(dates // block_rows, return_index=True)
    n, sx, sy, cxy = [], [], [], []
    for lo, hi in zip(first, [*first[1:], len(dates)]):
        xs, ys = x[lo:hi].sum(axis=0), y[lo:hi].sum(axis=0)
        size = hi - lo
        cross = (x[lo:hi] - xs / size).T @ (y[lo:hi] - ys / size)
        n.append(np.full(len(row), size))
        sx.append(np.where(swap, ys[col], xs[row]))
        sy.append(np.where(swap, xs[row], ys[col]))
        cxy.append(cross[row, col])
    m = len(blocks)
    return pa.table(
        [
            pa.repeat(pa.scalar(universe, pa.string()), m * len(row)),
            np.repeat(blocks, len(row)),
            pa.array(np.tile(ai, m), pa.string()),
            pa.array(np.tile(aj, m), pa.string()),
            np.concatenate(n),
            np.concatenate(sx),
            np.concatenate(sy),
            np.concatenate(cxy),
        ],
        schema=_ARROW_SCHEMA,
    )


def block_moments(returns: DataFrame, block_rows: int, tile: int = TILE) -> DataFrame:
    """Moments per universe, block of dates and pair of assets with ``ai <= aj``.

    ``returns`` is ``(universe, ix, asset, n_assets, r)`` on complete dates. With
    more than ``tile`` assets each row goes to one group per pair of tiles that
    contains its own tile.
    """
    blocks_per_chunk = (
        f"greatest(1L, least({CHUNK_ROWS // block_rows}L, "
        f"{MAX_EMITTED}L div pow(least(n_assets, {tile}L), 2)::bigint))"
    )
    routed = (
        returns.selectExpr(
            "universe",
            "ix",
            "asset",
            "r",
            f"ix div ({blocks_per_chunk} * {block_rows}L) AS chunk",
            f"(n_assets + {tile - 1}L) div {tile}L AS n_tiles",
        )
        .selectExpr(
            "*",
            "pmod(xxhash64(asset), n_tiles) AS tile",
            "explode(sequence(0L, n_tiles - 1)) AS other",
        )
        .selectExpr(
            "universe",
            "chunk",
            "least(tile, other) AS t_left",
            "greatest(tile, other) AS t_right",
            "ix",
            "asset",
            "tile",
            "r",
        )
    )

    def moments(key: tuple, table: pa.Table) -> pa.Table:
        return _tile_moments(key, table, block_rows)

    return routed.groupBy("universe", "chunk", "t_left", "t_right").applyInArrow(
        moments, MOMENT_SCHEMA
    )


_SUMS = ("n", "sx", "sy", "sxsy", "cxy")
_BLOCK_MEAN_PRODUCT = "sx * sy / n AS sxsy"
#: Sample covariance from sums of block moments.
_COV = "try_divide(cxy + sxsy - sx * sy / n, n - 1) AS cov"


def covariance(returns: DataFrame) -> DataFrame:
    """Sample covariance ``(universe, ai, aj, n, cov)`` over all dates, ``ai <= aj``."""
    total = (
        block_moments(returns, CHUNK_ROWS)
        .selectExpr("*", _BLOCK_MEAN_PRODUCT)
        .groupBy("universe", "ai", "aj")
        .agg(*[F.sum(c).alias(c) for c in _SUMS])
    )
    return total.selectExpr("universe", "ai", "aj", "n", _COV)


def _block_size(lookback: int, step: int, start: int) -> int:
    return math.gcd(math.gcd(lookback, step), start)


def _on_schedule(start: int, stop: int | None, step: int) -> str:
    due = f"ix >= {start} AND (ix - {start}) % {step} = 0"
    return due if stop is None else f"{due} AND ix < {stop}"


def _reached(returns: DataFrame, first: int, stop: int | None) -> DataFrame:
    """The rows that some scheduled window holds; the optimizer can't push that through the matrix step."""
    rows = returns if first <= 0 else returns.where(F.col("ix") >= first)
    return rows if stop is None else rows.where(F.col("ix") < stop)


def _label(windows: DataFrame, dates: DataFrame) -> DataFrame:
    """Attach the date of row ``ix``; windows that end past the calendar fall away."""
    return windows.join(dates.select("universe", "ix", "dt"), ["universe", "ix"]).select(
        "universe", "dt", "ix", "ai", "aj", "n", "cov"
    )


def _summed(moments: DataFrame, partition: str, frame: str) -> DataFrame:
    over = f"OVER (PARTITION BY {partition} ORDER BY block ROWS BETWEEN {frame} AND CURRENT ROW)"
    return moments.selectExpr(
        "universe", "ai", "aj", "block", *[f"sum({c}) {over} AS {c}" for c in _SUMS]
    )


def _trailing_sums(moments: DataFrame, per_window: int | None) -> DataFrame:
    """Each block's moments summed with those of the blocks before it.

    ``per_window`` blocks are summed, or all of them when None. A frame of
    ``p * q`` blocks is taken in two steps, ``p`` neighbours and then ``q`` of
    those sums that lie ``p`` apart, which adds up p + q values per row instead
    of p * q. The second window is over a finer key than the first, so it needs
    no further shuffle.
    """
    pair = "universe, ai, aj"
    if per_window is None:
        return _summed(moments, pair, "UNBOUNDED PRECEDING")
    p = next(d for d in range(math.isqrt(per_window), 0, -1) if per_window % d == 0)
    q = per_window // p
    if p == 1:
        p, q = q, 1
    sums = _summed(moments, pair, f"{p - 1} PRECEDING")
    return sums if q == 1 else _summed(sums, f"{pair}, block % {p}", f"{q - 1} PRECEDING")


def _windows(returns: DataFrame, block: int, per_window: int | None) -> DataFrame:
    """Covariance of the window that ends with each block, labelled by the row after it."""
    moments = block_moments(returns, block).selectExpr("*", _BLOCK_MEAN_PRODUCT)
    return _trailing_sums(moments, per_window).selectExpr(
        "universe", f"(block + 1) * {block}L AS ix", "ai", "aj", "n", _COV
    )


def rolling_cov(
    returns: DataFrame,
    dates: DataFrame,
    lookback: int,
    step: int,
    start: int,
    stop: int | None = None,
) -> DataFrame:
    """Covariance of rows ``[ix - lookback, ix)`` at each scheduled row ``ix``.

    Scheduled rows are ``start, start + step, ...`` below ``stop`` that exist in
    ``dates``, the calendar of the returns. Only full windows are returned.
    """
    block = _block_size(lookback, step, start)
    due = f"{_on_schedule(start, stop, step)} AND n = {lookback}"
    returns = _reached(returns, start - lookback, stop)
    return _label(_windows(returns, block, lookback // block).where(due), dates)


def expanding_cov(
    returns: DataFrame, dates: DataFrame, step: int, start: int, stop: int | None = None
) -> DataFrame:
    """Covariance of all rows before each scheduled row."""
    block = math.gcd(step, start)
    due = _on_schedule(start, stop, step)
    returns = _reached(returns, 0, stop)
    return _label(_windows(returns, block, None).where(due), dates)


def weighted_window_cov(
    returns: DataFrame,
    dates: DataFrame,
    lookback: int,
    step: int,
    start: int,
    half_life: float = 252.0,
    decay: str = "as_reference",
    stop: int | None = None,
) -> DataFrame:
    """Covariance of window rows that were multiplied by half-life weights.

    With ``decay='as_reference'`` the oldest row of the window has the largest
    weight; ``'recent_first'`` turns the order round. The weights of one window
    sum to 1 and multiply the returns, so they enter the covariance squared.

    A weight is a power of the position, hence a product of one factor for the
    block's place in the window and one for the row's place in the block. The
    second goes into the block moments. The first makes a window a geometric sum of
    blocks: blocks are cut into groups as long as a window, with exponents that begin
    anew in each, and a window is the end of one group's running sum and the beginning
    of the next one's, each times one power. Nothing is gathered, nothing subtracted.
    Blocks with weights below 2^-200 of the largest, which no double can show, are left out.
    """
    if decay not in ("as_reference", "recent_first"):
        raise ValueError(f"unknown decay: {decay}")
    recent = decay == "recent_first"
    block = _block_size(lookback, step, start)
    per_window = lookback // block
    inside = F.col("ix") % block
    if recent:
        inside = block - 1 - inside
    rows = _reached(returns, start - lookback, stop)
    rows = rows.withColumn("r", F.col("r") * half_life_decay(inside, half_life))
    norm = sum(2.0 ** (-j / half_life) for j in range(lookback))
    counted = max(1, min(per_window, math.ceil(200 * half_life / block)))
    later = 0 if recent else (per_window - counted) * block  # rows of the window after those that count
    sums = _geometric_sums(block_moments(rows, block), counted, 2.0 ** (-block / half_life), recent)
    found = sums.selectExpr(
        "universe",
        f"(block + 1) * {block}L + {later}L AS ix",
        "ai",
        "aj",
        f"{lookback}L AS n",
        f"(sxy / {norm * norm}D - (sx / {norm}D) * (sy / {norm}D) / {lookback}) / ({lookback} - 1) AS cov",
    )
    return _label(found.where(_on_schedule(start, stop, step)), dates)


def _geometric_sums(moments: DataFrame, per_window: int, ratio: float, recent: bool) -> DataFrame:
    """Sums over each block and the ``per_window - 1`` before it, times powers of ``ratio``; squares of them for products.

    The oldest block has power 0, or the latest with ``recent``. Only full windows are returned.
    """
    p, log = per_window, math.log(ratio)
    pair = "universe, ai, aj"

    def power(exponent: str) -> str:
        return f"exp({log!r}D * ({exponent}))"

    own = power("-o" if recent else "o")
    scaled = moments.selectExpr("universe", "ai", "aj", "block", f"block % {p} AS o", f"block div {p} AS grp", "sx", "sy", "cxy + sx * sy / n AS sxy")
    scaled = scaled.selectExpr(
        "universe", "ai", "aj", "block", "o", "grp", f"sx * {own} AS sx", f"sy * {own} AS sy", f"sxy * {own} * {own} AS sxy"
    )
    names = ("sx", "sy", "sxy")
    begun = [f"sum({c}) OVER (PARTITION BY {pair}, grp ORDER BY block ROWS UNBOUNDED PRECEDING) AS {c}_begun" for c in names]
    rest = [f"sum({c}) OVER (PARTITION BY {pair}, grp ORDER BY block DESC ROWS UNBOUNDED PRECEDING) AS {c}_rest" for c in names]
    before = f"OVER (PARTITION BY {pair} ORDER BY block)"
    parts = scaled.selectExpr("universe", "ai", "aj", "block", "o", "grp", *begun, *rest).selectExpr(
        "universe", "ai", "aj", "block", "o", *[f"{c}_begun" for c in names],
        f"lag(block, {p - 1}) {before} AS first", *[f"lag({c}_rest, {p - 1}) {before} AS {c}_rest" for c in names],
    )
    now, old = (power("o"), power(f"o + {p}")) if recent else (power(f"{p - 1} - o"), power("-o - 1"))

    def total(c: str, now: str, old: str) -> str:
        return f"{c}_begun * {now} + IF(o = {p - 1}, 0D, {c}_rest * {old}) AS {c}"

    return parts.where(f"first = block - {p - 1}").selectExpr(
        "universe", "ai", "aj", "block", total("sx", now, old), total("sy", now, old), total("sxy", f"{now} * {now}", f"{old} * {old}")
    )


def deviations(returns: DataFrame) -> DataFrame:
    """Sample deviation of each asset over all dates."""
    return returns.groupBy("universe", "asset").agg(F.stddev_samp("r").alias("s"))


def standardised_cov(cov: DataFrame, deviation: DataFrame) -> DataFrame:
    """Covariance of standardised returns, from that of the returns themselves.

    Subtracting a constant changes no covariance and a constant divisor comes
    out of it, so the divisors are applied to the few entries of each matrix and
    the panel's rows are joined with nothing.
    """
    left = deviation.selectExpr("universe", "asset AS ai", "s AS si")
    right = deviation.selectExpr("universe", "asset AS aj", "s AS sj")
    joined = cov.join(left, ["universe", "ai"]).join(right, ["universe", "aj"])
    scaled = {"cov": "try_divide(cov, si * sj) AS cov"}
    return joined.selectExpr(*[scaled.get(c, c) for c in cov.columns])


def trace(cov: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of the diagonal per key."""
    return cov.where("ai = aj").groupBy(*keys).agg(F.sum("cov").alias("trace"))


def trace_ratio(top: DataFrame, bottom: DataFrame, keys: list[str]) -> DataFrame:
    """Trace of one set of matrices over the trace of another, null for a key without the first."""
    above = trace(top, keys).withColumnRenamed("trace", "top")
    below = trace(bottom, keys).withColumnRenamed("trace", "bottom")
    return below.join(above, keys, "left").select(
        *keys, F.try_divide(F.col("top"), F.col("bottom")).alias("trace_ratio")
    )


def annualise_cov(cov: DataFrame, periods: int = 12, unit: float = 1e-4, digits: int | None = 4) -> DataFrame:
    """Covariance of percent returns per period to decimal units per year, rounded half-even."""
    yearly = F.col("cov") * (periods * unit)
    return cov.withColumn("cov", yearly if digits is None else F.bround(yearly, digits))


def both_halves(cov: DataFrame) -> DataFrame:
    """The full matrix from its upper half."""
    mirrored = F.when(
        F.col("ai") != F.col("aj"),
        F.array(F.struct("ai", "aj"), F.struct(F.col("aj").alias("ai"), F.col("ai").alias("aj"))),
    ).otherwise(F.array(F.struct("ai", "aj")))
    rest = [c for c in cov.columns if c not in ("ai", "aj")]
    return cov.select(*rest, F.explode(mirrored).alias("p")).select(*rest, "p.ai", "p.aj")


def matrix_rows(cov: DataFrame, keys: list[str], mu: DataFrame | None = None) -> DataFrame:
    """One row per key: ``(assets, cov[, mu])``, the matrix packed by rows of its upper half.

    A row holds the n(n+1)/2 entries of one matrix, never more than one key.
    """
    rows = (
        cov.groupBy(*keys)
        .agg(F.expr("sort_array(collect_list(struct(ai, aj, cov)))").alias("e"))
        .selectExpr(
            *keys,
            "transform(filter(e, x -> x.ai = x.aj), x -> x.ai) AS assets",
            "transform(e, x -> x.cov) AS cov",
        )
    )
    if mu is None:
        return rows
    means = mu.groupBy(*keys).agg(
        F.expr("sort_array(collect_list(struct(asset, mu)))").alias("m")
    )
    return rows.join(means, keys).selectExpr(
        *keys, "assets", "cov", "transform(m, x -> x.mu) AS mu"
    )


def unpack(assets: list[int], packed: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of equal size as ``(positions, stack of symmetric matrices)``."""
    sizes = np.asarray(assets)
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        upper = np.stack([packed[i] for i in at])
        full = np.empty((len(at), n, n))
        row, col = np.triu_indices(n)
        full[:, row, col] = upper
        full[:, col, row] = upper
        yield at, full
