"""The auto-encoder and its ratio on every date from rows of returns, without a matrix per date.

The trace of a linear model's output for a covariance matrix C is <E D, C> plus a constant.
C is a sum over the dates of a window, so <E D, C> is one too: of x'E D x, a number for each
date, less the same form of the window's mean. Each date is therefore one row of n numbers,
which meets the models whose dates look back on it, and a window is the difference of two
running sums. Only the few matrices that a model is trained on are formed, in the task that
trains it. A group holds the dates of one refresh and its look-back, whatever the length of
the history.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanfolio.operators.autoencoder import TrainSpec, default_codes, train

_MODEL = [("enc", pa.list_(pa.float64())), ("enc_bias", pa.list_(pa.float64())), ("dec", pa.list_(pa.float64())), ("dec_bias", pa.list_(pa.float64())), ("loss_first", pa.float64()), ("loss_last", pa.float64())]
_FITTED = pa.schema([("universe", pa.string()), ("ref_ix", pa.int64()), ("n_train", pa.int64()), *_MODEL])
_FITTED_TYPES = "universe string, ref_ix long, n_train long, enc array<double>, enc_bias array<double>, dec array<double>, dec_bias array<double>, loss_first double, loss_last double"


def date_rows(returns: DataFrame, deviation: DataFrame) -> DataFrame:
    """``(universe, ix, x)``: the returns of a date over the assets' deviations, in the order of names."""
    scaled = returns.join(deviation, ["universe", "asset"]).withColumn("x", F.try_divide("r", "s"))
    packed = F.sort_array(F.collect_list(F.struct("asset", "x")))
    return scaled.groupBy("universe", "ix").agg(F.transform(packed, lambda a: F.coalesce(a["x"], F.lit(float("nan")))).alias("x"))


def asset_names(returns: DataFrame) -> DataFrame:
    return returns.select("universe", "asset").distinct().groupBy("universe").agg(F.sort_array(F.collect_list("asset")).alias("assets"))


def _for_refreshes(rows: DataFrame, start: int, period: int, before: Column | int, after: int) -> DataFrame:
    """A copy of each row for every refresh row ``ref_ix`` with ``ref_ix - before <= ix < ref_ix + after``."""
    least = F.greatest(F.ceil((F.col("ix") - after + 1 - start) / period), F.lit(0))
    most = F.floor((F.col("ix") + before - start) / period)
    numbers = F.when(most >= least, F.sequence(least, most)).otherwise(F.array().cast("array<bigint>"))
    return rows.withColumn("ref_ix", F.explode(F.transform(numbers, lambda k: k * period + F.lit(start).cast("long"))))


def _matrix(table: pa.Table, first: int, last: int) -> np.ndarray | None:
    """Rows ``first`` to ``last`` (exclusive) by number; None unless all are there."""
    ix = table.column("ix").to_numpy()
    x = table.column("x").combine_chunks()
    values = x.flatten().to_numpy(zero_copy_only=False)
    if len(ix) == 0 or len(values) % len(ix):
        return None
    order = np.argsort(ix)
    inside = order[(ix[order] >= first) & (ix[order] < last)]
    if len(inside) != last - first or len(inside) == 0:
        return None
    return values.reshape(len(ix), -1)[inside]


def fit_models(rows: DataFrame, assets: DataFrame, dates: DataFrame, lookback: int, start: int, step: int = 1, refresh: int = 252, spec: TrainSpec = TrainSpec()) -> DataFrame:
    """One model per universe and refresh row, with the columns of ``autoencoder.fit_models``.

    A refresh at row t is trained on the covariance matrices of the ``lookback`` rows
    before t, t - step, ... back to slot 0 of a ring of ``spec.buffer`` matrices; t must be
    in the calendar.
    """
    period = step * refresh
    reach = lookback + (spec.buffer - 1) * step

    def run(table: pa.Table) -> pa.Table:
        universe, ref = table.column("universe")[0].as_py(), table.column("ref_ix")[0].as_py()
        slots = min((ref - start) // step % spec.buffer, refresh - 1) + 1
        x = _matrix(table, ref - lookback - (slots - 1) * step, ref)
        if x is None or lookback < 2:
            return _FITTED.empty_table()
        stack = []
        for back in range(slots - 1, -1, -1):
            part = x[len(x) - lookback - back * step : len(x) - back * step]
            part = part - part.mean(0)
            stack.append((part.T @ part / (lookback - 1)).astype(np.float32))
        model = train(np.stack(stack), spec.codes or default_codes(x.shape[1]), spec)
        return pa.Table.from_pylist([{"universe": universe, "ref_ix": ref, "n_train": slots, **{k: model[k] for k, _ in _MODEL}}], schema=_FITTED)

    due = dates.select("universe", F.col("ix").cast("long").alias("ref_ix")).where((F.col("ref_ix") >= start) & ((F.col("ref_ix") - start) % period == 0))
    used = _for_refreshes(rows.where(F.col("ix") >= start - reach), start, period, reach, 0).join(due, ["universe", "ref_ix"])
    fitted = used.select("universe", "ref_ix", "ix", "x").groupBy("universe", "ref_ix").applyInArrow(run, _FITTED_TYPES)
    return fitted.join(assets, "universe").select("universe", "ref_ix", "assets", "n_train", *(k for k, _ in _MODEL))


def ratio(rows: DataFrame, dates: DataFrame, models: DataFrame, lookback: int, start: int, step: int = 1, refresh: int = 252) -> DataFrame:
    """``(universe, dt, ix, ae_ratio)`` on every scheduled row: the trace of the model's output over that of its input.

    A row uses the model of its last refresh and the ``lookback`` rows before it; rows
    whose look-back isn't complete, or after a refresh without a model, have no ratio.
    """
    period = step * refresh
    schema = pa.schema([("universe", pa.string()), ("ix", pa.int64()), ("ae_ratio", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        model = right.to_pylist()[0]
        ref = model["ref_ix"]
        ends = int(left.column("ix").to_numpy().max()) + 1
        x = _matrix(left, ref - lookback, ends)
        if x is None or lookback < 2:
            return schema.empty_table()
        n = x.shape[1]
        down, up = np.asarray(model["enc"]).reshape(n, -1), np.asarray(model["dec"]).reshape(-1, n)
        shift = float((np.asarray(model["enc_bias"]) @ up + np.asarray(model["dec_bias"])).sum())
        x = x - x.mean(0)  # changes no covariance and keeps the sums small
        running = lambda v: np.concatenate([np.zeros((1, *v.shape[1:])), np.cumsum(v, axis=0)])
        coded, back = x @ down, x @ up.T
        form, square = running((coded * back).sum(1)), running((x * x).sum(1))
        total = running(x)
        at = np.arange(0, min(period, ends - ref + 1), step)  # rows after the refresh row
        moved = total[at + lookback] - total[at]
        out = form[at + lookback] - form[at] - ((moved @ down) * (moved @ up.T)).sum(1) / lookback
        trace = square[at + lookback] - square[at] - (moved * moved).sum(1) / lookback
        with np.errstate(divide="ignore", invalid="ignore"):
            found = (out / (lookback - 1) + shift) / (trace / (lookback - 1))
        found = pa.array(found, mask=~np.isfinite(found))
        return pa.Table.from_arrays([pa.array([model["universe"]] * len(at), pa.string()), pa.array(ref + at), found], schema=schema)

    used = _for_refreshes(rows.where(F.col("ix") >= start - lookback), start, period, lookback, period - 1)
    left = used.select("universe", "ref_ix", "ix", "x").groupBy("universe", "ref_ix")
    right = models.select("universe", F.col("ref_ix").cast("long").alias("ref_ix"), "enc", "enc_bias", "dec", "dec_bias").groupBy("universe", "ref_ix")
    found = left.cogroup(right).applyInArrow(run, "universe string, ix long, ae_ratio double")
    return found.join(dates.select("universe", "ix", "dt"), ["universe", "ix"]).select("universe", "dt", "ix", "ae_ratio")


def ratio_by_codes(returns: DataFrame, deviation: DataFrame, models: DataFrame, lookback: int, start: int, step: int = 1, refresh: int = 252) -> DataFrame:
    """``(universe, ix, by_codes)``: the same ratio from joins and Spark's own windows, for checks on few assets.

    Each date's codes and their counterparts are numbers, one of each a code; the trace of the
    output is the sum of their covariances over the window.
    """
    period = step * refresh
    scaled = returns.join(deviation, ["universe", "asset"]).selectExpr("universe", "ix", "asset", "try_divide(r, s) AS x")
    used = _for_refreshes(scaled.where(F.col("ix") >= start - lookback), start, period, lookback, period - 1)
    weights = models.selectExpr("universe", "ref_ix", "enc", "dec", "size(enc_bias) AS codes", "posexplode(assets) AS (p, asset)")
    weights = weights.selectExpr("universe", "ref_ix", "asset", "codes", "size(dec) div codes AS n", "p", "enc", "dec")
    weights = weights.selectExpr("universe", "ref_ix", "asset", "explode(transform(sequence(0, codes - 1), k -> struct(k, enc[int(p * codes + k)] AS down, dec[int(k * n + p)] AS up))) AS w")
    coded = used.join(weights, ["universe", "ref_ix", "asset"]).groupBy("universe", "ref_ix", "ix", "w.k").agg(
        F.sum(F.col("x") * F.col("w.down")).alias("u"), F.sum(F.col("x") * F.col("w.up")).alias("v")
    )
    frame = f"ORDER BY ix ROWS BETWEEN {lookback - 1} PRECEDING AND CURRENT ROW)"
    out = coded.selectExpr("universe", "ref_ix", "ix + 1 AS ix", f"covar_samp(u, v) OVER (PARTITION BY universe, ref_ix, k {frame} AS c").groupBy("universe", "ref_ix", "ix").agg(F.sum("c").alias("out"))
    trace = scaled.selectExpr("universe", "ix + 1 AS ix", f"var_samp(x) OVER (PARTITION BY universe, asset {frame} AS v").groupBy("universe", "ix").agg(F.sum("v").alias("trace"))
    shift = models.selectExpr(
        "universe", "ref_ix", "aggregate(dec_bias, 0D, (s, x) -> s + x) AS d",
        "aggregate(transform(dec, (x, i) -> x * enc_bias[int(i div (size(dec) div size(enc_bias)))]), 0D, (s, x) -> s + x) AS e",
    )
    due = f"ix >= ref_ix AND ix < ref_ix + {period} AND (ix - ref_ix) % {step} = 0"
    return out.where(due).join(shift, ["universe", "ref_ix"]).join(trace, ["universe", "ix"]).selectExpr("universe", "ix", "try_divide(out + d + e, trace) AS by_codes")
