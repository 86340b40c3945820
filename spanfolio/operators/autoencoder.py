"""Linear auto-encoder of covariance matrices and the ratio of traces it keeps.

Each refresh key trains on at most five matrices; all keys train in parallel.
The model is linear, so the ratio on every date is a product-sum of the date's
matrix with a matrix of the model and needs no further Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from spanfolio.functions.arrow import once
from spanfolio.operators.moments import matrix_rows
from spanfolio.operators.rolling import refresh_row

MODEL_SCHEMA = (
    "enc array<double>, enc_bias array<double>, dec array<double>, dec_bias array<double>, "
    "loss_first double, loss_last double"
)


@dataclass(frozen=True)
class TrainSpec:
    """Fixed values of the training run unless given otherwise."""

    codes: int | None = None
    learning_rate: float = 0.01
    epochs: int = 5
    batch: int = 2
    buffer: int = 5
    seed: int = 42


def _symmetric(packed: np.ndarray, n: int) -> np.ndarray:
    full = np.empty((n, n), dtype=np.float32)
    row, col = np.triu_indices(n)
    full[row, col] = packed
    full[col, row] = packed
    return full


def train(matrices: np.ndarray, codes: int, spec: TrainSpec) -> dict[str, np.ndarray]:
    """Fit ``X -> (X E + e) D + d`` to the matrices by Adam on the mean squared error."""
    n = matrices.shape[1]
    rng = np.random.default_rng(spec.seed)
    bound = np.sqrt(6.0 / (n + codes))
    theta = [
        rng.uniform(-bound, bound, (n, codes)).astype(np.float32),
        np.zeros(codes, np.float32),
        rng.uniform(-bound, bound, (codes, n)).astype(np.float32),
        np.zeros(n, np.float32),
    ]
    first = [np.zeros_like(t) for t in theta]
    second = [np.zeros_like(t) for t in theta]

    def residual(x):
        hidden = x @ theta[0] + theta[1]
        return hidden, hidden @ theta[2] + theta[3] - x

    def loss():
        return float(np.mean(residual(matrices)[1] ** 2))

    before = loss()
    steps = spec.epochs * (len(matrices) // min(len(matrices), spec.batch))
    for t in range(1, steps + 1):
        x = matrices[rng.integers(0, len(matrices), spec.batch)].reshape(-1, n)
        hidden, error = residual(x)
        pull = error * np.float32(2.0 / error.size)
        back = pull @ theta[2].T
        grads = [x.T @ back, back.sum(axis=0), hidden.T @ pull, pull.sum(axis=0)]
        rate = spec.learning_rate * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        for k, g in enumerate(grads):
            first[k] += np.float32(0.1) * (g - first[k])
            second[k] += np.float32(0.001) * (g * g - second[k])
            theta[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return {
        "enc": theta[0].ravel().astype(float),
        "enc_bias": theta[1].astype(float),
        "dec": theta[2].ravel().astype(float),
        "dec_bias": theta[3].astype(float),
        "loss_first": before,
        "loss_last": loss(),
    }


def default_codes(n: int, frac: float = 0.2) -> int:
    return max(1, int(frac * n))


def _trainer(spec: TrainSpec):
    @pandas_udf(MODEL_SCHEMA)
    def fit(size: pd.Series, matrices: pd.Series) -> pd.DataFrame:
        models = []
        for n, packed in zip(size, matrices):
            stack = np.stack([_symmetric(np.asarray(m), n) for m in packed])
            models.append(train(stack, spec.codes or default_codes(n), spec))
        return pd.DataFrame(models)

    return once(fit)


def fit_models(cov: DataFrame, start: int, step: int = 1, refresh: int = 252, spec: TrainSpec = TrainSpec()) -> DataFrame:
    """One model per universe and refresh row: ``(universe, ref_ix, assets, n_train, <weights>)``.

    ``cov`` holds a matrix for each evaluated row. The model of a refresh is
    trained on the slots of a ring of ``spec.buffer`` matrices from slot 0 up to
    the refresh's own slot, which are the latest ones since slot 0 was written.
    """
    period = step * refresh
    next_refresh = F.col("ix") + F.pmod(F.lit(start) - F.col("ix"), F.lit(period))
    own_slot = F.expr(f"((ref_ix - {start}) div {step}) % {spec.buffer}")
    used = cov.withColumn("ref_ix", next_refresh).where(F.col("ref_ix") - F.col("ix") <= own_slot * step)
    sets = (
        matrix_rows(used, ["universe", "ref_ix", "ix"])
        .groupBy("universe", "ref_ix")
        .agg(
            F.min("assets").alias("assets"),
            F.sort_array(F.collect_list(F.struct("ix", "cov"))).alias("slots"),
            F.max("ix").alias("last_ix"),
        )
        .where("last_ix = ref_ix")
        .withColumn("train", F.transform("slots", lambda x: x["cov"]))
    )
    return _train(sets, spec)


def fit_stack(cov: DataFrame, start: int, step: int, n_train: int, spec: TrainSpec = TrainSpec()) -> DataFrame:
    """One model per universe, trained on the first ``n_train`` matrices; ``ref_ix`` is ``start``."""
    used = cov.where((F.col("ix") >= start) & (F.col("ix") < start + n_train * step))
    sets = (
        matrix_rows(used, ["universe", "ix"])
        .groupBy("universe")
        .agg(
            F.min("assets").alias("assets"),
            F.sort_array(F.collect_list(F.struct("ix", "cov"))).alias("slots"),
        )
        .select(
            "universe",
            F.lit(start).cast("long").alias("ref_ix"),
            "assets",
            F.transform("slots", lambda x: x["cov"]).alias("train"),
        )
    )
    return _train(sets, spec)


def _train(sets: DataFrame, spec: TrainSpec) -> DataFrame:
    model = _trainer(spec)(F.size("assets"), "train")
    return sets.select(
        "universe", "ref_ix", "assets", F.size("train").cast("long").alias("n_train"), model.alias("m")
    ).select("universe", "ref_ix", "assets", "n_train", "m.*")


def _trace_kernel():
    @pandas_udf("kernel array<double>, shift double")
    def kernel(
        size: pd.Series, enc: pd.Series, enc_bias: pd.Series, dec: pd.Series, dec_bias: pd.Series
    ) -> pd.DataFrame:
        kernels, shifts = [], []
        for n, e, eb, d, db in zip(size, enc, enc_bias, dec, dec_bias):
            down = np.asarray(e).reshape(n, -1)
            up = np.asarray(d).reshape(-1, n)
            product = down @ up
            both = product + product.T
            both[np.diag_indices(n)] /= 2
            kernels.append(both[np.triu_indices(n)])
            shifts.append(float((np.asarray(eb) @ up + np.asarray(db)).sum()))
        return pd.DataFrame({"kernel": kernels, "shift": shifts})

    return once(kernel)


def autoencoder_ratio(
    cov: DataFrame, models: DataFrame, start: int, step: int = 1, refresh: int = 252
) -> DataFrame:
    """Trace of the model's output over the trace of its input, for each matrix in ``cov``.

    A date uses the model of its last refresh.
    """
    k = _trace_kernel()(F.size("assets"), "enc", "enc_bias", "dec", "dec_bias")
    kernels = models.select("universe", "ref_ix", k.alias("k")).select("universe", "ref_ix", "k.*")
    rows = matrix_rows(cov, ["universe", "dt", "ix"]).withColumn(
        "ref_ix", refresh_row(F.col("ix"), start, step, refresh)
    )
    whole = F.expr("aggregate(zip_with(cov, kernel, (c, q) -> c * q), 0D, (s, v) -> s + v)")
    inputs = cov.where("ai = aj").groupBy("universe", "ix").agg(F.sum("cov").alias("trace"))
    return (
        rows.join(kernels, ["universe", "ref_ix"])
        .join(inputs, ["universe", "ix"])
        .select(
            "universe",
            "dt",
            "ix",
            F.try_divide(whole + F.col("shift"), F.col("trace")).alias("ae_ratio"),
        )
    )


def codings(cov: DataFrame, models: DataFrame) -> DataFrame:
    """``(universe, dt, ix, asset, k, code)``: each refresh matrix through its own encoder.

    A product-sum over equal asset names, done as joins on the asset.
    """
    width = F.expr("size(enc_bias)")
    weight = models.select(
        "universe",
        F.col("ref_ix").alias("ix"),
        "enc_bias",
        width.alias("codes"),
        "assets",
        F.posexplode("enc").alias("p", "weight"),
    ).select(
        "universe",
        "ix",
        F.expr("assets[p div codes]").alias("via"),
        F.expr("p % codes").alias("code_ix"),
        "weight",
        F.expr("enc_bias[p % codes]").alias("bias"),
    )
    entry = F.expr(
        "CASE WHEN ai = aj THEN array(struct(ai AS asset, aj AS via)) "
        "ELSE array(struct(ai AS asset, aj AS via), struct(aj AS asset, ai AS via)) END"
    )
    full = cov.select("universe", "dt", "ix", "cov", F.inline(entry))
    return (
        full.join(weight, ["universe", "ix", "via"])
        .groupBy("universe", "dt", "ix", "asset", "code_ix")
        .agg((F.sum(F.col("cov") * F.col("weight")) + F.first("bias")).alias("code"))
        .select("universe", "dt", "ix", "asset", (F.col("code_ix") + 1).cast("long").alias("k"), "code")
    )
