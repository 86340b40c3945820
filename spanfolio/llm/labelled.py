"""Bounded samples of labelled rows, and logistic weights fitted on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.llm.text import compressed, key_filter
from spanfolio.sources.workspace import discard, materialise


def in_training(id_col: str = "doc_id"):
    """Rows whose label may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2


def known_labels(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """One row (``label``: 0 or 1) for each labelled id; of several labels of an id the greatest counts."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg((F.max(label) > 0).cast("int").alias("label"))
    return materialise(known, "labels")


def fold(id_col: str = "doc_id"):
    return F.abs(F.xxhash64(id_col)) % 2


def every(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All labelled documents: ``label`` and ``fold`` as in ``sample``, ``n_bytes`` and ``packed`` as in ``text.compressed``.

    A filter of the labelled ids spares other documents the shuffle.
    """
    known = known_labels(labels, label, id_col).withColumn("fold", fold(id_col))
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return compressed(texts, key=id_col, wanted=key_filter(known, id_col)).join(known, id_col).select("label", "fold", "n_bytes", "packed")


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``max_rows`` documents of each class with what they stand for.

    Columns ``text``, ``label`` (0 or 1), ``fold`` (0 or 1) and ``weight`` (labelled rows
    of the class per row taken). Rows are taken in the order of a hash of the id; rows
    without label are left out, and of several labels of an id the greatest counts. At
    most 2 * ``max_rows`` ids are broadcast.
    """
    known = known_labels(labels, label, id_col)
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    taken = None
    for value, n in sorted(sizes.items()):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64(F.lit(label), id_col), id_col).limit(max_rows)
        part = part.withColumn("weight", F.lit(n / min(n, max_rows))).withColumn("fold", fold(id_col))
        taken = part if taken is None else taken.unionAll(part)
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if taken is None:
        taken = known.withColumn("weight", F.lit(1.0)).withColumn("fold", F.lit(0).cast("long"))
    taken = materialise(taken, "sample-ids")
    texts = materialise(texts.join(F.broadcast(taken), id_col).select("text", "label", "fold", "weight"), "sample")
    discard(known, taken)
    return texts


class Logistic:
    """Ridge logistic regression on standardised columns, fitted by Newton's steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0):
        self.mean = np.average(x, 0, weight) if len(x) else np.zeros(x.shape[1])
        self.scale = np.sqrt(np.average((x - self.mean) ** 2, 0, weight)) + 1e-9 if len(x) else np.ones(x.shape[1])
        self.beta = np.zeros(x.shape[1] + 1)
        penalty = np.diag([1e-3, *[ridge] * x.shape[1]])
        for _ in range(60 if len(x) else 0):
            z = self._columns(x)
            p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
            slope = z.T @ (weight * (y - p)) - penalty @ self.beta
            step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + penalty, slope)
            self.beta += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-7:
                break

    def _columns(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(x)), np.clip((x - self.mean) / self.scale, -8, 8)])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._columns(x) @ self.beta, -30, 30)))
