"""Document quality: a linear-chain conditional random field labels every line good or bad."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanfolio.llm import text as T
from spanfolio.llm.labelled import Logistic, sample
from spanfolio.sources.workspace import discard, materialise

_BYTES = {
    "symbols": b"#*$%&|<>@^~=_{}[]\\",
    "bars": b"|",
    "exclaimed": b"!",
    "upper": bytes(range(0x41, 0x5B)),
    "digits": bytes(range(0x30, 0x3A)),
    "stops": b".,;:",
    "beyond": bytes(range(0x80, 0x100)),
}
_TABLES = {name: np.isin(np.arange(256), list(chars)) for name, chars in _BYTES.items()}
#: Of each line: logarithms of bytes and words, shares of bytes by class, word length, shares
#: of short words, repeated words, words equal to the one before, and whether an earlier line is the same.
FEATURES = ("bytes", "words", *_BYTES, "word_length", "short", "repeated", "doubled", "again")


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines that are not empty, their lengths in bytes, and the first line of each text."""
    begin, end, first = T.words(data, offsets, np.arange(256) != 0x0A)
    size = (end - begin).astype(np.float64)
    if not len(begin):
        return np.zeros((0, len(FEATURES))), size, first
    columns = {}
    for name, table in _TABLES.items():
        total = np.concatenate([[0], np.cumsum(table[data])])
        columns[name] = (total[end] - total[begin]) / size
    starts, ends, _ = T.words(data, offsets, T.NOT_SPACE)
    h = T.span_hashes(data, starts, ends)
    line = np.searchsorted(begin, starts, "right") - 1
    n = len(begin)
    words = np.bincount(line, minlength=n).astype(np.float64)
    some = np.maximum(words, 1)
    length = (ends - starts).astype(np.float64)
    distinct = np.unique(T.mixed(h + line.astype(np.uint64) * np.uint64(T.MULTIPLIER)), return_index=True)[1]
    columns["bytes"], columns["words"] = np.log1p(size), np.log1p(words)
    columns["word_length"] = np.bincount(line, length, n) / some
    columns["short"] = np.bincount(line, length <= 3, n) / some
    columns["repeated"] = 1 - np.bincount(line[distinct], minlength=n) / some
    doubled = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    columns["doubled"] = np.bincount(line[1:][doubled], minlength=n) / some
    whole = T.span_hashes(data, begin, end)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    again = np.ones(n)
    again[np.unique(T.mixed(whole + owner.astype(np.uint64) * np.uint64(T.MULTIPLIER)), return_index=True)[1]] = 0
    columns["again"] = again
    return np.column_stack([columns[f] for f in FEATURES]), size, first


@dataclass
class Field:
    """Weights of a line's own and its neighbours' features, and of the four transitions."""

    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    step: np.ndarray
    calibration: Logistic | None = None

    def inputs(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A column of ones; standardised features, whether each is there at all; those of the line before and after."""
        z = np.clip((x - self.mean) / self.scale, -4, 4).astype(np.float32)
        before, after = np.zeros_like(z), np.zeros_like(z)
        before[1:], after[:-1] = z[:-1], z[1:]
        has = first[:-1][np.diff(first) > 0]
        ends = first[1:][np.diff(first) > 0] - 1
        before[has] = 0
        after[ends] = 0
        edge = np.zeros((len(z), 2), np.float32)
        edge[has, 0] = 1
        edge[ends, 1] = 1
        return np.column_stack([np.ones(len(z), np.float32), z, (x > 0).astype(np.float32), before, after, edge])

    def marginals(self, score: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line by forward and backward passes over all texts at once, and expected transitions of each text."""
        n = np.diff(first)
        by = np.argsort(-n, kind="stable")
        by = by[: int((n > 0).sum())]
        begin, length = first[:-1][by], n[by]
        longest = int(length[0]) if len(length) else 0
        active = np.searchsorted(-length, -np.arange(1, longest + 1), "right")
        emission = np.exp(np.clip(score, -25, 25))
        emission = np.column_stack([1 / (1 + emission), emission / (1 + emission)])
        move = np.exp(self.step - self.step.max())
        forward, backward = np.empty_like(emission), np.ones_like(emission)
        for t in range(longest):
            at = begin[: active[t]] + t
            a = emission[at] if t == 0 else (forward[at - 1] @ move) * emission[at]
            forward[at] = a / a.sum(1, keepdims=True)
        pairs = np.zeros((len(n), 2, 2))
        for t in range(longest - 2, -1, -1):
            some = by[: active[t + 1]]
            at = begin[: active[t + 1]] + t
            ahead = emission[at + 1] * backward[at + 1]
            b = ahead @ move.T
            joint = forward[at][:, :, None] * move * ahead[:, None, :]
            pairs[some] += joint / joint.sum((1, 2), keepdims=True)
            backward[at] = b / b.sum(1, keepdims=True)
        good = forward * backward
        return good[:, 1] / good.sum(1), pairs

    def quality(self, x: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Mean of the marginals of a text's lines, weighted with their lengths; 0 without lines."""
        good, _ = self.marginals(self.inputs(x, first) @ self.beta, first) if len(x) else (size, None)
        total = lambda v: np.diff(np.concatenate([[0.0], np.cumsum(v)])[first])
        return total(good * size) / np.maximum(total(size), 1)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, size, first = lines(data, offsets)
        raw = self.quality(x, size, first)
        return np.where(np.diff(first) > 0, self.calibration(_logit(raw)) if self.calibration else raw, 0.0)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return (np.log(p) - np.log1p(-p))[:, None]


def trained(x: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 250, ridge: float = 1e-3) -> Field:
    """Field by gradient steps on the conditional likelihood; a text counts ``weight``, each of its lines an equal part."""
    n = np.diff(first)
    label, weight = label.astype(np.float64), weight / weight.sum()
    owner = np.repeat(np.arange(len(n)), n)
    field = Field(x.mean(0), x.std(0) + 1e-6, np.zeros(0), np.zeros((2, 2)))
    z = field.inputs(x, first)
    part = (weight / np.maximum(n, 1))[owner]
    rate = np.average(label, weights=weight)
    prior = np.log(rate / (1 - rate)) if 0 < rate < 1 else 0.0
    theta = np.zeros(z.shape[1] + 4)
    theta[0] = prior
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    seen = np.zeros((len(n), 2, 2))
    seen[np.arange(len(n)), label.astype(int), label.astype(int)] = np.maximum(n - 1, 0)
    for i in range(1, rounds + 1):
        field.beta, field.step = theta[:-4], theta[-4:].reshape(2, 2)
        good, pairs = field.marginals(z @ field.beta, first)
        slope = np.append(z.T @ (part * (label[owner] - good)), (((seen - pairs) / np.maximum(n, 1)[:, None, None]) * weight[:, None, None]).sum(0).ravel())
        slope -= ridge * np.append(0.0, theta[1:])
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta += 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-9)
    field.beta, field.step = theta[:-4], theta[-4:].reshape(2, 2)
    return field


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 3000, max_lines: int = 600_000, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """The field, learned from at most ``max_rows`` labelled documents of each class.

    A document is learned from whole, and every line of it has its label. The sample of a
    class also ends where its documents, in the order of a hash, would have more than
    ``max_lines`` lines together; a document that has more by itself isn't drawn. The mean
    marginal is made a probability on the half that a field has not seen.
    With no labels, or one class only, every text with a line has the same score.
    """
    T.return_memory()  # what the fit needs, the driver has for itself afterwards
    rows = sample(docs, labels, label, max_rows, id_col, text_col)

    def run(batches):
        T.return_memory()
        for batch, data, offsets in T.chunks(batches):
            x, size, first = lines(data, offsets)
            listed = lambda v, k: pa.ListArray.from_arrays(pa.array(first * k, pa.int32()), pa.array(v.astype(np.float32).ravel()))
            columns = [listed(x, len(FEATURES)), listed(size, 1), pa.array(np.diff(first), pa.int64()), *(batch.column(c) for c in ("label", "fold", "weight"))]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "size", "n", "label", "fold", "weight"])

    found = materialise(rows.mapInArrow(run, "x array<float>, size array<float>, n long, label int, fold long, weight double"), "features")
    drawn = F.xxhash64("size", "x")
    sizes = found.where(F.col("n") <= max_lines).groupBy("label", drawn.alias("drawn")).agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("label").orderBy("drawn"))
    within = sizes.withColumn("upto", upto).where(F.col("upto") <= max_lines).select("label", "drawn")
    got = found.withColumn("drawn", drawn).join(within, ["label", "drawn"]).orderBy("label", "drawn").toArrow()
    totals = {r["label"]: r["w"] for r in found.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    discard(rows, found)

    def arrays(name, width):
        column = got.column(name).combine_chunks()
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = np.cumsum(got.column("n").to_numpy())[:-1] if len(got) else []
        return np.split(values.reshape(-1, *width), ends) if len(got) else []

    x, size = arrays("x", (len(FEATURES),)), arrays("size", ())
    y, fold, weight = (got.column(c).to_numpy().copy() for c in ("label", "fold", "weight"))
    for value, total in totals.items():
        if (y == value).any():
            weight[y == value] *= total / weight[y == value].sum()

    def part(which):
        first = np.concatenate([[0], np.cumsum([len(x[i]) for i in which])]).astype(np.int64)
        return np.concatenate([np.zeros((0, len(FEATURES))), *(x[i] for i in which)]), np.concatenate([np.zeros(0), *(size[i] for i in which)]), first

    if len(set(y.tolist())) < 2:
        rate = float(y.mean()) if len(y) else 0.5
        return Field(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.append(np.log((rate + 1e-3) / (1.001 - rate)), np.zeros(4 * len(FEATURES) + 2)), np.zeros((2, 2)))
    halves = [np.flatnonzero(fold == f) for f in (0, 1)]
    calibration = None
    if all(len(set(y[h].tolist())) == 2 for h in halves):
        raw = np.zeros(len(y))
        for mine, other in (halves, halves[::-1]):
            z, _, first = part(mine)
            raw[other] = trained(z, first, y[mine], weight[mine]).quality(*part(other))
        calibration = Logistic(_logit(raw), y, weight)
    z, _, first = part(np.arange(len(y)))
    field = trained(z, first, y, weight)
    field.calibration = calibration
    return field


def scored(docs: DataFrame, field: Field, text_col: str = "text", name: str = "score") -> DataFrame:
    """Every column of ``docs`` and ``name``: the probability, 0 to 1, that the whole text is good.

    Only the text is looked at. Null and empty texts, and texts of line feeds alone, have no line and
    score 0; equal texts get equal scores. A column of that name in ``docs`` is replaced. Nothing is shuffled.
    """
    kept = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        T.return_memory()
        for batch, data, offsets in T.chunks(batches, text_col):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value(data, offsets))], names=[*batch.schema.names, name])

    return kept.mapInArrow(run, kept.select("*", F.lit(0.0).alias(name)).schema)
