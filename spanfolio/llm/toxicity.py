"""Toxicity: class-conditional Kneser-Ney models of words, compared per word."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.llm import kneser_ney as K
from spanfolio.llm import text as T
from spanfolio.llm.gathered import gathered
from spanfolio.llm.labelled import Logistic, every, sample
from spanfolio.sources.workspace import discard, materialise

#: Bytes of a gram; orders up to SHARED are counted for both classes together.
ORDER, SHARED = 6, 3
#: Groups of the counts: class in the lowest bit, above it the rows: all, or those of one fold.
ALL = 0
TOXIC = 1 << K.BYTES
FEATURES = ("mean_llr", "excess", "strong", "strongest", "size")


def _streams(data, starts, ends):
    """Packed grams of words, and where each word's begin: one for each byte and one for the end."""
    stream, begin = K.word_stream(data, starts, ends, ORDER - 1)
    n = ends - starts + 1
    first = np.cumsum(n) - n
    at = np.repeat(begin - (ORDER - 1) - first, n) + np.arange(int(n.sum()))
    return K.packed(stream, ORDER)[at], first


def _distinct(data, offsets, salt=None):
    """Distinct words of the texts: starts and ends of one of each, for every word which it is, and the first of each text."""
    starts, ends, first = T.words(data, offsets, T.WORD)
    h = T.span_hashes(data, starts, ends)
    if salt is not None:
        h = T.mixed(h + np.repeat(salt, np.diff(first)).astype(np.uint64))
    at, inverse = T.classes(h)
    return starts[at], ends[at], inverse, at, first


def _counts(rows: DataFrame) -> DataFrame:
    def grams(batches):
        T.return_memory()
        for batch, data, offsets in T.unpacked(batches, limit=T.SMALLER_CHUNK):
            data = T.LOWER[data]
            label, fold = (batch.column(c).to_numpy().astype(np.int64) for c in ("label", "fold"))
            starts, ends, inverse, at, first = _distinct(data, offsets, label * 2 + fold)
            if not len(at):
                continue
            owner = np.repeat(np.arange(len(batch)), np.diff(first))[at]
            gram, _ = _streams(data, starts, ends)
            each = ends - starts + 1
            times = np.repeat(np.bincount(inverse), each)
            for rows_of in (np.zeros(len(owner), np.int64), 1 + fold[owner]):
                yield gram | np.repeat(rows_of * 2 + label[owner], each) << K.BYTES, times

    return K.counted(rows, grams)


def _keys(data, offsets, rows_of):
    """Grams of the distinct words, each for the counts its text is judged by: with them where each
    word's begin, for every word of the texts which it is, and the first of each text."""
    data = T.LOWER[data]
    starts, ends, inverse, at, first = _distinct(data, offsets, rows_of)
    if not len(at):
        return np.zeros(0, np.int64), at, inverse, first
    owner = np.repeat(np.arange(len(rows_of)), np.diff(first))[at]
    gram, begin = _streams(data, starts, ends)
    return gram | np.repeat(rows_of[owner] * 2, ends - starts + 1) << K.BYTES, begin, inverse, first


def _features(data, offsets, rows_of, values) -> np.ndarray:
    """For each text, from the log-likelihood ratio toxic over ordinary of each word.

    The mean over its words (the length-normalised log-likelihoods, compared), the mean of
    what words exceed 1.5 by, the logarithm of the number over 2.5, the greatest, and the
    logarithm of the number of words.
    """
    gram, begin, inverse, first = _keys(data, offsets, rows_of)
    n = np.diff(first)
    out = np.zeros((len(n), len(FEATURES)))
    if not len(gram):
        return out
    ratio = values(gram).astype(np.float64)
    llr = np.clip(np.add.reduceat(ratio, begin), -6, 10)[inverse]
    owner = np.repeat(np.arange(len(n)), n)
    some = np.maximum(n, 1)
    out[:, 0] = np.bincount(owner, llr, len(n)) / some
    out[:, 1] = np.bincount(owner, np.maximum(llr - 1.5, 0), len(n)) / some
    out[:, 2] = np.log1p(np.bincount(owner, llr > 2.5, len(n)))
    full = n > 0
    out[full, 3] = np.maximum.reduceat(llr, first[:-1][full])
    out[:, 4] = np.log1p(n)
    return out


def ratios(language: K.Levels, wanted: DataFrame) -> DataFrame:
    """(``key``, ``value``): log-likelihood ratio toxic over ordinary of the grams of ``wanted`` (``gram``: class bit unset)."""
    toxic = F.col("gram").bitwiseAND(F.lit(TOXIC)) != 0
    both = wanted.select(F.explode(F.array("gram", F.col("gram").bitwiseOR(F.lit(TOXIC)))).alias("gram"))
    signed = F.when(toxic, F.log("p")).otherwise(-F.log("p"))
    found = K.probabilities(language, both)
    out = materialise(found.groupBy(F.col("gram").bitwiseAND(F.lit(~TOXIC)).alias("key")).agg(F.sum(signed).cast("float").alias("value")), "ratios")
    discard(found)
    return out


def _compared(docs: DataFrame, text_col: str, language: K.Levels, rows_of: Callable, judged: Callable, schema, inputs: list[str]) -> tuple[DataFrame, DataFrame]:
    """``judged(batch, features)`` for pieces of ``docs``, and the written ratios that it reads. ``rows_of(batch)`` tells by which counts each text is judged, from ``inputs``."""

    def grams(batches):
        T.return_memory()
        for batch, data, offsets in T.chunks(batches, text_col, T.SMALLER_CHUNK):
            found = T.distinct(_keys(data, offsets, rows_of(batch))[0])
            yield found, np.ones(len(found), np.int64)

    def asked(piece):
        batch, data, offsets = piece
        return T.distinct(_keys(data, offsets, rows_of(batch))[0])

    def used(piece, values):
        batch, data, offsets = piece
        return judged(batch, _features(data, offsets, rows_of(batch), values))

    values = ratios(language, K.counted(docs.select(*inputs), grams))
    return gathered(docs, text_col, asked, values, used, schema), values


@dataclass
class Model:
    language: K.Levels
    weights: Logistic

    def discard(self) -> None:
        """Delete the tables of the model, when no more texts are to be scored. What ``scored`` has returned doesn't read them."""
        K.forget(self.language)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = 12_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Models of toxic and ordinary words, and the weights that turn their comparison into a probability.

    Words are counted over every labelled document and every gram is kept, as tables; the
    weights alone are fitted on a sample of at most ``max_rows`` of each class. Every byte of a
    word is predicted from the bytes of the word before it; a rare expression falls back
    to shorter histories, and those of two bytes and fewer are counted for both classes
    together, so it says nothing for either. Weights are fitted on each half of the
    documents with the models of the other half. With no labels every score is 0.5. The
    halves' models are gone before that of all documents is made.
    """
    rows = sample(docs, labels, label, max_rows, id_col, text_col)
    counts = materialise(_counts(every(docs, labels, label, id_col, text_col)), "grams")
    whole = F.col("gram") < 2 << K.BYTES
    halves = K.levels(counts.where(~whole), ORDER, SHARED)

    def judged(batch, out):
        return pa.RecordBatch.from_arrays([*map(pa.array, out.T), batch.column("label"), batch.column("weight")], names=[*FEATURES, "label", "weight"])

    other = lambda batch: 2 - batch.column("fold").to_numpy().astype(np.int64)
    schema = ", ".join(f"{f} double" for f in FEATURES) + ", label int, weight double"
    seen, values = _compared(rows, "text", halves, other, judged, schema, ["text", "fold"])
    got = seen.toArrow().sort_by([(c, "ascending") for c in ("label", *FEATURES)])
    discard(values)
    K.forget(halves)
    language = K.levels(counts.where(whole), ORDER, SHARED)
    discard(counts, rows)
    x = np.column_stack([got.column(f).to_numpy() for f in FEATURES])
    return Model(language, Logistic(x, got.column("label").to_numpy(), got.column("weight").to_numpy()))


def scored(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """Every column of ``docs`` and ``name``: the probability, 0 to 1, that the whole text is toxic.

    Only the text is looked at. Null and empty texts get the score of a text without words; equal
    texts get equal scores. A column of that name in ``docs`` is replaced. Texts cross the
    network once, compressed, to meet the ratios of their grams (see ``gathered``).
    """
    kept = docs.drop(name)
    weights = model.weights

    def judged(batch, out):
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(weights(out))], names=[*batch.schema.names, name])

    every_row = lambda batch: np.full(len(batch), ALL, np.int64)
    return _compared(kept, text_col, model.language, every_row, judged, kept.select("*", F.lit(0.0).alias(name)).schema, [text_col])[0]
