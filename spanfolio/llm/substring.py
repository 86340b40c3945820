"""Substring removal by words: winnowed anchors are joined and extended to maximal repeats."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.llm import repeats as R
from spanfolio.llm import text as T


def _words(data, offsets):
    starts, ends, first = T.words(data, offsets, T.NOT_SPACE)
    return T.span_hashes(data, starts, ends), first


def rule(words: int = 20, seed: int = 5) -> R.Rule:
    """Windows of ``words`` words, found by anchors of ``seed`` words."""
    return R.Rule(words, seed, _words, T.grams)


def deduplicated(docs: DataFrame, key: str, text_col: str = "text", words: int = 20, digest: bool = False) -> DataFrame:
    """For each row of ``docs``: ``key``, ``n_words``, ``n_removed``, the maximal ``runs`` of removed words and ``kept``.

    A word goes if it lies in a window of ``words`` consecutive words of a document whose
    sequence also starts earlier: in a document with a smaller key, or earlier in the same
    one. Windows are judged on the input. Words are split at white space; ``kept`` has
    those that stay, joined by one blank. With ``digest`` its SHA-256 (``kept_sha256``)
    stands in place of ``kept`` and ``runs``. Null and empty texts have no words; a text
    of fewer words than a window keeps all; equal rows have keys in some order, the first stays.
    """
    of = rule(words)
    rows = docs.select(F.col(key).alias("key"), F.col(text_col).cast("string").alias("text"))
    types = "kept_sha256 string" if digest else "runs array<struct<start:bigint,end:bigint>>, kept string"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch, data, offsets in T.unpacked(batches):
            starts, ends, first = T.words(data, offsets, T.NOT_SPACE)
            gone = R.removed(batch, first, of)
            raw = data.tobytes()
            counts = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
            kept, runs = [], []
            starts, ends = starts.tolist(), ends.tolist()
            for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                stay = low + np.flatnonzero(~gone[low:high])
                text = b" ".join([raw[starts[i] : ends[i]] for i in stay.tolist()])
                kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
                if not digest:
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[low:high].astype(np.int8), [0]])))
                    runs.append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
            columns = [batch.column("key"), pa.array(np.diff(first), pa.int64()), pa.array(counts, pa.int64())]
            columns += [pa.array(kept, pa.string())] if digest else [pa.array(runs, kind), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "n_removed", *(["kept_sha256"] if digest else ["runs", "kept"])])

    return R.marked(rows, of).mapInArrow(run, f"key long, n_words long, n_removed long, {types}").withColumnRenamed("key", key)
