"""Substring removal by bytes: longest previous factors in suffix order."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.llm import repeats as R
from spanfolio.llm import text as T


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by their first ``depth`` bytes, equal ones by position, and lcp of neighbours, to depth.

    ``depth`` bytes must follow each start. Suffixes are compared eight bytes at a time, most significant first.
    """
    chunks = -(-depth // 8)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    word = np.zeros(len(data) + 1, np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | padded[i : i + len(word)]
    columns = []
    for c in range(chunks):
        w = word[starts + 8 * c]
        spare = 8 * (c + 1) - depth
        columns.append(w >> np.uint64(8 * spare) if spare > 0 else w)
    order = np.lexsort([starts, *columns[::-1]])
    lcp = np.zeros(len(order), np.int64)
    open_ = np.ones(max(0, len(order) - 1), bool)
    for c, w in enumerate(columns):
        s = w[order]
        differ = s[1:] ^ s[:-1]
        width = min(8, depth - 8 * c)
        same = np.full(len(differ), width)
        for byte in range(width - 1, -1, -1):
            same[differ >> np.uint64(8 * (width - 1 - byte)) & np.uint64(255) != 0] = byte
        lcp[1:] += np.where(open_, same, 0)
        open_ &= same == width
    return order, lcp


def longest_previous(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Longest previous factor at each of ``starts`` (in order), as far as ``depth`` bytes.

    In suffix order the earlier suffix with the longest common prefix is the nearest one
    before or after it with a smaller position; the common prefix is the least lcp on the way.
    """
    order, lcp = suffix_order(data, starts, depth)
    out = np.zeros(len(starts), np.int64)
    for places, common in ((order, lcp), (order[::-1], np.append(0, lcp[:0:-1]))):
        stack: list[tuple[int, int]] = []
        for place, least in zip(places.tolist(), common.tolist(), strict=True):
            while stack and stack[-1][0] > place:
                least = min(least, stack.pop()[1])
            if stack:
                out[place] = max(out[place], least)
            stack.append((place, least))
    return out


def _new(data: np.ndarray, length: int, starts: np.ndarray) -> np.ndarray:
    """Places in ``starts`` whose longest previous factor is shorter than ``length``.

    Suffixes with ``length`` bytes in common are neighbours in the order, by position, so
    that the previous smaller position of any but their first is the neighbour before it.
    """
    order, lcp = suffix_order(data, starts, length)
    return np.sort(order[lcp < length])


def rule(length: int = 100, seed: int = 20) -> R.Rule:
    """Strings of ``length`` bytes, found by anchors of ``seed`` bytes."""
    return R.Rule(length, seed, lambda data, offsets: (data, offsets), T.byte_grams, _new)


def deduplicated(docs: DataFrame, key: str, text_col: str = "text", length: int = 100, digest: bool = False) -> DataFrame:
    """For each row of ``docs``: ``key``, ``n_bytes``, ``n_removed``, the maximal removed ``spans`` and the ``kept`` bytes.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document
    with a smaller key, or earlier in the same one, overlapping or not. Strings are judged on the
    input and never cross documents. ``kept`` is binary, since a cut may part a character. With
    ``digest`` the result has ``n_spans`` and ``kept_sha256`` in place of ``spans`` and ``kept``. Null and
    empty texts have no bytes; shorter texts keep all; of equal rows the first in key order stays.
    """
    of = rule(length)
    rows = docs.select(F.col(key).alias("key"), F.col(text_col).cast("string").alias("text"))
    types = "n_spans long, kept_sha256 string" if digest else "spans array<struct<start:bigint,end:bigint>>, kept binary"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch, data, offsets in T.unpacked(batches):
            gone = R.removed(batch, offsets, of)
            n, spans, kept = [], [], []
            for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                mine = gone[low:high]
                n.append(int(mine.sum()))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
                rest = data[low:high][~mine].tobytes()
                spans.append(len(edge) // 2 if digest else [{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                kept.append(hashlib.sha256(rest).hexdigest() if digest else rest)
            columns = [batch.column("key"), pa.array(np.diff(offsets), pa.int64()), pa.array(n, pa.int64())]
            columns += [pa.array(spans, pa.int64() if digest else kind), pa.array(kept, pa.string() if digest else pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_bytes", "n_removed", *(["n_spans", "kept_sha256"] if digest else ["spans", "kept"])])

    return R.marked(rows, of).mapInArrow(run, f"key long, n_bytes long, n_removed long, {types}").withColumnRenamed("key", key)
