"""Benchmark passages in documents: winnowed fingerprints joined, hits extended word by word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.llm import text as T
from spanfolio.sources.workspace import materialise

#: Words of a window; grams of GRAM words, least of WIDTH of them: GRAM + WIDTH - 1 = WINDOW.
WINDOW, GRAM = 10, 5
WIDTH = WINDOW - GRAM + 1
#: Words kept around a fingerprint: as many before it as a window can reach, and from it on.
BEFORE, FROM = WINDOW - GRAM, WINDOW
CONTEXT = BEFORE + FROM
#: Bits of the filter that spares documents' fingerprints the shuffle. Its size is fixed;
#: where a large benchmark fills it, more fingerprints are joined and results stay the same.
FILTER_BITS = 1 << 26

_PRINT = "array<struct<fp:bigint,need:int,pos:int,context:binary>>"
_ARROW = pa.list_(pa.struct([("fp", pa.int64()), ("need", pa.int32()), ("pos", pa.int32()), ("context", pa.binary())]))


def _salted(h: np.ndarray, need: int) -> np.ndarray:
    return T.mixed(h + np.uint64(need) * np.uint64(T.MULTIPLIER))


def _prints(data, offsets, shorter, bits, fill):
    """Of each text the number of words, and of each fingerprint: its text, hash, length needed, word and words around."""
    starts, ends, first = T.words(data := T.LOWER[data], offsets, T.WORD)
    h = T.span_hashes(data, starts, ends)
    n = len(h)
    room = T.room(first)
    found = []
    if n >= WINDOW:
        gram = T.grams(h, GRAM)
        at = np.unique(T.anchors(gram, WIDTH)[room[: n - WINDOW + 1] >= WINDOW])
        found.append((at, _salted(gram[at], WINDOW), WINDOW))
    counts = np.diff(first)
    if shorter is None:  # benchmark items: those of fewer words are one window
        for need in np.unique(counts[(counts > 0) & (counts < WINDOW)]).tolist():
            at = first[:-1][counts == need]
            found.append((at, _salted(T.grams(h, need)[at], need), need))
    else:
        for need in shorter:
            if n >= need:
                at = np.flatnonzero(room[: n - need + 1] >= need)
                found.append((at, _salted(T.grams(h, need)[at], need), need))
    out = []
    padded = np.full(n + CONTEXT, fill, np.uint64)
    padded[BEFORE : BEFORE + n] = h
    for at, fp, need in found:
        if bits is not None:
            slot = (fp & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            keep = (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
            at, fp = at[keep], fp[keep]
        owner = np.searchsorted(first, at, "right") - 1
        around = padded[at[:, None] + np.arange(CONTEXT)]
        position = at[:, None] + np.arange(-BEFORE, FROM)
        around[(position < first[owner][:, None]) | (position >= first[owner + 1][:, None])] = fill
        out += zip(owner.tolist(), fp.view(np.int64).tolist(), [need] * len(at), (at - first[owner]).tolist(), map(bytes, around), strict=True)
    return counts, sorted(out, key=lambda x: x[0])


def _fingerprints(rows: DataFrame, shorter: list[int] | None, bits, fill: int) -> DataFrame:
    """``key``, the number of words and the fingerprints of each row of (key, text)."""
    schema = rows.select("key", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(_PRINT).alias("prints")).schema

    def run(batches):
        table = None if bits is None else np.frombuffer(bits.value, np.uint64)
        for batch, data, offsets in T.chunks(batches):
            counts, found = _prints(data, offsets, shorter, table, np.uint64(fill))
            lists: list[list] = [[] for _ in range(len(batch))]
            for owner, *row in found:
                lists[owner].append(dict(zip(("fp", "need", "pos", "context"), row, strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(lists, _ARROW)], names=["key", "n_words", "prints"])

    return rows.mapInArrow(run, schema)


def _filter_bits(prints: DataFrame) -> bytes:
    """A bit for each fingerprint of the benchmark, by its lowest bits; FILTER_BITS bits whatever their number."""
    slot = F.col("fp").bitwiseAND(F.lit(FILTER_BITS - 1))
    word = F.shiftright(slot, 6)
    rows = prints.groupBy(word.alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast(fp & 63 as int)))").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.tobytes()


def _extended(pairs: DataFrame) -> DataFrame:
    """Words of the document, from start to end (exclusive), that the item has too around a common fingerprint."""

    def run(batches):
        for batch in batches:
            n = len(batch)
            matrix = lambda name: np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint64).reshape(n, CONTEXT)
            same = matrix("context") == matrix("item_context")
            need, pos = batch.column("need").to_numpy(), batch.column("pos").to_numpy().astype(np.int64)
            right = np.logical_and.accumulate(same[:, BEFORE:], axis=1).sum(axis=1)
            left = np.logical_and.accumulate(same[:, BEFORE - 1 :: -1], axis=1).sum(axis=1)
            whole = need == WINDOW
            start, end = np.where(whole, pos - left, pos), np.where(whole, pos + right, pos + need)
            ok = np.where(whole, (right >= GRAM) & (left + right >= WINDOW), right >= need)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").filter(pa.array(ok)), batch.column("item").filter(pa.array(ok)), pa.array(start[ok]), pa.array(end[ok])],
                names=["key", "item", "start", "end"],
            )

    return pairs.mapInArrow(run, "key long, item string, start long, end long")


def hits(docs: DataFrame, benchmark: DataFrame, key: str, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """For each row of ``docs`` what it shares with the benchmark.

    Words are lower-cased and made of letters, digits and characters beyond ASCII. A
    window is ten consecutive words of an item, or the whole item if it has fewer.
    Columns: ``key`` (numbers the rows, see ``text.numbered``), ``n_words``, ``n_hit``
    (words inside occurring windows), ``items`` (sorted ids, as strings, of items with
    occurring windows) and ``spans`` (maximal runs of hit words, start and end).

    Every window of ten words has a least gram of five among its six, the same in
    document and item, so the join on these fingerprints meets every shared window.
    Null and empty texts have no words and no hits; an item without id marks words but
    is not listed; items that repeat an id count as one.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("key"), F.col(text_col).cast("string").alias("text"))
    prints = materialise(_fingerprints(items, None, None, 1).select("key", F.inline("prints")), "benchmark-prints")
    shorter = sorted(r[0] for r in prints.where(F.col("need") < WINDOW).select("need").distinct().collect())
    bits = spark.sparkContext.broadcast(_filter_bits(prints))
    rows = docs.select(F.col(key).alias("key"), F.col(text_col).cast("string").alias("text"))
    of_docs = materialise(_fingerprints(rows, shorter, bits, 2), "document-prints")
    asked = prints.select(F.col("key").alias("item"), "fp", F.col("need").alias("item_need"), F.col("context").alias("item_context"))
    pairs = of_docs.select("key", F.inline("prints")).join(asked, "fp").where("need = item_need")
    matched = materialise(_extended(pairs.select("key", "item", "need", "pos", "context", "item_context")), "benchmark-hits")
    runs = matched.groupBy("key", "start").agg(F.max("end").alias("end")).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))
    runs = runs.select(
        "key",
        F.expr(
            "aggregate(runs, cast(array() as array<struct<start:bigint,end:bigint>>), (done, x) -> "
            "if(size(done) > 0 and element_at(done, -1).end >= x.start, "
            "concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, x.end)))), "
            "concat(done, array(x))))"
        ).alias("spans"),
    )
    named = matched.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    out = of_docs.select("key", "n_words").join(runs, "key", "left").join(named, "key", "left")
    out = out.withColumn("spans", F.coalesce("spans", none)).withColumn("items", F.coalesce("items", F.expr("cast(array() as array<string>)")))
    return out.select(
        F.col("key").alias(key), "n_words", F.expr("aggregate(spans, 0L, (n, x) -> n + x.end - x.start)").alias("n_hit"), "items", "spans"
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs`` without any word of a benchmark window; columns stay as they are."""
    rows, key = T.numbered(docs, id_col, text_col)
    bad = materialise(hits(rows, benchmark, key, text_col, item_col).where("n_hit > 0").select(key), "contaminated")
    return T.without(rows, bad, key).select(*docs.columns)
