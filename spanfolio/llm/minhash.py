"""Near-duplicate documents: fast similarity sketches, bands, exact verification, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.llm import text as T
from spanfolio.llm.components import components
from spanfolio.sources.workspace import discard, materialise

SHINGLE = 5
#: Coordinates of a sketch and rows of a band. A pair of similarity 0.8 misses all 30 bands
#: with probability 1.4e-7, one of 0.85 with 2.4e-10.
COORDINATES, ROWS = 120, 4
BANDS = COORDINATES // ROWS


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and where each text's begin (n + 1 numbers)."""
    data = T.LOWER[data]
    starts, ends, first = T.words(data, offsets, T.NOT_SPACE)
    h = T.span_hashes(data, starts, ends)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    whole = np.flatnonzero(T.room(first)[: max(0, len(h) - SHINGLE + 1)] >= SHINGLE)
    found, owners = [T.grams(h, SHINGLE)[whole]], [owner[whole]]
    for few in range(1, SHINGLE):
        at = first[:-1][n == few]
        if len(at):
            found.append(T.mixed(T.grams(h, few)[at] + np.uint64(few)))
            owners.append(owner[at])
    found, owners = np.concatenate(found), np.concatenate(owners)
    by = np.lexsort((found, owners))
    found, owners = found[by], owners[by]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owners[1:] != owners[:-1])
    return found[new], np.searchsorted(owners[new], np.arange(len(n) + 1))


def sketches(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fast similarity sketch of each set: in round i every element falls into one bin with value (i, hash).

    From round COORDINATES on, round i fills bin i - COORDINATES with the least hash of
    all elements, so every bin of a set that isn't empty is filled by the end. A set
    takes part until its bins are full; later values are greater, so that two sets fill
    a coordinate equally with probability of their similarity.
    """
    n = len(first) - 1
    out = np.full((n, COORDINATES), ~np.uint64(0))
    sizes = np.diff(first)
    active = np.flatnonzero(sizes)
    flat = out.reshape(-1)
    for i in range(2 * COORDINATES):
        if not len(active):
            break
        owner = np.repeat(active, sizes[active])
        x = sets if len(active) == n else sets[np.repeat(first[active] - np.cumsum(sizes[active]) + sizes[active], sizes[active]) + np.arange(len(owner))]
        h = T.mixed(x + np.uint64((i + 1) * T.MULTIPLIER & (1 << 64) - 1))
        bins = (h % np.uint64(COORDINATES)).astype(np.int64) if i < COORDINATES else np.full(len(h), i - COORDINATES)
        value = (np.uint64(i) << np.uint64(56)) | (T.mixed(h) >> np.uint64(8))
        np.minimum.at(flat, owner * COORDINATES + bins, value)
        active = active[(out[active] == ~np.uint64(0)).any(1)]
    return out


def _bands(sketch: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sketch), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        out = T.mixed(out + sketch[:, r::ROWS])
    return out


def _summaries(rows: DataFrame) -> DataFrame:
    """Number of shingles of each text, two sums that equal sets share, and its bands."""

    def run(batches):
        for batch, data, offsets in T.chunks(batches):
            sets, first = shingles(data, offsets)
            sizes = np.diff(first)
            full = np.flatnonzero(sizes)
            sums = np.zeros((2, len(sizes)), np.uint64)
            if len(full):
                sums[0, full] = np.add.reduceat(T.mixed(sets), first[full])
                sums[1, full] = np.add.reduceat(T.mixed(sets ^ np.uint64(T.MULTIPLIER)), first[full])
            bands = _bands(sketches(sets, first)).view(np.int64)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * BANDS, pa.int32()), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), *(pa.array(s.view(np.int64)) for s in sums), flat], names=["key", "n_shingles", "s0", "s1", "bands"]
            )

    return rows.mapInArrow(run, "key long, n_shingles long, s0 long, s1 long, bands array<long>")


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (a, b) the sizes of both full sets and of their intersection."""

    def run(batches):
        known: dict[int, np.ndarray] = {}

        def sets(keys, column):
            wanted = [i for i, k in enumerate(keys) if k not in known]
            data, offsets = T.utf8(column.take(pa.array(wanted, pa.int64())))
            found, first = shingles(data, offsets)
            known.update((keys[i], found[first[j] : first[j + 1]]) for j, i in enumerate(wanted))

        for batch in batches:
            for low in range(0, len(batch), 512):
                part = batch.slice(low, 512)
                known.clear()
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                sets(a, part.column("text_a"))
                sets(b, part.column("text_b"))
                both = [len(np.intersect1d(known[x], known[y], assume_unique=True)) for x, y in zip(a, b, strict=True)]
                sizes = [pa.array([len(known[x]) for x in side], pa.int64()) for side in (a, b)]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), *sizes, pa.array(both, pa.int64())], names=["a", "b", "size_a", "size_b", "common"])

    of = lambda side: texts.select(F.col("key").alias(side), F.col("text").alias(f"text_{side}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, size_a long, size_b long, common long")


def _own(texts: DataFrame) -> DataFrame:
    """``id`` and ``own``: how many shingles of a text no other one has; texts without any are left out."""

    def run(batches):
        for batch, data, offsets in T.chunks(batches):
            sets, first = shingles(data, offsets)
            keys = np.repeat(batch.column("key").to_numpy(), np.diff(first))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sets.view(np.int64))], names=["key", "shingle"])

    each = texts.mapInArrow(run, "key long, shingle long")
    once = each.groupBy("shingle").agg(F.min("key").alias("id"), F.max("key").alias("last")).where("id = last")
    return once.groupBy("id").agg(F.count("*").alias("own"))


def grouped(docs: DataFrame, key: str, text_col: str = "text", percent: int = 85) -> DataFrame:
    """For each row of ``docs``: ``key``, ``n_shingles`` and ``component``, the least key its links reach.

    Words are lower-cased and split at white space; a document's set has its distinct
    shingles of five words, or all its words as one if it has fewer. Documents whose
    sets have at least ``percent`` hundredths of their union in common are linked. One
    without words is linked with nothing (``n_shingles`` 0).

    Equal sets are one document from the start. Those that share a band meet in a
    bucket; its center is the one with the smallest share of shingles that no other
    candidate has, the least edited of a group of copies. All members are compared with it,
    which joins groups of copies without their pairs. Members that are in different
    components after that are compared with each other unless their link is impossible:
    two members x and y of a bucket with center c share at most
    min(|x & c|, |y & c|) + min(e(x), e(y)), where e counts the shingles outside c that some
    other candidate has too. So no link is given up but those inside a component.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text_col).cast("string").alias("text"))
    summaries = materialise(_summaries(rows), "sketches")
    full = summaries.where("n_shingles > 0")
    equal = ["n_shingles", "s0", "s1"]
    first = materialise(full.groupBy(*equal).agg(F.min_by("bands", "key").alias("bands"), F.min("key").alias("rep")), "distinct-sets")
    buckets = first.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("bucket")
    buckets = materialise(buckets.join(shared, "bucket"), "buckets")
    candidates = materialise(buckets.select(F.col("id").alias("key")).distinct(), "candidates")
    texts = materialise(T.among(rows, candidates, "key"), "candidate-texts")
    discard(candidates)
    own = materialise(_own(texts), "own-shingles")
    judged = materialise(buckets.join(own, "id", "left").withColumn("own", F.coalesce("own", F.lit(0))), "members")
    discard(buckets, own)
    centers = judged.groupBy("bucket").agg(F.min_by("id", F.struct(F.col("own") / F.col("n"), "id")).alias("center"))
    members = materialise(judged.join(centers, "bucket"), "members")
    discard(judged)
    ends = F.greatest("id", "center").alias("a"), F.least("id", "center").alias("b")
    compared = materialise(_compared(members.where("id <> center").select(*ends).distinct(), texts), "compared")
    similar = f"100 * common >= {int(percent)} * (size_a + size_b - common)"
    links = compared.where(similar).select("a", "b")
    roots = components(links)
    # what a member shares with the center of its bucket, and its component
    shares = compared.select("a", "b", "common").unionAll(compared.select(F.col("b").alias("a"), F.col("a").alias("b"), "common"))
    state = members.join(shares.select(F.col("a").alias("id"), F.col("b").alias("center"), "common"), ["id", "center"], "left")
    state = state.withColumn("common", F.coalesce("common", "n")).withColumn("extra", F.greatest(F.col("n") - F.col("common") - F.col("own"), F.lit(0)))
    state = state.join(roots, "id", "left").select("bucket", "id", "n", "common", "extra", F.coalesce("root", "id").alias("root"))
    state = materialise(state, "states")
    discard(members)
    several = state.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    unsettled = materialise(state.join(several, "bucket"), "open-buckets")
    discard(state)
    x, y = unsettled.alias("x"), unsettled.alias("y")
    most = "(least(x.common, y.common) + least(x.extra, y.extra))"
    possible = F.expr(f"x.bucket = y.bucket AND x.root < y.root AND 100 * {most} >= {int(percent)} * (x.n + y.n - {most})")
    pairs = x.join(y, possible).select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).distinct()
    more = materialise(_compared(pairs, texts).where(similar).select("a", "b"), "links")
    discard(unsettled, texts)
    if not more.isEmpty():
        discard(roots)
        roots = components(links.unionAll(more))
    discard(compared, more)
    known = first.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select(*equal, F.coalesce("root", "rep").alias("component"))
    found = summaries.join(known, equal, "left").select(F.col("key").alias(key), "n_shingles", F.coalesce("component", "key").alias("component"))
    found = materialise(found, "components")
    discard(summaries, first, roots)
    return found


def distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The first document, in the order of ids, of each group of near duplicates; columns stay as they are.

    Documents without words are all kept. See ``grouped``; repeated ids count as documents of their own.
    """
    rows, key = T.numbered(docs, id_col, text_col)
    later = grouped(rows, key, text_col, percent).where(F.col("component") != F.col(key)).select(key)
    return T.without(rows, later, key).select(*docs.columns)
