"""Words and hashes of many texts at once, in numpy, and numbered documents.

All functions work on the UTF-8 bytes of a column: ``data`` (uint8) holds every text
behind the other and ``offsets`` (n + 1 numbers) where each begins. Both word rules
used here split on ASCII bytes only, so bytes and code points give the same words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.sources.workspace import materialise

PIECE = 1 << 18
CHUNK_BYTES = 1 << 21
#: For operators with many arrays as long as a chunk.
SMALLER_CHUNK = 1 << 20
#: The C library's option for the size from which an allocation has pages of its own.
_M_MMAP_THRESHOLD = -3
MULTIPLIER = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 32) - 1)


@lru_cache(maxsize=1)
def return_memory() -> None:
    """From now on this worker gives large arrays back to the system when they are freed.

    Otherwise the C library keeps what a chunk needed, beside Arrow's own pool, for as
    long as the worker lives. Where that library lacks the option nothing changes.
    """
    try:
        ctypes.CDLL(None).mallopt(_M_MMAP_THRESHOLD, 1 << 20)
    except (AttributeError, OSError):
        return
    pa.set_memory_pool(pa.system_memory_pool())


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = powers(MULTIPLIER, PIECE + 1)
_INVERSE = powers(pow(MULTIPLIER, -1, 1 << 64), PIECE + 1)

#: Bytes that are part of a word where words are split at white space only.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of letters, digits and everything beyond ASCII, after lower-casing.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower-cases A-Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches, name: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches of about ``limit`` bytes of text, one document at least, with bytes and offsets."""
    for batch in batches:
        data, offsets = utf8(batch.column(batch.schema.get_field_index(name)))
        first = 0
        while first < len(batch):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
            last = min(last, len(batch))
            yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            first = last


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each text the number of its first word (n + 1 numbers)."""
    return runs(table[data], offsets)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``words`` of bytes that are marked as ``inside``."""
    start, stop = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    start[edges] = inside[edges]
    stop[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def distinct(keys: np.ndarray) -> np.ndarray:
    """Each key once, sorted."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return keys[new]


def classes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, in the order of keys, and for every place which of them is there."""
    by = np.argsort(keys)
    ordered = keys[by]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    which = np.empty(len(keys), np.int64)
    which[by] = np.cumsum(new) - 1
    return by[new], which


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans given in order of their starts and ends."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        size = int(ends[upto - 1]) - base
        if size > PIECE:  # one span longer than a piece
            power, inverse = powers(MULTIPLIER, size + 1), np.ones(1, np.uint64)
        else:
            power, inverse = _POWERS, _INVERSE
        total = np.zeros(size + 1, np.uint64)
        np.cumsum((data[base : base + size].astype(np.uint64) + np.uint64(1)) * power[:size], out=total[1:])
        s, e = starts[at:upto] - base, ends[at:upto] - base
        out[at:upto] = (total[e] - total[s]) * inverse[s]
        at = upto
    return mixed(out ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive numbers."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0xD1342543DE82EF95) + h[i : i + len(out)]
    return mixed(out)


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive keys."""
    if len(keys) < width:
        return keys[:0]
    done, size = keys, 1
    while size * 2 <= width:
        done, size = np.minimum(done[: len(done) - size], done[size:]), size * 2
    n = len(keys) - width + 1
    return np.minimum(done[:n], done[width - size : width - size + n])


def anchors(gram: np.ndarray, width: int) -> np.ndarray:
    """Winnowing: for every ``width`` consecutive grams the position of the least, the leftmost of equal ones.

    The order is that of the upper half of the hash; which gram a window picks depends
    on the window alone, so equal windows pick the same one.
    """
    keys = (gram & ~_LOW) | np.arange(len(gram), dtype=np.uint64)
    return (sliding_min(keys, width) & _LOW).astype(np.int64)


def byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive bytes."""
    out = np.empty(max(0, len(data) - n + 1), np.uint64)
    for low in range(0, len(out), PIECE - n):
        part = data[low : low + PIECE].astype(np.uint64) + np.uint64(1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _POWERS[: len(part)], out=total[1:])
        some = min(PIECE - n, len(out) - low)
        out[low : low + some] = mixed((total[n : n + some] - total[:some]) * _INVERSE[:some])
    return out


def room(first: np.ndarray) -> np.ndarray:
    """For each word (or byte) how many there are from it to the end of its text."""
    counts = np.diff(first)
    return np.repeat(first[1:], counts) - np.arange(first[0], first[-1])


#: Bits of a filter of keys, whatever their number: a full one lets every row pass.
KEY_BITS = 1 << 26


def key_slot(key) -> F.Column:
    """Place of a key in a filter of keys."""
    return F.xxhash64(key).bitwiseAND(F.lit(KEY_BITS - 1))


def key_filter(keys: DataFrame, key: str) -> np.ndarray:
    """A bit for each key: for ``compressed``, which spares rows with other keys the shuffle."""
    slot = keys.select(key_slot(key).alias("slot"))
    words = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(KEY_BITS >> 6, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def held(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 6] >> (slot & 63) & 1).astype(bool)


def _perhaps(rows: DataFrame, keys: DataFrame, key: str) -> F.Column:
    """Whether a row's ``key`` may be in ``keys``, by a filter of these."""
    shared = rows.sparkSession.sparkContext.broadcast(key_filter(keys, key))

    def listed(slot: pa.Array) -> pa.Array:
        return pa.array(held(shared.value, slot.to_numpy()))

    return F.arrow_udf(listed, "boolean")(key_slot(key))


def among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is in ``keys`` (a written table). Of other rows only those
    whose bit a listed key has set cross the network."""
    return rows.where(_perhaps(rows, keys, key)).join(keys.select(key), key, "left_semi").select(*rows.columns)


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is not in ``keys`` (a written table).

    Rows that a filter of the keys surely lets go are read past the join, so that of whole
    texts only those cross the network whose key is listed, or whose bit another key has set.
    """
    perhaps = _perhaps(rows, keys, key)
    return rows.where(~perhaps).unionAll(rows.where(perhaps).join(keys.select(key), key, "left_anti").select(*rows.columns))


def compressed(
    rows: DataFrame, text_col: str = "text", names: tuple[str, str] = ("n_bytes", "packed"), key: str | None = None, wanted: np.ndarray | None = None
) -> DataFrame:
    """``rows`` with the text as its number of bytes and compressed bytes: what a shuffle of whole texts carries.

    The compressed bytes of a null text are null. With ``key`` and ``wanted``, a filter
    of keys, rows whose ``key`` surely isn't among them are left out.
    """
    others = [c for c in rows.columns if c != text_col]
    source, bits = rows, None
    if key is not None:
        source, bits = rows.withColumn("slot" + "_" * max(map(len, rows.columns)), key_slot(key)), rows.sparkSession.sparkContext.broadcast(wanted)

    def asked(batches):
        for batch in batches:
            yield batch if bits is None else batch.filter(pa.array(held(bits.value, batch.column(batch.num_columns - 1).to_numpy())))

    def run(batches):
        for batch, data, offsets in chunks(asked(batches), text_col):
            valid = batch.column(batch.schema.get_field_index(text_col)).is_valid().to_pylist()
            spans = zip(valid, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            packed = [pa.compress(data[a:b].tobytes(), codec="zstd", asbytes=True) if ok else None for ok, a, b in spans]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(offsets), pa.int64()), pa.array(packed, pa.binary())], names=[*others, *names])

    schema = rows.select(*others, F.lit(0).cast("long").alias(names[0]), F.lit(None).cast("binary").alias(names[1])).schema
    return source.mapInArrow(run, schema)


def unpacked(batches, names: tuple[str, str] = ("n_bytes", "packed"), limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``chunks`` of batches with compressed texts."""
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(names[0])).to_numpy()
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        first = 0
        while first < len(batch):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
            last = min(last, len(batch))
            part = batch.slice(first, last - first)
            packed = part.column(part.schema.get_field_index(names[1])).to_pylist()
            texts = [pa.decompress(z, int(n), codec="zstd", asbytes=True) for z, n in zip(packed, sizes[first:last], strict=True) if n]
            yield part, np.frombuffer(b"".join(texts), np.uint8), offsets[first : last + 1] - offsets[first]
            first = last


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a column of whole numbers, one for each row and in the order of ids, and its name.

    Ids that are unique whole numbers are their own number. Otherwise (repeated or null
    ids, ids of another type) every row counts as a document of its own, in the order of
    id (null first) and text hash, and the numbered table is written.
    """
    key = "row_number"
    while key in docs.columns:
        key += "_"
    if dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint"):
        twice = docs.groupBy(id_col).agg(F.count("*").alias("n")).where(F.col("n").__gt__(1) | F.col(id_col).isNull())
        if twice.isEmpty():
            return docs.withColumn(key, F.col(id_col).cast("long")), key
    ordered = docs.orderBy(F.col(id_col).asc_nulls_first(), F.xxhash64(text_col))
    return materialise(ordered.withColumn(key, F.monotonically_increasing_id()), "numbered"), key
