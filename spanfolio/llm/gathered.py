"""Values of a table of any size, brought to the chunks of documents that ask for them.

Documents travel in chunks of many megabytes, compressed. A chunk asks for each distinct
key once, a join finds the values, and chunk and values meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spanfolio.llm import text as T

#: Bytes of text of a chunk, one document at least.
CHUNK_BYTES = 1 << 24
#: Of compression: texts are most of what crosses the network.
LEVEL = 7



class Values:
    """Values by key, in an open table: a key stands in the first free slot from its own on."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(62 - max(len(keys), 1).bit_length())
        self.mask = (1 << (64 - int(self.shift))) - 1
        self.at = np.full(self.mask + 1, -1, np.int32)
        self.keys, self.values = keys, values
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(left):
            free = self.at[slot] < 0
            self.at[slot[free]] = left[free]
            # equal keys count once
            more = keys[self.at[slot]] != keys[left]
            left, slot = left[more], (slot[more] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(T.MULTIPLIER) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key."""
        slot = self._slot(keys)
        at = self.at[slot]
        left = np.flatnonzero((self.keys[at] != keys) if len(self.keys) else np.ones(len(keys), bool))
        slot = slot[left]
        while len(left):
            if (at[left] < 0).any():
                raise ValueError("the documents were not the same when they were read again")
            slot = (slot + 1) & self.mask
            at[left] = found = self.at[slot]
            more = (found < 0) | (self.keys[found] != keys[left])
            left, slot = left[more], slot[more]
        return self.values[at]


Piece = tuple[pa.RecordBatch, np.ndarray, np.ndarray]


def _written(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))) as out:
        out.write_table(pa.Table.from_batches(parts).combine_chunks())
    packed = sink.getvalue().to_pybytes()
    name = int.from_bytes(hashlib.blake2b(packed, digest_size=8).digest(), signed=True)
    return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([packed], pa.binary())], names=["chunk", "packed"])


def _read(packed: bytes, text_col: str) -> Iterator[Piece]:
    with pa.ipc.open_stream(packed) as stream:
        yield from T.chunks(stream, text_col)


def gathered(docs: DataFrame, text_col: str, asked: Callable[[Piece], np.ndarray], values: DataFrame, used: Callable[..., pa.RecordBatch], schema) -> DataFrame:
    """``used(piece, values)`` for pieces of ``docs``; ``values`` are the ``Values`` of the chunk's keys.

    ``values`` (``key``, ``value``) has each key once, and every key that ``asked`` tells of a piece.
    """

    def pack(batches):
        parts, held = [], 0
        for batch, data, _ in T.chunks(batches, text_col, CHUNK_BYTES):
            if parts and held + len(data) > CHUNK_BYTES:
                yield _written(parts)
                parts, held = [], 0
            parts.append(batch)
            held += len(data)
        if parts:
            yield _written(parts)

    def ask(batches):
        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("packed"), strict=True):
                found = T.distinct(np.concatenate([np.zeros(0, np.int64), *map(asked, _read(packed.as_buffer(), text_col))]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), chunk, np.int64)), pa.array(found)], names=["chunk", "key"])

    def meet(chunk, found):
        values = Values(*(found.column(c).to_numpy() for c in ("key", "value")))
        return pa.Table.from_batches([used(piece, values) for packed in chunk.column("packed") for piece in _read(packed.as_buffer(), text_col)])

    # both branches read one exchange; texts cross the network once
    chunks = docs.mapInArrow(pack, "chunk long, packed binary").repartition("chunk")
    wanted = chunks.mapInArrow(ask, "chunk long, key long").join(values.select("key", "value"), "key").select("chunk", "key", "value")
    return chunks.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(meet, schema)
