"""Values by key, and grams of many texts, against their plain definitions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from spanfolio.llm import gathered, perplexity
from spanfolio.llm import text as T


def test_values_by_key():
    rng = np.random.default_rng(0)
    keys = np.unique(np.concatenate([rng.integers(-(2**62), 2**62, 20_000), np.arange(3000) << 40]))
    keys = np.concatenate([keys, keys[:5]])  # a chunk that is there twice
    values = rng.random(len(keys)).astype(np.float32)
    values[-5:] = values[:5]
    found = gathered.Values(keys, values)
    asked = rng.integers(0, len(keys), 50_000)
    assert np.array_equal(found(keys[asked]), values[asked])
    assert len(gathered.Values(keys[:0], values[:0])(keys[:0])) == 0
    for some in (found, gathered.Values(keys[:0], values[:0])):
        with pytest.raises(ValueError):
            some(np.array([2**61 + 7]))


def test_distinct_and_classes():
    keys = np.random.default_rng(1).integers(0, 50, 400)
    at, which = T.classes(keys)
    assert np.array_equal(keys[at][which], keys) and np.array_equal(keys[at], np.unique(keys))
    assert np.array_equal(T.distinct(keys), np.unique(keys)) and len(T.distinct(keys[:0])) == len(T.classes(keys[:0])[0]) == 0


def test_grams_of_texts():
    r = random.Random(2)
    for _ in range(300):
        texts = ["".join(r.choice("ab  \né") for _ in range(r.randint(0, r.choice([3, 6, 60])))) for _ in range(r.randint(1, 6))]
        batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)), pa.int64())], names=["text", "language"])
        want = []
        for i, text in enumerate(texts):
            stream = b"".join(b" " + w for w in text.encode().split())
            want += [(int.from_bytes(stream[j : j + 5], "big") | i + 1 << 48, i) for j in range(len(stream) - 4)]
        data, offsets = T.utf8(batch.column("text"))
        gram, owner = perplexity._grams(batch, data, offsets, np.arange(len(texts)))
        assert list(zip(gram.tolist(), owner.tolist(), strict=True)) == want
