import dataclasses
import random

import numpy as np
import pyarrow as pa
import pytest
from fixtures import SPACE, awkward, corpus, sha, written

from spanfolio.llm import repeats, substring, suffix
from spanfolio.llm import text as T
from spanfolio.llm.queries import QUERIES
from spanfolio.llm.text import numbered


def plainly(sequences, length):
    """For each sequence which symbols lie in a window that starts earlier."""
    seen, out = set(), []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            window = bytes(s[i : i + length]) if isinstance(s, bytes) else tuple(s[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        out.append(gone)
    return out


def repeating(seed):
    documents = corpus(seed, 80)
    r = random.Random(seed)
    low = [(500 + i, "".join(r.choice("ab") for _ in range(r.randint(90, 400))), "en", "s", 1) for i in range(8)]
    even = [(600, "ab" * 300, "en", "s", 1), (601, "x" * 500, "en", "s", 1), (602, "a b " * 200, "en", "s", 1), (603, "ab" * 60 + "é" * 120, "en", "s", 1)]
    return documents + low + even


@pytest.mark.parametrize("seed", range(2))
def test_bytes_are_the_definition(spark, tmp_path, seed):
    documents = sorted(repeating(seed))
    folder = written(spark, tmp_path / "t", documents)
    raw = [(d[1] or "").encode() for d in documents]
    want = []
    for d, s, gone in zip(documents, raw, plainly(raw, 100), strict=True):
        spans = sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        want.append((d[0], len(s), sum(gone), spans, sha(bytes(b for b, g in zip(s, gone, strict=True) if not g))))
    got = QUERIES["op2_suffix_array_dedup"](spark, folder).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("seed", range(2))
def test_words_are_the_definition(spark, tmp_path, seed):
    documents = sorted(repeating(seed))
    folder = written(spark, tmp_path / "t", documents)
    raw = [SPACE.findall(d[1] or "") for d in documents]
    want = [
        (d[0], len(s), sum(gone), sha(" ".join(w for w, g in zip(s, gone, strict=True) if not g)))
        for d, s, gone in zip(documents, raw, plainly(raw, 20), strict=True)
    ]
    got = QUERIES["op9_substring_dedup"](spark, folder).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == want


def test_longest_previous_factors():
    r = random.Random(3)
    for size, letters in ((200, b"ab"), (300, b"abcd"), (150, b"a")):
        s = bytes(r.choice(letters) for _ in range(size))
        depth = 13
        starts = np.arange(size - depth + 1)
        got = suffix.longest_previous(np.frombuffer(s, np.uint8), starts, depth)
        common = lambda i, j: next((k for k in range(depth) if s[i + k] != s[j + k]), depth)
        assert got.tolist() == [max((common(i, j) for j in range(i)), default=0) for i in starts.tolist()]
        new = suffix._new(np.frombuffer(s, np.uint8), depth, starts)
        assert new.tolist() == np.flatnonzero(got < depth).tolist()


def test_hashes_across_pieces(monkeypatch):
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    whole = T.byte_grams(data, 7)
    starts = np.arange(0, 4900, 3)
    spans = T.span_hashes(data, starts, starts + 50)
    monkeypatch.setattr(T, "PIECE", 64)
    assert (T.byte_grams(data, 7) == whole).all()
    assert (T.span_hashes(data, starts, starts + 50) == spans).all()
    assert T.span_hashes(data, np.array([0, 10]), np.array([4000, 4100]))[0] == T.span_hashes(data[:4000], np.array([0]), np.array([4000]))[0]


def test_awkward_rows_and_runs(spark):
    rows, key = numbered(awkward(spark))
    for module, column in ((substring, "n_words"), (suffix, "n_bytes")):
        out = module.deduplicated(rows, key)
        assert out.count() == rows.count()
        assert module.deduplicated(rows.where("false"), key).count() == 0
        assert out.where("n_removed > 0").count() > 0 and column in out.columns
    long = substring.deduplicated(rows, key).where("n_words > 400").first()  # a period of 11 words, and another last one
    assert [(x["start"], x["end"]) for x in long["runs"]] == [(12, 440)] and len(long["kept"].split()) == 13


def test_marks_of_shared_anchors(monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 5)
    r = random.Random(4)
    for trial in range(200):
        sizes = [r.choice([1, 1, 2, 3, 5, 6, 9, 14]) for _ in range(r.randint(1, 8))]
        anchors = np.repeat(np.arange(len(sizes)), sizes)
        keys, places = np.arange(len(anchors)), np.arange(len(anchors)) * 256 + 1
        cuts = sorted({0, len(anchors), *(r.randrange(len(anchors) + 1) for _ in range(r.randint(0, 6)))})
        batches = [
            pa.RecordBatch.from_arrays([pa.array(x[a:b]) for x in (anchors, keys, places)], names=["anchor", "key", "place"])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        got = {}
        for batch in repeats._marked(iter(batches)):
            for key, block in zip(batch["key"].to_pylist(), batch["block"].to_pylist(), strict=True):
                assert key not in got and block >> 2 == key * 256 + 1
                got[key] = block & 3
        assert len(got) == len(anchors)
        for i, (size, low) in enumerate(zip(sizes, np.cumsum([0, *sizes]).tolist())):
            marks = {got[k] for k in range(low, low + size)}
            allowed = {repeats.MANY} if size > 5 or i in (0, len(sizes) - 1) else {repeats.ALONE if size == 1 else repeats.FEW}
            # after an anchor of many blocks at the front the next one may count as many, too
            assert marks <= allowed | ({repeats.MANY} if i == 1 else set()) and len(marks) == 1, (sizes, i, marks)


def test_few_and_many_give_the_same(spark):
    texts = [d[1] or "" for d in sorted(repeating(5))]
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, text string").coalesce(1)
    by_text, by_hash = suffix.rule(60, 12), dataclasses.replace(suffix.rule(60, 12), contexts=None)
    want = plainly([t.encode() for t in texts], 60)
    for rule in (by_text, by_hash):
        got = {}

        def run(batches, rule=rule):
            for batch, data, offsets in T.unpacked(batches):
                gone = repeats.removed(batch, offsets, rule)
                for key, low, high in zip(batch["key"].to_pylist(), offsets[:-1], offsets[1:], strict=True):
                    yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([gone[low:high].tolist()], pa.list_(pa.bool_()))], names=["key", "gone"])

        for row in repeats.marked(rows, rule).mapInArrow(run, "key long, gone array<boolean>").collect():
            got[row["key"]] = row["gone"]
        assert [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("length", [300, 400, 700])
def test_strings_longer_than_a_block_number(spark, length):
    r = random.Random(length)
    shared = ["".join(r.choice("abcdefgh ") for _ in range(1300)) for _ in range(2)]
    own = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    texts = [own(900) + shared[0] + own(50), own(2000), shared[0][200:1000] + own(700), own(300) + shared[1], shared[1] + shared[0], "ab" * 900]
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, text string").repartition(3)
    want = [sum(gone) for gone in plainly([t.encode() for t in texts], length)]
    got = {x["key"]: x["n_removed"] for x in suffix.deduplicated(rows, "key", length=length).collect()}
    assert [got[i] for i in range(len(texts))] == want
    words = [" ".join(t.replace(" ", "")) for t in texts]  # every letter a word
    rows = spark.createDataFrame(list(enumerate(words)), "key long, text string").repartition(3)
    want = [sum(gone) for gone in plainly([SPACE.findall(t) for t in words], length)]
    got = {x["key"]: x["n_removed"] for x in substring.deduplicated(rows, "key", words=length).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_strings_shorter_than_their_anchors_are_refused(spark):
    rows = spark.createDataFrame([(1, "a")], "key long, text string")
    with pytest.raises(ValueError):
        substring.deduplicated(rows, "key", words=3)
