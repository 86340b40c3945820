import random

import numpy as np
import pyarrow as pa
import pytest
from fixtures import SCHEMA, SPACE, awkward, corpus, lowered, tables_left, written

from spanfolio.llm import minhash
from spanfolio.llm import text as T
from spanfolio.llm.components import components
from spanfolio.llm.queries import QUERIES
from spanfolio.llm.text import utf8


def sets_of(text):
    words = SPACE.findall(lowered(text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def roots(ids, links):
    parent = {i: i for i in ids}
    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def plainly(documents, percent=85):
    sets = {d[0]: sets_of(d[1]) for d in documents}
    links = [
        (a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = roots(list(sets), links)
    return sorted((i, len(sets[i]), root[i], root[i] == i) for i in sets)


@pytest.mark.parametrize("seed", range(2))
def test_query_is_the_definition(spark, tmp_path, seed):
    documents = corpus(seed, 90)
    r = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    for i in range(60):  # a chain of texts, each near the one before, and a group near one text
        at = r.randrange(150)
        base[at] = f"c{i}"
        documents.append((1000 + i, " ".join(base), "en", "s", 1))
        other = [f"v{j}" for j in range(120)]
        other[r.randrange(120)] = f"x{i}"
        documents.append((2000 + i, " ".join(other).upper(), "en", "s", 1))
    folder = written(spark, tmp_path / "t", documents)
    got = sorted(tuple(row) for row in QUERIES["op6_minhash_near_dedup"](spark, folder).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == plainly(documents)


def test_sketches_are_filled_and_estimate_similarity():
    r = np.random.default_rng(1)
    pool = r.integers(0, 1 << 63, 4000).astype(np.uint64)
    for n in (1, 7, 300):
        a, b = np.unique(pool[: 2 * n]), np.unique(pool[n : 3 * n])
        sketch = minhash.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert (sketch != ~np.uint64(0)).all()
        alone = minhash.sketches(a, np.array([0, len(a)]))
        assert (alone[0] == sketch[0]).all()
    near = np.array([(minhash.sketches(np.concatenate([x[:100], x[10:110]]), np.array([0, 100, 200]))) for x in (r.permutation(pool) for _ in range(40))])
    assert abs((near[:, 0] == near[:, 1]).mean() - 90 / 110) < 0.03


def test_shingles_of_whole_texts():
    texts = ["A b C d e f", "a B c d e", "x", "", None, "a b c d e f", "A  b\tc"]
    found, first = minhash.shingles(*utf8(pa.array(texts)))
    sets = [set(found[first[i] : first[i + 1]].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == [2, 1, 1, 0, 0, 2, 1]
    assert sets[0] == sets[5] and sets[1] < sets[0]


def test_components(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(1, 40)] + [(100, j) for j in range(101, 180)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)]
    frame = spark.createDataFrame([x if r.random() < 0.5 else x[::-1] for x in links], "a long, b long")
    got = {row["id"]: row["root"] for row in components(frame).collect()}
    ids = {x for link in links if link[0] != link[1] for x in link}
    assert got == roots(ids, links)


def test_awkward_rows(spark):
    docs = awkward(spark)
    kept = minhash.distinct(docs)
    assert kept.columns == docs.columns
    # the line (null id first) with its copies and its near copy is one; three rows have no words
    assert sorted(len(r["text"] or "") for r in kept.collect()) == [0, 0, 0, 1, 62, 2480]
    assert minhash.distinct(docs.where("false")).count() == 0


def test_texts_that_stay_pass_by_the_join_and_the_work_is_deleted(spark):
    docs = spark.createDataFrame(corpus(4, 60), SCHEMA)
    before = tables_left(spark)
    kept = minhash.distinct(docs)
    assert tables_left(spark) - before == {"components": 1}
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.count("Join LeftAnti") == 1 and plan.count("ArrowEvalPython") >= 2
    assert {r["doc_id"] for r in kept.collect()} == {g[0] for g in plainly(corpus(4, 60), 80) if g[3]}


@pytest.mark.parametrize("bits", [1 << 26, 64])
def test_without_is_the_anti_join(spark, monkeypatch, bits):
    monkeypatch.setattr(T, "KEY_BITS", bits)  # a full filter lets every row through to the join
    rows = spark.createDataFrame([(i, f"t{i}", [i]) for i in (*range(300), *range(20))], "k long, text string, more array<int>")
    keys = spark.createDataFrame([(i,) for i in range(0, 400, 3)], "k long")
    want = rows.join(keys, "k", "left_anti")
    got = T.without(rows, keys, "k")
    assert got.columns == rows.columns and sorted(got.collect()) == sorted(want.collect())
    assert sorted(T.without(rows, keys.where("false"), "k").collect()) == sorted(rows.collect())
    assert sorted(T.among(rows, keys, "k").collect()) == sorted(rows.join(keys, "k", "left_semi").collect())
