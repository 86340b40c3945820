import random

import pytest
from fixtures import LETTERS, awkward, corpus, lowered, sha, written

from spanfolio.llm import decontam
from spanfolio.llm.queries import QUERIES
from spanfolio.llm.text import numbered


def plainly(documents, items):
    words = {i: LETTERS.findall(lowered(t or "")) for i, t in items}
    out = []
    for doc_id, text, *_ in documents:
        w = LETTERS.findall(lowered(text or ""))
        hit, found = set(), set()
        for item, x in words.items():
            size = min(10, len(x))
            windows = {tuple(x[j : j + size]) for j in range(len(x) - size + 1)} if x else set()
            for i in range(len(w) - size + 1):
                if size and tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(str(item))
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_query_is_the_definition(spark, tmp_path, seed):
    documents = corpus(seed)
    r = random.Random(seed)
    items = [(100, None), (101, ""), (102, "... !"), (103, "abc"), (104, "changed")]
    for i in range(12):
        text = r.choice(documents)[1] or "nothing here"
        parts = text.split(" ")
        at, size = r.randrange(len(parts)), r.choice([2, 3, 6, 9, 10, 11, 25])
        items.append((i, " ".join(parts[at : at + size]).upper() + r.choice(["", " unseen words at the end"])))
    folder = written(spark, tmp_path / "t", documents, items)
    out = QUERIES["op3_benchmark_decontamination"](spark, folder)
    got = sorted(tuple(row[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for row in out.collect())
    assert got == plainly(documents, items)


def test_without_benchmark_or_documents(spark, tmp_path):
    folder = written(spark, tmp_path / "a", corpus(), [])
    assert QUERIES["op3_benchmark_decontamination"](spark, folder).where("contaminated").count() == 0
    folder = written(spark, tmp_path / "b", [], [(1, "a b c")])
    assert QUERIES["op3_benchmark_decontamination"](spark, folder).count() == 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(None, "two three four five six seven eight nine ten eleven"), (7, "x"), (7, "one two")], "item_id long, text string")
    rows, key = numbered(docs)
    got = decontam.hits(rows, items, key).join(rows, key).select("doc_id", rows["text"], "n_hit", "items").collect()
    assert len(got) == docs.count()
    assert {(r["n_hit"], tuple(r["items"])) for r in got if r["text"] and r["text"].startswith("one") and len(r["text"]) < 90} == {(11, ("7",))}
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["text"] or "") for r in kept.collect()) == ["", "", ""]
