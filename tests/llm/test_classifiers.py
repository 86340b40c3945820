import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import awkward, kneser_ney_plainly, tables_left, written

from spanfolio.llm import quality_crf, toxicity
from spanfolio.llm.labelled import Logistic, sample
from spanfolio.llm.queries import QUERIES


def labelled_corpus(seed=0, n=240):
    """Toxic texts use words with a few beginnings; bad ones have symbols and repeats."""
    r = random.Random(seed)
    syllables = ["ba", "to", "mi", "re", "lu", "ne", "so", "ka", "é"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    documents, labels = [], []
    for i in range(n):
        toxic, quality = int(r.random() < 0.3), int(r.random() < 0.7)
        words = [word() for _ in range(r.randint(20, 90))]
        if toxic:
            for _ in range(max(2, len(words) // 12)):
                words[r.randrange(len(words))] = r.choice(["grok", "zwil"]) + word()
        if not quality:
            words = [w + r.choice(["###", "%%%", "&&&"]) for w in words]
        documents.append((i, "".join(w + r.choice([" ", " ", " ", ".\n"]) for w in words), "en", "s", 1))
        labels.append((i, quality, toxic))
    documents += [(n, None, None, None, None), (n + 1, "", "en", "s", 0)]
    return documents, labels


@pytest.mark.parametrize(("name", "column", "threshold"), [("op1_toxicity", 2, 0.3), ("op5_quality_classifier", 1, 0.7)])
def test_held_out_accuracy(spark, tmp_path, name, column, threshold):
    documents, labels = labelled_corpus()
    folder = written(spark, tmp_path / "t", documents, labels=labels)
    rows = {r["doc_id"]: r for r in QUERIES[name](spark, folder).collect()}
    assert len(rows) == len(documents)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in rows.items())
    assert all(r["predicted"] == int(r["score"] >= threshold) for r in rows.values())
    held = [(rows[x[0]]["predicted"], x[column]) for x in labels if rows[x[0]]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.93


def test_labels_that_are_held_out_change_nothing(spark, tmp_path):
    documents, labels = labelled_corpus(1, 120)
    other = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, q, t) for i, q, t in labels]
    for name in ("op1_toxicity", "op5_quality_classifier"):
        scores = [
            {r["doc_id"]: round(r["score"], 6) for r in QUERIES[name](spark, written(spark, tmp_path / f"{name}{k}", documents, labels=x)).collect()}
            for k, x in enumerate((labels, other))
        ]
        assert scores[0] == scores[1]


def test_words_of_every_labelled_document_are_counted(spark):
    """A bound on the sample leaves the counts alone: the model is that of all documents."""
    documents, labels = labelled_corpus(2, 60)
    docs = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    few, all_of_them = (toxicity.fit(docs, known, max_rows=n).language for n in (5, 1000))
    for a, b in zip(few.grams + few.histories, all_of_them.grams + all_of_them.histories, strict=True):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_word_seen_once_is_known_among_any_number(spark):
    """Ratios are those of the whole model: a word of one toxic document counts beside many other ones."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvw") for _ in range(9))
    texts = [(i, " ".join(word() for _ in range(40)) + (" xyzzyxyz" if i == 7 else ""), int(i % 2)) for i in range(40)]
    counts = Counter()
    for _, text, label in texts:
        for w in text.split():
            padded = b" " * 5 + w.encode() + b" "
            counts.update(int.from_bytes(padded[i : i + 6]) | label << 48 for i in range(len(w) + 1))
    p = kneser_ney_plainly(counts, 6, 3)
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, x) for i, _, x in texts], "doc_id long, toxic int"))
    grams = [int.from_bytes((b" " * 5 + b"xyzzyxyz ")[i : i + 6]) for i in range(9)]
    got = {r["key"]: r["value"] for r in toxicity.ratios(model.language, spark.createDataFrame([(g,) for g in grams], "gram long")).collect()}
    want = {g: math.log(p(g | 1 << 48) / p(g)) for g in grams}
    assert all(math.isclose(got[g], want[g], rel_tol=1e-6, abs_tol=1e-6) for g in grams)
    assert sum(want.values()) > 5


def test_forward_backward_is_the_sum_over_all_labellings():
    r = np.random.default_rng(3)
    first = np.array([0, 1, 1, 5, 8])
    score, step = r.normal(size=8), r.normal(size=(2, 2))
    field = quality_crf.Field(np.zeros(1), np.ones(1), np.zeros(1), step)
    good, pairs = field.marginals(score, first)
    for text, (low, high) in enumerate(zip(first[:-1], first[1:], strict=True)):
        n = high - low
        total, one, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n if n else 0):
            y = [(code >> i) & 1 for i in range(n)]
            p = np.exp(sum(score[low + i] * y[i] for i in range(n)) + sum(step[a, b] for a, b in zip(y, y[1:])))
            total += p
            one += p * np.array(y)
            for a, b in zip(y, y[1:]):
                moves[a, b] += p
        if n:
            assert np.allclose(good[low:high], one / total) and np.allclose(pairs[text], moves / total)


def test_without_labels_and_awkward_rows(spark):
    docs = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (5, None, None), (4, 0, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        for module, label in ((toxicity, "toxic"), (quality_crf, "quality")):
            out = module.scored(docs, module.fit(docs, labels, label), name="kept")
            scores = [r["kept"] for r in out.collect()]
            assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    assert toxicity.scored(docs.where("false"), toxicity.fit(docs, none)).count() == 0
    rows = sample(docs, some, "quality", 5).collect()
    assert sorted(r["label"] for r in rows) == [0, 1, 1, 1]  # all three rows of id 1, of which the greater label counts


def test_logistic_finds_the_weights():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, 2))
    y = (r.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(int)
    fitted = Logistic(x, y, np.ones(4000))
    assert abs(fitted.beta[1] - 2) < 0.25 and abs(fitted.beta[2]) < 0.15


def test_only_the_ratios_outlive_the_model(spark, tmp_path):
    documents, labels = labelled_corpus(2, 60)
    folder = written(spark, tmp_path / "t", documents, labels=labels)
    before = tables_left(spark)
    scores = QUERIES["op1_toxicity"](spark, folder)
    assert tables_left(spark) - before == {"labels": 1, "ratios": 1}
    assert scores.count() == len(documents) and scores.collect()
