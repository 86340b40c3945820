import math
import os
import random
from collections import Counter

import numpy as np
from fixtures import SPACE, awkward, corpus, kneser_ney_plainly, written

from spanfolio.llm import kneser_ney, perplexity
from spanfolio.llm.queries import QUERIES
from spanfolio.llm.text import numbered
from spanfolio.sources.workspace import run_folder


def plainly(text):
    words = SPACE.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_query_is_the_definition(spark, tmp_path):
    documents = corpus(4)
    documents[0] = (documents[0][0], "#a <b>\n#a <b>\n\n é|é  \n#a <b> \n" + "x y z " * 30, "de", "s", 1)
    folder = written(spark, tmp_path / "t", documents)
    texts = {d[0]: d[1] or "" for d in documents}
    rows = QUERIES["op10_quality_rules"](spark, folder).collect()
    assert len(rows) == len(documents)
    for r in rows:
        want = plainly(texts[r["doc_id"]])
        assert tuple(r[c] for c in perplexity.RULES) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])


TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog and the hat " * 2]


def counted(texts, order):
    return Counter(int.from_bytes(t.encode()[i : i + order]) | g << 48 for g, t in enumerate(texts) for i in range(len(t.encode()) - order + 1))


def probabilities(spark, grams, asked, shared=0):
    table = spark.createDataFrame(list(grams.items()), "gram long, c long")
    wanted = spark.createDataFrame([(x,) for x in asked], "gram long")
    got = {r["gram"]: r["p"] for r in kneser_ney.probabilities(kneser_ney.levels(table, 3, shared), wanted).collect()}
    return [got[x] for x in asked]


def test_model_is_the_formula(spark):
    for texts, shared in (([" ".join(TEXTS)], 0), (TEXTS, 0), (TEXTS, 2)):
        grams = counted(texts, 3)
        asked = [*grams, *(int.from_bytes(x.encode()) | g << 48 for g in range(len(texts)) for x in ("zzz", "thq", "dxq", "at "))]
        asked = list(dict.fromkeys(asked))
        p = kneser_ney_plainly(grams, 3, shared)
        assert np.allclose(probabilities(spark, grams, asked, shared), [p(g) for g in asked], rtol=1e-6)


def test_own_probabilities_are_those_of_the_tables(spark):
    grams = counted(TEXTS, 3)
    table = spark.createDataFrame(list(grams.items()), "gram long, c long")
    got = {r["gram"]: r["p"] for r in kneser_ney.own(table, 3).collect()}
    assert got.keys() == grams.keys()
    p = kneser_ney_plainly(grams, 3, 0)
    assert np.allclose([got[g] for g in grams], [p(g) for g in grams], rtol=1e-6)


def test_model_sums_to_one(spark):
    asked = [int.from_bytes(history + bytes([i])) for history in (b"th", b"qq", b"a ") for i in range(256)]
    sums = np.reshape(probabilities(spark, counted([" ".join(TEXTS)], 3), asked), (3, 256)).sum(1)
    assert np.allclose(sums, 1, rtol=1e-4)


def test_losses_take_every_gram(spark):
    """Each loss is that of the whole model."""
    text = "the cat sat on the mat and the dog sat on the log"
    docs = [(i, text + f" number {i}", "en") for i in range(9)] + [(9, "ein hund und eine katze", "de"), (10, "abc", "de"), (11, "un gat i un gos", "ca"), (12, "kissa ja koira", "fi"), (13, "no name", ""), (14, "none at all", None)]
    got = {r["row_number"]: r["log_loss"] for r in perplexity.judged(numbered(spark.createDataFrame(docs, "doc_id long, text string, lang string"))[0], "row_number").collect()}
    group = {lang: i for i, lang in enumerate(dict.fromkeys(d[2] for d in docs))}
    packed = {i: [int.from_bytes(f" {t}".encode()[j : j + 5]) | group[lang] << 48 for j in range(len(t) + 1 - 4)] for i, t, lang in docs}
    p = kneser_ney_plainly(Counter(g for x in packed.values() for g in x), 5)
    for i, grams in packed.items():
        want = -np.log([p(g) for g in grams]).mean() if grams else None
        assert got[i] is None if want is None else math.isclose(got[i], want, rel_tol=1e-5)


def test_odd_texts_leave_the_band(spark):
    fine = [(i, " ".join(f"word{(i * j) % 7} goes" for j in range(40)), "en") for i in range(60)]
    odd = [(100, " ".join(chr(33 + (7 * j) % 90) * 3 for j in range(60)), "en")]
    rows, key = numbered(spark.createDataFrame(fine + odd, "doc_id long, text string, lang string"))
    got = {r[key]: r["kept"] for r in perplexity.judged(rows, key).collect()}
    assert got[100] is False


def test_verdict_is_the_band(spark, monkeypatch):
    """The band from sorted losses, its own constants, also where languages share the model of the rest."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(200)]
    docs = [(i, " ".join(r.choice(words) if r.random() > 0.02 * (i % 9) else chr(200 + r.randrange(90)) * 4 for _ in range(r.randint(2, 90))), r.choice(["en", "de", "", None])) for i in range(240)]
    rows, key = numbered(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    for models in (1 << 15, 2):
        monkeypatch.setattr(perplexity, "MODELS", models)
        got = {x[key]: x for x in perplexity.judged(rows, key).collect()}
        verdicts = set()
        for lang in {d[2] for d in docs}:
            mine = [got[d[0]] for d in docs if d[2] == lang]
            losses = sorted(x["log_loss"] for x in mine if x["log_loss"] is not None)
            q1, q2, q3 = (losses[math.ceil(len(losses) * p) - 1] for p in (0.25, 0.5, 0.75))
            for x in mine:
                wider = 4 * (1 + 10 / math.sqrt(max(x["n_words"], 1)))
                low, high = q2 - wider * (q2 - q1), q2 + wider * (q3 - q2)
                failed = x["n_words"] < 50 or 100 * x["n_repeat_words"] > 50 * x["n_words"]
                assert math.isclose(x["lower"], low, rel_tol=1e-9) and math.isclose(x["upper"], high, rel_tol=1e-9)
                assert x["kept"] == (not failed and (x["log_loss"] is None or x["lower"] <= x["log_loss"] <= x["upper"]))
                verdicts.add(x["kept"])
        assert verdicts == {True, False}


def test_awkward_rows(spark):
    rows, key = numbered(awkward(spark))
    assert perplexity.judged(rows, key).count() == rows.count()
    assert perplexity.judged(rows.where("false"), key).count() == 0


def test_only_the_model_stays_on_disk(spark):
    folder = run_folder(spark)
    there = lambda: Counter(name.rsplit("-", 1)[0] for name in (os.listdir(folder) if os.path.isdir(folder) else []))
    before = there()
    counts = spark.createDataFrame([(int.from_bytes(b"abcab"[i : i + 3], "big"), i + 1) for i in range(3)], "gram long, c long")
    model = kneser_ney.levels(counts, 3)
    assert there() - before == Counter({"shares": 3, "left": 3})
    assert all(t.columns == ["h", "left"] for t in model.histories)
