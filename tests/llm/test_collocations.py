"""Phrases and their scores against plain counting, and the index against plain counts."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from fixtures import awkward, corpus, lowered

from spanfolio.llm import collocations as C

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least, top):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        chosen = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        held = {part for g, a in chosen.items() for k in range(2, len(g)) for i in range(len(g) - k + 1) if 100 * a >= 80 * counts[part := g[i : i + k]]}
        scored = []
        for g, a in chosen.items():
            score, k = min((2_000_000 * a // (counts[g[:k]] + counts[g[k:]]), k) for k in range(1, len(g)))
            if g not in held:
                scored.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


@pytest.mark.parametrize("seed,least,top", [(0, 3, 2000), (1, 2, 25), (2, 30, 2000)])
def test_against_plain_counts(spark, monkeypatch, seed, least, top):
    monkeypatch.setattr(C, "SHARD_BYTES", 5000)
    r = random.Random(seed)
    rows = [(t, r.choice(["en", "de", None, "und"])) for _, t, *_ in corpus(seed, 80, 15)]
    rows += [("A b C d. a B c D e\ta b", "en"), ("x x x x x x, x x", "en"), ("", "fr"), (None, "fr"), (" ,. ", None)] + [("über naïve Σ中 über naïve", "el")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert result(C.collocations(docs, least=least, top=top)) == plain(rows, least, top)


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark).selectExpr("*", "'x' as shard", "1 as a")
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    out = C.collocations(docs, least=2)
    assert result(out) == plain(rows, 2, 2000) and out.columns == COLUMNS
    assert {t for c, t in out.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert C.collocations(docs.where("false")).count() == 0
    assert C.collocations(spark.createDataFrame([("a b c", "en")], "text string, lang string")).count() == 0


def test_a_very_long_text(spark):
    r = random.Random(3)
    rows = [(" ".join(r.choice(["one", "two", "three", "four,", "five"]) for _ in range(200_000)), "en")]
    assert result(C.collocations(spark.createDataFrame(rows, "text string, lang string"))) == plain(rows, 30, 2000)


@pytest.mark.parametrize("n", [2, 3, 4])
def test_index_lists_every_phrase_with_its_count(n):
    r = random.Random(n)
    for symbols in (1, 2, 5):
        seq = [0] + [r.randint(0, symbols) for _ in range(300)] + [0]
        want = Counter(g for i in range(len(seq) - n + 1) if 0 not in (g := tuple(seq[i : i + n])))
        words, count = C.phrases(np.array(seq), n, lambda rows: np.ones(len(rows), bool))
        assert dict(zip(map(tuple, words.tolist()), count.tolist(), strict=True)) == want


def test_memory_beside_the_index_is_bounded():
    r = np.random.default_rng(0)
    seq = np.minimum(r.zipf(1.3, 300_000), 20_000)
    seq[r.random(len(seq)) < 0.1] = 0
    seq[[0, -1]] = 0
    tracemalloc.start()
    found = sum(int(count.sum()) for _, count in C.grown(seq, 2, None))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == int(((seq[1:] > 0) & (seq[:-1] > 0)).sum())
    assert peak < 40 * len(seq)  # all pairs at once took 51 bytes a symbol
