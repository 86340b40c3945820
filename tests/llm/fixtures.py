"""Small tables with every awkward case, and the definitions written plainly."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

from spanfolio.llm import kneser_ney
from spanfolio.sources.workspace import run_folder

SPACE = re.compile("[^\x20\x09-\x0d]+")
LETTERS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def corpus(seed=0, n=60, vocabulary=40, longest=160):
    """Rows of documents: copies, near copies, shared passages, junk, empty and null texts."""
    r = random.Random(seed)
    word = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(vocabulary)]
    prose = lambda k: " ".join(r.choice(word) + r.choice(["", "", "", ",", ".\n", "\t"]) for _ in range(k))
    passages = [prose(r.randint(5, 60)) for _ in range(4)]
    rows = []
    for i in range(n):
        kind = r.random()
        if kind < 0.25 and rows:
            text = r.choice(rows)[1] or ""
            if kind < 0.15 and text:
                parts = text.split(" ")
                parts[r.randrange(len(parts))] = "changed"
                text = " ".join(parts)
        elif kind < 0.55:
            text = prose(r.randint(0, longest)) + " " + r.choice(passages) + " " + prose(r.randint(0, 30))
        elif kind < 0.65:
            text = " ".join([r.choice(word)] * r.randint(1, 90))
        else:
            text = prose(r.randint(0, longest))
        rows.append((i, text, "en", "src0", len(text)))
    rows[3] = (3, None, None, None, None)
    rows[5] = (5, "", "en", "src1", 0)
    rows[7] = (7, " \n\t ", "en", "src1", 4)
    rows[9] = (9, " ".join(passages * 12), "en", "src0", 1)
    r.shuffle(rows)
    return rows


def tables_left(spark):
    """How many written tables of each label there are."""
    folder = run_folder(spark)
    return Counter(name.rsplit("-", 1)[0] for name in (os.listdir(folder) if os.path.isdir(folder) else []))


def written(spark, folder, documents, benchmark=None, labels=None):
    """A folder of tables as the queries read them."""
    spark.createDataFrame(documents, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark or [], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels or [], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def awkward(spark):
    """Rows with null and repeated ids, null texts, ties and columns whose names clash with the operators'."""
    names = "doc_id long, text string, lang string, source string, n_chars long, row_number string, key int, n_words string, spans string, kept string"
    extra = ("x", 1, "y", None, "z")
    line = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, line), (1, line), (1, line + " more"), (None, line), (None, None), (2, None), (3, ""), (4, "x"), (5, line * 40)]
    return spark.createDataFrame([(i, t, None, "s", None, *extra) for i, t in rows], names)


def kneser_ney_plainly(grams, order, shared=0):
    """P(gram) of packed grams by the formula, from a Counter of grams of ``order`` bytes."""
    group = ~((1 << 48) - 1)
    lower = lambda g, n: g & ((group if n > shared else group << 1) | (1 << 8 * n) - 1)
    history = lambda g: (g & group) | (g & ~group) >> 8
    counts = {order: grams}
    for n in range(order - 1, 0, -1):
        before = {(lower(g, n), g >> 8 * n & 255) for g in counts[n + 1]}
        counts[n] = Counter(g for g, _ in before)
    after = {n: defaultdict(list) for n in counts}
    of = {n: defaultdict(list) for n in counts}
    for n, c in counts.items():
        for g, times in c.items():
            after[n][history(g)].append(times)
            of[n][g >> 48].append(times)
    less = {(n, g): [0.0, *kneser_ney.discounts(*(sum(t == i for t in times) for i in (1, 2, 3, 4)))] for n in of for g, times in of[n].items()}

    def p(g, n=order):
        if n == 0:
            return 1 / 256
        g = lower(g, n)
        under = p(g, n - 1)
        times = after[n].get(history(g))
        if not times:
            return under
        d, own = less[n, g >> 48], counts[n].get(g, 0)
        return (own - d[min(own, 3)] + sum(d[min(t, 3)] for t in times) * under) / sum(times)

    return p
