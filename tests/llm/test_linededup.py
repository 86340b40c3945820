import os
import random
import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from fixtures import SCHEMA, SPACE, awkward, corpus, lowered, sha, tables_left, written

from spanfolio.llm import linededup
from spanfolio.llm.queries import QUERIES
from spanfolio.sources.workspace import materialise

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def near(a, b):
    """Levenshtein distance of at most one, by words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1] <= 1


def plainly(documents):
    seen, out = [], []
    known = set()
    for doc_id, text, *_ in documents:
        kept, n, removed = [], 0, 0
        for line in (text or "").split("\n"):
            words = SPACE.findall(lowered(line))
            n += bool(words)
            least = 5
            if len(words) < 5 and sum(map(len, words)) >= 20:
                words, least = [("character", c) for c in "".join(words)], 60
            if len(words) < 3:
                kept.append(line)
                continue
            t = tuple(words)
            if t in known or len(t) >= least and any(len(s) >= least and abs(len(s) - len(t)) < 2 and near(s, t) for s in seen):
                removed += 1
            else:
                kept.append(line)
            if t not in known:
                known.add(t)
                seen.append(t)
        out.append((doc_id, n, removed, None if text is None else sha("\n".join(kept))))
    return out


def with_lines(seed, n=70):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") * r.randint(1, 2)
    pool = [[word() for _ in range(r.randint(1, 14))] for _ in range(40)]
    rows = list(corpus(seed, 20))
    for i in range(100, 100 + n):
        lines = []
        for _ in range(r.randint(0, 9)):
            line = list(r.choice(pool)) if r.random() < 0.7 else [word() for _ in range(r.randint(0, 12))]
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                at = r.randint(0, len(line))
                action = r.random()
                if action < 0.35:
                    line.insert(at, word())
                elif at < len(line):
                    line[at : at + 1] = [] if action < 0.65 else [word()]
            lines.append(r.choice(["", " "]) + r.choice([" ", "  "]).join(line).upper() if r.random() < 0.2 else " ".join(line))
        rows.append((i, "\n".join(lines), "en", "s", 1))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_query_is_the_definition(spark, tmp_path, seed):
    documents = sorted(with_lines(seed))
    folder = written(spark, tmp_path / "t", documents)
    got = QUERIES["op4_line_dedup"](spark, folder).select("doc_id", "n_lines", "n_removed", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == plainly(documents)


def test_lines_of_few_words_by_characters(spark, tmp_path):
    r = random.Random(8)
    chinese = "".join(chr(0x4E00 + r.randrange(900)) for _ in range(160))
    url = "https://example.org/" + "".join(r.choice("abcdefghij/") for _ in range(300))
    pool = [chinese, url, "B" * 19, "é" * 20, "é" * 59, "ab cd ef " + "g" * 70, url[:59], url[:60]]
    documents = [(0, "\n".join([chinese, url, chinese, url]), "zh", "s", 1)]
    for i in range(1, 40):
        lines = []
        for _ in range(r.randint(1, 5)):
            line = list(r.choice(pool))
            for _ in range(r.choice([0, 1, 1, 2])):
                at = r.randrange(len(line))
                line[at : at + 1] = r.choice([[], ["x"], ["𝒳", line[at]], [" ", line[at]]])
            lines.append("".join(line))
        documents.append((i, "\n".join(lines), "zh", "s", 1))
    folder = written(spark, tmp_path / "t", documents)
    got = QUERIES["op4_line_dedup"](spark, folder).select("doc_id", "n_lines", "n_removed", "kept_sha256")
    want = plainly(documents)
    assert sorted(tuple(x) for x in got.collect()) == want and want[0][2] == 2


def test_one_apart():
    r = random.Random(0)
    for _ in range(3000):
        a = [r.randrange(3) for _ in range(r.randint(0, 6))]
        b = [r.randrange(3) for _ in range(r.randint(0, 6))]
        assert linededup.one_apart(np.array(a), np.array(b)) == near(a, b)


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = linededup.deduplicated(docs)
    assert set(out.columns) == {*docs.columns, "n_lines", "n_removed"} and out.count() == docs.count()
    kept = [r["text"] for r in out.collect()]
    # null id first: its line stays, the copies and the longer line go
    assert sorted(x for x in kept if x is not None) == sorted(["", "", "", "", "x", "one two three four five six seven eight nine ten eleven twelve", docs.where("doc_id = 5").first()["text"]])
    assert kept.count(None) == 2
    assert linededup.deduplicated(docs.where("false")).count() == 0


def test_lines_are_counted_without_hashes():
    r = random.Random(4)
    texts = ["".join(r.choice("ab é中 \t\n\x0b  wordx漢字字字字字字") for _ in range(r.randint(0, 300))) for _ in range(400)] + ["", "\n", "a"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    places, lines = linededup.Places(data, offsets), linededup.Lines(data, offsets)
    assert not hasattr(places, "words") and len(lines.words) == lines.first[-1]
    for name in ("begin", "end", "owner", "number", "n"):
        assert getattr(places, name).tolist() == getattr(lines, name).tolist()
    want = [(i, j) for i, t in enumerate(texts) for j, line in enumerate(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", line)]
    assert list(zip(places.owner.tolist(), places.number.tolist(), strict=True)) == want


def test_the_work_is_deleted(spark):
    docs = spark.createDataFrame(corpus(4, 60), SCHEMA)
    before = tables_left(spark)
    out = linededup.deduplicated(docs)
    assert tables_left(spark) - before == {"fewer-lines": 1}
    assert out.count() == 60 and out.collect()


def functions_in_a_task(plan):
    """The most Python functions that a task of a plan runs one behind the other."""
    most, above = 0, []
    for line in plan.splitlines():
        node = re.sub(r"^[\s:+-]*(\*\(\d+\) )?", "", line)
        depth = len(line) - len(node)
        while above and above[-1][0] >= depth:
            above.pop()
        n = 0 if re.match(r"(Broadcast)?Exchange\b", node) else (above[-1][1] if above else 0) + bool(re.match(r"MapInArrow|ArrowEvalPython", node))
        above.append((depth, n))
        most = max(most, n)
    return most


def test_no_task_holds_two_workers(spark, monkeypatch):
    """Small tables are broadcast; texts are unpacked in another task than that which packs them all the same."""
    plans = []
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def noted(df, label="table"):
        plans.append(plan_of(df))
        return materialise(df, label)

    monkeypatch.setattr(linededup, "materialise", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        documents = corpus(5, 60)
        out = linededup.deduplicated(spark.createDataFrame(documents, SCHEMA).coalesce(2))
        plans.append(plan_of(out))
        got = {r["doc_id"]: r["n_removed"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum("BroadcastHashJoin" in p for p in plans) > 1
    assert sum(got.values()) > 0 and got == {r[0]: r[2] for r in plainly(sorted(documents))}
    assert functions_in_a_task("MapInArrow a\n+- *(1) Project\n   +- MapInArrow b") == 2
    assert max(map(functions_in_a_task, plans)) == 1  # 2 before, where texts were joined with small tables


def test_lines_longer_than_a_chunk(spark, tmp_path):
    r = random.Random(6)
    words = [r.choice(("ab", "cd", "ef")) for _ in range(linededup.CHUNK_BYTES + 5)]
    letters = [chr(0x4E00 + r.randrange(900)) for _ in range(linededup.CHUNK_BYTES // 2)]
    third, last = len(words) // 3, len(letters) - 7
    lines = [
        " ".join(words),
        " ".join([*words[:third], "gh", *words[third + 1 :]]),
        " ".join([*words, "ab"]),
        " ".join(["gh", "gh", *words[2:]]),
        "".join(letters),
        "".join([*letters[:last], *letters[last + 1 :]]),
        "x".join(["", *letters[:2], "".join(letters[2:])]),
    ]
    documents = [(i, "a\n" + x + "\r\n\n", "en", "s", 1) for i, x in enumerate(lines)]
    got = QUERIES["op4_line_dedup"](spark, written(spark, tmp_path / "t", documents)).select("doc_id", "n_lines", "n_removed", "kept_sha256")
    gone = (1, 2, 5)
    assert sorted(tuple(x) for x in got.collect()) == [(i, 2, int(i in gone), sha("a\n\n" if i in gone else t)) for i, t, *_ in documents]


def test_lines_are_cut_out_of_many_texts_at_once():
    r = random.Random(7)
    for _ in range(200):
        texts = [None if r.random() < 0.1 else "".join(r.choice("ab\n\n \r中") for _ in range(r.choice([0, 1, 2, 5, 30]))) for _ in range(r.randint(1, 12))]
        raw = [(t or "").encode() for t in texts]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        split = [(t or "").split("\n") for t in texts]
        assert linededup.with_words(data, offsets).tolist() == [sum(bool(SPACE.search(x)) for x in some) for some in split]
        places = linededup.Places(data, offsets)
        at = np.array([i for i in range(len(places.n)) if r.random() < 0.5], int)
        got = linededup._cut(data, offsets, places.begin[at], places.end[at], places.owner[at], pa.array(texts, pa.string()).is_valid())
        got.validate(full=True)
        gone = set(zip(places.owner[at].tolist(), places.number[at].tolist(), strict=True))
        left = ["\n".join(x for j, x in enumerate(some) if (i, j) not in gone) for i, some in enumerate(split)]
        assert got.to_pylist() == [None if t is None else x for t, x in zip(texts, left, strict=True)]


FAULTS = """
import resource, sys
sys.path.insert(0, sys.argv[1])
import numpy as np, pyarrow as pa
from spanfolio.llm import linededup

class Rows:
    def mapInArrow(self, run, schema):
        return run

text = "\\n".join(" ".join(f"word{i * j % 997}" for j in range(9)) for i in range(40))
batch = pa.record_batch({"key": np.arange(3000), "text": [text] * 3000})
run = linededup._lines(Rows())
for _ in range(2):
    before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
    for _ in run([batch]):
        pass
print((resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before) / (3000 * len(text) / 2**20))
"""


def test_arrays_of_a_chunk_get_no_pages_of_their_own():
    """A page fetched anew for each 4 KB of each array was nearly half of the time; a worker takes the same ones again."""
    done = subprocess.run([sys.executable, "-c", FAULTS, ROOT], capture_output=True, text=True, check=True)
    assert float(done.stdout) < 1000  # pages for each MB of text


def test_texts_are_read_four_times(spark, tmp_path, monkeypatch):
    """For the lines, the lines asked for, the texts that stay and those that lose lines; not once more to count lines."""
    plans = []
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def noted(df, label="table"):
        plans.append(plan_of(df))
        return materialise(df, label)

    monkeypatch.setattr(linededup, "materialise", noted)
    docs = spark.read.parquet(f"{written(spark, tmp_path / 't', corpus(5, 60))}/documents.parquet")
    plans.append(plan_of(linededup.deduplicated(docs)))
    reads = [len(re.findall(r"FileScan parquet \[[^\]]*\btext#", p)) for p in plans]
    assert sum(reads) == 4
