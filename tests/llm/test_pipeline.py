import corpus_pipeline
import public_tokenizers
import tiktoken
from fixtures import SCHEMA, awkward, written
from test_classifiers import labelled_corpus
from test_decontam import plainly as contaminated
from test_linededup import plainly as lines_left
from test_minhash import plainly as groups

from spanfolio.llm import bpe
from spanfolio.llm.queries import vocabulary
from fixtures import sha


def test_stages_against_brute_force(spark, tmp_path):
    documents, labels = labelled_corpus(3, 150)
    good = [d for d, x in zip(documents, labels) if x[1]]
    documents += [(1000 + i, d[1], *d[2:]) for i, d in enumerate(good[:10])]  # copies
    documents += [(1100 + i, (d[1] or "").replace(" ba", " ", 1), *d[2:]) for i, d in enumerate(good[10:20])]
    items = [(1, " ".join(good[20][1].split()[:14])), (2, "not in any text at all")]
    folder = written(spark, tmp_path / "t", documents, items, labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    first = stages["quality_classifier"](spark, docs, folder)
    assert first.columns == docs.columns
    kept = {r["doc_id"] for r in first.collect()}
    assert sum((i in kept) == bool(q) for i, q, _ in labels) > 0.93 * len(labels)
    rows = sorted(tuple(r) for r in docs.collect())
    second = stages["line_dedup"](spark, docs, folder)
    assert second.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in second.collect()}
    want = {r[0]: r for r in lines_left(rows)}
    assert all(want[i][3] == (None if t is None else sha(t)) for i, t in texts.items())
    assert all(want[i][2] for i in set(want) - set(texts))
    third = stages["minhash_near_dedup"](spark, docs, folder)
    assert {r["doc_id"] for r in third.collect()} == {g[0] for g in groups(rows, 80) if g[3]}
    fourth = stages["benchmark_decontamination"](spark, docs, folder)
    assert {r["doc_id"] for r in fourth.collect()} == {c[0] for c in contaminated(rows, items) if not c[5]}
    out = corpus_pipeline.run(spark, folder)
    assert set(docs.columns) < set(out.columns) and out.where("not round_trip").isEmpty()
    assert 0 < out.count() < len(documents)


def test_awkward_rows(spark, tmp_path):
    folder = written(spark, tmp_path / "t", [], [(1, "one two three"), (None, None)], [(1, 1, 0), (4, 0, 1)])
    for docs in (awkward(spark), awkward(spark).where("false"), spark.createDataFrame([], SCHEMA)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, folder).columns == docs.columns, name
            assert stage(spark, docs, folder).count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_ids_are_those_of_the_library(spark):
    path, pattern = vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = ["", None, "  a   b \n\n c\t d", "don't we'll 'S x y　z", "a" * 5000, "\n\n", "é\U0001f600 \x00\x1c q", "12 345  6", "hello\n world\n", "<|endoftext|>"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for row in bpe.encoded(docs, path, pattern).collect():
        assert row["token_ids"] == library.encode_ordinary(row["text"] or "") and row["n_tokens"] == len(row["token_ids"])
        assert bytes(row["decoded"]).decode() == (row["text"] or "")
    ids = bpe.encoded(docs, path, pattern).select("doc_id", "token_ids")
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decoded(ids, path).collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert public_tokenizers.PATTERN == pattern


def test_merges_follow_the_lowest_rank():
    # after "bc" a pair of lower rank than the one waiting appears
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"ab": 310, b"cd": 290, b"abcd": 295, b"bcd": 320}
    library = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    merges = bpe.Merges(ranks)
    for text in ("abcdabcd", "abcabcd", "ababcdab", "bcdabcd", "cdcdab"):
        assert merges.encode([text])[text] == library.encode_ordinary(text)
