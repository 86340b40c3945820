"""Byte-level BPE on flat arrays against the tokenizer library."""

import random

import pytest
import tiktoken
from fixtures import sha

from spanfolio.llm import bpe
from spanfolio.llm.queries import vocabulary

POOL = "abcdeé 's'ld!?.\n\t\r 12 中🙂\x85​　   xyzthe"


@pytest.fixture(scope="module")
def library():
    path, pattern = vocabulary()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def test_rounds_and_replay_give_the_same(library):
    r = random.Random(3)
    merges = bpe.merges_of(vocabulary()[0])
    words = [bytes(r.choice(b"etaoin shrdlu,.\xc3\xa9") for _ in range(r.randint(1, bpe.SHORT + 9))) for _ in range(3000)] + [b"a" * bpe.SHORT]
    a, b = merges.rounds(words), merges.replay(words)
    assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"ab": 310, b"cd": 290, b"abcd": 295, b"bcd": 320}
    for text in (b"abcdabcd", b"abcabcd", b"ababcdab", b"bcdabcd"):
        assert bpe.Merges(ranks).rounds([text])[0].tolist() == bpe.Merges(ranks).replay([text])[0].tolist()
    assert merges.rounds([])[1].tolist() == [0]


@pytest.mark.parametrize("bound", [0, 7, 1 << 19])
def test_words_are_remembered_up_to_a_bound(library, monkeypatch, bound):
    monkeypatch.setattr(bpe, "REMEMBERED", bound)
    path, pattern = vocabulary()
    encoder = bpe.Encoder(bpe.merges_of(path), pattern)
    r = random.Random(1)
    texts = ["", " ", "a ", " a", "\n", "a\n", "a\n\n", "'s 's", "x" * 300 + " don't 's\n"]
    texts += ["".join(r.choice(POOL) for _ in range(r.randint(0, 40))) for _ in range(900)]
    texts += [" ".join("".join(r.choice("abet") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 9))) for _ in range(900)]
    asked = []
    flat = encoder.merges.flat
    monkeypatch.setattr(encoder.merges, "flat", lambda pieces: asked.extend(pieces) or flat(pieces))
    for _ in range(2):
        for low in range(0, len(texts), 100):
            ids, offsets = encoder(part := texts[low : low + 100])
            assert len(encoder.words) <= bound
            assert [ids[a:b].to_pylist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [library.encode_ordinary(t) for t in part]
        if bound > len(texts):
            asked, remembered = [], set(encoder.words.to_pylist())
    if bound > len(texts):  # the second time nothing but heads and texts that can't be cut
        assert not {" " + w for w in remembered if len(w) > 3 and w.isalpha()} & set(asked)


def test_parts_of_one_text_each(spark, library):
    path, pattern = vocabulary()
    texts = ["the cat, the hat", None, "", "  two  blanks ", "the cat, the hat"] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    for row in bpe.encoded(docs, path, pattern, batch_chars=1).collect():
        assert row["token_ids"] == library.encode_ordinary(texts[row["doc_id"]] or "") and bytes(row["decoded"]).decode() == (row["text"] or "")
    for row in bpe.encoded(docs, path, pattern, digest=True, batch_chars=1).collect():
        ids = library.encode_ordinary(texts[row["doc_id"]] or "")
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(row["text"] or ""))
    assert bpe.encoded(docs.where("false"), path, pattern, digest=True).count() == 0
