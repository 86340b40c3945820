"""Encoding by batched merge rounds against the tokenizer library."""

import random

import public_tokenizers
import pytest
from fixtures import awkward, sha, written
from tokenizers import Tokenizer

from spanfolio.llm import queries, word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
POOL = "abcdeé ΣΑς'’st'dlrvem0123456789!?<|startoftext|> \n\t́가İıſK中文🙂ẞ​\x1c\x85ȺꟋᲉ꟱"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def own(vocabulary, texts):
    words = [word_bpe.WORDS.findall(t) for t in texts]
    ids = vocabulary.encode(set().union(*words))
    return [[i for w in found for i in ids[w]] for found in words]


def test_random_texts(library):
    r = random.Random(5)
    texts = ["".join(r.choice(POOL) for _ in range(r.randint(0, 70))) for _ in range(3000)]
    texts += [t[:9] + "<|endoftext|>" + t[9:] for t in texts[:200]]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own(word_bpe.vocabulary_of(PATH), texts) == want


def test_every_character_of_the_first_planes(library):
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"a1{chr(c)}b!{chr(c)}" for c in points]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [hex(c) for c, a, b in zip(points, own(word_bpe.vocabulary_of(PATH), texts), want, strict=True) if a != b] == []


@pytest.mark.parametrize("letters", ["ab", "a", "the", "abcdefghijklmnopqrstuvwxyz", "ae", "é中"])
def test_very_long_words(library, letters):
    r = random.Random(2)
    for text in (letters * (200_000 // len(letters)), "".join(r.choice(letters) for _ in range(100_001))):
        assert own(word_bpe.vocabulary_of(PATH), [text]) == [library.encode(text, add_special_tokens=False).ids]


def test_query_against_the_library(spark, tmp_path, library):
    r = random.Random(9)
    texts = ["".join(r.choice(POOL) for _ in range(r.randint(0, 200))) for _ in range(60)]
    texts += [None, "", " \n ", "\x85", "Hello <|endoftext|>World's  END", "x " * 400_000, texts[0], texts[0]]
    folder = written(spark, tmp_path, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    got = {x["doc_id"]: x for x in queries.op11_word_bpe(spark, folder).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        want = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == want


def test_awkward_rows_ids_and_decoding(spark, library):
    docs = awkward(spark).selectExpr("*", "'x' as token_ids", "1 as n_tokens")
    out = word_bpe.encoded(docs, PATH, batch_chars=20)
    assert out.columns == [*awkward(spark).columns, "n_tokens", "token_ids", "decoded"]
    rows = word_bpe.decoded(out.withColumnRenamed("decoded", "before"), PATH).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert list(row["token_ids"]) == library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(row["token_ids"]) and row["decoded"] == row["before"]
    assert word_bpe.encoded(docs.where("false"), PATH, digest=True).count() == 0
