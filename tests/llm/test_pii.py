import random
import re

from fixtures import awkward, corpus, sha, written

from spanfolio.llm import pii
from spanfolio.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plainly(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            twice = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1]))
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(d) <= 19 and twice % 10 == 0,
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def base(text):
    return [s[:3] for s in pii.spans(text) if s[0] in pii.BASE]


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(5)
    known = ["4111 1111 1111 1111", "a.b@c.de", "a@b@c.com", "x@y.com.z@w.org", "1.2.3", "1.2.3.4.5.6.7.8", "256.1.1.1", "+1 (555) 123-4567", "+", "é", "😀 ", "012.1.1.0001"]
    for _ in range(4000):
        text = "".join(r.choice(known) if r.random() < 0.3 else r.choice("ab1234567890.@+-() \n%") for _ in range(r.randint(0, 40)))
        assert base(text) == plainly(text), text


def test_long_runs_take_linear_time():
    text = "a" * 300_000 + " " + "1." * 200_000 + "+1" * 100_000 + "1 " * 200_000
    assert base(text[:300_000]) == []
    pii.spans(text)


def test_added_kinds():
    assert [s[0] for s in pii.spans("IBAN GB82 WEST 1234 5698 7654 32 of the account")] == ["iban"]
    assert pii.spans("IBAN GB83 WEST 1234 5698 7654 32") == []
    assert [s[0] for s in pii.spans("his SSN is 078-05-1120.")] == ["national_id"]
    assert pii.spans("order number 078-05-1120") == []
    assert [s[0] for s in pii.spans("call 555-123-4567 now")] == ["local_phone"]
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_query_and_awkward_rows(spark, tmp_path):
    documents = corpus(2)
    documents[0] = (documents[0][0], "é mail a.b@c.de, +44 20 7946 0958 and 10.0.0.1\n4111-1111-1111-1111", "en", "s", 1)
    folder = written(spark, tmp_path / "t", documents)
    for row in QUERIES["op7_pii"](spark, folder).collect():
        want = plainly(dict((d[0], d[1]) for d in documents)[row["doc_id"]] or "")
        assert row["base_sha256"] == sha(",".join(f"{k}:{s}:{e}" for k, s, e in want))
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(w[0] == k for w in want) for k in pii.BASE]
    docs = awkward(spark)
    out = pii.found(docs, name="spans")
    assert out.count() == docs.count() and set(out.columns) == set(docs.columns)
    masked = pii.redacted(spark.createDataFrame([(1, "to a.b@c.de or 10.0.0.1"), (2, None)], "doc_id long, text string"))
    assert {r["text"] for r in masked.collect()} == {"to [email] or [ip]", None}
