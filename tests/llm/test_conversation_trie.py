"""The trie of conversations against one built plainly."""

import random
import re
import zlib

import pytest
from fixtures import SPACE, sha

from spanfolio.llm import conversation_trie as C
from spanfolio.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def own_turns(rows):
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    return {c: [x for _, x in sorted(t, key=lambda y: y[0])] for c, t in out.items()}


def rebuilt(rows):
    own = own_turns(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain(conversations):
    members, ends, last = {}, {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            node = tuple(turns[:d])
            members.setdefault(node, set()).add(c)
            last[node] = turns[d - 1][1] if d else ""
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(members[node]) - 1) * len(SPACE.findall(last[node]))
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, ())), leaves[n], saved[n], sha(",".join(map(str, sorted(ends.get(n, ()))))))
        for n, m in members.items()
    )


def spark_rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: (r[0], r[1]))


def conversations(seed, n, deepest, words=3):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(5 * n), n):
        for t in range(r.randint(1, deepest)):
            rows.append((c, t, r.choice(["user", "assistant", None]) if r.random() < 0.1 else "user", r.choice(["a", "b c", "ü  d\te", "", None][:words])))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,deepest,words", [(1, 150, 6, 3), (2, 60, 90, 1), (3, 80, 20, 5), (4, 3, 300, 2)])
def test_against_plain(spark, seed, n, deepest, words):
    rows = conversations(seed, n, deepest, words)
    table = C.turns(spark_rows(spark, rows))
    assert result(C.trie(C.rebuilt(table))) == plain(rebuilt(rows))
    assert result(C.trie(C.as_given(table))) == plain(own_turns(rows))


def test_copies_ties_nulls_and_clashing_columns(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(100, 170) for t in range(7)]  # copies
    rows += [(7, None, None, None), (7, 0, "x", "y"), (None, 1, "a", "b"), (40, 0, "user", "hi"), (41, 5, "user", "hi"), (-3, 0, "user", "hi")]
    rows += [(9, 1, "a", "same"), (9, 1, "a", "same")]  # repeated row: two turns
    want = plain({**rebuilt(rows), -3: [("user", "hi")][zlib.crc32(b"-3") % 4 :]})
    df = spark_rows(spark, rows).selectExpr("*", "'x' as k1", "1 as depth", "2 as words", "'q' as block")
    assert result(C.trie(C.rebuilt(C.turns(df)))) == want


def test_many_ends_in_several_pieces(spark):
    rows = [(c * 9973 - 300_000, 0, "user", "x") for c in range(200)]
    got = result(C.trie(C.as_given(C.turns(spark_rows(spark, rows)))))
    assert got == plain(own_turns(rows))


def test_empty_table_and_query(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.trie(C.rebuilt(C.turns(empty))).count() == 0
    rows = conversations(6, 50, 9)
    spark_rows(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    out = queries.op13_conversation_trie(spark, str(tmp_path))
    assert out.columns == COLUMNS and {t for c, t in out.dtypes if c != "ends_sha256"} == {"bigint"}
    assert result(out) == plain(rebuilt(rows))


def test_equal_turn_numbers_give_one_order(spark):
    rows = [(20, 0, "user", text) for text in "abcdefgh"]
    one, two = (result(C.trie(C.rebuilt(C.turns(spark_rows(spark, x))))) for x in (rows, rows[::-1]))
    assert one == two and len(one) == 9


def test_words_are_parted_at_white_space_only():
    assert re.compile(C.WORD).findall("a,b c d\x0be") == ["a,b c", "d", "e"]
