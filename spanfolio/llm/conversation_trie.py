"""Prefix trie of conversations, with totals of subtrees rolled up in bands of depth.

A node is a distinct sequence of first turns. Its key is two 64-bit hashes of running
sums over the hashes of its turns, so a window along each conversation finds the keys of
all its nodes and of the nodes above them; texts never leave the task that reads them.

Totals of subtrees take two passes over bands of HEIGHT depths. Upwards every node is
added to its ancestors in its own band, and the sums of the bands' first nodes are the
values of a trie that is HEIGHT times lower, where the same happens. Downwards the
finished totals of first nodes are added to the ancestors in the band above. A node is
copied to at most HEIGHT ancestors, and a trie of depth d needs log(d) rounds.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanfolio.sources.workspace import materialise

#: Depths of a band.
HEIGHT = 4
#: Every conversation begins with turns of the one whose id is the next multiple of this towards zero.
BLOCK = 20
WORD = r"[^\x20\x09-\x0D]+"
_LANES = ("s1", "s2", "s3", "s4")
_KEY = ["k1", "k2"]
_ABOVE = [(f"a{i}", f"b{i}") for i in range(1, HEIGHT + 1)]


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``n_own`` (turns of the conversation), ``block``, ``words`` and two hashes of each turn.

    Turns are in the order of ``turn`` (null first); turns with the same number in the
    order of a hash of role and text. Null roles and texts are empty. Rows without a
    conv_id belong to no conversation and are left out; other columns are not looked at.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    rows = conversations.where(conv.isNotNull()).select(
        conv.alias("conv_id"),
        "turn",
        (conv - conv % BLOCK).alias("block"),
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit("second"), text, role).alias("h2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    # conversations that lend each other turns share a partition from here on
    rows = rows.repartition("block")
    one = Window.partitionBy("block", "conv_id")
    return rows.withColumns(
        {"pos": F.row_number().over(one.orderBy(F.col("turn").asc_nulls_first(), "h1", "h2")).cast("long"), "n_own": F.count("*").over(one)}
    ).drop("turn")


def as_given(rows: DataFrame) -> DataFrame:
    """Paths of conversations as they are: a row for the root and one for each turn."""
    turn = F.struct(F.col("pos").alias("depth"), "h1", "h2", "words")
    return _paths(rows, F.when(F.col("pos") == 1, F.array(_root(), turn)).otherwise(F.array(turn)), F.col("n_own"))


def rebuilt(rows: DataFrame) -> DataFrame:
    """Paths of conversations that begin with the first h turns of their block's first one.

    h is crc32 of the decimal id, modulo 4. A conversation keeps its own turns after its
    first h; if nothing is borrowed and none is left it is the root's member only.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    turn = F.struct(F.col("pos").alias("depth"), "h1", "h2", "words")
    lent = F.sort_array(F.collect_list(F.when((F.col("conv_id") == F.col("block")) & (F.col("pos") <= 3), turn)).over(Window.partitionBy("block")))
    rows = rows.withColumn("lent", lent).withColumn("h", F.when(F.col("conv_id") == F.col("block"), 0).otherwise(h))
    rows = rows.withColumn("lent", F.filter("lent", lambda x: x["depth"] <= F.col("h"))).withColumn("n_lent", F.size("lent").cast("long"))
    own = F.struct((F.col("n_lent") + F.col("pos") - F.col("h")).alias("depth"), "h1", "h2", "words")
    own = F.when(F.col("pos") > F.col("h"), F.array(own)).otherwise(F.array().cast("array<struct<depth:bigint,h1:bigint,h2:bigint,words:bigint>>"))
    first = F.concat(F.array(_root()), "lent", own)
    return _paths(rows, F.when(F.col("pos") == 1, first).otherwise(own), F.col("n_lent") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))


def _root() -> Column:
    return F.struct(F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(c) for c in ("h1", "h2", "words")))


def _paths(rows: DataFrame, found: Column, length: Column) -> DataFrame:
    """A row for each node on the path of each conversation, with the keys of the HEIGHT nodes above it."""
    rows = rows.select("block", "conv_id", length.alias("length"), F.explode(found).alias("x")).select("block", "conv_id", "length", "x.*")
    # the turn's place is part of its hash; halves of 32 bits, whose sums can't overflow
    lane = [F.xxhash64("depth", "h1", "h2"), F.xxhash64("h2", "depth", "h1")]
    halves = [half for x in lane for half in (x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32))]
    along = Window.partitionBy("block", "conv_id").orderBy("depth")
    sums = {c: F.sum(F.when(F.col("depth") > 0, x).otherwise(0)).over(along) for c, x in zip(_LANES, halves, strict=True)}
    rows = rows.withColumns(sums).select(
        "block", "conv_id", "length", "depth", "words", F.xxhash64("depth", *_LANES).alias("k1"), F.xxhash64(*reversed(_LANES), "depth").alias("k2")
    )
    return _with_above(rows, along).drop("block")


def _with_above(rows: DataFrame, along) -> DataFrame:
    above = {name: F.lag(k, i).over(along) for i, pair in enumerate(_ABOVE, 1) for name, k in zip(pair, _KEY, strict=True)}
    return rows.withColumns(above)


def _ancestors(step: int) -> Column:
    """How many of the columns of nodes above lie in the node's own band, where a level has every ``step``-th depth."""
    return F.expr(f"(depth div {step}) % {HEIGHT}")


def _spread(rows: DataFrame, n: Column, values: list[str]) -> DataFrame:
    """``values`` of each row for the nearest ``n`` of the nodes above it."""
    up = F.array(*(F.struct(F.col(a).alias("k1"), F.col(b).alias("k2")) for a, b in _ABOVE))
    return rows.select(F.explode(F.slice(up, F.lit(1), n.cast("int"))).alias("up"), *values).select("up.k1", "up.k2", *values)


def trie(paths: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``paths`` (of ``as_given`` or ``rebuilt``).

    ``conv_id`` is its smallest member, ``depth`` that of the node, ``parent_conv_id`` the
    parent's ``conv_id`` (null for the root), ``n_convs`` its members, ``n_children`` and
    ``n_leaves`` its children and the childless nodes under it, ``saved_tokens`` the words
    of last texts that its subtree shares (members less one, times words),
    ``ends_sha256`` the digest of the ids of those that end there. Exact copies of a
    conversation are members of one leaf. No conversation at all gives no row.
    """
    paths = materialise(paths, "trie-paths")
    deepest = paths.agg(F.max("depth")).first()[0] or 0
    attributes = [F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.count("*").alias("n_convs"), F.first("words").alias("words"), F.max("length").alias("length")]
    above = [F.first(c).alias(c) for pair in _ABOVE for c in pair]
    nodes = paths.groupBy(*_KEY).agg(*attributes, *above)
    nodes = nodes.withColumn("leaves", (F.col("length") == F.col("depth")).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    levels = [materialise(nodes.drop("length", "words"), "trie-nodes")]
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]

    def within(rows: DataFrame, step: int) -> DataFrame:
        inner = _spread(rows, _ancestors(step), ["leaves", "saved"])
        return rows.select(*_KEY, "leaves", "saved").unionAll(inner).groupBy(*_KEY).agg(*sums)

    partial = [materialise(within(levels[0], 1), "trie-sums")]
    step = HEIGHT
    while step <= deepest:
        some = paths.where(F.col("depth") % step == 0).select("conv_id", "depth", *_KEY)
        some = _with_above(some, Window.partitionBy("conv_id").orderBy("depth"))
        some = some.groupBy(*_KEY).agg(F.first("depth").alias("depth"), *above).join(partial[-1], _KEY)
        levels.append(materialise(some, "trie-nodes"))
        partial.append(materialise(within(levels[-1], step), "trie-sums"))
        step *= HEIGHT
    total = partial[-1]
    for level in range(len(levels) - 2, -1, -1):
        begin = levels[level].where((F.col("depth") > 0) & (F.col("depth") % HEIGHT ** (level + 1) == 0)).drop("leaves", "saved")
        crossing = _spread(begin.join(total, _KEY), F.lit(HEIGHT), ["leaves", "saved"]).where(F.col("k1").isNotNull())
        total = partial[level].unionAll(crossing).groupBy(*_KEY).agg(*sums)
    return _described(levels[0], total, paths)


def _described(nodes: DataFrame, total: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes with their totals, children, parents and ends."""
    children = nodes.where("depth > 0").groupBy(F.col("a1").alias("k1"), F.col("b1").alias("k2")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("k1").alias("a1"), F.col("k2").alias("b1"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.select(*_KEY, "a1", "b1", "conv_id", "depth", "n_convs").join(total, _KEY).join(children, _KEY, "left")
    out = out.join(ends(paths), _KEY, "left").join(parents, ["a1", "b1"], "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def ends(paths: DataFrame) -> DataFrame:
    """Digest of the ids of the conversations that end at a node, ascending, with commas between them.

    Ids are gathered in pieces of at most 2^16, whatever the number of equal
    conversations; the pieces of a node then pass through its digest one after the other.
    """
    pieces = paths.where(F.col("depth") == F.col("length")).groupBy(*_KEY, F.shiftright("conv_id", 16).alias("piece"))
    pieces = pieces.agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def digests(batches):
        node, state = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids")), strict=True):
                if (k1, k2) != node:
                    if state is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(out)
        if state is not None:
            yield _batch([(*node, state.hexdigest())])

    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece").mapInArrow(digests, "k1 long, k2 long, ends_sha256 string")


def _batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], names=[*_KEY, "ends_sha256"])
