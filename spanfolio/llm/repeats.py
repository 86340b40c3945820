"""Windows of symbols that also start earlier, over all documents: what substring removal is built on.

A symbol is a byte or a word, a window is ``length`` consecutive symbols of a document. A
window's anchor is its least gram (winnowing), which depends on the window alone, so
equal windows have equal anchors at the same place. Consecutive windows with one anchor
are a block.

1. Blocks are aggregated by the hash of all their symbols; the first of equal blocks stays. All
   windows of any other block start earlier, where the first one is. What goes on are
   first blocks alone, so copies and passages that many documents share are counted once.
2. First blocks are sorted by the hash of their anchor. One without a neighbour of equal
   anchor holds only windows that occur once.
3. The windows of the others are aggregated by their hash, and the first of equal ones stays. Where
   a rule can compare texts, blocks whose anchor few share meet by anchor instead, with their
   text: a block has dozens of windows, and a hash of each would be ten times the text.

Every aggregation combines in the tasks before it shuffles, and the sort splits an anchor
of any frequency, so no key's rows need to meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.llm import text as T
from spanfolio.sources.workspace import materialise


@dataclass(frozen=True)
class Rule:
    """``symbols`` gives the symbols of texts and where each text's begin; ``grams`` the hashes of every n symbols."""

    length: int
    gram: int
    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    grams: Callable[[np.ndarray, int], np.ndarray]
    #: If given, blocks whose anchors few share are compared by their text: of the windows that start at
    #: ``starts`` in some bytes, the places of those whose bytes don't start earlier. Symbols must be bytes.
    contexts: Callable[[np.ndarray, int, np.ndarray], np.ndarray] | None = None


#: How a first block's anchor is shared with other first blocks.
ALONE, FEW, MANY = 0, 1, 2
#: Blocks of an anchor that count as few, and bytes of text that are put in suffix order at once.
GROUP, RESOLVED = 1024, 1 << 21


#: Windows of a block, whose number is held in eight bits; longer blocks are split.
LARGEST = 255


def first_of(h: np.ndarray, *order: np.ndarray) -> np.ndarray:
    """Places, in order, of the first of equal hashes by ``order`` (the most significant first; else by place)."""
    by = np.lexsort([*order[::-1], h])
    new = np.ones(len(h), bool)
    new[1:] = h[by[1:]] != h[by[:-1]]
    return np.sort(by[new])


def _blocks(rows: DataFrame, rule: Rule) -> DataFrame:
    """Blocks of each text: hash of all symbols, place (start * 256 + windows) and anchor."""
    width = rule.length - rule.gram + 1

    def run(batches):
        for batch, data, offsets in T.chunks(batches):
            symbols, first = rule.symbols(data, offsets)
            gram = rule.grams(symbols, rule.gram)
            at = T.anchors(gram, width)
            starts = np.flatnonzero(T.room(first)[: len(at)] >= rule.length)
            if not len(starts):
                continue
            new = np.ones(len(starts), bool)
            new[1:] = (at[starts[1:]] != at[starts[:-1]]) | (starts[1:] != starts[:-1] + 1)
            edge = np.flatnonzero(new)
            begin, windows = starts[edge], np.diff(np.append(edge, len(starts)))
            if width > LARGEST:
                parts = -(-windows // LARGEST)
                nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
                begin, windows = np.repeat(begin, parts) + nth * LARGEST, np.minimum(np.repeat(windows, parts) - nth * LARGEST, LARGEST)
            whole = T.span_hashes(symbols, begin, begin + windows - 1 + rule.length)
            owner = np.searchsorted(first, begin, "right") - 1
            keys = batch.column("key").to_numpy()[owner]
            kept = first_of(whole, keys, begin)
            begin, windows, whole, owner, keys = begin[kept], windows[kept], whole[kept], owner[kept], keys[kept]
            place = (begin - first[owner]) << 8 | windows
            anchor = gram[at[begin]].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (whole.view(np.int64), keys, place, anchor)], names=["whole", "key", "place", "anchor"])

    return rows.mapInArrow(run, "whole long, key long, place long, anchor long")


def _marked(batches):
    """Of first blocks, sorted by anchor, whether others have the same anchor: ALONE, a FEW, or MANY.

    The first and the last anchor of a partition may have blocks in another one, so they
    count as MANY; every other anchor has all its blocks here, and is MANY beyond GROUP of them.
    """
    held: list[tuple] = []  # blocks of the anchor that the batches so far end with
    size, anchor, first = 0, None, True

    def out(key, place, mark):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(place << 2 | mark)], names=["key", "block"])

    for batch in batches:
        if not len(batch):
            continue
        anchors, key, place = (batch.column(c).to_numpy() for c in ("anchor", "key", "place"))
        cuts = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
        lows, highs = np.append(0, cuts), np.append(cuts, len(anchors))
        for low, high in ((int(lows[0]), int(highs[0])),) if anchors[0] == anchor else ():
            held.append((key[low:high], place[low:high]))
            size += high - low
            lows, highs = lows[1:], highs[1:]
        if len(lows):  # another anchor begins: the one held is complete
            if held:
                mark = MANY if first or size > GROUP else ALONE if size == 1 else FEW
                yield from (out(k, p, mark) for k, p in held)
                first = False
            held, anchor = [], anchors[lows[-1]]
            if len(lows) > 1:
                sizes = highs[:-1] - lows[:-1]
                marks = np.where(sizes > GROUP, MANY, np.where(sizes == 1, ALONE, FEW))
                if first:
                    marks[0], first = MANY, False
                inner = slice(int(lows[0]), int(highs[-2]))
                yield out(key[inner], place[inner], np.repeat(marks, sizes))
            held, size = [(key[lows[-1] :], place[lows[-1] :])], int(highs[-1] - lows[-1])
        if size > GROUP:
            yield from (out(k, p, MANY) for k, p in held)
            held = []
            if not first and anchor is not None:
                first = False
    yield from (out(k, p, MANY) for k, p in held)


def _places(lists: pa.Array, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of lists of numbers and the base of the row that each is in."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(base, sizes)


def _asked(rows: DataFrame, rule: Rule) -> DataFrame:
    """What is needed of blocks that aren't alone: their text, if few share the anchor, else a hash of each window."""

    def run(batches):
        for batch, data, offsets in T.unpacked(batches):
            symbols, first = rule.symbols(data, offsets)
            block, owner = _places(batch.column("blocks"), np.arange(len(batch)))
            by = np.argsort(first[owner] + (block >> 10), kind="stable")
            block, owner = block[by], owner[by]
            keys = batch.column("key").to_numpy()
            few = (block & 3) == (FEW if rule.contexts else -1)
            begin, n = first[owner] + (block >> 10), block >> 2 & 255
            if few.any():
                low, high = begin[few], begin[few] + n[few] - 1 + rule.length
                # windows hold the anchor, and so does the text they all have in common
                text = pa.array([symbols[x:y].tobytes() for x, y in zip(low.tolist(), high.tolist(), strict=True)], pa.binary())
                gram = rule.grams(symbols, rule.gram)
                at = T.anchors(gram, rule.length - rule.gram + 1)[low]
                columns = [pa.array(gram[at].view(np.int64)), pa.nulls(len(low), pa.int64()), pa.array(keys[owner[few]]), pa.array(low - first[owner[few]]), text]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "window", "key", "start", "text"])
            rest = (block & 3) != ALONE
            rest &= ~few
            begin, n, owner = begin[rest], n[rest], owner[rest]
            if len(begin):
                starts = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                owner = np.repeat(owner, n)
                h = rule.grams(symbols, rule.length)[starts]
                kept = first_of(h)
                owner, starts = owner[kept], starts[kept]
                columns = [pa.nulls(len(kept), pa.int64()), pa.array(h[kept].view(np.int64)), pa.array(keys[owner]), pa.array(starts - first[owner]), pa.nulls(len(kept), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "window", "key", "start", "text"])

    return rows.mapInArrow(run, "anchor long, window long, key long, start long, text binary")


def _resolved(rows: DataFrame, rule: Rule) -> DataFrame:
    """First windows of blocks whose anchors few share: key and start. Rows are sorted by anchor, key and start."""

    def firsts(parts):
        key, start, text = (np.concatenate([x[i] for x in parts]) if i < 2 else [t for x in parts for t in x[2]] for i in range(3))
        lengths = np.fromiter(map(len, text), np.int64, len(text))
        data = np.frombuffer(b"".join(text), np.uint8)
        n = lengths - rule.length + 1
        begin = np.cumsum(lengths) - lengths
        starts = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        row = np.repeat(np.arange(len(n)), n)
        new = rule.contexts(data, rule.length, starts)
        row, starts = row[new], starts[new]
        return pa.RecordBatch.from_arrays([pa.array(key[row]), pa.array(start[row] + starts - begin[row])], names=["key", "start"])

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            if not len(batch):
                continue
            anchor, key, start = (batch.column(c).to_numpy() for c in ("anchor", "key", "start"))
            text = batch.column("text").to_pylist()
            total = np.cumsum(np.fromiter(map(len, text), np.int64, len(text)))
            low = 0
            ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor)).tolist()
            if held and anchor[0] != last and size > RESOLVED:
                yield firsts(held)
                held, size = [], 0
            begun = 0
            for end in ends[:-1]:  # groups that end here
                if size + int(total[end - 1]) - begun > RESOLVED:
                    yield firsts([*held, (key[low:end], start[low:end], text[low:end])])
                    held, size, low, begun = [], 0, end, int(total[end - 1])
            held.append((key[low:], start[low:], text[low:]))
            size, last = size + int(total[-1]) - begun, anchor[-1]
        if held:
            yield firsts(held)

    return rows.select("anchor", "key", "start", "text").mapInArrow(run, "key long, start long")


def marked(rows: DataFrame, rule: Rule) -> DataFrame:
    """``rows`` (key, text) as (key, n_bytes, packed, blocks, firsts), for ``removed``.

    Keys are unique whole numbers; an earlier document has a smaller one.
    """
    if rule.length <= rule.gram:
        raise ValueError(f"strings of {rule.length} can't have anchors of {rule.gram}")
    rows = rows.select("key", "text")
    blocks = _blocks(rows, rule).groupBy("whole").agg(F.min(F.struct("key", "place", "anchor")).alias("m")).select("m.*")
    sorted_ = blocks.repartitionByRange("anchor", "key", "place").sortWithinPartitions("anchor")
    lists = sorted_.mapInArrow(_marked, "key long, block long").groupBy("key").agg(F.collect_list("block").alias("blocks"))
    lists = materialise(lists, "first-blocks")
    texts = T.compressed(rows)
    asked = texts.join(lists.where(F.exists("blocks", lambda b: b.bitwiseAND(F.lit(3)) != ALONE)), "key").sortWithinPartitions("key")
    asked = _asked(asked, rule)
    if rule.contexts:
        asked = materialise(asked, "shared-anchors")
    windows = asked.where("window IS NOT NULL").groupBy("window").agg(F.min(F.struct("key", "start")).alias("m")).select("m.*")
    if rule.contexts:
        few = asked.where("window IS NULL").repartition("anchor").sortWithinPartitions("anchor", "key", "start")
        windows = windows.unionAll(_resolved(few, rule))
    firsts = materialise(windows.groupBy("key").agg(F.collect_list("start").alias("firsts")), "first-windows")
    known = lists.join(firsts, "key", "left")
    return texts.join(known, "key", "left")


def removed(batch: pa.RecordBatch, first: np.ndarray, rule: Rule) -> np.ndarray:
    """Of the symbols of a chunk of ``marked`` rows, which lie in a window that also starts earlier."""
    n = int(first[-1])
    edges = np.zeros(n + 1, np.int64)
    block, owner = _places(batch.column("blocks"), first[:-1])
    sure = block & 3 == ALONE
    begin, windows = owner[sure] + (block[sure] >> 10), block[sure] >> 2 & 255
    np.add.at(edges, begin, 1)
    np.add.at(edges, begin + windows, -1)
    start, base = _places(batch.column("firsts"), first[:-1])
    np.add.at(edges, base + start, 1)
    np.add.at(edges, base + start + 1, -1)
    again = np.flatnonzero((T.room(first) >= rule.length) & (np.cumsum(edges)[:-1] == 0))
    edges[:] = 0
    edges[again] = 1
    edges[again + rule.length] -= 1
    return np.cumsum(edges)[:-1] > 0
