"""Modified Kneser-Ney models over byte n-grams: counted by Spark, held in tables.

A gram is packed into one long: up to six bytes, and above them the number of the
group it is counted for (a language, or a class and fold), so the packed gram is its own
hash without collisions. Each order has a table of its grams and one of their histories;
grams looked up are joined with them in sorted order, a part of each in a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanfolio.sources.workspace import discard, materialise

BYTES = 48
_GRAM = (1 << BYTES) - 1
#: Distinct grams a task holds before it hands over their counts.
HELD = 1 << 21


def packed(stream: np.ndarray, order: int) -> np.ndarray:
    """For each byte from the ``order``-th on, it and the bytes before it as one number."""
    n = len(stream) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.zeros(n, np.int64)
    for i in range(order):
        out = (out << 8) | stream[i : i + n]
    return out


def word_stream(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Words behind each other with ``pad`` blanks before each, and where each word's bytes begin."""
    lengths = ends - starts
    begin = np.cumsum(lengths + pad) - lengths
    out = np.full(int(begin[-1] + lengths[-1]) + 1 if len(starts) else 1, 0x20, np.uint8)
    shift = np.repeat(begin - starts, lengths)
    at = np.arange(len(shift)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    out[at + shift] = data[at]
    return out, begin


def counted(rows: DataFrame, grams: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]]) -> DataFrame:
    """Counts of packed grams over all rows: (``gram``, ``c``). ``grams`` yields grams and counts of some rows.

    Each task sums what it has seen and hands over at most ``HELD`` distinct grams at once.
    """

    def run(batches):
        keys, counts = [], []
        held = 0

        def merged():
            distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            return distinct, np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)

        for k, c in grams(batches):
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > HELD:
                k, c = merged()
                if len(k) > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["gram", "c"])
                    keys, counts, held = [], [], 0
                else:
                    keys, counts, held = [k], [c], len(k)
        if keys:
            k, c = merged()
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["gram", "c"])

    return rows.mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Of counts one, two, and three or more; from how many grams have each count."""
    if not (n1 and n2):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    clipped = lambda d, most: min(max(d, 0.1), most)
    return clipped(1 - 2 * y * n2 / n1, 0.95), clipped(2 - 3 * y * n3 / n2, 1.9), clipped(3 - 4 * y * (n4 / n3 if n3 else 0.5), 2.9)


@dataclass
class Levels:
    """A whole model as tables, per order: the discounted ``share`` of each ``gram`` and the mass each history ``h`` has ``left`` for the order below."""

    order: int
    shared: int
    grams: list[DataFrame]
    histories: list[DataFrame]


def _suffix(gram, n: int, shared: int):
    return gram.bitwiseAND(F.lit(_signed((~_GRAM if n > shared else ~_GRAM << 1) | (1 << 8 * n) - 1)))


def _before(gram):
    return gram.bitwiseAND(F.lit(_signed(~_GRAM))).bitwiseOR(F.shiftright(gram.bitwiseAND(F.lit(_GRAM)), 8))


def _lower(table: DataFrame, n: int, shared: int) -> DataFrame:
    """Counts of the order ``n`` from those of the order above: in how many ways each gram is extended to the left."""
    byte = F.shiftright("gram", 8 * n).bitwiseAND(F.lit(255))
    return table.groupBy(_suffix(F.col("gram"), n, shared).alias("gram")).agg(F.countDistinct(byte).alias("c"))


def _discounts(table: DataFrame) -> DataFrame:
    """The three discounts of each group ``g`` of an order's counts, written."""

    def run(batches):
        for batch in batches:
            d = [discounts(*n) for n in zip(*(batch.column(f"n{i}").to_pylist() for i in (1, 2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("g"), *(pa.array([x[i] for x in d], pa.float64()) for i in range(3))], names=["g", "d1", "d2", "d3"])

    few = table.groupBy(F.shiftright("gram", BYTES).alias("g")).agg(*(F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)))
    return materialise(few.mapInArrow(run, "g long, d1 double, d2 double, d3 double"), "discounts")


def _discounted(table: DataFrame, few: DataFrame) -> DataFrame:
    """Each gram of an order with its history ``h`` and its discount ``d``."""
    taken = F.expr("case c when 1 then d1 when 2 then d2 else d3 end")
    return table.withColumn("g", F.shiftright("gram", BYTES)).join(few, "g").select("gram", _before(F.col("gram")).alias("h"), "c", taken.alias("d"))


#: Whole numbers, so that the order of a sum doesn't show.
_TAKEN = "cast(round(d * 1073741824) as long)"


def _left(t, s):
    return F.least(F.greatest(t / 2**30 / s, F.lit(1e-6)), F.lit(1.0))


def own(counts: DataFrame, order: int) -> DataFrame:
    """(``gram``, ``p``): P(last byte | bytes before it, group) of each counted gram itself, by the model of ``levels``.

    A counted gram's suffixes are the grams of the orders below, so the model is made from
    the lowest order up, in one table an order: histories are windows of at most 256
    grams, and nothing is asked for apart from what was counted.
    """
    tables = [materialise(counts, "grams")]
    for n in range(order - 1, 0, -1):
        tables.insert(0, materialise(_lower(tables[0], n, 0), "grams"))
    below = None
    for n, table in enumerate(tables, 1):
        few = _discounts(table)
        history = Window.partitionBy("h")
        rows = _discounted(table, few).withColumns({"s": F.sum("c").over(history), "t": F.sum(F.expr(_TAKEN)).over(history)})
        # four bytes each where they cross the network
        share, left = ((F.col("c") - F.col("d")) / F.col("s")).cast("float"), _left(F.col("t"), F.col("s")).cast("float")
        rows = rows.select("gram", share.alias("share"), left.alias("left"))
        if below is not None:
            under = below.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            rows = rows.withColumn("suffix", _suffix(F.col("gram"), n - 1, 0)).join(under, "suffix")
        q = F.lit(1 / 256) if below is None else F.col("q")
        last, below = below, materialise(rows.select("gram", (F.col("share").cast("double") + F.col("left").cast("double") * q).alias("p")), "probabilities")
        discard(table, few, *([] if last is None else [last]))
    return below


def levels(counts: DataFrame, order: int, shared: int = 0) -> Levels:
    """Model from counts of packed grams of ``order`` bytes, with every gram of every order, whatever their number.

    Lower orders count in how many ways a gram is extended to the left; orders up to
    ``shared`` count that for groups that differ in their lowest bit together.
    Nothing is collected; a group's discounts are a row of a small table.
    """
    model = Levels(order, shared, [None] * order, [None] * order)
    table = materialise(counts, "grams")
    for n in range(order, 0, -1):
        if n < order:
            above, table = table, materialise(_lower(table, n, shared), "grams")
            discard(above)
        few = _discounts(table)
        rows = _discounted(table, few)
        sums = rows.groupBy("h").agg(F.sum("c").alias("s"), F.sum(F.expr(_TAKEN)).alias("t"))
        sums = materialise(sums, "histories")
        model.grams[n - 1] = materialise(rows.join(sums, "h").select("gram", ((F.col("c") - F.col("d")) / F.col("s")).alias("share")), "shares")
        model.histories[n - 1] = materialise(sums.select("h", _left(F.col("t"), F.col("s")).alias("left")), "left")
        discard(few, sums)
    discard(table)
    return model


def forget(model: Levels) -> None:
    """Delete the tables of a model."""
    discard(*model.grams, *model.histories)


def probabilities(model: Levels, wanted: DataFrame) -> DataFrame:
    """(``gram``, ``p``): P(last byte | bytes before it, group) of the distinct grams of ``wanted`` (``gram``).

    Each order is joined with the one below. A gram has at most 512 neighbours with its
    suffix and as many with its history, so no key is a frequent one.
    """
    asked = [None] * model.order
    asked[-1] = materialise(wanted.select("gram").distinct(), "wanted")
    for n in range(model.order - 1, 0, -1):
        asked[n - 1] = materialise(asked[n].select(_suffix(F.col("gram"), n, model.shared).alias("gram")).distinct(), "wanted")
    below = None
    for n in range(1, model.order + 1):
        rows = asked[n - 1].select("gram", _before(F.col("gram")).alias("h"), _suffix(F.col("gram"), n - 1, model.shared).alias("suffix"))
        rows = rows.join(model.grams[n - 1], "gram", "left").join(model.histories[n - 1], "h", "left")
        if n > 1:
            rows = rows.join(below.select(F.col("gram").alias("suffix"), F.col("p").alias("q")), "suffix")
        under = F.col("q") if n > 1 else F.lit(1 / 256)
        last, below = below, materialise(rows.select("gram", (F.coalesce("share", F.lit(0.0)) + F.coalesce("left", F.lit(1.0)) * under).alias("p")), "probabilities")
        discard(asked[n - 1], *([last] if n > 1 else []))
    return below


def _signed(bits: int) -> int:
    bits &= (1 << 64) - 1
    return bits - (1 << 64) if bits >> 63 else bits
