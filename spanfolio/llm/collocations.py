"""Phrases whose words keep together: n-grams counted by an FM-index of each shard.

Texts become shards, the texts of one language of a task, written as numbers of words. A
word that is rare everywhere parts its piece, since no frequent phrase has it. A shard's
bidirectional index then lists the phrases that occur in it with their counts, one length
a round: phrases of one word less are grown at the left, those known to be frequent in
all shards together are kept, and their right extensions are what the round counts.
Counts are summed over the shards; phrases are told apart by the numbers of their words,
not by hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanfolio.llm import text as T
from spanfolio.sources.workspace import materialise

#: Bytes that end a piece, and bytes that part words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
#: Words of the longest phrase.
LONGEST = 4
#: Bytes of text of a shard, one document at least; all open shards of a task hold at most as much.
SHARD_BYTES = 12 << 20
#: The filter of frequent phrases has at most so many bits, whatever their number.
FILTER_BITS = 1 << 27
#: Suffixes whose phrases are grown at once, those of one phrase at least.
SUFFIXES = 1 << 16
UNKNOWN = "und"

_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, 0x09, *PIECE_ENDS]] = False
_ENDS = np.zeros(256, bool)
_ENDS[list(PIECE_ENDS)] = True
_LOW = (1 << 32) - 1


def _packed(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.astype(np.int32).tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, n * 4, codec="zstd", asbytes=True), np.int32) if n else np.zeros(0, np.int32)


class _Shard:
    """Distinct words of texts of one language and, for each word, which it is; 0 ends a piece."""

    def __init__(self):
        self.size, self.names, self.hashes, self.parts, self.counts = 0, [], np.zeros(0, np.uint64), [], None

    def add(self, data: np.ndarray, offsets: np.ndarray) -> None:
        data = T.LOWER[data]
        self.size += len(data)
        starts, ends, first = T.words(data, offsets, _INSIDE)
        if not len(starts):
            return
        h = T.span_hashes(data, starts, ends)
        known, at, which = np.unique(h, return_index=True, return_inverse=True)
        slot = np.searchsorted(self.hashes[self.order], known) if len(self.hashes) else np.zeros(len(known), np.int64)
        if len(self.hashes):
            slot[slot == len(self.hashes)] = 0
            slot = self.order[slot]
            new = self.hashes[slot] != known
        else:
            new = np.ones(len(known), bool)
        slot[new] = len(self.hashes) + np.arange(int(new.sum()))
        raw = data.tobytes()
        self.names += [raw[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)]
        self.hashes = np.concatenate([self.hashes, known[new]])
        self.order = np.argsort(self.hashes)
        # a piece ends where one of its bytes lies between two words, and with the text
        passed = np.concatenate([[0], np.cumsum(_ENDS[data])])
        cut = passed[starts[1:]] > passed[ends[:-1]]
        inner = first[1:-1]
        cut[inner[(inner > 0) & (inner < len(starts))] - 1] = True
        out = np.zeros(len(starts) + int(cut.sum()) + 1, np.int32)
        out[np.arange(len(starts)) + np.concatenate([[0], np.cumsum(cut)])] = slot[which] + 1
        self.parts.append(out)

    def row(self, lang: str) -> tuple:
        seq = np.concatenate(self.parts)
        counts = np.bincount(seq, minlength=len(self.names) + 1)[1:]
        return lang, [n.decode("utf-8", "replace") for n in self.names], counts.tolist(), len(seq), _packed(seq)


_SHARD_SCHEMA = "shard long, lang string, words array<string>, counts array<long>, n int, seq binary"


def _shards(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """A row for each shard: its words with their counts, and the sequence of their places in that list."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        T.return_memory()
        held: dict[str, _Shard] = {}

        def written(names) -> Iterator[pa.RecordBatch]:
            for name in names:
                shard = held.pop(name)
                if shard.parts:
                    row = shard.row(name)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], t) for x, t in zip(row, (pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int32(), pa.binary()), strict=True)],
                        names=["lang", "words", "counts", "n", "seq"],
                    )

        for batch, data, offsets in T.chunks(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            for name in sorted(set(langs)):
                some = np.flatnonzero(langs == name)
                sizes = np.diff(offsets)[some]
                part = data if len(some) == len(langs) else np.concatenate([data[offsets[i] : offsets[i + 1]] for i in some])
                held.setdefault(name, _Shard()).add(part, np.concatenate([[0], np.cumsum(sizes)]))
            if sum(s.size for s in held.values()) > SHARD_BYTES:
                yield from written([max(held, key=lambda x: held[x].size)])
        yield from written(list(held))

    found = rows.mapInArrow(run, _SHARD_SCHEMA.removeprefix("shard long, "))
    return materialise(found.select(F.monotonically_increasing_id().alias("shard"), "*"), "shards")


def dense_ids(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with numbers from 1 without gaps, written: places in written partitions plus the sizes of those before."""
    part, place = "part_", "place_"
    placed = materialise(rows.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id()}), "placed")
    sizes = placed.groupBy(part).agg(F.count("*").alias("n"))
    before = sizes.select(part, (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias("before"))  # a row for each partition
    number = F.col("before") + F.col(place).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return materialise(placed.join(before, part).withColumn(name, number).drop(part, place, "before"), "dense")


def _numbered(shards: DataFrame, words: DataFrame) -> DataFrame:
    """Sequences of the numbers of frequent words (``word_id``), one 0 where other words or ends of pieces lie."""
    asked = shards.select("shard", "lang", F.posexplode("words").alias("local", "word"))
    found = asked.join(words.select("lang", "word", "word_id"), ["lang", "word"]).groupBy("shard")
    found = found.agg(F.collect_list("local").alias("local"), F.collect_list("word_id").alias("word_id"))

    def run(batches):
        T.return_memory()
        for batch in batches:
            for row in batch.to_pylist():
                seq = _unpacked(row["seq"], row["n"])
                table = np.zeros(int(seq.max()) + 1, np.int64)
                table[np.array(row["local"]) + 1] = row["word_id"]
                ids = table[seq]
                keep = np.ones(len(ids), bool)
                keep[1:] = (ids[1:] != 0) | (ids[:-1] != 0)
                ids = np.concatenate([[0], ids[keep], [0]])
                yield pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int32()), pa.array([_packed(ids)], pa.binary())], names=["n", "seq"])

    return materialise(shards.select("shard", "n", "seq").join(found, "shard").mapInArrow(run, "n int, seq binary"), "sequences")


class Index:
    """FM-index of a cyclic sequence that ends in 0: the symbols before its suffixes, sorted by ``depth`` symbols.

    ``places`` has the number of each symbol and its place among the sorted suffixes, in
    order; the place of (a, i) in it is where suffixes begin that start with ``a`` and go
    on like the i-th one. So a binary search does what a table of occurrences does.
    """

    def __init__(self, seq: np.ndarray, depth: int):
        key, reach = seq.astype(np.int64), 1
        while reach < depth:
            if reach > 1:
                _, key = T.classes(key)
            key = key * (int(key.max()) + 1) + np.roll(key, -reach)
            reach *= 2
        # the order of suffixes that share their first symbols doesn't matter for counts
        self.before = seq[np.argsort(key) - 1].astype(np.int64)
        del key
        self.places = np.sort(self.before << 32 | np.arange(len(seq)))

    def extended(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each interval and symbol before its suffixes: the interval's place, symbol, new begin, count, and count of lesser symbols."""
        which = np.repeat(np.arange(len(low)), size)
        at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        key, count = np.unique(which << 32 | self.before[at], return_counts=True)
        which, symbol = key >> 32, key & _LOW
        passed = np.cumsum(count) - count
        first = np.searchsorted(which, np.arange(len(low)))
        return which, symbol, np.searchsorted(self.places, symbol << 32 | low[which]), count, passed - passed[first][which]


def _blocks(size: np.ndarray) -> Iterator[slice]:
    """Intervals of about SUFFIXES suffixes together, one at least."""
    ends, at = np.cumsum(size), 0
    while at < len(size):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SUFFIXES, "right")))
        yield slice(at, upto)
        at = upto


def grown(seq: np.ndarray, n: int, frequent) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``phrases``, some at a time: what a step holds beside the index doesn't grow with the sequence."""
    forward = Index(seq, n - 1) if n > 2 else None
    symbol, size = np.unique(seq, return_counts=True)
    low = np.cumsum(size) - size
    words, low, size = symbol[symbol > 0][:, None].astype(np.int64), low[symbol > 0], size[symbol > 0]
    mirrored = low.copy()  # begin of the reversed phrase's interval in the reversed sequence
    for _ in range(2, n):  # at the left
        parts = []
        for some in _blocks(size):
            which, found, begin, count, lesser = forward.extended(low[some], size[some])
            longer, other = np.column_stack([found, words[some][which]]), mirrored[some][which] + lesser
            ok = found > 0
            ok[ok] = frequent(longer[ok])
            parts.append((longer[ok], begin[ok], count[ok], other[ok]))
        if not parts:
            return
        words, low, size, mirrored = map(np.concatenate, zip(*parts, strict=True))
    forward = None
    backward = Index(seq[::-1], n)
    for some in _blocks(size):  # at the right
        which, found, _, count, _ = backward.extended(mirrored[some], size[some])
        longer = np.column_stack([words[some][which], found])
        ok = found > 0
        if n > 2:
            ok[ok] = frequent(longer[ok][:, 1:])
        yield longer[ok], count[ok]


def phrases(seq: np.ndarray, n: int, frequent) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of ``n`` symbols but 0 in a sequence that begins and ends with 0, a row each, and their counts.

    Only those whose parts of fewer symbols are ``frequent``: that takes rows of symbols
    and tells which may be.
    """
    words, counts = zip((np.zeros((0, n), np.int64), np.zeros(0, np.int64)), *grown(seq, n, frequent), strict=True)
    return np.concatenate(words), np.concatenate(counts)


def _slots(words: np.ndarray, bits: int) -> np.ndarray:
    h = np.full(len(words), words.shape[1], np.uint64)
    for column in words.T:
        h = T.mixed(h * np.uint64(T.MULTIPLIER) + column.astype(np.uint64))
    return (h & np.uint64(bits - 1)).astype(np.int64)


def _filter(known: DataFrame, n: int) -> np.ndarray:
    """A bit for each phrase of ``n`` words; of FILTER_BITS bits at most, so a full one lets too much pass, never too little."""
    bits = 1 << min(max(16, (16 * known.count()).bit_length()), FILTER_BITS.bit_length() - 1)

    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            slot = _slots(np.column_stack([k1 >> 32, k1 & _LOW, k2 >> 32, k2 & _LOW][:n]), bits)
            yield pa.RecordBatch.from_arrays([pa.array(slot >> 6), pa.array(np.int64(1) << (slot & 63))], names=["word", "bit"])

    rows = known.select("k1", "k2").mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bit").to_numpy()
    return out


def _counted(sequences: DataFrame, n: int, filters: dict, least: int) -> DataFrame:
    """``k1``, ``k2`` (four numbers of words in 32 bits each, 0 behind the last) and ``f`` of phrases of ``n`` words found ``least`` times."""
    shared = sequences.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        T.return_memory()
        for batch in batches:
            for size, packed in zip(batch.column("n").to_pylist(), batch.column("seq").to_pylist(), strict=True):
                ids, seq = np.unique(_unpacked(packed, size), return_inverse=True)
                if len(ids) < 2:
                    continue
                ids = ids.astype(np.int64)

                def frequent(rows):
                    table = shared.value[rows.shape[1]]
                    slot = _slots(ids[rows], len(table) << 6)
                    return (table[slot >> 6] >> (slot & 63) & 1).astype(bool)

                for words, count in grown(seq, n, frequent):
                    words = np.column_stack([ids[words], np.zeros((len(words), LONGEST - n), np.int64)])
                    columns = words[:, 0] << 32 | words[:, 1], words[:, 2] << 32 | words[:, 3], count
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k1", "k2", "f"])

    counts = sequences.mapInArrow(run, "k1 long, k2 long, f long").groupBy("k1", "k2").agg(F.sum("f").alias("f"))
    return materialise(counts.where(F.col("f") >= least).withColumn("n_words", F.lit(n)), "phrases")


def _key(ids: Column, start: int, length: int) -> list[Column]:
    """``k1`` and ``k2`` of some of the words of an array of four numbers."""
    word = lambda i: ids[start + i] if i < length else F.lit(0).cast("long")
    return [F.shiftleft(word(0), 32).bitwiseOR(word(1)).alias("k1"), F.shiftleft(word(2), 32).bitwiseOR(word(3)).alias("k2")]


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, top: int = 2000, scale: int = 2_000_000, contained: int = 80
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase has two to four words of one piece (between ``.,;:!?`` and line ends) and occurs
    ``a`` >= ``least`` times. Of its cuts into a first part (``l`` times) and a rest (``r`` times)
    the one of lowest ``floor(scale * a / (l + r))`` counts, the first of equal ones; ``n`` is
    the number of the language's words. Phrases that lie in a longer one which has
    ``contained`` percent of their occurrences are left out. Equal scores go by ``a``, then by
    the phrase's bytes. Null and empty texts have no words, a null language is ``und``; repeated
    rows count each; other columns are not looked at, and without words there is no row.
    """
    shards = _shards(docs, text_col, lang_col)
    pairs = shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("lang", F.col("x.words").alias("word"), F.col("x.counts").alias("f"))
    totals = materialise(shards.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n")), "totals")
    words = dense_ids(pairs.groupBy("lang", "word").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "word_id")
    if words.count() >> 31:
        raise ValueError("more frequent words than numbers of 31 bits")
    sequences = _numbered(shards, words)
    levels, filters = [], {}
    for n in range(2, LONGEST + 1):
        levels.append(_counted(sequences, n, filters, least))
        if n < LONGEST:
            filters[n] = _filter(levels[-1], n)
    return _best(levels, words, totals, top, scale, contained)


def _best(levels: list[DataFrame], words: DataFrame, totals: DataFrame, top: int, scale: int, contained: int) -> DataFrame:
    zero = F.lit(0).cast("long")
    known = words.select(F.shiftleft("word_id", 32).alias("k1"), zero.alias("k2"), "f")
    cuts, longer = [], []
    for n, level in enumerate(levels, 2):
        ids = level.select("k1", "k2", "f", F.array(F.shiftright("k1", 32), F.col("k1").bitwiseAND(F.lit(_LOW)), F.shiftright("k2", 32), F.col("k2").bitwiseAND(F.lit(_LOW))).alias("ids"))
        parts = [F.struct(F.lit(k).alias("cut"), F.lit(side).alias("side"), *_key(F.col("ids"), *span)) for k in range(1, n) for side, span in ((0, (0, k)), (1, (k, n - k)))]
        cuts.append(ids.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("f").alias("a"), F.explode(F.array(*parts)).alias("part")))
        if n > 2:
            inner = F.array(F.struct(*_key(F.col("ids"), 0, n - 1)), F.struct(*_key(F.col("ids"), 1, n - 1)))
            longer.append(ids.select("f", F.explode(inner).alias("x")).select("x.*", "f"))
        if n < LONGEST:
            known = known.unionAll(level.select("k1", "k2", "f"))
    parts = cuts[0]
    for more in cuts[1:]:
        parts = parts.unionAll(more)
    parts = parts.select("c1", "c2", "a", "part.*").join(known, ["k1", "k2"])
    side = lambda k, s: F.max(F.when((F.col("cut") == k) & (F.col("side") == s), F.col("f")))
    found = parts.groupBy(F.col("c1").alias("k1"), F.col("c2").alias("k2"), "a").agg(*(side(k, s).alias(f"{'lr'[s]}{k}") for k in range(1, LONGEST) for s in (0, 1)))
    # exact: decimals of 38 digits
    value = lambda k: f"cast(a as decimal(20,0)) * {scale} div (cast(l{k} as decimal(20,0)) + r{k})"
    options = ", ".join(f"if(l{k} is null, null, struct({value(k)} as score, {k} as cut, l{k} as l, r{k} as r))" for k in range(1, LONGEST))
    found = found.withColumn("best", F.expr(f"array_min(filter(array({options}), x -> x is not null))"))
    # a phrase that lies in a much longer one lies in one of one word more that is as frequent or more
    holder = longer[0]
    for more in longer[1:]:
        holder = holder.unionAll(more)
    holder = holder.groupBy("k1", "k2").agg(F.max("f").alias("held"))
    found = found.join(holder, ["k1", "k2"], "left").where(f"held is null or cast(held as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * {contained}")
    langs = words.select(F.col("word_id").alias("first"), "lang")
    found = found.withColumn("first", F.shiftright("k1", 32)).join(langs, "first").select("lang", "k1", "k2", "a", "best.l", "best.r", "best.score")
    order = [F.col("score").desc(), F.col("a").desc()]
    near = found.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top).drop("place")
    ids = F.array(F.shiftright("k1", 32), F.col("k1").bitwiseAND(F.lit(_LOW)), F.shiftright("k2", 32), F.col("k2").bitwiseAND(F.lit(_LOW)))
    near = materialise(near, "best-phrases")
    named = near.select("k1", "k2", F.posexplode(ids).alias("pos", "word_id")).where("word_id > 0").join(words.select("word_id", "word"), "word_id")
    named = named.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("x")).select("k1", "k2", F.array_join("x.word", " ").alias("phrase"))
    ranked = near.join(named, ["k1", "k2"]).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
