"""Line removal: equal lines, and lines one word apart found through deletion neighbourhoods.

Edits are counted in words: a line is near another if one word inserted, left out or
changed turns one into the other. Two such lines have a variant in common: the same
words after leaving out one of them. Lines of few words and many characters (languages
written without blanks, addresses) are taken character by character instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.llm import text as T
from spanfolio.sources.workspace import discard, materialise

#: Lines of fewer words stay; near lines are looked for among lines of NEAR words and more.
LEAST, NEAR = 3, 5
#: The same for the characters of lines of fewer than NEAR words.
LEAST_CHARACTERS, NEAR_CHARACTERS = 20, 60
#: Bytes of text taken at once: arrays of 8 bytes for each of them are below the size from which an
#: allocation has pages of its own, which cost nearly as much time as the work on them.
CHUNK_BYTES = 3 << 15
_POWERS = T.powers(T.MULTIPLIER, CHUNK_BYTES)
_INVERSE = T.powers(pow(T.MULTIPLIER, -1, 1 << 64), CHUNK_BYTES)
_SIZE = np.repeat([1, 2, 3, 4], [0xC0, 0x20, 0x10, 0x10])
#: What a line can share with another one: first or second half, of its own length or of one word less.
HALVES = 4


def _not_space(data: np.ndarray) -> np.ndarray:
    """``T.NOT_SPACE`` of bytes."""
    return (data != 0x20) & (data - np.uint8(0x09) > 4)


def _lowered(data: np.ndarray) -> np.ndarray:
    """``T.LOWER`` of bytes."""
    return data + ((data - np.uint8(0x41) < 26).view(np.uint8) << np.uint8(5))


class Places:
    """The lines with words of some texts: their numbers among all lines of the text, and how many words each has."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = _not_space(data)
        begin, end, line = T.runs(data != 0x0A, offsets)
        self.starts, self.ends, _ = T.runs(inside, offsets)
        first = np.searchsorted(self.starts, np.append(begin, len(data)))
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(line))
        has = np.diff(first) > 0
        self.begin, self.end, self.owner = begin[has], end[has], owner[has]
        # lines without words have no first word
        self.first = np.append(first[:-1][has], len(self.starts))
        self.n = np.diff(self.first)
        feeds = np.flatnonzero(data == 0x0A)
        self.number = np.searchsorted(feeds, self.begin) - np.searchsorted(feeds, offsets[:-1])[self.owner]
        self.few = self.n < NEAR
        some = np.flatnonzero(self.few & (self.end - self.begin >= LEAST_CHARACTERS))
        self.few[:] = False
        if len(some):
            passed = np.append(0, np.cumsum(inside & (data & 0xC0 != 0x80)))
            characters = passed[self.end[some]] - passed[self.begin[some]]
            self.few[some] = characters >= LEAST_CHARACTERS
            self.n[some] = np.where(self.few[some], characters, self.n[some])


class Lines(Places):
    """The same with hashes of the words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        super().__init__(data, offsets)
        low, starts, ends, few = _lowered(data), self.starts, self.ends, self.few
        self.near = np.where(few, NEAR_CHARACTERS, NEAR)
        if few.any():
            inside = _not_space(low) & (low & 0xC0 != 0x80)
            starts, ends, by = _characters(starts, ends, self.first, inside, low, self.begin[few], self.end[few], few)
            h = T.span_hashes(low, starts, ends)
            # a character is never equal to a word
            h[by] = T.mixed(h[by] + np.uint64(T.MULTIPLIER))
            self.first = np.append(0, np.cumsum(self.n))
        else:
            h = T.span_hashes(low, starts, ends)
        self.words = h
        # sums from which the hash of any run of words follows, also with a word left out
        self.total = np.zeros(len(h) + 1, np.uint64)
        if len(h) + 2 > CHUNK_BYTES:  # a text longer than a chunk
            power, self.inverse = T.powers(T.MULTIPLIER, len(h) + 1), T.powers(pow(T.MULTIPLIER, -1, 1 << 64), len(h) + 2)
        else:
            power, self.inverse = _POWERS, _INVERSE
        np.cumsum((h | np.uint64(1)) * power[: len(h)], out=self.total[1:])

    def part(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Hash of the words from ``low`` to ``high``."""
        return T.mixed((self.total[high] - self.total[low]) * self.inverse[low])

    def without(self, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The same with the word ``at`` left out."""
        behind = (self.total[high] - self.total[at + 1]) * self.inverse[1]
        return T.mixed((self.total[at] - self.total[low] + behind) * self.inverse[low])

    def whole(self) -> np.ndarray:
        return _salted(self.part(self.first[:-1], self.first[1:]), self.n, 9)

    def halves(self, at: np.ndarray) -> np.ndarray:
        """For each of the lines ``at`` HALVES hashes; 0 where the line is too short for one."""
        out = np.zeros((len(at), HALVES), np.uint64)
        a, b = self.first[at], self.first[at + 1]
        for less in (0, 1):
            base = self.n[at] - less
            m = base // 2
            for side, h in ((0, self.part(a, a + m)), (1, self.part(b - (base - m), b))):
                out[:, 2 * less + side] = np.where(base >= self.near[at], _salted(h, base, side), 0)
        return out


def _characters(starts, ends, first, inside, low, begin, end, few):
    """Starts and ends of words, of lines marked as ``few`` those of characters instead, and which are characters."""
    stay = np.repeat(~few, np.diff(first))
    edge = np.zeros(len(low) + 1, np.int8)
    edge[begin] += 1
    edge[end] -= 1  # may be where the first line of the next text begins
    character = inside & (np.cumsum(edge[:-1], dtype=np.int8) > 0)
    every = character.copy()
    every[starts[stay]] = True
    every = np.flatnonzero(every)
    by = character[every]
    upto = every + _SIZE[low[every]]
    upto[~by] = ends[stay]
    return every, upto, by


def with_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of lines of each text that have a word."""
    if not len(data):
        return np.zeros(len(offsets) - 1, np.int64)
    # a line goes from its feed, or the start of the text, to the next
    start = data == 0x0A
    start[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(start)
    found = np.append(0, np.cumsum(np.logical_or.reduceat(_not_space(data), starts)))
    return np.diff(found[np.searchsorted(starts, offsets)])


def _salted(h: np.ndarray, n: np.ndarray, what: int) -> np.ndarray:
    return T.mixed(h + n.astype(np.uint64) * np.uint64(16) + np.uint64(what))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x)


def _lines(rows: DataFrame) -> DataFrame:
    """Of each line with LEAST words or more its hash, place and half hashes, equal lines of a chunk once.

    And for each text that has such lines a row without hashes: the number of these lines, less than 0, as ``number``.
    ``text`` is that row's key, null in the others.
    """

    def run(batches):
        T.return_memory()
        for batch, data, offsets in T.chunks(batches, limit=CHUNK_BYTES):
            lines = Lines(data, offsets)
            whole = lines.whole()
            texts = batch.column("key").to_numpy()
            keys = texts[lines.owner]
            at = np.flatnonzero(lines.n >= LEAST)
            by = at[np.lexsort((lines.number[at], keys[at], whole[at]))]
            new = np.ones(len(by), bool)
            new[1:] = whole[by[1:]] != whole[by[:-1]]
            by = by[new]
            n = np.bincount(lines.owner[at], minlength=len(batch))
            some = np.flatnonzero(n)
            spare, halves = pa.nulls(len(some), pa.int64()), lines.halves(by).view(np.int64)
            ends = np.concatenate([np.arange(len(by) + 1), np.full(len(some), len(by))]) * HALVES
            columns = [
                pa.concat_arrays([_long(whole[by]), spare]),
                pa.concat_arrays([pa.nulls(len(by), pa.int64()), _long(texts[some])]),
                _long(np.concatenate([keys[by], texts[some]])),
                _long(np.concatenate([lines.number[by], -n[some]])),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(halves.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["line", "text", "key", "number", "halves"])

    return rows.mapInArrow(run, "line long, text long, key long, number long, halves array<long>")


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers from each ``low`` to its ``high``, one range behind the other."""
    size = high - low
    return np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size)


def _variants(n: np.ndarray, flags: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places to leave out of lines of ``n`` words, by kind as (number of the line, place).

    0, a word changed within the half that isn't shared: both lines leave out the same place,
    which is kept in the key. 1, a word too many: only the longer line leaves one out, without
    its place, the other is taken whole.
    """
    m, less = n // 2, (n - 1) // 2
    out = []
    for first, second, low, high in ((1, 2, m, m), (4, 8, less, less + 1)):
        # the halves that are shared tell in which there may be a difference
        low = np.where(flags & second, 0, low)
        high = np.where(flags & first, n, np.where(flags & second, high, low))
        out.append((np.repeat(np.arange(len(n)), high - low), _ranges(low, high)))
    return out


def _neighbourhoods(rows: DataFrame) -> DataFrame:
    """Variants of the lines asked for (``asked``: numbers and which halves are shared): of kind 0 and 1 those of
    ``_variants``, of kind 2 lines taken whole and, of kind 3, their words."""

    def run(batches):
        T.return_memory()
        for batch, data, offsets in T.unpacked(batches, limit=CHUNK_BYTES):
            asked = batch.column("asked")
            number, flags = (x.to_numpy() for x in asked.flatten().flatten())
            if not len(number):
                continue
            lines = Lines(data, offsets)
            # lines are in order of text and number
            width = max(int(number.max()), int(lines.number.max())) + 1
            row = np.repeat(np.arange(len(batch)), asked.value_lengths().to_numpy())
            line = np.searchsorted(lines.owner * width + lines.number, row * width + number)
            (changed, place), (longer, extra) = _variants(lines.n[line], flags)
            changed, longer, whole = line[changed], line[longer], line[flags & 3 != 0]
            a, b, n = lines.first[:-1], lines.first[1:], lines.n
            fps = [
                _salted(lines.without(a[changed], b[changed], a[changed] + place) + T.mixed(place.astype(np.uint64)), n[changed], 3),
                _salted(lines.without(a[longer], b[longer], a[longer] + extra), n[longer] - 1, 4),
                _salted(lines.part(a[whole], b[whole]), n[whole], 4),
                np.zeros(len(line), np.uint64),
            ]
            fp, at = np.concatenate(fps), np.concatenate([changed, longer, whole, line])
            kind = np.repeat(np.arange(4), [len(changed), len(longer), len(whole), len(line)])
            words = pa.array([lines.words[i:j].tobytes() for i, j in zip(a[line].tolist(), b[line].tolist(), strict=True)], pa.binary())
            keys = batch.column("key").to_numpy()[lines.owner[at]]
            columns = [_long(fp), pa.array(kind), pa.array(keys), pa.array(lines.number[at]), pa.concat_arrays([pa.nulls(len(at) - len(line), pa.binary()), words])]
            yield pa.RecordBatch.from_arrays(columns, names=["fp", "kind", "key", "number", "words"])

    return rows.mapInArrow(run, "fp long, kind long, key long, number long, words binary")


def one_apart(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether at most one word inserted, left out or changed turns one sequence into the other."""
    if abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    same = np.flatnonzero(a[:short] != b[:short])
    if not len(same):
        return True
    i = int(same[0])
    if len(a) == len(b):
        return np.array_equal(a[i + 1 :], b[i + 1 :])
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return np.array_equal(a[i + 1 :], b[i:])


def _verified(pairs: DataFrame) -> DataFrame:
    """Of pairs of a line and an earlier one with their words, the line, where they are one word apart."""

    def run(batches):
        T.return_memory()
        for batch in batches:
            a, b = ([np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("words", "other"))
            ok = pa.array([one_apart(x, y) for x, y in zip(a, b, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("key").filter(ok), batch.column("number").filter(ok)], names=["key", "number"])

    return pairs.select("key", "number", "words", "other").mapInArrow(run, "key long, number long")


def _firsts(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places of the first of equal lines, with the rows of texts; and by key those that share a half with another line, with what they share."""
    first = lines.groupBy("line", "text").agg(F.min(F.struct("key", "number", "halves")).alias("m")).select("line", "m.*")
    first = materialise(first, "first-lines")
    half = first.select("line", "key", "number", F.posexplode("halves").alias("which", "half")).where("half <> 0")
    common = half.groupBy("half").agg(F.min("line").alias("low"), F.max("line").alias("high")).where("low <> high").select("half")
    half = half.drop("line")
    flag = F.sum(F.expr("shiftleft(1, which)")).cast("int")
    asked = half.join(common, "half").groupBy("key", "number").agg(flag.alias("flags"))
    return first.select("key", "number"), asked.groupBy("key").agg(F.collect_list(F.struct("number", "flags")).alias("asked"))


def fewer_lines(rows: DataFrame) -> DataFrame:
    """Each ``key`` in ``rows`` (key, text) of a text that loses lines, with the numbers (``kept``) of those of its lines of LEAST words and more that stay."""
    rows = rows.select("key", "text")
    first, asked = _firsts(_lines(rows))
    asked = materialise(asked, "shared-halves")
    # shuffled even where the join broadcasts: two functions in one task would hold two workers of each core
    packed = T.compressed(rows, key="key", wanted=T.key_filter(asked, "key")).repartition("key")
    found = materialise(_neighbourhoods(packed.join(asked, "key")), "neighbourhoods")
    place = F.struct("key", "number")
    words = found.where("kind = 3").select(place.alias("place"), "words")
    variants = found.where("kind < 3").select("fp", "kind", place.alias("place"))
    # lines that leave out the same place: each is one word from the first of them
    changed = variants.where("kind = 0")
    least = changed.groupBy("fp").agg(F.min("place").alias("earlier"), F.max("place").alias("last")).where("earlier <> last")
    changed = changed.join(least.select("fp", "earlier"), "fp").where("earlier < place").select("place", "earlier")
    # a line taken whole and those that are it with one word more
    longer = variants.where("kind = 1").select("fp", "place")
    whole = variants.where("kind = 2").select("fp", F.col("place").alias("other"))
    inserted = longer.join(whole, "fp").select(F.greatest("place", "other").alias("place"), F.least("place", "other").alias("earlier"))
    pairs = changed.unionAll(inserted).distinct()
    pairs = pairs.join(words, "place").join(words.select(F.col("place").alias("earlier"), F.col("words").alias("other")), "earlier")
    near = _verified(pairs.select(F.col("place.key").alias("key"), F.col("place.number").alias("number"), "words", "other"))
    # a text's row has the number of its lines less than 0
    every = first.withColumn("near", F.lit(None).cast("long")).unionAll(near.select("key", F.lit(None).cast("long"), "number"))
    stay = F.array_except(F.collect_list(F.expr("if(number >= 0, number, null)")), F.collect_set("near"))
    fewer = every.groupBy("key").agg((-F.min("number")).alias("n"), stay.alias("kept")).where(F.col("n") > F.size("kept")).select("key", "kept")
    fewer = materialise(fewer, "fewer-lines")
    discard(first, asked, found)
    return fewer


def _cut(data: np.ndarray, offsets: np.ndarray, begin: np.ndarray, end: np.ndarray, owner: np.ndarray, valid: pa.Array) -> pa.Array:
    """The texts without the lines from ``begin`` to ``end`` of the text ``owner``; null where not ``valid``."""
    upto = offsets[1:][owner]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[begin] += 1
    # a line goes with the feed behind it
    edge[np.minimum(end + 1, upto)] -= 1
    stay = np.cumsum(edge[:-1], dtype=np.int8) == 0
    # a text whose last line goes ends before the feed behind the last one that stays
    cut = end == upto
    passed = np.append(0, np.cumsum(stay))
    low, high = offsets[:-1][owner[cut]], upto[cut]
    some = passed[high] > passed[low]
    stay[np.flatnonzero(stay)[passed[high[some]] - 1]] = False
    left = np.append(0, np.cumsum(stay))[offsets]
    bits = pa.array(np.zeros(len(valid), np.int8), mask=~valid.to_numpy(zero_copy_only=False)).buffers()[0]
    return pa.Array.from_buffers(pa.string(), len(valid), [bits, pa.py_buffer(left.astype(np.int32)), pa.py_buffer(data[stay])])


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every column of ``docs`` with the lines that stay as text, and ``n_lines``, ``n_removed``.

    A line goes if one before it (in a document with a smaller id, or earlier in the same
    one) has the same words or, of two lines with NEAR words or more, is one word inserted, left out or
    changed away. A line of fewer than NEAR words and LEAST_CHARACTERS characters or more is compared,
    with others of that kind, by its characters without white space: equal ones go, and of lines with
    NEAR_CHARACTERS or more those one character apart. Lines are judged on the input, so a line may go for one that goes
    itself. Words are lower-cased and split at white space. Other lines of fewer than LEAST words, blank
    ones among them, always stay. ``n_lines`` counts lines with a word. A null text
    stays null and has none; rows with equal or null ids count as documents of their own,
    so of repeated rows the first keeps its lines. Columns of ``docs`` named like the two counts are replaced.
    """
    rows, key = T.numbered(docs.drop("n_lines", "n_removed"), id_col, text_col)
    rows = rows.withColumn(text_col, F.col(text_col).cast("string"))
    fewer = fewer_lines(rows.select(F.col(key).alias("key"), F.col(text_col).alias("text"))).withColumnRenamed("key", key)
    # documents that lose no line needn't meet their numbers: a filter of the others' keys parts them
    bits = T.key_filter(fewer, key)
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    schema = rows.select(*columns, F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed")).schema
    spare = "_" * (1 + max(map(len, rows.columns)))
    names, slot = ("n_bytes" + spare, "packed" + spare), "slot" + spare
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def whole(batches):
        T.return_memory()
        at = len(columns)
        for batch in batches:
            batch = batch.filter(pa.array(~T.held(shared.value, batch.column(at).to_numpy())))
            for part, data, offsets in T.chunks([batch], text_col, CHUNK_BYTES):
                lines = with_words(data, offsets)
                yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array(lines, pa.int64()), pa.array(np.zeros(len(part), np.int64))], names=[*columns, "n_lines", "n_removed"])

    untouched = rows.select(*columns, T.key_slot(key).alias(slot)).mapInArrow(whole, schema)
    packed = T.compressed(rows, text_col, names, key, bits).repartition(key).join(fewer.withColumnRenamed("kept", "kept" + spare), key, "left")

    def run(batches):
        T.return_memory()
        for batch, data, offsets in T.unpacked(batches, names, CHUNK_BYTES):
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            lines = Places(data, offsets)
            kept = column("kept" + spare)
            counts = np.bincount(lines.owner, minlength=len(batch))
            # rows without a list were let through by the filter only
            listed = kept.is_valid().to_numpy(zero_copy_only=False)
            numbers = kept.flatten().to_numpy()
            width = max(int(lines.number.max(initial=0)), int(numbers.max(initial=0))) + 1
            stay = np.repeat(np.arange(len(batch)), kept.value_lengths().fill_null(0).to_numpy()) * width + numbers
            gone = np.flatnonzero((lines.n >= LEAST) & listed[lines.owner])
            gone = gone[~np.isin(lines.owner[gone] * width + lines.number[gone], stay)]
            removed = np.bincount(lines.owner[gone], minlength=len(batch))
            out = _cut(data, offsets, lines.begin[gone], lines.end[gone], lines.owner[gone], column(names[1]).is_valid())
            arrays = [out if c == text_col else column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names=[*columns, "n_lines", "n_removed"])

    return untouched.unionAll(packed.mapInArrow(run, schema))

