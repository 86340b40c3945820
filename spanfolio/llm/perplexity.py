"""Quality rules: plain counts of a text, and the band of perplexity of its language."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.llm import kneser_ney as K
from spanfolio.llm import text as T
from spanfolio.llm.gathered import gathered
from spanfolio.operators.ranks import elements
from spanfolio.sources.workspace import materialise

ORDER = 5
FEWEST_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 50, 50, 3
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


#: Languages with a model of their own; those of fewer texts beyond them share one.
MODELS = 1 << 15


def _models(rows: DataFrame) -> np.ndarray:
    """The ``language`` of each model, sorted: of the languages with the most texts, which is all of them but for odd tables."""
    sizes = rows.groupBy("language").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "language").limit(MODELS - 1)
    return np.array(sorted(r["language"] for r in most.collect()), np.int64)


def _group(language: np.ndarray, models: np.ndarray) -> np.ndarray:
    """Number of each language's model, from 1; 0 of the one that the rest shares."""
    at = np.searchsorted(models, language)
    known = at < len(models)
    known[known] = models[at[known]] == language[known]
    return np.where(known, at + 1, 0)


def _grams(batch, data, offsets, models):
    """Packed grams of all texts, with the number of each one's text. White space counts as one blank."""
    starts, ends, first = T.words(data, offsets, T.NOT_SPACE)
    lengths = ends - starts
    # a blank before each word, and one at the end
    blank = np.append(np.cumsum(lengths + 1) - lengths - 1, int(lengths.sum()) + len(lengths))
    stream = np.full(int(blank[-1]) + 1, 0x20, np.uint8)
    of_word = np.ones(len(stream), bool)
    of_word[blank] = False
    stream[of_word] = data[T.NOT_SPACE[data]]
    gram = K.packed(stream, ORDER)
    if not len(gram):
        return gram, gram
    # where each text's stream begins; a gram belongs to a text if all its bytes do
    edge = blank[first]
    owner = np.repeat(np.arange(len(batch)), np.diff(edge))[: len(gram)]
    inside = np.ones(ORDER + len(stream), bool)
    for i in range(1, ORDER):
        inside[ORDER + edge[1:] - i] = False
    inside = inside[ORDER:][: len(gram)]
    gram, owner = gram[inside], owner[inside]
    return gram | _group(batch.column("language").to_numpy(), models)[owner] << K.BYTES, owner


def losses(docs: DataFrame, models: np.ndarray) -> DataFrame:
    """Negative log-probability (``value``) of every gram (``key``) of ``docs`` (text, language), by the model of all its texts."""

    def grams(batches):
        for batch, data, offsets in T.chunks(batches):
            yield np.unique(_grams(batch, data, offsets, models)[0], return_counts=True)

    return K.own(K.counted(docs.select("text", "language"), grams), ORDER).select(F.col("gram").alias("key"), (-F.log("p")).cast("float").alias("value"))


def _repeated(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries equal another of the same text, and which of them are not the first."""
    at, which = T.classes(T.mixed(h + owner.astype(np.uint64) * np.uint64(T.MULTIPLIER)))
    first = np.full(len(at), len(which), np.int64)
    np.minimum.at(first, which, np.arange(len(which)))
    later = np.ones(len(which), bool)
    later[first] = False
    return np.bincount(which, minlength=len(at))[which] > 1, later


def _rules(data, offsets) -> dict[str, np.ndarray]:
    """The plain counts of each text."""
    n = len(offsets) - 1
    starts, ends, first = T.words(data, offsets, T.NOT_SPACE)
    summed = lambda flags: np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets]
    inside = T.NOT_SPACE[data]
    out = {
        "n_words": np.diff(first),
        "word_chars": np.diff(summed(inside & (data & 0xC0 != 0x80))),
        "n_symbols": np.diff(summed(SYMBOLS[data])),
    }
    lines, ends_of_lines, first_line = T.words(data, offsets, np.arange(256) != 0x0A)
    has = np.searchsorted(starts, lines) < np.searchsorted(starts, ends_of_lines)
    owner = np.repeat(np.arange(n), np.diff(first_line))[has]
    h = T.span_hashes(data, lines, ends_of_lines)[has]
    out["n_dup_lines"] = np.bincount(owner[_repeated(owner, h)[1]], minlength=n)
    h = T.span_hashes(data, starts, ends)
    window = T.grams(h, REPEAT_WINDOW)
    whole = np.flatnonzero(T.room(first)[: len(window)] >= REPEAT_WINDOW)
    owner = np.repeat(np.arange(n), np.diff(first))
    again = whole[_repeated(owner[whole], window[whole])[0]]
    covered = np.zeros(len(h) + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = np.bincount(owner[np.cumsum(covered)[:-1] > 0], minlength=n)
    return out


def quartiles(scored: DataFrame) -> DataFrame:
    """``language, q1, q2, q3``: the exact losses at a quarter, half and three quarters of a language's texts that have one."""
    part = scored.select("language", "log_loss").where("log_loss is not null")
    sizes = materialise(part.groupBy("language").agg(F.count(F.lit(1)).alias("n")), "sizes")
    out = sizes.select("language")
    for i in (1, 2, 3):
        rank = {f"q{i}": lambda n, i=i: F.ceil(n * i / 4)}
        out = out.join(elements(part, ["language"], "log_loss", rank, sizes=sizes).drop("n"), "language")
    return out


RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_TYPES = "key long, language long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_grams long, log_loss double"


def judged(docs: DataFrame, key: str, text_col: str = "text", lang_col: str = "lang", reach: float = 4.0, short: float = 10.0) -> DataFrame:
    """Plain counts, perplexity and verdict for each row of ``docs``.

    Columns: ``key`` (numbers the rows, see ``text.numbered``), ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``log_loss`` (mean negative log-probability of a byte: the logarithm of the
    perplexity; null without five bytes), ``lower``, ``upper`` (the band of the language) and ``kept``.

    The model counts every text and keeps every gram, as tables. A language's band reaches from its median loss
    ``reach`` times as far as the quarter below and above, exact elements of its losses; both ends widen with
    ``short`` over the root of the words of the text, since a short text varies more. A text
    without loss, and one whose band is a point, is judged by the plain rules alone. Null
    and empty texts have no words and fail; a null language is a language of its own, and so is an empty one. ``MODELS`` - 1 languages
    have a model each (of more, those with the most texts) and the rest one together; every language has its band.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.xxhash64(F.col(lang_col).cast("string")).alias("language"))
    models = _models(rows)

    def asked(piece):
        return T.distinct(_grams(*piece, models)[0])

    def used(piece, values):
        batch, data, offsets = piece
        gram, owner = _grams(batch, data, offsets, models)
        loss = values(gram).astype(np.float64)
        n = np.bincount(owner, minlength=len(batch))
        total = np.bincount(owner, loss, len(batch))
        mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
        rules = _rules(data, offsets)
        columns = [batch.column("key"), batch.column("language"), *(pa.array(rules[c], pa.int64()) for c in RULES), pa.array(n, pa.int64()), mean]
        return pa.RecordBatch.from_arrays(columns, names=["key", "language", *RULES, "n_grams", "log_loss"])

    scored = materialise(gathered(rows, "text", asked, losses(rows, models), used, _TYPES), "losses")
    bands = materialise(quartiles(scored), "bands")
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    wider = F.lit(reach) * (1 + F.lit(short) / F.sqrt(F.greatest("n_words", F.lit(1))))
    out = scored.join(bands, "language", "left").withColumn("base_failed", failed)
    out = out.withColumn("lower", F.col("q2") - wider * (F.col("q2") - F.col("q1")))
    out = out.withColumn("upper", F.col("q2") + wider * (F.col("q3") - F.col("q2")))
    within = F.coalesce((F.col("lower") == F.col("upper")) | F.col("log_loss").between(F.col("lower"), F.col("upper")), F.lit(True))
    return out.select(F.col("key").alias(key), *RULES, "base_failed", "log_loss", "lower", "upper", (~F.col("base_failed") & within).alias("kept"))
