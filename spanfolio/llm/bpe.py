"""Byte-level BPE: encoding by replaying merges over all words of a batch, and decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfolio.llm import text as T

#: White space other than blank and line feed, and white space beside a blank.
_OTHER_SPACE = ["  ", " \n", "\n ", *"\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B))]


def plain(text: str) -> bool:
    """Whether cutting at blanks could part white space wrongly, so that the pattern must see the whole text."""
    return text.endswith(" ") or any(map(text.__contains__, _OTHER_SPACE))


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file with a base64 token and a rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


#: Bytes of a word that is merged with others of its length, round by round; longer ones take ``replay``.
SHORT = 64


class Merges:
    """Ranks as arrays: which two tokens make which third."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for bytes {missing}")
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted(
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        )
        self.keys = np.array([k for k, _ in pairs], np.int64)
        self.made = np.array([r for _, r in pairs], np.int64)
        self.none = max(ranks.values()) + 1
        byte = np.arange(256)
        self.of_bytes = self.of(self.single[byte[:, None]], self.single[byte]).astype(np.int32)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes; ``none`` where it makes none."""
        want = left << 32 | right
        at = np.searchsorted(self.keys, want)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == want, self.made[at], self.none) if len(self.keys) else np.full(want.shape, self.none)

    def rounds(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same as ``replay`` for short words, none of them empty.

        Words of equal numbers of symbols are the rows of one matrix. Every round merges the
        leftmost lowest pair of each row, which then joins the rows with one symbol less.
        """
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = int(lengths.max(initial=1))
        rows, ids, rank = np.zeros(0, np.int64), np.zeros((0, n), np.int32), np.zeros((0, n - 1), np.int32)
        done = []
        for n in range(n, 0, -1):
            own = np.flatnonzero(lengths == n)
            raw = data[begin[own][:, None] + np.arange(n)]
            rows = np.concatenate([rows, own])
            ids = np.concatenate([ids, self.single[raw].astype(np.int32)])
            rank = np.concatenate([rank, self.of_bytes[raw[:, :-1], raw[:, 1:]]])
            if n == 1:
                done.append((rows, ids))
                break
            at = rank.argmin(1)
            least = rank[np.arange(len(rows)), at]
            more = least < self.none
            done.append((rows[~more], ids[~more]))
            rows, ids, rank, at = rows[more], ids[more], rank[more], at[more]
            row = np.arange(len(rows))
            ids[row, at] = least[more]
            stay = np.ones(ids.shape, bool)
            stay[row, at + 1] = False
            ids = ids[stay].reshape(len(rows), n - 1)
            stay = np.ones(rank.shape, bool)
            stay[row, at] = False
            rank = rank[stay].reshape(len(rows), n - 2)
            for side in (at - 1, at):
                some = np.flatnonzero((side >= 0) & (side < n - 2))
                first = side[some]
                rank[some, first] = self.of(ids[some, first].astype(np.int64), ids[some, first + 1])
        for part, found in done:
            lengths[part] = found.shape[1]
        offsets = np.append(0, np.cumsum(lengths))
        out = np.empty(offsets[-1], np.int64)
        for part, found in done:
            out[offsets[part][:, None] + np.arange(found.shape[1])] = found
        return out, offsets

    def replay(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words behind each other, and offsets of each word in them.

        ``waiting`` is the inverted index: for each rank the positions whose pair makes
        that token. Ranks are taken in order; at each, the leftmost such pair of every
        word is merged and only the pairs at its two sides are looked up anew. A second
        occurrence in the same word waits for the next turn, because the first merge may
        have made a pair of lower rank.
        """
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.single[np.frombuffer(b"".join(texts), np.uint8)]
        n = len(ids)
        word = np.repeat(np.arange(len(texts)), lengths)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        after[offsets[1:][lengths > 0] - 1] = -1
        before[offsets[:-1][lengths > 0]] = -1
        rank = np.full(n, self.none, np.int64)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.of(ids[inner], ids[inner + 1])
        alive = np.ones(n, bool)

        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def index(positions: np.ndarray) -> None:
            values = rank[positions]
            positions = positions[values < self.none]
            values = values[values < self.none]
            if not len(values):
                return
            by = np.argsort(values, kind="stable")
            values, positions = values[by], positions[by]
            cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
            lows = [0, *cuts.tolist(), len(values)]
            for r, low, high in zip(values[lows[:-1]].tolist(), lows[:-1], lows[1:], strict=True):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(order, r)
                waiting[r].append(positions[low:high])

        index(inner)
        while order:
            r = heapq.heappop(order)
            found = waiting.pop(r)
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if len(at) > 1:
                owner = word[at]
                first = np.empty(len(at), bool)
                first[0] = True
                np.not_equal(owner[1:], owner[:-1], out=first[1:])
                rest, at = at[~first], at[first]
            else:
                rest = at[:0]
            gone = after[at]
            ids[at] = r
            alive[gone] = False
            rank[gone] = self.none
            follow = after[gone]
            after[at] = follow
            has = follow >= 0
            before[follow[has]] = at[has]
            rank[at] = self.none
            right = at[has]
            rank[right] = self.of(ids[right], ids[follow[has]])
            left = before[at]
            left = left[left >= 0]
            rank[left] = self.of(ids[left], ids[after[left]])
            rest = rest[rank[rest] == r]
            index(np.concatenate([left, right, rest]) if len(rest) else np.concatenate([left, right]))
        kept = np.concatenate([[0], np.cumsum(alive)])
        return ids[alive], kept[offsets]

    def flat(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each distinct piece behind each other (its own token if there is one, else by merges), and offsets."""
        raw = [p.encode() for p in pieces]
        own = np.fromiter((self.ranks.get(b, -1) for b in raw), np.int64, len(raw))
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        lengths = np.ones(len(raw), np.int64)
        made = []
        for way, which in ((self.rounds, (size > 0) & (size <= SHORT)), (self.replay, (size == 0) | (size > SHORT))):
            which = np.flatnonzero(which & (own < 0))
            if len(which):
                ids, cuts = way([raw[i] for i in which.tolist()])
                lengths[which] = np.diff(cuts)
                made.append((which, ids))
        offsets = np.append(0, np.cumsum(lengths))
        ids = np.empty(offsets[-1], np.int32)
        ids[offsets[:-1][own >= 0]] = own[own >= 0]
        for which, found in made:
            chosen = np.zeros(len(raw), bool)
            chosen[which] = True
            ids[np.repeat(chosen, lengths)] = found
        return ids, offsets

    def encode(self, pieces: list[str]) -> dict[str, list[int]]:
        """Ids of each distinct piece."""
        ids, offsets = self.flat(pieces)
        return {p: ids[a:b].tolist() for p, a, b in zip(pieces, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)}


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    return Merges(read_ranks(path))


#: Words between blanks, and bytes of them and their ids, that a worker remembers.
REMEMBERED, REMEMBERED_BYTES = 1 << 19, 1 << 25


class Encoder:
    """Ids of texts. Every distinct word between blanks is split and merged once; those of earlier texts are remembered, up to a bound."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges = merges
        self.split = regex.compile(pattern).findall
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_list(pa.int32()))
        known = range(merges.none)
        self.raw = pa.array([merges.token.get(i) for i in known], pa.large_binary())
        self.decimals = pa.array([b"%d," % i for i in known], pa.large_binary())

    def _pieces(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """Pieces of words, each with a blank before it, and the first one of each word."""
        pieces = self.split(" " + " ".join(words)) if words else []
        first = np.flatnonzero(pc.starts_with(pa.array(pieces, pa.large_string()), " ").to_numpy(zero_copy_only=False))
        if len(first) != len(words):  # by this pattern a piece goes on behind a blank
            each = [self.split(" " + w) for w in words]
            pieces, first = [p for found in each for p in found], np.cumsum([0, *map(len, each)])[:-1]
        return pieces, first

    def _coded(self, head: list[str], words: list[str]) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        """Ids of pieces, and of words behind a blank; every distinct piece is merged once."""
        pieces, first = self._pieces(words)
        distinct = pa.array(head + pieces, pa.large_string()).dictionary_encode()
        ids, cuts = self.merges.flat(distinct.dictionary.to_pylist())
        found = pa.LargeListArray.from_arrays(cuts, ids).take(distinct.indices)
        found = _runs(found, np.concatenate([np.arange(len(head)), len(head) + first, [len(found)]]))
        return found[: len(head)], found[len(head) :]

    def __call__(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Ids of all texts behind each other, and offsets of each text in them."""
        # the head of a text, up to the first blank, and texts that can't be cut at blanks go to the pattern as they are
        whole = [plain(t) for t in texts]
        head = [self.split(t if w else t.partition(" ")[0]) for t, w in zip(texts, whole, strict=True)]
        cut = pc.split_pattern(pa.array(["" if w else t for t, w in zip(texts, whole, strict=True)], pa.large_string()), " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        later = np.ones(bounds[-1], bool)
        later[bounds[:-1]] = False
        words = cut.flatten().filter(pa.array(later)).dictionary_encode()
        at = pc.index_in(words.dictionary, self.words)
        new = words.dictionary.filter(at.is_null())
        units, more = self._coded([p for found in head for p in found], new.to_pylist())
        known, ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, more])
        place = at.fill_null(-1).to_numpy().astype(np.int64)
        place[place < 0] = np.arange(len(self.words), len(known))
        heads = np.fromiter(map(len, head), np.int64, len(head))
        both = np.column_stack([heads, np.diff(bounds) - 1])
        of_head = np.repeat(np.tile([True, False], len(texts)), both.ravel())
        unit = np.empty(len(of_head), np.int64)
        unit[of_head] = np.arange(len(units))
        unit[~of_head] = len(units) + place[words.indices.to_numpy()]
        found = _runs(pa.concat_arrays([units, ids]).take(pa.array(unit)), np.append(0, np.cumsum(both.sum(1))))
        self._remember(known, ids, place)
        return found.values, found.offsets.to_numpy()

    def _remember(self, words: pa.Array, ids: pa.Array, last: np.ndarray) -> None:
        """Go on with these words, or, where they are too many, with the ``last`` ones alone, or none."""
        fits = lambda: len(words) <= REMEMBERED and words.nbytes + ids.nbytes <= REMEMBERED_BYTES
        if not fits():
            words, ids = words.take(pa.array(last)), ids.take(pa.array(last))
        if not fits():
            words, ids = words[:0], ids[:0]
        self.words, self.ids = words, ids


def _runs(lists: pa.LargeListArray, offsets: np.ndarray) -> pa.LargeListArray:
    """Each run of lists as one."""
    bounds = lists.offsets.to_numpy()[offsets]
    return pa.LargeListArray.from_arrays(bounds - bounds[0], lists.values.slice(bounds[0], bounds[-1] - bounds[0]))


def _joined(tokens: pa.LargeBinaryArray, ids: pa.Array, offsets: np.ndarray) -> pa.LargeBinaryArray:
    """The bytes that stand for ids behind each other, for each text."""
    each = tokens.take(ids)
    _, starts, data = each.buffers()
    bounds = np.frombuffer(starts, np.int64)[each.offset :][offsets]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), data or pa.py_buffer(b"")])


def _digests(texts: pa.LargeBinaryArray, end: int = 0) -> pa.Array:
    """SHA-256 of each text without the last ``end`` bytes."""
    _, bounds, data = texts.buffers()
    bounds, data = np.frombuffer(bounds, np.int64).tolist(), memoryview(data)
    return pa.array([hashlib.sha256(data[a : max(a, b - end)]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.string())


@lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str) -> Encoder:
    return Encoder(merges_of(path), pattern)


SCHEMA = "n_tokens long, token_ids array<int>, decoded binary"


def encoded(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", digest: bool = False, batch_chars: int = 1 << 21
) -> DataFrame:
    """Every column of ``docs`` with the ids of its whole text and the text decoded from them.

    Adds ``n_tokens`` and ``token_ids`` (array of int), ``decoded`` (binary: the bytes of
    the ids' tokens). With ``digest`` it adds ``ids_sha256`` and ``decoded_sha256``
    instead of the last two. Columns of ``docs`` with these names are replaced. A null
    text counts as empty and has no tokens; texts are never cut. Texts are taken
    ``batch_chars`` bytes at a time, one text at least, and go from words to ids as flat arrays;
    ids of words are remembered from one such part to the next. Nothing is shuffled.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["n_tokens", "token_ids", "decoded"]
    kept = docs.drop(*added)
    types = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else SCHEMA
    schema = kept.select("*", *(F.lit(None).cast(t).alias(c) for c, t in (x.split(" ") for x in types.split(", ")))).schema

    def run(batches):
        T.return_memory()
        encoder = encoder_of(path, pattern)
        for part, _, _ in T.chunks(batches, text_col, batch_chars):
            texts = [t or "" for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
            ids, offsets = encoder(texts)
            bytes_of = _joined(encoder.raw, ids, offsets)
            if digest:
                out = [_digests(_joined(encoder.decimals, ids, offsets), 1), _digests(bytes_of)]
            else:
                out = [pa.ListArray.from_arrays(offsets.astype(np.int32), ids), bytes_of.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(offsets)), *out], names=[*part.schema.names, *added])

    return kept.mapInArrow(run, schema)


def decoded(docs: DataFrame, path: str, ids_col: str = "token_ids") -> DataFrame:
    """Every column of ``docs`` and ``decoded``: the bytes of the tokens of the ids (null ids: none)."""
    kept = docs.drop("decoded")

    def run(batches):
        token = merges_of(path).token
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            out = [b"".join([token[i] for i in x or ()]) for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return kept.mapInArrow(run, kept.select("*", F.lit(None).cast("binary").alias("decoded")).schema)
