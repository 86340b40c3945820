"""BPE with word ends: encoding by batched merge rounds over flat arrays, and decoding.

A vocabulary file (JSON of the tokenizers library) states what happens to a text: the
special strings are cut out, the rest is brought to NFC and lower case, cut into pieces
by a pattern, and white space goes. A piece is its UTF-8 bytes, each byte written as one
printable character, the last one marked as the end of a word; pairs are then merged in
the order of the file.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space that always parts words; the other kinds are left to the file's pattern.
WORDS = re.compile("[^\x20\x09-\x0d]+")
#: Pieces of more symbols than this merge wherever a pair is the least nearby, others once a round.
SHORT = 48
#: Distinct words whose ids a task remembers, and symbols that one merge round works on.
REMEMBERED, ROUND_SYMBOLS = 200_000, 1 << 21

# Letters and numbers (first and last code point) and lower-case forms (first and
# last code point, distance) of Unicode 16 and 17 that the tokenizers library knows and Python's tables don't.
LATER_LETTERS = """1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d40-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b-1138b
1138e-1138e 11390-113b5 113b7-113b7 113d1-113d1 113d3-113d3 116d0-116e3 11bc0-11be0 11bf0-11bf9 13460-143fa 16100-1611d
16130-16139 16d40-16d6c 16d70-16d79 18cff-18cff 1ccf0-1ccf9 1e5d0-1e5ed 1e5f0-1e5fa"""
LATER_LOWER = "1c89-1c89+1 a7cb-a7cb-42343 a7cc-a7cc+1 a7ce-a7ce+1 a7d2-a7d2+1 a7d4-a7d4+1 a7da-a7da+1 a7dc-a7dc-42561 10d50-10d65+32 16ea0-16eb8+27"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def lowered(text: str) -> str:
    """Lower case of each character by itself: a sigma at the end of a word is like any other."""
    if text.isascii():
        return text.lower()
    table, later = _later_lower()
    text = "σ".join(part.lower() for part in text.split("Σ"))
    return text.translate(table) if later(text) else text


def normalised(text: str) -> str:
    return lowered(unicodedata.normalize("NFC", text))


@lru_cache(maxsize=1)
def _later_lower() -> tuple[dict[int, int], Callable]:
    """The later lower-case forms, and a search for characters that have one."""
    rows = [re.fullmatch(r"(\w+)-(\w+)([+-]\d+)", x).groups() for x in LATER_LOWER.split()]
    table = {c: c + int(by) for first, last, by in rows for c in range(int(first, 16), int(last, 16) + 1)}
    return table, re.compile("[" + "".join(map(chr, table)) + "]").search


@lru_cache(maxsize=1)
def unknown_letters() -> re.Pattern:
    """Letters and numbers that the ``regex`` module knows and the tokenizers library doesn't: those of later Unicode versions."""
    known = {c for first, last in (x.split("-") for x in LATER_LETTERS.split()) for c in range(int(first, 16), int(last, 16) + 1)}
    found = regex.compile(r"[\p{L}\p{N}]").match
    points = np.array([c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn" and c not in known and found(chr(c))], np.int64)
    cuts = np.flatnonzero(np.diff(points) > 1)
    spans = zip(points[np.r_[0, cuts + 1]].tolist(), points[np.r_[cuts, len(points) - 1]].tolist(), strict=True) if len(points) else []
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in spans) + "]" if len(points) else "(?!)")


class Vocabulary:
    """Tokens, sorted keys of the pairs that merge, and the steps before them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        splits, level = spec["pre_tokenizer"]["pretokenizers"]
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        if (model["type"], steps, level["type"], splits["behavior"], splits["invert"], spec["decoder"]) != ("BPE", ["NFC", "Replace", "Lowercase"], "ByteLevel", "Removed", True, None):
            raise ValueError(f"{path} asks for steps that aren't known here")
        self.end = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.findall = regex.compile(splits["pattern"]["Regex"]).findall
        shown = byte_characters()
        self.inner = np.array([vocab[c] for c in shown], np.int64)
        self.last = np.array([vocab[c + self.end] for c in shown], np.int64)
        self.names = {i: t for t, i in (vocab | self.special).items()}
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order
        self.none = len(pairs)
        self.longest = max((len(t.removesuffix(self.end)) for t in vocab), default=1)
        # a merge that uses a token comes after the one that makes it: merges of one rank don't disturb each other
        first = np.full(max(vocab.values()) + 1, -1, np.int64)
        first[self.made] = np.arange(self.none)
        if len(np.unique(self.made)) < self.none or (first[keys >> 32] >= np.arange(self.none)).any() or (first[keys & 0xFFFFFFFF] >= np.arange(self.none)).any():
            raise ValueError(f"{path} has a token that two merges make, or a merge before its parts")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in the order of merges, ``none`` if it isn't one: a binary search over the sorted keys."""
        want = left << 32 | right
        at = np.searchsorted(self.keys, want)
        at[at == self.none] = 0
        return np.where(self.keys[at] == want, self.rank[at], self.none) if self.none else np.zeros(len(want), np.int64)

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of every piece (one byte at least): the symbols of all of them lie in one flat array."""
        out: list[list[int]] = [[]] * len(pieces)
        for long in (False, True):
            some = [i for i, p in enumerate(pieces) if (len(p) > SHORT) == long]
            first, size = 0, 0
            for stop in range(1, len(some) + 1):
                size += len(pieces[some[stop - 1]])
                if stop == len(some) or size + len(pieces[some[stop]]) > ROUND_SYMBOLS:
                    part = some[first:stop]
                    for i, ids in zip(part, self._rounds([pieces[i] for i in part], long), strict=True):
                        out[i] = ids
                    first, size = stop, 0
        return out

    def _rounds(self, pieces: list[bytes], long: bool) -> list[list[int]]:
        """Merge rounds until no piece has a pair left to merge.

        In a round a short piece merges its pair of lowest rank, at all its places. A long
        one merges every pair that is the lowest of those within ``longest`` symbols on both
        sides: what merges earlier elsewhere makes tokens of at most that many symbols, so it
        can't reach such a pair first. Pieces that are done leave the array.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ids = self.inner[raw]
        ends = np.cumsum(sizes)
        ids[ends - 1] = self.last[raw[ends - 1]]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = self._pair_ranks(ids, owner)
        while len(ids):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(ids)])
            least = np.minimum.reduceat(rank, starts)
            ready = least == self.none
            if ready.any():
                gone = np.repeat(ready, sizes)
                done.append((owner[gone], ids[gone]))
                ids, owner, rank = ids[~gone], owner[~gone], rank[~gone]
                sizes, least = sizes[~ready], least[~ready]
                if not len(ids):
                    break
            at = self._least_nearby(ids, rank) if long else np.flatnonzero(rank == np.repeat(least, sizes))
            at = self._apart(at, rank)
            ids[at] = self.made[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            # only the pairs at both sides of a merge are looked up anew
            new = np.zeros(len(ids), bool)
            new[at] = True
            ids, owner, rank, new = ids[keep], owner[keep], rank[keep], new[keep]
            new[:-1] |= new[1:]
            touched = np.flatnonzero(new)
            rank[touched] = self._pair_ranks(ids, owner, touched)
        owner = np.concatenate([o for o, _ in done]) if done else np.zeros(0, np.int64)
        ids = np.concatenate([i for _, i in done]) if done else owner
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(pieces) + 1)).tolist()
        flat = ids[order].tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _pair_ranks(self, ids: np.ndarray, owner: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Rank of the pair of each symbol (or those at ``at``) and the next one of its piece."""
        at = np.arange(len(ids)) if at is None else at
        out = np.full(len(at), self.none, np.int64)
        inside = np.flatnonzero(at < len(ids) - 1)
        inside = inside[owner[at[inside]] == owner[at[inside] + 1]]
        out[inside] = self.ranks(ids[at[inside]], ids[at[inside] + 1])
        return out

    def _least_nearby(self, ids: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Pairs of the lowest rank within ``longest`` symbols; runs of one symbol only as a whole."""
        reach = self.longest
        padded = np.concatenate([np.full(reach, self.none), rank, np.full(reach, self.none)])
        low, size = padded, 1
        while size * 2 <= 2 * reach + 1:
            low, size = np.minimum(low[: len(low) - size], low[size:]), size * 2
        width = 2 * reach + 1 - size
        low = np.minimum(low[: len(rank)], low[width : width + len(rank)])
        fit = (rank == low) & (rank < self.none)
        same = np.flatnonzero((rank[1:] == rank[:-1]) & (rank[1:] < self.none))
        if len(same):  # where such a run is cut depends on its first symbol, however far
            begin = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
            fit &= np.repeat(np.logical_and.reduceat(fit, begin), np.diff(np.r_[begin, len(rank)]))
        return np.flatnonzero(fit)

    @staticmethod
    def _apart(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Of places in a row, which share symbols, the first, third and so on."""
        if len(at) < 2:
            return at
        begin = np.r_[True, at[1:] != at[:-1] + 1]
        first = at[np.flatnonzero(begin)][np.cumsum(begin) - 1]
        return at[(at - first) % 2 == 0]

    def pieces(self, text: str) -> list[bytes]:
        """Pieces of a normalised text without special strings."""
        if text.isascii() or not unknown_letters().search(text):
            return [p.encode() for p in self.findall(text)]
        cuts, at = [], 0  # stand-ins of no class show where to cut
        for p in self.findall(shown := unknown_letters().sub("\ue000", text)):
            at = shown.index(p, at) + len(p)
            cuts.append(text[at - len(p) : at].encode())
        return cuts

    def around_special(self, word: str) -> list[int | bytes]:
        """Ids of the special strings in a word, and the pieces between them."""
        out: list[int | bytes] = []
        at = 0
        for m in self.cut.finditer(word):
            out += [*self.pieces(normalised(word[at : m.start()])), self.special[m.group()]]
            at = m.end()
        return out + self.pieces(normalised(word[at:]))

    def encode(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of distinct words without white space; every distinct piece is merged once."""
        words = list(words)
        joined = "\n".join(words)
        special = [w for w in words if self.cut.search(w)] if self.cut is not None and self.cut.search(joined) else []
        if special:
            joined = "\n".join(words := list(set(words).difference(special)))
        # letters alone are one piece
        shown = normalised(joined).split("\n") if words else []
        parts: dict[str, list[int | bytes]] = {w: [s.encode()] if s.isalpha() else self.pieces(s) for w, s in zip(words, shown, strict=True)}
        parts.update((w, self.around_special(w)) for w in special)
        pieces = list(dict.fromkeys(p for found in parts.values() for p in found if p.__class__ is bytes))
        ids = dict(zip(pieces, self.merged(pieces), strict=True))
        whole = lambda found: [i for p in found for i in (ids[p] if p.__class__ is bytes else (p,))]
        return {w: ids[found[0]] if len(found) == 1 and found[0].__class__ is bytes else whole(found) for w, found in parts.items()}


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


def _texts(batch: pa.RecordBatch, name: str) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).cast(pa.string()).to_pylist()]


def encoded(docs: DataFrame, path: str, text_col: str = "text", digest: bool = False, batch_chars: int = 1 << 21) -> DataFrame:
    """Every column of ``docs`` with the ids of its whole text and the text decoded from them.

    Adds ``n_tokens``, ``token_ids`` (array of int) and ``decoded`` (the tokens' names with
    blanks between them). With ``digest`` it adds ``ids_sha256`` (of the decimals with
    blanks between them) and ``decoded_sha256`` instead of the last two. Columns of
    ``docs`` with these names are replaced, all others stay; equal rows give equal
    results. A null text counts as empty; a text without pieces has no tokens and decodes
    to the empty string. Texts are never cut; distinct words of about ``batch_chars``
    characters are merged together, and a task remembers the ids of up to REMEMBERED
    words. Nothing is shuffled, so a lost task is simply run again.
    """
    added = ["n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["token_ids", "decoded"])]
    kept = docs.drop(*added)
    kinds = ("long", "string", "string") if digest else ("long", "array<int>", "string")
    schema = kept.select("*", *(F.lit(None).cast(t).alias(c) for c, t in zip(added, kinds, strict=True))).schema

    def run(batches):
        gc.disable()  # many small lists without cycles
        vocabulary = vocabulary_of(path)
        names = vocabulary.names
        decimals = {i: str(i) for i in names}
        known: dict = {}
        shown: dict = {}

        def learn(words) -> None:
            if len(known) > REMEMBERED:
                known.clear()
                shown.clear()
            for w, ids in vocabulary.encode(words.difference(known)).items():
                known[w] = " ".join(map(decimals.__getitem__, ids)) if digest else ids
                shown[w] = " ".join(map(names.__getitem__, ids))

        for batch in batches:
            for low, high, part in _parts(_texts(batch, text_col), batch_chars):
                found = [WORDS.findall(t) for t in part]
                learn(set().union(*found))
                n, a, b = [], [], []
                for words in found:
                    ids, text = [known[w] for w in words], [shown[w] for w in words]
                    if not all(ids):
                        ids, text = [x for x in ids if x], [x for x in text if x]
                    if digest:
                        joined = " ".join(ids)
                        n.append(joined.count(" ") + 1 if joined else 0)
                        a.append(hashlib.sha256(joined.encode()).hexdigest())
                        b.append(hashlib.sha256(" ".join(text).encode()).hexdigest())
                    else:
                        flat = [i for x in ids for i in x]
                        n.append(len(flat))
                        a.append(flat)
                        b.append(" ".join(text))
                some = batch.slice(low, high - low)
                columns = [pa.array(n, pa.int64()), pa.array(a, pa.string() if digest else pa.list_(pa.int32())), pa.array(b, pa.string())]
                yield pa.RecordBatch.from_arrays([*some.columns, *columns], names=[*some.schema.names, *added])

    return kept.mapInArrow(run, schema)


def _parts(texts: list[str], limit: int):
    """Bounds and texts of slices of about ``limit`` characters, one text at least."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > limit:
            yield first, i, texts[first:i]
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts), texts[first:]


def decoded(docs: DataFrame, path: str, ids_col: str = "token_ids") -> DataFrame:
    """Every column of ``docs`` and ``decoded``: the names of the ids' tokens with blanks between them (null: empty)."""
    kept = docs.drop("decoded")

    def run(batches):
        names = vocabulary_of(path).names
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            out = [" ".join([names[i] for i in x or ()]) for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "decoded"])

    return kept.mapInArrow(run, kept.select("*", F.lit(None).cast("string").alias("decoded")).schema)
