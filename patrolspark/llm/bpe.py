"""Byte-level BPE encoding and decoding in linear time.

Bytes are mapped to Latin-1 characters so that a string automaton can hold the
vocabulary.  A pretokenised piece is walked in longest matches of an
Aho-Corasick automaton, with backtracking: a token may follow another only if
the merges, run on both together, would leave exactly that pair
(``_Vocabulary.compatible``, memoised); if not, the next shorter token is tried,
and no end position is tried twice, which keeps the walk linear.  The result
equals running the merges.

Ids are one binary column of little-endian unsigned 32-bit integers.

Defined cases: a null text counts as empty and has no ids; an empty table gives
an empty result; whole texts of any length are encoded; repeated rows get equal
results; other columns pass through; ids that the vocabulary lacks raise an
error in ``decode``.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, free_name, small_batches

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Bytes that a generation of a task's memory may take, an entry's own cost, and the longest text kept there.
KEPT_BYTES = 48 << 20
ENTRY_BYTES = 232
LONGEST_KEPT = 64
PAIRS_KEPT = 1_000_000
_STOPS = frozenset(".,;:!?")
_IDS_AT_ONCE = 1 << 20
if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("packed ids need a little-endian machine with 4-byte integers")


class _Vocabulary:
    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(t).decode("latin-1"): int(r) for t, r in pairs}
        self.bytes = {r: t.encode("latin-1") for t, r in self.rank.items()}
        self.size = [len(self.bytes.get(r, b"")) for r in range(max(self.bytes) + 1)]
        self.bits = len(self.size).bit_length()
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for t, r in self.rank.items():
            self.automaton.add_word(t, r)
        self.automaton.make_automaton()
        self.longest = max(map(len, self.rank))
        self.prefix = [-1] * len(self.size)
        for t, r in self.rank.items():
            self.prefix[r] = self._longest_prefix(t)
        self.joined: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}
        for r, t in sorted((r, t) for t, r in self.rank.items()):
            self.halves[r] = self._split(r, t)

    def _longest_prefix(self, token: str) -> int:
        return next((self.rank[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in self.rank), -1)

    def _split(self, r: int, token: str) -> tuple[int, int]:
        """The two tokens whose merge makes ``r``; (r, r) for a token that no merge makes."""
        left = self.prefix[r]
        while left >= 0:
            right = self.rank.get(token[self.size[left]:])
            if right is not None and left < r and right < r and self._survives(left, right):
                self.joined[left, right] = r
                return left, right
            left = self.prefix[left]
        return r, r

    def _survives(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes, side by side, end as these two tokens.

        Undo the later of the two last merges again and again: at each border
        in between, a merge across it must not have come first.
        """
        limit = 1 << 40
        while True:
            if self.joined.get((left, right), limit) < limit:
                return False
            for undo_left in ((True, False) if left > right else (False, True)):
                token = left if undo_left else right
                a, b = self.halves[token]
                if a != token:
                    # equal ranks merge from the left, so a right token's own merge may tie
                    limit = token if undo_left else token + 1
                    left, right = (b, right) if undo_left else (left, a)
                    break
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        pair = left << self.bits | right
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            found = self.pairs[pair] = self._survives(left, right)
        return found

    def _longest_match(self, rest: str) -> int:
        """The longest token that ``rest`` begins with; the trie bounds its length."""
        k = self.automaton.longest_prefix(rest)
        token = self.rank.get(rest[:k])
        while token is None:
            k -= 1
            if k <= 0:
                raise ValueError(f"no token for byte {rest[:1]!r}")
            token = self.rank.get(rest[:k])
        return token

    def encode(self, piece: str) -> list[int]:
        """Ids of one piece, given as Latin-1 text of its bytes."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        n, size, prefix, bits, pairs = len(piece), self.size, self.prefix, self.bits, self.pairs
        reach = self.longest
        matched: dict[int, int] = {}
        closed: set[int] = set()  # ends that lead nowhere
        out: list[int] = []
        at, last, token = 0, -1, self._longest_match(piece[:reach])
        while True:
            end = at + size[token]
            if end not in closed:
                if last < 0:
                    fits = True
                else:
                    fits = pairs.get(last << bits | token)
                    if fits is None:
                        fits = self.compatible(last, token)
                if fits:
                    out.append(token)
                    if end == n:
                        return out
                    at, last = end, token
                    token = matched.get(at, -1)
                    if token < 0:
                        token = matched[at] = self._longest_match(piece[at:at + reach])
                    continue
            token = prefix[token]
            if token < 0:
                closed.add(at)
                token = out.pop()
                at -= size[token]
                last = out[-1] if out else -1


class _Memory(dict):
    """Remembered values in two generations: a full one becomes the old one, and what is asked for again returns."""

    def __init__(self):
        self.old: dict[str, bytes] = {}
        self.room = KEPT_BYTES

    def __missing__(self, key: str) -> bytes | None:
        value = self.old.get(key)
        if value is None:
            value = self.made(key)
            if value is None or len(key) > LONGEST_KEPT:
                return value
        self.room -= ENTRY_BYTES + len(key) + len(value)
        if self.room < 0:
            self.old = dict(self)
            self.clear()
            self.room = KEPT_BYTES
        self[key] = value
        return value

    def made(self, key: str) -> bytes | None:
        raise NotImplementedError


class _Pieces(_Memory):
    """From a piece of text to its packed ids."""

    def __init__(self, vocabulary: _Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def made(self, piece: str) -> bytes:
        raw = piece if piece.isascii() else piece.encode("utf-8", "surrogatepass").decode("latin-1")
        return array("I", self.vocabulary.encode(raw)).tobytes()


class _Chunks(_Memory):
    """From what stands between two single spaces to the packed ids of space and chunk.

    Under PATTERN a piece always begins at a space between two characters that
    are not white space, so such chunks are encoded apart; letters, with one
    stop at the end or none, need no pattern.  A chunk with white space at an
    end has no entry: its text goes through the pattern as a whole.
    """

    def __init__(self, pieces: _Pieces, find):
        super().__init__()
        self.pieces, self.find = pieces, find

    def made(self, chunk: str) -> bytes | None:
        if chunk.isalpha():
            return self.pieces.made(" " + chunk)
        if chunk[-1:] in _STOPS and chunk[:-1].isalpha():
            return self[chunk[:-1]] + self.pieces[chunk[-1]]
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        return b"".join(map(self.pieces.__getitem__, self.find(" " + chunk)))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> _Vocabulary:
    """The tables of a rank file, built once in each Python worker."""
    return _Vocabulary(path)


@lru_cache(maxsize=2)
def _memory(path: str, pattern: str) -> tuple:
    find = regex.compile(pattern).findall
    pieces = _Pieces(vocabulary(path))
    return find, pieces, _Chunks(pieces, find) if pattern == PATTERN else None


def forget() -> None:
    """Give up what a task has remembered: a worker that waits, or runs other work, holds the tables only."""
    _memory.cache_clear()


def encode_text(text: str, path: str = RANKS, pattern: str = PATTERN) -> bytes:
    """Packed ids of one text."""
    find, pieces, chunks = _memory(path, pattern)
    if chunks is not None and text:
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            packed = list(map(chunks.__getitem__, rest))
            if None not in packed:
                return b"".join(map(pieces.__getitem__, find(first))) + b"".join(packed)
    return b"".join(map(pieces.__getitem__, find(text)))


@lru_cache(maxsize=2)
def _table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes one after the other, and by id where each starts and its length (-1: no token)."""
    tokens = vocabulary(path).bytes
    ids = np.array(sorted(tokens))
    length = np.full(ids.max() + 1, -1, dtype=np.int64)
    length[ids] = [len(tokens[i]) for i in ids.tolist()]
    start = np.zeros(len(length), dtype=np.int64)
    start[ids] = np.cumsum(length[ids]) - length[ids]
    return np.frombuffer(b"".join(tokens[i] for i in ids.tolist()), dtype=np.uint8), start, length


def decode_ids(packed: bytes, path: str = RANKS) -> bytes:
    """The bytes of packed ids; an error for an id that the vocabulary lacks."""
    table, start, length = _table(path)
    out = []
    for a in range(0, len(packed), _IDS_AT_ONCE * 4):
        ids = np.frombuffer(packed[a:a + _IDS_AT_ONCE * 4], "<u4")
        if ids.max() >= len(length) or (length[ids] < 0).any():
            raise KeyError("an id that the vocabulary lacks")
        n = length[ids]
        ends = np.cumsum(n)
        out.append(table[np.repeat(start[ids] - (ends - n), n) + np.arange(ends[-1])].tobytes())
    return b"".join(out)


def encode(docs: DataFrame, text: str = "text", out: str = "ids", path: str = RANKS,
           pattern: str = PATTERN) -> DataFrame:
    """``docs`` with the packed ids of each text in ``out`` (underscores added if taken)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for batch in batches:
                yield pd.Series([encode_text(t, path, pattern) for t in batch], dtype=object)
        finally:
            forget()

    return docs.withColumn(free_name(docs, out), apply(F.coalesce(col(docs, text), F.lit(""))))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str = RANKS) -> DataFrame:
    """``df`` with the bytes that the packed ids stand for in ``out``."""
    small_batches(df.sparkSession)

    @F.pandas_udf("binary")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([decode_ids(b, path) for b in batch], dtype=object)

    return df.withColumn(free_name(df, out), apply(F.coalesce(col(df, ids), F.lit(b""))))


def round_trip(docs: DataFrame, text: str = "text", out: str = "coded", path: str = RANKS,
               pattern: str = PATTERN) -> DataFrame:
    """``docs`` with ``out``: a struct of the packed ids and of the bytes they decode to.

    One trip to Python for both; the bytes come from the ids alone.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("ids binary, decoded binary")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            for batch in batches:
                ids = [encode_text(t, path, pattern) for t in batch]
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object),
                                    "decoded": pd.Series([decode_ids(i, path) for i in ids], dtype=object)})
        finally:
            forget()

    return docs.withColumn(free_name(docs, out), apply(F.coalesce(col(docs, text), F.lit(""))))
