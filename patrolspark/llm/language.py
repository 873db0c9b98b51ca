"""Language identification by hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs, seeded by its code point.  A
trigram binds three of them: the product of the first turned by two places, the
second turned by one and the third.  A text bundles the trigrams of its words
(letters and their marks in lower case, a blank on both sides): it is the sum of
their vectors.  A language's prototype is the sum over all texts it is learned
from, and a document gets the language whose prototype has the largest cosine
with it.

Texts are bundled many at a time: the counts of the trigrams of each text times
the vectors of these trigrams, a matrix product over ``GRAMS_AT_ONCE`` trigrams
after the other, so memory is bounded for any alphabet; a long text goes in
pieces of ``PIECE`` characters.  All sums are whole numbers and exact, so a rerun
gives the same prototypes in whatever order rows arrive.  The driver sees one
vector a language (``MAX_LANGUAGES`` at most, else an error).

Learned from: documents with a language and a letter that are not held out.
Language and id are never inputs of a prediction.

Defined cases: a null or empty text, or one without a letter, is ``und`` with
score 0, and so is every text when there is nothing to learn from; whole texts of
any length count; a null id is not held out; equal cosines go to the first
language by code point; repeated rows get equal results and are learned from as
often as they come; an empty table gives an empty result; other columns pass
through, and added ones get underscores where the name is taken.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, free_name, small_batches

DIM = 1024
SEED = 42
FOLDS, HELD = 4, 2
UNKNOWN = "und"
MAX_LANGUAGES = 2000
GRAMS_AT_ONCE = 8192
PIECE = 1 << 20
TEXTS_AT_ONCE = 256
_BLANK = 32
_CODES = 0x110000


@lru_cache(maxsize=1)
def _in_words() -> np.ndarray:
    """Whether each code point is part of a word: a letter or a mark."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(_CODES)])


@lru_cache(maxsize=4096)
def _signs(code: int) -> np.ndarray:
    return np.random.default_rng([SEED, code]).integers(0, 2, DIM, dtype=np.int8) * 2 - 1


def _pieces(text: str) -> Iterator[np.ndarray]:
    """Code points of a text in lower case, blanks for what is in no word; pieces overlap by two."""
    if not any(c.isalpha() for c in text):
        return
    text = f" {text.lower()} "
    for a in range(0, len(text) - 2, PIECE):
        codes = np.frombuffer(text[a:a + PIECE + 2].encode("utf-32-le", "surrogatepass"), dtype="<u4").copy()
        codes[~_in_words()[codes]] = _BLANK
        yield codes


def _vectors(first: np.ndarray, middle: np.ndarray, last: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The bound vector of each trigram, given by positions in ``letters``."""
    own = np.stack([_signs(int(c)) for c in letters])
    return np.roll(own, 2, axis=1)[first] * np.roll(own, 1, axis=1)[middle] * own[last]


def bundle(texts: list[str], group: list[int], groups: int) -> np.ndarray:
    """The sum of the trigram vectors of all texts of each group; whole numbers, added up exactly."""
    total = np.zeros((groups, DIM))
    held: list[np.ndarray] = []
    owner: list[int] = []
    size = 0
    for text, g in zip(texts, group, strict=True):
        for piece in _pieces(text):
            held.append(piece)
            owner.append(g)
            size += len(piece)
            if size >= PIECE or len(held) >= TEXTS_AT_ONCE:
                _add(total, held, owner)
                held, owner, size = [], [], 0
    if held:
        _add(total, held, owner)
    return total


def _ranks(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order and the place of each value among them; by a table if it is small."""
    if below > 1 << 24:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(below, dtype=bool)
    seen[values] = True
    found = np.flatnonzero(seen)
    place = np.empty(below, dtype=np.int32)
    place[found] = np.arange(len(found))
    return found, place[values]


def _add(total: np.ndarray, pieces: list[np.ndarray], owner: list[int]) -> None:
    """Add the trigrams of the pieces to the rows of ``total`` that own them."""
    codes = np.concatenate(pieces)
    rows, own = np.unique(owner, return_inverse=True)
    own = np.repeat(own, [len(p) for p in pieces])
    letters, small = _ranks(codes, _CODES)
    middle = codes != _BLANK
    ends = np.cumsum([len(p) for p in pieces])
    middle[ends - 1] = False  # a trigram lies in one piece
    middle[np.r_[0, ends[:-1]]] = False
    at = np.flatnonzero(middle)
    k = len(letters)
    small = small.astype(np.int64)
    gram, which = _ranks((small[at - 1] * k + small[at]) * k + small[at + 1], k ** 3)
    who = own[at]
    for a in range(0, len(gram), GRAMS_AT_ONCE):
        g = gram[a:a + GRAMS_AT_ONCE]
        mine = slice(None) if len(gram) <= GRAMS_AT_ONCE else (which >= a) & (which < a + len(g))
        counts = np.bincount(who[mine] * len(g) + (which[mine] - a), minlength=len(rows) * len(g))
        vectors = _vectors(g // (k * k), g // k % k, g % k, letters)
        # 32-bit floats hold the sums of a PIECE of trigrams exactly
        total[rows] += counts.reshape(len(rows), len(g)).astype(np.float32) @ vectors.astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the id as text, modulo FOLDS, is HELD."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def prototypes(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes, from (text, lang) rows."""
    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            group, langs = pd.factorize(batch["lang"])
            for lang, own in zip(langs, bundle(batch["text"].tolist(), group.tolist(), len(langs)), strict=True):
                sums[lang] = sums.get(lang, 0) + own.astype(np.int64)
            if len(sums) > MAX_LANGUAGES:
                yield pd.DataFrame({"lang": list(sums), "total": list(sums.values())})
                sums.clear()
        if sums:
            yield pd.DataFrame({"lang": list(sums), "total": list(sums.values())})

    parts = rows.mapInPandas(learn, "lang string, total array<long>")
    parts = parts.select("lang", F.posexplode("total").alias("at", "x"))
    parts = parts.groupBy("lang", "at").agg(F.sum("x").alias("x"))
    sums = parts.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))  # DIM elements
    known = sums.select("lang", F.col("v.x").alias("total")).limit(MAX_LANGUAGES + 1).collect()
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    known.sort(key=lambda r: r["lang"])
    total = np.array([r["total"] for r in known], dtype=np.float64).reshape(len(known), DIM)
    length = np.sqrt((total * total).sum(axis=1, keepdims=True))
    return [r["lang"] for r in known], total / np.maximum(length, 1)


def predict(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with held_out, lang_pred and score (the cosine with that prototype, at least 0)."""
    small_batches(docs.sparkSession)
    learn = docs.where(~held_out(col(docs, doc_id)))
    learn = learn.select(col(docs, text).alias("text"), col(docs, lang).alias("lang")).dropna()
    languages, known = prototypes(learn)

    @F.pandas_udf("lang string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = bundle(batch.tolist(), list(range(len(batch))), len(batch))
            length = np.sqrt((x * x).sum(axis=1))
            if not languages:
                length[:] = 0
            cosine = (x / np.maximum(length, 1)[:, None]) @ (known.T if languages else np.zeros((DIM, 1)))
            best = cosine.argmax(axis=1)
            yield pd.DataFrame({"lang": [languages[b] if s else UNKNOWN for b, s in zip(best, length, strict=True)],
                                "score": np.where(length > 0, np.clip(cosine.max(axis=1), 0, 1), 0.0)})

    n = {c: free_name(docs, c) for c in ("held_out", "lang_pred", "score")}
    x = free_name(docs, "__x")
    out = docs.withColumn(x, judge(F.coalesce(col(docs, text), F.lit(""))))
    return out.withColumns({n["held_out"]: held_out(col(docs, doc_id)), n["lang_pred"]: F.col(x)["lang"],
                            n["score"]: F.col(x)["score"]}).drop(x)
