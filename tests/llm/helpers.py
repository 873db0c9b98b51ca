"""Brute-force versions and small frames for the operator tests."""

import hashlib
import re
from collections import Counter

import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use or add, as columns of the caller's table.
CLASHES = ("size", "source_size", "target", "taken", "shards", "score", "predicted", "held_out", "ids", "decoded",
           "host", "path", "rule", "verdict", "sha", "fp", "h", "key", "__sha", "__x", "part", "licenses", "pii", "a.b")


def docs_frame(spark, texts, sources=None, ids=None):
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, "en", (sources or {}).get(i, "s"), len(t or "")) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def components(n, pairs):
    """Smallest index reachable, by union-find."""
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def fingerprint(text, shingle=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    ones = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g.encode(), 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def repeated_words(rows, window=20):
    """doc_id to (n_words, n_removed, kept text), one row after the other."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                gone[i:i + window] = [True] * window
            seen.add(w)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out[doc_id] = (len(words), sum(gone), " ".join(kept))
    return out
