"""Substring dedup by prefix-partitioned suffix trees over words.

A suffix is a word position with the ``WINDOW`` words from there on.  Suffixes
are split into groups by a prefix that is chosen by content: of the
``WINDOW - PREFIX + 1`` short word sequences inside a suffix, the one with the
smallest hash.  Equal suffixes choose equally, and neighbouring suffixes mostly
choose the same place, so a stretch of them travels as one run of words instead
of one by one.  Prefixes that stand in one place only cannot lead to a repeat;
their runs are never shuffled.

Each group becomes a subtree, built top-down: suffixes are parted by their first
word, the parts by the second, and so on, dropping parts with one suffix; the
nodes left at depth ``WINDOW`` are the repeated windows, their leaves the places.
A group with more than ``GROUP`` different runs is too large for that; its
suffixes take the longest prefix instead, all their words, and meet by it.

Equal texts count once (the smallest id stands for them) and equal runs are one
row before they are grouped, so a passage that a third of all documents share
is one row a map task.

A word is removed if it is covered by a window that also starts earlier: in a
document with a smaller id, or earlier in the same one.

Defined cases: a null or empty text has no words; null ids come last in the
order; of rows repeated in full one is judged and the others are copies of it;
texts shorter than a window keep all their words; an empty table gives an empty
result; whole texts are read; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, apart, col, cut, small_batches

WINDOW = 20
PREFIX = 6
GROUP = 20_000
#: Bytes of text that are hashed at once.
BLOCK = 1 << 20
_LAST = (1 << 63) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = 24
_KEY = ["k1", "k2"]


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    up = np.full(n, _BASE, dtype=np.uint64)
    down = np.full(n, pow(int(_BASE), -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return up.cumprod(dtype=np.uint64), down.cumprod(dtype=np.uint64)


def _mixed(g: np.ndarray) -> np.ndarray:
    g = (g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return g ^ (g >> np.uint64(32))


def prefixes(raw: np.ndarray, window: int, prefix: int):
    """Words of UTF-8 bytes, the hash of ``prefix`` words from each, and each window's choice.

    Returns (first byte, end byte) of the words, the hashes, and the place that
    the window from each word chooses: the smallest hash, the first of equals.
    Hashes only bring suffixes together; words are compared where they meet.
    """
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].view(np.int8)))
    first, end = edge[::2], edge[1::2]
    n = len(first) - prefix + 1
    if len(first) < window:
        return first, end, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = 1 << int(len(raw)).bit_length()
    up, down = _powers(max(size, 1 << 21))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    word = _mixed((sums[end] - sums[first]) * down[first])
    g = np.zeros(n, dtype=np.uint64)
    for j in range(prefix):
        g = g * _BASE + word[j:j + n]
    g = _mixed(g)
    span, last = window - prefix + 1, len(first) - window + 1
    if n >= 1 << _PLACE_BITS:
        return first, end, g, np.lib.stride_tricks.sliding_window_view(g, span).argmin(axis=1) + np.arange(last)
    # hash and place in one number: smallest of all windows by doubling
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    low, width = (g & ~mask) | np.arange(n, dtype=np.uint64), 1
    while 2 * width <= span:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    low = np.minimum(low[:last], low[span - width:span - width + last])
    return first, end, g, (low & mask).astype(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _blocks(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of a batch, joined to about BLOCK bytes: rows, first byte of each, all bytes."""
    held, rows, size = [], [], 0
    for i, text in enumerate(batch["text"]):
        raw = text.encode("utf-8", "surrogatepass")
        held.append(raw)
        rows.append(i)
        size += len(raw) + 1
        if size >= BLOCK or i == len(batch) - 1:
            begin = np.cumsum([0] + [len(r) + 1 for r in held[:-1]])
            yield np.array(rows), begin, np.frombuffer(b"\n".join(held), dtype=np.uint8)
            held, rows, size = [], [], 0


def _choices(batch: pd.DataFrame, window: int, prefix: int):
    """Per block: bytes, words, hashes, row and first word of each text, and the windows' choices."""
    for rows, begin, raw in _blocks(batch):
        first, end, g, at = prefixes(raw, window, prefix)
        text = np.searchsorted(begin, first, side="right") - 1
        word0 = np.searchsorted(first, begin)
        whole = np.flatnonzero(text[:len(at)] == text[window - 1:window - 1 + len(at)]) if len(at) else at
        yield rows, raw, first, end, g, text, word0, whole, at[whole]


def _chosen(window: int, prefix: int):
    """(k1, k2, d, c, text) to the chosen prefixes (h, k1, k2, place)."""
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            for rows, _, _, _, g, text, word0, _, at in _choices(batch, window, prefix):
                at = at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at  # choices never go back
                own = text[at]
                yield pd.DataFrame({"h": _signed(g[at]), "k1": k1[rows[own]], "k2": k2[rows[own]],
                                    "place": (at - word0[own]).astype(np.int32)})

    return apply


def _runs(window: int, prefix: int):
    """(k1, k2, d, c, text, places) to runs of suffixes that chose a repeated prefix."""
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k1, k2, d = (batch[c].to_numpy() for c in ("k1", "k2", "d"))
            places = batch["places"].to_list()
            for rows, raw, first, end, g, text, word0, suffix, at in _choices(batch, window, prefix):
                if not len(at):
                    continue
                wanted = np.concatenate([np.asarray(places[r], dtype=np.int64) + word0[i]
                                         for i, r in enumerate(rows)])
                begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                stop = np.r_[begin[1:], len(at)]
                use = np.isin(at[begin], wanted)
                begin, stop = begin[use], stop[use]
                whole = raw.tobytes()
                a, n = suffix[begin], stop - begin
                keys = [xxhash.xxh3_128_digest(b" ".join(whole[x:y].split()))
                        for x, y in zip(first[a].tolist(), end[a + n + window - 2].tolist(), strict=True)]
                own = text[a]
                r = rows[own]
                yield pd.DataFrame({"h": _signed(g[at[begin]]), "run": keys, "k1": k1[r], "k2": k2[r], "d": d[r],
                                    "first": (a - word0[own]).astype(np.int32), "n": n.astype(np.int32)})

    return apply


_RUNS = "h long, run binary, k1 long, k2 long, d long, first int, n int"


def _words(window: int):
    """(k1, k2, d, text, wanted) to the words of the wanted runs."""
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k1, k2, d, text, wanted in zip(*(batch[c] for c in ("k1", "k2", "d", "text", "wanted")), strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                out += [(r["h"], k1, k2, d, r["first"], r["n"],
                         b" ".join(words[r["first"]:r["first"] + r["n"] + window - 1]).decode("utf-8", "surrogatepass"))
                        for r in wanted]
            yield pd.DataFrame(out, columns=["h", "k1", "k2", "d", "first", "n", "words"])

    return apply


def subtree_nodes(group: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Depth-window node of each suffix (row of word numbers), -1 where it is alone.

    All groups are built at once, top-down, one word a level.
    """
    node = np.full(len(group), -1, dtype=np.int64)
    live, part = np.arange(len(group)), np.unique(group, return_inverse=True)[1]
    for depth in range(words.shape[1] + 1):
        count = np.bincount(part)
        keep = count[part] > 1
        live, part = live[keep], part[keep]
        if depth == words.shape[1] or not len(live):
            break
        word = words[live, depth]
        part = np.unique(part * (int(word.max()) + 1) + word, return_inverse=True)[1]
    node[live] = part
    return node


def _repeated(window: int):
    """Complete groups of different runs to the suffixes that start earlier elsewhere."""
    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        words = [w.split(" ") for w in rows["words"]]
        code = pd.factorize(np.array([w for run in words for w in run], dtype=object))[0].astype(np.int64)
        n = rows["n"].to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(rows)), n)
        offset = np.arange(len(row)) - np.repeat(np.r_[0, n.cumsum()[:-1]], n)
        begin = np.r_[0, np.cumsum([len(w) for w in words])[:-1]]
        suffix = code[(begin[row] + offset)[:, None] + np.arange(window)]
        node = subtree_nodes(pd.factorize(rows["h"])[0][row], suffix)
        k1, k2, d = (rows[c].to_numpy()[row] for c in ("k1", "k2", "d"))
        place = rows["first"].to_numpy()[row] + offset
        rank = np.empty(len(row), dtype=np.int64)
        rank[np.lexsort((k2, k1, place, d))] = np.arange(len(row))
        held = node >= 0
        lowest = np.full(int(node.max(initial=0)) + 1, len(row))
        np.minimum.at(lowest, node[held], rank[held])
        at = np.flatnonzero(held)
        at = at[lowest[node[at]] < rank[at]]
        return pd.DataFrame({"k1": k1[at], "k2": k2[at], "first": place[at].astype(np.int32), "n": np.int32(1)})

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            h = held["h"].to_numpy()
            other = np.flatnonzero(h != h[-1])
            if len(other):
                done = int(other[-1]) + 1
                yield whole(held.iloc[:done])
                held = held.iloc[done:].reset_index(drop=True)
        if held is not None:
            yield whole(held)

    return apply


def _judged(window: int):
    """(k1, k2, d, text, spans) to the words that stay."""
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for d, text, spans in zip(batch["d"], batch["text"], batch["spans"], strict=True):
                words = text.encode("utf-8", "surrogatepass").split()  # the same white space as WORD
                n, removed = len(words), []
                if spans is not None:
                    gone = np.zeros(n + 1, dtype=np.int64)
                    for s in spans:
                        gone[s["first"]] += 1
                        gone[s["first"] + s["n"] + window - 1] -= 1
                    stays = gone[:-1].cumsum() == 0
                    edge = np.flatnonzero(np.diff(np.r_[True, stays, True].view(np.int8))).reshape(-1, 2)
                    removed = [{"first": int(a), "last": int(b) - 1} for a, b in edge]
                    words = [w for w, ok in zip(words, stays.tolist(), strict=True) if ok]
                out.append((d, n, n - len(words), removed, b" ".join(words).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(out, columns=["d", "n_words", "n_removed", "removed", "kept"])

    return apply


_SPANS = "array<struct<first:long,last:long>>"
_JUDGED = f"d long, n_words long, n_removed long, removed {_SPANS}, kept string"


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
            prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, removed (spans of words), kept (text)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(col(docs, doc_id).cast("long"), F.lit(_LAST)).alias("d"),
                       F.coalesce(col(docs, text), F.lit("")).alias("text"))
    rows = rows.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})
    # Different texts, one row each; every use below shares this one shuffle of texts.
    texts = rows.groupBy(_KEY).agg(F.min("d").alias("d"), F.count(F.lit(1)).alias("c"), F.first("text").alias("text"))
    all_of = ["k1", "k2", "d", "c", "text"]

    chosen = texts.select(*all_of).mapInPandas(
        _chosen(window, prefix), "h long, k1 long, k2 long, place int")
    often = chosen.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    often = often.select(F.col("h").alias("o_h"), apart(F.col("h")).alias("o"))
    hot = (apart(F.col("h")) == F.col("o")) & (F.col("h") == F.col("o_h"))
    places = chosen.join(often, hot, "left_semi").groupBy(_KEY).agg(F.collect_list("place").alias("places"))
    runs = texts.join(places, _KEY).select(*all_of, "places").mapInPandas(_runs(window, prefix), _RUNS)

    runs = cut(runs)  # keys and places only

    # Different runs, each with its first place and the number of places.
    place = F.struct("d", "first", "k1", "k2", "n")
    different = (runs.groupBy("h", "run").agg(F.min(place).alias("p"), F.count(F.lit(1)).alias("places"))
                 .select("h", "run", "p.*", "places"))
    # A run that stands in several places: all but the first repeat it as a whole.
    first_of = different.where("places > 1").select(
        F.col("h").alias("f_h"), F.col("run").alias("f_run"), apart(F.col("run")).alias("f_o"), F.struct("d", "first", "k1", "k2").alias("f"))
    again = (runs.join(first_of, (apart(F.col("run")) == F.col("f_o")) & (F.col("h") == F.col("f_h"))
                         & (F.col("run") == F.col("f_run")))
             .where(F.struct("d", "first", "k1", "k2") != F.col("f")).select("k1", "k2", "first", "n"))
    # The first place of each run: suffixes that start earlier in another run of its group.
    sizes = different.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    sizes = sizes.select(F.col("h").alias("s_h"), apart(F.col("h")).alias("o"), "c")
    sized = different.join(sizes, (apart(F.col("h")) == F.col("o")) & (F.col("h") == F.col("s_h"))).select("h", "k1", "k2", "first", "n", "c")

    def with_words(some: DataFrame) -> DataFrame:
        wanted = some.groupBy(_KEY).agg(F.collect_list(F.struct("h", "first", "n")).alias("wanted"))
        return texts.join(wanted, _KEY).select(*all_of, "wanted").mapInPandas(
            _words(window), "h long, k1 long, k2 long, d long, first int, n int, words string")

    small = (with_words(sized.where(F.col("c") <= group)).repartition("h").sortWithinPartitions("h")
             .mapInPandas(_repeated(window), "k1 long, k2 long, first int, n int"))
    word = F.split("words", " ")
    large = with_words(sized.where(F.col("c") > group)).select("k1", "k2", "d", "first", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("n")), lambda i: F.md5(F.array_join(F.slice(word, i, window), " ")))).alias("o", "w"))
    large = large.select("w", F.struct("d", (F.col("first") + F.col("o")).alias("first"), "k1", "k2").alias("p"))
    lowest = large.groupBy("w").agg(F.min("p").alias("low")).withColumnRenamed("w", "l_w")
    large = (large.join(lowest, F.col("w") == F.col("l_w")).where("p <> low")
             .select("p.k1", "p.k2", "p.first", F.lit(1).alias("n")))

    spans = (again.unionAll(small).unionAll(large).groupBy(_KEY)
             .agg(F.collect_list(F.struct("first", "n")).alias("spans")))
    judged = texts.join(spans, _KEY, "left").select(*all_of, "spans").mapInPandas(
        _judged(window), _JUDGED)

    # Copies of a text that has come already lose every word, unless they are too short.
    n_words = F.regexp_count("text", F.lit(WORD)).cast("long")
    short = F.when(F.col("n_words") < window, F.array_join(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), " "))
    heads = texts.select(*all_of).where("c > 1").withColumn("n_words", n_words)
    heads = heads.select("k1", "k2", F.col("d").alias("head"), "n_words", F.coalesce(short, F.lit("")).alias("kept"))
    copies = rows.groupBy("k1", "k2", "d").agg(F.count(F.lit(1)).alias("m")).join(heads, _KEY)
    copies = copies.withColumn("m", F.col("m") - (F.col("d") == F.col("head")).cast("long"))
    gone = F.when(F.col("n_words") < window, 0).otherwise(F.col("n_words")).cast("long")
    removed = F.when(gone > 0, F.array(F.struct(F.lit(0), gone - 1))).otherwise(F.array()).cast(_SPANS)
    copies = copies.where("m > 0").select("d", "n_words", gone.alias("n_removed"), removed.alias("removed"), "kept",
                                          F.explode(F.array_repeat(F.lit(0), F.col("m").cast("int")))).drop("col")
    every = judged.unionByName(copies)
    return every.select(F.nullif("d", F.lit(_LAST)).alias("doc_id"), "n_words", "n_removed", "removed", "kept")


ORACLE = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
p as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as j from w),
s as (
  select doc_id, j, string_agg(word, ' ') over o as g, count(*) over o as n
  from p window o as (partition by doc_id order by j rows between current row and 19 following)),
r as (select doc_id, j, row_number() over (partition by g order by doc_id, j) as k from s where n = 20),
gone as (select distinct doc_id, unnest(range(j, j + 20)) as j from r where k > 1),
k as (
  select p.doc_id, count(gone.j) as n_removed,
         string_agg(p.word, ' ' order by p.j) filter (where gone.j is null) as kept
  from p left join gone on p.doc_id = gone.doc_id and p.j = gone.j group by p.doc_id)
select w.doc_id, len(w.ws) as n_words, coalesce(k.n_removed, 0) as n_removed,
       sha256(coalesce(k.kept, '')) as kept_sha256
from w left join k on w.doc_id = k.doc_id
"""
