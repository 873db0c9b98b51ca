"""SimHash near-dedup with pigeonring filtering.

A fingerprint has 64 bits, cut into ``distance + 1`` segments on a ring.  Two
fingerprints within ``distance`` bits have a segment from which every chain of
l consecutive segments differs in at most l * distance / segments bits (the
pigeonring principle).  For l = 1 that budget is 0: the first segment is equal,
so fingerprints meet in buckets of one segment's value.  Inside a bucket the
longer chains prune candidates before the full Hamming check.  When there are so
many fingerprints that a bucket would hold more than ``BUCKET`` of them on
average, the key takes in the next segment too, with its budget of one
differing bit: the side on which that bit is set also visits the key with it
cleared, so exactly the same pairs are found.

A bucket beyond ``TILE`` rows is cut into tiles that meet pairwise in separate
tasks.  Equal fingerprints are one row from the start, and a task emits one
link a fingerprint at most (a spanning forest), so dense groups stay linear in
what they shuffle.

Defined cases: a null or empty text has fingerprint zero, which links like any
other; texts of fewer words than a shingle hash as a whole; a null id takes part
but is a component's id only if all ids of the component are null; repeated rows
share a component; an empty table gives an empty result; other columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, WORDS, apart, col, cut, free_name, small_batches
from .components import components, forest

SHINGLE = 4
DISTANCE = 4
SEED = 42
BUCKET = 512
TILE = 2048
_STEP = 1 << 16


def fingerprint_of(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the text's word shingles as an unsigned number."""
    words = WORDS.findall(text.translate(UPPER))
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < shingle else map(" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass"), seed) for g in grams), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _STEP):
        block = hashes[at:at + _STEP]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", out: str = "__fingerprint",
                 shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of each text as a signed long in ``out``."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([fingerprint_of(t, shingle) for t in batch], dtype=np.uint64).view(np.int64))

    return docs.withColumn(out, apply(F.coalesce(col(docs, text), F.lit(""))))


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment; the bits of 64 as even as they go."""
    n = distance + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _keys(distance: int, chained: bool) -> Column:
    """Array of (key, probe) of a fingerprint ``fp``: its buckets, probes where chained."""
    def part(segment: tuple[int, int]) -> Column:
        first, bits = segment
        return F.shiftrightunsigned(F.col("fp"), first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))

    segments = _segments(distance)
    own, probes = [], []
    for i, s in enumerate(segments):
        key = F.lit(i << 56).cast("long").bitwiseOR(part(s))
        if chained:
            nxt = segments[(i + 1) % len(segments)]
            second = part(nxt)
            for bit in range(nxt[1]):
                value = F.lit(1 << bit).cast("long")
                seen = second.bitwiseAND(value) != 0
                probe = key.bitwiseOR(F.shiftleft(second.bitwiseXOR(value), s[1]))
                probes.append(F.when(seen, F.struct(probe.alias("key"), F.lit(True).alias("probe"))))
            key = key.bitwiseOR(F.shiftleft(second, s[1]))
        own.append(F.struct(key.alias("key"), F.lit(False).alias("probe")))
    return F.array_compact(F.array(*own, *probes))


def _match(distance: int):
    """Function of sorted bucket rows to the star links of the pairs within ``distance``."""
    segments = _segments(distance)
    ring = [np.uint64(((1 << bits) - 1) << first) for first, bits in segments]
    n = len(ring)

    def chains(x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Positions of XORs that keep every chain budget from their bucket's segment on."""
        left = np.arange(len(x))
        for length in range(2, n):
            mask = np.array([np.bitwise_or.reduce([ring[(s + j) % n] for j in range(length)]) for s in range(n)])
            ok = np.bitwise_count(x[left] & mask[first[left]]) <= length * distance // n
            left = left[ok]
        return left

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        """Links within complete groups of (key, x, y)."""
        fp = rows["fp"].to_numpy().view(np.uint64)
        probe, tile = rows["probe"].to_numpy(), rows["tile"].to_numpy()
        group = rows.groupby(["key", "x", "y"], sort=False).ngroup().to_numpy()
        cross = (rows["x"] != rows["y"]).to_numpy()
        first = (rows["key"].to_numpy() >> 56).astype(np.int64)
        at, off, held = np.arange(len(rows)), 0, []
        a = b = np.zeros(0, dtype=np.int64)
        while True:
            off += 1
            at = at[at + off < len(rows)]
            at = at[group[at] == group[at + off]]
            if not len(at):
                break
            other = at + off
            use = ~(probe[at] & probe[other]) & ~(cross[at] & (tile[at] == tile[other]))
            left, right = at[use], other[use]
            x = fp[left] ^ fp[right]
            keep = chains(x, first[left])
            keep = keep[np.bitwise_count(x[keep]) <= distance]
            held.append((left[keep], right[keep]))
            if sum(len(p) for p, _ in held) > 1 << 20:
                a, b = forest_pairs(fp, [(a, b), *held])
                held = []
        a, b = forest_pairs(fp, [(a, b), *held])
        return pd.DataFrame({"a": fp[a].view(np.int64), "b": fp[b].view(np.int64)})

    def forest_pairs(fp: np.ndarray, parts: list) -> tuple[np.ndarray, np.ndarray]:
        left, right = (np.concatenate(p) for p in zip(*parts, strict=True))
        value, index = np.unique(fp, return_inverse=True)
        at = np.zeros(len(value), dtype=np.int64)
        at[index] = np.arange(len(fp))
        return forest(at, index[left], index[right])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            k = held[["key", "x", "y"]].to_numpy()
            last = np.flatnonzero((k != k[-1]).any(axis=1))
            done = int(last[-1]) + 1 if len(last) else 0
            if done:
                yield whole(held.iloc[:done].reset_index(drop=True))
                held = held.iloc[done:].reset_index(drop=True)
        if held is not None:
            yield whole(held)

    return run


def links(prints: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET, tile: int = TILE) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp`` with the components of all pairs within ``distance``."""
    chained = prints.count() > bucket << min(bits for _, bits in _segments(distance))
    keyed = prints.select("fp", F.explode(_keys(distance, chained)).alias("k")).select("fp", "k.*")
    sizes = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.col("key").alias("s_key"), F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    tiled = keyed.join(sizes, F.col("key") == F.col("s_key"))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("fp"), "tiles").cast("int"))
    tiled = tiled.select("fp", "key", "probe", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o"))
    tiled = tiled.select("fp", "key", "probe", "tile", F.least("tile", "o").alias("x"), F.greatest("tile", "o").alias("y"))
    tiled = tiled.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return tiled.mapInPandas(_match(distance), "a long, b long")


def near_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                 distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = docs.select(col(docs, doc_id).alias("doc_id"), col(docs, text).alias("text"))
    prints = cut(fingerprints(prints, "text", "fp", shingle).drop("text"))
    found = _classes(prints, distance)
    return (prints.join(found, F.col("fp") == F.col("c_fp"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def _classes(prints: DataFrame, distance: int) -> DataFrame:
    """(c_fp, component_id) for every distinct fingerprint of (doc_id, fp)."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    parts = components(links(distinct.select("fp"), distance))
    named = distinct.join(parts, F.col("fp") == F.col("node"), "left")
    named = named.select(F.col("fp").alias("c_fp"), "rep", F.coalesce("component", "fp").alias("part"))
    lowest = named.groupBy("part").agg(F.min("rep").alias("component_id"))
    lowest = lowest.select(F.col("part").alias("l_part"), apart(F.col("part")).alias("o"), "component_id")
    same = (F.col("part") == F.col("l_part")) & (apart(F.col("part")) == F.col("o"))
    return named.join(lowest, same).select("c_fp", "part", "component_id")


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
          distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row, that of the smallest id."""
    key = F.xxhash64(F.coalesce(col(docs, text), F.lit("")))
    prints = docs.select(col(docs, doc_id).alias("doc_id"), col(docs, text).alias("text"), key.alias("key"))
    prints = cut(fingerprints(prints, "text", "fp", shingle).drop("text"))
    judged = prints.join(_classes(prints, distance), F.col("fp") == F.col("c_fp"))
    stay = judged.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("part").agg(
        F.min(F.struct("doc_id", "key")).alias("s")).select("s.*")
    s_id, s_key, own = (free_name(docs, x) for x in ("__stay_id", "__stay_key", "__key"))
    stay = stay.select(F.col("doc_id").alias(s_id), F.col("key").alias(s_key))
    full = docs.withColumn(own, key)
    full = full.join(stay, (F.col(own) == F.col(s_key)) & col(full, doc_id).eqNullSafe(F.col(s_id)))
    return full.dropDuplicates([s_id, s_key]).drop(own, s_id, s_key)
