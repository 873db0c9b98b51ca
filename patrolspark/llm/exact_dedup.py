"""Exact dedup by two-pass Bloom filtering (DataFrame functions only).

Pass one hashes every text to two positions of a bit field and keeps, as a
Bloom filter, the positions that two or more rows hit.  Pass two probes that
filter: a row of which one position is missing has no equal anywhere and
passes straight through.  Only the possibly repeated rows shuffle, and those
are compared by the SHA-256 of their normalised text, so false positives of
the filter cost a little shuffle and never a wrong result.

The filter is a table of 4 KB bitmaps, ``bits / 8`` bytes in all.  ``bits``
follows the row count (16 a row) up to ``max_bits``, which bounds what is
broadcast; past that bound more rows count as possibly repeated and the result
stays the same.

Defined cases: a null text counts as empty; an empty table gives an empty
result; a null id sorts after every other id; rows repeated with the same id
and text share one result and ``dedup`` keeps one of them; other columns pass
through untouched whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, apart, col, cut, free_name

BITS_PER_ROW = 16
MAX_BITS = 1 << 30


def normalised(text: Column) -> Column:
    """Text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _filter_bits(rows: int, max_bits: int) -> int:
    return min(max_bits, max(1 << 15, 1 << (max(1, rows) * BITS_PER_ROW - 1).bit_length()))


def _positions(sha: Column, bits: int) -> tuple[Column, Column]:
    """Two positions in 1..bits for a hash."""
    return (F.pmod(F.xxhash64(sha), F.lit(bits)) + 1,
            F.pmod(F.xxhash64(F.lit(1), sha), F.lit(bits)) + 1)


def repeated_filter(hashes: DataFrame, sha: str, bits: int) -> DataFrame:
    """Bloom filter of the positions that two or more rows hit: (bucket, bitmap)."""
    a, b = _positions(col(hashes, sha), bits)
    twice = (hashes.select(F.explode(F.array(a, b)).alias("p"))
             .groupBy("p").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return (twice.groupBy(F.bitmap_bucket_number("p").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap")))


def _probe(df: DataFrame, position: Column, bloom: DataFrame, out: str) -> DataFrame:
    """Adds whether the bit at ``position`` is set; ``bloom`` is at most bits / 8 bytes."""
    key, bucket, bitmap = (free_name(df, x) for x in ("__bucket", "__b", "__bitmap"))
    side = F.broadcast(bloom.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap)))
    df = df.withColumn(key, F.bitmap_bucket_number(position))
    df = df.join(side, F.col(key) == F.col(bucket), "left")
    at = F.bitmap_bit_position(position)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.expr(f"shiftright(`{free_name(df, '__byte')}`, cast(`{free_name(df, '__at')}` % 8 as int)) & 1")
    byte_name, at_name = free_name(df, "__byte"), free_name(df, "__at")
    return (df.withColumn(byte_name, byte).withColumn(at_name, at)
            .withColumn(out, F.coalesce(bit == 1, F.lit(False)))
            .drop(key, bucket, bitmap, byte_name, at_name))


def _flag(df: DataFrame, sha: str, bloom: DataFrame, bits: int, out: str) -> DataFrame:
    """Adds ``out``: the Bloom filter holds both positions of the row's hash."""
    a, b = _positions(col(df, sha), bits)
    one = free_name(df, "__one")
    df = _probe(df, a, bloom, one)
    two = free_name(df, "__two")
    df = _probe(df, b, bloom, two)
    return df.withColumn(out, F.col(one) & F.col(two)).drop(one, two)


def _hashed(df: DataFrame, text: str, sha: str, size: str) -> DataFrame:
    t = col(df, text)
    return df.withColumns({sha: F.sha2(normalised(t).cast("binary"), 256),
                           size: F.char_length(F.coalesce(t, F.lit(""))).cast("long")})


def _winners(rows: DataFrame, sha: str) -> DataFrame:
    """Per hash the row that stays (longest, then smallest id) and the group's size."""
    best = F.min(F.struct(-F.col("size"), F.col("id").isNull(), F.col("id").alias("id")))
    return (rows.groupBy(sha).agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
            .select(F.col(sha).alias("w_sha"), apart(F.col(sha)).alias("w_apart"), F.col("best.id").alias("keep_id"),
                    (-F.col("best.col1")).alias("keep_size"), "group_size"))


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
            max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(col(docs, doc_id).alias("id"), col(docs, text).alias("text"))
    rows = cut(_hashed(rows, "text", "sha", "size").drop("text"))
    bits = _filter_bits(rows.count(), max_bits)
    bloom = repeated_filter(rows, "sha", bits)
    flagged = _flag(rows, "sha", bloom, bits, "maybe")
    alone = flagged.where(~F.col("maybe")).select(
        F.col("id").alias("doc_id"), F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"))
    suspects = flagged.where("maybe").drop("maybe")
    same = (F.col("sha") == F.col("w_sha")) & (apart(F.col("sha")) == F.col("w_apart"))
    judged = suspects.join(_winners(suspects, "sha"), same)
    judged = judged.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        ((F.col("size") == F.col("keep_size")) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"))
    return alone.unionByName(judged)


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
          max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, all columns."""
    sha, size, maybe = (free_name(docs, x) for x in ("__sha", "__size", "__maybe"))
    full = _hashed(docs, text, sha, size)
    narrow = cut(full.select(F.col(sha).alias("sha"), F.col(size).alias("size"),
                             col(full, doc_id).alias("id")))
    bits = _filter_bits(narrow.count(), max_bits)
    bloom = repeated_filter(narrow, "sha", bits)
    winners = _winners(_flag(narrow, "sha", bloom, bits, "maybe").where("maybe"), "sha")
    flagged = _flag(full, sha, bloom, bits, maybe)
    suspects = flagged.where(F.col(maybe))
    w = {c: free_name(docs, f"__{c}") for c in winners.columns}
    winners = winners.select(*[F.col(c).alias(n) for c, n in w.items()])
    kept = (suspects.join(winners, (F.col(sha) == F.col(w["w_sha"])) & (F.col(size) == F.col(w["keep_size"]))
                          & col(suspects, doc_id).eqNullSafe(F.col(w["keep_id"])))
            .dropDuplicates([sha]))
    names = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    return flagged.where(~F.col(maybe)).select(*names).unionAll(kept.select(*names))


ORACLE = r"""
with n as (
  select doc_id, length(coalesce(text, '')) as size,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as t
  from documents),
k as (
  select doc_id, t,
         first_value(doc_id) over w as keep_id,
         count(*) over (partition by t) as group_size,
         row_number() over w as r
  from n
  window w as (partition by t order by size desc, doc_id nulls last))
select doc_id, keep_id, cast(group_size as bigint) as group_size, r = 1 as kept,
       sha256(t) as text_sha256
from k
"""
