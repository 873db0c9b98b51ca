"""Mixing sources to target weights by a hypergeometric splitting tree.

Sizes are words.  Each source's documents stand in a seeded random order (by
MD5 of seed and id); the order is cut into ``blocks`` runs of equal word count.
A source's target makes a quota of block draws: whole passes over its blocks
and a part of one more.  The splitting tree halves the output shards again and
again; at every node a multivariate hypergeometric draw deals each source's
quota to the two halves, so every shard ends with an exact number of blocks and
all shards together with exactly each source's quota.  Shards then take
disjoint ranges of the permuted blocks, and each shard is ordered locally.

Positions come from two levels, so no task holds a whole source: documents are
bucketed by hash, bucket totals are summed up per source, and a window runs
inside each bucket.  What reaches the driver is one row a source
(``MAX_SOURCES`` at most, else an error): its total size.

Defined cases: a null text has size 0; a null source is a source, last in
order; a row with a null id stands by a hash of its text and the number of its
copy, so each has a position of its own; rows repeated with the same id,
source and size are taken alike; a table without words has targets 0 and takes
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, col, cut, free_name

MAX_SOURCES = 100_000
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCKS = 1024
SHARDS = 64
PIECE_WORDS = 4_000_000
BUCKET_ROWS = 2000
SEED = 42


def size_in_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


@dataclass
class Source:
    name: str | None
    size: int
    weight: float
    target: float = 0.0
    quota: int = 0


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = SHARE,
            cap: float = CAP) -> list[Source]:
    """Targets by weight, stopped at ``cap`` times a size, the excess reshared."""
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    out = [Source(n, s, weights[i % len(weights)]) for i, (n, s) in enumerate(order)]
    rest, open_ = share * sum(s.size for s in out), list(out)
    while open_:
        total = sum(s.weight for s in open_)
        full = [s for s in open_ if rest * s.weight / total >= cap * s.size]
        if not full:
            for s in open_:
                s.target = rest * s.weight / total
            break
        for s in full:
            s.target = float(cap * s.size)
        rest -= sum(cap * s.size for s in full)
        open_ = [s for s in open_ if s not in full]
    return out


def split(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Block counts per shard and source: the leaves of the splitting tree."""
    leaves: list[np.ndarray] = []

    def node(left: np.ndarray, n: int, path: int) -> None:
        if n == 1:
            leaves.append(left)
            return
        half = n // 2
        total = int(left.sum())
        rng = np.random.default_rng([seed, path])
        take = rng.multivariate_hypergeometric(left, total * half // n, method="marginals") if total else left
        node(take, half, 2 * path)
        node(left - take, n - half, 2 * path + 1)

    node(np.asarray(quotas, dtype=np.int64), shards, 1)
    return np.stack(leaves)


def _plan(spark: SparkSession, sizes, shards: int, blocks: int, seed: int, **how) -> DataFrame:
    """One row a source: its target, block size and the shards' upper draw numbers."""
    plan = targets(sizes, **how)
    for s in plan:
        s.quota = int(np.ceil(s.target * blocks / s.size - 1e-9)) if s.size else 0
    per_shard = split([s.quota for s in plan], shards, seed)
    upper = per_shard.cumsum(axis=0)
    rows = [(s.name, s.size, s.target, [int(x) for x in upper[:, i]]) for i, s in enumerate(plan)]
    return spark.createDataFrame(rows, "p_source string, source_size long, target double, upper array<long>")


def draws(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
          shards: int = SHARDS, blocks: int = BLOCKS, seed: int = SEED, **how) -> DataFrame:
    """``docs`` with size, source_size, target, taken and the shard of each draw.

    The added columns get underscores where ``docs`` already has such a name;
    the mapping is returned by ``draw_names``.
    """
    drawn, hashed, _ = _draw(docs, doc_id, source, text, shards, blocks, seed, **how)
    return drawn.drop(hashed)


def _number_null_ids(docs: DataFrame, i: dict[str, str], text: str, seed: int) -> DataFrame:
    """The rows with a null id, hashed by text and number of the copy.

    Copies are counted inside a partition of the input, and counts of partitions
    are summed up, so no task holds all copies of a text.
    """
    odd = cut(docs.where(F.col(i["id"]).isNull()).withColumns({
        i["words"]: F.md5(F.coalesce(col(docs, text), F.lit("")).cast("binary")), i["at"]: F.monotonically_increasing_id()}))
    odd = odd.withColumn(i["part"], F.shiftright(i["at"], 33))
    heads = odd.groupBy(i["src"], i["words"], i["part"]).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(i["src"], i["words"]).orderBy(i["part"]).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(F.col(i["src"]).alias(i["first"]), F.col(i["words"]).alias(i["until"]),
                         F.col(i["part"]).alias(i["bucket"]), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(i["before"]))
    odd = odd.join(heads, F.col(i["src"]).eqNullSafe(F.col(i["first"])) & (F.col(i["words"]) == F.col(i["until"]))
                   & (F.col(i["part"]) == F.col(i["bucket"])))
    copy = F.col(i["before"]) + F.row_number().over(Window.partitionBy(i["src"], i["words"], i["part"]).orderBy(i["at"]))
    odd = odd.withColumn(i["h"], F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(""), i["words"], copy.cast("string")).cast("binary")))
    return odd.select(*[col(odd, c) for c in docs.columns])


def _draw(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
          shards: int = SHARDS, blocks: int = BLOCKS, seed: int = SEED, **how) -> tuple[DataFrame, str, int]:
    """``draws`` with a column of hashes, its name, and the pieces that keep a shard's parts at PIECE_WORDS or so."""
    n = draw_names(docs)
    i = {x: free_name(docs, f"__{x}") for x in ("h", "bucket", "before", "mid", "until", "src", "id",
                                                "p_source", "upper", "first", "words", "at", "part")}
    docs = docs.withColumns({
        n["size"]: size_in_words(col(docs, text)), i["src"]: col(docs, source), i["id"]: col(docs, doc_id),
        i["h"]: F.md5(F.concat(F.lit(f"{seed}:"), col(docs, doc_id).cast("string")).cast("binary"))})
    slim = [F.col(i["src"]).alias("src"), F.col(i["h"]).alias("h"), F.col(n["size"]).alias("size")]
    narrow = cut(docs.select(*slim))
    if not narrow.where("h is null").isEmpty():
        odd = _number_null_ids(docs, i, text, seed)
        narrow = cut(narrow.where("h is not null").unionAll(odd.select(*slim)))
        docs = docs.where(F.col(i["id"]).isNotNull()).unionAll(odd)
    sums = narrow.groupBy("src").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    known = sums.limit(MAX_SOURCES + 1).collect()
    if len(known) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    spark = docs.sparkSession
    plan = _plan(spark, [(r["src"], r["size"]) for r in known], shards, blocks, seed, **how)
    # The hash space of a source is cut into buckets of about BUCKET_ROWS rows.
    count = spark.createDataFrame([(r["src"], -(-r["rows"] // BUCKET_ROWS)) for r in known],
                                  "c_source string, buckets long")
    plan = plan.join(count, F.col("p_source").eqNullSafe(F.col("c_source"))).drop("c_source")

    def bucket(h: Column) -> Column:
        return F.floor(F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48)) * F.col("buckets"))

    heads = narrow.join(F.broadcast(plan.select("p_source", "buckets")), F.col("src").eqNullSafe(F.col("p_source")))
    heads = heads.groupBy("src", bucket(F.col("h")).alias("b")).agg(F.sum("size").alias("n"))
    before = Window.partitionBy("src").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(F.col("src").alias(i["first"]), F.col("b").alias(i["until"]),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias(i["before"]))

    side = plan.select(F.col("p_source").alias(i["p_source"]), F.col("source_size").alias(n["source_size"]),
                       F.col("target").alias(n["target"]), F.col("upper").alias(i["upper"]), "buckets")
    # plan has one row a source: MAX_SOURCES rows bound both broadcasts
    full = docs.join(F.broadcast(side), F.col(i["src"]).eqNullSafe(F.col(i["p_source"])))
    full = full.withColumn(i["bucket"], bucket(F.col(i["h"]))).drop("buckets")
    full = full.join(heads, F.col(i["src"]).eqNullSafe(F.col(i["first"])) & (F.col(i["bucket"]) == F.col(i["until"])))
    inside = Window.partitionBy(i["src"], i["bucket"]).orderBy(i["h"], i["id"])  # equal rows share a position
    size = F.col(n["size"])
    full = full.withColumn(i["mid"], F.col(i["before"]) + F.sum(size).over(inside) - size / 2)

    def shard_of(epoch: int) -> Column:
        at = F.col(i["mid"]) + epoch * F.col(n["source_size"])
        block = F.floor(F.col(i["mid"]) * blocks / F.col(n["source_size"])) + epoch * blocks
        shard = F.size(F.filter(F.col(i["upper"]), lambda x: x <= block))
        # a block beyond the leaves of all shards is not drawn: the last leaf ends with the quota
        return F.when((size > 0) & (at < F.col(n["target"])) & (shard < shards), shard)

    last = int(np.ceil(how.get("cap", CAP)))
    full = full.withColumn(n["shards"], F.array_compact(F.array(*[shard_of(e) for e in range(last)])))
    full = full.withColumn(n["taken"], size * F.size(n["shards"]))
    words = how.get("share", SHARE) * sum(r["size"] for r in known)
    return full.drop(*(v for k, v in i.items() if k != "h")), i["h"], max(1, int(np.ceil(words / shards / PIECE_WORDS)))


def draw_names(docs: DataFrame) -> dict[str, str]:
    return {x: free_name(docs, x) for x in ("size", "source_size", "target", "taken", "shards")}


def mix(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """The mixture: rows of ``docs`` as often as drawn, dealt to shards and shuffled there.

    A large shard is written by several tasks, each with a random piece of it.
    """
    n = draw_names(docs)
    names = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    shard, order = free_name(docs, "__shard"), free_name(docs, "__order")
    drawn, hashed, pieces = _draw(docs, seed=seed, **how)
    doc_id = col(drawn, how.get("doc_id", "doc_id"))
    drawn = drawn.withColumn(shard, F.explode(n["shards"]))
    drawn = drawn.withColumn(order, F.when(doc_id.isNull(), F.xxhash64(F.lit(seed), F.col(shard), F.col(hashed)))
                             .otherwise(F.xxhash64(F.lit(seed), F.col(shard), doc_id)))
    drawn = drawn.repartition(F.col(shard), F.pmod(F.col(order), F.lit(pieces))).sortWithinPartitions(shard, order)
    return drawn.select(*names)


ORACLE = r"""
with n as (
  select doc_id, source, coalesce(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 0) as size,
         md5('42:' || cast(doc_id as varchar)) as h
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from n group by source),
w as (
  select source, source_size,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end as weight
  from s),
r as (  -- in order of 2 * size / weight, the sources stopped at twice their size come first
  select *, row_number() over o as k,
         1.5::double * (select sum(source_size) from s)
           - 2 * coalesce(sum(source_size) over (o rows between unbounded preceding and 1 preceding), 0) as rest,
         sum(weight) over (o rows between current row and unbounded following) as total
  from w window o as (order by 2.0::double * source_size / weight, source nulls last)),
f as (select k, rest, total from r where rest * weight / total < 2 * source_size order by k limit 1),
t as (
  select r.source, r.source_size,
         case when r.k >= f.k then f.rest * r.weight / f.total else 2.0::double * r.source_size end as target
  from r left join f on true),
p as (
  select n.doc_id, n.size, t.source_size, t.target,
         sum(n.size) over (partition by n.source order by n.h, n.doc_id) - n.size / 2.0::double as mid
  from n join t on n.source is not distinct from t.source)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(size * (case when size > 0 and mid < target then 1 else 0 end
                  + case when size > 0 and mid + source_size < target then 1 else 0 end) as bigint) as taken
from p
"""
