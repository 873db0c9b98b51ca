"""Embedding near-dedup by sorted projection passes.

A pass hashes every vector to ``BITS`` signs of random projections and orders
all vectors by (label, concatenated signs).  The signs are those of the unit
vectors less their label's mean, so that they also split vectors in a cone.
Near vectors share long prefixes, so each vector is compared with its ``WINDOW``
successors; pairs with cosine at or above the threshold are links, and the links
of all passes are united.

The number of passes is measured for each label.  A sample of its vectors
(``SAMPLE_VALUES`` numbers at most) is sorted by the keys of one pass after the
other; ``PROBES`` of them get a partner at exactly the threshold, half of the
partners towards another vector of the label.  Neighbours that link are united.
Passes are added until all but half of ``1 - RECALL`` of the partners are in
the component of their vector, be it that both met within the sample's share of
a window or that links lead from one to the other: where most vectors of a label
link, one or two passes do.  A label that fits a window takes one pass, which
compares all its pairs.  A label that would take more than ``MOST_PASSES`` takes none:
all its pairs are compared, tile by tile.

The global order is exact and distributed: a range partitioned sort, the row
counts of its partitions (one number a partition on the driver), and blocks of
``BLOCK`` consecutive ranks of which each also holds the first ``WINDOW`` rows
of the next.  A block passes on a spanning forest of its pairs.

Links within a component are then counted exactly: members of a component meet
tile by tile, and each tile returns counts, not pairs.  So a window never loses
a link between two vectors of one component, however dense it is.

Equal vectors with equal labels are one row from the start (they have cosine
1).  Defined cases: a vector that is null, empty, zero or holds null or
non-finite components, and one whose label is null, links with nothing; vectors
of different lengths do not link; a null id is kept, links with nothing and has
a null component; rows repeated in full are equal vectors like any other and
share one result; an id that comes with different vectors is one node of the
links; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, col, cut, runs
from .components import components, forest

THRESHOLD = 0.98
RECALL = 0.999
WINDOW = 1024
BLOCK = 8192
TILE = 2048
BITS = 48
LEAST_PASSES = 4
MOST_PASSES = 256
SAMPLE_VALUES = 1 << 22
PROBES = 8192
LEAST_GAP = 4
SEED = 42


def passes_for(n: int, threshold: float, recall: float, window: int) -> int:
    """Passes until a pair at the threshold has met with probability ``recall``, if every sign halves ``n`` rows."""
    same = 1 - np.arccos(threshold) / np.pi
    meet = same ** max(0.0, np.log2(max(2, n) / window) + 1)
    return max(LEAST_PASSES, int(np.ceil(np.log(1 - recall) / np.log(1 - min(meet, 1 - 1e-9)))))


@lru_cache(maxsize=64)
def _planes(seed: int, p: int, dim: int) -> np.ndarray:
    return np.random.default_rng([seed, p, dim]).standard_normal((dim, BITS))


def _pass_signs(x: np.ndarray, p: int, seed: int = SEED) -> np.ndarray:
    weight = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return (x @ _planes(seed, p, x.shape[1]) > 0) @ weight


def signs(x: np.ndarray, count: int, seed: int = SEED) -> np.ndarray:
    """Sort keys of the rows of ``x`` for each pass: BITS projection signs as one number."""
    out = np.empty((len(x), count), dtype=np.int64)
    for p in range(count):
        out[:, p] = _pass_signs(x, p, seed)
    return out


def _units(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _partners(x: np.ndarray, pick: np.ndarray, threshold: float, rng: np.random.Generator) -> np.ndarray:
    """A unit vector at cosine ``threshold`` from each picked one; every second lies towards another row."""
    own = x[pick]
    way = rng.standard_normal(own.shape)
    way[::2] = x[rng.integers(len(x), size=len(way[::2]))] - own[::2]
    for again in (False, True):
        way -= (way * own).sum(axis=1, keepdims=True) * own
        flat = np.sqrt((way * way).sum(axis=1)) < 1e-6
        if not again:  # towards itself or a copy: any way will do
            way[flat] = rng.standard_normal((flat.sum(), x.shape[1]))
    length = np.sqrt((way * way).sum(axis=1, keepdims=True))
    return threshold * own + np.sqrt(1 - threshold ** 2) * way / np.maximum(length, 1e-300)


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give both ends of each link a-b, and all that is in their components, one label."""
    while True:
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up
        open_ = label[a] != label[b]
        if not open_.any():
            return
        a, b = a[open_], b[open_]


def passes_needed(x: np.ndarray, centre: np.ndarray, n: int, threshold: float, recall: float, window: int,
                  most: int = MOST_PASSES) -> int:
    """Passes for a label of ``n`` unit vectors with the sample ``x``, by planted partners at the threshold; at most ``most + 1``."""
    rng = np.random.default_rng([SEED, n, len(x)])
    pick = rng.permutation(len(x))[:PROBES]
    y = _partners(x, pick, threshold, rng)
    gap = window * len(x) / n
    reach = max(gap, LEAST_GAP)
    centred, partner = x - centre, y - centre
    label = np.arange(len(x) + len(y))
    own = len(x) + np.arange(len(y))
    open_ = np.arange(len(pick))
    passes = 0
    while len(open_) > (1 - recall) / 2 * len(pick) and x.shape[1] > 1 and passes <= most:
        keys, mine = _pass_signs(centred, passes), _pass_signs(partner, passes)
        order = np.argsort(keys, kind="stable")
        rank = np.empty(len(x), dtype=np.int64)
        rank[order] = np.arange(len(x))
        low, high = np.searchsorted(keys[order], mine, "left"), np.searchsorted(keys[order], mine, "right")
        at = low + np.floor(rng.random(len(mine)) * (high - low + 1)).astype(np.int64)
        met = np.abs(rank[pick] + 0.5 - at) < reach
        a, b = [pick[met], order[:-1]], [own[met], order[1:]]
        linked = [np.ones(met.sum(), dtype=bool), (x[order[:-1]] * x[order[1:]]).sum(axis=1) >= threshold]
        for side in (at - 1, at):  # the rows next to the partner
            near = order[np.clip(side, 0, len(x) - 1)]
            a.append(near)
            b.append(own)
            linked.append((x[near] * y).sum(axis=1) >= threshold)
        linked = np.concatenate(linked)
        _unite(label, np.concatenate(a)[linked], np.concatenate(b)[linked])
        open_ = np.flatnonzero(label[pick] != label[own])
        passes += 1
    if x.shape[1] > 1 and gap < reach:
        # a sample too thin for the window was measured with a wider one: one more sign must agree for each halving
        length = np.sqrt((centred[pick] ** 2).sum(axis=1) * (partner ** 2).sum(axis=1))
        cosine = (centred[pick] * partner).sum(axis=1) / np.maximum(length, 1e-300)
        same = 1 - float(np.arccos(np.clip(cosine, -1, 1)).mean()) / np.pi
        passes = int(np.ceil(passes / same ** np.log2(reach / gap)))
    least = passes_for(n, threshold, recall, window) if _alone(label, len(x)) else LEAST_PASSES
    return min(most + 1, max(passes, least))


def _alone(label: np.ndarray, rows: int) -> bool:
    """Whether most rows are linked to no other row, so that pairs meet by the window alone."""
    return bool((np.bincount(label[:rows])[label[:rows]] == 1).mean() > 0.5)


def _centres(reps: DataFrame) -> DataFrame:
    """(dim, label, n, centre): the mean unit vector of each label and length."""
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(dim, label, len(own), _units(own["vec"]).sum(axis=0))
                   for (dim, label), own in batch.groupby(["dim", "label"])]
            yield pd.DataFrame(out, columns=["dim", "label", "n", "total"])

    sums = reps.select("dim", "label", "vec").mapInPandas(apply, "dim int, label string, n long, total array<double>")
    sums = sums.select("dim", "label", "n", F.posexplode("total").alias("at", "x"))
    sums = sums.groupBy("dim", "label", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    sums = sums.groupBy("dim", "label").agg(  # one element a dimension
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", F.round(F.col("x") / F.col("n"), 9).alias("x")))).alias("c"))
    return sums.select("dim", "label", "n", F.col("c.x").alias("centre"))


def _beside(reps: DataFrame, labels: DataFrame) -> DataFrame:
    """``reps`` with the columns of their label; a large label can be split."""
    side = labels.withColumnsRenamed({"dim": "l_dim", "label": "l_label"}).withColumn("l_apart", apart(F.col("l_label")))
    same = (F.col("dim") == F.col("l_dim")) & (F.col("label") == F.col("l_label")) & (apart(F.col("label")) == F.col("l_apart"))
    return reps.join(side, same).drop("l_dim", "l_label", "l_apart")


def _label_passes(reps: DataFrame, centres: DataFrame, threshold: float, recall: float, window: int,
                  most: int) -> DataFrame:
    """``centres`` with the number of passes of each label; ``most + 1`` stands for too many."""
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in runs(batches, ["dim", "label"]):
            g = g.sort_values("rep")
            one = g.iloc[0]
            need = passes_needed(_units(g["vec"]), np.asarray(one["centre"]), int(one["n"]), threshold, recall, window, most)
            yield pd.DataFrame({"p_dim": [one["dim"]], "p_label": [one["label"]], "passes": [need]})

    grain = 1 << 30
    rows = _beside(reps, centres.where(F.col("n") > window))
    share = F.lit(float(SAMPLE_VALUES)) / F.col("dim") / F.col("n")
    rows = rows.where(F.pmod(F.xxhash64("rep"), F.lit(grain)) < share * grain)
    rows = rows.repartition("dim", "label").sortWithinPartitions("dim", "label")  # SAMPLE_VALUES bound a label
    found = rows.select("rep", "dim", "label", "vec", "n", "centre").mapInPandas(
        apply, "p_dim int, p_label string, passes int")
    same = (F.col("dim") == F.col("p_dim")) & (F.col("label") == F.col("p_label"))
    return centres.join(found, same, "left").select("dim", "label", "n", "centre", F.coalesce("passes", F.lit(1)).alias("passes"))


def _with_keys(reps: DataFrame, labels: DataFrame) -> DataFrame:
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, own in batch.groupby("dim"):
                x = _units(own["vec"]) - np.array(own["centre"].tolist())
                count = own["passes"].to_numpy()
                keys = np.zeros((len(x), count.max()), dtype=np.int64)
                for p in range(count.max()):
                    keys[count > p, p] = _pass_signs(x[count > p], p)
                yield pd.DataFrame({"rep": own["rep"], "label": own["label"], "dim": own["dim"],
                                    "keys": [k[:c] for k, c in zip(keys, count, strict=True)]})

    return _beside(reps, labels).mapInPandas(apply, "rep long, label string, dim int, keys array<long>")


def _ranked(keyed: DataFrame) -> DataFrame:
    """(rep, rank) of every row in every pass, in the order of pass, label and key."""
    rows = keyed.select("rep", "label", "dim", F.posexplode("keys").alias("pass", "key"))
    order = ["pass", "dim", "label", "key", "rep"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = cut(rows.select("rep", "pass", "label", "dim", F.spark_partition_id().alias("part"),
                           F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")))
    counts = sorted(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())  # one row a partition
    starts = np.cumsum([0] + [r["n"] for r in counts])
    begin = rows.sparkSession.createDataFrame(
        [(r["part"], int(s)) for r, s in zip(counts, starts, strict=False)], "b_part int, begin long")
    rows = rows.join(F.broadcast(begin), F.col("part") == F.col("b_part"))  # one row a partition
    return rows.select("rep", "pass", (F.col("begin") + F.col("at")).alias("rank"))


def _window_links(threshold: float, window: int, block: int):
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in runs(batches, ["block"]):
            g = g.sort_values("rank")
            code = pd.factorize(pd.MultiIndex.from_frame(g[["pass", "dim", "label"]]))[0]
            own = (g["rank"].to_numpy() // block == g["block"].to_numpy())
            found = []
            for c in np.unique(code):  # rows of a pass, length and label are consecutive
                at = np.flatnonzero(code == c)
                x = _units(g["vec"].iloc[at])
                for a in range(0, len(at), 256):
                    near = x[a:a + 256] @ x[a:a + 256 + window].T
                    i, j = np.nonzero(near >= threshold)
                    ok = (j > i) & (j - i <= window) & own[at[a + i]]
                    found.append((at[a + i[ok]], at[a + j[ok]]))
            rep = g["rep"].to_numpy()
            a, b = forest(rep, *(np.concatenate(p) for p in zip(*found, strict=True)))
            yield pd.DataFrame({"a": a, "b": b})

    return apply


def links(reps: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, window: int = WINDOW,
          block: int = BLOCK, most: int = MOST_PASSES) -> DataFrame:
    """Links (a, b) with the components of all pairs found over (rep, label, dim, vec)."""
    labels = cut(_label_passes(reps, cut(_centres(reps)), threshold, recall, window, most))
    found = _window_pass(reps, labels.where(F.col("passes") <= most).drop("n"), threshold, window, block)
    wide = labels.where(F.col("passes") > most)
    if wide.isEmpty():
        return found
    return found.unionAll(_all_pairs(reps, wide, threshold, block))


def _window_pass(reps: DataFrame, labels: DataFrame, threshold: float, window: int, block: int) -> DataFrame:
    ranks = _ranked(_with_keys(reps, labels))
    spots = ranks.groupBy("rep").agg(F.collect_list(F.struct("pass", "rank")).alias("spots"))  # one a pass
    rows = reps.join(spots.withColumnRenamed("rep", "s_rep"), F.col("rep") == F.col("s_rep"))
    rows = rows.select("rep", "label", "dim", "vec", F.explode("spots").alias("s")).select("*", "s.*").drop("s")
    home = F.floor(F.col("rank") / block)
    halo = (F.col("rank") % block < window) & (home > 0)
    rows = rows.withColumn("block", F.explode(F.when(halo, F.array(home, home - 1)).otherwise(F.array(home))))
    rows = rows.repartition("block").sortWithinPartitions("block")
    return rows.mapInPandas(_window_links(threshold, window, block), "a long, b long")


def _tiled(rows: DataFrame, tiles: Column) -> DataFrame:
    """``rows`` (with rep) once for each pair (x, y) of tiles that their own tile is in; a tile meets every tile once."""
    rows = rows.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return rows.withColumns({"x": F.least("tile", "o"), "y": F.greatest("tile", "o")}).drop("o", "tiles")


def _all_pairs(reps: DataFrame, labels: DataFrame, threshold: float, tile: int) -> DataFrame:
    """Links (a, b) with the components of all pairs of these labels; a task holds two tiles."""
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in runs(batches, ["dim", "label", "x", "y"]):
            x, rep, found = _units(g["vec"]), g["rep"].to_numpy(), [(np.empty(0, np.int64),) * 2]
            for a in range(0, len(g), 256):
                i, j = np.nonzero(x[a:a + 256] @ x[a:].T >= threshold)
                found.append((a + i[i < j], a + j[i < j]))
            a, b = forest(rep, *(np.concatenate(p) for p in zip(*found, strict=True)))
            yield pd.DataFrame({"a": a, "b": b})

    rows = _tiled(_beside(reps, labels.select("dim", "label", "n")), F.ceil(F.col("n") / tile).cast("int"))
    rows = rows.repartition("dim", "label", "x", "y").sortWithinPartitions("dim", "label", "x", "y")
    return rows.mapInPandas(apply, "a long, b long")


def _tile_counts(threshold: float):
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in runs(batches, ["component", "x", "y"]):
            x = _units(g["vec"])
            n, tile = g["n"].to_numpy(), g["tile"].to_numpy()
            total = np.zeros(len(g), dtype=np.int64)
            cross = g["x"].iloc[0] != g["y"].iloc[0]
            for a in range(0, len(g), 256):
                hit = x[a:a + 256] @ x.T >= threshold
                if cross:
                    hit &= tile[a:a + 256, None] != tile[None, :]
                else:
                    hit[np.arange(hit.shape[0]), a + np.arange(hit.shape[0])] = False
                total[a:a + 256] = hit @ n
            yield pd.DataFrame({"rep": g["rep"].to_numpy(), "links": total})

    return apply


def _counts(members: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(rep, links): vectors linked to each of (rep, component, vec, n), copies counted by n."""
    sizes = (members.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
             .select(F.col("component").alias("s_c"), F.ceil(F.col("m") / tile).cast("int").alias("tiles")))
    sizes = sizes.withColumn("s_apart", apart(F.col("s_c")))
    rows = members.join(sizes, (F.col("component") == F.col("s_c")) & (apart(F.col("component")) == F.col("s_apart")))
    rows = _tiled(rows.withColumnRenamed("tiles", "of"), F.col("of")).drop("of", "s_c", "s_apart")
    rows = rows.repartition("component", "x", "y").sortWithinPartitions("component", "x", "y")
    counted = rows.mapInPandas(_tile_counts(threshold), "rep long, links long")
    return counted.groupBy("rep").agg(F.sum("links").alias("links"))


def near_classes(vectors: DataFrame, embedding: str = "embedding", label: str = "label", vec_id: str = "vec_id",
                 threshold: float = THRESHOLD, recall: float = RECALL, window: int = WINDOW,
                 block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    vec = col(vectors, embedding)
    if dict(vectors.dtypes)[embedding] != "array<float>":  # floats travel as such: half the bytes, and exact in doubles
        vec = vec.cast("array<double>")
    rows = vectors.select(col(vectors, vec_id).cast("long").alias("vec_id"),
                          col(vectors, label).cast("string").alias("label"), vec.alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
             & F.coalesce(F.exists("vec", lambda v: v != 0), F.lit(False)))
    rows = rows.withColumn("sound", sound).withColumn("hash", F.md5(F.to_json(F.struct("label", "vec")).cast("binary")))
    good = rows.where("sound")
    reps = cut(good.groupBy("hash").agg(F.min(F.struct("vec_id", "label", "vec")).alias("r"), F.count(F.lit(1)).alias("n"))
               .select(F.col("r.vec_id").alias("rep"), F.col("r.label").alias("label"), F.size("r.vec").alias("dim"),
                       F.col("r.vec").alias("vec"), "n", "hash"))
    found = components(links(reps.select("rep", "label", "dim", "vec"), threshold, recall, window, block))
    found = cut(found)
    members = reps.join(found, F.col("rep") == F.col("node")).select("rep", "component", "vec", "n")
    counts = _counts(members, threshold, tile).withColumnRenamed("rep", "k_rep")
    named = (reps.select("rep", "hash", F.col("rep").alias("vec_id"), "n")
             .join(found, F.col("rep") == F.col("node"), "left")
             .join(counts, F.col("rep") == F.col("k_rep"), "left")
             .select("hash", "vec_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "rep").alias("part")))
    low = named.groupBy("part").agg(F.min("vec_id").alias("component_id")).withColumnRenamed("part", "l_part")
    named = named.join(low, F.col("part") == F.col("l_part")).select(F.col("hash").alias("n_hash"), "n_links", "component_id")
    done = good.select("vec_id", "hash").join(named, F.col("hash") == F.col("n_hash")).select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    alone = rows.where(~F.col("sound")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return done.unionAll(alone)


ORACLE = r"""
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (
  select a.vec_id as a, b.vec_id as b
  from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (select vec_id as a, vec_id as b from v union select r.a, l.b from reach r join l on r.b = l.a),
c as (select a, min(b) as component_id from reach group by a),
n as (select a, count(*) as n_links from l group by a)
select e.vec_id, coalesce(n.n_links, 0) as n_links, coalesce(c.component_id, e.vec_id) as component_id,
       e.vec_id = coalesce(c.component_id, e.vec_id) as kept
from embeddings e left join c on e.vec_id = c.a left join n on e.vec_id = n.a
"""
