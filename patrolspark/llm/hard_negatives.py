"""Hard-negative mining with an STR-packed R-tree.

All vectors are packed by sort-tile-recursive: sorted by label and the widest
coordinate into slabs, and each slab by label and the next coordinate into
blocks of ``BLOCK`` rows.  A block is packed further into leaves of ``LEAF``
rows and nodes of ``FAN`` children.  Every node has its minimum bounding box and
range of labels; against an anchor the box gives each coordinate's interval of
products, and their sum the interval of inner products of all rows below.

A search goes through the boxes best first: a queue ordered by the highest score
that a node can still give, which drops nodes whose interval lies outside every
score window, strictly below every window's k-th score found so far, or whose
labels do not suit.  The upper level of the tree is a table of block boxes; an
anchor is compared with it in pages of ``PAGE`` boxes, goes to its most promising
block first, and with the k-th scores found there to those of the others that
may hold as good a row.

Two searches make the result: the positives of every anchor (first rows of its
label), then for all of its positives at once the negatives whose scores lie in
the window of that positive.  Blocks and anchors meet in cells of at most
``BLOCK`` rows and about ``CELL`` anchors, so a popular block is searched by many
tasks and no task or driver holds more than a cell.

Components are floor(256 x).  Scores are exact: 64-bit floats hold the whole
numbers and their sums up to 2^53; larger ones are added as Python integers,
without boxes, and a score beyond the long range counts as its end.

Defined cases: rows with a null id or label, a null or empty vector, or null or
non-finite components take no part, nor do components whose 256-fold is not
finite; vectors of another length than the anchor's have no score; repeated rows
are rows of their own, and a row with the anchor's id is never its positive; an
anchor without positives, and a positive without negatives, gives no rows; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, col, cut, ranked, runs

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
SCALE = 256
BLOCK = 16384
LEAF = 256
FAN = 8
PAGE = 4096
CELL = 4096
_AT_ONCE = 256
_EXACT = float(1 << 53)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1)


def _scaled(vectors: pd.Series) -> np.ndarray:
    return np.floor(SCALE * _matrix(vectors))


def _pack(x: np.ndarray, rows: np.ndarray, axes: list[np.ndarray], leaf: int) -> np.ndarray:
    """``rows`` in sort-tile-recursive order of the coordinates ``axes``."""
    leaves = -(-len(rows) // leaf)
    rows = rows[np.argsort(axes[0][rows], kind="stable")]
    if len(axes) == 1 or leaves <= 1:
        return rows
    slabs = int(np.ceil(leaves ** (1 / len(axes))))
    step = leaf * -(-leaves // slabs)
    return np.concatenate([_pack(x, rows[a:a + step], axes[1:], leaf) for a in range(0, len(rows), step)])


class Tree:
    """R-tree over some rows of one length: boxes of its nodes (leaves first, root last) and their children."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        self.names, code = np.unique(labels.astype(str), return_inverse=True)
        widest = np.argsort(-x.var(axis=0), kind="stable")[:3]
        axes = ([code] if len(self.names) > 1 else []) + [x[:, j] for j in widest]
        order = _pack(x, np.arange(len(x)), axes, leaf)
        self.x, self.ids, self.code = x[order], ids[order], code[order]
        starts = np.arange(0, len(x), leaf)
        self.rows = [(a, min(len(x), a + leaf)) for a in starts]
        level = [np.minimum.reduceat(self.x, starts), np.maximum.reduceat(self.x, starts),
                 np.minimum.reduceat(self.code, starts), np.maximum.reduceat(self.code, starts)]
        parts, self.children = [level], []
        first = 0
        while len(level[0]) > 1:
            n = len(level[0])
            starts = np.arange(0, n, fan)
            self.children += [(first + a, first + min(n, a + fan)) for a in starts]
            first += n
            level = [f.reduceat(part, starts) for f, part in zip((np.minimum, np.maximum) * 2, level, strict=True)]
            parts.append(level)
        self.low, self.high, self.code_low, self.code_high = (np.concatenate(p) for p in zip(*parts, strict=True))

    def bounds(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _intervals(a, self.low, self.high)

    def search(self, a: np.ndarray, own: int, label: str, same: bool, windows: list[list], k: int,
               low: np.ndarray, high: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each window (lowest, highest, k-th score so far or None): the first k rows, as (score, -id)."""
        at = int(np.searchsorted(self.names, label))
        code = at if at < len(self.names) and self.names[at] == label else -1
        suits = (self.code_low <= code) & (code <= self.code_high) if same else (self.code_low < self.code_high) | (self.code_low != code)
        floor = [w[0] if w[2] is None else max(w[0], w[2]) for w in windows]
        top = [w[1] for w in windows]
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        queue: list[tuple[float, int]] = []

        def offer(node: int) -> None:
            if suits[node]:
                best = [min(high[node], t) for f, t in zip(floor, top) if f <= high[node] and low[node] <= t and f <= t]
                if best:
                    heappush(queue, (-float(max(best)), node))

        offer(len(self.low) - 1)
        while queue:
            _, node = heappop(queue)
            # the floors may have passed it since it was queued
            if not any(f <= high[node] and low[node] <= t and f <= t for f, t in zip(floor, top)):
                continue
            if node >= len(self.rows):
                for child in range(*self.children[node - len(self.rows)]):
                    offer(child)
                continue
            x, y = self.rows[node]
            score = _products(self.x[x:y], a)
            ok = (self.code[x:y] == code) & (self.ids[x:y] != own) if same else self.code[x:y] != code
            near = np.flatnonzero(ok & (score >= min(floor)) & (score <= max(top)))
            for w in range(len(windows)) if len(near) else ():
                inside = near[(score[near] >= floor[w]) & (score[near] <= top[w])]
                if len(inside) > k:
                    order = np.lexsort((self.ids[x:y][inside], -score[inside])) if score.dtype != object else sorted(
                        range(len(inside)), key=lambda i: (-score[inside[i]], self.ids[x + inside[i]]))
                    inside = inside[order[:k]]
                own_best = found[w]
                for i in inside:
                    item = (int(score[i]), -int(self.ids[x + i]))
                    if len(own_best) < k:
                        heappush(own_best, item)
                    elif item > own_best[0]:
                        heapreplace(own_best, item)
                if len(own_best) == k:
                    floor[w] = max(floor[w], own_best[0][0])
        return found


def _intervals(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest inner product of each row of ``a`` with each box; without limits where floats are not exact."""
    largest = float(np.abs(a).max(initial=0)) * float(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)))
    if not largest * a.shape[1] < _EXACT:
        return np.full((len(a), len(low)), -np.inf), np.full((len(a), len(low)), np.inf)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _products(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    if float(np.abs(x).max(initial=0)) * float(np.abs(a).max(initial=0)) * len(a) < _EXACT:
        return x @ a
    whole = [int(v) for v in a]
    score = [sum(int(v) * w for v, w in zip(row, whole, strict=True)) for row in x]
    return np.array([min(max(s, _LEAST), _MOST) for s in score] + [None], dtype=object)[:-1]


def _windows(scores: np.ndarray | None, kth: np.ndarray | None, low: int, high: int) -> list[list]:
    """[lowest, highest, k-th so far] of each positive's window; one without limits for a search of positives."""
    known = [None] * (1 if scores is None else len(scores)) if kth is None else [None if pd.isna(v) else int(v) for v in kth]
    if scores is None:
        return [[-np.inf, np.inf, known[0]]]
    # python integers: 100 * lowest >= low * score, 100 * highest <= high * score
    return [[-(-low * int(s) // 100), high * int(s) // 100, v] for s, v in zip(scores, known, strict=True)]


def _meet(held: DataFrame, asking: DataFrame, cell: int, build: Callable, ask: Callable, schema: str) -> DataFrame:
    """``ask(build(held rows of a block), asking rows of it)`` in cells of one block and about ``cell`` asking rows."""
    parts = asking.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("parts"))
    parts = parts.select(F.col("block").alias("p_block"), apart(F.col("block")).alias("p_apart"), "parts")
    same = (F.col("block") == F.col("p_block")) & (apart(F.col("block")) == F.col("p_apart"))
    left = held.join(parts, same).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = asking.join(parts, same).withColumn("part", F.pmod(F.xxhash64("q_row"), F.col("parts")).cast("int"))
    both = left.withColumn("kind", F.lit(0)).unionByName(right.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    both = both.drop("p_block", "p_apart", "parts")
    both = both.repartition("block", "part").sortWithinPartitions("block", "part", "kind")

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        built = None
        for g in runs(batches, ["block", "part", "kind"]):
            if g["kind"].iloc[0] == 0:
                built = build(g)
            else:
                for a in range(0, len(g), _AT_ONCE):
                    yield from ask(built, g.iloc[a:a + _AT_ONCE])

    return both.mapInPandas(apply, schema)


def _packed(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` with the block that sort-tile-recursive packing gives each."""
    spread = rows.select("dim", F.posexplode("vec").alias("at", "x")).groupBy("dim", "at").agg(F.var_pop("x").alias("s"))
    spread = spread.groupBy("dim").agg(F.collect_list(F.struct((-F.col("s")).alias("s"), "at")).alias("axes"))  # dim elements
    spread = spread.select(F.col("dim").alias("a_dim"), apart(F.col("dim")).alias("a_apart"), F.array_sort("axes")["at"].alias("axes"))
    keys = rows.join(spread, (F.col("dim") == F.col("a_dim")) & (apart(F.col("dim")) == F.col("a_apart")))
    keys = keys.select("row", "dim", "label", F.get("vec", F.col("axes")[0]).alias("x"),
                       F.coalesce(F.get("vec", F.get("axes", F.lit(1))), F.lit(0.0)).alias("y"))
    keys = ranked(keys, ["dim", "label", "x", "row"], "rank")
    blocks = -(-rows.count() // block)
    slab = block * max(1, int(np.ceil(np.sqrt(blocks))))
    keys = keys.withColumn("slab", F.floor(F.col("rank") / slab))
    keys = ranked(keys, ["slab", "dim", "label", "y", "row"], "place")
    keys = keys.select(F.col("row").alias("k_row"), F.floor(F.col("place") / block).alias("block"))
    return rows.join(keys, F.col("row") == F.col("k_row")).drop("k_row")


def _directory(index: DataFrame) -> DataFrame:
    """One row a block and vector length: box and range of labels, the upper level of the tree."""
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in runs(batches, ["block", "dim"]):
            x = _scaled(g["vec"])
            yield pd.DataFrame({"of": [g["block"].iloc[0]], "dim": [g["dim"].iloc[0]], "low": [x.min(axis=0)], "high": [x.max(axis=0)],
                                "label_low": [g["label"].min()], "label_high": [g["label"].max()]})

    rows = index.select("block", "dim", "label", "vec").repartition("block").sortWithinPartitions("block", "dim")
    return rows.mapInPandas(apply, "of long, dim int, low array<double>, high array<double>, label_low string, label_high string")


def _reach(directory: DataFrame, pages: int, queries: DataFrame, same: bool, low: int, high: int) -> DataFrame:
    """(q_row, of, tops): blocks that may serve an anchor and the best score of each window there, null for none."""
    def build(g: pd.DataFrame) -> dict:
        return {d: (own["of"].to_numpy(), _matrix(own["low"]), _matrix(own["high"]), own["label_low"].to_numpy(), own["label_high"].to_numpy())
                for d, own in g.groupby("dim")}

    def ask(built: dict, g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for d, own in g.groupby("dim"):
            if d not in built:
                continue
            of, box_low, box_high, label_low, label_high = built[d]
            lowest, highest = _intervals(_scaled(own["vec"]), box_low, box_high)
            out = []
            for i, q in enumerate(own.itertuples()):
                label = q.label
                if same:
                    suits = (label_low <= label) & (label <= label_high)
                else:
                    suits = (label_low != label) | (label_high != label)
                tops = []
                for a, b, _ in _windows(q.scores, None, low, high):
                    fits = suits & (highest[i] >= a) & (lowest[i] <= b) if a <= b else np.zeros(len(of), dtype=bool)
                    tops.append(np.where(fits, np.minimum(highest[i], float(b)), np.nan))
                tops = np.array(tops).T
                for j in np.flatnonzero(~np.isnan(tops).all(axis=1)):
                    out.append((q.q_row, of[j], [None if np.isnan(t) else float(t) for t in tops[j]]))
            if out:
                yield pd.DataFrame(out, columns=["q_row", "of", "tops"])

    boxes = directory.withColumn("block", F.floor(F.col("of") / PAGE))
    asking = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long"))))
    return _meet(boxes, asking, CELL, build, ask, "q_row long, of long, tops array<double>")


def _found(index: DataFrame, queries: DataFrame, same: bool, k: int, low: int, high: int) -> DataFrame:
    """(q_row, window, id, score): the first k rows of each window among those of one block; ``queries`` name the block."""
    def build(g: pd.DataFrame) -> dict:
        return {d: Tree(_scaled(own["vec"]), own["id"].to_numpy(dtype=np.int64), own["label"].to_numpy())
                for d, own in g.groupby("dim")}

    def ask(built: dict, g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for d, own in g.groupby("dim"):
            if d not in built:
                continue
            tree, a = built[d], _scaled(own["vec"])
            lowest, highest = tree.bounds(a)
            out = []
            for i, q in enumerate(own.itertuples()):
                best = tree.search(a[i], q.id, q.label, same, _windows(q.scores, q.kth, low, high), k, lowest[i], highest[i])
                out += [(q.q_row, w, -item[1], item[0]) for w, b in enumerate(best) for item in b]
            if out:
                yield pd.DataFrame(out, columns=["q_row", "window", "id", "score"])

    held = index.select("block", "dim", "label", "vec", "id")
    return _meet(held, queries, CELL, build, ask, "q_row long, window int, id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q_row", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(index: DataFrame, directory: DataFrame, pages: int, queries: DataFrame, same: bool, k: int, low: int, high: int) -> DataFrame:
    """(q_row, window, id, score, rank): the first k rows of each window of the queries (q_row, id, label, dim, vec, scores)."""
    reach = cut(_reach(directory, pages, queries, same, low, high))
    best = F.array_max("tops")  # nulls are left out
    home = reach.groupBy("q_row").agg(F.max_by("of", F.struct(best, -F.col("of"))).alias("of")).withColumnRenamed("q_row", "h_row")
    near = queries.join(home.withColumnRenamed("of", "block"), F.col("q_row") == F.col("h_row")).drop("h_row")
    here = cut(_first(_found(index, near.withColumn("kth", F.lit(None).cast("array<long>")), same, k, low, high), k))
    # beyond 2^53 an array with nulls reaches Python rounded: such a score prunes nothing
    known = here.where((F.col("rank") == k) & F.col("score").between(-(1 << 53), 1 << 53)).groupBy("q_row").agg(  # one element a positive
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("last")).withColumnRenamed("q_row", "l_row")
    rest = reach.join(home, (F.col("q_row") == F.col("h_row"))).where(reach["of"] != home["of"]).select("q_row", reach["of"].alias("block"), "tops")
    rest = rest.join(known, F.col("q_row") == F.col("l_row"), "left")
    kth = F.transform("tops", lambda _, w: F.col("last")[w])
    rest = rest.withColumn("kth", F.when(F.col("last").isNull(), F.transform("tops", lambda _: F.lit(None).cast("long"))).otherwise(kth))
    open_ = F.exists(F.arrays_zip("tops", "kth"), lambda z: z["tops"].isNotNull() & (z["kth"].isNull() | (z["tops"] >= z["kth"])))
    rest = rest.where(open_).select(F.col("q_row").alias("r_row"), "block", "kth")
    far = queries.join(rest, F.col("q_row") == F.col("r_row")).drop("r_row")
    there = _found(index, far, same, k, low, high)
    return _first(here.drop("rank").unionByName(there), k)


def mine(vectors: DataFrame, anchors: Column, embedding: str = "embedding", label: str = "label", vec_id: str = "vec_id",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK) -> DataFrame:
    """One row per anchor (rows where ``anchors`` holds), positive and negative: ids, rank and both scores."""
    vec = col(vectors, embedding)
    if dict(vectors.dtypes)[embedding] != "array<float>":  # floats travel as such: half the bytes, and exact in doubles
        vec = vec.cast("array<double>")
    rows = vectors.select(col(vectors, vec_id).cast("long").alias("id"), col(vectors, label).cast("string").alias("label"),
                          vec.alias("vec"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * SCALE) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0) & finite)
    rows = cut(rows.withColumn("dim", F.size("vec")))  # numbered once it is stored
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    index = cut(_packed(rows, block))
    directory = cut(_directory(index))
    pages = (directory.agg(F.max("of")).first()[0] or 0) // PAGE + 1
    queries = index.where("anchor").select(F.col("row").alias("q_row"), "id", "label", "dim", "vec")
    first = queries.withColumn("scores", F.lit(None).cast("array<long>"))
    near = cut(_search(index, directory, pages, first, True, positives, low, high))
    scores = near.groupBy("q_row").agg(F.array_sort(F.collect_list(F.struct("rank", "score")))["score"].alias("scores"))
    second = queries.join(scores.withColumnRenamed("q_row", "s_row"), F.col("q_row") == F.col("s_row")).drop("s_row")
    hard = _search(index, directory, pages, second, False, negatives, low, high)
    named = near.join(queries.select(F.col("q_row").alias("a_row"), F.col("id").alias("anchor_id")), F.col("q_row") == F.col("a_row"))
    named = named.select("q_row", "anchor_id", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    hard = hard.select("q_row", "window", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                       F.col("score").alias("negative_score"))
    return named.join(hard, ["q_row", "window"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = r"""
with v as (
  select vec_id, list_transform(cast(embedding as double[]), lambda x: floor(256 * x)) as e,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
  from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
         cast(list_inner_product(a.e, b.e) as bigint) as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.e) = len(b.e)),
p as (select anchor_id, other_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select anchor_id, positive_id,
       cast(row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as int) as rank,
       other_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""
