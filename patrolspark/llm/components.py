"""Connected components of a link table by alternating large and small stars.

Every round is two grouped minima and two joins; nothing but two numbers a
round reaches the driver.  A node with very many links is a hot join key on one
side only, which adaptive execution splits; the minima combine before they
shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, cut

MAX_ROUNDS = 64


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (u, v) with u > v."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select(F.col("u").alias("c"), apart(F.col("u")).alias("o"), F.least("u", "m").alias("m"))
    same = (F.col("u") == F.col("c")) & (apart(F.col("u")) == F.col("o"))
    large = (both.join(low, same).where("v > u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    rest = (large.join(low, F.col("u") == F.col("c")).where("v <> m")
            .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))
    return rest.unionAll(low.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; component is the smallest node reachable."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = cut(edges)
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        edges = cut(_stars(edges))
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("u")).distinct().withColumn("v", F.col("u"))
    return edges.unionAll(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))


def forest(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star links (node, smallest node) with the components that the links a-b have.

    ``a`` and ``b`` index ``nodes``; at most one link a node comes out, however
    many go in.
    """
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]
