"""Counting, shares, top-k and top-per-group.

Scale notes
-----------
* ``count_by`` is a partial + final hash aggregate: each map task emits one
  row per key, so a key holding a third of all rows costs one row per task in
  the shuffle, not a third of the data.
* ``share_of_total`` takes the overall total from a scalar subquery over the
  *aggregated* frame rather than a window without partitioning, so no stage
  ever moves all groups into one task; with ``by`` keys, the per-key totals
  are a second aggregate joined back (AQE broadcasts it when it is small and
  splits skewed keys when it is not).
* ``top_per_group`` is one aggregate (``min`` of a sortable struct), not a
  ``row_number`` window: a hot group is pre-aggregated map-side instead of
  being sorted inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..util import as_col

COUNT = "number_of_violations"
PERCENT = "percent"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def count_by(df: DataFrame, keys, counted: str = "violation_code",
             alias: str = COUNT) -> DataFrame:
    """Count of non-null ``counted`` per group; an all-null group stays with 0."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.col(counted)).alias(alias))


def percent_of(n, total) -> Column:
    """``n * 100 / total`` as double; null when the total is 0 or null."""
    return F.try_divide(as_col(n) * 100, as_col(total))


def share_of_total(counts: DataFrame, by: Sequence[str] = (), n: str = COUNT,
                   alias: str = PERCENT) -> DataFrame:
    """Add ``percent`` = n × 100 / (sum of n over all rows, or over ``by``)."""
    by = _keys(by)
    if not by:
        total = counts.select(F.sum(n)).scalar()
        return counts.withColumn(alias, percent_of(F.col(n), total))
    totals = counts.groupBy(*by).agg(F.sum(n).alias("__total")) \
        .select(*[F.col(k).alias(f"__by_{k}") for k in by], "__total")
    # Null-safe keys: a null group gets its own total.  Still an equi-join
    # (hash or sort-merge, never a nested loop).
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"__by_{k}")) for k in by])
    return (counts.join(totals, on=cond, how="left")
            .withColumn(alias, percent_of(F.col(n), F.col("__total")))
            .drop("__total", *[f"__by_{k}" for k in by]))


def top_k(df: DataFrame, k: int, n: str = COUNT, tie: str = "violation_code") -> DataFrame:
    """The ``k`` rows with the largest ``n``; ties by ``tie`` ascending, nulls first.

    ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task
    keeps its own k best, the driver merges k × tasks rows.
    """
    return df.orderBy(F.col(n).desc(), F.col(tie).asc_nulls_first()).limit(k)


def top_per_group(counts: DataFrame, group: str, item: str = "violation_code",
                  n: str = COUNT, alias: str = PERCENT) -> DataFrame:
    """Best item of each group by ``n`` desc, ``item`` asc nulls first, with
    its share of the group's total.

    ``min(struct(-n, item))`` orders exactly like the tie rule (struct fields
    compare left to right, null first), and is a mergeable aggregate.
    """
    best = F.min(F.struct((-F.col(n)).alias("neg_n"), F.col(item).alias("item")))
    agg = counts.groupBy(group).agg(best.alias("__best"), F.sum(n).alias("__total"))
    return agg.select(
        F.col(group),
        F.col("__best.item").alias(item),
        (-F.col("__best.neg_n")).alias(n),
        percent_of(-F.col("__best.neg_n"), F.col("__total")).alias(alias),
    )


def union_bands(df: DataFrame, label_col: str, names: Sequence[str], label_fn) -> DataFrame:
    """Rows of ``df`` whose band is one of ``names``, tagged with ``label_col``.

    Equivalent to one filter + constant tag per band, unioned by position; a
    single pass because the bands are disjoint.
    """
    return df.withColumn(label_col, label_fn).where(F.col(label_col).isin(list(names)))
