"""Keep a frame in memory and disk for the length of a block, then release it."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """``with cached(small) as s: ...`` persists ``df`` and always unpersists it.

    Persist what is reused and small (an aggregate), not the raw rows: a
    cache blocks column pruning and filter push-down for every reader.
    Blocks lost with an executor are recomputed from lineage.
    """
    p = df.persist(level)
    try:
        yield p
    finally:
        p.unpersist()
