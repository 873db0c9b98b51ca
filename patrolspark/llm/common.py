"""Helpers shared by the training-data operators."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: White space of the contracts: space and the C0 controls tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: A word of the contracts, in a form Python, Java and RE2 read alike.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)
UPPER = {c: c + 32 for c in range(65, 91)}
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    shared_dir(df.sparkSession)  # sets a folder only where the session names none
    return df.checkpoint(eager=True)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the rows of an Arrow batch, so that a batch of long texts fits a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name."""
    have = {c.lower() for c in df.columns}
    while wanted.lower() in have:
        wanted += "_"
    return wanted


def col(df: DataFrame, name: str) -> Column:
    """Column of ``df`` by its literal name (dots and blanks included)."""
    return df["`" + name.replace("`", "``") + "`"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def apart(key: Column) -> Column:
    """A second join key, a function of ``key``.

    A side that has just been grouped by a key is joined in the stage that
    grouped it, and adaptive execution can't split a hot key of the other side
    there.  With this beside the key both sides shuffle anew, and it can.
    """
    return F.xxhash64(key)


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(rows: DataFrame, order: list[str], out: str) -> DataFrame:
    """``rows`` with their exact rank, from 0, in ``order``: a range partitioned sort and one count a partition."""
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = cut(rows.withColumns({"__part": F.spark_partition_id(),
                                 "__at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    counts = sorted(rows.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect())  # one row a partition
    starts = np.cumsum([0] + [r["n"] for r in counts])
    begin = rows.sparkSession.createDataFrame(
        [(r["__part"], int(s)) for r, s in zip(counts, starts, strict=False)], "__of int, __begin long")
    rows = rows.join(F.broadcast(begin), F.col("__part") == F.col("__of"))  # one row a partition
    return rows.withColumn(out, F.col("__begin") + F.col("__at")).drop("__part", "__at", "__of", "__begin")


def runs(batches: Iterable[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Contiguous groups of equal ``key`` over sorted batches, one frame per group.

    Holds one group and one batch at a time; callers bound the size of a group.
    """
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        ends = np.r_[starts[1:], len(batch)]
        for a, b in zip(starts, ends, strict=True):
            this = tuple(keys[a])
            if held and this != last:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(batch.iloc[a:b])
            last = this
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
