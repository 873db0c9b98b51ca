"""Exactly-once writes of micro-batches to plain tables.

``foreachBatch`` gives at-least-once delivery: after a failure a batch is run
again with the same id and the same rows.  Writing each table partitioned by
``run_id, batch_id`` with dynamic partition overwrite makes the replay
replace its own earlier output instead of adding to it.  The run id lives in
the checkpoint folder: a new checkpoint restarts batch ids at 0 but also gets
a new run id, so it can never overwrite an older run's rows.  Any number of
checkpoints, and plain appends, can therefore share one table.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import CSV_TIMES, path_exists

#: Files that one task of a batch write keeps open, one a folder; beyond them Spark sorts what is left by folder.
OPEN_FILES = 8


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The run id stored in ``checkpoint`` (created on first use)."""
    path = checkpoint.rstrip("/") + "/patrolspark_run_id"
    if path_exists(spark, path):
        row = spark.read.text(path).first()
        if row is not None:
            return row[0]
    # First start (or one interrupted before the id was written): the query
    # has not run yet, so no output can carry another id.
    # The creation time comes first, so that runs sort in the order they began.
    new = f"{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex}"
    spark.createDataFrame([(new,)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    return spark.read.text(path).first()[0]


def last_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch that the checkpoint's commit log holds; none before the first."""
    path = checkpoint.rstrip("/") + "/commits"
    if not path_exists(spark, path):
        return None
    log = spark.read.text(path, wholetext=True)
    name = F.col("_metadata.file_name")
    return log.where(name.rlike("^[0-9]+$")).agg(F.max(name.cast("long"))).first()[0]


def refuse_sink_log(spark: SparkSession, path: str) -> None:
    """Raise if ``path`` holds a file sink's log: readers then see only what the
    log lists, so batches written beside it would be invisible."""
    log = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_spark_metadata")
    if log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"{path} was written by a streaming file sink; rewrite it "
                         "(read_lake, then write_table) before adding to it")


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Tasks write to a few folders side by side, instead of sorting all their rows by folder first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_batch_table(df: DataFrame, path: str, rid: str, batch_id: int,
                      fmt: str = "parquet", options: dict[str, str] | None = None,
                      also_by: tuple[str, ...] = ()) -> None:
    w = (df.withColumn("run_id", F.lit(rid)).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.format(fmt).mode("overwrite")
         .options(**{**(CSV_TIMES if fmt == "csv" else {}), **(options or {})})
         .option("partitionOverwriteMode", "dynamic"))
    with unsorted_writes(df.sparkSession):
        w.partitionBy("run_id", "batch_id", *also_by).save(path)
