"""Live messages: one standing query that routes, decodes and stores.

A micro-batch is decoded once and written once, to ``<out_dir>/messages``,
partitioned by run, batch and ``kind`` (``standard``, ``violation``,
``image``, ``rejects``).  The five tables are views of it: a read prunes to
the kind's folders, and alerts are a projection of the violations.

Exactly-once: ``foreachBatch`` may replay a batch after a failure, so the
write overwrites exactly its own ``run_id, batch_id`` partitions.  The run id
is kept inside the checkpoint, so a fresh checkpoint (whose batch ids start
again at 0) never overwrites the rows of an earlier run; it starts with its
creation time, so runs have an order too.

``compact_output`` rewrites a run's committed batches into one partition and
keeps only the latest row of each image id, which bounds the number of folders
and the history an image read goes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.alerts import ALERT_SUBJECT, alert_body
from ..operators.images import latest_images
from ..operators.messages import decode_all
from ..schemas import STANDARD, VIOLATION
from ..sources.tables import path_exists
from .idempotent import last_commit, refuse_sink_log, run_id, write_batch_table

TABLES = ("standard", "violation", "images", "alerts", "rejects")
KINDS = {"standard": "standard", "violation": "violation", "images": "image",
         "alerts": "violation", "rejects": "rejects"}
# Stream position of a message; "latest image" needs it.
POSITION = ("partition", "offset")
IMAGE_ORDER = ("run_id", "batch_id", *POSITION)
_SCHEMA = T.StructType([
    T.StructField("reason", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), *VIOLATION.fields,
    T.StructField("content", T.StringType()), T.StructField("body", T.StringType()),
    T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("kind", T.StringType())])


def decoded_batch(batch: DataFrame, image_dir: str) -> DataFrame:
    """Decoded messages of a batch with their ``kind`` and alert text."""
    missing = [c for c in POSITION if c not in batch.columns]
    if missing:
        raise ValueError(f"the stream needs {', '.join(missing)}: without a position the "
                         "latest image of an id is undefined")
    rows = decode_all(batch, keep=POSITION)
    kind = F.when(F.col("reason").isNotNull(), "rejects").otherwise(F.col("route"))
    body = F.when(kind == "violation", alert_body(image_dir))
    return rows.withColumn("kind", kind).withColumn("body", body).drop("route")


def write_batch(batch: DataFrame, out_dir: str, image_dir: str, rid: str, batch_id: int,
                fmt: str = "parquet", on_alerts=None) -> None:
    """Decode one batch and store it with one write.

    ``on_alerts(alerts_df, batch_id)``, when given, runs after the batch is
    stored, on the stored rows (so a delivery failure never loses an alert): e.g.
    ``lambda df, _: df.foreachPartition(send)`` delivers from the executors.
    A replayed batch calls it again; delivery must tolerate repeats.
    """
    out = out_dir.rstrip("/")
    write_batch_table(decoded_batch(batch, image_dir), f"{out}/messages", rid, batch_id, fmt,
                      also_by=("kind",))
    if on_alerts is not None:
        rows = _stored(batch.sparkSession, f"{out}/messages", fmt)
        rows = rows.where((F.col("run_id") == rid) & (F.col("batch_id") == batch_id))
        on_alerts(_view(rows, "alerts"), batch_id)


def delivered_once(stream: DataFrame, within: str) -> DataFrame:
    """``stream`` without messages whose position (partition, offset) already came within that time.

    The clock is the arrival of a message: the time of its micro-batch, which the
    checkpoint keeps, so a replayed batch decides alike.  By that clock no message
    is ever late, so none is dropped for its age; state holds the positions of
    the last ``within``, and a message delivered again after that counts as new.
    """
    arrived = "__arrived"
    stream = stream.withColumn(arrived, F.current_timestamp()).withWatermark(arrived, within)
    return stream.dropDuplicatesWithinWatermark(list(POSITION)).drop(arrived)


def consume_messages(stream: DataFrame, out_dir: str, checkpoint: str, image_dir: str,
                     fmt: str = "parquet", available_now: bool = False,
                     processing_time: str | None = "10 seconds",
                     wait: bool = False, on_alerts=None, redelivery: str | None = None) -> StreamingQuery:
    """Start the consumer.  ``stream`` has ``key, value, partition, offset``.

    Batch size is set on the source (``maxOffsetsPerTrigger`` or
    ``maxFilesPerTrigger``; the command line requires it): without it the
    first batch is the whole backlog.  ``on_alerts``: see ``write_batch``.

    A batch that is replayed leaves its rows once anyway.  A message that the
    source itself delivers twice is stored, and raises its alert, once if it comes
    again within ``redelivery`` (e.g. ``"1 hour"``; see ``delivered_once``): this
    shuffles every message once by position, so it is off by default.
    """
    spark = stream.sparkSession
    if redelivery:
        stream = delivered_once(stream, redelivery)
    refuse_sink_log(spark, f"{out_dir.rstrip('/')}/messages")
    rid = run_id(spark, checkpoint)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out_dir, image_dir, rid, batch_id, fmt, on_alerts)

    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    q = w.start()
    if wait or available_now:
        q.awaitTermination()
    return q


def _stored(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Rows under ``path``; empty only if nothing has been written there yet."""
    if path_exists(spark, path):
        return spark.read.schema(_SCHEMA).format(fmt).load(path)
    return spark.createDataFrame([], _SCHEMA)


def _closed(spark: SparkSession, out: str) -> DataFrame:
    """(c_run, upto): the batches of each run that a finished compaction covers."""
    if path_exists(spark, f"{out}/compactions"):
        done = spark.read.schema("run_id string, upto long").json(f"{out}/compactions")
    else:
        done = spark.createDataFrame([], "run_id string, upto long")
    return done.groupBy(F.col("run_id").alias("c_run")).agg(F.max("upto").alias("upto"))


def _everything(spark: SparkSession, out: str, fmt: str) -> DataFrame:
    """Compacted batches and the live ones after them."""
    closed = _closed(spark, out)  # one row a run
    live = _stored(spark, f"{out}/messages", fmt).join(
        closed, F.col("run_id") == F.col("c_run"), "left")
    live = live.where(F.col("upto").isNull() | (F.col("batch_id") > F.col("upto")))
    packed = _stored(spark, f"{out}/compacted", fmt).join(
        closed, (F.col("run_id") == F.col("c_run")) & (F.col("batch_id") == F.col("upto")))
    names = [f.name for f in _SCHEMA.fields]
    return live.select(*names).unionAll(packed.select(*names))


def _view(rows: DataFrame, name: str) -> DataFrame:
    columns = {"standard": [f.name for f in STANDARD.fields],
               "violation": [f.name for f in VIOLATION.fields],
               "images": ["image_id", "content", *IMAGE_ORDER],
               "alerts": [F.lit(ALERT_SUBJECT).alias("subject"), "body"],
               "rejects": ["reason", "key", "value", *POSITION]}[name]
    return rows.where(F.col("kind") == KINDS[name]).select(*columns)


def read_output(spark: SparkSession, out_dir: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One of ``TABLES``; a table no batch has written to yet is empty."""
    return _view(_everything(spark, out_dir.rstrip("/"), fmt), name)


def image_store(spark: SparkSession, out_dir: str, fmt: str = "parquet") -> DataFrame:
    """Latest content per image id over everything consumed so far."""
    return latest_images(read_output(spark, out_dir, "images", fmt), order=IMAGE_ORDER)


def compact_output(spark: SparkSession, out_dir: str, checkpoint: str, upto: int | None = None,
                   fmt: str = "parquet", remove: bool = True) -> int | None:
    """Merge the batches of the checkpoint's run up to ``upto`` into one partition.

    ``upto`` is the last batch in the checkpoint's commit log, or one before it:
    a later batch, which may still be written or replayed, is refused, because its
    rows would be taken for merged ones.  Images keep their latest row per id.
    Readers switch over when the compaction's record is written, after its rows
    are; ``remove`` then deletes the merged batches.  A run that stops anywhere can
    simply be repeated, beside a running consumer too.  Returns the batch it
    reached; none if there is nothing to merge.
    """
    out = out_dir.rstrip("/")
    last = last_commit(spark, checkpoint)
    if upto is not None and (last is None or upto > last):
        raise ValueError(f"batch {upto} is not committed; the last one is {last}")
    upto = last if upto is None else upto
    if upto is None:
        return None
    rid = run_id(spark, checkpoint)
    known = _closed(spark, out).where(F.col("c_run") == rid).first()
    if known is None or known["upto"] < upto:
        _merge_batches(spark, out, rid, upto, fmt)
    else:
        upto = known["upto"]
    if remove:
        _remove_batches(spark, f"{out}/messages/run_id={rid}", lambda b: b <= upto)
        _remove_batches(spark, f"{out}/compacted/run_id={rid}", lambda b: b < upto)
    return upto


def _merge_batches(spark: SparkSession, out: str, rid: str, upto: int, fmt: str) -> None:
    """Write the merged rows, then the record that makes readers take them."""
    rows = _everything(spark, out, fmt).where(
        (F.col("run_id") == rid) & (F.col("batch_id") <= upto))
    last = latest_images(rows.where(F.col("kind") == "image"), content=None, order=IMAGE_ORDER)
    packed = rows.where(F.col("kind") != "image").unionByName(last)
    write_batch_table(packed.drop("run_id", "batch_id"), f"{out}/compacted", rid, upto, fmt,
                      also_by=("kind",))
    (spark.createDataFrame([(rid, upto)], "run_id string, upto long").coalesce(1)
     .write.mode("append").json(f"{out}/compactions"))


def _remove_batches(spark: SparkSession, path: str, old) -> None:
    """Delete the batch folders of one run that ``old`` selects."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and old(int(name[len("batch_id="):])):
            fs.delete(status.getPath(), True)
