"""Historic load: police files → violation lake, each file exactly once.

Structured Streaming's file source remembers every file it has committed in
the checkpoint, so a re-run after a stop (or a crash, or a lost executor)
picks up only files it has not finished.  Each micro-batch is written to its
own ``run_id, batch_id`` partition and a replay overwrites exactly that, so
the lake never holds a batch twice, and any number of loads, savers and plain
appends can share one lake.  ``availableNow`` runs the backlog in rate-limited
micro-batches and stops, which makes the same code a batch job or a standing
one.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..fixed import HISTORIC_KEY, HISTORIC_TOPIC
from ..operators.conform import LINE_CLASSES, line_class, to_violation
from ..operators.messages import checked, good, rejects
from ..schemas import VIOLATION
from ..sources.kafka import keyed_payload
from ..sources.raw import RAW_SUFFIX, raw_files
from .cube import add_batch
from .idempotent import refuse_sink_log, run_id, write_batch_table
from .ledger import SOURCE, changed_since, note_batch

CLASS = "line_class"
_METRICS = ", ".join(f"{c} long" for c in ("lines", *LINE_CLASSES))


def _start(stream: DataFrame, on_batch, checkpoint: str, available_now: bool,
           processing_time: str | None, wait: bool) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    q = w.start()
    if wait and available_now:
        q.awaitTermination()
    return q


def lake_rows(df: DataFrame, fmt: str) -> DataFrame:
    """Rows as the lake stores them.  A CSV lake is read by line, so line breaks
    inside its text fields (codes come from untrusted messages) become spaces."""
    if fmt != "csv":
        return df
    return df.select(*[F.translate(f.name, "\r\n", "  ").alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in df.schema.fields])


def load_historic(spark: SparkSession, src_dir: str, lake_path: str, checkpoint: str,
                  fmt: str = "parquet", suffix: str = RAW_SUFFIX, noon: str = "reference",
                  max_files_per_trigger: int | None = None,
                  options: dict[str, str] | None = None,
                  wait: bool = True,
                  processing_time: str | None = None,
                  archive_dir: str | None = None, metrics_path: str | None = None,
                  cube_path: str | None = None, ledger_path: str | None = None) -> StreamingQuery:
    """Parse every new ``*.<suffix>`` file of ``src_dir`` into the lake.

    By default the backlog is loaded and the query stops (``availableNow``);
    with ``processing_time`` (e.g. ``"1 minute"``) it keeps running and picks
    up files as they land.  ``fmt="csv"`` gives the headerless CSV lake of
    the original system; Parquet (default) keeps real timestamps so later
    scans push filters and read two columns out of six.  ``archive_dir`` moves
    finished files away, so that a standing load need not remember them all.

    Every batch also leaves one row of ``read_metrics`` (``<lake>_metrics`` by
    default): its lines by ``LINE_CLASSES``, observed while the lake is written.
    ``cube_path`` keeps the partial cubes of ``streaming.cube``, ``ledger_path``
    the loaded lines of each file for ``streaming.ledger.load_grown`` (lake rows
    then name their file in a further column).
    """
    raw = raw_files(spark, src_dir, suffix, streaming=True,
                    max_files_per_trigger=max_files_per_trigger, archive_dir=archive_dir,
                    source=SOURCE if ledger_path else None)
    refuse_sink_log(spark, lake_path)
    rid = run_id(spark, checkpoint)
    metrics = metrics_path or lake_path.rstrip("/") + "_metrics"
    rows = to_violation(raw, noon, keep=(line_class(noon).alias(CLASS), *([SOURCE] if ledger_path else [])))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        kinds = [F.count_if(F.col(CLASS) == c).alias(c) for c in LINE_CLASSES]
        batch = batch.observe(seen, F.count(F.lit(1)).alias("lines"), *kinds)
        keep = [f.name for f in VIOLATION.fields] + ([SOURCE] if ledger_path else [])
        write_batch_table(lake_rows(batch.select(*keep), fmt), lake_path, rid, batch_id, fmt, options)
        found = seen.get
        row = [tuple(found[c] for c in ("lines", *LINE_CLASSES))]
        write_batch_table(spark.createDataFrame(row, _METRICS).coalesce(1), metrics, rid, batch_id)
        if cube_path:
            add_batch(spark, lake_path, cube_path, rid, batch_id, fmt)
        if ledger_path and found["lines"]:
            note_batch(spark, lake_path, ledger_path, rid, batch_id, fmt)

    return _start(rows, on_batch, checkpoint, processing_time is None, processing_time, wait)


def read_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    """One row a batch: its lines, and how many of them are of each class."""
    return spark.read.schema(f"{_METRICS}, run_id string, batch_id long").parquet(metrics_path)


def grown_files(spark: SparkSession, src_dir: str, checkpoint: str,
                suffix: str = RAW_SUFFIX) -> DataFrame:
    """Files of ``src_dir`` that changed after a load had read them: path, loaded, changed.

    A load reads each file once; lines added later come with ``load_grown`` if
    the load keeps a ledger, and this report finds such files.  ``loaded`` and
    ``changed`` are the modification times in epoch milliseconds, from the
    load's own source log and from the folder now.
    """
    return changed_since(spark, src_dir, checkpoint, suffix)


def historic_messages(spark: SparkSession, src_dir: str, suffix: str = RAW_SUFFIX,
                      noon: str = "reference",
                      max_files_per_trigger: int | None = None,
                      partitions: int | None = None) -> DataFrame:
    """Streaming ``key, value``: every new police line as violation JSON under
    the historic key (the first half of the two-stage load through a topic).
    ``partitions`` spreads the topic, see ``keyed_payload``."""
    raw = raw_files(spark, src_dir, suffix, streaming=True,
                    max_files_per_trigger=max_files_per_trigger)
    return keyed_payload(to_violation(raw, noon), HISTORIC_KEY, partitions)


def publish_historic(spark: SparkSession, src_dir: str, servers: str, checkpoint: str,
                     topic: str = HISTORIC_TOPIC, suffix: str = RAW_SUFFIX,
                     noon: str = "reference", max_files_per_trigger: int | None = None,
                     wait: bool = True, partitions: int | None = None) -> StreamingQuery:
    """Send every new police line to the historic topic, each file once."""
    q = (historic_messages(spark, src_dir, suffix, noon, max_files_per_trigger, partitions)
         .writeStream.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def save_violations(stream: DataFrame, lake_path: str, checkpoint: str,
                    fmt: str = "parquet", available_now: bool = True,
                    processing_time: str | None = None,
                    options: dict[str, str] | None = None,
                    wait: bool = True, rejects_path: str | None = None,
                    cube_path: str | None = None) -> StreamingQuery:
    """Keyed stream of violation JSON → lake and rejects.

    Batch size is set on the source (``maxOffsetsPerTrigger`` for a topic,
    ``maxFilesPerTrigger`` for files).  Undecodable messages go to
    ``rejects_path`` (``<lake>_rejects`` by default), never away.  Each
    micro-batch is decoded once and written to both tables through idempotent
    ``run_id/batch_id`` partitions.  ``cube_path`` keeps the partial cubes of
    ``streaming.cube``.
    """
    spark = stream.sparkSession
    rejects_path = rejects_path or lake_path.rstrip("/") + "_rejects"
    refuse_sink_log(spark, lake_path)
    refuse_sink_log(spark, rejects_path)
    rid = run_id(spark, checkpoint)
    keep = tuple(c for c in ("partition", "offset") if c in stream.columns)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        c = checked(batch, "violation").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch_table(lake_rows(good(c, "violation"), fmt), lake_path, rid, batch_id,
                              fmt, options)
            # rejects hold raw text: always Parquet, which keeps it as it came
            write_batch_table(rejects(c, keep), rejects_path, rid, batch_id)
        finally:
            c.unpersist()
        if cube_path:
            add_batch(spark, lake_path, cube_path, rid, batch_id, fmt)

    return _start(stream, on_batch, checkpoint, available_now, processing_time, wait)
