"""Ledger of loaded lines, and the load of lines added to files later.

Streaming loads take each file once, whole.  With a ledger they also note, batch
by batch, how many lines of each file they loaded (``path, first, lines`` under
the batch's ``run_id, batch_id``).  ``load_grown`` then reads the files that
changed after they were loaded, numbers their lines, leaves out those the ledger
holds and adds the rest to the lake.

Each such load is a batch with a number of its own.  Its ledger rows are written
first and say which lines it takes; then come its lake rows, and a ``done`` record
closes it.  A load that stopped in between is finished first, from its ledger
rows, into the same partition: no line is lost or comes twice.

A file may only grow at its end: a changed line that was loaded before stays as
it was, and a file cut shorter adds nothing.  Files loaded without a ledger are
left alone (``grown_files`` reports them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import plain_path
from ..operators.conform import to_violation
from ..session import scratch_path
from ..sources.lake import create_once, names_in
from ..sources.raw import RAW_SUFFIX, numbered_lines, raw_records
from ..sources.tables import path_exists
from .cube import add_batch
from .idempotent import run_id, write_batch_table

LEDGER = "path string, first long, lines long, run_id string, batch_id long"
#: Column of a lake row that names its file, while a ledger is kept.
SOURCE = "source_file"


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    if path_exists(spark, ledger_path):
        return spark.read.schema(LEDGER).parquet(ledger_path)
    return spark.createDataFrame([], LEDGER)


def note_batch(spark: SparkSession, lake_path: str, ledger_path: str, rid: str, batch_id: int, fmt: str) -> None:
    """Count a stored batch's rows by file; reads one column of its folder."""
    folder = f"{lake_path.rstrip('/')}/run_id={rid}/batch_id={batch_id}"
    if fmt == "csv":  # by position: the file is the last of seven columns
        rows = spark.read.schema(", ".join(f"_c{i} string" for i in range(7))).csv(folder).withColumnRenamed("_c6", SOURCE)
    else:
        rows = spark.read.schema(f"{SOURCE} string").format(fmt).load(folder)
    counts = rows.groupBy(F.col(SOURCE).alias("path")).agg(F.count(F.lit(1)).alias("lines"))
    write_batch_table(counts.select("path", F.lit(0).cast("long").alias("first"), "lines"), ledger_path, rid, batch_id)


def changed_since(spark: SparkSession, src_dir: str, checkpoint: str, suffix: str = RAW_SUFFIX) -> DataFrame:
    """(path, loaded, changed): files of ``src_dir`` changed after the load read them, times in epoch milliseconds."""
    log = (spark.read.option("recursiveFileLookup", "true")
           .text(checkpoint.rstrip("/") + "/sources").where(F.col("value").startswith("{")))
    entry = F.from_json("value", "path string, timestamp long")
    seen = log.select(entry.alias("e")).groupBy(plain_path(F.col("e.path")).alias("path")).agg(
        F.max("e.timestamp").alias("loaded"))
    now = (spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").load(src_dir)
           .select(plain_path(F.col("path")).alias("now_path"), F.unix_millis("modificationTime").alias("changed")))
    return seen.join(now, F.col("path") == F.col("now_path")).where("changed > loaded").select("path", "loaded", "changed")


def load_grown(spark: SparkSession, src_dir: str, lake_path: str, checkpoint: str, ledger_path: str,
               fmt: str = "parquet", suffix: str = RAW_SUFFIX, noon: str = "reference",
               cube_path: str | None = None, options: dict[str, str] | None = None) -> int:
    """Add the lines that files of ``src_dir`` got after ``load_historic`` read them; how many there were.

    Run it between loads that use the same checkpoint, one at a time."""
    rid = run_id(spark, checkpoint) + "-grown"
    done = [int(n) for n in names_in(spark, f"{ledger_path.rstrip('/')}/_done/{rid}") if n.isdigit()]
    own = read_ledger(spark, ledger_path).where(F.col("run_id") == rid)
    last = own.agg(F.max("batch_id")).first()[0]
    if last is not None and last not in done:
        _add(spark, own.where(F.col("batch_id") == last), lake_path, ledger_path, rid, last, fmt, noon, cube_path, options)
    batch_id = 0 if last is None else last + 1
    loaded = read_ledger(spark, ledger_path).groupBy("path").agg(F.max(F.col("first") + F.col("lines")).alias("loaded"))
    grown = changed_since(spark, src_dir, checkpoint, suffix).join(loaded.drop("loaded"), "path", "left_semi")
    paths = [r["path"] for r in grown.select("path").collect()]  # names of the files that grew
    if not paths:
        return 0
    lines = numbered_lines(spark, paths, scratch_path(spark, "grown"))
    ranges = (lines.groupBy("path").agg(F.count(F.lit(1)).alias("now")).join(loaded, "path").where("now > loaded")
              .select("path", F.col("loaded").alias("first"), (F.col("now") - F.col("loaded")).alias("lines")))
    write_batch_table(ranges, ledger_path, rid, batch_id)
    taken = read_ledger(spark, ledger_path).where((F.col("run_id") == rid) & (F.col("batch_id") == batch_id))
    added = taken.agg(F.sum("lines")).first()[0]
    if not added:
        return 0
    _add(spark, taken, lake_path, ledger_path, rid, batch_id, fmt, noon, cube_path, options, lines)
    return added


def _add(spark: SparkSession, taken: DataFrame, lake_path: str, ledger_path: str, rid: str, batch_id: int, fmt: str,
         noon: str, cube_path: str | None, options: dict[str, str] | None, lines: DataFrame | None = None) -> None:
    """The lake rows (and partial cube) of the lines that a batch's ledger rows take, then its ``done`` record."""
    from .load import lake_rows
    if lines is None:
        paths = [r["path"] for r in taken.select("path").collect()]
        lines = numbered_lines(spark, paths, scratch_path(spark, "grown"))
    ranges = taken.select(F.col("path").alias("t_path"), "first", "lines")
    new = lines.join(ranges, (F.col("path") == F.col("t_path")) & (F.col("line") >= F.col("first"))
                     & (F.col("line") < F.col("first") + F.col("lines")), "left_semi")
    rows = to_violation(raw_records(new, "value", keep=("path",)), noon)
    write_batch_table(lake_rows(rows, fmt), lake_path, rid, batch_id, fmt, options)
    if cube_path:
        add_batch(spark, lake_path, cube_path, rid, batch_id, fmt)
    create_once(spark, f"{ledger_path.rstrip('/')}/_done/{rid}/{batch_id}", "")
