"""The violation lake on disk: reading all of it, and merging its small files.

A lake is a folder of batch folders (``run_id=…/batch_id=…``) and of files that
plain appends left.  ``compact_lake`` packs its small files into files of about
``target`` bytes, a *generation* at a time, under the hidden folder ``_packed``:

* ``replaced/<generation>`` lists the files it merges, written first;
* ``data/<generation>`` holds their rows;
* ``live/<n>`` is the switch record, created last and exclusively: from then on
  every ``read_lake`` takes the merged rows and leaves the listed files out;
* ``cleared/<n>`` says that the listed files have been deleted.

A run that stops before the switch record leaves a folder that nobody reads; one
that stops after it leaves files that nobody counts.  Two compactions at once
race for the same record, and the loser changes nothing.

It is safe beside running writers: a batch folder is touched only if its run has
a later batch, because a streaming query starts a batch after committing the one
before, so a replay can no longer rewrite it.  Deleting the merged files is a
step of its own (``remove_replaced``), for when no reader that listed the lake
earlier still runs.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import plain_path
from ..operators.conform import conform
from ..schemas import VIOLATION
from .tables import path_exists, read_table, write_table

PACKED = "_packed"
#: A file below this share of the target is small.
SMALL = 0.5
TARGET_BYTES = 512 << 20
#: Files merged by one generation; what is left goes into the next.
FILES_AT_ONCE = 50_000
#: Folders whose files ``read_lake`` must list by themselves.
_WHOLE = {"recursiveFileLookup": "true"}
REPLACED = "path string, length long, bin int, run_id string, batch_id long"


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a small folder; none if it is not there."""
    fs, folder = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    fs, name = _fs(spark, path)
    fs.delete(name, True)


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; an error if it is there already."""
    fs, name = _fs(spark, path)
    out = fs.create(name, False)
    out.write(bytearray(text.encode()))
    out.close()


def generations(spark: SparkSession, lake: str) -> list[tuple[int, str, bool]]:
    """(number, folder, whether its merged files are gone) of every live generation, in order."""
    base = f"{lake}/{PACKED}"
    gone = set(names_in(spark, f"{base}/cleared"))
    numbers = sorted(int(n) for n in names_in(spark, f"{base}/live") if n.isdigit())
    if not numbers:
        return []
    rows = spark.read.text(f"{base}/live", wholetext=True).select("_metadata.file_name", "value").collect()  # one a generation
    folder = {int(r["file_name"]): json.loads(r["value"])["folder"] for r in rows if r["file_name"].isdigit()}
    return [(n, folder[n], str(n) in gone) for n in numbers if n in folder]


def replaced_files(spark: SparkSession, lake: str, folders: list[str]) -> DataFrame:
    """(path, length, bin, run_id, batch_id, folder) of the files that the generations in ``folders`` merged."""
    paths = [f"{lake}/{PACKED}/replaced/{f}" for f in folders]
    rows = spark.read.schema(REPLACED).parquet(*paths)
    return rows.withColumn("folder", F.regexp_extract("_metadata.file_path", "/([^/]+)/[^/]+$", 1))


def _roots(lake: str, live: list[tuple[int, str, bool]]) -> list[str]:
    return [lake, *(f"{lake}/{PACKED}/data/{folder}" for _, folder, _ in live)]


def read_lake(spark: SparkSession, lake_path: str, fmt: str = "parquet") -> DataFrame:
    """The lake as VIOLATION rows: every file in the folder, whether a batch
    wrote it, a plain append or a compaction.  A CSV lake is untyped and headerless,
    so it is read as text columns and conformed by position; other formats are
    already typed.

    Only between a compaction's switch and the deletion of the merged files does a
    read carry a join, which leaves those files out."""
    lake = lake_path.rstrip("/")
    live = generations(spark, lake)
    text = ", ".join(f"_c{i} string" for i in range(len(VIOLATION.fields)))
    if not live:
        rows = read_table(spark, lake_path, fmt, _WHOLE, text if fmt == "csv" else VIOLATION)
    else:
        roots, folders = _roots(lake, live), [f for _, f, cleared in live if not cleared]
        files = _listed(spark, roots) if folders else None  # before the rows' own listing: it misses none of theirs
        rows = spark.read.format(fmt).schema(text if fmt == "csv" else VIOLATION).options(**_WHOLE).load(roots)
        rows = _without(spark, lake, rows, files, folders)
    return conform(rows, VIOLATION) if fmt == "csv" else rows


def _listed(spark: SparkSession, roots: list[str]) -> DataFrame:
    """(path, file_path, length) of all files in ``roots``; ``file_path`` is spelled as in the metadata of their rows."""
    files = spark.read.format("binaryFile").options(**_WHOLE).load(roots)
    return files.select(plain_path(F.col("path")).alias("path"), F.col("_metadata.file_path").alias("file_path"), "length")


def _without(spark: SparkSession, lake: str, rows: DataFrame, files: DataFrame, folders: list[str]) -> DataFrame:
    """``rows`` but for those of ``files`` that the generations in ``folders`` have merged."""
    if not folders:
        return rows
    # spelled as rows name their files, so that the path is decoded once a file and not once a row
    merged = (files.join(replaced_files(spark, lake, folders).select("path"), "path", "left_semi")
              .select(F.col("file_path").alias("merged_path")))
    names = rows.columns
    rows = rows.withColumn("from_path", F.col("_metadata.file_path"))
    # one short row a file; the lake's rows are not shuffled for it
    return rows.join(F.broadcast(merged), F.col("from_path") == F.col("merged_path"), "left_anti").select(*names)


def lake_files(spark: SparkSession, lake_path: str) -> DataFrame:
    """(path, file_path, length, run_id, batch_id) of every file that ``read_lake`` reads; run and batch null
    for other files, ``file_path`` as in the metadata of their rows."""
    lake = lake_path.rstrip("/")
    live = generations(spark, lake)
    if not path_exists(spark, lake):
        return spark.createDataFrame([], "path string, file_path string, length long, run_id string, batch_id long")
    inside = F.regexp_extract("path", r"/run_id=([^/]+)/batch_id=(\d+)/[^/]+$", 1)
    number = F.regexp_extract("path", r"/run_id=([^/]+)/batch_id=(\d+)/[^/]+$", 2)
    files = _listed(spark, _roots(lake, live)).select(
        "path", "file_path", "length", F.nullif(inside, F.lit("")).alias("run_id"),
        F.nullif(number, F.lit("")).cast("long").alias("batch_id"))
    folders = [f for _, f, cleared in live if not cleared]
    if folders:
        files = files.join(replaced_files(spark, lake, folders).select("path"), "path", "left_anti")
    return files


def closed_files(files: DataFrame) -> DataFrame:
    """Files no writer can touch again: all but those of the newest batch of each run."""
    newest = files.groupBy("run_id").agg(F.max("batch_id").alias("newest")).withColumnRenamed("run_id", "n_run")
    files = files.join(newest, F.col("run_id") == F.col("n_run"), "left")
    return files.where(F.col("run_id").isNull() | (F.col("batch_id") < F.col("newest"))).drop("n_run", "newest")


def pack(sizes: list[tuple[str, int]], target: int) -> list[list[str]]:
    """Bins of at least two files and at most ``target`` bytes: first fit, largest first."""
    bins: list[tuple[int, list[str]]] = []
    open_: list[int] = []  # bins with room left
    for path, size in sorted(sizes, key=lambda s: (-s[1], s[0])):
        for k in open_:
            used, names = bins[k]
            if used + size <= target:
                names.append(path)
                bins[k] = (used + size, names)
                break
        else:
            bins.append((size, [path]))
            open_.append(len(bins) - 1)
        open_ = [k for k in open_[-64:] if bins[k][0] < target]  # the oldest of many open bins are full enough
    return [names for _, names in bins if len(names) > 1]


def _merge(spark: SparkSession, lake: str, fmt: str, target: int, files_at_once: int) -> bool:
    """One generation; whether there was anything to merge."""
    small = closed_files(lake_files(spark, lake)).where(F.col("length") < SMALL * target)
    found = {r["path"]: r for r in small.orderBy("length", "path").limit(files_at_once).collect()}  # names and sizes only
    bins = pack([(p, r["length"]) for p, r in found.items()], target)
    if not bins:
        return False
    number = max((n for n, _, _ in generations(spark, lake)), default=0) + 1
    folder = f"{number:08d}-{uuid.uuid4().hex}"
    base = f"{lake}/{PACKED}"
    plan = [(p, found[p]["length"], k, found[p]["run_id"], found[p]["batch_id"]) for k, b in enumerate(bins) for p in b]
    spark.createDataFrame(plan, REPLACED).coalesce(1).write.mode("errorifexists").parquet(f"{base}/replaced/{folder}")
    schema = ", ".join(f"_c{i} string" for i in range(len(VIOLATION.fields))) if fmt == "csv" else VIOLATION
    rows = spark.read.format(fmt).schema(schema).load([p for p, *_ in plan])
    into = spark.createDataFrame([(found[p]["file_path"], k) for p, _, k, _, _ in plan], "bin_path string, bin int")
    names = rows.columns
    read = Observation()
    rows = rows.withColumn("from_path", F.col("_metadata.file_path")).observe(read, F.count(F.lit(1)).alias("n"))
    # one short row a file, at most files_at_once
    rows = rows.join(F.broadcast(into), F.col("from_path") == F.col("bin_path"))
    data = f"{base}/data/{folder}"
    # by number, not by range: a range is sampled, which reads and counts the rows twice
    write_table(rows.repartitionById(len(bins), "bin").select(*names), data, fmt, "errorifexists")
    have = spark.read.format(fmt).schema(schema).load(data).count()
    if have != read.get["n"]:
        raise RuntimeError(f"{have} rows merged, {read.get['n']} rows in the files")
    _switch(spark, lake, number, folder)
    return True


def _switch(spark: SparkSession, lake: str, number: int, folder: str) -> None:
    """Make a generation live; fails if another one took its number."""
    create_once(spark, f"{lake}/{PACKED}/live/{number}", json.dumps({"folder": folder}))


def compact_lake(spark: SparkSession, lake_path: str, fmt: str = "parquet", target_bytes: int = TARGET_BYTES,
                 files_at_once: int = FILES_AT_ONCE, remove: bool = False) -> int:
    """Merge the lake's small closed files; the number of generations made.

    ``remove`` deletes the merged files right away: only when no other reader of
    the lake runs."""
    lake, made = lake_path.rstrip("/"), 0
    while _merge(spark, lake, fmt, target_bytes, files_at_once):
        made += 1
    if remove:
        remove_replaced(spark, lake)
    return made


def remove_replaced(spark: SparkSession, lake_path: str) -> int:
    """Delete the files that live generations have merged; a stopped run can be repeated."""
    lake, count = lake_path.rstrip("/"), 0
    for number, folder, cleared in generations(spark, lake):
        if cleared:
            continue
        for r in replaced_files(spark, lake, [folder]).select("path").toLocalIterator():  # FILES_AT_ONCE names
            fs, name = _fs(spark, r["path"])
            count += bool(fs.delete(name, False))
        create_once(spark, f"{lake}/{PACKED}/cleared/{number}", "")
    return count


__all__ = ["read_lake", "compact_lake", "remove_replaced", "lake_files", "closed_files", "pack", "names_in", "create_once", "remove_folder"]
