"""Incremental cube: partial counts per batch beside the lake, merged on read.

A lake only grows, and the four analyses need nothing but counts per season,
period and code.  Every batch that a load or a saver adds leaves a partial cube
in its own ``run_id, batch_id`` partition of a cube table, computed from the two
columns of the rows it has just stored.  A replay overwrites it, as it does the
rows.  ``read_cube`` adds the partials up: a few rows a batch, however many rows
the lake has, so the analyses never scan the lake again.

Rows that came otherwise (batches from before there was a cube, plain appends)
are a *unit* each: a batch folder, a file outside the batch folders, or a
generation of merged files.  ``backfill_cube`` counts the units that have no
partial yet, and reads only them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bands import period_index, season_index
from ..functions.paths import plain_path
from ..operators.conform import conform
from ..operators.metrics import COUNT
from ..plans.analyses import CODE, DATE, named
from ..schemas import VIOLATION
from ..sources import lake as L
from ..sources.tables import path_exists
from .idempotent import write_batch_table

#: A partial: band numbers (null for undated rows), code, codes counted, all rows.
PARTIAL = "season int, period int, violation_code string, number_of_violations long, n_rows long"
UNIT = "run_id string, batch_id long"
#: Units of rows that no batch wrote: run names, with 0 as the batch.
FILE_UNIT, MERGED_UNIT = "file-", "merged-"
UNITS_AT_ONCE = 10_000


def partial_counts(rows: DataFrame, *by: str) -> DataFrame:
    """Partial cube of some lake rows; a grouping of at most 9 bands x codes rows."""
    bands = rows.select(*by, season_index(DATE).cast("int").alias("season"), period_index(DATE).cast("int").alias("period"), CODE)
    return bands.groupBy(*by, "season", "period", CODE).agg(
        F.count(CODE).alias(COUNT), F.count(F.lit(1)).alias("n_rows"))


def _rows(spark: SparkSession, paths: list[str], fmt: str) -> DataFrame:
    if fmt != "csv":
        return spark.read.format(fmt).schema(VIOLATION).option("recursiveFileLookup", "true").load(paths)
    text = ", ".join(f"_c{i} string" for i in range(len(VIOLATION.fields)))
    return spark.read.format(fmt).schema(text).option("recursiveFileLookup", "true").load(paths)


def batch_partial(spark: SparkSession, lake_path: str, rid: str, batch_id: int, fmt: str = "parquet") -> DataFrame:
    """Partial cube of one stored batch; reads its folder alone, and of Parquet two columns of six."""
    folder = f"{lake_path.rstrip('/')}/run_id={rid}/batch_id={batch_id}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], PARTIAL)  # a batch without rows has no folder
    rows = _rows(spark, [folder], fmt)
    return partial_counts(conform(rows) if fmt == "csv" else rows)


def add_batch(spark: SparkSession, lake_path: str, cube_path: str, rid: str, batch_id: int, fmt: str = "parquet") -> None:
    """Store the partial of a batch; a repeat overwrites it."""
    write_batch_table(batch_partial(spark, lake_path, rid, batch_id, fmt), cube_path, rid, batch_id)


def _partials(spark: SparkSession, cube_path: str) -> DataFrame:
    if path_exists(spark, cube_path):
        return spark.read.schema(f"{PARTIAL}, {UNIT}").parquet(cube_path)
    return spark.createDataFrame([], f"{PARTIAL}, {UNIT}")


def read_cube(spark: SparkSession, cube_path: str) -> DataFrame:
    """The cube of everything counted so far, as ``violation_cube`` gives it."""
    dated = _partials(spark, cube_path).where("season is not null")
    return named(dated.groupBy("season", "period", CODE).agg(F.sum(COUNT).alias(COUNT)))


def _unit(lake: str) -> list[Column]:
    """run_id and batch_id of the unit that a file with ``path, run_id, batch_id`` belongs to."""
    merged = F.regexp_extract("path", f"/{L.PACKED}/data/([^/]+)/", 1)
    inside = F.substring_index("path", "/" + lake.rsplit("/", 1)[-1] + "/", -1)  # the same wherever the lake lies
    run = F.when(merged != "", F.concat(F.lit(MERGED_UNIT), merged)).otherwise(
        F.coalesce("run_id", F.concat(F.lit(FILE_UNIT), F.md5(inside))))
    return [run.alias("run_id"), F.coalesce("batch_id", F.lit(0)).alias("batch_id")]


def uncounted(spark: SparkSession, lake_path: str, cube_path: str) -> DataFrame:
    """(path, run_id, batch_id): closed files of the lake whose unit has no partial.

    The newest batch of a run is left to its own writer.  Raises if merged files
    hold rows of both counted and uncounted units.
    """
    lake = lake_path.rstrip("/")
    counted = _partials(spark, cube_path).select("run_id", "batch_id").distinct()
    files = L.closed_files(L.lake_files(spark, lake))
    files = files.select("path", *_unit(lake))
    done = _merged_units(spark, lake, counted)
    return files.join(counted, ["run_id", "batch_id"], "left_anti").join(done, "run_id", "left_anti").select("path", "run_id", "batch_id")


def _merged_units(spark: SparkSession, lake: str, counted: DataFrame) -> DataFrame:
    """(run_id): generations of merged files whose rows were all counted before they were merged."""
    folders = [f for _, f, _ in L.generations(spark, lake)]
    if not folders:
        return spark.createDataFrame([], "run_id string")
    files = L.replaced_files(spark, lake, folders)
    units = files.select("folder", *_unit(lake))
    known = counted.withColumn("known", F.lit(1))
    found = units.distinct().join(known, ["run_id", "batch_id"], "left").groupBy("folder").agg(
        F.count("known").alias("known"), F.count(F.lit(1)).alias("units"))
    own = counted.where(F.col("run_id").startswith(MERGED_UNIT)).select(F.expr(f"substr(run_id, {len(MERGED_UNIT) + 1})").alias("folder"))
    found = found.join(own, "folder", "left_anti")
    mixed = found.where("known > 0 and known < units").first()
    if mixed is not None:
        raise ValueError(f"generation {mixed['folder']} merged counted and uncounted rows; count into a new cube folder")
    return found.where("known = units").select(F.concat(F.lit(MERGED_UNIT), F.col("folder")).alias("run_id"))


def backfill_cube(spark: SparkSession, lake_path: str, cube_path: str, fmt: str = "parquet",
                  units_at_once: int = UNITS_AT_ONCE) -> int:
    """Count the units of the lake that have no partial yet; how many there were.

    Reads only their files, ``units_at_once`` units a job.  Partials are
    overwritten by unit, so a stopped run can be repeated and may run beside the
    writers that add to the lake and the cube.
    """
    todo = uncounted(spark, lake_path, cube_path)
    units = [(r["run_id"], r["batch_id"], r["paths"]) for r in todo.groupBy("run_id", "batch_id").agg(
        F.collect_list("path").alias("paths")).toLocalIterator()]  # names only
    for a in range(0, len(units), units_at_once):
        of = [(p, rid, b) for rid, b, paths in units[a:a + units_at_once] for p in paths]
        names = spark.createDataFrame(of, f"unit_path string, {UNIT}")
        rows = _rows(spark, [p for p, _, _ in of], fmt)
        source = plain_path(F.col("_metadata.file_path"))
        if fmt == "csv":
            wide = T.StructType([*VIOLATION.fields, T.StructField("unit_source", T.StringType())])
            rows = conform(rows.withColumn("unit_source", source), wide)
        else:
            rows = rows.withColumn("unit_source", source)
        # the partial per file first: the join sees a few rows a file
        parts = partial_counts(rows, "unit_source").join(names, F.col("unit_source") == F.col("unit_path"))
        empty = names.select("run_id", "batch_id").distinct().select(  # a unit without rows is counted too
            *[F.lit(None).cast(t).alias(n) for n, t in (("season", "int"), ("period", "int"), (CODE, "string"))],
            "run_id", "batch_id", *[F.lit(0).cast("long").alias(n) for n in (COUNT, "n_rows")])
        parts = parts.select(*empty.columns).unionByName(empty)
        parts = parts.groupBy("season", "period", CODE, "run_id", "batch_id").agg(
            F.sum(COUNT).alias(COUNT), F.sum("n_rows").alias("n_rows"))
        (parts.repartition("run_id", "batch_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "batch_id").parquet(cube_path))
    return len(units)
