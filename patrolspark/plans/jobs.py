"""End-to-end jobs: what the original system's runnable applications did.

* ``analyse_lake``: lake table → the four answers, one small file each.
* ``load``: police file directory → lake (resumable; see ``streaming.load``).
* ``save``: keyed violation topic → lake.
* ``consume``: keyed live message stream → standard / violation / images /
  alerts / rejects tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import KEYED
from ..sources.lake import read_lake
from ..sources.publish import publish, read_published
from ..sources.tables import write_result
from ..streaming.cube import read_cube
from . import analyses as A

#: Columns of the written answers.
ANSWERS = {
    "season_share": "season string, number_of_violations long, percent double",
    "top5_codes": "violation_code string, number_of_violations long, percent double",
    "period_share": "period string, number_of_violations long, percent double",
    "top_code_per_season": "season string, violation_code string, number_of_violations long, percent double",
}


def result_order(key: str) -> list:
    """Final ordering of each written answer (count first, then label)."""
    n = F.col("number_of_violations").desc()
    return {"season_share": [n, F.col("season")],
            "top5_codes": [n, F.col("violation_code").asc_nulls_first()],
            "period_share": [n, F.col("period")],
            "top_code_per_season": [F.col("season")]}[key]


def migrate_lake(spark: SparkSession, csv_lake: str, parquet_lake: str,
                 mode: str = "errorifexists") -> None:
    """One pass: an existing headerless-CSV lake → a typed Parquet lake.

    Afterwards the analyses read two columns and push ``isnotnull`` into the
    scan instead of tokenising every CSV line.  A map-only job: no shuffle,
    one output file per input split.
    """
    read_lake(spark, csv_lake, "csv").write.mode(mode).parquet(parquet_lake)


def analyse_lake(spark: SparkSession, lake_path: str, out_dir: str | None = None,
                 lake_format: str = "parquet", result_format: str = "csv",
                 header: bool = False, cube_path: str | None = None, together: bool = False) -> dict:
    """Run the four analyses over the lake in one scan; write each answer as
    one file under ``out_dir/<name>`` if given (CSV without a header by
    default, as the original system wrote them).  Returns the rows.

    With ``cube_path``, the partial cubes kept there by the lake's writers answer
    instead, and the lake is not read.  ``together`` publishes the four answers as
    one set (``sources.publish``): readers see all of this run or all of the last.
    """
    if cube_path:
        results, cube = A.answers_from(read_cube(spark, cube_path))
    else:
        results, cube = A.run_all(read_lake(spark, lake_path, lake_format))
    try:
        cube.count()  # one scan of the lake fills the cached cube
        ordered = {k: df.orderBy(*result_order(k)) for k, df in results.items()}
        opts = {"header": str(header).lower()} if result_format == "csv" else None
        if out_dir and together:
            publish(spark, out_dir, ordered, result_format, opts, each=A.run_concurrently)

        def answer(k: str, df: DataFrame):
            if out_dir and not together:
                write_result(df, f"{out_dir.rstrip('/')}/{k}", result_format, opts)
            return df.collect()  # ≤ 5 rows each

        return A.run_concurrently(ordered, answer)
    finally:
        cube.unpersist()


def read_answers(spark: SparkSession, out_dir: str, header: bool = False) -> dict[str, DataFrame]:
    """The four answers of the set published last under ``out_dir``, all of one run."""
    opts = {"header": str(header).lower()}
    return read_published(spark, out_dir, ANSWERS, opts)


def message_source(spark: SparkSession, topic: str | None = None, servers: str | None = None,
                   directory: str | None = None, max_per_trigger: int | None = None,
                   min_partitions: int | None = None) -> DataFrame:
    """A keyed stream from a topic, or from a directory of JSON lines shaped
    ``key, value, partition, offset`` (the same columns)."""
    if topic:
        from ..sources.kafka import keyed_stream
        return keyed_stream(spark, topic, servers, max_offsets_per_trigger=max_per_trigger,
                            min_partitions=min_partitions)
    r = spark.readStream.schema(KEYED)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    return r.json(directory)
