"""Generic table read/write and the single-file result sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store its scheme names."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()).exists(name)


# Spark's CSV writer cuts microseconds to milliseconds by default.
CSV_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
             "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               options: dict[str, str] | None = None,
               schema: T.StructType | str | None = None) -> DataFrame:
    """Read a table in any format Spark knows.  Pass ``schema`` for text
    formats at scale: inference costs an extra pass over the data."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if options:
        r = r.options(**options)
    return r.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                options: dict[str, str] | None = None,
                partition_by: list[str] | None = None) -> None:
    """Write a table; append by default (the lake only grows).

    CSV keeps microseconds (``CSV_TIMES``) unless ``options`` say otherwise.
    """
    w = df.write.format(fmt).mode(mode)
    options = {**(CSV_TIMES if fmt == "csv" else {}), **(options or {})}
    if options:
        w = w.options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_result(df: DataFrame, path: str, fmt: str = "csv",
                 options: dict[str, str] | None = None) -> None:
    """Overwrite ``path`` with one part file.

    Only for small final answers (a handful of rows): ``coalesce(1)`` merges
    the last stage without a shuffle and keeps a prior ``orderBy`` order.
    """
    w = df.coalesce(1).write.format(fmt).mode("overwrite")
    if options:
        w = w.options(**options)
    w.save(path)
