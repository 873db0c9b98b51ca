"""Raw police files: a directory of wide CSV files, read once each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import RAW_SUFFIX
from ..functions.parse import field, split_fields
from ..functions.paths import plain_path
from ..schemas import RAW

# A streaming file source ignores a new file whose modification time is more
# than ``maxFileAge`` older than the newest file seen (default 7 days).
# Historic files are often copied with their original times, so the age
# limit is effectively lifted; the price is that the source remembers every
# file name it has seen.  ``archive_dir`` bounds that: finished files move
# there, and the source forgets them.
HISTORIC_MAX_FILE_AGE = "36500d"


def raw_files(spark: SparkSession, directory: str, suffix: str = RAW_SUFFIX,
              streaming: bool = False, schema: T.StructType = RAW,
              max_files_per_trigger: int | None = None,
              max_file_age: str = HISTORIC_MAX_FILE_AGE,
              archive_dir: str | None = None, source: str | None = None) -> DataFrame:
    """Plain ``*.<suffix>`` files of one directory (no recursion) as RAW rows.

    Files are read as lines and split by the same rule as single lines
    (``split_fields``), so a doubled quote, a quote inside a field or a
    backslash before one never shifts the fields after it.  The header line
    is data (its date fails to parse and the record is dropped later as
    undated); short lines give null fields, long lines are cut.  The text
    reader splits files into blocks, so one huge file still spreads over many
    tasks.  ``source`` names a column that carries each line's file along.
    """
    reader = spark.readStream if streaming else spark.read
    reader = (reader.format("text")
              .option("pathGlobFilter", f"*.{suffix}")
              .option("recursiveFileLookup", "false"))
    if streaming:
        reader = reader.option("maxFileAge", max_file_age)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        if archive_dir:
            reader = (reader.option("cleanSource", "archive")
                      .option("sourceArchiveDir", archive_dir))
    lines = reader.load(directory)
    if source is None:
        return raw_records(lines, "value", schema)
    return raw_records(lines.withColumn(source, plain_path(F.col("_metadata.file_path"))), "value", schema, keep=(source,))


def unquoted(c: Column) -> Column:
    """A field without its outer pair of quotes, if it has one."""
    quoted = (F.length(c) >= 2) & c.startswith('"') & c.endswith('"')
    return F.when(quoted, F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(c)


def raw_records(lines: DataFrame, line_col: str = "line",
                schema: T.StructType = RAW, keep: tuple[str, ...] = ()) -> DataFrame:
    """A frame of text lines → RAW rows; ``raw_files`` uses the same rule."""
    parts = lines.select(split_fields(F.col(line_col)).alias("__parts"), *keep)
    return parts.select(*[unquoted(field("__parts", i)).alias(f.name)
                          for i, f in enumerate(schema.fields)], *keep)


def numbered_lines(spark: SparkSession, paths: list[str], store: str) -> DataFrame:
    """(path, line, value): every line of some files with its number in the file, from 0.

    The text reader gives each line's block, and the lines of a block in order.
    They are stored under ``store`` once, so that numbers and lines come from one
    reading even while a file grows; then a block's first number is the count of
    lines in the blocks before it.  No file passes through one task.
    """
    path = plain_path(F.col("_metadata.file_path"))
    (spark.read.text(paths).select(
        path.alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value").write.mode("overwrite").parquet(store))
    lines = spark.read.parquet(store)
    blocks = lines.groupBy("path", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("path").alias("b_path"), F.col("block").alias("b_block"), "first",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))  # a few rows a file
    lines = lines.join(blocks, (F.col("path") == F.col("b_path")) & (F.col("block") == F.col("b_block")))
    return lines.select("path", (F.col("before") + F.col("at") - F.col("first")).alias("line"), "value")
