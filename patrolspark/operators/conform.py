"""Schema conformance, raw-record mapping and the dated-row filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import compact_clock, us_date_parts, violation_ts
from ..schemas import RAW_CLOCK, RAW_CODE, RAW_DATE, VIOLATION
from ..util import null_of


def conform(df: DataFrame, schema: T.StructType = VIOLATION) -> DataFrame:
    """Conform a table to ``schema`` by position, not by name.

    Source column *i* becomes target field *i*, cast with ``try_cast`` (a bad
    value gives null, as the lake's string columns require).  Extra source
    columns are dropped; missing target fields become typed nulls.  One
    ``select``: Catalyst prunes whatever the caller does not use.
    """
    src = df.columns
    cols = []
    for i, f in enumerate(schema.fields):
        if i < len(src):
            cols.append(F.col(f"`{src[i]}`").try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _failed(df: DataFrame, schema: T.StructType) -> Column:
    """Array with, for each target field, the rows whose value is there but cannot be cast."""
    src = df.columns
    return F.array(*[
        F.count_if(F.col(f"`{src[i]}`").isNotNull() & F.col(f"`{src[i]}`").try_cast(f.dataType).isNull())
        if i < len(src) else F.lit(0).cast("long") for i, f in enumerate(schema.fields)])


def cast_report(df: DataFrame, schema: T.StructType = VIOLATION) -> DataFrame:
    """What ``conform`` would null: one row per target field with its position, the source column
    (null if there is none), the rows, the null values and the values whose cast fails.

    One aggregation of one row, unpacked afterwards, however many fields there are.
    """
    src = df.columns
    nulls = F.array(*[F.count_if(F.col(f"`{src[i]}`").isNull()) if i < len(src) else F.count(F.lit(1))
                      for i in range(len(schema.fields))])
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("nulls"), _failed(df, schema).alias("failures"))
    names = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("field"),
                               F.lit(src[i] if i < len(src) else None).cast("string").alias("source"))
                      for i, f in enumerate(schema.fields)])
    return one.select("*", F.inline(names)).select(
        "position", "field", "source", "n_rows", F.get("nulls", F.col("position")).alias("nulls"),
        F.get("failures", F.col("position")).alias("failures"))


def conform_observed(df: DataFrame, schema: T.StructType = VIOLATION) -> tuple[DataFrame, Observation]:
    """``conform`` and, from the same pass over the rows, the failures of each field.

    Once an action on the rows has run, ``observation.get["failures"]`` is a list in field order."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), _failed(df, schema).alias("failures"))
    return conform(counted, schema), seen


def prepared(df: DataFrame, date_col: str = "sending_date") -> DataFrame:
    """Keep dated rows only (the analyses ignore undated records)."""
    return df.where(F.col(date_col).isNotNull())


#: What became of a raw line; every line is exactly one of these.
LINE_CLASSES = ("dated", "short", "header", "out_of_range", "undated")


def line_class(noon: str = "reference") -> Column:
    """The class of a RAW row: ``dated``; ``short`` of fields; a ``header`` (a date field of
    letters without a digit); ``out_of_range`` (date and clock are numbers, but beyond
    what a timestamp may be); else ``undated``."""
    date, clock = F.col(RAW_DATE), F.col(RAW_CLOCK)
    numbers = us_date_parts(date).isNotNull() & compact_clock(clock, noon).isNotNull()
    return (F.when(clock.isNull(), "short").when(violation_ts(date, clock, noon).isNotNull(), "dated")
            .when(date.rlike("[A-Za-z]") & ~date.rlike("[0-9]"), "header")
            .when(numbers, "out_of_range").otherwise("undated"))


def to_violation(raw: DataFrame, noon: str = "reference",
                 keep: tuple = ()) -> DataFrame:
    """Raw police record → violation record.

    Date from position 4 plus clock from position 19; code from position 5
    with an empty code as null; every other field null.  ``keep`` carries
    raw columns along (e.g. a line id).
    """
    return raw.select(
        *keep,
        null_of("double").alias("lat"),
        null_of("double").alias("lng"),
        violation_ts(F.col(RAW_DATE), F.col(RAW_CLOCK), noon).alias("sending_date"),
        null_of("string").alias("drone_id"),
        F.nullif(F.col(RAW_CODE), F.lit("")).alias("violation_code"),
        null_of("string").alias("image_id"),
    )
