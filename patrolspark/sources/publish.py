"""Result sets that readers see whole: versioned folders and a pointer written last.

``publish`` writes every table of a set under ``versions/<version>`` and only then
creates the next numbered record under ``current``, exclusively.  A reader takes
the version of the highest record, so it never mixes tables of two sets: a run
that stops between two tables leaves a folder that nobody reads.  Of two runs at
once, the one that records last is current, with all of its tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .lake import create_once, names_in, remove_folder
from .tables import read_table, write_result


def _records(spark: SparkSession, out: str) -> list[int]:
    return sorted(int(n) for n in names_in(spark, f"{out}/current") if n.isdigit())


def _read_record(spark: SparkSession, out: str, number: int) -> dict:
    return json.loads(spark.read.text(f"{out}/current/{number}", wholetext=True).first()[0])


def publish(spark: SparkSession, out_dir: str, results: dict[str, DataFrame], fmt: str = "csv",
            options: dict[str, str] | None = None, each: Callable | None = None, keep: int = 2) -> str:
    """Write a set of small results and make it the current one; its version.

    ``each(results, action)`` runs ``action(name, df)`` for every result (one after
    the other by default).  ``keep`` sets stay, for readers that still follow an
    older record; the folders of others are removed.
    """
    out = out_dir.rstrip("/")
    version = uuid.uuid4().hex

    def write(name: str, df: DataFrame) -> None:
        write_result(df, f"{out}/versions/{version}/{name}", fmt, options)

    if each is None:
        for name, df in results.items():
            write(name, df)
    else:
        each(results, write)
    text = json.dumps({"version": version, "tables": sorted(results), "format": fmt})
    while True:
        number = max(_records(spark, out), default=0) + 1
        try:
            create_once(spark, f"{out}/current/{number}", text)
            break
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise  # another run took the number: take the next
    _prune(spark, out, keep)
    return version


def _prune(spark: SparkSession, out: str, keep: int) -> None:
    """Remove the sets of all but the last records, and those records after them."""
    for number in _records(spark, out)[:-max(1, keep)]:
        remove_folder(spark, f"{out}/versions/{_read_record(spark, out, number)['version']}")
        remove_folder(spark, f"{out}/current/{number}")


def current(spark: SparkSession, out_dir: str) -> dict:
    """The current record: version, tables and format."""
    out = out_dir.rstrip("/")
    numbers = _records(spark, out)
    if not numbers:
        raise ValueError(f"nothing is published under {out}")
    return _read_record(spark, out, numbers[-1])


def read_published(spark: SparkSession, out_dir: str, schemas: dict[str, T.StructType | str],
                   options: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Tables of one and the same set, the current one, by name."""
    record = current(spark, out_dir)
    base = f"{out_dir.rstrip('/')}/versions/{record['version']}"
    return {n: read_table(spark, f"{base}/{n}", record["format"], options, schema) for n, schema in schemas.items()}
