"""File paths as Spark's sources report them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_path(c: Column) -> Column:
    """One spelling for a file's path: decoded, and ``file:///x`` as ``file:/x``."""
    return F.regexp_replace(F.coalesce(F.try_url_decode(c), c), "^([a-zA-Z0-9]+):/+", "$1:/")
