"""Band filters: rows of one season or one period of the day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import PERIODS, SEASONS, period, season


def in_season(df: DataFrame, name: str, date_col: str = "sending_date",
              tag: str | None = "season") -> DataFrame:
    """Rows whose date falls in season ``name`` (undated rows never do)."""
    if name not in SEASONS:
        raise ValueError(f"unknown season {name!r}")
    out = df.where(season(date_col) == name)
    return out.withColumn(tag, F.lit(name)) if tag else out


def in_period(df: DataFrame, name: str, date_col: str = "sending_date",
              tag: str | None = "period") -> DataFrame:
    """Rows whose time of day falls in period ``name``."""
    if name not in PERIODS:
        raise ValueError(f"unknown period {name!r}")
    out = df.where(period(date_col) == name)
    return out.withColumn(tag, F.lit(name)) if tag else out
