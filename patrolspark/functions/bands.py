"""Calendar labels: season of a date and period of the day.

The four season bands tile the year and the two periods tile the day, so one
label column replaces a filter per band.  The bands are data
(``band_table``).  Comparisons are done on integers
(``month*100 + day``, ``hour*60 + minute``) rather than formatted strings.
The fields are the built-in calendar functions, in the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import (AUTUMN_START, DAY_START_HHMM, NIGHT_START_HHMM, PERIOD_NAMES,
                     SEASON_NAMES, SPRING_START, SUMMER_START, WINTER_START)
from ..util import as_col
from .band_table import BandTable

SEASONS = SEASON_NAMES
PERIODS = PERIOD_NAMES
# Period starts as minutes of the day.
NIGHT_START = (NIGHT_START_HHMM // 100) * 60 + NIGHT_START_HHMM % 100
DAY_START = (DAY_START_HHMM // 100) * 60 + DAY_START_HHMM % 100


def month_day(c) -> Column:
    """``month*100 + day`` of a timestamp in the session zone."""
    c = as_col(c)
    return F.month(c) * 100 + F.dayofmonth(c)


def minute_of_day(c) -> Column:
    """``hour*60 + minute`` of a timestamp in the session zone."""
    c = as_col(c)
    return F.hour(c) * 60 + F.minute(c)


#: The bands as data, in the order of their indices: name, start, end (month-day or minute of the day).
SEASON_TABLE = BandTable.of([("winter", WINTER_START, SPRING_START), ("spring", SPRING_START, SUMMER_START),
                             ("summer", SUMMER_START, AUTUMN_START), ("autumn", AUTUMN_START, WINTER_START)])
PERIOD_TABLE = BandTable.of([("night", NIGHT_START, DAY_START), ("day", DAY_START, NIGHT_START)])
if SEASON_TABLE.names != SEASONS or PERIOD_TABLE.names != PERIODS:
    raise ImportError("band indices must follow the fixed names")


def season_index(c) -> Column:
    """Season of a timestamp as 0 winter, 1 spring, 2 summer, 3 autumn; null
    for a null timestamp.  Grouping on this small integer is cheaper than on
    the name; ``season_name`` turns it into the name after aggregation."""
    return SEASON_TABLE.index(month_day(c))


def period_index(c) -> Column:
    """Period of a timestamp as 0 night, 1 day; null for a null timestamp."""
    return PERIOD_TABLE.index(minute_of_day(c))


def _name(idx, names) -> Column:
    # An explicit CASE (null for anything else): ``element_at`` over a
    # literal array was seen to return the last element for a null index.
    i = as_col(idx)
    out = F.when(i == 0, F.lit(names[0]))
    for k, n in enumerate(names[1:], start=1):
        out = out.when(i == k, F.lit(n))
    return out


def season_name(idx) -> Column:
    return _name(idx, SEASONS)


def period_name(idx) -> Column:
    return _name(idx, PERIODS)


def season(c) -> Column:
    """Season label of a timestamp; null for a null timestamp."""
    return season_name(season_index(c))


def period(c) -> Column:
    """Period-of-day label of a timestamp; null for a null timestamp."""
    return period_name(period_index(c))
