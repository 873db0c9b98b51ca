"""Column functions for raw police lines: field split, US date, compact clock.

All of them are plain Catalyst expressions (no Python per row).  Bad input
gives null, never an error, so an untrusted line cannot stop a job even with
ANSI mode on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..util import as_col

from ..fixed import AFTERNOON_MARK, ALERT_DATE_FORMAT, DATE_SEPARATOR, MORNING_MARK

# One field and the comma that ends it, from where the field before ended: quoted stretches keep their
# commas.  In a line with an odd number of quotes the first quote opens nothing, so its first field
# takes what stands before that quote and the quote itself.  Only possessive loops: no backtracking,
# and no recursion of the regex engine however many quotes a line has.
_ODD_START = r'\A(?=[^"]*+"(?:[^"]*+"[^"]*+")*+[^"]*+\z)[^"]*+"'
_FIELD = rf'\G((?:{_ODD_START})?+[^",]*+(?:"[^"]*+"[^",]*+)*+),'


def split_fields(line) -> Column:
    """Quote-aware split of one CSV line held in a string column: a comma
    followed by an even number of double quotes up to the end of the line is
    a separator (``fixed.LINE_SPLIT_REGEX``).  Keeps quote marks and empty fields.

    Evaluated in linear time, not with the look-ahead regex (which re-scans
    the rest of the line at every comma and, on a long line with many quotes,
    overflows the regex engine's stack): a comma has an even number of quotes
    after it exactly if as many stand before it as in the whole line, modulo 2,
    so one pass from the start finds the fields (``_FIELD``).
    """
    ended = F.concat(as_col(line), F.lit(","))
    return F.regexp_extract_all(ended, F.lit(_FIELD), F.lit(1))


def field(parts, i: int) -> Column:
    """Element ``i`` of a split array, null when the line is too short."""
    return F.get(as_col(parts), i)


def us_date_parts(date) -> Column:
    """``MM/dd/yyyy`` → struct(month, day, year) of ints.

    Null unless the text starts with three all-digit parts separated by
    ``/`` (more parts may follow and are ignored).  One anchored regular
    expression checks all three parts, then ``split`` cuts them; a number
    beyond an int is a null part.
    """
    c = as_col(date)
    ok = c.rlike("^[0-9]+/[0-9]+/[0-9]+(/|$)")
    parts = F.split(c, DATE_SEPARATOR, -1)
    return F.when(ok, F.struct(F.get(parts, 0).try_cast("int").alias("month"),
                               F.get(parts, 1).try_cast("int").alias("day"),
                               F.get(parts, 2).try_cast("int").alias("year")))


def compact_clock(clock, noon: str = "reference") -> Column:
    """``hhmmA`` / ``hhmmP`` → struct(hour, minute).

    ``noon="reference"``: an upper-case ``P`` anywhere adds 12 hours modulo
    24, anything else keeps the hour (so ``1230P`` is 00:30 and ``1215A`` is
    12:15).  ``noon="clock"``: the usual 12-hour reading.  Hours and minutes
    are not range-checked; they roll over in ``violation_ts``.
    """
    if noon not in ("reference", "clock"):
        raise ValueError("noon must be 'reference' or 'clock'")
    c = as_col(clock)
    ok = c.rlike("^[0-9]{4}")
    h = F.substring(c, 1, 2).try_cast("int")
    m = F.substring(c, 3, 2).try_cast("int")
    pm = F.coalesce(c.contains(AFTERNOON_MARK), F.lit(False))
    if noon == "reference":
        hour = F.when(pm, (h + 12) % 24).otherwise(h)
    else:
        am = F.coalesce(c.contains(MORNING_MARK), F.lit(False))
        hour = F.when(pm, h % 12 + 12).when(am, h % 12).otherwise(h)
    return F.when(ok, F.struct(hour.alias("hour"), m.alias("minute")))


def violation_ts(date, clock, noon: str = "reference") -> Column:
    """Date + clock → timestamp with lenient roll-over, bad input → null.

    Month 13 is January of the next year, day 0 the last day of the month
    before, hour 25 one o'clock the next day.  The value is the first day of
    the normalised month plus (day − 1) days, the hours and the minutes, in
    the session time zone.  A month or a result outside years 1..9999, which
    not every reader can hold, gives null.
    """
    dp = us_date_parts(date)
    ck = compact_clock(clock, noon)
    months = dp["year"].cast("long") * 12 + (dp["month"].cast("long") - 1)
    year = F.floor(months / 12).try_cast("int")
    month = (F.pmod(months, F.lit(12)) + 1).cast("int")
    first = F.try_make_timestamp(year, month, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    shift = F.try_make_interval(F.lit(0), F.lit(0), F.lit(0), dp["day"] - 1, ck["hour"],
                                ck["minute"], F.lit(0))
    ts = F.try_add(first, shift)
    inside = months.between(12, 119_999) & F.year(ts).between(1, 9999)
    return F.when(ck.isNotNull() & inside, ts)


def try_parse_ts(c, pattern: str) -> Column:
    """Parse a string by a datetime pattern; failure → null."""
    return F.try_to_timestamp(as_col(c), F.lit(pattern))


ISO_SECONDS = ALERT_DATE_FORMAT


def iso_seconds(c) -> Column:
    """Timestamp → ``yyyy-MM-dd'T'HH:mm:ss`` text."""
    return F.date_format(as_col(c), ISO_SECONDS)
