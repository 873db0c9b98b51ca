"""Alert text for a violation record; missing values read ``Unknown``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..util import as_col
from .parse import iso_seconds

from ..fixed import ALERT_BODY, ALERT_SUBJECT, ALERT_UNKNOWN  # noqa: F401 (re-exported)


def image_path(image_dir: str, image_id="image_id") -> Column:
    """``<dir>/<image_id>``; null when the id is null."""
    return F.concat(F.lit(image_dir.rstrip("/") + "/"), as_col(image_id))


def _or_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit(ALERT_UNKNOWN))


def alert_body(image_dir: str, lat="lat", lng="lng", sending_date="sending_date",
               drone_id="drone_id", violation_code="violation_code",
               image_id="image_id") -> Column:
    """Body text of one alert, built with ``concat`` in the JVM."""
    values = {
        "code": _or_unknown(as_col(violation_code)),
        "date": _or_unknown(iso_seconds(sending_date)),
        "lat": _or_unknown(as_col(lat).cast("string")),
        "lng": _or_unknown(as_col(lng).cast("string")),
        "drone": _or_unknown(as_col(drone_id)),
        "image": _or_unknown(image_path(image_dir, image_id)),
    }
    parts: list[Column] = []
    rest = ALERT_BODY
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        parts += [F.lit(head), values[name]]
    parts.append(F.lit(rest))
    return F.concat(*parts)
