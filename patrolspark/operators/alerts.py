"""Alert table: one (subject, body) row per decoded violation.

Delivery (mail or anything else) is a consumer of this table, so a failed
delivery never loses the alert and replays are visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.alerts import ALERT_SUBJECT, alert_body


def alerts(violations: DataFrame, image_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return violations.select(*keep, F.lit(ALERT_SUBJECT).alias("subject"),
                             alert_body(image_dir).alias("body"))
