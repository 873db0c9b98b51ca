"""patrolspark: a Spark-native traffic-violation lake.

Main entry points (see README.md for the full layout):

* ``get_session`` — session with the settings the library relies on.
* ``load_historic`` / ``publish_historic`` / ``save_violations`` — police
  files into the lake, directly or through a keyed topic.
* ``consume_messages`` — live keyed messages into five tables.
* ``analyse_lake`` / ``run_all`` and ``season_share``, ``top_codes``,
  ``period_share``, ``top_code_per_season`` — the four analyses.
* ``read_cube`` / ``backfill_cube`` — their partial counts, kept batch by batch.
* ``compact_lake`` / ``compact_output``, ``load_grown`` — upkeep of lake and files.
"""

from .operators.conform import conform, prepared, to_violation
from .operators.messages import decode_all, decode_image, decode_standard, decode_violation, route
from .plans.analyses import (period_share, run_all, season_share, top_code_per_season,
                             top_codes, violation_cube)
from .plans.jobs import analyse_lake, migrate_lake, read_lake
from .session import get_session
from .sources.lake import compact_lake, remove_replaced
from .streaming.consume import compact_output, consume_messages, image_store, read_output
from .streaming.cube import backfill_cube, read_cube
from .streaming.ledger import load_grown
from .streaming.load import load_historic, publish_historic, save_violations

__all__ = [
    "get_session", "load_historic", "publish_historic", "save_violations", "consume_messages",
    "read_output", "image_store", "analyse_lake", "migrate_lake", "read_lake", "run_all",
    "violation_cube", "season_share", "top_codes", "period_share", "top_code_per_season",
    "conform", "prepared", "to_violation", "route", "decode_all", "decode_standard",
    "decode_violation", "decode_image", "compact_lake", "remove_replaced", "compact_output",
    "backfill_cube", "read_cube", "load_grown",
]
