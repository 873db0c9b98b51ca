"""Violation-shaped inputs derived by Spark from the driver's tables.

The analysed system reads police files and drone messages; the test bed has
TPC-H-like tables instead.  These views map them onto the violation layout
so every registered query reads the whole given tables:

* ``season_rows``: ``lineitem`` ship dates (1995–2001, every season) with
  the supplier key as the code;
* ``period_rows``: ``events`` times (with time of day) with the event type as
  the code, ``error`` standing for a missing code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixed import IMAGE_KEY, STANDARD_KEY, VIOLATION_KEY
from .functions import codec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def season_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").cast("timestamp").alias("sending_date"),
        F.col("l_suppkey").cast("string").alias("violation_code"))


def period_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").cast("timestamp").alias("sending_date"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("violation_code"))


def all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources together: every season and every hour."""
    return season_rows(spark, sf_dir).unionByName(period_rows(spark, sf_dir))


# -- keyed drone messages ----------------------------------------------------
# Built from ``events``: 1 in 20 a violation (as in the live feed), 1 in 20 an
# image, 2 in 20 under keys nobody handles; some values broken on purpose.

def _msg_parts():
    eid = F.col("event_id")
    k = eid % 20
    ts = F.col("ts").cast("timestamp")
    uid = F.col("user_id").cast("string")
    code = F.nullif(F.col("event_type"), F.lit("error"))
    key = (F.when(k == 0, F.lit(VIOLATION_KEY)).when(k == 1, F.lit(IMAGE_KEY))
           .when(k == 2, F.lit("OTHER")).when(k == 3, F.lit(None).cast("string"))
           .otherwise(F.lit(STANDARD_KEY)))
    broken = eid % 7 == 0
    not_json = (eid % 11 == 0) & ~broken
    std_ok = codec.encode_standard(F.col("value"), -F.col("value"), ts, uid)
    std_bad = codec.encode(F.col("value").cast("string").alias("lat"),
                           (-F.col("value")).alias("lng"),
                           F.unix_millis(ts).alias("sending_date"), uid.alias("drone_id"))
    vio_ok = codec.encode_violation(F.col("value"), -F.col("value"), ts, uid, code,
                                    eid.cast("string"))
    vio_bad = codec.encode(F.col("value").alias("lat"), F.unix_millis(ts).alias("sending_date"),
                           F.col("user_id").alias("drone_id"))
    img_ok = codec.encode_image(uid, F.col("props"))
    img_bad = codec.encode(uid.alias("image_id"))
    value = (F.when(not_json & (k <= 1) | not_json & (k >= 4),
                    F.concat(F.lit("not json "), eid.cast("string")))
             .when(k == 0, F.when(broken, vio_bad).otherwise(vio_ok))
             .when(k == 1, F.when(broken, img_bad).otherwise(img_ok))
             .when(k >= 4, F.when(broken, std_bad).otherwise(std_ok))
             .otherwise(std_ok))
    return key, value


def keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, value, partition, offset) messages, offset = event id."""
    ev = table(spark, sf_dir, "events")
    key, value = _msg_parts()
    return ev.select(key.alias("key"), value.alias("value"),
                     F.lit(0).alias("partition"), F.col("event_id").alias("offset"))


# -- raw police lines ------------------------------------------------------
# 21 comma-separated fields per event: date MM/dd/yyyy at 4, code at 5 (empty
# for ``error``, quoted on every 17th), the 12-hour clock hhmmA/hhmmP at 19,
# a quoted field holding a comma at 2 (on some rows doubled quotes, quotes inside the
# field, or a backslash before its last quote).  Every 13th line has 8 fields only.

def raw_line_parts() -> list:
    eid = F.col("event_id")
    ts = F.col("ts")
    h = F.hour(ts)
    h12 = F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12)
    clock = F.concat(F.lpad(h12.cast("string"), 2, "0"),
                     F.lpad(F.minute(ts).cast("string"), 2, "0"),
                     F.when(h < 12, F.lit("A")).otherwise(F.lit("P")))
    code = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type"))
    code = F.when((eid % 17 == 0) & (code != ""), F.concat(F.lit('"'), code, F.lit('"'))) \
        .otherwise(code)
    kind = F.col("event_type")
    quoted = (F.when(eid % 19 == 1, F.concat(F.lit('"say ""'), kind, F.lit('"", x"')))
              .when(eid % 19 == 2, F.concat(F.lit('AB"C,D"'), kind))
              .when(eid % 19 == 3, F.concat(F.lit('"'), kind, F.lit('\\"')))
              .otherwise(F.concat(F.lit('"'), kind, F.lit(", "),
                                  F.col("user_id").cast("string"), F.lit('"'))))
    fields = [eid.cast("string"), F.col("user_id").cast("string"), quoted,
              F.lit("NY"), F.date_format(ts, "MM/dd/yyyy"), code,
              F.col("value").cast("string"), F.lit("")]
    fields += [F.lit(f"f{i}") for i in range(8, 19)]
    fields += [clock, F.lit("X")]
    return fields


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    fields = raw_line_parts()
    short = F.col("event_id") % 13 == 0
    line = F.when(short, F.concat_ws(",", *fields[:8])).otherwise(F.concat_ws(",", *fields))
    return ev.select(line.alias("line"))


# -- events as positional string tables -----------------------------------

def events_as_strings(spark: SparkSession, sf_dir: str, width: int) -> DataFrame:
    """Events as ``width`` untyped string columns c0.. (4, 6 or 7)."""
    ev = table(spark, sf_dir, "events")
    cols = [
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.col("value").cast("string")),
        (-F.col("value")).cast("string"),
        F.when(F.col("event_id") % 5 == 0, F.lit("Issue Date"))
        .otherwise(F.col("ts").cast("string")),
        F.col("user_id").cast("string"),
        F.col("event_type"),
        F.col("event_id").cast("string"),
        F.col("props"),
    ]
    return ev.select(*[c.alias(f"c{i}") for i, c in enumerate(cols[:width])])
