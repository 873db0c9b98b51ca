"""Registered queries over the driver tables, with their DuckDB oracles.

Each entry of ``QUERIES`` takes ``(spark, sf_dir)`` and returns a DataFrame;
``ORACLE_SQL`` holds the same question as DuckDB SQL over the views
``lineitem``, ``events``, ``orders`` … .  Column names match one to one.
Timestamps leave as epoch microseconds (``*_us``) so both sides compare as
plain numbers.  Integer columns that can hold nulls leave as doubles on both
sides (exact below 2**53): pandas turns a nullable integer column into
float64 on the Spark side and into a nullable integer type on the DuckDB
side, and the two print differently.

Every query processes whole tables.  Where ``event_id % n`` appears it
*assigns* something to each row (the message key, as in the live feed where
1 in 20 messages is a violation; which rows carry a deliberate defect; which
raw lines are short), never selects a subset to process.  The oracle SQL
repeats the same assignment to know what each row should become.

The calendar rules are defined in UTC, so each registered query pins the
session time zone (and the other settings of ``session.pin``) before it
builds its plan.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.bands import period, season
from .functions.codec import encode_image, encode_standard, encode_violation
from .functions.parse import compact_clock, field, split_fields, try_parse_ts
from .operators.alerts import alerts
from .operators.conform import conform, prepared, to_violation
from .operators.images import latest_images
from .operators.messages import (all_rejects, decode_image, decode_standard,
                                 decode_violation, route, route_of)
from .operators.metrics import count_by, share_of_total, union_bands
from .plans import analyses as A
from .derived import (all_rows, events_as_strings, keyed_messages, period_rows,
                            raw_lines, season_rows, table)
from .session import pin

QUERIES: dict = {}


def _us(ts) -> "F.Column":
    """Epoch microseconds of a nullable timestamp, as double (see above)."""
    return F.unix_micros(ts).cast("double")

ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return run
    return deco


# -- oracle building blocks (DuckDB) ---------------------------------------

V_SEASONS = ("select l_shipdate as sending_date, cast(l_suppkey as varchar) as violation_code "
             "from lineitem")
V_PERIODS = ("select ts as sending_date, nullif(event_type, 'error') as violation_code "
             "from events")


def se(d: str) -> str:
    md = f"strftime({d}, '%m%d')"
    return (f"case when {d} is null then null "
            f"when {md} >= '1221' or {md} < '0321' then 'winter' "
            f"when {md} < '0621' then 'spring' when {md} < '0921' then 'summer' "
            f"else 'autumn' end")


def pe(d: str) -> str:
    hm = f"strftime({d}, '%H%M')"
    return (f"case when {d} is null then null "
            f"when {hm} >= '2000' or {hm} < '0800' then 'night' else 'day' end")


def pct(n: str, over: str = "") -> str:
    return f"({n} * 100) / nullif(cast(sum({n}) over ({over}) as bigint), 0)"


# -- the four analyses and the cube ----------------------------------------

@register("season_share", f"""
with v as ({V_SEASONS}),
g as (select season, count(violation_code) as n
      from (select {se('sending_date')} as season, violation_code from v
            where sending_date is not null) t
      where season in ('winter', 'summer') group by season)
select season, n as number_of_violations, {pct('n')} as percent from g
""")
def q_season_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.season_share(season_rows(spark, sf_dir))


@register("top5_codes", f"""
with v as ({V_SEASONS}),
g as (select violation_code, count(violation_code) as n from v
      where sending_date is not null group by violation_code)
select violation_code, n as number_of_violations, {pct('n')} as percent from g
order by n desc, violation_code asc nulls first limit 5
""")
def q_top5_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_codes(season_rows(spark, sf_dir))


@register("period_share", f"""
with v as ({V_PERIODS}),
g as (select {pe('sending_date')} as period, count(violation_code) as n from v
      where sending_date is not null group by 1)
select period, n as number_of_violations, {pct('n')} as percent from g
""")
def q_period_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.period_share(period_rows(spark, sf_dir))


@register("top_code_per_season", f"""
with v as ({V_SEASONS}),
g as (select {se('sending_date')} as season, violation_code, count(violation_code) as n
      from v where sending_date is not null group by 1, 2),
r as (select season, violation_code, n, {pct('n', 'partition by season')} as percent,
             row_number() over (partition by season
                                order by n desc, violation_code asc nulls first) as k
      from g)
select season, violation_code, n as number_of_violations, percent from r where k = 1
""")
def q_top_code_per_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_code_per_season(season_rows(spark, sf_dir))


@register("violation_cube", f"""
with v as ({V_SEASONS} union all {V_PERIODS})
select {se('sending_date')} as season, {pe('sending_date')} as period, violation_code,
       count(violation_code) as number_of_violations
from v where sending_date is not null group by 1, 2, 3
""")
def q_violation_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.violation_cube(all_rows(spark, sf_dir))


# -- labels, counting and shares -------------------------------------------

@register("season_label", f"""
select l_orderkey, l_linenumber, {se('l_shipdate')} as season from lineitem
""")
def q_season_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     season(F.col("l_shipdate").cast("timestamp")).alias("season"))


@register("period_label", f"""
select event_id, {pe('ts')} as period from events
""")
def q_period_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", period(F.col("ts").cast("timestamp")).alias("period"))


@register("count_by_code", f"""
with v as ({V_SEASONS})
select violation_code, count(violation_code) as number_of_violations from v
where sending_date is not null group by violation_code
""")
def q_count_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(prepared(season_rows(spark, sf_dir)), "violation_code")


@register("share_of_total", f"""
with v as ({V_PERIODS}),
g as (select violation_code, count(violation_code) as n from v
      where sending_date is not null group by violation_code)
select violation_code, n as number_of_violations, {pct('n')} as percent from g
""")
def q_share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_of_total(count_by(prepared(period_rows(spark, sf_dir)), "violation_code"))


@register("union_bands", f"""
select l_orderkey, l_linenumber, season from (
  select l_orderkey, l_linenumber, {se('l_shipdate')} as season from lineitem) t
where season in ('winter', 'summer')
""")
def q_union_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    tagged = union_bands(li, "season", A.FIRST_ANALYSIS_SEASONS,
                         season(F.col("l_shipdate").cast("timestamp")))
    return tagged.select("l_orderkey", "l_linenumber", "season")


# -- raw police lines --------------------------------------------------------

def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines through files, as a load reads them."""
    from .session import scratch_path
    from .sources.raw import raw_files
    src = scratch_path(spark, "raw_src")
    raw_lines(spark, sf_dir).write.text(src)
    return raw_files(spark, src, suffix="txt")


# The clock in the lines is the usual 12-hour one; the parsing rule adds 12
# hours for ``P`` only, so 12 AM reads as 12:00 and 12 PM as 00:00.
_RULE_HOUR = "case when hour(ts) = 0 then 12 when hour(ts) = 12 then 0 else hour(ts) end"


@register("parse_raw_records", f"""
select event_id, cast(case when event_id % 13 = 0 then null else
         epoch_us(date_trunc('day', ts) + to_hours({_RULE_HOUR}) + to_minutes(minute(ts))) end
         as double) as sending_date_us,
       nullif(event_type, 'error') as violation_code
from events
""")
def q_parse_raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = to_violation(_raw(spark, sf_dir), keep=("_c0",))
    return v.select(F.col("_c0").cast("long").alias("event_id"),
                    _us(F.col("sending_date")).alias("sending_date_us"), "violation_code")


@register("compact_clock", f"""
select event_id,
       cast(case when event_id % 13 = 0 then null else {_RULE_HOUR} end as double) as hour,
       cast(case when event_id % 13 = 0 then null else minute(ts) end as double) as minute
from events
""")
def q_compact_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split_fields(F.col("line"))
    df = raw_lines(spark, sf_dir).select(parts.alias("p"))
    ck = compact_clock(field("p", 19))
    return df.select(field("p", 0).cast("long").alias("event_id"),
                     ck["hour"].cast("double").alias("hour"),
                     ck["minute"].cast("double").alias("minute"))


@register("split_fields", """
select event_id,
       case when event_id % 13 = 0 then 8 else 21 end as n_fields,
       case event_id % 19 when 1 then '"say ""' || event_type || '"", x"'
            when 2 then 'AB"C,D"' || event_type when 3 then '"' || event_type || '\\"'
            else '"' || event_type || ', ' || cast(user_id as varchar) || '"' end as field2,
       case when event_type = 'error' then ''
            when event_id % 17 = 0 then '"' || event_type || '"'
            else event_type end as field5
from events
""")
def q_split_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = raw_lines(spark, sf_dir).select(split_fields(F.col("line")).alias("p"))
    return df.select(field("p", 0).cast("long").alias("event_id"),
                     F.size("p").alias("n_fields"),
                     field("p", 2).alias("field2"), field("p", 5).alias("field5"))


@register("try_parse_ts", """
select o_orderkey, cast(case when o_orderkey % 9 = 0 then null else epoch_us(o_orderdate) end
       as double) as parsed_us
from orders
""")
def q_try_parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    text = F.date_format(F.col("o_orderdate"), "dd-MM-yyyy HH:mm:ss")
    text = F.when(F.col("o_orderkey") % 9 == 0, F.concat(text, F.lit(" x"))).otherwise(text)
    return o.select("o_orderkey",
                    _us(try_parse_ts(text, "dd-MM-yyyy HH:mm:ss")).alias("parsed_us"))


# -- schema conformance --------------------------------------------------------

_CONFORM_ROW = """
  case when event_type = 'error' then null else value end as lat, -value as lng,
  cast(case when event_id % 5 = 0 then null else epoch_us(ts) end as double) as sending_date_us,
  cast(user_id as varchar) as drone_id"""


@register("conform_positional", f"""
select 7 as width, {_CONFORM_ROW}, event_type as violation_code,
       cast(event_id as varchar) as image_id from events
union all
select 6 as width, {_CONFORM_ROW}, event_type as violation_code,
       cast(event_id as varchar) as image_id from events
union all
select 4 as width, {_CONFORM_ROW}, null as violation_code, null as image_id from events
""")
def q_conform_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for w in (7, 6, 4):
        c = conform(events_as_strings(spark, sf_dir, w))
        c = c.select(F.lit(w).alias("width"), "lat", "lng",
                     _us(F.col("sending_date")).alias("sending_date_us"),
                     "drone_id", "violation_code", "image_id")
        out = c if out is None else out.unionByName(c)
    return out


@register("prepared_rows", """
select cast(event_id as varchar) as image_id, epoch_us(ts) as sending_date_us
from events where event_id % 5 <> 0
""")
def q_prepared_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = prepared(conform(events_as_strings(spark, sf_dir, 6)))
    return p.select("image_id", F.unix_micros("sending_date").alias("sending_date_us"))


# -- keyed messages --------------------------------------------------------------

# The messages carry lng = -value as JSON; a JSON number has no negative zero
# once read (it is a decimal), so -0.0 arrives as 0.0.  ``0.0 - value`` is
# the same negation with that zero.
_NEG = "(0.0 - value)"

_ROUTE_SQL = ("case when event_id % 20 = 0 then 'violation' when event_id % 20 = 1 then 'image' "
              "when event_id % 20 >= 4 then 'standard' else 'unhandled' end")
_OK = "event_id % 7 <> 0 and event_id % 11 <> 0"


@register("route_counts", f"""
select {_ROUTE_SQL} as route, count(*) as n from events group by 1
""")
def q_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = keyed_messages(spark, sf_dir)
    return m.groupBy(route_of("key").alias("route")).agg(F.count(F.lit(1)).alias("n"))


@register("decode_standard", f"""
select value as lat, {_NEG} as lng, (epoch_us(ts) // 1000) * 1000 as sending_date_us,
       cast(user_id as varchar) as drone_id, event_id as "offset"
from events where event_id % 20 >= 4 and {_OK}
""")
def q_decode_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = decode_standard(route(keyed_messages(spark, sf_dir))["standard"], keep=("offset",))
    return good.select("lat", "lng", F.unix_micros("sending_date").alias("sending_date_us"),
                       "drone_id", "offset")


_VIOLATION_ROW = f"""value as lat, {_NEG} as lng, (epoch_us(ts) // 1000) * 1000 as sending_date_us,
       cast(user_id as varchar) as drone_id, nullif(event_type, 'error') as violation_code,
       cast(event_id as varchar) as image_id"""


@register("decode_violation", f"""
select {_VIOLATION_ROW}, event_id as "offset"
from events where event_id % 20 = 0 and {_OK}
""")
def q_decode_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = decode_violation(route(keyed_messages(spark, sf_dir))["violation"], keep=("offset",))
    return good.select("lat", "lng", F.unix_micros("sending_date").alias("sending_date_us"),
                       "drone_id", "violation_code", "image_id", "offset")


@register("decode_image", f"""
select cast(user_id as varchar) as image_id, props as content, event_id as "offset"
from events where event_id % 20 = 1 and {_OK}
""")
def q_decode_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = decode_image(route(keyed_messages(spark, sf_dir))["image"], keep=("offset",))
    return good


@register("encode_violation", f"""
select event_id as "offset",
       '{{"lat":' || cast(value as varchar) || ',"lng":' || cast({_NEG} as varchar)
       || ',"sending_date":' || cast(epoch_us(ts) // 1000 as varchar)
       || ',"drone_id":"' || cast(user_id as varchar) || '"'
       || coalesce(',"violation_code":"' || nullif(event_type, 'error') || '"', '')
       || ',"image_id":"' || cast(event_id as varchar) || '"}}' as value
from events where event_id % 20 = 0 and {_OK}
""")
def q_encode_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # decode → encode: the stored record re-encoded is the message sent.
    good, _ = decode_violation(route(keyed_messages(spark, sf_dir))["violation"], keep=("offset",))
    return good.select("offset", encode_violation().alias("value"))


@register("reject_records", f"""
select case when {_ROUTE_SQL} = 'unhandled' then 'unhandled key'
            when event_id % 7 = 0 and event_id % 20 = 0 then 'bad type drone_id'
            when event_id % 7 = 0 and event_id % 20 = 1 then 'missing content'
            when event_id % 7 = 0 then 'bad type lat'
            else 'not a JSON object' end as reason,
       case when event_id % 20 = 0 then 'VIOLATION_MESSAGE'
            when event_id % 20 = 1 then 'VIOLATION_IMAGE'
            when event_id % 20 = 2 then 'OTHER' when event_id % 20 = 3 then null
            else 'STANDARD_MESSAGE' end as key,
       event_id as "offset"
from events where event_id % 20 in (2, 3) or not ({_OK})
""")
def q_reject_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_rejects(keyed_messages(spark, sf_dir), keep=("offset",)) \
        .select("reason", "key", "offset")


# Image folder named in the alert text of the test bed.
IMAGE_DIR = "lake/drone_message/image_drone_message"


@register("alert_text", f"""
select event_id as "offset", 'Violation Alert' as subject,
  'New Violation Occured' || chr(10)
  || 'Violation Code: ' || coalesce(nullif(event_type, 'error'), 'Unknown') || chr(10)
  || 'Occurring Date: ' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || chr(10)
  || 'Latitude : ' || cast(value as varchar) || chr(10)
  || 'Longitude : ' || cast({_NEG} as varchar) || chr(10)
  || 'Drone ID: ' || cast(user_id as varchar) || chr(10)
  || 'Violation Image: {IMAGE_DIR}/' || cast(event_id as varchar) || chr(10)
  || chr(10) || chr(10) || '-- SENT FROM ALERT HANDLER SYSTEM --' || chr(10) as body
from events where event_id % 20 = 0 and {_OK}
""")
def q_alert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = decode_violation(route(keyed_messages(spark, sf_dir))["violation"], keep=("offset",))
    return alerts(good, IMAGE_DIR, keep=("offset",))


@register("latest_images", f"""
select image_id, content from (
  select cast(user_id as varchar) as image_id, props as content,
         row_number() over (partition by user_id order by event_id desc) as k
  from events where event_id % 20 = 1 and {_OK}) t
where k = 1
""")
def q_latest_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = decode_image(route(keyed_messages(spark, sf_dir))["image"],
                           keep=("partition", "offset"))
    return latest_images(good)


# -- tables on disk and streams ------------------------------------------------

@register("csv_round_trip", """
select event_id, epoch_us(ts) as ts_us, user_id, event_type, value, props from events
""")
def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import types as T

    from .session import scratch_path
    from .sources.tables import read_table, write_table
    path = scratch_path(spark, "csv_round_trip")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type",
                                               "value", "props")
    write_table(ev, path, "csv")  # headerless, append
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("ts", T.TimestampType()),
                           T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType()),
                           T.StructField("props", T.StringType())])
    back = conform(read_table(spark, path, "csv"), schema)
    return back.select("event_id", F.unix_micros("ts").alias("ts_us"), "user_id",
                       "event_type", "value", "props")


def _loaded(v: DataFrame) -> DataFrame:
    return v.select(_us(F.col("sending_date")).alias("sending_date_us"), "violation_code")


_RULE_US = f"epoch_us(date_trunc('day', ts) + to_hours({_RULE_HOUR}) + to_minutes(minute(ts)))"
_LOADED_SQL = f"""
select cast(case when event_id % 13 = 0 then null else {_RULE_US} end as double) as sending_date_us,
       nullif(event_type, 'error') as violation_code
from events"""


@register("streaming_load_totals", _LOADED_SQL)
def q_streaming_load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row a load leaves in the lake."""
    from .plans.jobs import read_lake
    from .session import scratch_path
    from .streaming.load import load_historic
    src, lake, ckpt = (scratch_path(spark, n) for n in ("raw_src", "lake", "lake_ckpt"))
    raw_lines(spark, sf_dir).write.text(src)  # Spark's text writer names parts *.txt
    load_historic(spark, src, lake, ckpt, suffix="txt")
    return _loaded(read_lake(spark, lake))


@register("lake_two_loads", f"""
{_LOADED_SQL} union all {_LOADED_SQL}
union all select epoch_us(ts), nullif(event_type, 'error') from events
union all select cast((epoch_us(ts) // 1000) * 1000 as double), nullif(event_type, 'error')
from events where event_id % 20 = 0 and {_OK}
""")
def q_lake_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads with checkpoints of their own, a plain append and a saver share one lake."""
    from .plans.jobs import read_lake
    from .schemas import KEYED
    from .session import scratch_path
    from .sources.tables import write_table
    from .streaming.load import load_historic, save_violations
    lake, topic = scratch_path(spark, "lake"), scratch_path(spark, "topic")
    for _ in range(2):
        src, ckpt = scratch_path(spark, "raw_src"), scratch_path(spark, "lake_ckpt")
        raw_lines(spark, sf_dir).write.text(src)
        load_historic(spark, src, lake, ckpt, suffix="txt")
        load_historic(spark, src, lake, ckpt, suffix="txt")  # a rerun adds nothing
    write_table(_appended(spark, sf_dir), lake)
    route(keyed_messages(spark, sf_dir))["violation"].write.json(topic)
    save_violations(spark.readStream.schema(KEYED).json(topic), lake,
                    scratch_path(spark, "save_ckpt"))
    return _loaded(read_lake(spark, lake))


def _appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as VIOLATION rows, for a plain append to a lake."""
    return conform(period_rows(spark, sf_dir).select(
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"),
        "sending_date", F.lit(None).cast("string").alias("drone_id"), "violation_code"))


def _loads(spark: SparkSession, sf_dir: str, lake: str, times: int, **kw) -> None:
    """The raw lines loaded so many times, each load with a checkpoint of its own, a file a batch."""
    from .session import scratch_path
    from .streaming.load import load_historic
    for _ in range(times):
        src, ckpt = scratch_path(spark, "raw_src"), scratch_path(spark, "lake_ckpt")
        raw_lines(spark, sf_dir).repartition(3).write.text(src)
        load_historic(spark, src, lake, ckpt, suffix="txt", max_files_per_trigger=1, **kw)


@register("lake_compacted", f"""
{_LOADED_SQL} union all {_LOADED_SQL} union all select epoch_us(ts), nullif(event_type, 'error') from events
""")
def q_lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a lake after its small files were merged, while the merged files are still there."""
    from .session import scratch_path
    from .sources.lake import compact_lake, read_lake
    from .sources.tables import write_table
    lake = scratch_path(spark, "lake")
    _loads(spark, sf_dir, lake, 2)
    write_table(_appended(spark, sf_dir), lake)
    compact_lake(spark, lake)
    return _loaded(read_lake(spark, lake))


_TWICE = f"""
with v as (select sending_date_us, violation_code from ({_LOADED_SQL}) a
           union all select sending_date_us, violation_code from ({_LOADED_SQL}) b
           union all select cast(epoch_us(ts) as double), nullif(event_type, 'error') from events),
d as (select make_timestamp(cast(sending_date_us as bigint)) as d, violation_code from v where sending_date_us is not null)"""


@register("cube_incremental", f"""{_TWICE}
select {se('d')} as season, {pe('d')} as period, violation_code, count(violation_code) as number_of_violations
from d group by 1, 2, 3
""")
def q_cube_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial cubes of two loads, one batch replayed, an append counted later, and files merged in between."""
    from .session import scratch_path
    from .sources.lake import compact_lake
    from .sources.tables import write_table
    from .streaming import cube
    lake, path = scratch_path(spark, "lake"), scratch_path(spark, "cube")
    _loads(spark, sf_dir, lake, 2, cube_path=path)
    batch = spark.read.parquet(path).select("run_id", "batch_id").first()
    cube.add_batch(spark, lake, path, batch["run_id"], batch["batch_id"])
    write_table(_appended(spark, sf_dir), lake)
    cube.backfill_cube(spark, lake, path)
    compact_lake(spark, lake, remove=True)
    cube.backfill_cube(spark, lake, path)
    return cube.read_cube(spark, path)


@register("load_metrics", """
select cast(count(*) as bigint) as lines, count(*) filter (where event_id % 13 <> 0) as dated,
       count(*) filter (where event_id % 13 = 0) as short, cast(0 as bigint) as header,
       cast(0 as bigint) as out_of_range, cast(0 as bigint) as undated
from events
""")
def q_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by class, as observed while a load wrote the lake, over all of its batches."""
    from .operators.conform import LINE_CLASSES
    from .session import scratch_path
    from .streaming.load import read_metrics
    lake = scratch_path(spark, "lake")
    _loads(spark, sf_dir, lake, 1)
    return read_metrics(spark, f"{lake}_metrics").agg(*[F.sum(c).alias(c) for c in ("lines", *LINE_CLASSES)])


@register("conform_report", """
select 'lat' as field, 0 as position, count(*) as n_rows, 0 as nulls,
       count(*) filter (where event_type = 'error') as failures from events
union all select 'lng', 1, count(*), 0, 0 from events
union all select 'sending_date', 2, count(*), 0, count(*) filter (where event_id % 5 = 0) from events
union all select 'drone_id', 3, count(*), 0, 0 from events
union all select 'violation_code', 4, count(*), count(*), 0 from events
union all select 'image_id', 5, count(*), count(*), 0 from events
""")
def q_conform_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What conforming a four-column table would null, by target field."""
    from .operators.conform import cast_report
    return cast_report(events_as_strings(spark, sf_dir, 4)).select("field", "position", "n_rows", "nulls", "failures")


@register("top5_codes_sketch", f"""
with v as ({V_SEASONS}),
g as (select violation_code, count(violation_code) as n from v
      where sending_date is not null group by violation_code)
select violation_code, n as number_of_violations, {pct('n')} as percent from g
order by n desc, violation_code asc nulls first limit 5
""")
def q_top5_codes_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 from the combined sketches of each month, with exact counts of the candidates."""
    from .operators.top_sketch import code_sketch, top_codes_verified
    rows = prepared(season_rows(spark, sf_dir))
    sketches = code_sketch(rows.withColumn("part", F.month("sending_date")), by=("part",))
    return top_codes_verified(rows, sketches, 5)[0]


_MARKS = [("rush", 420, 570), ("rush", 960, 1140), ("night", 1320, 360), ("lunch", 690, 810), ("late", 1080, 60)]


@register("band_labels", """
with m as (select event_id, cast(hour(ts) * 60 + minute(ts) as int) as x from events),
b(k, name, a, z) as (values (0, 'rush', 420, 570), (1, 'rush', 960, 1140), (2, 'night', 1320, 360),
                            (3, 'lunch', 690, 810), (4, 'late', 1080, 60)),
n as (select event_id, name, min(k) as k from m join b
      on case when a < z then x >= a and x < z else x >= a or x < z end group by event_id, name)
select m.event_id, coalesce(string_agg(n.name, ',' order by n.k), '') as bands
from m left join n on m.event_id = n.event_id group by m.event_id
""")
def q_band_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bands of each event's minute, from a table of overlapping and wrapping bands with gaps."""
    from .functions.band_table import BandTable
    from .functions.bands import minute_of_day
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.array_join(BandTable.of(_MARKS).labels(minute_of_day("ts")), ",").alias("bands"))


def _growing(spark: SparkSession, sf_dir: str, src: str, grown: bool) -> None:
    """The raw lines in files of fixed names; the lines of odd events come only when they have ``grown``."""
    from .session import scratch_path
    store = scratch_path(spark, "raw_parts")
    added = F.col("event_id") % 2 == 1
    ev = table(spark, sf_dir, "events").select("event_id", F.pmod("event_id", F.lit(8)).alias("k"), added.alias("added"))
    lines = raw_lines(spark, sf_dir).withColumn("id", F.split("line", ",")[0].cast("long"))
    lines = lines.join(ev, F.col("id") == F.col("event_id")).where(F.lit(grown) | ~F.col("added"))
    lines.select("line", "k", "added", "event_id").repartition("k").sortWithinPartitions("k", "added", "event_id") \
        .select("line", "k").write.partitionBy("k").text(store)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(store).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(src))
    for k in range(8):
        for status in fs.globStatus(fs_path(f"{store}/k={k}/part-*")):
            fs.delete(fs_path(f"{src}/{k}.txt"), False)
            fs.rename(status.getPath(), fs_path(f"{src}/{k}.txt"))


@register("grown_lines", _LOADED_SQL)
def q_grown_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake after its files grew: half of the lines loaded with the files, the others added, none twice."""
    from .session import scratch_path
    from .sources.lake import read_lake
    from .streaming.ledger import load_grown
    from .streaming.load import load_historic
    src, lake, ckpt, ledger = (scratch_path(spark, n) for n in ("raw_src", "lake", "lake_ckpt", "ledger"))
    for grown in (False, True):
        _growing(spark, sf_dir, src, grown)
        load_historic(spark, src, lake, ckpt, suffix="txt", ledger_path=ledger)
        load_grown(spark, src, lake, ckpt, ledger, suffix="txt")
        load_grown(spark, src, lake, ckpt, ledger, suffix="txt")
    return _loaded(read_lake(spark, lake))


@register("saved_rejects", f"""
select case when event_id % 7 = 0 then 'bad type drone_id' else 'not a JSON object' end as reason,
       event_id as "offset"
from events where event_id % 20 = 0 and not ({_OK})
""")
def q_saved_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a saver could not decode, in the table it always keeps."""
    from .schemas import KEYED
    from .session import scratch_path
    from .streaming.load import save_violations
    topic, lake = scratch_path(spark, "topic"), scratch_path(spark, "lake")
    route(keyed_messages(spark, sf_dir))["violation"].write.json(topic)
    save_violations(spark.readStream.schema(KEYED).json(topic), lake,
                    scratch_path(spark, "save_ckpt"))
    return spark.read.parquet(f"{lake}_rejects").select("reason", "offset")


@register("publish_round_trip", """
select value as lat, (0.0 - value) as lng, (epoch_us(ts) // 1000) * 1000 as sending_date_us,
       cast(user_id as varchar) as drone_id, nullif(event_type, 'error') as violation_code,
       cast(event_id as varchar) as image_id
from events
""")
def q_publish_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations → published messages → decoded again; no message is rejected."""
    from .fixed import VIOLATION_KEY
    from .sources.kafka import keyed_payload
    ev = table(spark, sf_dir, "events")
    rows = ev.select(F.col("value").alias("lat"), (-F.col("value")).alias("lng"),
                     F.col("ts").cast("timestamp").alias("sending_date"),
                     F.col("user_id").cast("string").alias("drone_id"),
                     F.nullif("event_type", F.lit("error")).alias("violation_code"),
                     F.col("event_id").cast("string").alias("image_id"))
    good, bad = decode_violation(keyed_payload(rows, VIOLATION_KEY, partitions=8))
    lost = bad.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema.fields])
    return good.unionAll(lost).select(
        "lat", "lng", F.unix_micros("sending_date").alias("sending_date_us"), "drone_id",
        "violation_code", "image_id")


@register("encode_standard", f"""
select event_id as "offset",
       '{{"lat":' || cast(value as varchar) || ',"lng":' || cast({_NEG} as varchar)
       || ',"sending_date":' || cast(epoch_us(ts) // 1000 as varchar)
       || ',"drone_id":"' || cast(user_id as varchar) || '"}}' as value
from events where event_id % 20 >= 4 and {_OK}
""")
def q_encode_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = decode_standard(route(keyed_messages(spark, sf_dir))["standard"], keep=("offset",))
    return good.select("offset", encode_standard().alias("value"))


@register("encode_image", f"""
select event_id as "offset",
       '{{"image_id":"' || cast(user_id as varchar) || '","content":' || to_json(props) || '}}' as value
from events where event_id % 20 = 1 and {_OK}
""")
def q_encode_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = decode_image(route(keyed_messages(spark, sf_dir))["image"], keep=("offset",))
    return good.select("offset", encode_image().alias("value"))


def _consumed(spark: SparkSession, sf_dir: str) -> str:
    return _consumer_run(spark, sf_dir)[0]


def _consumer_run(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The messages through the consumer, from files; the folder it wrote and its checkpoint."""
    from .schemas import KEYED
    from .session import scratch_path
    from .streaming.consume import consume_messages
    src, out, ckpt = (scratch_path(spark, n) for n in ("msg_src", "msg_out", "msg_ckpt"))
    keyed_messages(spark, sf_dir).write.json(src)
    consume_messages(spark.readStream.schema(KEYED).json(src), out, ckpt, IMAGE_DIR,
                     available_now=True)
    return out, ckpt


@register("stream_route_counts", f"""
select 'standard' as "table", count(*) as n from events where event_id % 20 >= 4 and {_OK}
union all select 'violation', count(*) from events where event_id % 20 = 0 and {_OK}
union all select 'alerts', count(*) from events where event_id % 20 = 0 and {_OK}
union all select 'images', count(*) from events where event_id % 20 = 1 and {_OK}
union all select 'rejects', count(*) from events where event_id % 20 in (2, 3) or not ({_OK})
""")
def q_stream_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .streaming.consume import TABLES, read_output
    out = _consumed(spark, sf_dir)
    parts = [read_output(spark, out, t).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(t).alias("table"), "n") for t in TABLES]
    return functools.reduce(DataFrame.unionByName, parts)


@register("stream_standard", f"""
select value as lat, {_NEG} as lng, (epoch_us(ts) // 1000) * 1000 as sending_date_us,
       cast(user_id as varchar) as drone_id
from events where event_id % 20 >= 4 and {_OK}
""")
def q_stream_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .streaming.consume import read_output
    return read_output(spark, _consumed(spark, sf_dir), "standard").select(
        "lat", "lng", F.unix_micros("sending_date").alias("sending_date_us"), "drone_id")


@register("stream_violation", f"select {_VIOLATION_ROW} from events where event_id % 20 = 0 and {_OK}")
def q_stream_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .streaming.consume import read_output
    return read_output(spark, _consumed(spark, sf_dir), "violation").select(
        "lat", "lng", F.unix_micros("sending_date").alias("sending_date_us"), "drone_id",
        "violation_code", "image_id")


@register("stream_images", f"""
select image_id, content from (
  select cast(user_id as varchar) as image_id, props as content,
         row_number() over (partition by user_id order by event_id desc) as k
  from events where event_id % 20 = 1 and {_OK}) t
where k = 1
""")
def q_stream_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image store after the consumer, read back after a compaction."""
    from .streaming.consume import compact_output, image_store
    out, ckpt = _consumer_run(spark, sf_dir)
    compact_output(spark, out, ckpt)
    return image_store(spark, out)


@register("stream_alerts", f"""
select body from ({ORACLE_SQL["alert_text"]}) t
""")
def q_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .streaming.consume import read_output
    return read_output(spark, _consumed(spark, sf_dir), "alerts").select("body")


@register("stream_alerts_once", f"""
select 'alerts' as "table", body as text from ({ORACLE_SQL["alert_text"]}) t
union all select 'rejects', reason || ' ' || "offset" from ({ORACLE_SQL["reject_records"]}) r
""")
def q_stream_alerts_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts and rejects of a source that delivers every message twice, in different batches."""
    from .schemas import KEYED
    from .session import scratch_path
    from .streaming.consume import consume_messages, read_output
    src, out, ckpt = (scratch_path(spark, n) for n in ("msg_src", "msg_out", "msg_ckpt"))
    messages = keyed_messages(spark, sf_dir)
    for _ in range(2):
        messages.write.mode("append").json(src)
    stream = spark.readStream.schema(KEYED).option("maxFilesPerTrigger", "1").json(src)
    consume_messages(stream, out, ckpt, IMAGE_DIR, available_now=True, redelivery="1 hour")
    rejected = F.concat_ws(" ", "reason", F.col("offset").cast("string"))
    return read_output(spark, out, "alerts").select(F.lit("alerts").alias("table"), F.col("body").alias("text")).unionAll(
        read_output(spark, out, "rejects").select(F.lit("rejects"), rejected))


@register("stream_rejects", ORACLE_SQL["reject_records"])
def q_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .streaming.consume import read_output
    return read_output(spark, _consumed(spark, sf_dir), "rejects").select("reason", "key", "offset")


@register("historic_topic_totals", _LOADED_SQL)
def q_historic_topic_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Police lines → keyed JSON on a "topic" (JSON files here) → saver → lake."""
    from .plans.jobs import read_lake
    from .session import scratch_path
    from .streaming.load import historic_messages, save_violations
    src, topic, lake, ck1, ck2 = (scratch_path(spark, n) for n in
                                  ("raw_src", "topic", "lake", "pub_ckpt", "save_ckpt"))
    raw_lines(spark, sf_dir).write.text(src)
    q = (historic_messages(spark, src, suffix="txt").writeStream.format("json")
         .option("checkpointLocation", ck1).trigger(availableNow=True).start(topic))
    q.awaitTermination()
    save_violations(spark.readStream.schema("key string, value string").json(topic), lake, ck2)
    return _loaded(read_lake(spark, lake))


@register("cached_counts", f"""
with v as ({V_SEASONS})
select 'rows' as what, count(*) as n from v where sending_date is not null
union all select 'codes', count(distinct violation_code) from v where sending_date is not null
""")
def q_cached_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two answers from one cached aggregate, which is then released."""
    from .operators.cache import cached
    with cached(count_by(prepared(season_rows(spark, sf_dir)), "violation_code")) as counts:
        rows = counts.agg(F.sum("number_of_violations").alias("n")).first()[0]
        codes = counts.where("violation_code is not null").count()
    return spark.createDataFrame([("rows", rows), ("codes", codes)], "what string, n long")


@register("analyse_lake", f"""
with v as ({V_SEASONS} union all {V_PERIODS}),
d as (select {se('sending_date')} as season, {pe('sending_date')} as period, violation_code
      from v where sending_date is not null),
s as (select season, count(violation_code) as n from d where season in ('winter', 'summer')
      group by season),
c as (select violation_code, count(violation_code) as n from d group by 1),
p as (select period, count(violation_code) as n from d group by 1),
t as (select season, violation_code, count(violation_code) as n from d group by 1, 2),
r as (select *, {pct('n', 'partition by season')} as percent, row_number() over (
        partition by season order by n desc, violation_code asc nulls first) as k from t)
select 'season_share' as answer, season as label, n as number_of_violations,
       {pct('n')} as percent from s
union all select * from (select 'top5_codes', violation_code, n, {pct('n')} from c
                         order by n desc, violation_code asc nulls first limit 5)
union all select 'period_share', period, n, {pct('n')} from p
union all select 'top_code_per_season', season || ' ' || violation_code, n, percent from r where k = 1
""")
def q_analyse_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end-to-end job: a lake on disk → four answer files → read back."""
    from .plans.jobs import analyse_lake
    from .session import scratch_path
    from .sources.tables import read_table, write_table
    lake, out = scratch_path(spark, "lake"), scratch_path(spark, "answers")
    rows = all_rows(spark, sf_dir)
    write_table(rows.select(F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"),
                            "sending_date", F.lit(None).cast("string").alias("drone_id"),
                            "violation_code", F.lit(None).cast("string").alias("image_id")), lake)
    analyse_lake(spark, lake, out)
    parts = []
    for name, label in (("season_share", "a"), ("top5_codes", "a"), ("period_share", "a"),
                        ("top_code_per_season", "concat(a, ' ', b)")):
        wide = name == "top_code_per_season"
        schema = f"a string, {'b string, ' if wide else ''}n long, percent double"
        parts.append(read_table(spark, f"{out}/{name}", "csv", schema=schema).selectExpr(
            f"'{name}' as answer", f"{label} as label", "n as number_of_violations", "percent"))
    return functools.reduce(DataFrame.unionByName, parts)


@register("published_answers", ORACLE_SQL["analyse_lake"])
def q_published_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers from stored partial cubes, published as one set and read back through its pointer."""
    from .plans.jobs import analyse_lake, read_answers
    from .session import scratch_path
    from .sources.tables import write_table
    from .streaming.cube import backfill_cube
    lake, cube, out = (scratch_path(spark, n) for n in ("lake", "cube", "answers"))
    for rows in (season_rows(spark, sf_dir), period_rows(spark, sf_dir)):
        write_table(conform(rows.select(F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"),
                                        "sending_date", F.lit(None).cast("string").alias("drone_id"), "violation_code")), lake)
        backfill_cube(spark, lake, cube)
        analyse_lake(spark, lake, out, cube_path=cube, together=True)
    label = {"top_code_per_season": F.concat("season", F.lit(" "), "violation_code")}
    parts = [df.select(F.lit(n).alias("answer"), label.get(n, F.col(df.columns[0])).alias("label"), "number_of_violations", "percent")
             for n, df in read_answers(spark, out).items()]
    return functools.reduce(DataFrame.unionByName, parts)


# -- the four answers through the cube (Q5), over lineitem and events together --

V_ALL = f"{V_SEASONS} union all {V_PERIODS}"


@register("season_share_cube", f"""
with v as ({V_ALL}),
g as (select season, count(violation_code) as n
      from (select {se('sending_date')} as season, violation_code from v
            where sending_date is not null) t
      where season in ('winter', 'summer') group by season)
select season, n as number_of_violations, {pct('n')} as percent from g
""")
def q_season_share_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.season_share_from(A.violation_cube(all_rows(spark, sf_dir)))


@register("top5_codes_cube", f"""
with v as ({V_ALL}),
g as (select violation_code, count(violation_code) as n from v
      where sending_date is not null group by violation_code)
select violation_code, n as number_of_violations, {pct('n')} as percent from g
order by n desc, violation_code asc nulls first limit 5
""")
def q_top5_codes_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_codes_from(A.violation_cube(all_rows(spark, sf_dir)))


@register("period_share_cube", f"""
with v as ({V_ALL}),
g as (select {pe('sending_date')} as period, count(violation_code) as n from v
      where sending_date is not null group by 1)
select period, n as number_of_violations, {pct('n')} as percent from g
""")
def q_period_share_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.period_share_from(A.violation_cube(all_rows(spark, sf_dir)))


@register("top_code_per_season_cube", f"""
with v as ({V_ALL}),
g as (select {se('sending_date')} as season, violation_code, count(violation_code) as n
      from v where sending_date is not null group by 1, 2),
r as (select season, violation_code, n, {pct('n', 'partition by season')} as percent,
             row_number() over (partition by season
                                order by n desc, violation_code asc nulls first) as k
      from g)
select season, violation_code, n as number_of_violations, percent from r where k = 1
""")
def q_top_code_per_season_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_code_per_season_from(A.violation_cube(all_rows(spark, sf_dir)))


@register("band_filters", f"""
select 'season' as band, season as name, count(*) as n_rows from (
  select {se('ts')} as season from events) t group by season
union all
select 'period', period, count(*) from (select {pe('ts')} as period from events) t
group by period
""")
def q_band_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each season and each period, labelled once (``in_season`` and
    ``in_period`` filter on the same labels; events are January only)."""
    ev = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    bands = F.explode(F.array(F.struct(F.lit("season").alias("band"), season("ts").alias("name")),
                              F.struct(F.lit("period").alias("band"), period("ts").alias("name"))))
    return (ev.select(bands.alias("b")).groupBy("b.band", "b.name")
            .agg(F.count(F.lit(1)).alias("n_rows")))
