"""Property tests (hypothesis): rules equal brute force, untrusted input never raises.

``PROPERTY_EXAMPLES=<n>`` runs every property with n examples (default 25).
"""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

EXAMPLES = int(os.environ.get("PROPERTY_EXAMPLES", "25"))

digits = st.text(alphabet="0123456789", min_size=1, max_size=3)
dates = st.one_of(
    st.builds(lambda m, d, y: f"{m}/{d}/{y}", digits, digits,
              st.integers(min_value=0, max_value=9999).map(str)),
    st.text(alphabet="0123456789/-x ", max_size=12))
clocks = st.one_of(
    st.builds(lambda h, m, s: f"{h:02d}{m:02d}{s}", st.integers(0, 99), st.integers(0, 99),
              st.sampled_from(["A", "P", "", "AP", "p", "X"])),
    st.text(alphabet="0123456789APx", max_size=6))


@settings(max_examples=EXAMPLES, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(min_value=-5_000_000_000_000_000,
                            max_value=8_000_000_000_000_000), min_size=1, max_size=80))
def test_season_and_period_equal_builtins(spark, micros):
    from pyspark.sql import functions as F
    from patrolspark.functions.bands import minute_of_day, month_day
    df = spark.createDataFrame([(m,) for m in micros], "us long") \
        .select(F.timestamp_micros("us").alias("t"))
    bad = df.where((month_day("t") != F.month("t") * 100 + F.dayofmonth("t")) |
                   (minute_of_day("t") != F.hour("t") * 60 + F.minute("t")))
    assert bad.count() == 0


# -- message decoding against a brute-force checker ------------------------------

import json  # noqa: E402

FIELDS = {
    "standard": [("lat", "double", True), ("lng", "double", True),
                 ("sending_date", "long", True), ("drone_id", "string", True)],
    "violation": [("lat", "double", False), ("lng", "double", False),
                  ("sending_date", "long", False), ("drone_id", "string", False),
                  ("violation_code", "string", False), ("image_id", "string", False)],
    "image": [("image_id", "string", True), ("content", "string", True)],
}
KEYS = {"standard": "STANDARD_MESSAGE", "violation": "VIOLATION_MESSAGE",
        "image": "VIOLATION_IMAGE"}


def _type_ok(v, kind):
    if isinstance(v, bool):
        return False
    if kind == "string":
        return isinstance(v, str)
    if kind == "double":
        return isinstance(v, (int, float))
    if isinstance(v, int):
        return -2**63 <= v < 2**63
    return isinstance(v, float) and v.is_integer() and abs(v) < 2**53


def expected_reason(text, kind):
    try:
        obj = json.loads(text)
    except (TypeError, ValueError):
        return "not a JSON object"
    if not isinstance(obj, dict):
        return "not a JSON object"
    for name, jkind, required in FIELDS[kind]:
        present = obj.get(name) is not None
        if required and not present:
            return f"missing {name}"
        if present and not _type_ok(obj[name], jkind):
            return f"bad type {name}"
        if present and name == "sending_date" and abs(int(obj[name])) > (2**63 - 1) // 1000:
            return f"bad value {name}"
    return None


scalars = st.one_of(st.none(), st.booleans(), st.integers(-2**62, 2**62),
                    st.floats(-1e15, 1e15, allow_nan=False, allow_infinity=False),
                    st.text(max_size=5))
values = st.one_of(scalars, st.lists(scalars, max_size=2),
                   st.dictionaries(st.sampled_from(["lat", "x"]), scalars, max_size=2))
names = st.sampled_from(["lat", "lng", "sending_date", "drone_id", "violation_code",
                         "image_id", "content", "LAT", "extra"])
objects = st.dictionaries(names, values, max_size=7).map(json.dumps)
texts = st.one_of(objects, st.one_of(values.map(json.dumps),
                                     st.sampled_from(["not json", "", "{", '{"lat":1,}'])))


@settings(max_examples=EXAMPLES, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(sorted(FIELDS)), texts), min_size=1, max_size=40))
def test_decode_matches_brute_force(spark, msgs):
    from patrolspark.operators.messages import decode_all
    rows = [(KEYS[k], t, 0, i) for i, (k, t) in enumerate(msgs)]
    df = spark.createDataFrame(rows, "key string, value string, partition int, offset long")
    from pyspark.sql import functions as F
    dec = decode_all(df, keep=("offset",))
    # dates compared as epoch milliseconds inside Spark: any long is a valid
    # date there, even one Python's datetime cannot hold
    dec = dec.withColumn("sending_date", F.unix_millis("sending_date"))
    got = {r.offset: r for r in dec.collect()}
    for i, (kind, text) in enumerate(msgs):
        want = expected_reason(text, kind)
        assert got[i].reason == want, (kind, text, got[i].reason, want)
        if want is None:
            obj = json.loads(text)
            for name, jkind, _ in FIELDS[kind]:
                v = obj.get(name)
                g = got[i][name]
                if name == "sending_date":
                    v = None if v is None else int(v)
                elif jkind == "double" and v is not None:
                    v = float(v)  # a JSON integer read as a double rounds like any reader's
                assert g == v, (name, g, v)


# -- raw-line timestamps against a brute-force computation ------------------------

def expected_ts(date, clock):
    from datetime import datetime, timedelta
    parts = date.split("/")
    if len(parts) < 3 or not all(p.isdigit() and p.isascii() for p in parts[:3]):
        return None
    mo, d, y = (int(p) for p in parts[:3])
    if len(clock) < 4 or not clock[:4].isdigit() or not clock[:4].isascii():
        return None
    h, mi = int(clock[:2]), int(clock[2:4])
    if "P" in clock:
        h = (h + 12) % 24
    months = y * 12 + mo - 1
    yy, mm = divmod(months, 12)
    if not 1 <= yy <= 9999:
        return None
    try:
        return datetime(yy, mm + 1, 1) + timedelta(days=d - 1, hours=h, minutes=mi)
    except OverflowError:
        return None


@settings(max_examples=EXAMPLES, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(
    st.builds(lambda m, d, y: f"{m}/{d}/{y}", st.integers(0, 40), st.integers(0, 400),
              st.integers(1, 9998)),
    st.builds(lambda h, m, s: f"{h:02d}{m:02d}{s}", st.integers(0, 99), st.integers(0, 99),
              st.sampled_from(["A", "P", "", "AP"]))), min_size=1, max_size=50))
def test_violation_ts_matches_brute_force(spark, rows):
    from pyspark.sql import functions as F
    from patrolspark.functions.parse import violation_ts
    df = spark.createDataFrame([(i, d, c) for i, (d, c) in enumerate(rows)],
                               "i int, d string, c string")
    got = {r.i: r.us for r in df.select(
        "i", F.unix_micros(violation_ts("d", "c")).alias("us")).collect()}
    from datetime import datetime, timedelta
    epoch = datetime(1970, 1, 1)
    for i, (d, c) in enumerate(rows):
        e = expected_ts(d, c)
        want = None if e is None else (e - epoch) // timedelta(microseconds=1)
        assert got[i] == want, (d, c, got[i], want)


# -- untrusted raw lines never fail a task ----------------------------------------

line_chars = st.sampled_from(list('0123456789/,"APap -:x\\t') + ["٣", "é"])
fields = st.text(line_chars, max_size=12)
lines = st.one_of(st.lists(fields, min_size=0, max_size=25).map(",".join),
                  st.text(line_chars, max_size=80))


@settings(max_examples=EXAMPLES, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(lines, min_size=1, max_size=40))
def test_raw_lines_never_raise(spark, texts):
    from pyspark.sql import functions as F
    from patrolspark.operators.conform import to_violation
    from patrolspark.sources.raw import raw_records
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    v = to_violation(raw_records(df))
    # every line gives exactly one record, whatever its content
    assert v.select(F.unix_micros("sending_date"), "violation_code").count() == len(texts)


@settings(max_examples=EXAMPLES, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from(list('ab,"\u0001 ')), max_size=30), min_size=1,
                max_size=40))
def test_linear_split_equals_the_rule(spark, texts):
    from pyspark.sql import functions as F
    from patrolspark.fixed import LINE_SPLIT_REGEX
    from patrolspark.functions.parse import split_fields
    df = spark.createDataFrame([(t,) for t in texts], "l string")
    bad = df.where(~F.coalesce(split_fields("l") == F.split("l", LINE_SPLIT_REGEX, -1),
                               F.lit(False)))
    assert bad.count() == 0


@settings(max_examples=max(5, EXAMPLES // 5), deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from(list('abP1/,"\\ ')), min_size=1, max_size=60), min_size=1,
                max_size=30))
def test_files_follow_the_split_rule(spark, texts):
    """Lines read through files give the fields that the split rule gives."""
    import os
    import re
    import tempfile
    from patrolspark.fixed import LINE_SPLIT_REGEX
    from patrolspark.sources.raw import raw_files
    folder = tempfile.mkdtemp()
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("\n".join(texts) + "\n")
    got = sorted(tuple(r) for r in raw_files(spark, folder).fillna("<none>").collect())

    def fields(line):
        parts = re.split(LINE_SPLIT_REGEX, line)
        parts = [p[1:-1] if len(p) >= 2 and p[0] == p[-1] == '"' else p for p in parts]
        return tuple((parts + ["<none>"] * 21)[:21])

    assert got == sorted(map(fields, texts))
