from datetime import datetime

from pyspark.sql import functions as F

from patrolspark.functions.parse import (compact_clock, field, iso_seconds, split_fields,
                                         try_parse_ts, violation_ts)
from patrolspark.operators.conform import to_violation
from patrolspark.sources.raw import raw_files, raw_records

# Fixture R: (date, clock, expected with noon="reference", expected with noon="clock")
R = [
    ("05/04/2016", "0143P", datetime(2016, 5, 4, 13, 43), datetime(2016, 5, 4, 13, 43)),
    ("05/04/2016", "0143A", datetime(2016, 5, 4, 1, 43), datetime(2016, 5, 4, 1, 43)),
    ("05/04/2016", "0143", datetime(2016, 5, 4, 1, 43), datetime(2016, 5, 4, 1, 43)),
    ("05/04/2016", "0143p", datetime(2016, 5, 4, 1, 43), datetime(2016, 5, 4, 1, 43)),
    ("05/04/2016", "0143AP", datetime(2016, 5, 4, 13, 43), datetime(2016, 5, 4, 13, 43)),
    ("05/04/2016", "1230P", datetime(2016, 5, 4, 0, 30), datetime(2016, 5, 4, 12, 30)),
    ("05/04/2016", "1215A", datetime(2016, 5, 4, 12, 15), datetime(2016, 5, 4, 0, 15)),
    ("13/45/2016", "0900A", datetime(2017, 2, 14, 9, 0), datetime(2017, 2, 14, 9, 0)),
    ("00/00/2016", "0000A", datetime(2015, 11, 30, 0, 0), datetime(2015, 11, 30, 0, 0)),
    ("05/04/2016", "2510A", datetime(2016, 5, 5, 1, 10), None),
    ("05/04/2016", "12", None, None),
    ("05/04/2016", "ABCDP", None, None),
    ("05/04/2016", None, None, None),
    ("05-04-2016", "0143P", None, None),
    ("Issue Date", "0143P", None, None),
    (None, "0143P", None, None),
    ("05/04/", "0143P", None, None),
]


def _ts(spark, noon):
    df = spark.createDataFrame([(i, d, c) for i, (d, c, _, _) in enumerate(R)],
                               "i int, d string, c string")
    rows = df.select("i", violation_ts("d", "c", noon).alias("t")).orderBy("i").collect()
    return [r.t for r in rows]


def test_fixture_r_reference_rule(spark):
    assert _ts(spark, "reference") == [e for _, _, e, _ in R]


def test_fixture_r_clock_rule(spark):
    got = _ts(spark, "clock")
    for (d, c, _, e), g in zip(R, got):
        if e is not None:
            assert g == e, (d, c)


def test_compact_clock_parts(spark):
    df = spark.createDataFrame([("0143P",), ("1230P",), ("9999A",), ("1",)], "c string")
    r = df.select(compact_clock("c").alias("k")).collect()
    assert [(x.k.hour, x.k.minute) if x.k else None for x in r] == \
        [(13, 43), (0, 30), (99, 99), None]


def test_split_fields_keeps_quotes_and_empties(spark):
    df = spark.createDataFrame([('a,"b,c",,d',), ("x",)], "l string")
    r = df.select(split_fields("l").alias("p")).collect()
    assert r[0].p == ["a", '"b,c"', "", "d"]
    assert r[1].p == ["x"]
    assert df.select(field(split_fields("l"), 7).alias("f")).first().f is None


def _line(fields):
    return ",".join(fields)


def test_raw_lines_quoted_comma_empty_code_short_line_header(spark):
    base = ["0", "1", '"Main St, 5"', "NY", "05/04/2016", "21"] + ["x"] * 13 + ["0143P", "z"]
    empty = list(base); empty[5] = ""
    quoted = list(base); quoted[5] = '"46"'
    header = ["Summons Number", "Plate", "State", "Type", "Issue Date", "Violation Code"] + \
        ["h"] * 13 + ["Violation Time", "h"]
    lines = [_line(base), _line(empty), _line(quoted), _line(base[:8]), _line(header)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    v = to_violation(raw_records(df)).collect()
    assert v[0].sending_date == datetime(2016, 5, 4, 13, 43) and v[0].violation_code == "21"
    assert v[1].violation_code is None
    assert v[2].violation_code == "46"
    assert v[3].sending_date is None and v[3].violation_code == "21"
    assert v[4].sending_date is None and v[4].violation_code == "Violation Code"
    assert all(r.lat is None and r.lng is None and r.drone_id is None and r.image_id is None
               for r in v)


def test_raw_files_suffix_and_no_recursion(spark, tmp_dir):
    import os
    line = _line(["0", "1", "2", "3", "05/04/2016", "21"] + ["x"] * 13 + ["0143P", "z"])
    os.makedirs(f"{tmp_dir}/sub")
    for name in ("a.csv", "b.txt", "sub/c.csv"):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(line + "\n")
    assert raw_files(spark, tmp_dir).count() == 1


def test_try_parse_ts_and_iso_seconds(spark):
    df = spark.createDataFrame([("04-05-2016 13:43:00",), ("nope",)], "s string")
    r = df.select(try_parse_ts("s", "dd-MM-yyyy HH:mm:ss").alias("t")).collect()
    assert r[0].t == datetime(2016, 5, 4, 13, 43) and r[1].t is None
    r = df.select(iso_seconds(F.lit(datetime(2016, 5, 4, 13, 43, 5))).alias("x")).first()
    assert r.x == "2016-05-04T13:43:05"


def test_split_fields_long_line_with_many_quotes(spark):
    # the look-ahead regex overflows the regex engine on such a line; the
    # linear split does not
    line = ",".join(['"a,b"'] * 20000)
    df = spark.createDataFrame([(line,)], "l string")
    assert df.select(F.size(split_fields("l")).alias("n")).first().n == 20000


def test_split_fields_is_compiled_and_needs_no_mark(spark):
    # even and odd numbers of quotes, quotes at either end, line breaks, control characters
    lines = ['a,"b,c",d', 'a,b"c,d', 'a"b,c"d,e"f,g', '"', '",', ',"', '"a","b', "x\u0001,\u0002\u0003,", "a\n,\"b,\nc\"",
             "", ",", ",,", '""', '"",""', '"a,b",' * 50000 + '"', '"' + "a," * 100000]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, l string").select("i", split_fields("l").alias("p"))
    assert [r.p for r in df.orderBy("i").collect()] == [split_by_count(x) for x in lines]
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()  # lambdas run interpreted, row by row


def split_by_count(text):
    """Commas with an even number of quotes after them separate."""
    after, fields, last = text.count('"'), [], 0
    for i, c in enumerate(text):
        after -= c == '"'
        if c == "," and after % 2 == 0:
            fields.append(text[last:i])
            last = i + 1
    return [*fields, text[last:]]
