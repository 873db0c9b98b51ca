from datetime import datetime

import pytest
from pyspark.sql import functions as F

from patrolspark.functions import codec
from patrolspark.operators.images import latest_images
from patrolspark.operators.messages import (all_rejects, decode_image, decode_standard,
                                            decode_violation, route)

S, V, I = "STANDARD_MESSAGE", "VIOLATION_MESSAGE", "VIOLATION_IMAGE"
GOOD_STD = '{"lat":-73.2,"lng":40.1,"sending_date":1590000000123,"drone_id":"7"}'


def _df(spark, rows):
    return spark.createDataFrame([(k, v, 0, i) for i, (k, v) in enumerate(rows)],
                                 "key string, value string, partition int, offset long")


def test_fixture_j_standard(spark):
    rows = [(S, GOOD_STD),
            (S, GOOD_STD.replace("-73.2", '"-73.2"')),
            (S, GOOD_STD.replace('"7"', "7")),
            (S, GOOD_STD.replace("1590000000123", "1.5")),
            (S, '{"lat":1.0,"lng":2.0,"drone_id":"7"}'),
            (S, '{"lat":1.0,"lng":2.0,"sending_date":null,"drone_id":"7"}'),
            (S, "not json"), (S, "[]"), (S, "null"), (S, None)]
    good, bad = decode_standard(_df(spark, rows), keep=("offset",))
    g = good.collect()
    assert len(g) == 1
    assert (g[0].lat, g[0].lng, g[0].drone_id) == (-73.2, 40.1, "7")
    assert g[0].sending_date == datetime(2020, 5, 20, 18, 40, 0, 123000)
    reasons = {r.offset: r.reason for r in bad.collect()}
    assert set(reasons) == set(range(1, 10))
    assert reasons[1] == "bad type lat" and reasons[2] == "bad type drone_id"
    assert reasons[3] == "bad type sending_date"
    assert reasons[4] == "missing sending_date" and reasons[5] == "missing sending_date"
    assert all(reasons[i] == "not a JSON object" for i in (6, 7, 8, 9))


def test_fixture_j_violation(spark):
    full = ('{"lat":1.5,"lng":2,"sending_date":1590000000123,"drone_id":"d",'
            '"violation_code":"21","image_id":"i","extra":[1]}')
    rows = [(V, "{}"), (V, full), (V, '{"drone_id":7}'), (V, '{"violation_code":null}'),
            (V, "[]")]
    good, bad = decode_violation(_df(spark, rows), keep=("offset",))
    g = {r.offset: r for r in good.collect()}
    assert set(g) == {0, 1, 3}
    assert all(g[0][c] is None for c in ("lat", "lng", "sending_date", "drone_id",
                                         "violation_code", "image_id"))
    assert (g[1].lat, g[1].lng, g[1].violation_code, g[1].image_id) == (1.5, 2.0, "21", "i")
    assert {r.offset: r.reason for r in bad.collect()} == {2: "bad type drone_id",
                                                           4: "not a JSON object"}


def test_fixture_j_image(spark):
    rows = [(I, '{"image_id":"i","content":"c","extra":1}'), (I, '{"image_id":"i"}'),
            (I, '{"image_id":"i","content":5}')]
    good, bad = decode_image(_df(spark, rows), keep=("offset",))
    assert [(r.image_id, r.content) for r in good.collect()] == [("i", "c")]
    assert {r.offset: r.reason for r in bad.collect()} == {1: "missing content",
                                                           2: "bad type content"}


def test_route_null_and_other_keys_are_unhandled(spark):
    df = _df(spark, [(S, GOOD_STD), ("OTHER", "{}"), (None, "{}"), (V, "{}"), (I, "{}")])
    r = route(df)
    assert {k: d.count() for k, d in r.items()} == \
        {"standard": 1, "violation": 1, "image": 1, "unhandled": 2}
    rej = all_rejects(df).collect()
    assert sorted((x.reason, x.key or "") for x in rej) == \
        [("missing image_id", I), ("unhandled key", ""), ("unhandled key", "OTHER")]


def test_encode_decode_identity(spark):
    from patrolspark.schemas import VIOLATION
    rows = [(1.25, -3.5, datetime(2020, 1, 2, 3, 4, 5, 678000), "d", "21", "img"),
            (None, None, None, None, None, None),
            (0.1, 1e10, datetime(1999, 12, 31, 23, 59, 59), "x", None, "i")]
    src = spark.createDataFrame(rows, VIOLATION)
    enc = src.select(F.lit(V).alias("key"), codec.encode_violation().alias("value"))
    assert enc.collect()[1].value == "{}"
    good, bad = decode_violation(enc)
    assert bad.count() == 0
    assert sorted(map(tuple, good.collect()), key=str) == sorted(map(tuple, src.collect()), key=str)


def test_fixture_i_latest_image(spark):
    df = spark.createDataFrame([("a", "old", 0, 5), ("a", "new", 0, 9), ("b", "x", 0, 1)],
                               "image_id string, content string, partition int, offset long")
    got = {r.image_id: r.content for r in latest_images(df).collect()}
    assert got == {"a": "new", "b": "x"}


def test_alert_text_unknowns(spark):
    from patrolspark.operators.alerts import alerts
    good, _ = decode_violation(_df(spark, [(V, "{}")]))
    a = alerts(good, "/img").first()
    assert a.subject == "Violation Alert"
    assert a.body.count("Unknown") == 6
    assert a.body.startswith("New Violation Occured\nViolation Code: Unknown\n")
    assert a.body.endswith("\n\n\n-- SENT FROM ALERT HANDLER SYSTEM --\n")


def test_alert_text_values(spark):
    from patrolspark.operators.alerts import alerts
    full = ('{"lat":-73.25,"lng":40.5,"sending_date":1590000000123,"drone_id":"d7",'
            '"violation_code":"21","image_id":"im1"}')
    good, _ = decode_violation(_df(spark, [(V, full)]))
    body = alerts(good, "/lake/img/").first().body
    assert body == ("New Violation Occured\nViolation Code: 21\n"
                    "Occurring Date: 2020-05-20T18:40:00\nLatitude : -73.25\n"
                    "Longitude : 40.5\nDrone ID: d7\nViolation Image: /lake/img/im1\n\n\n"
                    "-- SENT FROM ALERT HANDLER SYSTEM --\n")


@pytest.mark.parametrize("text,ok", [("1.0", True), ("1e3", True), ("1.5", False),
                                     ('"1"', False), ("true", False)])
def test_epoch_millis_must_be_whole(spark, text, ok):
    v = '{"lat":1,"lng":2,"drone_id":"x","sending_date":%s}' % text
    good, _ = decode_standard(_df(spark, [(S, v)]))
    assert (good.count() == 1) == ok


def test_decode_all_agrees_with_each_decoder(spark):
    from patrolspark.operators.messages import decode_all
    rows = [(S, GOOD_STD), (S, GOOD_STD.replace('"7"', "7")), (V, "{}"), (V, "[]"),
            (I, '{"image_id":"i","content":"c"}'), (I, '{"image_id":"i"}'), ("OTHER", "{}"),
            (None, None), (S, None)]
    df = _df(spark, rows)
    d = {r.offset: r for r in decode_all(df, keep=("offset",)).collect()}
    assert [d[i].route for i in range(9)] == ["standard", "standard", "violation", "violation",
                                              "image", "image", "unhandled", "unhandled",
                                              "standard"]
    assert [d[i].reason for i in range(9)] == [None, "bad type drone_id", None,
                                               "not a JSON object", None, "missing content",
                                               "unhandled key", "unhandled key",
                                               "not a JSON object"]
    assert d[0].lat == -73.2 and d[0].image_id is None and d[0].content is None
    assert d[4].content == "c" and d[4].lat is None


def test_keyed_payload(spark):
    from patrolspark.sources.kafka import keyed_payload
    df = spark.createDataFrame([(1.5, None, "x")], "lat double, lng double, drone_id string")
    r = keyed_payload(df, "VIOLATION_MESSAGE").first()
    assert (r.key, r.value) == ("VIOLATION_MESSAGE", '{"lat":1.5,"drone_id":"x"}')


def test_encode_standard_and_image_round_trip(spark):
    std = spark.createDataFrame([(1.5, -2.0, datetime(2020, 5, 20, 18, 40, 0, 123000), "7")],
                                "lat double, lng double, sending_date timestamp, drone_id string")
    enc = std.select(F.lit(S).alias("key"), codec.encode_standard().alias("value"))
    assert enc.first().value == \
        '{"lat":1.5,"lng":-2.0,"sending_date":1590000000123,"drone_id":"7"}'
    good, bad = decode_standard(enc)
    assert bad.count() == 0 and list(good.first()) == list(std.first())
    img = spark.createDataFrame([("i", "c")], "image_id string, content string")
    enc = img.select(F.lit(I).alias("key"), codec.encode_image().alias("value"))
    good, _ = decode_image(enc)
    assert list(good.first()) == ["i", "c"]


def test_duplicate_key_keeps_last_value(spark):
    rows = [(S, '{"lat":"x","lat":1.0,"lng":2.0,"sending_date":5,"drone_id":"d"}'),
            (S, '{"lat":1.0,"lat":"x","lng":2.0,"sending_date":5,"drone_id":"d"}')]
    good, bad = decode_standard(_df(spark, rows), keep=("offset",))
    assert [r.offset for r in good.collect()] == [0]
    assert [(r.offset, r.reason) for r in bad.collect()] == [(1, "bad type lat")]


def test_negative_zero_reads_as_zero(spark):
    # a JSON number is read as a decimal, which has no negative zero (as the
    # original system's BigDecimal-based reader)
    good, _ = decode_violation(_df(spark, [(V, '{"lat":-0.0,"lng":0.0}')]))
    r = good.first()
    assert str(r.lat) == "0.0" and str(r.lng) == "0.0"


def test_out_of_range_epoch_millis_is_a_reject_not_a_crash(spark):
    rows = [(S, '{"lat":1,"lng":2,"drone_id":"d","sending_date":9223372036854776}'),
            (V, '{"sending_date":-9223372036854775808}'),
            (S, '{"lat":1,"lng":2,"drone_id":"d","sending_date":9223372036854775}')]
    df = _df(spark, rows)
    from patrolspark.operators.messages import decode_all
    dec = decode_all(df, keep=("offset",)).select("offset", "reason")  # the valid date is
    got = {r.offset: r.reason for r in dec.collect()}                 # past Python's range
    assert got == {0: "bad value sending_date", 1: "bad value sending_date", 2: None}
