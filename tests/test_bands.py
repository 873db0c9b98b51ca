from pyspark.sql import functions as F

from patrolspark.functions.bands import period, season
from fixtures import FIXTURE_G, G_PERIODS, G_SEASONS, violations_df


def test_season_and_period_labels_fixture_g(spark):
    df = violations_df(spark, FIXTURE_G).withColumn("i", F.monotonically_increasing_id())
    rows = df.orderBy("i").select(season("sending_date").alias("s"),
                                  period("sending_date").alias("p")).collect()
    assert [r.s for r in rows] == G_SEASONS
    assert [r.p for r in rows] == G_PERIODS


def test_bands_tile_the_year_and_day(spark):
    # every minute of a leap year gets exactly one season and one period
    df = spark.sql("select explode(sequence(timestamp'2020-01-01 00:00:00', "
                   "timestamp'2020-12-31 23:59:00', interval 7 minutes)) as d")
    r = df.select(season("d").alias("s"), period("d").alias("p")) \
        .agg(F.count(F.when(F.col("s").isNull(), 1)).alias("ns"),
             F.count(F.when(F.col("p").isNull(), 1)).alias("np"),
             F.countDistinct("s").alias("ds"), F.countDistinct("p").alias("dp")).first()
    assert (r.ns, r.np, r.ds, r.dp) == (0, 0, 4, 2)


def test_calendar_fields_of_fixed_dates(spark):
    from patrolspark.functions.bands import minute_of_day, month_day
    dates = {"1600-01-01 00:00:00": (101, 0), "1969-12-31 23:59:59.999999": (1231, 1439), "1970-01-01 00:00:00": (101, 0),
             "2000-02-29 12:00:00": (229, 720), "2100-03-01 00:00:00": (301, 0), "2400-12-31 20:01:00": (1231, 1201)}
    df = spark.createDataFrame([(d,) for d in dates], "d string").select(F.col("d").cast("timestamp").alias("t"))
    assert [tuple(r) for r in df.select(month_day("t"), minute_of_day("t")).collect()] == list(dates.values())


def test_timestamp_ntz_and_other_zones(spark):
    from datetime import datetime
    from patrolspark.functions.bands import minute_of_day, month_day
    df = spark.createDataFrame([(datetime(2020, 3, 21, 19, 59),)], "t timestamp_ntz")
    r = df.select(month_day("t").alias("md"), minute_of_day("t").alias("m")).first()
    assert (r.md, r.m) == (321, 19 * 60 + 59)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = spark.sql("select timestamp'2020-03-21 19:59:00' as t")  # read in session zone
        r = ts.select(month_day("t").alias("md"), minute_of_day("t").alias("m"),
                      season("t").alias("s")).first()
        assert (r.md, r.m, r.s) == (321, 19 * 60 + 59, "spring")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_dates_get_no_label_in_generated_code(spark):
    from patrolspark.functions.bands import period_name, season_name
    df = spark.createDataFrame([(None,), (1,), (3,)], "i int")
    r = df.select(season_name("i").alias("s"), period_name("i").alias("p")).collect()
    assert [(x.s, x.p) for x in r] == [(None, None), ("spring", "day"), ("autumn", None)]
