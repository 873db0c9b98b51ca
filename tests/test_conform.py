from datetime import datetime

from patrolspark.operators.conform import conform, prepared
from patrolspark.schemas import VIOLATION


def test_conform_by_position_extra_missing_bad(spark):
    df = spark.createDataFrame([("1.5", "x", "2020-01-02 03:04:05", "d", "21", "i", "extra")],
                               "z string, y string, q string, w string, v string, u string, "
                               "t string")
    r = conform(df).first()
    assert conform(df).schema == VIOLATION.__class__(
        [f.__class__(f.name, f.dataType, True) for f in VIOLATION.fields])
    assert (r.lat, r.lng, r.sending_date, r.drone_id, r.violation_code, r.image_id) == \
        (1.5, None, datetime(2020, 1, 2, 3, 4, 5), "d", "21", "i")
    short = conform(df.select("z", "y", "q")).first()
    assert short.violation_code is None and short.image_id is None and short.lat == 1.5


def test_prepared_drops_undated(spark):
    df = spark.createDataFrame([("1", "2", "2020-01-01"), ("1", "2", "Issue Date")],
                               "a string, b string, c string")
    assert prepared(conform(df)).count() == 1


def test_csv_lake_round_trip(spark, tmp_dir):
    from patrolspark.sources.tables import read_table, write_table
    rows = [(1.5, None, datetime(2016, 5, 4, 13, 10), None, "21", None),
            (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, VIOLATION)
    write_table(df, f"{tmp_dir}/lake", "csv")
    back = conform(read_table(spark, f"{tmp_dir}/lake", "csv"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_write_result_single_part(spark, tmp_dir):
    import glob
    from patrolspark.sources.tables import write_result
    df = spark.range(10).repartition(4)
    write_result(df, f"{tmp_dir}/res")
    write_result(df, f"{tmp_dir}/res")  # overwrite
    assert len(glob.glob(f"{tmp_dir}/res/part-*")) == 1


def test_failed_write_raises(spark, tmp_dir):
    import pytest
    from patrolspark.sources.tables import write_result, write_table
    blocker = f"{tmp_dir}/blocker"
    with open(blocker, "w") as f:
        f.write("a file where a directory should go")
    with pytest.raises(Exception):
        write_table(spark.range(3), f"{blocker}/t", "parquet")
    with pytest.raises(Exception):
        write_result(spark.range(3), f"{blocker}/r")


def test_generic_read_write_with_options_schema_and_partitions(spark, tmp_dir):
    from patrolspark.sources.tables import read_table, write_table
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "n int, g string")
    write_table(df, f"{tmp_dir}/p", "parquet", partition_by=["g"])
    write_table(df, f"{tmp_dir}/p", "parquet", partition_by=["g"])      # append (default)
    back = read_table(spark, f"{tmp_dir}/p", "parquet")
    assert back.where("g = 'a'").count() == 4 and set(back.columns) == {"n", "g"}
    write_table(df, f"{tmp_dir}/c", "csv", options={"sep": ";", "header": "true"})
    typed = read_table(spark, f"{tmp_dir}/c", "csv", options={"sep": ";", "header": "true"},
                       schema="n int, g string")
    assert sorted(map(tuple, typed.collect())) == [(1, "a"), (2, "b"), (3, "a")]
