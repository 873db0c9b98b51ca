import os

import pytest
from pyspark.sql import functions as F

from patrolspark.schemas import KEYED
from patrolspark.sources.raw import raw_files
from patrolspark.operators.conform import to_violation
from patrolspark.plans.jobs import read_lake
from patrolspark.sources.tables import write_table
from patrolspark.streaming.consume import (compact_output, consume_messages, image_store,
                                           read_output, write_batch)
from patrolspark.streaming.idempotent import run_id
from patrolspark.streaming.load import grown_files, load_historic, save_violations


def _line(i, code="21"):
    return ",".join([str(i), "p", '"A, B"', "NY", "05/04/2016", code] + ["x"] * 13 +
                    ["0143P", "z"])


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_historic_load_each_file_once(spark, tmp_dir):
    src, lake, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    os.makedirs(src)
    _write(f"{src}/a.1.csv", [_line(i) for i in range(5)])
    _write(f"{src}/a.2.csv", [_line(i) for i in range(5, 8)])   # same prefix, no collision
    _write(f"{src}/skip.txt", [_line(99)])
    load_historic(spark, src, lake, ckpt)
    n1 = read_lake(spark, lake).count()
    assert n1 == 8
    # batch read of the same files gives the same rows
    batch = to_violation(raw_files(spark, src))
    assert sorted(map(tuple, batch.collect()), key=str) == \
        sorted(map(tuple, read_lake(spark, lake).collect()), key=str)
    load_historic(spark, src, lake, ckpt)                      # second run: nothing new
    assert read_lake(spark, lake).count() == 8
    _write(f"{src}/b.csv", [_line(i) for i in range(3)])       # a new file adds itself
    with open(f"{src}/a.1.csv", "a") as f:                     # a grown file adds nothing
        f.write(_line(100) + "\n")
    load_historic(spark, src, lake, ckpt)
    assert read_lake(spark, lake).count() == 11


def test_csv_lake_format(spark, tmp_dir):
    src, lake, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    os.makedirs(src)
    _write(f"{src}/a.csv", [_line(1), _line(2, "")])
    load_historic(spark, src, lake, ckpt, fmt="csv")
    back = read_lake(spark, lake, "csv").orderBy(F.col("violation_code").asc_nulls_last())
    rows = back.collect()
    assert [r.violation_code for r in rows] == ["21", None]
    assert str(rows[0].sending_date) == "2016-05-04 13:43:00"


def _messages(spark, path, rows):
    df = spark.createDataFrame(rows, KEYED)
    df.write.mode("append").json(path)


STD = '{"lat":1.0,"lng":2.0,"sending_date":1590000000123,"drone_id":"7"}'
VIO = '{"violation_code":"21","image_id":"i1"}'


def test_consume_messages_routes_all_records(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    _messages(spark, src, [("STANDARD_MESSAGE", STD, 0, 1), ("VIOLATION_MESSAGE", VIO, 0, 2),
                           ("VIOLATION_IMAGE", '{"image_id":"i1","content":"old"}', 0, 3),
                           ("VIOLATION_IMAGE", '{"image_id":"i1","content":"new"}', 0, 4),
                           ("STANDARD_MESSAGE", "not json", 0, 5), ("OTHER", "{}", 0, 6),
                           (None, "{}", 0, 7)])
    stream = spark.readStream.schema(KEYED).json(src)
    consume_messages(stream, out, ckpt, "/img", available_now=True)
    counts = {t: read_output(spark, out, t).count()
              for t in ("standard", "violation", "images", "alerts", "rejects")}
    assert counts == {"standard": 1, "violation": 1, "images": 2, "alerts": 1, "rejects": 3}
    assert [r.content for r in image_store(spark, out).collect()] == ["new"]
    # restart on the same checkpoint: nothing is consumed twice
    consume_messages(spark.readStream.schema(KEYED).json(src), out, ckpt, "/img",
                     available_now=True)
    assert read_output(spark, out, "standard").count() == 1
    # new messages arrive: only they are added
    _messages(spark, src, [("STANDARD_MESSAGE", STD, 0, 8)])
    consume_messages(spark.readStream.schema(KEYED).json(src), out, ckpt, "/img",
                     available_now=True)
    assert read_output(spark, out, "standard").count() == 2


def test_replayed_batch_is_idempotent(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    batch = spark.createDataFrame([("STANDARD_MESSAGE", STD, 0, 1),
                                   ("VIOLATION_MESSAGE", VIO, 0, 2)], KEYED)
    for _ in range(2):  # the same batch id written twice
        write_batch(batch, out, "/img", "run", 7)
    assert read_output(spark, out, "standard").count() == 1
    assert read_output(spark, out, "alerts").count() == 1
    write_batch(batch, out, "/img", "run", 8)  # next batch id adds rows
    assert read_output(spark, out, "violation").count() == 2


def test_run_id_lives_in_checkpoint(spark, tmp_dir):
    a = run_id(spark, f"{tmp_dir}/c1")
    assert run_id(spark, f"{tmp_dir}/c1") == a
    assert run_id(spark, f"{tmp_dir}/c2") != a


def test_save_violations_keeps_rejects_by_default(spark, tmp_dir):
    src, lake, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    _messages(spark, src, [("VIOLATION_MESSAGE", VIO, 0, 1), ("VIOLATION_MESSAGE", "[]", 0, 2)])
    save_violations(spark.readStream.schema(KEYED).json(src), lake, ckpt)
    rows = read_lake(spark, lake).collect()
    assert [(r.violation_code, r.image_id) for r in rows] == [("21", "i1")]
    lost = spark.read.parquet(f"{lake}_rejects").collect()
    assert [(r.reason, r.value, r.offset) for r in lost] == [("not a JSON object", "[]", 2)]


def test_one_lake_many_writers(spark, tmp_dir):
    """Two loads with two checkpoints, an append and a saver: every row is there."""
    lake = f"{tmp_dir}/lake"
    for name, n in (("one", 5), ("two", 7)):
        os.makedirs(f"{tmp_dir}/{name}")
        _write(f"{tmp_dir}/{name}/a.csv", [_line(i) for i in range(n)])
        load_historic(spark, f"{tmp_dir}/{name}", lake, f"{tmp_dir}/ck_{name}")
    write_table(read_lake(spark, lake).limit(7), lake)
    _messages(spark, f"{tmp_dir}/msg", [("VIOLATION_MESSAGE", VIO, 0, 1)])
    stream = spark.readStream.schema(KEYED).json(f"{tmp_dir}/msg")
    save_violations(stream, lake, f"{tmp_dir}/ck_save")
    assert read_lake(spark, lake).count() == 5 + 7 + 7 + 1
    for name in ("one", "two"):  # reruns add nothing; new files of either do
        load_historic(spark, f"{tmp_dir}/{name}", lake, f"{tmp_dir}/ck_{name}")
    save_violations(stream, lake, f"{tmp_dir}/ck_save")
    assert read_lake(spark, lake).count() == 20
    _write(f"{tmp_dir}/two/b.csv", [_line(1), _line(2), _line(3)])
    _write(f"{tmp_dir}/one/b.csv", [_line(1), _line(2)])
    for name in ("two", "one"):
        load_historic(spark, f"{tmp_dir}/{name}", lake, f"{tmp_dir}/ck_{name}")
    assert read_lake(spark, lake).count() == 25


def test_lake_of_a_file_sink_is_refused(spark, tmp_dir):
    import pytest
    os.makedirs(f"{tmp_dir}/lake/_spark_metadata")
    os.makedirs(f"{tmp_dir}/src")
    with pytest.raises(ValueError, match="file sink"):
        load_historic(spark, f"{tmp_dir}/src", f"{tmp_dir}/lake", f"{tmp_dir}/ck")


def test_grown_files_are_reported(spark, tmp_dir):
    src, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/ck"
    os.makedirs(src)
    _write(f"{src}/a b.csv", [_line(1)])
    _write(f"{src}/c.csv", [_line(2)])
    load_historic(spark, src, f"{tmp_dir}/lake", ckpt)
    assert grown_files(spark, src, ckpt).count() == 0
    with open(f"{src}/a b.csv", "a") as f:
        f.write(_line(3) + "\n")
    later = os.path.getmtime(f"{src}/a b.csv") + 5
    os.utime(f"{src}/a b.csv", (later, later))
    assert [r.path.rsplit("/", 1)[1] for r in grown_files(spark, src, ckpt).collect()] == ["a b.csv"]


def test_csv_lake_keeps_a_code_with_line_breaks_in_one_row(spark, tmp_dir):
    src, lake = f"{tmp_dir}/src", f"{tmp_dir}/lake"
    rows = [("VIOLATION_MESSAGE", '{"violation_code":"a\\nb\\rc","image_id":"i%d"}' % i, 0, i)
            for i in range(3)]
    _messages(spark, src, rows)
    save_violations(spark.readStream.schema(KEYED).json(src), lake, f"{tmp_dir}/ck", fmt="csv")
    got = sorted((r.violation_code, r.image_id) for r in read_lake(spark, lake, "csv").collect())
    assert got == [("a b c", f"i{i}") for i in range(3)]


def test_save_violations_with_rejects(spark, tmp_dir):
    src, lake, rej, ckpt = (f"{tmp_dir}/{n}" for n in ("src", "lake", "rej", "ckpt"))
    _messages(spark, src, [("VIOLATION_MESSAGE", VIO, 0, 1), ("VIOLATION_MESSAGE", "[]", 0, 2),
                           ("VIOLATION_MESSAGE", '{"lat":"x"}', 0, 3)])
    save_violations(spark.readStream.schema(KEYED).json(src), lake, ckpt, rejects_path=rej)
    assert [r.violation_code for r in read_lake(spark, lake).collect()] == ["21"]
    got = sorted((r.offset, r.reason) for r in spark.read.parquet(rej).collect())
    assert got == [(2, "not a JSON object"), (3, "bad type lat")]


def test_late_file_with_old_mtime_is_loaded(spark, tmp_dir):
    import time as _t
    src, lake, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    os.makedirs(src)
    _write(f"{src}/new.csv", [_line(1)])
    load_historic(spark, src, lake, ckpt)
    old = f"{src}/old.csv"                      # arrives later, but was written years ago
    _write(old, [_line(2), _line(3)])
    past = _t.time() - 3 * 365 * 86400
    os.utime(old, (past, past))
    load_historic(spark, src, lake, ckpt)
    assert read_lake(spark, lake).count() == 3


def test_two_stage_historic_load_through_a_topic(spark, tmp_dir):
    """files → keyed JSON "topic" (files here) → saver → lake == direct load."""
    from patrolspark.streaming.load import historic_messages
    src, topic = f"{tmp_dir}/src", f"{tmp_dir}/topic"
    os.makedirs(src)
    _write(f"{src}/a.csv", [_line(i) for i in range(4)] + [_line(9, "")])
    q = (historic_messages(spark, src).writeStream.format("json")
         .option("checkpointLocation", f"{tmp_dir}/ck1").trigger(availableNow=True).start(topic))
    q.awaitTermination()
    assert {r.key for r in spark.read.json(topic).collect()} == {"CSV_INTEGRATION"}
    save_violations(spark.readStream.schema("key string, value string").json(topic),
                    f"{tmp_dir}/lake2", f"{tmp_dir}/ck2")
    load_historic(spark, src, f"{tmp_dir}/lake1", f"{tmp_dir}/ck3")
    a = sorted(map(tuple, read_lake(spark, f"{tmp_dir}/lake1").collect()), key=str)
    b = sorted(map(tuple, read_lake(spark, f"{tmp_dir}/lake2").collect()), key=str)
    assert a == b and len(a) == 5


def test_stream_without_position_is_refused(spark, tmp_dir):
    import pytest
    batch = spark.createDataFrame([("VIOLATION_IMAGE", '{"image_id":"a","content":"c"}')],
                                  "key string, value string")
    with pytest.raises(ValueError, match="partition, offset"):
        write_batch(batch, f"{tmp_dir}/out", "/img", "run", 0)


def _image(content, offset, image_id="i"):
    return ("VIOLATION_IMAGE", '{"image_id":"%s","content":"%s"}' % (image_id, content), 0, offset)


def test_latest_image_in_any_write_order(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    for rid, batch_id, rows in (("2-run", 0, [_image("last", 0)]),  # a recreated topic starts over
                                ("1-run", 1, [_image("later", 9), _image("sooner", 8)]),
                                ("1-run", 0, [_image("first", 7)])):
        write_batch(spark.createDataFrame(rows, KEYED), out, "/img", rid, batch_id)
    assert [r.content for r in image_store(spark, out).collect()] == ["last"]


def _folders(path):
    return sum(d.startswith("batch_id=") for _, names, _ in os.walk(path) for d in names)


def _committed(spark, ckpt, rid, upto):
    """A checkpoint whose commit log ends with ``upto``."""
    os.makedirs(f"{ckpt}/commits", exist_ok=True)
    for b in range(upto + 1):
        _write(f"{ckpt}/commits/{b}", ["v1", "{}"])
    if not os.path.exists(f"{ckpt}/patrolspark_run_id"):
        spark.createDataFrame([(rid,)], "value string").write.text(f"{ckpt}/patrolspark_run_id")


def test_compaction_keeps_the_tables(spark, tmp_dir):
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    _committed(spark, ckpt, "1-run", 3)
    for b in range(4):
        rows = [("STANDARD_MESSAGE", STD, 0, 10 * b), ("VIOLATION_MESSAGE", VIO, 0, 10 * b + 1),
                _image(f"c{b}", 10 * b + 2), ("OTHER", "{}", 0, 10 * b + 3)]
        write_batch(spark.createDataFrame(rows, KEYED), out, "/img", "1-run", b)
    tables = ("standard", "violation", "alerts", "rejects")

    def seen():
        return ({t: sorted(map(str, read_output(spark, out, t).collect())) for t in tables},
                sorted(map(str, image_store(spark, out).collect())))

    before = seen()
    assert _folders(out) == 4
    compact_output(spark, out, ckpt, 1)
    assert seen() == before and _folders(out) == 3       # one merged, two live
    compact_output(spark, out, ckpt, 1)                  # a repeat changes nothing
    compact_output(spark, out, ckpt, 2)
    assert seen() == before and _folders(out) == 2
    assert read_output(spark, out, "images").count() == 2  # the latest of the merged, the live one
    write_batch(spark.createDataFrame([_image("new", 99)], KEYED), out, "/img", "1-run", 4)
    assert [r.content for r in image_store(spark, out).collect()] == ["new"]


def test_compaction_stops_at_the_commit_log(spark, tmp_dir):
    """Batches after the last committed one are never taken for merged ones."""
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def batch(b):
        write_batch(spark.createDataFrame([_image(f"c{b}-{k}", 10 * b + k, f"i{b}-{k}") for k in range(4)], KEYED),
                    out, "/img", "1-run", b)

    _committed(spark, ckpt, "1-run", 2)
    for b in range(3):
        batch(b)
    with pytest.raises(ValueError, match="not committed"):
        compact_output(spark, out, ckpt, 5)
    batch(3)                                             # written, not committed: a replay may follow
    assert compact_output(spark, out, ckpt) == 2
    assert image_store(spark, out).count() == 16
    batch(3)
    _committed(spark, ckpt, "1-run", 3)
    assert image_store(spark, out).count() == 16
    assert compact_output(spark, out, ckpt) == 3 and compact_output(spark, out, ckpt, 1) == 3
    batch(4)
    assert image_store(spark, out).count() == 20
    assert compact_output(spark, out, f"{tmp_dir}/none") is None
    with pytest.raises(ValueError, match="not committed"):
        compact_output(spark, out, f"{tmp_dir}/none", 0)


def test_compaction_beside_a_real_consumer(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    for b in range(4):
        spark.createDataFrame([_image(f"c{b}", b, f"i{b}")], KEYED).coalesce(1).write.mode("append").json(src)
        consume_messages(spark.readStream.schema(KEYED).json(src), out, ckpt, "/img", available_now=True)
        if b % 2:
            assert compact_output(spark, out, ckpt) == b
        assert image_store(spark, out).count() == b + 1


def test_one_alert_for_a_message_delivered_twice(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    first = [("VIOLATION_MESSAGE", VIO, 0, 1), ("VIOLATION_MESSAGE", VIO, 0, 2), ("OTHER", "{}", 0, 3)]
    again = [("VIOLATION_MESSAGE", VIO, 0, 2), ("VIOLATION_MESSAGE", VIO, 1, 2), ("OTHER", "{}", 0, 3), _image("c", 4)]
    runs = []
    for rows in (first, again, again):                   # each run a batch, and state across restarts
        spark.createDataFrame(rows + rows[:1], KEYED).coalesce(1).write.mode("append").json(src)
        stream = spark.readStream.schema(KEYED).json(src)
        consume_messages(stream, out, ckpt, "/img", available_now=True, redelivery="1 hour",
                         on_alerts=lambda df, _: runs.append(df.count()))
    assert read_output(spark, out, "alerts").count() == 3 and sum(runs) == 3
    assert read_output(spark, out, "rejects").count() == 1 and image_store(spark, out).count() == 1


def test_unreadable_output_is_an_error_not_an_empty_table(spark, tmp_dir):
    import pytest
    out = f"{tmp_dir}/out"
    os.makedirs(f"{out}/messages/run_id=1/batch_id=0/kind=image")
    _write(f"{out}/messages/run_id=1/batch_id=0/kind=image/part-0.parquet", ["not parquet"])
    with pytest.raises(Exception, match="not a Parquet file"):
        read_output(spark, out, "images").collect()
    with pytest.raises(Exception, match="(?i)no_such_format|not found|find"):
        read_output(spark, out, "images", fmt="no_such_format")


def test_alert_hook_sees_each_batch_after_the_write(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    seen = []

    def hook(df, batch_id):
        assert read_output(spark, out, "alerts").count() >= 1   # already stored
        seen.append((batch_id, [r.subject for r in df.collect()]))

    batch = spark.createDataFrame([("VIOLATION_MESSAGE", VIO, 0, 1)], KEYED)
    write_batch(batch, out, "/img", "run", 3, on_alerts=hook)
    assert seen == [(3, ["Violation Alert"])]


def test_outputs_read_empty_before_any_row(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    batch = spark.createDataFrame([("STANDARD_MESSAGE", STD, 0, 1)], KEYED)
    write_batch(batch, out, "/img", "run", 0)
    assert read_output(spark, out, "images").count() == 0
    assert read_output(spark, out, "standard").count() == 1
    assert read_output(spark, f"{tmp_dir}/never", "alerts").columns == ["subject", "body"]
    assert image_store(spark, out).count() == 0


def test_standing_historic_load_picks_up_new_files(spark, tmp_dir):
    src, lake, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    os.makedirs(src)
    _write(f"{src}/a.csv", [_line(1)])
    q = load_historic(spark, src, lake, ckpt, processing_time="1 second")
    try:
        q.processAllAvailable()
        _write(f"{src}/b.csv", [_line(2), _line(3)])
        q.processAllAvailable()
        assert read_lake(spark, lake).count() == 3
    finally:
        q.stop()


def test_failed_batch_retried_leaves_no_duplicates(spark, tmp_dir):
    import pytest
    out = f"{tmp_dir}/out"
    batch = spark.createDataFrame([("STANDARD_MESSAGE", STD, 0, 1),
                                   ("VIOLATION_MESSAGE", VIO, 0, 2)], KEYED)

    def boom(df, batch_id):
        raise RuntimeError("delivery down")

    with pytest.raises(RuntimeError):
        write_batch(batch, out, "/img", "run", 4, on_alerts=boom)   # fails after the writes
    write_batch(batch, out, "/img", "run", 4)                         # the engine's retry
    assert read_output(spark, out, "standard").count() == 1
    assert read_output(spark, out, "alerts").count() == 1


def test_batches_and_compactions_are_not_sorted_by_kind(spark, tmp_dir, monkeypatch):
    """A task holds open files, not all its rows: the plans that write the kinds have no sort by kind."""
    from pyspark.sql import DataFrameWriter
    from patrolspark.catalog import keyed_messages
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen, real = spark.conf.get(key, None), [], DataFrameWriter.save

    def save(self, path=None, *a, **k):
        if "/messages" in path or "/compacted" in path:
            seen.append((os.path.basename(path), int(self._df.sparkSession.conf.get(key))))
        return real(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "save", save)
    src, out, ckpt = (f"{tmp_dir}/{n}" for n in ("src", "out", "ckpt"))
    keyed_messages(spark, "/root/testdata/sf0.001").coalesce(1).write.json(src)
    stream = spark.readStream.schema(KEYED).json(src)
    consume_messages(stream, out, ckpt, "/images", available_now=True)
    want = sorted(map(tuple, image_store(spark, out).collect()))
    counts = {t: read_output(spark, out, t).count() for t in ("standard", "violation", "rejects")}
    compact_output(spark, out, ckpt)
    assert [n for n, _ in seen] == ["messages", "compacted"]
    assert all(files >= 4 for _, files in seen)  # one a kind
    assert sorted(map(tuple, image_store(spark, out).collect())) == want and want
    assert {t: read_output(spark, out, t).count() for t in counts} == counts and all(counts.values())
    assert spark.conf.get(key, None) == before
