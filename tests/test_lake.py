"""Lake compaction, incremental cube, grown files, load accounting, late image contents."""

import os

import pytest
from pyspark.sql import functions as F

from patrolspark.operators.conform import line_class
from patrolspark.operators.images import latest_images
from patrolspark.plans.analyses import violation_cube
from patrolspark.schemas import VIOLATION
from patrolspark.sources import lake as L
from patrolspark.sources.lake import closed_files, compact_lake, lake_files, pack, read_lake, remove_replaced
from patrolspark.sources.raw import numbered_lines, raw_files
from patrolspark.sources.tables import write_table
from patrolspark.streaming import cube as C
from patrolspark.streaming import ledger
from patrolspark.streaming.idempotent import run_id, write_batch_table
from patrolspark.streaming.ledger import load_grown, read_ledger
from patrolspark.streaming.load import load_historic, read_metrics


def line(i, code="21", date="05/04/2016", clock="0143P"):
    return ",".join([str(i), "p", '"A, B"', "NY", date, code] + ["x"] * 13 + [clock, "z"])


def write(path, lines, mode="w"):
    with open(path, mode) as f:
        f.write("".join(x + "\n" for x in lines))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def later(path, by=10):
    t = os.stat(path).st_mtime + by
    os.utime(path, (t, t))


@pytest.fixture()
def dirs(tmp_dir):
    os.makedirs(f"{tmp_dir}/src")
    return {n: f"{tmp_dir}/{n}" for n in ("src", "lake", "ckpt", "cube", "ledger")}


def load(spark, d, fmt="parquet", **kw):
    load_historic(spark, d["src"], d["lake"], d["ckpt"], fmt, max_files_per_trigger=1, **kw)


def many_batches(spark, d, n=6, fmt="parquet", **kw):
    for i in range(n):
        write(f"{d['src']}/f{i}.csv", [line(k, str(k % 3)) for k in range(i, 4 * i + 3)])
        later(f"{d['src']}/f{i}.csv", i)
    load(spark, d, fmt, **kw)                                            # a file a batch, oldest first


# -- compaction ----------------------------------------------------------------

def test_pack_fills_bins():
    sizes = [(f"f{k}", s) for k, s in enumerate([60, 50, 40, 30, 20, 10, 90, 5])]
    bins = pack(sizes, 100)
    size = dict(sizes)
    assert sorted(p for b in bins for p in b) == sorted(size)[:-1]       # the last one would be merged with none
    assert all(sum(size[p] for p in b) == 100 for b in bins) and len(bins) == 3
    assert pack([("a", 1)], 10) == [] and pack([], 10) == []


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_compaction_keeps_rows_and_merges_files(spark, dirs, fmt):
    many_batches(spark, dirs, fmt=fmt)
    write_table(spark.createDataFrame([(1.0, 2.0, None, "d", "x, \"y\"", None)], VIOLATION), dirs["lake"], fmt)
    before, files = rows(read_lake(spark, dirs["lake"], fmt)), lake_files(spark, dirs["lake"]).count()
    assert compact_lake(spark, dirs["lake"], fmt) == 1
    assert rows(read_lake(spark, dirs["lake"], fmt)) == before           # merged files still there, left out
    assert remove_replaced(spark, dirs["lake"]) > 3
    assert rows(read_lake(spark, dirs["lake"], fmt)) == before
    # the newest batch of the run, still open to a replay, and one merged file
    assert lake_files(spark, dirs["lake"]).count() == 2 < files
    assert compact_lake(spark, dirs["lake"], fmt) == 0 and remove_replaced(spark, dirs["lake"]) == 0
    write(f"{dirs['src']}/late.csv", [line(1), line(2)])                 # writers go on, and so do compactions
    load(spark, dirs, fmt)
    after = rows(read_lake(spark, dirs["lake"], fmt))
    assert len(after) == len(before) + 2
    assert compact_lake(spark, dirs["lake"], fmt, remove=True) == 1
    assert rows(read_lake(spark, dirs["lake"], fmt)) == after and lake_files(spark, dirs["lake"]).count() == 2


def test_open_batch_is_never_touched(spark, dirs):
    """A replay of the newest batch after a compaction leaves its rows once."""
    many_batches(spark, dirs, 3)
    rid = run_id(spark, dirs["ckpt"])
    assert {r.batch_id for r in closed_files(lake_files(spark, dirs["lake"])).collect()} == {0, 1}
    before = rows(read_lake(spark, dirs["lake"]))
    again = spark.createDataFrame(read_lake(spark, f"{dirs['lake']}/run_id={rid}/batch_id=2").collect(), VIOLATION)
    compact_lake(spark, dirs["lake"], remove=True)
    write_batch_table(again, dirs["lake"], rid, 2)
    assert rows(read_lake(spark, dirs["lake"])) == before


def test_crash_before_and_after_the_switch(spark, dirs, monkeypatch):
    many_batches(spark, dirs, 4)
    before = rows(read_lake(spark, dirs["lake"]))

    def crash(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:                                     # data written, no switch record
        m.setattr(L, "_switch", crash)
        with pytest.raises(RuntimeError):
            compact_lake(spark, dirs["lake"])
    assert rows(read_lake(spark, dirs["lake"])) == before and L.generations(spark, dirs["lake"]) == []
    with monkeypatch.context() as m:                                     # switched, nothing deleted
        m.setattr(L, "remove_replaced", crash)
        with pytest.raises(RuntimeError):
            compact_lake(spark, dirs["lake"], remove=True)
    assert rows(read_lake(spark, dirs["lake"])) == before and len(L.generations(spark, dirs["lake"])) == 1
    with monkeypatch.context() as m:                                     # some files deleted
        m.setattr(L, "create_once", crash)
        with pytest.raises(RuntimeError):
            remove_replaced(spark, dirs["lake"])
    assert rows(read_lake(spark, dirs["lake"])) == before
    remove_replaced(spark, dirs["lake"])
    assert rows(read_lake(spark, dirs["lake"])) == before


def test_of_two_compactions_one_wins(spark, dirs):
    many_batches(spark, dirs, 3)
    compact_lake(spark, dirs["lake"])
    with pytest.raises(Exception, match="exist"):
        L._switch(spark, dirs["lake"], 1, "another")
    assert len(L.generations(spark, dirs["lake"])) == 1


def test_generations_are_bounded(spark, dirs):
    many_batches(spark, dirs, 6)
    before = rows(read_lake(spark, dirs["lake"]))
    assert compact_lake(spark, dirs["lake"], files_at_once=2, remove=True) >= 2
    assert rows(read_lake(spark, dirs["lake"])) == before


def test_steady_reads_carry_no_join(spark, dirs):
    many_batches(spark, dirs, 3)
    compact_lake(spark, dirs["lake"])
    plan = read_lake(spark, dirs["lake"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan
    remove_replaced(spark, dirs["lake"])
    plan = read_lake(spark, dirs["lake"]).where("sending_date is not null")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "PushedFilters: [IsNotNull(sending_date)]" in plan


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_merging_into_several_files(spark, tmp_dir, fmt):
    """Rows of every bin are read and counted once, and each bin is one file."""
    lake = f"{tmp_dir}/the lake é"
    for k in range(6):
        part = spark.range(k * 100, k * 100 + 100).selectExpr(
            "cast(id as double) as lat", "cast(id as double) as lng", "cast(null as timestamp) as sending_date",
            "cast(id as string) as drone_id", "'c' as violation_code", "cast(null as string) as image_id")
        write_table(part.coalesce(1), lake, fmt)
    before = rows(read_lake(spark, lake, fmt))
    largest = max(r.length for r in lake_files(spark, lake).collect())
    assert compact_lake(spark, lake, fmt, target_bytes=int(2.5 * largest)) == 1
    assert rows(read_lake(spark, lake, fmt)) == before                   # merged files still there, left out
    merged = [r for r in lake_files(spark, lake).collect() if f"/{L.PACKED}/data/" in r.path]
    assert len(merged) == 3 and lake_files(spark, lake).count() == 3
    remove_replaced(spark, lake)
    assert rows(read_lake(spark, lake, fmt)) == before


def test_paths_are_decoded_once_a_file(spark, dirs):
    """The lake's own side of the join that leaves merged files out takes file names as its rows have them."""
    many_batches(spark, dirs, 3)
    compact_lake(spark, dirs["lake"])
    todo, left = [read_lake(spark, dirs["lake"])._jdf.queryExecution().optimizedPlan()], []
    while todo:
        node = todo.pop()
        if node.nodeName() == "Join" and "LeftAnti" in node.simpleString(1000):
            left.append(node.left().toString())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    assert len(left) == 1 and "Relation" in left[0] and "regexp_replace" not in left[0]


# -- incremental cube --------------------------------------------------------------

def test_cube_follows_loads_and_replays(spark, dirs):
    many_batches(spark, dirs, 3, cube_path=dirs["cube"])
    want = rows(violation_cube(read_lake(spark, dirs["lake"])))
    assert rows(C.read_cube(spark, dirs["cube"])) == want
    rid = run_id(spark, dirs["ckpt"])
    C.add_batch(spark, dirs["lake"], dirs["cube"], rid, 1)               # a replay
    assert rows(C.read_cube(spark, dirs["cube"])) == want
    load(spark, dirs, cube_path=dirs["cube"])                            # nothing new
    assert C.uncounted(spark, dirs["lake"], dirs["cube"]).count() == 0
    assert rows(C.read_cube(spark, dirs["cube"])) == want


def test_extra_batch_reads_only_its_own_rows(spark, dirs):
    many_batches(spark, dirs, 3)
    rid = run_id(spark, dirs["ckpt"])
    partial = C.batch_partial(spark, dirs["lake"], rid, 2)
    assert partial.inputFiles() and all(f"run_id={rid}/batch_id=2/" in f for f in partial.inputFiles())
    plan = partial._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<sending_date:timestamp,violation_code:string>" in plan


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_backfill_counts_what_has_no_partial(spark, dirs, fmt):
    many_batches(spark, dirs, 3, fmt)                                    # before there was a cube
    write(f"{dirs['src']}/g.csv", [line(9)])
    load(spark, dirs, fmt, cube_path=dirs["cube"])
    one = spark.createDataFrame([(None, None, None, None, "p", None)], VIOLATION)
    write_table(one.coalesce(1), dirs["lake"], fmt)
    write_table(one.limit(0).coalesce(1), dirs["lake"], fmt)             # a file without rows, if the format writes one
    more = lake_files(spark, dirs["lake"]).count() - 5
    assert C.backfill_cube(spark, dirs["lake"], dirs["cube"], fmt, units_at_once=2) == 4 + more
    want = rows(violation_cube(read_lake(spark, dirs["lake"], fmt)))
    assert rows(C.read_cube(spark, dirs["cube"])) == want
    assert C.backfill_cube(spark, dirs["lake"], dirs["cube"], fmt) == 0
    compact_lake(spark, dirs["lake"], fmt, remove=True)                  # merged rows were counted before
    assert C.backfill_cube(spark, dirs["lake"], dirs["cube"], fmt) == 0
    assert rows(C.read_cube(spark, dirs["cube"])) == want


def test_cube_over_merged_files(spark, dirs):
    many_batches(spark, dirs, 4)
    compact_lake(spark, dirs["lake"], remove=True)
    assert C.backfill_cube(spark, dirs["lake"], dirs["cube"]) == 1       # the generation; the open batch is its writer's
    rid = run_id(spark, dirs["ckpt"])
    C.add_batch(spark, dirs["lake"], dirs["cube"], rid, 3)
    assert rows(C.read_cube(spark, dirs["cube"])) == rows(violation_cube(read_lake(spark, dirs["lake"])))
    C.add_batch(spark, dirs["lake"], f"{dirs['cube']}2", rid, 3)
    write(f"{dirs['src']}/h.csv", [line(9)])
    load(spark, dirs)
    compact_lake(spark, dirs["lake"], remove=True)                       # merges a counted and an uncounted batch
    with pytest.raises(ValueError):
        C.backfill_cube(spark, dirs["lake"], f"{dirs['cube']}2")


def test_empty_batches_and_cubes(spark, dirs):
    assert C.read_cube(spark, dirs["cube"]).collect() == []
    write(f"{dirs['src']}/empty.csv", [])
    load(spark, dirs, cube_path=dirs["cube"], ledger_path=dirs["ledger"])
    assert C.read_cube(spark, dirs["cube"]).collect() == []


# -- lines added to a known file -----------------------------------------------------

@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_lines_added_later(spark, dirs, fmt):
    d = dirs
    kw = {"cube_path": d["cube"], "ledger_path": d["ledger"]}
    write(f"{d['src']}/a b.csv", [line(k) for k in range(5)])
    write(f"{d['src']}/still.csv", [line(k) for k in range(4)])
    load(spark, d, fmt, **kw)
    assert load_grown(spark, d["src"], d["lake"], d["ckpt"], d["ledger"], fmt, cube_path=d["cube"]) == 0
    write(f"{d['src']}/a b.csv", [line(k, "new") for k in range(3)], "a")
    later(f"{d['src']}/a b.csv")
    load(spark, d, fmt, **kw)
    assert read_lake(spark, d["lake"], fmt).count() == 9
    for want in (3, 0):                                                  # a rerun adds none
        assert load_grown(spark, d["src"], d["lake"], d["ckpt"], d["ledger"], fmt, cube_path=d["cube"]) == want
        assert read_lake(spark, d["lake"], fmt).count() == 12
        assert read_lake(spark, d["lake"], fmt).where("violation_code = 'new'").count() == 3
    write(f"{d['src']}/a b.csv", [line(0, "more")], "a")                  # and again
    later(f"{d['src']}/a b.csv", 20)
    assert load_grown(spark, d["src"], d["lake"], d["ckpt"], d["ledger"], fmt, cube_path=d["cube"]) == 1
    assert rows(C.read_cube(spark, d["cube"])) == rows(violation_cube(read_lake(spark, d["lake"], fmt)))
    assert read_ledger(spark, d["ledger"]).agg(F.sum("lines")).first()[0] == 13


def test_grown_load_stopped_before_its_rows(spark, dirs, monkeypatch):
    d = dirs
    write(f"{d['src']}/a.csv", [line(k) for k in range(5)])
    load(spark, d, ledger_path=d["ledger"])
    write(f"{d['src']}/a.csv", [line(k, "new") for k in range(3)], "a")
    later(f"{d['src']}/a.csv")
    real = ledger.create_once

    def crash(*_):
        raise RuntimeError("stopped")

    for name in ("_add", "create_once"):                                 # before the lake rows, and after them
        with monkeypatch.context() as m:
            m.setattr(ledger, name, crash)
            with pytest.raises(RuntimeError):
                load_grown(spark, d["src"], d["lake"], d["ckpt"], d["ledger"])
        write(f"{d['src']}/a.csv", [line(9, "late")], "a")
        later(f"{d['src']}/a.csv", 20)
    assert ledger.create_once is real
    load_grown(spark, d["src"], d["lake"], d["ckpt"], d["ledger"])
    assert read_lake(spark, d["lake"]).groupBy("violation_code").count().collect() and \
        {r[0]: r[1] for r in read_lake(spark, d["lake"]).groupBy("violation_code").count().collect()} == {"21": 5, "new": 3, "late": 2}


def test_shorter_and_unknown_files_add_nothing(spark, dirs):
    d = dirs
    write(f"{d['src']}/a.csv", [line(k) for k in range(5)])
    load(spark, d)                                                       # no ledger
    write(f"{d['src']}/b.csv", [line(k) for k in range(5)])
    load(spark, d, ledger_path=d["ledger"])
    for n in "ab":
        write(f"{d['src']}/{n}.csv", [line(k) for k in range(6 if n == "a" else 2)])
        later(f"{d['src']}/{n}.csv")
    assert load_grown(spark, d["src"], d["lake"], d["ckpt"], d["ledger"]) == 0
    assert read_lake(spark, d["lake"]).count() == 10


def test_line_numbers_over_blocks(spark, tmp_dir):
    for n in range(3):
        write(f"{tmp_dir}/f{n}.txt", [f"{n}-{k}" for k in range(2000 * n + 7)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = numbered_lines(spark, [f"{tmp_dir}/f{n}.txt" for n in range(3)], f"{tmp_dir}/store").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.path[-5], r.line, r.value) for r in got) == sorted(
        (str(n), k, f"{n}-{k}") for n in range(3) for k in range(2000 * n + 7))


# -- load accounting -----------------------------------------------------------------

LINES = [("Summons Number,Plate,A,State,Issue Date,Code," + ",".join(["x"] * 13) + ",Violation Time,z", "header"),
         (line(1), "dated"), (line(2, date="13/45/2016"), "dated"), ("1,2,3", "short"), ("", "short"),
         (line(3, date="05/04/99999"), "out_of_range"), (line(4, date="0/0/0"), "out_of_range"),
         (line(5, clock="late"), "undated"), (line(6, date=""), "undated"), (line(7, date="2016-05-04"), "undated")]


def test_each_line_has_one_class(spark, dirs):
    write(f"{dirs['src']}/a.csv", [t for t, _ in LINES])
    got = [r[0] for r in raw_files(spark, dirs["src"]).select(line_class()).collect()]
    assert got == [c for _, c in LINES]


def test_load_metrics_add_up(spark, dirs):
    write(f"{dirs['src']}/a.csv", [t for t, _ in LINES])
    load(spark, dirs)
    write(f"{dirs['src']}/b.csv", [line(k) for k in range(4)])
    load(spark, dirs)
    load(spark, dirs)
    got = {r.batch_id: r for r in read_metrics(spark, dirs["lake"] + "_metrics").collect()}
    assert tuple(got[0])[:6] == (10, 2, 2, 1, 2, 3) and tuple(got[1])[:6] == (4, 4, 0, 0, 0, 0)
    assert sum(r.lines for r in got.values()) == read_lake(spark, dirs["lake"]).count()
    assert sum(r.dated for r in got.values()) == read_lake(spark, dirs["lake"]).where("sending_date is not null").count()


# -- latest images -------------------------------------------------------------------

def test_no_content_in_the_first_exchange(spark, tmp_dir):
    schema = "image_id string, content string, partition int, offset long"
    spark.createDataFrame([("a", "x" * 50, 0, k) for k in range(20)] + [("b", None, 0, 30)], schema).write.parquet(f"{tmp_dir}/i")
    images = spark.read.parquet(f"{tmp_dir}/i")
    out = latest_images(images)
    assert rows(out) == [("a", "x" * 50), ("b", None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.index("partial_max(struct(partition"):]              # the reduction, down to its scan
    assert "content" not in first[:first.index("Batched")] and "content" in plan and "max_by" not in plan


def test_one_message_twice_is_one_image(spark):
    df = spark.createDataFrame([("a", "x", 0, 1), ("a", "x", 0, 1), ("a", "y", 0, 0)], "image_id string, content string, partition int, offset long")
    assert rows(latest_images(df)) == [("a", "x")]


# -- answers published together ------------------------------------------------------

def test_a_set_is_read_whole(spark, tmp_dir):
    from patrolspark.sources.publish import current, publish, read_published

    def frames(v):
        return {n: spark.createDataFrame([(f"{n}{v}",)], "x string") for n in "abcd"}

    out, schemas = f"{tmp_dir}/out", {n: "x string" for n in "abcd"}

    def seen():
        return {n: df.first()[0] for n, df in read_published(spark, out, schemas).items()}

    with pytest.raises(ValueError):
        read_published(spark, out, schemas)
    publish(spark, out, frames(1))
    assert seen() == {n: f"{n}1" for n in "abcd"}

    def stops(results, action):
        for k, (name, df) in enumerate(results.items()):
            if k == 2:
                raise RuntimeError("stopped")
            action(name, df)

    with pytest.raises(RuntimeError):
        publish(spark, out, frames(2), each=stops)
    assert seen() == {n: f"{n}1" for n in "abcd"}                         # the old set, whole
    old = read_published(spark, out, schemas)
    publish(spark, out, frames(3))
    assert seen() == {n: f"{n}3" for n in "abcd"}
    assert {n: df.first()[0] for n, df in old.items()} == {n: f"{n}1" for n in "abcd"}  # a reader of the last set goes on
    publish(spark, out, frames(4))
    assert current(spark, out)["tables"] == list("abcd") and len(os.listdir(f"{out}/versions")) == 3  # two sets, one stopped


def test_a_taken_number_is_passed_over(spark, tmp_dir, monkeypatch):
    from patrolspark.sources import publish as P
    out = f"{tmp_dir}/out"
    df = spark.createDataFrame([("x",)], "x string")
    P.publish(spark, out, {"a": df})
    real, calls = P._records, []

    def behind(spark, out):  # another run records in between
        calls.append(1)
        return [] if len(calls) == 1 else real(spark, out)

    monkeypatch.setattr(P, "_records", behind)
    version = P.publish(spark, out, {"a": df})
    assert P.current(spark, out)["version"] == version


# -- sketches, band tables, cast report -----------------------------------------------

def test_verified_top_codes(spark):
    from patrolspark.operators.metrics import count_by, share_of_total, top_k
    from patrolspark.operators.top_sketch import code_sketch, error_bound, estimated, top_codes_verified
    skewed = spark.range(20000).select(F.when(F.col("id") % 50 == 0, None).otherwise(
        F.floor(F.pow(F.col("id") / 20000, 6) * 3000).cast("string")).alias("violation_code"), (F.col("id") % 7).alias("p"))
    flat = spark.range(20000).select((F.col("id") % 5000).cast("string").alias("violation_code"), (F.col("id") % 7).alias("p"))
    few = spark.createDataFrame([("a", 0), ("a", 1), (None, 0)], "violation_code string, p long")
    for df, tracked, proven in ((skewed, 512, True), (flat, 512, False), (few, 512, False)):
        want = [r.asDict() for r in top_k(share_of_total(count_by(df, "violation_code")), 5).collect()]
        sketches = code_sketch(df, by=("p",), tracked=tracked)
        got, enough = top_codes_verified(df, sketches, 5, tracked=tracked)
        assert [r.asDict() for r in got.collect()] == want and enough is proven
    sketches = code_sketch(skewed, by=("p",), tracked=512)
    top, n = estimated(sketches, 20, 512)
    exact = {r[0]: r[1] for r in count_by(skewed, "violation_code").collect()}
    assert n == sum(exact.values()) and all(abs(exact[c] - e) <= error_bound(n, 512) for c, e in top)


def test_band_table(spark):
    from patrolspark.functions.band_table import BandTable
    from patrolspark.functions.bands import PERIOD_TABLE, SEASON_TABLE
    tables = [([("w", 90, 10), ("a", 10, 50), ("b", 40, 60)], range(0, 100)), ([("all", 5, 5)], range(0, 12)),
              ([("x", 3, 4)], range(0, 9)), ([(f"n{k}", 7 * k % 50, 11 * k % 50 + 1) for k in range(9)], range(0, 60))]
    for bands, xs in tables:
        t = BandTable.of(bands)
        df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x int")
        for x, labels, label, index in df.select("x", t.labels("x"), t.label("x"), t.index("x")).collect():
            held = None if x is None else list(dict.fromkeys(
                n for n, a, b in bands if (a <= x < b if a < b else x >= a or x < b)))
            assert labels == held and label == (held[0] if held else None)
            assert index == (t.names.index(held[0]) if held else None)
    assert len(SEASON_TABLE.starts) == 4 and len(PERIOD_TABLE.starts) == 2
    with pytest.raises(ValueError):
        BandTable.of([])


def test_cast_report(spark):
    from patrolspark.operators.conform import cast_report, conform, conform_observed
    df = spark.createDataFrame([("1.5", "x", "2016-05-04", "d"), (None, "2", "no", ""), ("", "3", None, None)], "p string, q string, r string, `s t` string")
    got = {r.field: (r.source, r.n_rows, r.nulls, r.failures) for r in cast_report(df).collect()}
    assert got == {"lat": ("p", 3, 1, 1), "lng": ("q", 3, 0, 1), "sending_date": ("r", 3, 1, 1), "drone_id": ("s t", 3, 1, 0),
                   "violation_code": (None, 3, 3, 0), "image_id": (None, 3, 3, 0)}
    out, seen = conform_observed(df)
    assert rows(out) == rows(conform(df)) and list(seen.get["failures"]) == [1, 1, 1, 0, 0, 0]
    empty = cast_report(df.limit(0)).collect()
    assert [r.failures for r in empty] == [0] * 6
    plan = cast_report(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
