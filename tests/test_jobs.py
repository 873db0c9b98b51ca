import os

from patrolspark.operators.bands import in_period, in_season
from patrolspark.operators.cache import cached
from patrolspark.plans.jobs import analyse_lake
from patrolspark.streaming.load import load_historic
from fixtures import FIXTURE_G, violations_df


def test_band_filters(spark):
    g = violations_df(spark, FIXTURE_G)
    assert in_season(g, "winter").count() == 5
    assert in_period(g, "night").count() == 6
    assert in_season(g, "autumn").select("season").distinct().first()[0] == "autumn"


def test_cached_releases(spark):
    df = spark.range(5)
    with cached(df) as c:
        assert c.is_cached
    assert not df.is_cached


def test_analyse_csv_lake_end_to_end(spark, tmp_dir):
    src, lake, out = f"{tmp_dir}/src", f"{tmp_dir}/lake", f"{tmp_dir}/out"
    os.makedirs(src)
    header = ",".join(["Summons"] * 4 + ["Issue Date", "Violation Code"] + ["h"] * 13 +
                      ["Violation Time", "h"])
    lines = [header]
    for i, (d, c, code) in enumerate([("01/05/2020", "0100A", "21"), ("01/06/2020", "0900P", "21"),
                                      ("07/01/2020", "1000A", "14"), ("12/25/2019", "1100P", "")]):
        lines.append(",".join([str(i), "p", '"x, y"', "NY", d, code] + ["f"] * 13 + [c, "z"]))
    with open(f"{src}/v.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    load_historic(spark, src, lake, f"{tmp_dir}/ckpt", fmt="csv")
    res = analyse_lake(spark, lake, out, lake_format="csv")
    q1 = {r.season: (r.number_of_violations, r.percent) for r in res["season_share"]}
    assert q1 == {"winter": (2, 200 / 3), "summer": (1, 100 / 3)}
    assert [(r.violation_code, r.number_of_violations) for r in res["top5_codes"]] == \
        [("21", 2), ("14", 1), (None, 0)]
    q3 = {r.period: r.number_of_violations for r in res["period_share"]}
    assert q3 == {"night": 2, "day": 1}
    for k in ("season_share", "top5_codes", "period_share", "top_code_per_season"):
        assert len([p for p in os.listdir(f"{out}/{k}") if p.startswith("part-")]) == 1


def test_cli_load_migrate_analyse(spark, tmp_dir, capsys):
    import json
    from patrolspark.__main__ import main
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    line = ",".join(["0", "p", '"x, y"', "NY", "01/05/2020", "21"] + ["f"] * 13 + ["0100A", "z"])
    with open(f"{src}/v.csv", "w") as f:
        f.write(line + "\n")
    main(["load", "--src", src, "--lake", f"{tmp_dir}/csvlake", "--checkpoint",
          f"{tmp_dir}/ck", "--lake-format", "csv"])
    main(["migrate", "--csv-lake", f"{tmp_dir}/csvlake", "--parquet-lake", f"{tmp_dir}/pq"])
    capsys.readouterr()
    main(["analyse", "--lake", f"{tmp_dir}/pq", "--out", f"{tmp_dir}/out"])
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["top5_codes"] == [{"violation_code": "21", "number_of_violations": 1,
                                  "percent": 100.0}]
    assert res["season_share"] == [{"season": "winter", "number_of_violations": 1,
                                    "percent": 100.0}]


def test_cli_consume_and_save_once(spark, tmp_dir):
    from patrolspark.__main__ import main
    from patrolspark.schemas import KEYED
    from patrolspark.streaming.consume import read_output
    src = f"{tmp_dir}/msgs"
    rows = [("STANDARD_MESSAGE", '{"lat":1,"lng":2,"sending_date":3,"drone_id":"d"}', 0, 1),
            ("VIOLATION_MESSAGE", '{"violation_code":"21"}', 0, 2),
            ("VIOLATION_IMAGE", '{"image_id":"i","content":"c"}', 0, 3)]
    spark.createDataFrame(rows, KEYED).write.json(src)
    main(["consume", "--src-dir", src, "--out", f"{tmp_dir}/out", "--checkpoint",
          f"{tmp_dir}/ck1", "--image-dir", "/img", "--once", "--max-per-trigger", "10"])
    assert [r.body.splitlines()[1] for r in read_output(spark, f"{tmp_dir}/out", "alerts")
            .collect()] == ["Violation Code: 21"]
    main(["save", "--src-dir", src, "--out", f"{tmp_dir}/lake", "--checkpoint",
          f"{tmp_dir}/ck2", "--once"])
    # The saver reads a topic of violations only and decodes every record as one:
    # all three are objects whose known fields have the right types (extra
    # fields are ignored), so all three are stored.
    from patrolspark.plans.jobs import read_lake
    assert read_lake(spark, f"{tmp_dir}/lake").count() == 3


def test_lake_scan_pushes_filter_and_reads_two_columns(spark, tmp_dir):
    from patrolspark.plans import analyses as A
    from patrolspark.plans.jobs import read_lake
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    line = ",".join(["0", "p", '"x, y"', "NY", "01/05/2020", "21"] + ["f"] * 13 + ["0100A", "z"])
    with open(f"{src}/v.csv", "w") as f:
        f.write(line + "\n")
    load_historic(spark, src, f"{tmp_dir}/lake", f"{tmp_dir}/ck")
    cube = A.violation_cube(read_lake(spark, f"{tmp_dir}/lake"))
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(sending_date)]" in plan
    assert "ReadSchema: struct<sending_date:timestamp,violation_code:string>" in plan
    assert cube.collect()[0].number_of_violations == 1


def test_cli_upkeep(spark, tmp_dir, capsys):
    """load with cube and ledger, grown, compact, backfill and analyse from the cube."""
    import os

    from patrolspark.__main__ import main
    from patrolspark.plans.jobs import read_answers, read_lake
    d = {n: f"{tmp_dir}/{n}" for n in ("src", "lake", "ckpt", "cube", "ledger", "out")}
    os.makedirs(d["src"])
    line = ",".join(["1", "p", "x", "NY", "05/04/2016", "21"] + ["x"] * 13 + ["0143P", "z"]) + "\n"
    keep = ["--lake", d["lake"], "--cube", d["cube"]]
    load = ["load", "--src", d["src"], "--checkpoint", d["ckpt"], "--ledger", d["ledger"], *keep]
    for k in range(3):
        with open(f"{d['src']}/{k}.csv", "w") as f:
            f.write(line * (k + 1))
        main(load)
    with open(f"{d['src']}/0.csv", "a") as f:
        f.write(line)
    t = os.stat(f"{d['src']}/0.csv").st_mtime + 10
    os.utime(f"{d['src']}/0.csv", (t, t))
    main(["grown", "--src", d["src"], "--checkpoint", d["ckpt"], "--ledger", d["ledger"], *keep])
    main(["compact", *keep, "--remove"])
    main(["backfill", *keep])
    assert read_lake(spark, d["lake"]).count() == 7
    main(["analyse", *keep, "--out", d["out"], "--together"])
    assert [tuple(r) for r in read_answers(spark, d["out"])["top5_codes"].collect()] == [("21", 7, 100.0)]
    assert capsys.readouterr().out.split("\n")[:3] == ["1", "1", "0"]
