"""Benchmark: headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Prints one JSON line.  Each query runs to completion through the ``noop``
sink (full execution, nothing collected to the driver).  Every query runs
four times: the first (cold) run pays for plan compilation and JIT warm-up;
the median of the three warm runs is reported per query and summed into
``value``; the cold total is reported too.  Streaming queries write fresh folders on each run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from patrolspark.catalog import QUERIES
    from patrolspark.plans import analyses as A
    from patrolspark.derived import all_rows, season_rows
    from patrolspark.session import get_session

    spark = get_session(f"local[{cpus}]", app_name="patrolspark-bench",
                        conf={"spark.sql.shuffle.partitions": str(int(cpus) * 2),
                              "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["top5_codes"](spark, sf_dir))  # warm-up

    times: dict[str, float] = {}
    cold: dict[str, float] = {}

    def timed(name, fn):
        runs = []
        for _ in range(4):
            t0 = time.perf_counter()
            fn()
            runs.append(round(time.perf_counter() - t0, 3))
        cold[name], times[name] = runs[0], statistics.median(runs[1:])

    headline = {"q1": "season_share", "q2": "top5_codes", "q3": "period_share",
                "q4": "top_code_per_season"}
    for short, key in headline.items():
        timed(short, lambda k=key: run(QUERIES[k](spark, sf_dir)))

    def four_separate():
        rows = all_rows(spark, sf_dir)
        for f in (A.season_share, A.top_codes, A.period_share, A.top_code_per_season):
            run(f(rows))

    def cube_path():
        results, cube = A.run_all(all_rows(spark, sf_dir))
        try:
            cube.count()
            A.run_concurrently(results, lambda _, df: run(df))
        finally:
            cube.unpersist()

    def lineitem_three_times():
        """About 1.7 million rows, the analysed system's stated data set size (sf0.1)."""
        rows = season_rows(spark, sf_dir)
        results, cube = A.run_all(rows.unionAll(rows).unionAll(rows))
        try:
            cube.count()
            A.run_concurrently(results, lambda _, df: run(df))
        finally:
            cube.unpersist()

    from patrolspark.operators.conform import conform, to_violation
    from patrolspark.derived import raw_lines
    from patrolspark.session import scratch_path
    from patrolspark.sources.raw import raw_files
    from patrolspark.streaming.cube import backfill_cube, read_cube

    # Written once, not timed: a lake with partial cubes, and raw files.
    lake, cube_dir, raw = (scratch_path(spark, n) for n in ("bench_lake", "bench_cube", "bench_raw"))
    nothing = [f"cast(null as {t}) as {n}" for n, t in (("lat", "double"), ("lng", "double"))]
    conform(all_rows(spark, sf_dir).selectExpr(*nothing, "sending_date", "cast(null as string) as drone_id", "violation_code")) \
        .write.parquet(lake)
    backfill_cube(spark, lake, cube_dir)
    raw_lines(spark, sf_dir).write.text(raw)

    def four_from_partials():
        results, cube = A.answers_from(read_cube(spark, cube_dir))
        try:
            cube.count()
            A.run_concurrently(results, lambda _, df: run(df))
        finally:
            cube.unpersist()

    timed("q1_q4_from_partial_cubes", four_from_partials)
    timed("parse_raw_files_alone", lambda: run(to_violation(raw_files(spark, raw, suffix="txt"))))
    timed("q1_q4_separate_all_rows", four_separate)
    timed("q1_q4_lineitem_three_times", lineitem_three_times)
    timed("q5_cube_all_rows", cube_path)
    for key in ("parse_raw_records", "decode_standard", "reject_records", "alert_text",
                "latest_images", "violation_cube", "conform_positional"):
        timed(key, lambda k=key: run(QUERIES[k](spark, sf_dir)))
    for key in ("streaming_load_totals", "stream_route_counts"):
        timed(key, lambda k=key: run(QUERIES[k](spark, sf_dir)))

    # Input sizes (Parquet footers, no scan) for throughput figures.
    n_li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    n_ev = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    rows = {"q1": n_li, "q2": n_li, "q3": n_ev, "q4": n_li,
            "q1_q4_lineitem_three_times": 3 * n_li, "q1_q4_separate_all_rows": n_li + n_ev, "q5_cube_all_rows": n_li + n_ev}
    throughput = {k: round(n / times[k]) for k, n in rows.items() if times.get(k)}

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus),
                      "cold_total": round(sum(cold.values()), 3), "cold": cold,
                      "input_rows": rows, "rows_per_sec": throughput}))
    spark.stop()


if __name__ == "__main__":
    main()
