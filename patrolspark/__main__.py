"""Command line: ``python -m patrolspark <job> ...``.

Jobs: ``analyse``, ``migrate``, ``load``, ``grown``, ``backfill``, ``compact``, ``publish``, ``save``,
``consume``.
Cluster settings come from the environment (``spark-defaults.conf``,
``PYSPARK_SUBMIT_ARGS``); ``session.get_session`` adds only the settings the
library's semantics rely on (UTC, AQE, dynamic partition overwrite, JSON
duplicate keys).  Under spark-submit, submit a two-line script that calls
``patrolspark.__main__.main()``.
"""

from __future__ import annotations

import argparse
import json


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="patrolspark")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("analyse", help="four analyses over the lake")
    a.add_argument("--lake", required=True)
    a.add_argument("--lake-format", default="parquet")
    a.add_argument("--out")
    a.add_argument("--result-format", default="csv")
    a.add_argument("--header", action="store_true", help="CSV results with a header line")
    a.add_argument("--cube", help="answer from the partial cubes kept here; the lake is not read")
    a.add_argument("--together", action="store_true", help="publish the four answers as one set")
    mg = sub.add_parser("migrate", help="headerless CSV lake → Parquet lake")
    mg.add_argument("--csv-lake", required=True)
    mg.add_argument("--parquet-lake", required=True)
    ld = sub.add_parser("load", help="police files → lake, each file once")
    ld.add_argument("--src", required=True)
    ld.add_argument("--lake", required=True)
    ld.add_argument("--checkpoint", required=True)
    ld.add_argument("--lake-format", default="parquet")
    ld.add_argument("--suffix", default="csv")
    ld.add_argument("--max-files-per-trigger", type=int)
    ld.add_argument("--noon", default="reference", choices=["reference", "clock"])
    ld.add_argument("--processing-time", help="keep running, e.g. '1 minute' (default: "
                                              "load what is there and stop)")
    ld.add_argument("--cube", help="keep partial cubes of the batches here")
    ld.add_argument("--ledger", help="keep the loaded lines of each file here, for the job grown")
    gr = sub.add_parser("grown", help="lines added to files after they were loaded → lake")
    for name in ("--src", "--lake", "--checkpoint", "--ledger"):
        gr.add_argument(name, required=True)
    gr.add_argument("--cube")
    gr.add_argument("--lake-format", default="parquet")
    gr.add_argument("--suffix", default="csv")
    gr.add_argument("--noon", default="reference", choices=["reference", "clock"])
    bf = sub.add_parser("backfill", help="partial cubes of lake rows that have none")
    bf.add_argument("--lake", required=True)
    bf.add_argument("--cube", required=True)
    bf.add_argument("--lake-format", default="parquet")
    cp = sub.add_parser("compact", help="merge small files of a lake, or a consumer's committed batches")
    cp.add_argument("--lake")
    cp.add_argument("--lake-format", default="parquet")
    cp.add_argument("--target-mb", type=int, default=512)
    cp.add_argument("--cube", help="count the lake's uncounted rows into this cube first")
    cp.add_argument("--out", help="folder a consumer writes to")
    cp.add_argument("--checkpoint", help="that consumer's checkpoint")
    cp.add_argument("--upto", type=int, help="last batch to merge (default: the last committed one)")
    cp.add_argument("--remove", action="store_true", help="delete merged files; only while nobody reads them")
    pb = sub.add_parser("publish", help="police files → historic topic, each file once")
    pb.add_argument("--src", required=True)
    pb.add_argument("--servers", required=True)
    pb.add_argument("--checkpoint", required=True)
    pb.add_argument("--topic")
    pb.add_argument("--suffix", default="csv")
    pb.add_argument("--max-files-per-trigger", type=int)
    pb.add_argument("--partitions", type=int, help="partitions of the topic to spread over")
    for name, helptext in (("save", "violation messages → lake"),
                           ("consume", "live messages → five tables")):
        s = sub.add_parser(name, help=helptext)
        s.add_argument("--topic")
        s.add_argument("--servers")
        s.add_argument("--src-dir")
        s.add_argument("--out", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--max-per-trigger", type=int, required=name == "consume",
                       help="messages (topic) or files (folder) a micro-batch takes")
        s.add_argument("--once", action="store_true", help="process what is there, then stop")
        if name == "consume":
            s.add_argument("--image-dir", required=True)
            s.add_argument("--redelivery", help="store a message that comes again within this time once, e.g. '1 hour'")
        else:
            s.add_argument("--rejects", help="table of undecodable messages (default: <out>_rejects)")
    args = p.parse_args(argv)

    from .session import get_session
    spark = get_session()
    if args.job == "analyse":
        from .plans.jobs import analyse_lake
        res = analyse_lake(spark, args.lake, args.out, args.lake_format, args.result_format,
                           args.header, args.cube, args.together)
        print(json.dumps({k: [r.asDict() for r in v] for k, v in res.items()}, default=str))
    elif args.job == "migrate":
        from .plans.jobs import migrate_lake
        migrate_lake(spark, args.csv_lake, args.parquet_lake)
    elif args.job == "load":
        from .streaming.load import load_historic
        q = load_historic(spark, args.src, args.lake, args.checkpoint, args.lake_format,
                          args.suffix, args.noon, args.max_files_per_trigger,
                          processing_time=args.processing_time, cube_path=args.cube, ledger_path=args.ledger)
        q.awaitTermination()
    elif args.job == "grown":
        from .streaming.ledger import load_grown
        print(load_grown(spark, args.src, args.lake, args.checkpoint, args.ledger, args.lake_format,
                         args.suffix, args.noon, args.cube))
    elif args.job == "backfill":
        from .streaming.cube import backfill_cube
        print(backfill_cube(spark, args.lake, args.cube, args.lake_format))
    elif args.job == "compact":
        if not args.lake and not (args.out and args.checkpoint):
            p.error("compact: give --lake, or --out and --checkpoint")
        if args.lake:
            from .sources.lake import compact_lake
            from .streaming.cube import backfill_cube
            if args.cube:
                backfill_cube(spark, args.lake, args.cube, args.lake_format)
            print(compact_lake(spark, args.lake, args.lake_format, args.target_mb << 20, remove=args.remove))
        else:
            from .streaming.consume import compact_output
            print(compact_output(spark, args.out, args.checkpoint, args.upto, remove=args.remove))
    elif args.job == "publish":
        from .fixed import HISTORIC_TOPIC
        from .streaming.load import publish_historic
        publish_historic(spark, args.src, args.servers, args.checkpoint,
                         args.topic or HISTORIC_TOPIC, args.suffix,
                         max_files_per_trigger=args.max_files_per_trigger,
                         partitions=args.partitions)
    else:
        from .fixed import HISTORIC_TOPIC, LIVE_TOPIC
        from .plans.jobs import message_source
        if not (args.servers or args.src_dir):
            p.error(f"{args.job}: give --servers (a topic) or --src-dir (JSON files)")
        topic = args.topic or (HISTORIC_TOPIC if args.job == "save" else LIVE_TOPIC)
        stream = message_source(spark, topic if args.servers else None, args.servers,
                                args.src_dir, args.max_per_trigger)
        if args.job == "save":
            from .streaming.load import save_violations
            q = save_violations(stream, args.out, args.checkpoint, available_now=args.once,
                                processing_time=None if args.once else "10 seconds",
                                rejects_path=args.rejects)
        else:
            from .streaming.consume import consume_messages
            q = consume_messages(stream, args.out, args.checkpoint, args.image_dir,
                                 available_now=args.once, redelivery=args.redelivery)
        q.awaitTermination()


if __name__ == "__main__":
    main()
