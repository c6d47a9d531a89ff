"""Command line: run the analyses or the ingest stream.

  python -m ludica list
  python -m ludica run <query> --sf-dir DIR [--rows N] [--explain]
  python -m ludica views --sf-dir DIR [--sql "SELECT ... FROM predictions_table"]
  python -m ludica ingest --files DIR | --kafka SERVERS [--topic T]
                          --out PATH [--checkpoint PATH] [--trigger availableNow|"30 seconds"]
                          [--until-close]

Without a configured ``spark.checkpoint.dir`` a local run uses a scratch
folder; on a cluster set it to a shared folder. The ingest checkpoint lies
in the output folder unless one is named, so a second run appends.
"""

from __future__ import annotations

import argparse
import sys


def _session(app: str):
    from pyspark.sql import SparkSession

    from ludica.session import ensure_checkpoint_dir, ship_code
    spark = SparkSession.builder.appName(app).getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ludica")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="registered analyses")
    run = sub.add_parser("run", help="run one analysis and show its rows")
    run.add_argument("query")
    run.add_argument("--sf-dir", required=True, help="folder of the input tables")
    run.add_argument("--rows", type=int, default=20)
    run.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    views = sub.add_parser("views", help="register the eight named views, run SQL over them")
    views.add_argument("--sf-dir", required=True, help="folder of the input tables")
    views.add_argument("--sql", default=None, help="a query over the views to show")
    ing = sub.add_parser("ingest", help="stream messages into landed Parquet")
    src = ing.add_mutually_exclusive_group(required=True)
    src.add_argument("--files", help="folder of message files (one message per line)")
    src.add_argument("--kafka", help="bootstrap servers")
    ing.add_argument("--topic", default=None)
    ing.add_argument("--out", required=True)
    ing.add_argument("--checkpoint", default=None)
    ing.add_argument("--trigger", default="availableNow")
    ing.add_argument("--landing-date", action="store_true",
                     help="partition the landed files by ingest date")
    ing.add_argument("--until-close", action="store_true",
                     help="stop after the batch carrying the close sentinel")
    args = ap.parse_args(argv)

    from ludica.plans.analyses import QUERIES
    if args.cmd == "list":
        for name, fn in QUERIES.items():
            doc = (fn.__doc__ or "").strip().split("\n")[0]
            print(f"{name:32s} {doc}")
        return 0

    if args.cmd == "run":
        if args.query not in QUERIES:
            print(f"unknown query {args.query!r}; see `python -m ludica list`", file=sys.stderr)
            return 2
        spark = _session(f"ludica-{args.query}")
        df = QUERIES[args.query](spark, args.sf_dir)
        if args.explain:
            df.explain("formatted")
        df.show(args.rows, truncate=False)
        return 0

    if args.cmd == "views":
        from ludica.plans.analyses import register_analysis_views
        spark = _session("ludica-views")
        for name in register_analysis_views(spark, args.sf_dir, results=True):
            print(name)
        if args.sql:
            spark.sql(args.sql).show(truncate=False)
        return 0

    from ludica.sources import messages
    from ludica.streaming import pipeline
    spark = _session("ludica-ingest")
    if args.files:
        source = messages.read_message_files(spark, args.files, streaming=True)
    else:
        kw = {"topic": args.topic} if args.topic else {}
        source = messages.read_kafka(spark, args.kafka, **kw)
    if args.until_close:
        trigger = "1 second" if args.trigger == "availableNow" else args.trigger
        pipeline.ingest_until_close(source, args.out, args.checkpoint, trigger=trigger)
    else:
        pipeline.ingest_stream(source, args.out, args.checkpoint, trigger=args.trigger,
                               landing_date=args.landing_date).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
