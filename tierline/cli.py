"""Command-line entry points for the tier jobs.

Run under spark-submit (the master and resources come from the submit
command, never from code), e.g.::

    spark-submit scripts/tierline_job.py chain --root s3a://lake/feedback
    spark-submit scripts/tierline_job.py silver-events --source ... --dimension-parquet ...

Each subcommand drains what is available (``availableNow``) and exits;
failures end the process with a non-zero status.
"""

from __future__ import annotations

import argparse
import json
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tierline", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="job", required=True)

    b = sub.add_parser("bronze", help="landing JSON arrays -> bronze parquet")
    b.add_argument("--landing", required=True)
    b.add_argument("--bronze", required=True)
    b.add_argument("--checkpoint", required=True)
    b.add_argument("--max-files-per-trigger", type=int, default=1000)

    e = sub.add_parser("silver-events", help="raw event JSON -> enriched silver parquet")
    e.add_argument("--source", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--checkpoint", required=True)
    e.add_argument("--dimension-parquet", help="user dimension as parquet")
    e.add_argument("--dimension-jdbc",
                   help='JSON: {"url": ..., "table": ..., "user": ..., "partition_column": ..., '
                        '"lower_bound": ..., "upper_bound": ..., "num_partitions": ...}')
    e.add_argument("--key", default="user_id")
    e.add_argument("--max-files-per-trigger", type=int, default=100)
    e.add_argument("--broadcast-max-rows", type=int, default=5_000_000)
    e.add_argument("--salt-buckets", type=int, default=0)
    e.add_argument("--snapshot-dimension", action="store_true")
    e.add_argument("--refresh-dimension", action="store_true",
                   help="read the parquet dimension again in every micro-batch")
    e.add_argument("--rejects")

    t = sub.add_parser("silver-tickets", help="bronze tickets -> triaged silver parquet")
    t.add_argument("--bronze", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--checkpoint", required=True)
    t.add_argument("--rejects")

    g = sub.add_parser("gold", help="silver tickets -> gold target")
    g.add_argument("--silver", required=True)
    g.add_argument("--target", required=True)
    g.add_argument("--rejects")
    g.add_argument("--incremental-checkpoint",
                   help="maintain gold incrementally with this streaming checkpoint")

    c = sub.add_parser("chain", help="landing -> bronze -> silver -> gold under one root")
    c.add_argument("--root", required=True)
    c.add_argument("--landing")
    c.add_argument("--incremental", action="store_true")

    k = sub.add_parser("compact", help="many small files of a tier -> few large ones")
    k.add_argument("--source", required=True)
    k.add_argument("--out", required=True)
    k.add_argument("--checkpoint", required=True)
    k.add_argument("--target-bytes", type=int, default=128 * 1024 * 1024)

    x = sub.add_parser("export-jdbc", help="gold target -> serving database table")
    x.add_argument("--target", required=True)
    x.add_argument("--url", required=True)
    x.add_argument("--table", required=True)
    x.add_argument("--user")
    x.add_argument("--password")
    x.add_argument("--driver")
    return p


def run(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from .session import build_session

    spark = build_session(app_name=f"tierline-{args.job}")
    try:
        return dispatch(spark, args)
    finally:
        spark.stop()


def dispatch(spark, args) -> int:
    """Run the job named by ``args`` on an existing session."""
    from .plans.bronze import run_bronze
    from .plans.chain import ChainPaths, run_chain, silver_schema
    from .plans.gold import export_jdbc, run_gold, run_gold_incremental
    from .plans.silver import run_silver_events, run_silver_tickets
    from .functions.triage import DEFAULT_OUTCOME, DEFAULT_RULES
    from .sources.jdbc import read_jdbc
    from .streaming.compact import run_compaction

    if args.job == "bronze":
        run_bronze(spark, args.landing, args.bronze, args.checkpoint,
                   max_files_per_trigger=args.max_files_per_trigger)
    elif args.job == "silver-events":
        if args.dimension_jdbc:
            opts = json.loads(args.dimension_jdbc)
            dim = read_jdbc(spark, opts.pop("url"), opts.pop("table"), **opts)
        elif args.dimension_parquet:
            def read_dimension():
                return spark.read.parquet(args.dimension_parquet)

            dim = read_dimension if args.refresh_dimension else read_dimension()
        else:
            raise SystemExit("silver-events needs --dimension-parquet or --dimension-jdbc")
        run_silver_events(
            spark, args.source, dim, args.out, args.checkpoint,
            max_files_per_trigger=args.max_files_per_trigger, rejects=args.rejects,
            key=args.key, broadcast_max_rows=args.broadcast_max_rows,
            salt_buckets=args.salt_buckets or None, snapshot=args.snapshot_dimension,
        )
    elif args.job == "silver-tickets":
        run_silver_tickets(spark, args.bronze, args.out, args.checkpoint, rejects=args.rejects)
    elif args.job == "gold":
        schema = silver_schema(spark, DEFAULT_RULES, DEFAULT_OUTCOME)
        if args.incremental_checkpoint:
            run_gold_incremental(spark, args.silver, args.target, args.incremental_checkpoint,
                                 schema, args.rejects)
        else:
            result = run_gold(spark, args.silver, args.target, schema, args.rejects)
            print(json.dumps({"published": result.path}))
    elif args.job == "chain":
        result = run_chain(spark, ChainPaths.under(args.root, args.landing), incremental=args.incremental)
        print(json.dumps({"published": result.path}))
    elif args.job == "compact":
        run_compaction(spark, args.source, args.out, args.checkpoint, spark.read.parquet(args.source).schema,
                       target_bytes=args.target_bytes)
    elif args.job == "export-jdbc":
        path = export_jdbc(spark, args.target, args.url, args.table,
                           user=args.user, password=args.password, driver=args.driver)
        print(json.dumps({"exported": path}))
    return 0


if __name__ == "__main__":
    sys.exit(run())
