"""Command line: ``python -m quotelake.cli <command> [options]``.

  stream    envelope stream (Kafka or JSON-lines files) -> lake (+ JDBC), availableNow
  backfill  raw lake -> fact + stats tables (replaced)
  history   fold the batches committed since the last run into the whole-history statistics
  compact   rewrite the committed batches of a lake as one folder per day, in one commit
  gates     row-count and null-critical gates over a fact table; non-zero exit on failure
  query     run one registered query on a table folder and show / write the result

Settings (master, memory, object-store keys, spark.checkpoint.dir) come from
spark-submit / spark-defaults as usual; nothing is read from the environment.
"""

from __future__ import annotations

import argparse
import sys

from quotelake.session import build_session


def _session(args):
    return build_session(args.master, f"quotelake-{args.command}")


def _tables(args) -> dict[str, dict[str, str]] | None:
    """JDBC options of the two tables, if a database is given."""
    from quotelake.sinks.jdbc import jdbc_options
    if not args.jdbc_url:
        return None
    return {t: jdbc_options(args.jdbc_url, t, args.jdbc_user, args.jdbc_password, args.jdbc_driver)
            for t in ("coin_prices", "market_stats")}


def _logger(spark, args):
    """Run log to a folder, else to the database's log table, else none."""
    from quotelake.sinks.jdbc import jdbc_options
    from quotelake.sinks.runlog import lake_logger, table_logger
    if args.log:
        return lake_logger(spark, args.log)
    if args.jdbc_url:
        return table_logger(spark, jdbc_options(args.jdbc_url, "pipeline_logs", args.jdbc_user, args.jdbc_password,
                                                args.jdbc_driver))
    return None


def _add_jdbc(parser) -> None:
    for name in ("url", "user", "password", "driver"):
        parser.add_argument(f"--jdbc-{name}")


def cmd_stream(args) -> int:
    from quotelake.sources.streams import envelope_file_stream, kafka_stream
    from quotelake.streaming.jobs import start_pipeline
    spark = _session(args)
    if args.kafka:
        extra = dict(o.split("=", 1) for o in args.kafka_option or [])
        messages = kafka_stream(spark, args.kafka, args.topic, args.starting_offsets,
                                args.max_per_trigger, args.fail_on_data_loss, extra)
    else:
        messages = envelope_file_stream(spark, args.files, args.max_per_trigger)
    q = start_pipeline(messages, args.lake, args.checkpoint, jdbc=_tables(args),
                       event_time=args.event_time, available_now=not args.continuous, log=_logger(spark, args),
                       commit=args.commit, gate=args.gate)
    if args.continuous:
        q.awaitTermination()
    return 0


def cmd_backfill(args) -> int:
    from quotelake.plans.backfill import backfill
    spark = _session(args)
    log = _logger(spark, args) or (lambda *_: None)
    log("backfill", "started", args.raw)
    try:
        done = backfill(spark, args.raw, args.facts, args.stats, _tables(args), args.rejects)
    except Exception as e:
        log("backfill", "failed", str(e)[:500])
        raise
    log("backfill", "success", str(done))
    print(done)
    return 0


def cmd_history(args) -> int:
    from quotelake.plans.history import incremental_history, update_history
    spark = _session(args)
    print(f"{update_history(spark, args.lake, args.state)} new batches")
    stats = incremental_history(spark, args.state)
    if args.out:
        stats.write.mode("overwrite").parquet(args.out)
    else:
        stats.show(truncate=False)
    return 0


def cmd_compact(args) -> int:
    from quotelake.sinks.manifest import compact_committed, vacuum
    spark = _session(args)
    print(f"{compact_committed(spark, args.lake, args.sink)} batches compacted")
    if args.vacuum:
        print(f"{vacuum(spark, args.lake, args.sink)} replaced folders deleted")
    return 0


def cmd_gates(args) -> int:
    from quotelake.operators.quality import QualityGateError, run_gates
    from quotelake.sinks.jdbc import read_table
    spark = _session(args)
    if args.facts:
        facts = spark.read.parquet(args.facts)
    elif args.jdbc_url:
        facts = read_table(spark, _tables(args)["coin_prices"])
    else:
        print("gates needs --facts or --jdbc-url", file=sys.stderr)
        return 1
    log = _logger(spark, args)
    try:
        print(run_gates(facts, log))
    except QualityGateError as e:
        print(f"gate failed: {e}", file=sys.stderr)
        return 2
    return 0


def cmd_query(args) -> int:
    import quotelake.plans.stream_queries  # noqa: F401  (registers streaming queries)
    from quotelake.plans.registry import QUERIES
    spark = _session(args)
    df = QUERIES[args.name](spark, args.tables)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.rows, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quotelake")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("stream")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="folder of JSON-lines envelope files")
    s.add_argument("--topic", default="quotes")
    s.add_argument("--starting-offsets", default="earliest")
    s.add_argument("--max-per-trigger", type=int, help="cap on messages (files) per micro-batch; none by default")
    s.add_argument("--fail-on-data-loss", action="store_true")
    s.add_argument("--kafka-option", action="append", metavar="KEY=VALUE")
    s.add_argument("--lake", required=True)
    s.add_argument("--checkpoint", required=True, help="keep it: it is the stream's identity")
    s.add_argument("--log", help="run-log folder")
    s.add_argument("--commit", action="store_true", help="make all sinks of a batch visible together")
    s.add_argument("--gate", action="store_true", help="audit each batch before it becomes visible (implies --commit)")
    s.add_argument("--event-time", action="store_true")
    s.add_argument("--continuous", action="store_true", help="processing-time trigger, no stop")
    _add_jdbc(s)

    b = sub.add_parser("backfill")
    b.add_argument("--raw", required=True)
    b.add_argument("--facts")
    b.add_argument("--stats")
    b.add_argument("--rejects", help="folder for rows that break a table's contract")
    b.add_argument("--log", help="run-log folder")
    _add_jdbc(b)

    h = sub.add_parser("history")
    h.add_argument("--lake", required=True, help="lake written with --commit")
    h.add_argument("--state", required=True)
    h.add_argument("--out")

    c = sub.add_parser("compact")
    c.add_argument("--lake", required=True, help="lake written with --commit")
    c.add_argument("--sink", default="raw")
    c.add_argument("--vacuum", action="store_true", help="delete the replaced folders")

    g = sub.add_parser("gates")
    g.add_argument("--facts", help="parquet fact table; else the database's")
    g.add_argument("--log")
    _add_jdbc(g)

    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--tables", required=True)
    q.add_argument("--out")
    q.add_argument("--rows", type=int, default=20)

    args = p.parse_args(argv)
    return {"stream": cmd_stream, "backfill": cmd_backfill, "history": cmd_history, "compact": cmd_compact,
            "gates": cmd_gates, "query": cmd_query}[args.command](args)


if __name__ == "__main__":
    sys.exit(main())
