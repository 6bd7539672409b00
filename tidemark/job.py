"""Command-line entry points (for spark-submit or ``python -m tidemark.job``).

    run     stream the history into the keyed live table, with a progress log
    report  print the landing report of the live table and the progress report, once

Examples::

    python -m tidemark.job run --history /data/history --dim /data/dim_asset \\
        --target /data/asset_live_state --checkpoint /chk/asset_live_state \\
        --trigger processing --interval "1 second" --progress /data/stream_progress

    python -m tidemark.job report --target /data/asset_live_state \\
        --progress /data/stream_progress --window 60
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tidemark.job")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="start the live-state stream")
    run.add_argument("--history", required=True)
    run.add_argument("--dim", required=True)
    run.add_argument("--target", required=True)
    run.add_argument("--checkpoint", required=True)
    run.add_argument("--trigger", choices=["processing", "availableNow", "realtime"], default="processing")
    run.add_argument("--interval", default="1 second", help='processing interval; "0 seconds" = back-to-back')
    run.add_argument("--watermark", default="30 seconds")
    run.add_argument("--reload-dim", action="store_true")
    run.add_argument("--max-files-per-trigger", type=int, default=None)
    run.add_argument("--progress", default=None, help="Parquet folder for the per-batch progress log")
    run.add_argument("--query-name", default="asset_live_state")
    rep = sub.add_parser("report", help="print the landing and progress reports once")
    rep.add_argument("--target", required=True)
    rep.add_argument("--progress", default=None)
    rep.add_argument("--window", type=int, default=60, help="window in seconds")
    rep.add_argument("--as-of", default=None, help="UTC instant replacing now(), ISO format (default: now)")
    return ap


def run(spark: SparkSession, args: argparse.Namespace):
    from tidemark.plans.live import start_live_state
    from tidemark.streaming.progress import ProgressLog

    trigger = {"processing": args.interval, "availableNow": "availableNow", "realtime": "realtime"}[args.trigger]
    log = None
    if args.progress:
        log = ProgressLog(spark, args.progress, args.query_name)
        spark.streams.addListener(log)
    q = start_live_state(spark, args.history, args.dim, args.target, args.checkpoint,
                         watermark=args.watermark, trigger=trigger, reload_dim=args.reload_dim,
                         query_name=args.query_name, max_files_per_trigger=args.max_files_per_trigger)
    return q, log


def await_with_progress(q, log, flush_every_sec: float = 10.0) -> None:
    """Block until the query ends, flushing the progress log periodically."""
    try:
        while not q.awaitTermination(flush_every_sec):
            if log is not None:
                log.flush()
    finally:
        if log is not None:   # also when the query failed: its last batches are the interesting ones
            log.flush()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def report(spark: SparkSession, args: argparse.Namespace) -> dict:
    from tidemark.plans.reports import landing_report
    from tidemark.streaming.keyed import KeyedTable
    from tidemark.streaming.progress import ProgressLog, progress_report

    from tidemark.functions import utc_wall_clock

    # Everything in UTC wall clock, like the progress log's event times: the
    # table's instants, and "now" (``--as-of`` is read as UTC).
    as_of = (F.lit(dt.datetime.fromisoformat(args.as_of)).cast("timestamp_ntz") if args.as_of
             else utc_wall_clock(F.current_timestamp()))
    live = KeyedTable(spark, args.target).read()
    live = live.select(*[utc_wall_clock(c).alias(c) if c in ("reading_ts", "updated_ts") else F.col(c)
                         for c in live.columns])
    out = {"landing": landing_report(live, as_of, args.window).first().asDict()}
    if args.progress:
        out["progress"] = progress_report(ProgressLog(spark, args.progress).read(), as_of, args.window).first().asDict()
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    if spark is None:
        from tidemark.session import get_spark
        spark = get_spark()
    if args.cmd == "run":
        q, log = run(spark, args)
        await_with_progress(q, log)
    else:
        print(json.dumps(report(spark, args), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
