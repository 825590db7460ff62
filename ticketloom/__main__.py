"""Command line of the jobs, for spark-submit or `python -m ticketloom`.

The session zone, master and sizing come from the submit command; job settings
are applied here. Paths may be on any file system the cluster can reach.
"""

from __future__ import annotations

import argparse
import logging
from datetime import date, timedelta

from pyspark.sql import SparkSession

from ticketloom.plans import balances, jobs
from ticketloom.plans.store import TicketStore
from ticketloom.session import build_session
from ticketloom.sources.day_files import DayFiles, export_days, read_extract
from ticketloom.streaming.arrivals import load_arrivals


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ticketloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *, files: bool = False, store: bool = False):
        sub = commands.add_parser(name, help=text, description=text)
        if files:
            sub.add_argument("--files", required=True, help="folder of the day files")
            sub.add_argument(
                "--partitioned", action="store_true", help="created_date=... folders, as exported"
            )
        if store:
            sub.add_argument("--store", required=True, help="folder of the tables")
        return sub

    def span(sub):
        sub.add_argument("--start", type=date.fromisoformat, help="first day, where none is recorded")
        sub.add_argument("--end", type=date.fromisoformat, help="load nothing later")
        sub.add_argument("--skip-missing", action="store_true", help="record a day without a file")

    daily = command("daily", "load the next day, or a named one again", files=True, store=True)
    daily.add_argument("--date", type=date.fromisoformat)
    daily.add_argument("--publish", help="also bring the published copies here up to date")
    span(daily)

    span(command("catch-up", "load every unrecorded day", files=True, store=True))

    months = command("backfill", "land the raw tickets of some months", files=True, store=True)
    months.add_argument("--year", type=int, required=True)
    months.add_argument("--start-month", type=int, default=1)
    months.add_argument("--end-month", type=int, default=12)

    bulk = command("rebuild", "recompute every derived table from raw", store=True)
    bulk.add_argument("--publish", help="also write full copies of the results here")

    reset = command("reset", "remove a day from every table", store=True)
    reset.add_argument("--date", type=date.fromisoformat, required=True)

    command("log", "show the recorded days, newest first", store=True)

    split = command("export", "split an extract into one CSV folder per day")
    split.add_argument("--extract", required=True)
    split.add_argument("--to", required=True)
    split.add_argument("--year", type=int, help="only this year")
    split.add_argument("--month", type=int)
    split.add_argument("--splits", action="store_true", help="read a file by many tasks; no cell may hold a line break")

    command("arrivals", "load every day with a new or changed file", files=True, store=True)

    compact = command("compact", "rewrite the sums of closed days as few files", store=True)
    compact.add_argument("--until", type=date.fromisoformat, required=True)
    command("balance", "strike the closing balances that ranges of days begin from", store=True)
    backlog = command("backlog", "show the running backlog of some days", store=True)
    backlog.add_argument("--start", type=date.fromisoformat, required=True)
    backlog.add_argument("--end", type=date.fromisoformat, required=True, help="the last day shown")
    vacuum = command("vacuum", "remove folders of loads that no reader sees", store=True)
    vacuum.add_argument("--older-than-hours", type=float, default=24.0)
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> object:
    files = DayFiles(args.files, args.partitioned) if hasattr(args, "files") else None
    store = TicketStore(spark, args.store) if hasattr(args, "store") else None
    match args.command:
        case "daily":
            return _daily(store, files, args)
        case "catch-up":
            return jobs.catch_up(store, files, args.start, args.end, args.skip_missing)
        case "backfill":
            return jobs.backfill(store, files, args.year, args.start_month, args.end_month)
        case "rebuild":
            return jobs.rebuild(store, args.publish)
        case "reset":
            return jobs.reset_day(store, args.date)
        case "log":
            for row in jobs.ingestion_log(store).toLocalIterator():
                print(row.simulation_date, row.ingestion_timestamp, row.rows_ingested, sep="\t")
            return None
        case "export":
            extract = read_extract(spark, args.extract, typed=False, splits=args.splits)
            return export_days(extract, args.to, args.year, args.month)
        case "arrivals":
            return load_arrivals(store, files)
        case "compact":
            rewritten = store.compact(args.until)
            balances.strike(store)
            return rewritten
        case "balance":
            return balances.strike(store).version
        case "backlog":
            shown = balances.running_backlog_between(store, args.start, args.end + timedelta(days=1))
            for row in shown.orderBy("ops_date").toLocalIterator():
                print(*row, sep="\t")
            return None
        case "vacuum":
            return store.vacuum(args.older_than_hours)


def _daily(store: TicketStore, files: DayFiles, args: argparse.Namespace) -> jobs.DayResult:
    day = args.date or jobs.next_day(store, args.start)
    before = jobs.touched_days(store, [day]) if args.publish else ()
    result = jobs.run_day(store, files, day, end=args.end, skip_missing=args.skip_missing)
    if args.publish and result.status == "loaded":
        jobs.publish_days(store, args.publish, [day], before)
    return result


def main() -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    args = parser().parse_args()
    spark = build_session()
    try:
        result = run(spark, args)
        logging.info("%s: %s", args.command, result)
        failed = getattr(result, "failed_months", None)
        return 1 if failed else 0
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
