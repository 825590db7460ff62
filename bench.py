"""Time the headline queries and jobs; print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Every
query is run once to warm up and then three times; the median counts. Jobs write
new tables each time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ticketloom.plans import jobs  # noqa: E402
from ticketloom.plans.store import TicketStore  # noqa: E402
from ticketloom.registry import queries  # noqa: E402
from ticketloom.session import local_session, new_work_dir  # noqa: E402
from ticketloom.sources.day_files import export_days  # noqa: E402
from ticketloom.sources.event_tickets import event_tickets  # noqa: E402
from ticketloom.streaming.arrivals import load_arrivals  # noqa: E402

REPEATS = 3
OPERATORS = (
    "fact_tickets",
    "features_daily",
    "backlog_daily",
    "daily_aggregates",
    "assigned_per_agent",
    "resolved_per_agent",
    "daily_agent_load",
    "daily_agent_load_null_safe",
    "ticket_sla_risk",
    "running_backlog",
    "rows_per_month",
)


def median_seconds(run) -> float:
    run()
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "ticketloom-bench")
    seconds: dict[str, float] = {}

    def consume(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    for name in OPERATORS:
        query = queries.QUERIES[name]
        seconds[name] = median_seconds(lambda: consume(query(spark, sf_dir)))

    tickets = event_tickets(spark, sf_dir)
    export = lambda: export_days(tickets, new_work_dir(spark, "bench")).files
    seconds["export_days"] = median_seconds(export)
    files = export()

    def new_store() -> TicketStore:
        return TicketStore(spark, new_work_dir(spark, "bench"))

    months = {m for (m,) in tickets.selectExpr("month(created_at)").distinct().collect()}
    span = tickets.selectExpr("to_date(min(created_at))", "to_date(max(created_at))").first()

    def backfill(store: TicketStore) -> TicketStore:
        jobs.backfill(store, files, 2024, min(months), max(months))
        return store

    seconds["backfill"] = median_seconds(lambda: backfill(new_store()))
    loaded = backfill(new_store())
    seconds["rebuild"] = median_seconds(lambda: jobs.rebuild(loaded))
    daily = new_store()
    seconds["run_day"] = median_seconds(lambda: jobs.run_day(daily, files, span[0], end=span[1]))
    seconds["catch_up"] = median_seconds(lambda: jobs.catch_up(new_store(), files, *span))
    for name in ("features_daily", "daily_agent_load", "running_backlog"):
        seconds[f"read_{name}"] = median_seconds(lambda: consume(loaded.table(name)))

    seconds["stream"] = median_seconds(lambda: load_arrivals(new_store(), files))

    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries and jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
