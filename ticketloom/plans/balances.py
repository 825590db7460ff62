"""Closing balances: the running backlog of some days without summing all history.

A balance holds, as of one state of the store, how many tickets every day created and
resolved, by month, and what each month closed with. A reader takes the closing value of the
month before its first day and the days of its own months, and corrects both by what has
changed since: sums of days loaded later are added, and those that the balance counted and
the store no longer holds are taken back. So no load has to renew a balance, and an old one
only makes readers look at more days.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from datetime import date
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ticketloom.plans.numbered_log import NumberedLog
from ticketloom.schema import BALANCE_DAYS, CREATED, DAY_FLOWS, RESOLVED, TABLES
from ticketloom.sources import folders

if TYPE_CHECKING:
    from ticketloom.plans.store import TicketStore

# Sums of a source day lie in one load, corrections of a creation day in another.
Sums = tuple[str, date, str]
_DAY, _LATE = "day", "late"


@dataclass(frozen=True)
class Balance:
    version: str
    covers: frozenset[Sums]
    closing: dict[date, int] = field(default_factory=dict)

    def opening(self, month: date) -> int:
        """What the last month with tickets before a month closed with."""
        before = [m for m in self.closing if m < month]
        return self.closing[max(before)] if before else 0


def _log(store: TicketStore) -> NumberedLog:
    return NumberedLog(store.spark, store.path("balances"), "version string, month string, closing bigint, seq bigint")


def newest(store: TicketStore) -> Balance | None:
    """The last balance struck; a row per month and one per day it covers are read."""
    listing = _log(store).listing()
    if not listing.entries:
        return None
    lines = folders.read_text(store.spark, listing.entries[listing.head]).splitlines()
    first, *months = map(json.loads, lines)
    days = store.spark.read.schema(BALANCE_DAYS).parquet(f"{store.path('balance_days')}/load={first['version']}")
    covers = frozenset(tuple(row) for row in days.collect())
    return Balance(first["version"], covers, {date.fromisoformat(m["month"]): m["closing"] for m in months})


def _held(rows: list[Row]) -> frozenset[Sums]:
    days = {(_DAY, r.simulation_date, r.sums_load) for r in rows if r.simulation_date is not None and r.sums_load is not None}
    late = {(_LATE, r.creation_day, r.late_load) for r in rows if r.creation_day is not None and r.landed_rows}
    return frozenset(days | late)


def _flows(store: TicketStore, some: frozenset[Sums], sign: int) -> list[DataFrame]:
    """What the tickets of some sums did on each day; none for no sums."""
    if not some:
        return []
    record = dict.fromkeys(T._parse_datatype_string(TABLES["ingestion_state"]).names)
    records = [
        record | ({"simulation_date": day, "sums_load": load} if kind == _DAY else {"creation_day": day, "late_load": load, "landed_rows": 1})
        for kind, day, load in sorted(some)
    ]
    sums = store.sums("day_partials", store.records([Row(**r) for r in records]))
    counted = [f"{sign} * if(side = '{side}', tickets, 0L) AS {name}" for side, name in ((CREATED, "created_tickets"), (RESOLVED, "resolved_tickets"))]
    return [sums.selectExpr("ops_date", *counted)]


def _stored(store: TicketStore, version: str, months: list[date] | None = None) -> list[DataFrame]:
    """The days of a balance, all of them or those of some months."""
    base = f"{store.path('running_balances')}/load={version}"
    paths = [base] if months is None else [f"{base}/ops_month={m}" for m in sorted(months)]
    if not paths:
        return []
    return [store.spark.read.schema(DAY_FLOWS).option("basePath", base).parquet(*paths).drop("ops_month")]


def _changes(store: TicketStore, rows: list[Row], balance: Balance | None) -> tuple[Balance | None, list[DataFrame]]:
    """The balance to begin with and the flows that lead from it to the state. A balance
    most of which would be taken back (after a rebuild, say) is none to begin with."""
    held = _held(rows)
    if balance is not None and len(held ^ balance.covers) > len(held):
        balance = None
    covered = balance.covers if balance else frozenset()
    return balance, _flows(store, held - covered, 1) + _flows(store, covered - held, -1)


def _united(store: TicketStore, parts: list[DataFrame]) -> DataFrame:
    flows = store.spark.createDataFrame([], DAY_FLOWS)
    for number, part in enumerate(parts):
        flows = flows.unionByName(part) if number else part
    return flows


def _per_day(flows: DataFrame, day) -> DataFrame:
    return flows.groupBy(day.alias("ops_date")).agg(
        F.sum("created_tickets").alias("created_tickets"), F.sum("resolved_tickets").alias("resolved_tickets")
    )


def _moved() -> str:
    """A day that nothing is left of is no row, as in the full window."""
    return "created_tickets <> 0 OR resolved_tickets <> 0"


def strike(store: TicketStore) -> Balance:
    """Write a balance of the store as it is now, from the one before and what has changed.

    Any balance is right for any later state, so of two writers the later one's is used. An
    empty store has a balance without months. A null day is kept, but closes no month.
    """
    rows = store.current()
    before, parts = _changes(store, rows, newest(store))
    if before is not None:
        parts += _stored(store, before.version)
    version, covers = store.new_load(), _held(rows)
    days = _per_day(_united(store, parts), F.col("ops_date")).where(_moved())
    place = f"{store.path('running_balances')}/load={version}"
    days.withColumn("ops_month", F.trunc("ops_date", "month")).hint("rebalance", "ops_month").write.partitionBy("ops_month").parquet(place)
    listed = store.spark.createDataFrame(sorted(covers), BALANCE_DAYS)
    listed.coalesce(1).write.parquet(f"{store.path('balance_days')}/load={version}")
    month = F.trunc("ops_date", "month")
    net = F.sum(F.col("created_tickets") - F.col("resolved_tickets"))
    closing, total = {}, 0
    # One row per month.
    for row in sorted(_stored(store, version)[0].where("ops_date IS NOT NULL").groupBy(month.alias("month")).agg(net.alias("net")).collect()):
        closing[row.month] = total = total + row.net
    lines = [json.dumps({"version": version}), *(json.dumps({"month": str(m), "closing": c}) for m, c in closing.items())]
    log = _log(store)
    while log.append(lines, log.listing().head) is None:
        pass
    return Balance(version, covers, closing)


def running_backlog_between(store: TicketStore, start: date, stop: date) -> DataFrame:
    """Rows of ``running_backlog`` from a day up to, not with, another one.

    Reads the balance's days of these months and the sums of days loaded since; without a
    balance all sums up to ``stop``. Days without tickets are no rows, and rows without a day
    belong to no range.
    """
    first = start.replace(day=1)
    balance, parts = _changes(store, store.current(), newest(store))
    opening = 0
    if balance is not None:
        opening = balance.opening(first)
        parts += _stored(store, balance.version, [m for m in balance.closing if first <= m < stop])
    flows = _united(store, parts).where(F.col("ops_date") < F.lit(stop))
    # Whatever moved before the first day is one row, in front of the others.
    days = _per_day(flows, F.when(F.col("ops_date") >= F.lit(start), F.col("ops_date")))
    up_to_here = Window.orderBy(F.col("ops_date").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = F.lit(opening).cast("bigint") + F.sum(F.col("created_tickets") - F.col("resolved_tickets")).over(up_to_here)
    return days.withColumn("running_backlog", running).where("ops_date IS NOT NULL").where(_moved())


def loads_covered(store: TicketStore) -> set[str]:
    """Loads that readers of the newest balance may have to take back."""
    balance = newest(store)
    return {load for _, _, load in balance.covers} if balance else set()


def vacuum(store: TicketStore, older_than_hours: float) -> list[str]:
    """Remove balances before the newest one, if old enough that no reader uses them."""
    log = _log(store)
    listing = log.listing()
    if not listing.entries:
        return []
    kept, before = newest(store).version, time.time_ns() - int(older_than_hours * 3600e9)
    removed = []
    for name in ("running_balances", "balance_days"):
        for child in folders.children(store.spark, store.path(name)):
            version = child.removeprefix("load=")
            if version not in (child, kept) and int(version.split("-")[0]) < before:
                removed.append(f"{store.path(name)}/{child}")
    for path, modified, _ in folders.matching(store.spark, f"{log.path}/entry-*.json"):
        if path != listing.entries[listing.head] and modified * 1_000_000 < before:
            removed.append(path)
    for path in removed:
        folders.remove(store.spark, path)
    return removed
