"""Results with one row per day.

Each takes ticket rows or any partial sums of them (``ticket_days``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from ticketloom.functions.exact_hours import mean_hours
from ticketloom.schema import CREATED, RESOLVED

_RESOLVED_TICKETS = "sum(tickets - open)"

# The breach rate is all breached tickets over resolved ones: that is its
# definition. It may exceed 1, and is null on a day with none resolved.
_KPI = [
    "sum(tickets) AS total_tickets",
    f"{_RESOLVED_TICKETS} AS resolved_tickets",
    "sum(open) AS open_tickets",
    f"{mean_hours()} AS avg_tat",
    f"try_divide(sum(breached), {_RESOLVED_TICKETS}) AS sla_breach_rate",
]
_BACKLOG = "sum(open) AS backlog_size"


def _by_creation_day(rows: DataFrame) -> GroupedData:
    return rows.where(f"side = '{CREATED}'").groupBy("ops_date")


def _agg(groups: GroupedData, *measures: str) -> DataFrame:
    return groups.agg(*map(F.expr, measures))


def features_daily(rows: DataFrame) -> DataFrame:
    """Volume, turnaround and breach rate per creation day."""
    return _agg(_by_creation_day(rows), *_KPI)


def backlog_daily(rows: DataFrame) -> DataFrame:
    """Tickets of each creation day that are still open."""
    return _agg(_by_creation_day(rows), _BACKLOG)


def daily_aggregates(rows: DataFrame) -> DataFrame:
    """All per-creation-day measures from a single aggregation.

    The distinct count is first reduced per (day, agent), so neither a hot day
    nor a hot agent collects its rows in one task.
    """
    distinct_agents = "count(DISTINCT agent_id) AS distinct_agents"
    return _agg(_by_creation_day(rows), *_KPI, _BACKLOG, distinct_agents)


def running_backlog(rows: DataFrame) -> DataFrame:
    """Tickets created up to each day minus tickets resolved up to it.

    Tickets without a readable day stand in a last, null-dated row, so that its
    running value is the true number of open tickets. The window sees one row per
    calendar day, after the distributed sum; its size does not grow with tickets.
    """
    per_day = _agg(
        rows.groupBy("ops_date"),
        f"sum(if(side = '{CREATED}', tickets, 0L)) AS created_tickets",
        f"sum(if(side = '{RESOLVED}', tickets, 0L)) AS resolved_tickets",
    )
    return per_day.selectExpr(
        "*",
        "sum(created_tickets - resolved_tickets) OVER (ORDER BY ops_date NULLS LAST "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_backlog",
    )
