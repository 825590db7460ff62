"""Tickets as additive rows on the days they touch.

A ticket counts on the day it was created and, once resolved, on the day it was
resolved. Every day-level result is a sum over such rows, so one set of partial
sums serves them all, in bulk and incrementally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ticketloom.functions.exact_hours import split_hours
from ticketloom.schema import CREATED, MEASURES, RESOLVED

_MEASURE_SQL = {
    "tickets": "1L",
    "ids": "if(ticket_id IS NULL, 0L, 1L)",
    "open": "if(is_resolved, 0L, 1L)",
    "breached": "if(sla_breached, 1L, 0L)",
    **split_hours("resolution_hours_clean"),
}
_MEASURES = [f"{_MEASURE_SQL[m]} AS {m}" for m in MEASURES]


def created_rows(fact: DataFrame, *keep: str) -> DataFrame:
    """One row per ticket, on its creation day."""
    return fact.selectExpr(
        f"'{CREATED}' AS side", "created_date AS ops_date", "agent_id", *_MEASURES, *keep
    )


def resolved_rows(fact: DataFrame, *keep: str) -> DataFrame:
    """One row per resolved ticket, on its resolution day, which may be null."""
    return fact.where("is_resolved").selectExpr(
        f"'{RESOLVED}' AS side", "resolved_date AS ops_date", "agent_id", *_MEASURES, *keep
    )


def ticket_rows(fact: DataFrame, *keep: str) -> DataFrame:
    """Creation rows, and resolution rows of the resolved tickets, from one scan.

    A resolved ticket whose resolution day cannot be read keeps its resolution
    row, with a null day.
    """
    return (
        fact.selectExpr("*", f"explode(array('{CREATED}', '{RESOLVED}')) AS side")
        .where(f"side = '{CREATED}' OR is_resolved")
        .selectExpr(
            "side",
            f"if(side = '{CREATED}', created_date, resolved_date) AS ops_date",
            "agent_id",
            *_MEASURES,
            *keep,
        )
    )


def sum_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """Partial sums of ticket rows, or of partial sums, per key.

    Map tasks pre-aggregate, so a key that holds a third of all rows still sends
    one row per task.
    """
    return rows.groupBy(*keys).sum(*MEASURES).toDF(*keys, *MEASURES)
