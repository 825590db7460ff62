"""Per-ticket SLA-risk features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import ticket_columns as tc
from ticketloom.schema import RISK_COLUMNS


def ticket_sla_risk(fact: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A narrow projection: no shuffle, one output row per fact row."""
    created_at = F.col("created_at")
    derived = {
        "created_at_ts": created_at,
        "day_of_week": tc.day_of_week(created_at),
        "hour_of_day": F.hour(created_at),
        "is_high_priority": tc.is_high_priority(F.col("priority")),
        "is_long_resolution": tc.is_long_resolution(
            F.col("resolution_hours_clean"), F.col("sla_hours")
        ),
    }
    return fact.select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in RISK_COLUMNS], *keep
    )
