"""Raw tickets to one cleaned fact row per ticket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import ticket_columns as tc
from ticketloom.schema import FACT_COLUMNS


def fact_tickets(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fifteen fact columns, plus any columns named in ``keep``.

    Whether a ticket is open is decided by ``resolved_at`` alone, never by
    ``status``. The same narrow projection serves bulk, daily and streaming use.
    """
    resolved_at = F.col("resolved_at")
    derived = {
        "created_date": F.to_date("created_at"),
        "resolved_date": tc.resolved_date(resolved_at),
        "is_resolved": resolved_at.isNotNull(),
        "resolution_hours_clean": tc.clean_hours(resolved_at, F.col("resolution_hours")),
    }
    return raw.select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in FACT_COLUMNS], *keep
    )
