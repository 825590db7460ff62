"""Support tickets seen in the `events` test table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SLA_HOURS = "element_at(array(8D, 24D, 48D, 72D), CAST(event_id % 4 + 1 AS INT))"
_RESOLVED = "timestampadd(MINUTE, floor(value * 60), ts)"

_COLUMNS = [
    "event_id AS ticket_id",
    "ts AS created_at",
    f"CASE WHEN event_type <> 'error' THEN date_format({_RESOLVED}, 'M/d/yy H:mm') END"
    " AS resolved_at",
    "value AS resolution_hours",
    f"{_SLA_HOURS} AS sla_hours",
    f"value > {_SLA_HOURS} AS sla_breached",
    "element_at(array('Critical', 'High', 'Medium', 'Low'), CAST(event_id % 4 + 1 AS INT))"
    " AS priority",
    "event_type AS category",
    "element_at(array('Email', 'Chat', 'Phone'), CAST(user_id % 3 + 1 AS INT)) AS channel",
    "if(user_id % 2 = 0, 'Gold', 'Silver') AS customer_tier",
    "if(event_type = 'error', 'Open', 'Resolved') AS status",
    "if(event_id % 50 <> 0, user_id % 25, NULL) AS agent_id",
]


def event_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticket per event; an error event is a ticket that is still open.

    Ids stay bigint here, so the operators are exercised on ids that are not text.
    """
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*_COLUMNS)
