"""Support tickets seen in the `orders` test table, over two years of days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_HOURS = "(o_orderkey % 200) / 4D"
_SLA_HOURS = "element_at(array(8D, 24D, 48D, 72D), CAST(o_orderkey % 4 + 1 AS INT))"
# The table's years of midnights are folded onto 2023 and 2024, times are added.
_CREATED = (
    "timestampadd(SECOND, o_orderkey % 86400, timestampadd(DAY, "
    "datediff(o_orderdate, DATE'1992-01-01') % 730, TIMESTAMP_NTZ'2023-01-01 00:00:00'))"
)

_COLUMNS = [
    "CAST(o_orderkey AS STRING) AS ticket_id",
    f"{_CREATED} AS created_at",
    f"CASE WHEN o_orderstatus <> 'O' THEN date_format("
    f"timestampadd(MINUTE, CAST({_HOURS} * 60 AS BIGINT), {_CREATED}), 'M/d/yy H:mm') END AS resolved_at",
    f"{_HOURS} AS resolution_hours",
    f"{_SLA_HOURS} AS sla_hours",
    f"{_HOURS} > {_SLA_HOURS} AS sla_breached",
    "o_orderpriority AS priority",
    "o_orderstatus AS category",
    "element_at(array('Email', 'Chat', 'Phone'), CAST(o_custkey % 3 + 1 AS INT)) AS channel",
    "if(o_custkey % 2 = 0, 'Gold', 'Silver') AS customer_tier",
    "if(o_orderstatus = 'O', 'Open', 'Resolved') AS status",
    "if(o_orderkey % 50 <> 0, CAST(o_custkey % 25 AS STRING), NULL) AS agent_id",
]


def order_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(*_COLUMNS)
