"""Column contracts: the ticket source, the fact table, the stored tables."""

from __future__ import annotations

# The twelve source columns and the type each is read as. Files
# are bound to these by header name, never by position.
TICKET_TYPES = {
    "ticket_id": "string",
    "created_at": "timestamp",
    "resolved_at": "string",
    "resolution_hours": "double",
    "sla_hours": "double",
    "sla_breached": "boolean",
    "priority": "string",
    "category": "string",
    "channel": "string",
    "customer_tier": "string",
    "status": "string",
    "agent_id": "string",
}

# The fifteen fact columns in their published order.
FACT_COLUMNS = [
    "ticket_id",
    "created_at",
    "resolved_at",
    "created_date",
    "resolved_date",
    "is_resolved",
    "resolution_hours_clean",
    "sla_hours",
    "sla_breached",
    "priority",
    "category",
    "channel",
    "customer_tier",
    "status",
    "agent_id",
]

# The risk table's columns in their published order.
RISK_COLUMNS = [
    "ticket_id",
    "created_at_ts",
    "created_date",
    "priority",
    "category",
    "agent_id",
    "resolution_hours_clean",
    "sla_hours",
    "sla_breached",
    "day_of_week",
    "hour_of_day",
    "is_high_priority",
    "is_long_resolution",
]

# The sums that every day-level result is finished from. All of them merge by
# addition, so a day's rows can be summed in any order and any number of steps.
MEASURES = [
    "tickets",
    "ids",
    "open",
    "breached",
    "hours_n",
    "hours_whole",
    "hours_micro",
    "hours_rest",
]

CREATED, RESOLVED = "created", "resolved"


_MEASURE_DDL = ", ".join(
    f"{m} {'double' if m == 'hours_rest' else 'bigint'}" for m in MEASURES
)

# Stored tables, as DDL. Partition columns stand last, as Spark returns them.
TABLES = {
    "tickets_raw": (
        ", ".join(f"{c} {t}" for c, t in TICKET_TYPES.items())
        + ", _unread map<string,string>, _malformed string, _ingestion_ts timestamp, _source_file string, "
        "source_date date, created_date date"
    ),
    "fact_tickets": (
        "ticket_id string, created_at timestamp, resolved_at string, resolved_date date, "
        "is_resolved boolean, resolution_hours_clean double, sla_hours double, "
        "sla_breached boolean, priority string, category string, channel string, "
        "customer_tier string, status string, agent_id string, "
        "source_date date, created_date date"
    ),
    "ticket_sla_risk": (
        "ticket_id string, created_at_ts timestamp, priority string, category string, "
        "agent_id string, resolution_hours_clean double, sla_hours double, "
        "sla_breached boolean, day_of_week string, hour_of_day int, "
        "is_high_priority boolean, is_long_resolution boolean, "
        "source_date date, created_date date"
    ),
    "agent_partials": (
        f"side string, ops_date date, agent_id string, {_MEASURE_DDL}, source_date date"
    ),
    "day_partials": f"side string, ops_date date, {_MEASURE_DDL}, source_date date",
    # Versions of tickets that a later day's file replaced, and what they count for, negated.
    "late_versions": "ticket_id string, source_date date, created_date date",
    "late_partials": f"side string, ops_date date, agent_id string, {_MEASURE_DDL}, created_date date",
    "ingestion_state": (
        "simulation_date date, ingestion_timestamp timestamp, rows_ingested bigint, "
        "landed_rows bigint, raw_load string, fact_load string, sums_load string, extra_columns array<string>, "
        "creation_day date, late_load string, seq bigint"
    ),
    "loaded_files": "path string, modified timestamp, length bigint, day date, seq bigint",
}

# A balance: what tickets did on each day, and which sums it counted.
DAY_FLOWS = "ops_date date, created_tickets bigint, resolved_tickets bigint"
BALANCE_DAYS = "kind string, day date, load string"

# Tables of one row per ticket lie by these columns within a load; the sums do not.
PARTITIONS = {
    "tickets_raw": ["source_date", "created_date"],
    "fact_tickets": ["source_date", "created_date"],
    "ticket_sla_risk": ["source_date", "created_date"],
    "agent_partials": [],
    "day_partials": [],
}

# Which load of a day holds its rows in each table.
LOAD_COLUMN = {
    "tickets_raw": "raw_load",
    "fact_tickets": "fact_load",
    "ticket_sla_risk": "fact_load",
    "agent_partials": "sums_load",
    "day_partials": "sums_load",
}

# How many rows of a day lie there; a table of a day without any has no folder for it.
ROWS_COLUMN = {
    "tickets_raw": "landed_rows",
    "fact_tickets": "rows_ingested",
    "ticket_sla_risk": "rows_ingested",
}

# These belong to a creation day, not to a source day.
LATE_TABLES = ("late_versions", "late_partials")

STATE_COLUMNS = ["simulation_date", "ingestion_timestamp", "rows_ingested"]
