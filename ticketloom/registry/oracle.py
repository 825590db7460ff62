"""The registered queries as plain SQL over the same tables.

Means are exact decimal sums divided by counts: a floating sum would depend on
the order in which an engine adds. sum() of integers is cast, because the SQL
engine widens it beyond bigint.
"""

from __future__ import annotations

_TICKETS = """
tickets AS (
  SELECT
    event_id AS ticket_id,
    ts AS created_at,
    CASE WHEN event_type <> 'error'
         THEN strftime(ts + to_minutes(CAST(floor(value * 60) AS BIGINT)), '%-m/%-d/%y %-H:%M')
    END AS resolved_at,
    value AS resolution_hours,
    CAST(CASE event_id % 4 WHEN 0 THEN 8 WHEN 1 THEN 24 WHEN 2 THEN 48 ELSE 72 END AS DOUBLE)
      AS sla_hours,
    value > CASE event_id % 4 WHEN 0 THEN 8 WHEN 1 THEN 24 WHEN 2 THEN 48 ELSE 72 END
      AS sla_breached,
    CASE event_id % 4 WHEN 0 THEN 'Critical' WHEN 1 THEN 'High' WHEN 2 THEN 'Medium' ELSE 'Low' END
      AS priority,
    event_type AS category,
    CASE user_id % 3 WHEN 0 THEN 'Email' WHEN 1 THEN 'Chat' ELSE 'Phone' END AS channel,
    CASE user_id % 2 WHEN 0 THEN 'Gold' ELSE 'Silver' END AS customer_tier,
    CASE WHEN event_type = 'error' THEN 'Open' ELSE 'Resolved' END AS status,
    CASE WHEN event_id % 50 <> 0 THEN user_id % 25 END AS agent_id
  FROM events
)"""

_FACT = f"""{_TICKETS},
fact AS (
  SELECT
    ticket_id, created_at, resolved_at,
    CAST(created_at AS DATE) AS created_date,
    CAST(strptime(resolved_at, '%m/%d/%y %H:%M') AS DATE) AS resolved_date,
    resolved_at IS NOT NULL AS is_resolved,
    CASE WHEN resolved_at IS NOT NULL THEN resolution_hours END AS resolution_hours_clean,
    sla_hours, sla_breached, priority, category, channel, customer_tier, status, agent_id
  FROM tickets
)"""

_ORDER_TICKETS = """
order_day AS (
  SELECT *, (o_orderkey % 200) / 4.0 AS hours,
    CAST(CASE o_orderkey % 4 WHEN 0 THEN 8 WHEN 1 THEN 24 WHEN 2 THEN 48 ELSE 72 END AS DOUBLE) AS sla,
    TIMESTAMP '2023-01-01' + to_days(CAST(datediff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) % 730 AS INTEGER))
      + to_seconds(o_orderkey % 86400) AS created_at
  FROM orders
),
tickets AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ticket_id, created_at,
    CASE WHEN o_orderstatus <> 'O'
         THEN strftime(created_at + to_minutes(CAST(floor(hours * 60) AS BIGINT)), '%-m/%-d/%y %-H:%M') END AS resolved_at,
    CAST(hours AS DOUBLE) AS resolution_hours, sla AS sla_hours, hours > sla AS sla_breached,
    o_orderpriority AS priority, o_orderstatus AS category,
    CASE o_custkey % 3 WHEN 0 THEN 'Email' WHEN 1 THEN 'Chat' ELSE 'Phone' END AS channel,
    CASE o_custkey % 2 WHEN 0 THEN 'Gold' ELSE 'Silver' END AS customer_tier,
    CASE WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'Resolved' END AS status,
    CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_custkey % 25 AS VARCHAR) END AS agent_id
  FROM order_day
)"""

_MEAN = (
    "CAST(sum(CAST(resolution_hours_clean AS DECIMAL(18,6))) AS DOUBLE)"
    " / nullif(count(resolution_hours_clean), 0)"
)

_KPI = f"""
    count(*) AS total_tickets,
    CAST(sum(CASE WHEN is_resolved THEN 1 ELSE 0 END) AS BIGINT) AS resolved_tickets,
    CAST(sum(CASE WHEN is_resolved THEN 0 ELSE 1 END) AS BIGINT) AS open_tickets,
    {_MEAN} AS avg_tat,
    CAST(sum(CASE WHEN sla_breached THEN 1 ELSE 0 END) AS DOUBLE)
      / nullif(sum(CASE WHEN is_resolved THEN 1 ELSE 0 END), 0) AS sla_breach_rate"""

_AGENT_SIDES = f"""{_FACT},
assigned AS (
  SELECT created_date AS ops_date, agent_id,
    count(ticket_id) AS tickets_assigned,
    CAST(sum(CASE WHEN is_resolved THEN 0 ELSE 1 END) AS BIGINT) AS open_tickets_from_day
  FROM fact GROUP BY created_date, agent_id
),
resolved AS (
  SELECT resolved_date AS ops_date, agent_id,
    count(ticket_id) AS tickets_resolved,
    {_MEAN} AS avg_resolution_hours,
    CAST(coalesce(sum(CAST(sla_breached AS INTEGER)), 0) AS BIGINT) AS sla_breaches
  FROM fact WHERE is_resolved GROUP BY resolved_date, agent_id
)"""

_TEXT_ID = "CAST({0} AS VARCHAR) AS {0}"
_TICKET_ID, _AGENT_ID = _TEXT_ID.format("ticket_id"), _TEXT_ID.format("agent_id")


def _agent_load(match: str, agent: str) -> str:
    return f"""WITH {_AGENT_SIDES}
SELECT
  coalesce(a.ops_date, r.ops_date) AS ops_date,
  {agent} AS agent_id,
  coalesce(tickets_assigned, 0) AS tickets_assigned,
  coalesce(tickets_resolved, 0) AS tickets_resolved,
  avg_resolution_hours,
  coalesce(sla_breaches, 0) AS sla_breaches,
  coalesce(open_tickets_from_day, 0) AS open_tickets_from_day
FROM assigned a FULL OUTER JOIN resolved r
  ON a.ops_date {match} r.ops_date AND a.agent_id {match} r.agent_id"""


_EITHER_AGENT = "coalesce(a.agent_id, r.agent_id)"
_EITHER_AGENT_TEXT = f"CAST({_EITHER_AGENT} AS VARCHAR)"
_EQUAL, _SAME = "=", "IS NOT DISTINCT FROM"

_SOURCE_COLUMNS = (
    "created_at, resolved_at, resolution_hours, sla_hours, sla_breached, priority, category, "
    "channel, customer_tier, status"
)
_FACT_COLUMNS = (
    "created_at, resolved_at, created_date, resolved_date, is_resolved, resolution_hours_clean, "
    "sla_hours, sla_breached, priority, category, channel, customer_tier, status"
)

_SOURCE_TEXT_IDS = f"WITH {_TICKETS} SELECT {_TICKET_ID}, {_SOURCE_COLUMNS}, {_AGENT_ID} FROM tickets"
_LANDED = f"""WITH {_TICKETS}
SELECT {_TICKET_ID}, {_SOURCE_COLUMNS}, {_AGENT_ID},
  TIMESTAMP '2024-03-01 00:00:00' AS _ingestion_ts,
  strftime(created_at, '%Y-%m-%d') AS _source_file"""
_SCANNED = f"{_LANDED}, CAST(created_at AS DATE) AS source_date FROM tickets"
_FACT_TEXT_IDS = f"WITH {_FACT} SELECT {_TICKET_ID}, {_FACT_COLUMNS}, {_AGENT_ID} FROM fact"

_FEATURES = f"WITH {_FACT} SELECT created_date AS ops_date, {_KPI} FROM fact GROUP BY created_date"
_BACKLOG = f"""WITH {_FACT}
SELECT created_date AS ops_date,
  CAST(sum(CASE WHEN resolved_at IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS backlog_size
FROM fact GROUP BY created_date"""


def _risk(ticket_id: str, agent_id: str) -> str:
    return f"""WITH {_FACT}
SELECT {ticket_id}, created_at AS created_at_ts, created_date, priority, category, {agent_id},
  resolution_hours_clean, sla_hours, sla_breached,
  strftime(created_at, '%a') AS day_of_week,
  CAST(hour(created_at) AS INTEGER) AS hour_of_day,
  coalesce(priority IN ('Critical', 'High'), false) AS is_high_priority,
  coalesce(resolution_hours_clean > sla_hours, false) AS is_long_resolution
FROM fact"""


_RUNNING = f"""WITH {_FACT},
moves AS (
  SELECT created_date AS ops_date, 1 AS created, 0 AS resolved FROM fact
  UNION ALL
  SELECT resolved_date, 0, 1 FROM fact WHERE is_resolved
),
days AS (
  SELECT ops_date,
    CAST(sum(created) AS BIGINT) AS created_tickets,
    CAST(sum(resolved) AS BIGINT) AS resolved_tickets
  FROM moves GROUP BY ops_date
)
SELECT ops_date, created_tickets, resolved_tickets,
  CAST(sum(created_tickets - resolved_tickets) OVER (
    ORDER BY ops_date NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
  ) AS BIGINT) AS running_backlog
FROM days"""

_LOAD_TEXT_IDS = _agent_load(_EQUAL, _EITHER_AGENT_TEXT)
_RISK_TEXT_IDS = _risk(_TICKET_ID, _AGENT_ID)

_LOG = f"""WITH {_FACT}
SELECT created_date AS simulation_date,
  TIMESTAMP '2024-03-01 00:00:00' AS ingestion_timestamp,
  count(*) AS rows_ingested
FROM fact GROUP BY created_date"""

_AGGREGATES = f"""WITH {_FACT}
SELECT created_date AS ops_date, {_KPI},
  CAST(sum(CASE WHEN resolved_at IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS backlog_size,
  count(DISTINCT agent_id) AS distinct_agents
FROM fact GROUP BY created_date"""
_PER_AGENT = f"""WITH {_FACT}
SELECT created_date AS ops_date, count(*) AS total_tickets, count(DISTINCT agent_id) AS distinct_agents,
  CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT agent_id), 0) AS tickets_per_agent
FROM fact GROUP BY created_date"""


def _of_orders(sql: str) -> str:
    """The same over the tickets seen in `orders`."""
    return sql.replace(_TICKETS, _ORDER_TICKETS)


ORACLE_SQL: dict[str, str] = {
    "ticket_source": f"WITH {_TICKETS} SELECT * FROM tickets",
    "fact_tickets": f"WITH {_FACT} SELECT * FROM fact",
    "resolved_tickets": f"WITH {_FACT} SELECT * FROM fact WHERE is_resolved",
    "month_slice": f"""WITH {_ORDER_TICKETS}
SELECT *, CAST(date_trunc('month', created_at) AS DATE) AS month
FROM tickets WHERE month(created_at) % 2 = 0""",
    "features_daily": _FEATURES,
    "backlog_daily": _BACKLOG,
    "daily_aggregates": _AGGREGATES,
    "assigned_per_agent": f"WITH {_AGENT_SIDES} SELECT * FROM assigned",
    "resolved_per_agent": f"WITH {_AGENT_SIDES} SELECT * FROM resolved",
    "tickets_per_agent": _PER_AGENT,
    "daily_agent_load": _agent_load(_EQUAL, _EITHER_AGENT),
    "daily_agent_load_null_safe": _agent_load(_SAME, _EITHER_AGENT),
    "ticket_sla_risk": _risk("ticket_id", "agent_id"),
    "running_backlog": _RUNNING,
    "rows_per_day": f"""WITH {_FACT}
SELECT created_date, count(*) AS rows_loaded FROM fact GROUP BY created_date""",
    "rows_per_month": f"""WITH {_ORDER_TICKETS}
SELECT CAST(date_trunc('month', created_at) AS DATE) AS month, count(*) AS rows_loaded
FROM tickets GROUP BY ALL""",
    "days_without_tickets": f"""WITH {_FACT},
bounds AS (SELECT min(created_date) AS first, max(resolved_date) AS last FROM fact)
SELECT CAST(d.day AS DATE) AS created_date
FROM bounds, LATERAL (SELECT unnest(generate_series(first, last, INTERVAL 1 DAY)) AS day) d
WHERE CAST(d.day AS DATE) NOT IN (SELECT created_date FROM fact)""",
    "day_files_scan": _SCANNED,
    "month_files_scan": _SCANNED,
    "extract_scan": _SOURCE_TEXT_IDS,
    "agent_list_scan": f"""WITH {_TICKETS}
SELECT {_AGENT_ID}, CAST(count(*) AS VARCHAR) AS tickets, min(channel) AS first_channel
FROM tickets GROUP BY tickets.agent_id""",
    "export_accounts_for_all": f"""WITH {_ORDER_TICKETS},
seen AS (SELECT *, CAST(ticket_id AS BIGINT) AS id, CAST(ticket_id AS BIGINT) % 97 = 0 AS odd FROM tickets),
kept AS (SELECT * FROM seen WHERE odd OR year(created_at) = 2023)
SELECT (SELECT count(*) FROM seen WHERE NOT odd AND year(created_at) = 2023) AS exported,
  (SELECT count(*) FROM seen WHERE NOT odd AND year(created_at) <> 2023) AS out_of_range,
  (SELECT count(*) FROM seen WHERE odd) AS unreadable,
  (SELECT count(*) FROM kept) AS rows_written,
  (SELECT count(*) FROM kept WHERE id % 89 = 0) AS odd_hours_kept,
  (SELECT count(*) FROM kept WHERE odd) AS odd_times_kept""",
    "empty_slice": """SELECT CAST(0 AS BIGINT) AS exported, count(*) AS out_of_range,
  CAST(0 AS BIGINT) AS unreadable, CAST(0 AS BIGINT) AS files FROM events""",
    "backfill_tickets_raw": f"{_LANDED} FROM tickets",
    "backfill_rows_by_month": f"""WITH {_ORDER_TICKETS}
SELECT month, CASE WHEN month <> '2023-05' THEN n END AS rows_loaded, month = '2023-05' AS failed
FROM (SELECT strftime(created_at, '%Y-%m') AS month, count(*) AS n FROM tickets GROUP BY ALL)""",
    "backfill_odd_names": _FACT_TEXT_IDS,
    "failed_backfill_keeps_raw": f"{_LANDED} FROM tickets",
    "failed_rebuild_keeps_facts": _FACT_TEXT_IDS,
    "rebuild_fact_tickets": _FACT_TEXT_IDS,
    "published_features_daily": _FEATURES,
    "published_daily_ops_metrics": _FEATURES,
    "published_backlog_daily": _BACKLOG,
    "published_daily_agent_load": _LOAD_TEXT_IDS,
    "published_ticket_sla_risk": _RISK_TEXT_IDS,
    "upkeep_fact_tickets": _FACT_TEXT_IDS,
    "upkeep_features_daily": _FEATURES,
    "upkeep_daily_ops_metrics": _FEATURES,
    "upkeep_backlog_daily": _BACKLOG,
    "upkeep_running_backlog": _RUNNING,
    "upkeep_daily_agent_load": _LOAD_TEXT_IDS,
    "upkeep_agent_load_null_safe": _agent_load(_SAME, _EITHER_AGENT_TEXT),
    "upkeep_ticket_sla_risk": _RISK_TEXT_IDS,
    "ingestion_log": _LOG,
    "next_day": f"""WITH {_FACT}
SELECT CAST(max(created_date) + INTERVAL 1 DAY AS DATE) AS next_day FROM fact""",
    "next_day_past_end": f"""WITH {_FACT}
SELECT next_day FROM (
  SELECT CAST(max(created_date) + INTERVAL 1 DAY AS DATE) AS next_day, max(created_date) AS last FROM fact
) WHERE next_day <= last""",
    "date_exists": f"""WITH {_FACT},
bounds AS (SELECT min(created_date) AS first, max(created_date) AS last FROM fact)
SELECT CAST(d.day AS DATE) AS created_date,
  CAST(d.day AS DATE) IN (SELECT created_date FROM fact) AS there
FROM bounds, LATERAL (
  SELECT unnest(generate_series(first - INTERVAL 3 DAY, last + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS day
) d""",
    "half_loaded_features_daily": _FEATURES,
    "published_after_each_day": _LOAD_TEXT_IDS,
    "unrecorded_days": f"""WITH {_FACT},
bounds AS (SELECT min(created_date) AS first, max(created_date) AS last FROM fact)
SELECT CAST(d.day AS DATE) AS simulation_date
FROM bounds, LATERAL (
  SELECT unnest(generate_series(first - INTERVAL 3 DAY, last + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS day
) d
WHERE CAST(d.day AS DATE) NOT IN (SELECT created_date FROM fact)""",
    "repaired_fact_tickets": _FACT_TEXT_IDS,
    "repaired_features_daily": _FEATURES,
    "repaired_daily_agent_load": _LOAD_TEXT_IDS,
    "stream_fact_tickets": _FACT_TEXT_IDS,
    "stream_features_daily": _FEATURES,
    "stream_daily_agent_load": _LOAD_TEXT_IDS,
    "arrivals_fact_tickets": _FACT_TEXT_IDS,
    "arrivals_features_daily": _FEATURES,
    "arrivals_redelivered_facts": _FACT_TEXT_IDS,
    "upkeep_daily_aggregates": _AGGREGATES,
    "upkeep_tickets_per_agent": _PER_AGENT,
    "many_loads_features_daily": _of_orders(_FEATURES),
    "many_loads_fact_tickets": _of_orders(_FACT_TEXT_IDS),
    "compacted_fact_tickets": _FACT_TEXT_IDS,
    "compacted_daily_agent_load": _LOAD_TEXT_IDS,
    "balanced_running_backlog": f"""WITH running AS ({_of_orders(_RUNNING)}),
last AS (SELECT date_trunc('quarter', max(created_at)) + INTERVAL 3 MONTH AS stop FROM ({_of_orders(f"WITH {_TICKETS} SELECT * FROM tickets")}))
SELECT running.*, CAST(date_trunc('quarter', ops_date) AS DATE) AS quarter FROM running, last WHERE ops_date < stop""",
    "mixed_headers_fact_tickets": _FACT_TEXT_IDS,
    "mixed_headers_regions": f"""WITH {_TICKETS}
SELECT CAST(created_at AS DATE) AS created_date,
  CASE WHEN day(created_at) % 3 = 2 THEN 'r' || CAST(ticket_id % 5 AS VARCHAR) END AS region, count(*) AS tickets
FROM tickets GROUP BY ALL""",
    "messy_fact_tickets": _FACT_TEXT_IDS.replace(
        "event_type AS category", """event_type || chr(10) || '"é",' || chr(13) || chr(10) || ' ' AS category"""
    ),
    "messy_quarantine": f"""WITH {_TICKETS}
SELECT CAST(created_at AS DATE) AS source_date, count(*) AS records, min(record) AS first_record FROM (
  SELECT created_at, CASE WHEN ticket_id % 11 = 0 THEN ticket_id || ',cut off'
    WHEN ticket_id % 13 = 0 THEN ticket_id || repeat(',x', 12) END AS record FROM tickets
) WHERE record IS NOT NULL GROUP BY ALL""",
    "late_facts_fact_tickets": _FACT_TEXT_IDS,
    "late_facts_features_daily": _FEATURES,
    "late_facts_backlog_daily": _BACKLOG,
    "late_facts_running_backlog": _RUNNING,
    "late_facts_daily_agent_load": _LOAD_TEXT_IDS,
    "late_facts_ticket_sla_risk": _RISK_TEXT_IDS,
    "late_facts_replaced_versions": f"""WITH {_FACT},
last AS (SELECT max(created_date) AS day FROM fact)
SELECT created_date, count(*) AS replaced FROM fact, last
WHERE least(resolved_date, day) > created_date GROUP BY ALL""",
    "arrivals_daily_agent_load": _LOAD_TEXT_IDS,
    "arrivals_ingestion_state": _LOG,
}
