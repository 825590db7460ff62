"""From landed raw tickets to every derived table, for some days or for all."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ticketloom.operators.clean import fact_tickets
from ticketloom.operators.sla_risk import ticket_sla_risk
from ticketloom.operators.ticket_days import sum_rows, ticket_rows
from ticketloom.plans.store import TicketStore, run_together


def agent_partials(fact: DataFrame) -> DataFrame:
    """Partial sums per source day, side, day and agent."""
    return sum_rows(ticket_rows(fact, "source_date"), "source_date", "side", "ops_date", "agent_id")


def day_partials(agent_sums: DataFrame) -> DataFrame:
    """The same without the agent: a few rows per source day."""
    return sum_rows(agent_sums, "source_date", "side", "ops_date")


def derive(store: TicketStore, load: str, raw: DataFrame) -> None:
    """Write one load of every derived table from raw rows.

    Each step reads the table the step before wrote, not a cached frame: nothing
    is held in executor memory, and a lost executor costs only its own tasks. Raw rows
    already lie by source day, so the two ticket-grained tables are written without a
    shuffle. The partial sums shuffle once to be summed.
    """
    if "_malformed" in raw.columns:
        raw = raw.where("_malformed is null")
    store.write("fact_tickets", load, fact_tickets(raw, ("source_date",)))

    def risk():
        fact = store.read_load("fact_tickets", load)
        store.write("ticket_sla_risk", load, ticket_sla_risk(fact, ("source_date",)))

    def sums():
        by_agent = agent_partials(store.read_load("fact_tickets", load))
        # Sorted within files, so that a filter on the day skips row groups.
        store.write("agent_partials", load, by_agent.sortWithinPartitions("source_date", "ops_date", "agent_id"))
        by_day = day_partials(store.read_load("agent_partials", load))
        store.write("day_partials", load, by_day)

    run_together([risk, sums])
