"""Per-agent daily load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.exact_hours import mean_hours
from ticketloom.schema import CREATED, RESOLVED


def assigned_per_agent(fact: DataFrame) -> DataFrame:
    """Tickets that came in for an agent on a day, and how many are still open."""
    return fact.groupBy(F.col("created_date").alias("ops_date"), "agent_id").agg(
        F.count("ticket_id").alias("tickets_assigned"),
        F.count_if(~F.col("is_resolved")).alias("open_tickets_from_day"),
    )


def tickets_per_agent(rows: DataFrame) -> DataFrame:
    """Mean tickets per agent of each creation day: tickets over distinct agents.

    Takes creation rows, all ticket rows, or partial sums of them per agent. Null on a day
    whose tickets have no agent at all.
    """
    created = rows.where(f"side = '{CREATED}'")
    per_agent = created.groupBy("ops_date", "agent_id").agg(F.sum("tickets").alias("n"))
    per_day = per_agent.groupBy("ops_date").agg(
        F.sum("n").alias("total_tickets"), F.count("agent_id").alias("distinct_agents")
    )
    return per_day.withColumn("tickets_per_agent", F.expr("try_divide(total_tickets, distinct_agents)"))


def resolved_per_agent(rows: DataFrame) -> DataFrame:
    """Tickets an agent closed on a day, their mean hours and their breaches.

    Takes resolution rows, all ticket rows, or partial sums of them.
    """
    return (
        rows.where(f"side = '{RESOLVED}'")
        .groupBy("ops_date", "agent_id")
        .agg(
            F.sum("ids").alias("tickets_resolved"),
            F.expr(f"{mean_hours()} AS avg_resolution_hours"),
            F.sum("breached").alias("sla_breaches"),
        )
    )


def daily_agent_load(rows: DataFrame, null_safe: bool = False) -> DataFrame:
    """Both sides of an agent's day in one row.

    The result is that of a full outer join of the two aggregates above on
    (day, agent), reached with one scan and one shuffle: the sides are summed
    under a common key. A join never matches a null key, so by default a null
    day or agent keeps its two sides as separate rows; ``null_safe`` merges them.

    Takes ticket rows or partial sums of them, in any split.
    """

    def assigned(measure):
        return f"sum(if(side = '{CREATED}', {measure}, 0L))"

    def resolved(measure):
        return f"sum(if(side = '{RESOLVED}', {measure}, 0))"

    keys = ["ops_date", "agent_id"]
    if not null_safe:
        rows = rows.selectExpr(
            "*", "if(ops_date IS NULL OR agent_id IS NULL, side, NULL) AS unmatched_side"
        )
        keys.append("unmatched_side")
    measures = [
        f"{assigned('ids')} AS tickets_assigned",
        f"{resolved('ids')} AS tickets_resolved",
        f"{mean_hours(resolved)} AS avg_resolution_hours",
        f"{resolved('breached')} AS sla_breaches",
        f"{assigned('open')} AS open_tickets_from_day",
    ]
    return rows.groupBy(*keys).agg(*map(F.expr, measures)).drop("unmatched_side")
