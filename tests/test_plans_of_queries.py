"""What the physical plans must and must not contain."""

import re
from datetime import date

import pytest
from helpers import TICKET_DDL, random_tickets, rows_of
from pyspark.sql import functions as F

from ticketloom.operators import agent_load, calendar, daily
from ticketloom.operators.sla_risk import ticket_sla_risk
from ticketloom.operators.ticket_days import created_rows, resolved_rows, ticket_rows
from ticketloom.plans.marts import derive
from ticketloom.plans.store import TicketStore

# Work that leaves generated code, multiplies rows, or copies a table to every task.
UNWANTED = ("Python", "CartesianProduct", "NestedLoop", "SortAggregate", "Broadcast")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    store = TicketStore(spark, str(tmp_path_factory.mktemp("plans")))
    raw = spark.createDataFrame(rows_of(random_tickets(3)), TICKET_DDL)
    load, day = store.new_load(), date(2023, 11, 1)
    derive(store, load, raw.withColumn("source_date", F.lit(day)))
    loads = {c: F.lit(load) for c in ("raw_load", "fact_load", "sums_load")}
    store.commit(spark.createDataFrame([(day,)], "simulation_date date").withColumns(loads))
    return store


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("build", "shuffles"),
    [
        (lambda f: daily.features_daily(created_rows(f)), 1),
        (lambda f: daily.backlog_daily(created_rows(f)), 1),
        (lambda f: daily.daily_aggregates(created_rows(f)), 2),
        (lambda f: agent_load.daily_agent_load(ticket_rows(f)), 1),
        (lambda f: agent_load.daily_agent_load(ticket_rows(f), null_safe=True), 1),
        (lambda f: agent_load.resolved_per_agent(resolved_rows(f)), 1),
        (lambda f: agent_load.tickets_per_agent(created_rows(f)), 2),
        (lambda f: calendar.days_without_rows(f, "created_date", "resolved_date"), 2),
        (lambda f: daily.running_backlog(ticket_rows(f)), 2),
        (ticket_sla_risk, 0),
    ],
)
def test_one_scan_and_few_shuffles(store, build, shuffles):
    plan = plan_of(build(store.table("fact_tickets")))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == shuffles
    assert not [word for word in UNWANTED if word in plan]


def test_resolved_side_is_not_doubled(store):
    assert "Generate" not in plan_of(agent_load.resolved_per_agent(resolved_rows(store.table("fact_tickets"))))


def test_backlog_reads_one_flag(store):
    plan = plan_of(daily.backlog_daily(created_rows(store.table("fact_tickets"))))
    assert "ReadSchema: struct<is_resolved:boolean>" in plan


def test_day_filter_prunes_directories(store):
    fact = store.table("fact_tickets").where("created_date = date'2023-11-03'")
    plan = plan_of(daily.features_daily(created_rows(fact)))
    assert re.search(r"PartitionFilters: \[[^\]]*created_date#\d+ = 2023-11-03", plan)


def test_day_filter_reaches_the_stored_sums(store):
    load = store.table("daily_agent_load").where("ops_date >= date'2023-11-03'")
    assert "GreaterThanOrEqual(ops_date,2023-11-03)" in plan_of(load)


def test_month_slice_is_pushed_down(store):
    bounds = calendar.month_bounds(2023, 11)
    plan = plan_of(calendar.time_slice(store.table("fact_tickets"), "created_at", *bounds))
    assert "GreaterThanOrEqual(created_at,2023-11-01" in plan
    assert "LessThan(created_at,2023-12-01" in plan
