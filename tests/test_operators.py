import random
from datetime import date, datetime
from fractions import Fraction

import pytest
from helpers import (
    TICKET_DDL,
    brute_agent_load,
    brute_features,
    in_order,
    random_tickets,
    resolved_day,
    rows_of,
    ticket,
)
from pyspark.sql import functions as F

from ticketloom.functions.exact_hours import mean_hours, split_hours
from ticketloom.operators import agent_load, calendar, daily
from ticketloom.operators.clean import fact_tickets
from ticketloom.operators.sla_risk import ticket_sla_risk
from ticketloom.operators.ticket_days import created_rows, sum_rows, ticket_rows
from ticketloom.schema import FACT_COLUMNS


def facts(spark, tickets, partitions=5):
    raw = spark.createDataFrame(rows_of(tickets), TICKET_DDL).repartition(partitions)
    return fact_tickets(raw)


def one(spark, **cells):
    return facts(spark, [ticket(**cells)]).first()


def test_fact_columns(spark):
    assert facts(spark, [ticket()]).columns == FACT_COLUMNS


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("11/1/23 8:15", date(2023, 11, 1)),
        ("11/01/23 08:15", date(2023, 11, 1)),
        ("11/1/2023 8:15", None),
        ("  ", None),
        ("", None),
        ("2023-11-01 08:15:00", None),
        ("2/30/23 8:15", None),
        ("11/1/23 24:15", None),
    ],
)
def test_resolved_text(spark, text, day):
    row = one(spark, resolved_at=text, resolution_hours=5.0)
    assert row.is_resolved is True
    assert row.resolved_date == day
    assert row.resolution_hours_clean == 5.0


def test_open_ticket_has_no_hours_whatever_its_status(spark):
    row = one(spark, resolved_at=None, resolution_hours=5.0, status="Resolved")
    assert (row.is_resolved, row.resolved_date, row.resolution_hours_clean) == (False, None, None)


@pytest.mark.parametrize(
    ("cells", "high", "long"),
    [
        ({"priority": "Critical"}, True, False),
        ({"priority": "high"}, False, False),
        ({"priority": None}, False, False),
        ({"resolved_at": "11/2/23 8:15", "resolution_hours": 24.0}, False, False),
        ({"resolved_at": "11/2/23 8:15", "resolution_hours": 24.01}, False, True),
        ({"resolved_at": "11/2/23 8:15", "resolution_hours": 99.0, "sla_hours": None}, False, False),
        ({"resolved_at": None, "resolution_hours": 99.0}, False, False),
    ],
)
def test_risk_flags(spark, cells, high, long):
    row = ticket_sla_risk(facts(spark, [ticket(**cells)])).first()
    assert (row.is_high_priority, row.is_long_resolution) == (high, long)
    assert (row.day_of_week, row.hour_of_day) == ("Wed", 9)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    tickets = random_tickets(seed)
    fact = facts(spark, tickets).cache()
    by_day = brute_features(tickets)

    features = daily.features_daily(created_rows(fact)).collect()
    assert in_order(features) == in_order((d, *m) for d, m in by_day.items())

    backlog = daily.backlog_daily(created_rows(fact)).collect()
    assert in_order(backlog) == in_order((d, m[2]) for d, m in by_day.items())

    for null_safe in (False, True):
        load = agent_load.daily_agent_load(ticket_rows(fact), null_safe).collect()
        assert in_order(load) == in_order(brute_agent_load(tickets, null_safe))

    running = daily.running_backlog(ticket_rows(fact)).collect()
    still_open = sum(t["resolved_at"] is None for t in tickets)
    assert running[-1].running_backlog == still_open
    for row in running:
        if row.ops_date is not None:
            born = sum(bool(t["created_at"]) and t["created_at"].date() <= row.ops_date for t in tickets)
            gone = sum((resolved_day(t["resolved_at"]) or date.max) <= row.ops_date for t in tickets)
            assert row.running_backlog == born - gone
    fact.unpersist()


@pytest.mark.parametrize("seed", [4, 5])
def test_partial_sums_in_any_split_give_the_same_result(spark, seed):
    rows = ticket_rows(facts(spark, random_tickets(seed, 400))).cache()
    keys = ("side", "ops_date", "agent_id")
    split = rows.withColumn("part", F.pmod(F.hash("ids", "hours_micro", "agent_id"), F.lit(3)))
    parts = [sum_rows(split.where(F.col("part") == i), *keys) for i in (2, 0, 1)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    for finish in (daily.features_daily, daily.running_backlog, agent_load.daily_agent_load):
        assert in_order(finish(merged).collect()) == in_order(finish(rows).collect())
    rows.unpersist()


def test_day_with_nothing_resolved(spark):
    row = daily.features_daily(created_rows(facts(spark, [ticket(sla_breached=True)]))).first()
    assert (row.total_tickets, row.resolved_tickets, row.avg_tat, row.sla_breach_rate) == (1, 0, None, None)


def test_breach_rate_may_exceed_one(spark):
    done = ticket(resolved_at="11/1/23 12:00", sla_breached=True)
    row = daily.features_daily(created_rows(facts(spark, [done, ticket(sla_breached=True)]))).first()
    assert row.sla_breach_rate == 2.0


def test_distinct_agents_ignores_null(spark):
    tickets = [ticket(agent_id=a) for a in ("a", "a", "b", None)]
    assert daily.daily_aggregates(created_rows(facts(spark, tickets))).first().distinct_agents == 2


def mean_of(spark, values, partitions=4):
    df = spark.createDataFrame([(v,) for v in values], "h double").repartition(partitions)
    parts = df.selectExpr(*[f"{sql} AS {name}" for name, sql in split_hours("h").items()])
    return parts.agg(F.expr(mean_hours()).alias("m")).first().m


def test_mean_is_exact_in_any_order(spark):
    # Ten times 0.1 is not 1.0 when doubles are added one by one.
    assert mean_of(spark, [0.1] * 10) == 0.1
    values = [i / 100 for i in range(1, 2000)]
    assert mean_of(spark, values, 7) == mean_of(spark, values[::-1], 3) == 10.0


def test_means_of_many_groups_are_the_exact_ones(spark):
    rng = random.Random(11)
    values = [(rng.randint(1, 50), f"{rng.randint(0, 10**rng.randint(1, 9)) / 100:.2f}") for _ in range(5000)]
    df = spark.createDataFrame([(g, float(v)) for g, v in values], "g int, h double").repartition(9)
    parts = df.selectExpr("g", *[f"{sql} AS {name}" for name, sql in split_hours("h").items()])
    for group, mean in parts.groupBy("g").agg(F.expr(mean_hours())).collect():
        exact = [Fraction(v) for g, v in values if g == group]
        assert mean == float(sum(exact)) / len(exact)


def test_mean_of_odd_values(spark):
    assert mean_of(spark, [None, None]) is None
    assert mean_of(spark, [None, -1.25]) == -1.25
    assert mean_of(spark, [1 / 3, 2 / 3]) == pytest.approx(0.5, abs=1e-15)
    assert mean_of(spark, [1e-9, 3e-9]) == pytest.approx(2e-9, rel=1e-12)
    assert mean_of(spark, [1e18, 3e18]) == 2e18
    assert mean_of(spark, [float("inf"), 1.0]) == float("inf")
    assert str(mean_of(spark, [float("nan"), 1.0])) == "nan"


def test_month_bounds():
    assert calendar.month_bounds(2023, 12) == (date(2023, 12, 1), date(2024, 1, 1))
    assert calendar.month_bounds(2023, 1) == (date(2023, 1, 1), date(2023, 2, 1))
    assert calendar.month_bounds(2023) == (date(2023, 1, 1), date(2024, 1, 1))


def test_time_slice_is_half_open(spark):
    times = [datetime(2023, 10, 31, 23, 59, 59), datetime(2023, 11, 1), datetime(2023, 12, 1), None]
    df = spark.createDataFrame([(t,) for t in times], "created_at timestamp")
    sliced = calendar.time_slice(df, "created_at", *calendar.month_bounds(2023, 11)).collect()
    assert [r.created_at for r in sliced] == [datetime(2023, 11, 1)]
