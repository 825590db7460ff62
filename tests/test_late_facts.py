"""Tickets that come again in a later day's file count once, as the latest file has them."""

import itertools
import random
from datetime import date, datetime, timedelta

import pytest
from helpers import brute_agent_load, brute_features, in_order, random_tickets, ticket
from test_files_and_jobs import D1, D2, D3, contents, files, new_store, on, put  # noqa: F401

from ticketloom.plans import jobs

RESULTS = ("fact_tickets", "ticket_sla_risk", "features_daily", "backlog_daily", "daily_agent_load",
           "running_backlog", "daily_aggregates", "tickets_per_agent")


def put_versions(files):  # noqa: F811
    put(files, D1, on(D1, ticket_id="a", agent_id="a1"), on(D1, ticket_id="b"), on(D1, ticket_id=""))
    put(files, D2, on(D2, ticket_id="c"), on(D1, ticket_id="a", agent_id="a2", resolved_at="11/2/23 9:00", resolution_hours=24.5))
    put(files, D3, on(D1, ticket_id="a", agent_id="a3", resolved_at="11/3/23 9:00", resolution_hours=48.25, sla_breached=True),
        on(D2, ticket_id="c", resolved_at="11/3/23 10:00", resolution_hours=25.0), on(D1, ticket_id=""))


@pytest.mark.parametrize("order", list(itertools.permutations((D1, D2, D3)))[1::2])
def test_the_latest_file_counts_in_any_order_of_loading(files, new_store, order):  # noqa: F811
    put_versions(files)
    store = new_store()
    for day in order:
        jobs.run_day(store, files, day)
    expected = [on(D1, ticket_id="b"), on(D1, ticket_id=None), on(D1, ticket_id=None),
                on(D1, ticket_id="a", agent_id="a3", resolved_at="11/3/23 9:00", resolution_hours=48.25, sla_breached=True),
                on(D2, ticket_id="c", resolved_at="11/3/23 10:00", resolution_hours=25.0)]
    assert in_order((r.ticket_id, r.agent_id, r.resolved_at) for r in store.table("fact_tickets").collect()) == in_order(
        (t["ticket_id"], t["agent_id"], t["resolved_at"]) for t in expected
    )
    features = {r.ops_date: tuple(r)[1:] for r in store.table("features_daily").collect()}
    assert features == brute_features(expected)
    assert in_order(store.table("daily_agent_load").collect()) == in_order(brute_agent_load(expected, False))
    assert {(r.ops_date, r.distinct_agents) for r in store.table("daily_aggregates").collect()} == {(D1, 2), (D2, 1)}
    assert store.table("ticket_sla_risk").count() == 5 and store.table("tickets_raw").count() == 8


def test_later_versions_are_taken_back_with_their_day(files, new_store):  # noqa: F811
    put_versions(files)
    store, plain = new_store(), new_store("plain")
    for day in (D1, D2, D3):
        jobs.run_day(store, files, day)
    whole = contents(store, RESULTS)
    out = f"{store.root}/out"
    store.publish(out)
    before = jobs.touched_days(store, [D3])
    jobs.reset_day(store, D3)
    jobs.publish_days(store, out, [D3], before)
    for day in (D1, D2):
        jobs.run_day(plain, files, day)
    assert contents(store, RESULTS) == contents(plain, RESULTS) != whole
    assert in_order(store.published(out, "daily_agent_load").collect()) == contents(store, ["daily_agent_load"])["daily_agent_load"]
    jobs.run_day(store, files, D3)
    assert contents(store, RESULTS) == whole
    assert store.compact(D3) == 3 and contents(store, RESULTS) == whole
    store.vacuum(older_than_hours=0)
    assert contents(store, RESULTS) == whole
    bulk = new_store("bulk")
    jobs.backfill(bulk, files, 2023, 11, 11)
    jobs.rebuild(bulk)
    assert contents(bulk, RESULTS) == whole
    # Delivered again without the late rows, the day no longer replaces anything.
    put(files, D2, on(D2, ticket_id="c"))
    put(files, D3)
    jobs.load_days(store, files, [D2, D3])
    facts = {(r.ticket_id, r.resolved_at) for r in store.table("fact_tickets").collect()}
    assert facts == {("a", None), ("b", None), ("c", None), (None, None)}
    assert store.late_rows("late_versions") is None


def test_random_versions_agree_with_brute_force(files, new_store):  # noqa: F811
    rng = random.Random(11)
    days = [date(2023, 11, 1) + timedelta(days=i) for i in range(5)]
    by_day, latest = {day: [] for day in days}, {}
    for i, made in enumerate(random_tickets(5, 60)):
        made["created_at"] = datetime(2023, 11, rng.randint(1, 5), 8)
        made["ticket_id"] = f"t{i}"
        first = made["created_at"].date()
        for day in [first, *rng.sample(days, rng.choice([0, 0, 1, 2]))]:
            if day >= first and not (latest.get(i) and day in latest[i]):
                version = ticket(**made, **{}) | {"agent_id": rng.choice([None, "a1", "a2"]), "resolved_at": rng.choice([None, "11/4/23 9:00"])}
                by_day[day].append(version)
                latest.setdefault(i, {})[day] = version
    for day in days:
        put(files, day, *by_day[day])
    expected = [versions[max(versions)] for versions in latest.values()]
    store = new_store()
    for some in ([days[3]], [days[0], days[4]], [days[1]], [days[2], days[0]]):
        jobs.load_days(store, files, some)
    assert store.table("fact_tickets").count() == len(expected)
    got = {r.ops_date: tuple(r)[1:4] for r in store.table("features_daily").collect()}
    assert got == {day: row[:3] for day, row in brute_features(expected).items()}
    assert in_order(store.table("daily_agent_load").collect()) == in_order(brute_agent_load(expected, False))
