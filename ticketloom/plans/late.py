"""Tickets that come again in a later day's file.

A ticket is known by its id and its creation day. Of its versions the one from the latest
source day counts, in whatever order the files were loaded; the others are replaced. What
they had counted for is stored per creation day as negated partial sums, and their keys
beside it, so a change costs the creation days it touches, never history. Rows without an
id, or with a creation day that cannot be read, are tickets of their own.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ticketloom.operators.ticket_days import sum_rows, ticket_rows
from ticketloom.plans.store import Commit, TicketStore
from ticketloom.schema import MEASURES

FEW_DAYS = 1000


def replaced_versions(facts: DataFrame) -> DataFrame:
    """Facts of which a later source day has another version.

    Only tickets that some file of another day than their creation day holds can have
    several versions, so only these are shuffled. A ticket that one file holds twice
    counts twice, as it always did.
    """
    key = ["ticket_id", "created_date"]
    late = facts.where("source_date <> created_date").select(*key).distinct()
    several = facts.join(late, key, "left_semi")
    newest = F.max("source_date").over(Window.partitionBy(*key))
    return several.withColumn("_newest", newest).where("source_date < _newest").drop("_newest")


def touched_creation_days(store: TicketStore, days: Iterable[date], load: str | None) -> set[date]:
    """Creation days whose versions change when source days get a new load, or none."""
    late, days = store.late_days(), set(days)
    before = {r.simulation_date: r.fact_load for r in store._newest()[1] if r.simulation_date in days}
    touched = days & set(late)
    for day in days:
        for some in {load, before.get(day)} - {None}:
            touched |= store.creation_days(some, day) - {day}
    return touched


def _replaced(store: TicketStore, complete: list[Row], touched: set[date]) -> DataFrame:
    """Records of creation days, their replaced versions written under a new load."""
    load = store.new_load()
    facts = store.rows("fact_tickets", store.records(complete))
    if len(touched) <= FEW_DAYS:
        facts = facts.where(F.col("created_date").isin(sorted(touched)))
    replaced = replaced_versions(facts)
    store.write("late_versions", load, replaced.select("ticket_id", "source_date", "created_date"))
    versions = store.read_load("late_versions", load)
    own = facts.join(versions, ["ticket_id", "source_date", "created_date"], "left_semi").withColumn(
        "created_on", F.col("created_date")
    )
    sums = sum_rows(ticket_rows(own, "created_on"), "side", "ops_date", "agent_id", "created_on")
    negated = sums.withColumns({m: -F.col(m) for m in MEASURES}).withColumnRenamed("created_on", "created_date")
    store.write("late_partials", load, negated)
    counted = versions.groupBy(F.col("created_date").alias("creation_day")).agg(F.count(F.lit(1)).alias("landed_rows"))
    days = store.spark.createDataFrame([(day,) for day in sorted(touched)], "creation_day date")
    return days.join(counted, "creation_day", "left").fillna(0, ["landed_rows"]).withColumn("late_load", F.lit(load))


def commit_days(
    store: TicketStore, records: DataFrame, load: str | None, base: int | None = None, keep_newer: bool = False
) -> Commit:
    """Commit records of source days together with what they change about late facts.

    If another writer commits in between, the late facts are worked out again.
    """
    empty = store.records([])
    new = empty.unionByName(records, allowMissingColumns=True).collect()  # one per day
    records, days = store.records(new), {r.simulation_date for r in new}
    while True:
        head = store.head()
        touched = touched_creation_days(store, days, load)
        entry = records
        if touched:
            complete = [r for r in store._newest()[1] if r.simulation_date not in days]
            complete += [r for r in new if r.fact_load is not None]
            entry = records.unionByName(_replaced(store, complete, touched), allowMissingColumns=True)
        done = store.commit(entry, base, keep_newer, expect=head)
        if done.number is not None or store.head() == head:
            return done
