"""Table upkeep driven by files as they arrive, also again or corrected."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame

from ticketloom.plans.jobs import deliveries, load_in_parts
from ticketloom.plans.store import TicketStore
from ticketloom.sources.day_files import DayFiles


def new_deliveries(store: TicketStore, files: DayFiles) -> DataFrame:
    """(path, modified, length, day) of files that are new, or are not as they were loaded.

    A delivery is known by its path, time and length, so a corrected file under its old
    path is new again.
    """
    listed = deliveries(store, files.all(store.spark))
    return listed.join(store.loaded_files(), ["path", "modified", "length"], "left_anti")


def load_arrivals(
    store: TicketStore, files: DayFiles, ingested_at: datetime | None = None, days_per_load: int = 31
) -> list[date]:
    """Load every day that has a new delivery, whole, in place of what it had.

    Instead of a cursor over the calendar, the arrival of a file decides which day is
    loaded, so a day delivered again, in part or corrected, ends as it was last delivered.
    """
    days = [r[0] for r in new_deliveries(store, files).select("day").distinct().orderBy("day").collect()]
    return load_in_parts(store, files, days, False, ingested_at, days_per_load)
