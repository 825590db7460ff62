"""The jobs a user runs: daily run, catch-up, backfill, rebuild, reset."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ticketloom.plans.late import commit_days
from ticketloom.plans.marts import derive
from ticketloom.plans.store import TicketStore
from ticketloom.schema import CREATED, TICKET_TYPES
from ticketloom.sources.day_files import (
    TYPED_COLUMNS,
    DayFiles,
    Delivery,
    listed_days,
    listed_month,
    read_files,
    with_ingestion_time,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadResult:
    """``unread`` counts, per column, the cells whose text did not fit the type;
    ``malformed`` the records kept aside because their cells do not match the header.
    ``overtaken`` names days that another writer loaded meanwhile and this load replaced."""

    days: list[date]
    rows: int = 0
    unread: dict[str, int] = field(default_factory=dict)
    malformed: int = 0
    overtaken: tuple[date, ...] = ()


@dataclass(frozen=True)
class DayResult:
    day: date
    status: str  # loaded | past_end
    rows: int = 0
    unread: dict[str, int] = field(default_factory=dict)
    malformed: int = 0


@dataclass
class BackfillResult:
    rows_by_month: dict[str, int] = field(default_factory=dict)
    failed_months: dict[str, str] = field(default_factory=dict)
    unread: dict[str, int] = field(default_factory=dict)
    malformed: int = 0

    @property
    def rows(self) -> int:
        return sum(self.rows_by_month.values())


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _calendar(store: TicketStore, days: Column) -> DataFrame:
    return store.spark.range(1).select(F.explode(days).alias("simulation_date"))


# -- progress ------------------------------------------------------------------


def next_day(store: TicketStore, start: date | None = None) -> date:
    """The day after the last recorded one, or ``start`` when none is recorded."""
    last = store.recorded().agg(F.max("simulation_date")).first()[0]
    if last is None and start is None:
        raise ValueError("no day is recorded yet: name the first one")
    return start if last is None else last + timedelta(days=1)


def next_day_frame(store: TicketStore, start: date, end: date | None = None) -> DataFrame:
    """``next_day`` as a one-row frame; no row if it lies past ``end``."""
    after_last = F.date_add(F.max("simulation_date"), 1)
    found = store.recorded().agg(F.coalesce(after_last, F.lit(start)).alias("next_day"))
    return found if end is None else found.where(F.col("next_day") <= F.lit(end))


def date_exists(store: TicketStore, days: Sequence[date]) -> DataFrame:
    """(created_date, there): whether any raw ticket of a complete day was created then.

    Only the folders of these creation days are read.
    """
    asked = _calendar(store, F.array(*[F.lit(d) for d in days])).toDF("created_date")
    wanted = store.rows("tickets_raw").where(F.col("created_date").isin(list(days)))
    found = wanted.select("created_date").distinct().withColumn("there", F.lit(True))
    return asked.join(found, "created_date", "left").fillna(False, ["there"])


def unrecorded_days(store: TicketStore, start: date, end: date) -> DataFrame:
    """Days of ``start..end`` that have no progress row."""
    every_day = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return _calendar(store, every_day).join(store.recorded(), "simulation_date", "left_anti")


def ingestion_log(store: TicketStore) -> DataFrame:
    """Recorded days, newest first."""
    return store.table("ingestion_state").orderBy(F.desc("simulation_date"))


def _records(store: TicketStore, days: Sequence[date], sums: DataFrame, at: datetime) -> DataFrame:
    """Progress rows. Row counts come from the stored day sums, which count every
    loaded ticket once, on its creation side."""
    loaded = sums.where(F.col("side") == CREATED).select(
        F.col("source_date").alias("simulation_date"), "tickets"
    )
    # Every asked-for day gets a row, also one without tickets.
    asked = _calendar(store, F.array(*[F.lit(d) for d in days])).withColumn(
        "tickets", F.lit(0).cast("bigint")
    )
    return (
        asked.unionByName(loaded)
        .groupBy("simulation_date")
        .agg(
            F.lit(at).cast("timestamp").alias("ingestion_timestamp"),
            F.sum("tickets").alias("rows_ingested"),
        )
    )


# -- loading -------------------------------------------------------------------


@dataclass(frozen=True)
class _Landed:
    extra: list[str]
    rows: int
    unread: dict[str, int]
    malformed: int


def _land(store: TicketStore, load: str, raw: DataFrame | None, at: datetime) -> _Landed:
    """Write raw rows; their extra columns, number, unread cells by column, and records
    kept aside.

    All are counted while writing, instead of scanning once more.
    """
    if raw is None:
        store.write("tickets_raw", load, store._empty("tickets_raw"))
        return _Landed([], 0, {}, 0)
    seen, good = Observation(), F.col("_malformed").isNull()
    counts = [F.count_if(F.col("_unread")[c].isNotNull()).alias(c) for c in TYPED_COLUMNS]
    counts += [F.count_if(good).alias("rows"), F.count_if(~good).alias("malformed")]
    landing = with_ingestion_time(raw, at).withColumn("created_date", F.to_date("created_at"))
    store.write("tickets_raw", load, landing.observe(seen, *counts))
    got = seen.get
    extra = [c for c in raw.columns if c not in (*TICKET_TYPES, "_unread", "_malformed", "_source_file", "source_date")]
    return _Landed(extra, got["rows"], {c: got[c] for c in TYPED_COLUMNS if got[c]}, got["malformed"])


def _landed_rows(store: TicketStore, load: str) -> DataFrame:
    """(simulation_date, landed_rows) of a load, from the row counts in its files."""
    raw = store.read_load("tickets_raw", load)
    return raw.groupBy(F.col("source_date").alias("simulation_date")).agg(F.count(F.lit(1)).alias("landed_rows"))


def deliveries(store: TicketStore, found: Sequence[Delivery]) -> DataFrame:
    """Listed files as a frame (path, modified, length, day)."""
    rows = [(f.path, datetime.fromtimestamp(f.modified_ms / 1000, timezone.utc), f.length, f.day) for f in found]
    return store.spark.createDataFrame(rows, "path string, modified timestamp, length bigint, day date")


def load_days(
    store: TicketStore,
    files: DayFiles,
    days: Sequence[date],
    skip_missing: bool = False,
    ingested_at: datetime | None = None,
) -> LoadResult:
    """Load the files of some days in one set of Spark jobs, replacing what those
    days had loaded before.

    The days' records are written last: until then readers keep what they had, and a
    load that breaks off anywhere changes nothing.
    """
    at, days, base = ingested_at or _now(), list(days), store.head()
    found = listed_days(store.spark, files, days, skip_missing)
    load = store.new_load()
    raw = read_files(store.spark, files, found) if found else None
    landed = _land(store, load, raw, at)
    derive(store, load, store.read_load("tickets_raw", load))
    records = _records(store, days, store.read_load("day_partials", load), at)
    if landed.malformed:
        records = records.join(_landed_rows(store, load), "simulation_date", "left").fillna(0, ["landed_rows"])
    else:
        records = records.withColumn("landed_rows", F.col("rows_ingested"))
    loads = {c: F.lit(load) for c in ("raw_load", "fact_load", "sums_load")}
    records = records.withColumns({**loads, "extra_columns": F.lit(landed.extra).cast("array<string>")})
    overtaken = commit_days(store, records, load, base).overtaken
    if overtaken:
        log.warning("another writer had loaded %s meanwhile; this load replaced it", ", ".join(map(str, overtaken)))
    if found:
        store.note_files(deliveries(store, found))
    return LoadResult(days, landed.rows, landed.unread, landed.malformed, overtaken)


def run_day(
    store: TicketStore,
    files: DayFiles,
    day: date | None = None,
    start: date | None = None,
    end: date | None = None,
    skip_missing: bool = False,
    ingested_at: datetime | None = None,
) -> DayResult:
    """Load one day and bring every table up to date.

    Without ``day``, the next unrecorded day is taken, ``start`` if none is recorded; a
    named day is loaded again even if it is recorded. Nothing happens past ``end``.
    """
    day = day or next_day(store, start)
    if end is not None and day > end:
        return DayResult(day, "past_end")
    result = load_days(store, files, [day], skip_missing, ingested_at)
    return DayResult(day, "loaded", result.rows, result.unread, result.malformed)


def load_in_parts(store, files, days, skip_missing, ingested_at, days_per_load) -> list[date]:
    for i in range(0, len(days), days_per_load):
        load_days(store, files, days[i : i + days_per_load], skip_missing, ingested_at)
    return days


def catch_up(
    store: TicketStore,
    files: DayFiles,
    start: date | None = None,
    end: date | None = None,
    skip_missing: bool = False,
    ingested_at: datetime | None = None,
    days_per_load: int = 31,
) -> list[date]:
    """Load every unrecorded day of ``start..end``, oldest first, gaps included.

    Without ``start`` the first recorded day begins; without ``end`` every day from
    there on that has a file is meant.
    """
    if start is None:
        start = store.recorded().agg(F.min("simulation_date")).first()[0]
        if start is None:
            raise ValueError("no day is recorded yet: name the first one")
    if end is None:
        there = sorted({f.day for f in files.all(store.spark) if f.day >= start})
        known = {r[0] for r in store.recorded().select("simulation_date").collect()}
        days = [d for d in there if d not in known]
    else:
        rows = unrecorded_days(store, start, end).orderBy("simulation_date").collect()
        days = [row[0] for row in rows]
    return load_in_parts(store, files, days, skip_missing, ingested_at, days_per_load)


def backfill(
    store: TicketStore,
    files: DayFiles,
    year: int,
    start_month: int = 1,
    end_month: int = 12,
    ingested_at: datetime | None = None,
) -> BackfillResult:
    """Land the raw tickets of a range of months, one Spark write per month.

    Days that have a file are replaced, other days keep what they have. A month that
    fails is reported, changes nothing and does not stop the others. Derived tables, and
    what readers see, follow with ``rebuild``.
    """
    result = BackfillResult()
    at = ingested_at or _now()
    for month in range(start_month, end_month + 1):
        label = f"{year:04d}-{month:02d}"
        try:
            found = listed_month(store.spark, files, year, month)
            load = store.new_load()
            landed = _land(store, load, read_files(store.spark, files, found), at)
            days = sorted({f.day for f in found})
            records = _calendar(store, F.array(*[F.lit(d) for d in days])).withColumns(
                {
                    "ingestion_timestamp": F.lit(at).cast("timestamp"),
                    "raw_load": F.lit(load),
                    "extra_columns": F.lit(landed.extra).cast("array<string>"),
                }
            )
            rows = _landed_rows(store, load)
            store.commit(records.join(rows, "simulation_date", "left").fillna(0, ["landed_rows"]))
            store.note_files(deliveries(store, found))
            result.rows_by_month[label] = landed.rows
            result.malformed += landed.malformed
            for column, cells in landed.unread.items():
                result.unread[column] = result.unread.get(column, 0) + cells
        except Exception as error:  # any failure belongs to its month alone
            log.error("month %s was not loaded: %s", label, error)
            result.failed_months[label] = str(error)
    return result


def rebuild(store: TicketStore, publish_to: str | None = None) -> dict[str, str]:
    """Recompute all derived tables from the raw rows of every landed day and record
    these days; if asked, publish the day-level results.

    Readers keep the old tables until all new ones are there. A day that another writer
    lands or loads meanwhile stays as that writer left it.
    """
    base, landed = store.head(), store.landed()
    if not landed.isEmpty():
        load = store.new_load()
        derive(store, load, store.rows("tickets_raw", landed))
        days = [r[0] for r in landed.select("simulation_date").collect()]
        sums = store.read_load("day_partials", load)
        counted = _records(store, days, sums, _now()).drop("ingestion_timestamp")
        kept = landed.select("simulation_date", "ingestion_timestamp", "landed_rows", "raw_load", "extra_columns")
        records = kept.join(counted, "simulation_date")
        loads = {"fact_load": F.lit(load), "sums_load": F.lit(load)}
        left = commit_days(store, records.withColumns(loads), load, base, keep_newer=True).overtaken
        if left:
            log.warning("%s changed during the rebuild and stay as they were committed", ", ".join(map(str, left)))
    return store.publish(publish_to) if publish_to else {}


def touched_days(store: TicketStore, days: Sequence[date]) -> list[date | None]:
    """The ``ops_date``s that some source days count on."""
    mine = store.recorded().where(F.col("simulation_date").isin(list(days)))
    touched = store.rows("day_partials", mine).select("ops_date")
    late = store.late_rows("late_partials")
    if late is not None:
        # What replaced versions of the same creation days counted on.
        own = set().union(*(store.creation_days(r.fact_load, r.simulation_date) for r in mine.collect()))
        touched = touched.union(late.where(F.col("created_date").isin(sorted(own))).select("ops_date"))
    return [r[0] for r in touched.distinct().collect()]


def publish_days(store: TicketStore, out: str, days: Sequence[date], before: Sequence[date | None] = ()) -> dict[str, str]:
    """Bring published copies up to date after some source days were loaded.

    ``before`` names the ``ops_date``s these days counted on until then.
    """
    return store.publish(out, days=sorted({*touched_days(store, days), *before}, key=str))


def reset_day(store: TicketStore, day: date) -> None:
    """Take a day out of every table, all at once."""
    gone = _calendar(store, F.array(F.lit(day))).withColumn("ingestion_timestamp", F.lit(_now()).cast("timestamp"))
    commit_days(store, gone, None)
