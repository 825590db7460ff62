"""Stored tables: Parquet, written as loads and made visible by a state record.

A load writes its rows of every table into new folders. Nothing that readers see is
touched until one small record says, per source day, which loads hold the day's rows; a
load that breaks off before it leaves every table as it was. The source day is the unit
of replacement: a record of a later load takes the day over in all tables at once.

Day-level results are not stored. They are finished at read time from additive partial
sums, which makes a daily run cost one day, never history.
"""

from __future__ import annotations

import functools
import json
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.operators.agent_load import daily_agent_load, tickets_per_agent
from ticketloom.operators.daily import backlog_daily, daily_aggregates, features_daily, running_backlog
from ticketloom.operators.ticket_days import sum_rows
from ticketloom.plans import balances
from ticketloom.plans.numbered_log import NumberedLog
from ticketloom.schema import (
    FACT_COLUMNS,
    LATE_TABLES,
    LOAD_COLUMN,
    MEASURES,
    PARTITIONS,
    ROWS_COLUMN,
    RISK_COLUMNS,
    STATE_COLUMNS,
    TABLES,
    TICKET_TYPES,
)
from ticketloom.sources import folders

# Results with rows per day; the ticket-grained risk table is read where it is stored.
DAY_MARTS = ("features_daily", "daily_ops_metrics", "backlog_daily", "daily_agent_load")
MARTS = (*DAY_MARTS, "ticket_sla_risk")
# A day and its load are about 50 bytes.
DAYS_TO_BROADCAST = 100_000
# So many creation days are told apart by a filter on folders.
LATE_DAYS_APART = 1000
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"

VIEWS = (
    "tickets_raw", "tickets_quarantine", "fact_tickets", *MARTS, "running_backlog", "daily_aggregates",
    "tickets_per_agent", "ingestion_state",
)

# The state of each store as of the last reading of its log: a few rows per calendar day.
_STATES: dict[tuple[str, str], tuple] = {}


@dataclass(frozen=True)
class Commit:
    """``number`` is None where nothing was left to commit."""

    number: int | None
    overtaken: tuple[date, ...] = ()


def _month_folder(month: date | None) -> str:
    return f"ops_month={month or _NO_MONTH}"


def run_together(actions: Sequence[Callable[[], object]], threads: int = 4) -> None:
    """Independent Spark actions at the same time; the first failure is raised
    when all have ended."""
    free = threading.Semaphore(threads)
    errors: list[BaseException] = []

    def attempt(action: Callable[[], object]) -> None:
        with free:
            try:
                action()
            except BaseException as error:  # handed to the caller's thread
                errors.append(error)

    running = [InheritableThread(target=attempt, args=(action,)) for action in actions]
    for thread in running:
        thread.start()
    for thread in running:
        thread.join()
    if errors:
        raise errors[0]


@dataclass(frozen=True)
class TicketStore:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], TABLES[name])

    # -- loads -------------------------------------------------------------------

    @staticmethod
    def new_load() -> str:
        return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def write(self, name: str, load: str, df: DataFrame) -> None:
        """Write a load's rows of a table. Readers do not see them before ``commit``."""
        writer = df.write
        places = ["created_date"] if name in LATE_TABLES else PARTITIONS[name]
        if places:
            writer = writer.partitionBy(*places)
        writer.parquet(f"{self.path(name)}/load={load}")

    def _schema(self, name: str, extra: Sequence[str] = ()) -> T.StructType:
        schema = T._parse_datatype_string(TABLES[name])
        inner = [T.StructField(c, T.StringType()) for c in extra]
        return T.StructType(inner + schema.fields + [T.StructField("load", T.StringType())])

    def read_load(self, name: str, load: str, extra: Sequence[str] = ()) -> DataFrame:
        """What one load wrote to a table, recorded or not."""
        return self._read(name, [f"load={load}"], extra).drop("load")

    def read_loads(self, name: str) -> DataFrame:
        """What all loads wrote to a table, recorded or not, and which load it was."""
        return self.spark.read.schema(self._schema(name)).parquet(self.path(name))

    def _read(self, name: str, places: Sequence[str], extra: Sequence[str]) -> DataFrame:
        path = self.path(name)
        reader = self.spark.read.schema(self._schema(name, extra)).option("basePath", path)
        return reader.parquet(*[f"{path}/{place}" for place in sorted(places)])

    # -- state -------------------------------------------------------------------

    def log(self, name: str = "ingestion_state") -> NumberedLog:
        return NumberedLog(self.spark, self.path(name), TABLES[name])

    def _newest(self) -> tuple[list[Row], list[Row], list[Row]]:
        """(landed, recorded, late): the newest record of every day, of every day that is
        complete in all tables, and of every creation day that other days' files have
        tickets of. The log is read again only when it has grown."""
        log = self.log()
        listing = log.listing()
        key = (self.spark.sparkContext.applicationId, self.root)
        held = _STATES.get(key)
        if held is None or held[0] != listing.stamp:
            landed: dict[date, Row] = {}
            complete: dict[date, Row] = {}
            late: dict[date, Row] = {}
            # A few rows per calendar day.
            for row in sorted(log.records(listing).collect(), key=lambda r: r.seq):
                if row.creation_day is not None:
                    late[row.creation_day] = row
                    continue
                landed[row.simulation_date] = row
                if row.fact_load is not None or row.raw_load is None:
                    complete[row.simulation_date] = row
            held = _STATES[key] = (
                listing.stamp,
                [r for r in landed.values() if r.raw_load is not None],
                [r for r in complete.values() if r.fact_load is not None],
                list(late.values()),
            )
        return held[1], held[2], held[3]

    def records(self, rows: list[Row]) -> DataFrame:
        """Rows of the state as a frame, to read tables as of them."""
        return self.spark.createDataFrame(rows, TABLES["ingestion_state"])

    def recorded(self) -> DataFrame:
        """The current record of every day that is complete in all tables, one row per
        calendar day, as it is now."""
        return self.records(self._newest()[1])

    def snapshot(self) -> DataFrame:
        """The whole state as it is now: tables read with it agree with each other whatever
        is loaded meanwhile."""
        return self.records(self.current())

    def current(self) -> list[Row]:
        """The rows of ``snapshot``: some per calendar day."""
        _, complete, late = self._newest()
        return complete + late

    def late_days(self) -> dict[date, Row]:
        """Creation days that other days' files have tickets of, with their record."""
        return {row.creation_day: row for row in self._newest()[2]}

    def creation_days(self, load: str, day: date) -> set[date]:
        """The creation days of a source day's facts in a load, from their folders' names."""
        names = folders.children(self.spark, f"{self.path('fact_tickets')}/load={load}/source_date={day}")
        found = {name.removeprefix("created_date=") for name in names if name.startswith("created_date=")}
        return {date.fromisoformat(name) for name in found if not name.startswith("__HIVE")}

    def landed(self) -> DataFrame:
        """The current record of every day whose raw rows have landed, derived or not."""
        return self.records(self._newest()[0])

    def head(self) -> int:
        """The number of the last commit."""
        return self.log().listing().head

    def commit(
        self, records: DataFrame, base: int | None = None, keep_newer: bool = False, expect: int | None = None
    ) -> Commit:
        """Make loads visible: append records of days, all of them at once.

        A record without ``fact_load`` lands raw rows only; one without any load takes
        the day out of every table. Commits are numbered, and the later one has a day.

        ``base`` names the last commit (``head``) that the writer knew of. Days that other
        writers have committed since are returned as ``overtaken``; with ``keep_newer``
        they stay as those writers left them. With ``expect`` nothing is committed unless
        that is still the last commit.
        """
        columns = [f for f in T._parse_datatype_string(TABLES["ingestion_state"]) if f.name != "seq"]
        records = records.select(
            *[(F.col(f.name) if f.name in records.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns]
        )
        line = F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
        rows = records.select("simulation_date", line.alias("line")).collect()  # one per day
        log = self.log()
        while True:
            listing = log.listing()
            if expect is not None and listing.head != expect:
                return Commit(None)
            overtaken: set[date] = set()
            if base is not None and listing.since(base):
                since = log.records(listing, after=base).select("simulation_date").distinct()
                overtaken = ({r[0] for r in since.collect()} & {r.simulation_date for r in rows}) - {None}
            lines = [r.line for r in rows if not (keep_newer and r.simulation_date in overtaken)]
            if not lines:
                return Commit(None, tuple(sorted(overtaken)))
            number = log.append(lines, listing.head)
            if number is not None:
                break
        log.keep_short(lambda: self.landed().unionByName(self.snapshot()).distinct())
        return Commit(number, tuple(sorted(overtaken)))

    def note_files(self, files: DataFrame) -> None:
        """Remember the deliveries (path, modified, length, day) that have been loaded."""
        line = F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
        lines = [r[0] for r in files.select(line).collect()]
        log = self.log("loaded_files")
        while log.append(lines, log.listing().head) is None:
            pass
        log.keep_short(self.loaded_files)

    def loaded_files(self) -> DataFrame:
        """The latest delivery loaded of every path."""
        noted = self.log("loaded_files").records()
        whole = F.struct(*noted.columns)
        return noted.groupBy("path").agg(F.max_by(whole, "seq").alias("r")).select("r.*")

    # -- reading -----------------------------------------------------------------

    def rows(self, name: str, records: DataFrame | None = None) -> DataFrame:
        """A stored table's rows of all complete days, or of other records' days.

        Tables that lie by day are read from the folders that hold the days now, and
        from no others. The sums of a load lie together, so they are joined with the
        days that the load still holds. Neither plan grows with the number of days.
        """
        column, counted = LOAD_COLUMN[name], ROWS_COLUMN.get(name)
        # One row per day.
        held = self._newest()[1] if records is None else records.collect()
        held = [r for r in held if r[column] is not None and (counted is None or r[counted] != 0)]
        if not held:
            return self._empty(name)
        extra: dict[str, None] = {}
        if name == "tickets_raw":
            extra = dict.fromkeys(c for r in held for c in r["extra_columns"] or ())
        if PARTITIONS[name]:
            days = [f"load={r[column]}/source_date={r['simulation_date']}" for r in held]
            return self._read(name, days, list(extra)).drop("load")
        now = self.spark.createDataFrame([(r[column], r["simulation_date"]) for r in held], "load string, source_date date")
        if len(held) <= DAYS_TO_BROADCAST:
            now = F.broadcast(now)
        stored = self._read(name, sorted({f"load={r[column]}" for r in held}), [])
        return stored.join(now, ["load", "source_date"], "left_semi").drop("load")

    def late_rows(self, name: str, records: DataFrame | None = None) -> DataFrame | None:
        """What is stored about replaced versions of tickets; None if there are none."""
        held = self._newest()[2] if records is None else records.where("creation_day is not null").collect()
        held = [r for r in held if r.landed_rows]
        if not held:
            return None
        return self._read(name, [f"load={r.late_load}/created_date={r.creation_day}" for r in held], []).drop("load")

    def sums(self, name: str, records: DataFrame | None = None) -> DataFrame:
        """Partial sums in which every ticket counts once, as its latest version has it.

        The replaced versions are taken back by adding their negated sums; keys that
        nothing is left of go.
        """
        rows, late = self.rows(name, records), self.late_rows("late_partials", records)
        if late is None:
            return rows
        keys = ["side", "ops_date", "agent_id"] if name == "agent_partials" else ["side", "ops_date"]
        both = rows.select(*keys, *MEASURES).unionByName(late.select(*keys, *MEASURES))
        return sum_rows(both, *keys).where("tickets <> 0")

    def latest(self, name: str, records: DataFrame | None = None) -> DataFrame:
        """A table of one row per ticket, without the versions that a later day's file
        replaced. Only creation days that have such versions are joined with them."""
        rows, late = self.rows(name, records), self.late_rows("late_versions", records)
        if late is None:
            return rows
        held = self._newest()[2] if records is None else records.where("creation_day is not null").collect()
        days = [r.creation_day for r in held if r.landed_rows]
        if len(days) > LATE_DAYS_APART:
            return rows.join(late, ["ticket_id", "source_date", "created_date"], "left_anti")
        apart = F.coalesce(F.col("created_date").isin(days), F.lit(False))
        kept = rows.where(apart).join(late, ["ticket_id", "source_date", "created_date"], "left_anti")
        return rows.where(~apart).unionByName(kept)

    def table(self, name: str, records: DataFrame | None = None) -> DataFrame:
        """A table as its users know it, complete days only."""
        days, agents = "day_partials", "agent_partials"

        def raw() -> DataFrame:
            rows = self.rows("tickets_raw", records).where("_malformed is null")
            own = [*TICKET_TYPES, "_unread", "_malformed", "_ingestion_ts", "_source_file", "source_date", "created_date"]
            extra = [c for c in rows.columns if c not in own]
            return rows.select(*TICKET_TYPES, *[f"`{c}`" for c in extra], "_unread", "_ingestion_ts", "_source_file")

        views = {
            "tickets_raw": raw,
            "tickets_quarantine": lambda: self.rows("tickets_raw", records)
            .where("_malformed is not null")
            .selectExpr("source_date", "_source_file", "_malformed AS record", "_ingestion_ts"),
            "fact_tickets": lambda: self.latest("fact_tickets", records).select(*FACT_COLUMNS),
            "ticket_sla_risk": lambda: self.latest("ticket_sla_risk", records).select(*RISK_COLUMNS),
            "features_daily": lambda: features_daily(self.sums(days, records)),
            "daily_ops_metrics": lambda: features_daily(self.sums(days, records)),
            "backlog_daily": lambda: backlog_daily(self.sums(days, records)),
            "running_backlog": lambda: running_backlog(self.sums(days, records)),
            "daily_agent_load": lambda: daily_agent_load(self.sums(agents, records)),
            "daily_aggregates": lambda: daily_aggregates(self.sums(agents, records)),
            "tickets_per_agent": lambda: tickets_per_agent(self.sums(agents, records)),
            "ingestion_state": lambda: (self.recorded() if records is None else records)
            .where("simulation_date is not null")
            .select(*STATE_COLUMNS),
        }
        return views[name]()

    def register_views(self) -> None:
        """Make every table, as it is now, available to spark.sql under its own name."""
        now = self.snapshot()
        for name in VIEWS:
            self.table(name, now).createOrReplaceTempView(name)

    # -- upkeep --------------------------------------------------------------------

    def vacuum(self, older_than_hours: float = 24.0) -> list[str]:
        """Remove the folders of loads that no current record names, if old enough that
        no reader or unfinished load uses them. Returns the removed paths."""
        records = self.landed().unionByName(self.recorded())
        rows = records.select("raw_load", "fact_load", "sums_load").distinct().collect()  # two a day at most
        late = {row.late_load for row in self._newest()[2]}
        covered = balances.loads_covered(self)
        before = time.time_ns() - int(older_than_hours * 3600e9)
        removed = []
        for name in (*PARTITIONS, *LATE_TABLES):
            named = late if name in LATE_TABLES else {row[LOAD_COLUMN[name]] for row in rows}
            if name in ("day_partials", "late_partials"):
                named = named | covered
            for child in folders.children(self.spark, self.path(name)):
                load = child.removeprefix("load=")
                if child != load and load not in named and int(load.split("-")[0]) < before:
                    removed.append(f"{self.path(name)}/{child}")
                    folders.remove(self.spark, removed[-1])
        for name in ("ingestion_state", "loaded_files"):
            self.log(name).trim(older_than_hours)
        return removed + balances.vacuum(self, older_than_hours)

    def compact(self, until: date) -> int:
        """Rewrite the complete days up to ``until`` in all tables, one load per month.

        Many daily loads leave as many small files and folders; afterwards a day is one
        folder with few files, and a month's sums lie together. A day that another writer
        loads meanwhile keeps that load, and days that have landed anew but are not
        derived yet are left alone. Months that lie in one load already are skipped.
        Returns how many days were rewritten.
        """
        base = self.head()
        landed, complete, _ = self._newest()
        waiting = {r.simulation_date for r in landed} - {r.simulation_date for r in complete}
        newest = {r.simulation_date: r.seq for r in landed}
        months: dict[date, list[Row]] = {}
        for row in complete:
            day = row.simulation_date
            if day <= until and day not in waiting and newest.get(day) == row.seq:
                months.setdefault(day.replace(day=1), []).append(row)
        done = 0
        for _, rows in sorted(months.items()):
            if len({load for r in rows for load in (r.raw_load, r.fact_load, r.sums_load)}) > 1:
                done += self._compact_days(rows, base)
        return done

    def _compact_days(self, rows: list[Row], base: int) -> int:
        load, fixed = self.new_load(), self.records(rows)

        def rewrite(name: str) -> None:
            stored = self.rows(name, fixed)
            if PARTITIONS[name]:
                stored = stored.hint("rebalance", *PARTITIONS[name])
            else:
                stored = stored.repartitionByRange("source_date", "ops_date").sortWithinPartitions("source_date", "ops_date")
            self.write(name, load, stored)

        run_together([functools.partial(rewrite, name) for name in PARTITIONS])
        loads = {c: F.lit(load) for c in ("raw_load", "fact_load", "sums_load")}
        return len(rows) - len(self.commit(fixed.withColumns(loads), base, keep_newer=True).overtaken)

    # -- publishing ----------------------------------------------------------------

    def publish(
        self, out: str, names: Sequence[str] = DAY_MARTS, days: Sequence[date | None] | None = None, threads: int = 4
    ) -> dict[str, str]:
        """Plain-Parquet copies of day-level results for readers outside Spark.

        They lie by month in folders of their own for every publication. An entry in
        ``out/publications`` says last of all, for every result at once, which folders hold
        its months; a publication that breaks off before changes nothing, and a reader of
        the newest entry sees all results of one state. With ``days`` (of ``ops_date``) only
        the months these fall in are written again, the others stay where they are.
        Returns the folder of each result; ``published`` reads it.
        """
        months = None if days is None else {_month_folder(d and d.replace(day=1)) for d in days}
        while True:
            version, log = self.new_load(), self._publications(out)
            before, places = self._newest_publication(log)
            now, state = self.snapshot(), self.head()
            run_together([functools.partial(self._copy, out, version, name, now, months) for name in names], threads)
            lines = [json.dumps({"state": state, "version": version})]
            for name in sorted({*places, *names}):
                kept = places.get(name, {})
                if name in names:
                    kept = {} if months is None else {m: v for m, v in kept.items() if m not in months}
                    folder = f"{out}/{name}/version={version}"
                    kept |= {m: version for m in folders.children(self.spark, folder) if m.startswith("ops_month=")}
                lines += [json.dumps({"name": name, "month": m, "version": v}) for m, v in sorted(kept.items())]
                lines += [json.dumps({"name": name})]
            # Another publication that came first may know a newer state: start again from it.
            if log.append(lines, before) is not None:
                return {name: f"{out}/{name}" for name in names}

    def _copy(self, out: str, version: str, name: str, now: DataFrame, months: set[str] | None) -> None:
        result = self.table(name, now).withColumn("ops_month", F.trunc("ops_date", "month"))
        if months is not None:
            folder = F.concat(F.lit("ops_month="), F.coalesce(F.col("ops_month").cast("string"), F.lit(_NO_MONTH)))
            result = result.where(folder.isin(sorted(months)))
        result.hint("rebalance", "ops_month").write.partitionBy("ops_month").parquet(f"{out}/{name}/version={version}")

    def _publications(self, out: str) -> NumberedLog:
        return NumberedLog(self.spark, f"{out}/publications", "name string, month string, version string, seq bigint")

    def _newest_publication(self, log: NumberedLog) -> tuple[int, dict[str, dict[str, str]]]:
        """(number, result -> month -> version)."""
        listing = log.listing()
        places: dict[str, dict[str, str]] = {}
        if listing.entries:
            for line in folders.read_text(self.spark, listing.entries[listing.head]).splitlines():
                entry = json.loads(line)
                if "name" in entry:
                    own = places.setdefault(entry["name"], {})
                    own |= {entry["month"]: entry["version"]} if "month" in entry else {}
        return listing.head, places

    def published(self, out: str, name: str) -> DataFrame:
        """A published copy as of the newest publication."""
        months = self._newest_publication(self._publications(out))[1][name]
        schema = self.table(name, self.records([])).schema
        if not months:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{out}/{name}")
        paths = [f"{out}/{name}/version={version}/{month}" for month, version in sorted(months.items())]
        return reader.parquet(*paths).select(*schema.names)

    def vacuum_published(self, out: str, older_than_hours: float = 24.0) -> list[str]:
        """Remove what the newest publication does not name, if old enough that no reader
        or unfinished publication uses it. Returns the removed paths."""
        log = self._publications(out)
        number, places = self._newest_publication(log)
        before, removed = time.time_ns() - int(older_than_hours * 3600e9), []
        for name, months in places.items():
            for child in folders.children(self.spark, f"{out}/{name}"):
                version = child.removeprefix("version=")
                if version == child or int(version.split("-")[0]) >= before:
                    continue
                inside = folders.children(self.spark, f"{out}/{name}/{child}")
                if not any(months.get(m) == version for m in inside):
                    removed.append(f"{out}/{name}/{child}")
                else:
                    unused = [m for m in inside if m.startswith("ops_month=") and months.get(m) != version]
                    removed += [f"{out}/{name}/{child}/{m}" for m in unused]
        for path, modified, _ in folders.matching(self.spark, f"{log.path}/entry-*.json"):
            if int(path[-25:-5]) < number and modified * 1_000_000 < before:
                removed.append(path)
        for path in removed:
            folders.remove(self.spark, path)
        return removed
