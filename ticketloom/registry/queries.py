"""Every operator and job as a named query over the given tables.

The file, store and stream queries first derive their input from the tables:
tickets are exported as day files, loaded by the job under test, and the table it
wrote is returned. Such a store is built once per session and read by all queries
about it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators import agent_load, calendar, daily, sla_risk
from ticketloom.operators.clean import fact_tickets
from ticketloom.operators.ticket_days import created_rows, resolved_rows, ticket_rows
from ticketloom.plans import balances, jobs, marts
from ticketloom.plans.store import TicketStore, run_together
from ticketloom.schema import PARTITIONS, TICKET_TYPES
from ticketloom.session import apply_job_conf, new_work_dir
from ticketloom.sources import day_files
from ticketloom.sources.event_tickets import event_tickets
from ticketloom.sources.order_tickets import order_tickets
from ticketloom.streaming.arrivals import load_arrivals
from ticketloom.streaming.day_stream import DayStream

LOADED_AT = datetime(2024, 3, 1, tzinfo=timezone.utc)


# -- what the tables span --------------------------------------------------------


def _once_per_session(build: Callable) -> Callable:
    """Build once per Spark application and table directory."""
    built: dict[tuple[str, str], object] = {}

    @functools.wraps(build)
    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in built:
            built[key] = build(spark, sf_dir)
        return built[key]

    return get


@_once_per_session
def _span(spark, sf_dir) -> tuple[date, date]:
    created = F.to_date("created_at")
    return tuple(event_tickets(spark, sf_dir).agg(F.min(created), F.max(created)).first())


def _all_days(spark, sf_dir) -> list[date]:
    first, last = _span(spark, sf_dir)
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def _months(spark, sf_dir) -> list[tuple[int, int]]:
    return sorted({(day.year, day.month) for day in _all_days(spark, sf_dir)})


@_once_per_session
def _order_months(spark, sf_dir) -> list[tuple[int, int]]:
    months = order_tickets(spark, sf_dir).select(F.trunc("created_at", "month").alias("m")).distinct()
    return sorted((row.m.year, row.m.month) for row in months.collect())


# -- operators on the ticket table ---------------------------------------------


def _fact(spark, sf_dir):
    return fact_tickets(event_tickets(spark, sf_dir))


def ticket_source(spark, sf_dir):
    return event_tickets(spark, sf_dir)


def fact_tickets_query(spark, sf_dir):
    return _fact(spark, sf_dir)


def resolved_tickets(spark, sf_dir):
    return _fact(spark, sf_dir).where("is_resolved")


def month_slice(spark, sf_dir):
    """Every even month of the tickets seen in `orders`, each row with its month."""
    tickets = order_tickets(spark, sf_dir)
    even = [(year, month) for year, month in _order_months(spark, sf_dir) if month % 2 == 0]
    return calendar.month_slices(tickets, "created_at", even)


def features_daily(spark, sf_dir):
    return daily.features_daily(created_rows(_fact(spark, sf_dir)))


def backlog_daily(spark, sf_dir):
    return daily.backlog_daily(created_rows(_fact(spark, sf_dir)))


def daily_aggregates(spark, sf_dir):
    return daily.daily_aggregates(created_rows(_fact(spark, sf_dir)))


def assigned_per_agent(spark, sf_dir):
    return agent_load.assigned_per_agent(_fact(spark, sf_dir))


def resolved_per_agent(spark, sf_dir):
    return agent_load.resolved_per_agent(resolved_rows(_fact(spark, sf_dir)))


def tickets_per_agent(spark, sf_dir):
    return agent_load.tickets_per_agent(created_rows(_fact(spark, sf_dir)))


def daily_agent_load(spark, sf_dir):
    return agent_load.daily_agent_load(ticket_rows(_fact(spark, sf_dir)))


def daily_agent_load_null_safe(spark, sf_dir):
    return agent_load.daily_agent_load(ticket_rows(_fact(spark, sf_dir)), null_safe=True)


def ticket_sla_risk(spark, sf_dir):
    return sla_risk.ticket_sla_risk(_fact(spark, sf_dir))


def running_backlog(spark, sf_dir):
    return daily.running_backlog(ticket_rows(_fact(spark, sf_dir)))


def rows_per_day(spark, sf_dir):
    return calendar.rows_per_day(_fact(spark, sf_dir))


def rows_per_month(spark, sf_dir):
    return calendar.rows_per_month(fact_tickets(order_tickets(spark, sf_dir)))


def days_without_tickets(spark, sf_dir):
    return calendar.days_without_rows(_fact(spark, sf_dir), "created_date", "resolved_date")


# -- day files -----------------------------------------------------------------


def _exported(spark, tickets: DataFrame, label: str) -> day_files.DayFiles:
    return day_files.export_days(tickets, new_work_dir(spark, label)).files


@_once_per_session
def _files(spark, sf_dir) -> day_files.DayFiles:
    return _exported(spark, event_tickets(spark, sf_dir), "day-files")


def _add_bad_file(spark, files: day_files.DayFiles, folder: str) -> None:
    """Deliver a file that is no ticket file."""
    bad = spark.createDataFrame([("x",)], "ticket_id string")
    bad.coalesce(1).write.mode("append").option("header", True).csv(f"{files.base}/{folder}")


def _plain_time(df: DataFrame, column: str) -> DataFrame:
    """Times without a zone, as the SQL side has them."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def _landed(df: DataFrame) -> DataFrame:
    """A landed frame with its file path reduced to the day in it: where the work
    folder lies differs from run to run."""
    in_path = F.regexp_extract("_source_file", r"(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    df = _plain_time(_plain_time(df, "created_at"), "_ingestion_ts").drop("_unread", "_malformed")
    return df.withColumn("_source_file", in_path)


def day_files_scan(spark, sf_dir):
    days = _all_days(spark, sf_dir)
    rows = day_files.read_days(spark, _files(spark, sf_dir), days)
    return _landed(day_files.with_ingestion_time(rows, LOADED_AT))


def month_files_scan(spark, sf_dir):
    files = _files(spark, sf_dir)
    months = [day_files.read_month(spark, files, *month) for month in _months(spark, sf_dir)]
    rows = functools.reduce(DataFrame.unionByName, months)
    return _landed(day_files.with_ingestion_time(rows, LOADED_AT))


def extract_scan(spark, sf_dir):
    path = f"{_files(spark, sf_dir).base}/*"
    return _plain_time(day_files.read_extract(spark, path), "created_at")


def agent_list_scan(spark, sf_dir):
    path = new_work_dir(spark, "agents")
    agents = event_tickets(spark, sf_dir).groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("tickets"), F.min("channel").alias("first_channel")
    )
    agents.write.option("header", True).csv(path)
    return day_files.read_agents(spark, path)


@_once_per_session
def _awkward_extract(spark, sf_dir) -> DataFrame:
    """The tickets seen in `orders` as text, some with cells that do not fit."""
    tickets = order_tickets(spark, sf_dir)
    text = tickets.select(*[F.col(c).cast("string").alias(c) for c in tickets.columns])
    number = F.col("ticket_id").cast("long")
    return text.withColumns(
        {
            "created_at": F.when(number % 97 == 0, "soon").otherwise(F.col("created_at")),
            "resolution_hours": F.when(number % 89 == 0, "7 h").otherwise(F.col("resolution_hours")),
        }
    )


def export_accounts_for_all(spark, sf_dir):
    """What an export of one of two years did with every row of an awkward extract."""
    out = day_files.export_days(_awkward_extract(spark, sf_dir), new_work_dir(spark, "extract"), 2023)
    counts = spark.createDataFrame(
        [(out.exported, out.out_of_range, out.unreadable)], "exported long, out_of_range long, unreadable long"
    )
    rows = day_files.read_extract(spark, f"{out.files.base}/*", typed=False)
    kept = rows.agg(
        F.count(F.lit(1)).alias("rows_written"),
        F.count_if(F.col("resolution_hours") == "7 h").alias("odd_hours_kept"),
        F.count_if(F.col("created_at") == "soon").alias("odd_times_kept"),
    )
    return counts.crossJoin(kept)  # one row each


def empty_slice(spark, sf_dir):
    """An export of a year without tickets writes nothing."""
    out = day_files.export_days(event_tickets(spark, sf_dir), new_work_dir(spark, "empty"), 1999)
    files = len(out.files.all(spark))
    row = [(out.exported, out.out_of_range, out.unreadable, files)]
    return spark.createDataFrame(row, "exported long, out_of_range long, unreadable long, files long")


# -- bulk load and rebuild -----------------------------------------------------


@_once_per_session
def _rebuilt(spark, sf_dir) -> tuple[TicketStore, str]:
    root = new_work_dir(spark, "bulk")
    store = TicketStore(spark, f"{root}/tables")
    for year, month in _months(spark, sf_dir):
        result = jobs.backfill(store, _files(spark, sf_dir), year, month, month, LOADED_AT)
        if result.failed_months:
            raise RuntimeError(f"months not loaded: {result.failed_months}")
    jobs.rebuild(store, publish_to=f"{root}/published")
    return store, f"{root}/published"


def backfill_tickets_raw(spark, sf_dir):
    return _landed(_rebuilt(spark, sf_dir)[0].table("tickets_raw"))


def rebuild_fact_tickets(spark, sf_dir):
    return _plain_time(_rebuilt(spark, sf_dir)[0].table("fact_tickets"), "created_at")


def _published(name: str) -> Callable:
    def read(spark, sf_dir):
        store, out = _rebuilt(spark, sf_dir)
        return store.published(out, name)

    return read


def published_ticket_sla_risk(spark, sf_dir):
    """The ticket-grained table is handed out where it is stored."""
    return _plain_time(_rebuilt(spark, sf_dir)[0].table("ticket_sla_risk"), "created_at_ts")


@_once_per_session
def _order_backfill(spark, sf_dir) -> jobs.BackfillResult:
    """Two years of days, one month with a file that cannot be read."""
    files = _exported(spark, order_tickets(spark, sf_dir), "order-files")
    _add_bad_file(spark, files, "created_date=2023-05-03")
    store = TicketStore(spark, f"{new_work_dir(spark, 'order-backfill')}/tables")
    result = jobs.BackfillResult()
    for year in sorted({year for year, _ in _order_months(spark, sf_dir)}):
        own = jobs.backfill(store, files, year, ingested_at=LOADED_AT)
        result.rows_by_month |= own.rows_by_month
        result.failed_months |= own.failed_months
    landed = store.rows("tickets_raw", store.landed()).count()
    if landed != result.rows:
        raise RuntimeError(f"{landed} rows landed, {result.rows} reported")
    return result


def backfill_rows_by_month(spark, sf_dir):
    result = _order_backfill(spark, sf_dir)
    rows = [(month, rows, False) for month, rows in result.rows_by_month.items()]
    rows += [(month, None, True) for month in result.failed_months]
    return spark.createDataFrame(rows, "month string, rows_loaded long, failed boolean")


@_once_per_session
def _damaged(spark, sf_dir) -> TicketStore:
    """Loaded and rebuilt; then a rebuild meets a raw file that is damaged."""
    store = TicketStore(spark, f"{new_work_dir(spark, 'damaged')}/tables")
    for year, month in _months(spark, sf_dir):
        jobs.backfill(store, _files(spark, sf_dir), year, month, month, LOADED_AT)
    jobs.rebuild(store)
    first = store.landed().orderBy("simulation_date").first()
    day = first["simulation_date"]
    place = f"{store.path('tickets_raw')}/load={first['raw_load']}/source_date={day}/created_date={day}"
    spark.createDataFrame([("damaged",)], "value string").write.mode("append").text(place)
    try:
        jobs.rebuild(store)
    except Exception:  # the damaged file
        return store
    raise RuntimeError("a damaged raw file was read")


def failed_backfill_keeps_raw(spark, sf_dir):
    return _landed(_odd_names(spark, sf_dir).table("tickets_raw"))


@_once_per_session
def _odd_names(spark, sf_dir) -> TicketStore:
    """Loaded and rebuilt; then a month gets a file that cannot be read, and after that
    one that is not named after a day. Both attempts to load the month must fail."""
    files = _exported(spark, event_tickets(spark, sf_dir), "odd-files")
    store = TicketStore(spark, f"{new_work_dir(spark, 'odd')}/tables")
    first = _all_days(spark, sf_dir)[0]
    for attempt in ("whole", f"created_date={first}", f"created_date={first:%Y-%m}-late"):
        if attempt != "whole":
            _add_bad_file(spark, files, attempt)
        for year, month in _months(spark, sf_dir):
            result = jobs.backfill(store, files, year, month, month, LOADED_AT)
            if bool(result.failed_months) != (attempt != "whole" and (year, month) == (first.year, first.month)):
                raise RuntimeError(f"{attempt}: {result}")
        if attempt == "whole":
            jobs.rebuild(store)
    return store


def backfill_odd_names(spark, sf_dir):
    return _plain_time(_odd_names(spark, sf_dir).table("fact_tickets"), "created_at")


def failed_rebuild_keeps_facts(spark, sf_dir):
    return _plain_time(_damaged(spark, sf_dir).table("fact_tickets"), "created_at")


# -- day-at-a-time upkeep ------------------------------------------------------


@_once_per_session
def _kept_up(spark, sf_dir) -> TicketStore:
    """All days loaded incrementally, some days at a time."""
    store = TicketStore(spark, f"{new_work_dir(spark, 'daily')}/tables")
    first, last = _span(spark, sf_dir)
    jobs.catch_up(
        store, _files(spark, sf_dir), first, last, ingested_at=LOADED_AT, days_per_load=10
    )
    return store


@_once_per_session
def _repaired(spark, sf_dir) -> TicketStore:
    """Loaded in part, one day loaded twice, one wiped, then caught up: the result
    must not show it."""
    store = TicketStore(spark, f"{new_work_dir(spark, 'repaired')}/tables")
    files = _files(spark, sf_dir)
    days = _all_days(spark, sf_dir)
    first, last = days[0], days[-1]
    half = days[len(days) // 2]
    jobs.catch_up(store, files, half, last, ingested_at=LOADED_AT)
    jobs.run_day(store, files, half, start=first, end=last, ingested_at=LOADED_AT)
    jobs.reset_day(store, last)
    jobs.catch_up(store, files, first, last, ingested_at=LOADED_AT)
    return store


@_once_per_session
def _half_loaded(spark, sf_dir) -> TicketStore:
    """All days loaded, then a load of some of them that broke off half-way."""
    store = TicketStore(spark, f"{new_work_dir(spark, 'half')}/tables")
    jobs.catch_up(store, _files(spark, sf_dir), *_span(spark, sf_dir), ingested_at=LOADED_AT)
    load = store.new_load()
    for name in ("tickets_raw", "fact_tickets", "day_partials"):
        rows = store.rows(name)
        store.write(name, load, rows.unionByName(rows))
    return store


@_once_per_session
def _published_by_day(spark, sf_dir) -> tuple[TicketStore, str]:
    """Published copies brought up to date after each of several loads."""
    root = new_work_dir(spark, "publish")
    store, days = TicketStore(spark, f"{root}/tables"), _all_days(spark, sf_dir)
    third = len(days) // 3 + 1
    for some in (days[:third], days[third : 2 * third], days[2 * third :], days[third : third + 2]):
        if some:
            before = jobs.touched_days(store, some)
            jobs.load_days(store, _files(spark, sf_dir), some, True, LOADED_AT)
            jobs.publish_days(store, f"{root}/published", some, before)
    return store, f"{root}/published"


def published_after_each_day(spark, sf_dir):
    store, out = _published_by_day(spark, sf_dir)
    return store.published(out, "daily_agent_load")


def date_exists(spark, sf_dir):
    first, last = _span(spark, sf_dir)
    days = [first + timedelta(days=i) for i in range(-3, (last - first).days + 4)]
    return jobs.date_exists(_kept_up(spark, sf_dir), days)


def next_day_past_end(spark, sf_dir):
    """Past the given end there is no next day."""
    first, last = _span(spark, sf_dir)
    return jobs.next_day_frame(_kept_up(spark, sf_dir), first, last)


def _table(store_of: Callable, name: str, *times: str) -> Callable:
    def read(spark, sf_dir):
        df = store_of(spark, sf_dir).table(name)
        return functools.reduce(_plain_time, times, df)

    return read


def upkeep_agent_load_null_safe(spark, sf_dir):
    partials = _kept_up(spark, sf_dir).rows("agent_partials")
    return agent_load.daily_agent_load(partials, null_safe=True)


def ingestion_log(spark, sf_dir):
    return _plain_time(jobs.ingestion_log(_kept_up(spark, sf_dir)), "ingestion_timestamp")


def next_day(spark, sf_dir):
    return jobs.next_day_frame(_kept_up(spark, sf_dir), _span(spark, sf_dir)[0])


def unrecorded_days(spark, sf_dir):
    first, last = _span(spark, sf_dir)
    around = timedelta(days=3)
    return jobs.unrecorded_days(_kept_up(spark, sf_dir), first - around, last + around)


# -- a long history ------------------------------------------------------------


def single_day_loads(store: TicketStore, tickets: DataFrame) -> None:
    """Every day of some tickets as a load of its own, as a daily run leaves them: written
    in one go, so that a history of years can be had in a minute."""
    created = F.col("created_at").cast("timestamp")
    raw = tickets.withColumn("created_at", created).select(
        *[F.col(c).cast(t) for c, t in TICKET_TYPES.items()],
        F.lit(None).cast("map<string,string>").alias("_unread"),
        F.lit(None).cast("string").alias("_malformed"),
        F.lit(LOADED_AT).cast("timestamp").alias("_ingestion_ts"),
        F.lit("made").alias("_source_file"),
        F.to_date("created_at").alias("source_date"),
        F.to_date("created_at").alias("created_date"),
    )
    load = F.format_string("%020d-00000001", F.unix_date("source_date"))

    def write(name: str, rows: DataFrame) -> None:
        rows.withColumn("load", load).write.partitionBy("load", *PARTITIONS[name]).parquet(store.path(name))

    def written(name: str) -> DataFrame:
        return store.read_loads(name).drop("load")

    # Each table is read from the one before it as stored, so the source is read and
    # shuffled once.
    write("tickets_raw", raw.hint("rebalance", "source_date").sortWithinPartitions("source_date", "created_date"))
    write("fact_tickets", fact_tickets(written("tickets_raw"), ("source_date",)))

    def sums() -> None:
        by_agent = marts.agent_partials(written("fact_tickets"))
        write("agent_partials", by_agent.hint("rebalance", "source_date").sortWithinPartitions("source_date"))
        by_day = marts.day_partials(written("agent_partials"))
        write("day_partials", by_day.hint("rebalance", "source_date").sortWithinPartitions("source_date"))

    def risk() -> None:
        write("ticket_sla_risk", sla_risk.ticket_sla_risk(written("fact_tickets"), ("source_date",)))

    run_together([risk, sums])
    days = written("tickets_raw").groupBy(F.col("source_date").alias("simulation_date")).agg(F.count(F.lit(1)).alias("rows_ingested"))
    own = F.format_string("%020d-00000001", F.unix_date("simulation_date"))
    loads = {c: own for c in ("raw_load", "fact_load", "sums_load")}
    at = F.lit(LOADED_AT).cast("timestamp")
    store.commit(days.withColumns(loads | {"landed_rows": F.col("rows_ingested"), "ingestion_timestamp": at}))


@_once_per_session
def _long_history(spark, sf_dir) -> TicketStore:
    """Two years of single-day loads of the tickets seen in `orders`."""
    store = TicketStore(spark, f"{new_work_dir(spark, 'history')}/tables")
    single_day_loads(store, order_tickets(spark, sf_dir))
    return store


@_once_per_session
def _compacted(spark, sf_dir) -> TicketStore:
    """A load per day of `events`, all but the last week compacted; of the rest, one day is
    taken out and written again."""
    store = TicketStore(spark, f"{new_work_dir(spark, 'compacted')}/tables")
    single_day_loads(store, event_tickets(spark, sf_dir))
    last = _all_days(spark, sf_dir)[-1]
    jobs.reset_day(store, last)
    store.compact(last - timedelta(days=7))
    jobs.load_days(store, _files(spark, sf_dir), [last], True, LOADED_AT)
    return store


@_once_per_session
def _balanced(spark, sf_dir) -> TicketStore:
    """Single-day loads of `orders`, without the 15th of any month and with all tickets of
    some days still open; the missing and the wrong days are loaded after a balance was
    struck, half of them before the next one is and half after it."""
    tickets = order_tickets(spark, sf_dir)
    number = F.dayofmonth("created_at")
    wrong = number % 10 == 3
    store = TicketStore(spark, f"{new_work_dir(spark, 'balanced')}/tables")
    first = tickets.where(number != 15).withColumn("resolved_at", F.when(~wrong, F.col("resolved_at")))
    single_day_loads(store, first)
    balances.strike(store)
    files = _exported(spark, tickets.where(wrong | (number == 15)), "balanced-files")
    days = [file.day for file in files.all(spark)]
    days = sorted(set(days))
    jobs.load_days(store, files, days[::2], False, LOADED_AT)
    balances.strike(store)
    jobs.load_days(store, files, days[1::2], False, LOADED_AT)
    return store


def balanced_running_backlog(spark, sf_dir):
    """Every quarter of `orders`, read from the closing balance before it."""
    store, months = _balanced(spark, sf_dir), _order_months(spark, sf_dir)
    starts = sorted({date(year, month - (month - 1) % 3, 1) for year, month in months})
    parts = []
    for first in starts:
        stop = calendar.month_bounds(first.year, first.month + 2)[1]
        rows = balances.running_backlog_between(store, first, stop)
        parts.append(rows.withColumn("quarter", F.lit(first)))
    return functools.reduce(DataFrame.unionByName, parts)


@_once_per_session
def _mixed_headers(spark, sf_dir) -> TicketStore:
    """Days of `events` whose files differ in their headers: by the day of the month the
    columns come as they are, backwards, or with one more column in front."""
    tickets = event_tickets(spark, sf_dir)
    number = F.dayofmonth("created_at") % 3
    base = new_work_dir(spark, "mixed-headers")
    for kind, columns in enumerate((tickets.columns, tickets.columns[::-1], ["region", *tickets.columns])):
        some = tickets.withColumn("region", F.concat(F.lit("r"), F.col("ticket_id") % 5)).where(number == kind)
        files = day_files.export_days(some.select(*columns), base).files
    store = TicketStore(spark, f"{new_work_dir(spark, 'mixed')}/tables")
    for year, month in _months(spark, sf_dir):
        jobs.backfill(store, files, year, month, month, ingested_at=LOADED_AT)
    jobs.rebuild(store)
    return store


def mixed_headers_regions(spark, sf_dir):
    """Tickets per day and value of the column that only some days' files have."""
    raw = _mixed_headers(spark, sf_dir).table("tickets_raw")
    return raw.groupBy(F.to_date("created_at").alias("created_date"), "region").agg(F.count(F.lit(1)).alias("tickets"))


# -- cells and records that are hard to read --------------------------------------


@_once_per_session
def _messy(spark, sf_dir) -> TicketStore:
    """Days whose cells hold line breaks, quotes and commas, each delivered with a second
    file of records that are cut off or too long."""
    text = F.concat("category", F.lit('\n"é",\r\n '))
    tickets = event_tickets(spark, sf_dir)
    files = _exported(spark, tickets.withColumn("category", text), "messy-files")
    number = F.col("ticket_id")
    line = F.when(number % 11 == 0, F.concat(number, F.lit(",cut off")))
    line = line.when(number % 13 == 0, F.concat(number, F.repeat(F.lit(",x"), 12)))
    broken = tickets.select(F.to_date("created_at").alias("created_date"), F.lit(1).alias("place"), line.alias("line"))
    broken = broken.where("line is not null")
    header = broken.select("created_date").distinct().withColumns({"place": F.lit(0), "line": F.lit(",".join(tickets.columns))})
    lines = header.unionByName(broken).repartition("created_date").sortWithinPartitions("created_date", "place")
    lines.drop("place").write.mode("append").partitionBy("created_date").text(files.base)
    store = TicketStore(spark, f"{new_work_dir(spark, 'messy')}/tables")
    jobs.catch_up(store, files, *_span(spark, sf_dir), ingested_at=LOADED_AT)
    return store


def messy_quarantine(spark, sf_dir):
    kept_aside = _messy(spark, sf_dir).table("tickets_quarantine")
    return kept_aside.groupBy("source_date").agg(
        F.count(F.lit(1)).alias("records"), F.min("record").alias("first_record")
    )


# -- late facts ------------------------------------------------------------------


@_once_per_session
def _late(spark, sf_dir) -> TicketStore:
    """A ticket resolved on a later day comes open with its creation day's file and again,
    resolved, with the later one's (the last day's at most). The files are loaded in three
    parts, the last days first; all results must be those of the tickets' final state."""
    tickets, days = event_tickets(spark, sf_dir), _all_days(spark, sf_dir)
    created, last = F.to_date("created_at"), F.lit(days[-1])
    resolved = F.least(F.to_date(F.try_to_timestamp("resolved_at", F.lit("M/d/yy H:mm"))), last)
    later = F.coalesce(resolved > created, F.lit(False))
    first = tickets.withColumns(
        {
            "resolved_at": F.when(~later, F.col("resolved_at")),
            "status": F.when(later, F.lit("Open")).otherwise(F.col("status")),
            "delivered_at": F.col("created_at"),
        }
    )
    again = tickets.where(later).withColumn("delivered_at", resolved.cast("timestamp_ntz"))
    both = first.unionByName(again)
    files = day_files.export_days(both, new_work_dir(spark, "late-files"), timestamp_column="delivered_at").files
    store = TicketStore(spark, f"{new_work_dir(spark, 'late')}/tables")
    third = len(days) // 3 + 1
    for some in (days[2 * third :], days[:third], days[third : 2 * third]):
        if some:
            jobs.load_days(store, files, some, True, LOADED_AT)
    return store


def late_facts_replaced_versions(spark, sf_dir):
    """How many versions of each creation day's tickets later files have replaced."""
    replaced = _late(spark, sf_dir).late_rows("late_versions")
    return replaced.groupBy("created_date").agg(F.count(F.lit(1)).alias("replaced"))


# -- a stream of day files ------------------------------------------------------


@_once_per_session
def _streamed(spark, sf_dir) -> DayStream:
    """All day files through a stream, a few at a time; a second start must add nothing."""
    stream = DayStream(spark, new_work_dir(spark, "stream"))
    first = stream.advance(_files(spark, sf_dir), files_per_batch=8)
    again = stream.advance(_files(spark, sf_dir))
    if not first["facts"] or any(again.values()):
        raise RuntimeError(f"read first {first}, then {again}")
    return stream


# -- arrivals ------------------------------------------------------------------


@_once_per_session
def _kept_up_by_arrival(spark, sf_dir) -> TicketStore:
    """Loaded as files arrive, with a second look that must add nothing."""
    store = TicketStore(spark, f"{new_work_dir(spark, 'arrivals')}/tables")
    for _ in range(2):
        load_arrivals(store, _files(spark, sf_dir), LOADED_AT, days_per_load=20)
    return store


@_once_per_session
def _redelivered(spark, sf_dir) -> TicketStore:
    """Half of the days come with wrong contents first and are delivered again."""
    tickets = event_tickets(spark, sf_dir)
    days = _all_days(spark, sf_dir)
    wrong = F.col("created_at") < F.lit(days[len(days) // 2]).cast("timestamp_ntz")
    first = tickets.where(~wrong | (F.col("ticket_id") % 2 == 0)).withColumn(
        "status", F.when(wrong, F.lit("Wrong")).otherwise(F.col("status"))
    )
    base = new_work_dir(spark, "redelivered")
    store = TicketStore(spark, f"{new_work_dir(spark, 'redelivered')}/tables")
    for delivery in (first, tickets.where(wrong), tickets.where(wrong)):
        load_arrivals(store, day_files.export_days(delivery, base).files, LOADED_AT)
    return store


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ticket_source": ticket_source,
    "fact_tickets": fact_tickets_query,
    "resolved_tickets": resolved_tickets,
    "month_slice": month_slice,
    "features_daily": features_daily,
    "backlog_daily": backlog_daily,
    "daily_aggregates": daily_aggregates,
    "assigned_per_agent": assigned_per_agent,
    "resolved_per_agent": resolved_per_agent,
    "tickets_per_agent": tickets_per_agent,
    "daily_agent_load": daily_agent_load,
    "daily_agent_load_null_safe": daily_agent_load_null_safe,
    "ticket_sla_risk": ticket_sla_risk,
    "running_backlog": running_backlog,
    "rows_per_day": rows_per_day,
    "rows_per_month": rows_per_month,
    "days_without_tickets": days_without_tickets,
    "day_files_scan": day_files_scan,
    "month_files_scan": month_files_scan,
    "extract_scan": extract_scan,
    "agent_list_scan": agent_list_scan,
    "export_accounts_for_all": export_accounts_for_all,
    "empty_slice": empty_slice,
    "backfill_tickets_raw": backfill_tickets_raw,
    "backfill_rows_by_month": backfill_rows_by_month,
    "backfill_odd_names": backfill_odd_names,
    "failed_backfill_keeps_raw": failed_backfill_keeps_raw,
    "failed_rebuild_keeps_facts": failed_rebuild_keeps_facts,
    "rebuild_fact_tickets": rebuild_fact_tickets,
    "published_features_daily": _published("features_daily"),
    "published_daily_ops_metrics": _published("daily_ops_metrics"),
    "published_backlog_daily": _published("backlog_daily"),
    "published_daily_agent_load": _published("daily_agent_load"),
    "published_ticket_sla_risk": published_ticket_sla_risk,
    "upkeep_fact_tickets": _table(_kept_up, "fact_tickets", "created_at"),
    "upkeep_features_daily": _table(_kept_up, "features_daily"),
    "upkeep_daily_ops_metrics": _table(_kept_up, "daily_ops_metrics"),
    "upkeep_backlog_daily": _table(_kept_up, "backlog_daily"),
    "upkeep_running_backlog": _table(_kept_up, "running_backlog"),
    "upkeep_daily_agent_load": _table(_kept_up, "daily_agent_load"),
    "upkeep_agent_load_null_safe": upkeep_agent_load_null_safe,
    "upkeep_ticket_sla_risk": _table(_kept_up, "ticket_sla_risk", "created_at_ts"),
    "ingestion_log": ingestion_log,
    "next_day": next_day,
    "next_day_past_end": next_day_past_end,
    "unrecorded_days": unrecorded_days,
    "date_exists": date_exists,
    "half_loaded_features_daily": _table(_half_loaded, "features_daily"),
    "published_after_each_day": published_after_each_day,
    "repaired_fact_tickets": _table(_repaired, "fact_tickets", "created_at"),
    "repaired_features_daily": _table(_repaired, "features_daily"),
    "repaired_daily_agent_load": _table(_repaired, "daily_agent_load"),
    "upkeep_daily_aggregates": _table(_kept_up, "daily_aggregates"),
    "upkeep_tickets_per_agent": _table(_kept_up, "tickets_per_agent"),
    "many_loads_features_daily": _table(_long_history, "features_daily"),
    "many_loads_fact_tickets": _table(_long_history, "fact_tickets", "created_at"),
    "compacted_fact_tickets": _table(_compacted, "fact_tickets", "created_at"),
    "compacted_daily_agent_load": _table(_compacted, "daily_agent_load"),
    "balanced_running_backlog": balanced_running_backlog,
    "mixed_headers_fact_tickets": _table(_mixed_headers, "fact_tickets", "created_at"),
    "mixed_headers_regions": mixed_headers_regions,
    "messy_fact_tickets": _table(_messy, "fact_tickets", "created_at"),
    "messy_quarantine": messy_quarantine,
    "late_facts_fact_tickets": _table(_late, "fact_tickets", "created_at"),
    "late_facts_features_daily": _table(_late, "features_daily"),
    "late_facts_backlog_daily": _table(_late, "backlog_daily"),
    "late_facts_running_backlog": _table(_late, "running_backlog"),
    "late_facts_daily_agent_load": _table(_late, "daily_agent_load"),
    "late_facts_ticket_sla_risk": _table(_late, "ticket_sla_risk", "created_at_ts"),
    "late_facts_replaced_versions": late_facts_replaced_versions,
    "stream_fact_tickets": _table(_streamed, "fact_tickets", "created_at"),
    "stream_features_daily": _table(_streamed, "features_daily"),
    "stream_daily_agent_load": _table(_streamed, "daily_agent_load"),
    "arrivals_fact_tickets": _table(_kept_up_by_arrival, "fact_tickets", "created_at"),
    "arrivals_features_daily": _table(_kept_up_by_arrival, "features_daily"),
    "arrivals_redelivered_facts": _table(_redelivered, "fact_tickets", "created_at"),
    "arrivals_daily_agent_load": _table(_kept_up_by_arrival, "daily_agent_load"),
    "arrivals_ingestion_state": _table(
        _kept_up_by_arrival, "ingestion_state", "ingestion_timestamp"
    ),
}


def with_job_conf(query: Callable) -> Callable:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(apply_job_conf(spark), sf_dir)

    return run
