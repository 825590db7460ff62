import glob
import gzip
import os
from datetime import date, datetime, timedelta

import pytest
from helpers import HEADER, TICKET_DDL, csv_line, in_order, random_tickets, rows_of, ticket, write_day
from pyspark.sql import functions as F

from ticketloom.__main__ import parser
from ticketloom.__main__ import run as run_command
from ticketloom.operators.agent_load import daily_agent_load
from ticketloom.plans import jobs
from ticketloom.plans.store import TicketStore
from ticketloom.session import apply_job_conf
from ticketloom.sources import day_files
from ticketloom.streaming.arrivals import load_arrivals

D1, D2, D3, D4 = (date(2023, 11, d) for d in (1, 2, 3, 4))
TABLES = (
    "tickets_raw", "fact_tickets", "features_daily", "daily_ops_metrics", "backlog_daily",
    "daily_agent_load", "ticket_sla_risk", "running_backlog",
)


@pytest.fixture
def files(tmp_path):
    return day_files.DayFiles(str(tmp_path / "raw"))


@pytest.fixture
def new_store(spark, tmp_path):
    return lambda name="store": TicketStore(spark, str(tmp_path / name))


def put(files, day, *tickets):
    write_day(files.base, day, [csv_line(t) for t in tickets])


def on(day, hour=9, **cells):
    return ticket(created_at=datetime(day.year, day.month, day.day, hour), **cells)


def put_three_days(files):
    put(files, D1, on(D1, ticket_id="a", resolved_at="11/4/23 9:00", resolution_hours=72.0),
        on(D1, ticket_id="b", agent_id=None))
    put(files, D2, on(D2, ticket_id="c", resolved_at="11/2/23 12:00", resolution_hours=3.1),
        on(D2, ticket_id="d", resolved_at="11/4/23 12:00", resolution_hours=50.2, agent_id="a1"))
    put(files, D3, on(D3, ticket_id="e", sla_breached=True))


def contents(store, tables=TABLES):
    """Everything a user can see, without what differs between runs."""
    now = store.snapshot()
    return {
        t: in_order(store.table(t, now).drop("_ingestion_ts", "_source_file", "_unread").collect())
        for t in tables
    }


def recorded(store):
    return [(r.simulation_date, r.rows_ingested) for r in jobs.ingestion_log(store).collect()]


# -- reading -------------------------------------------------------------------


def test_cells_are_cast_by_name(spark, files):
    write_day(
        files.base,
        D1,
        [
            "High,note,x1,2023-11-01,  ,5.5,24,0,Billing,Email,Gold,Open,7",
            "Low,,x2,2023-11-01 10:00:00.123456,,oops,24,True,Billing,Email,Gold,Open,",
            'Low,"say ""hi"", ok",x3,not a time,,1,24,,Billing,Email,Gold,Open,8',
        ],
        "priority,remark,ticket_id,created_at,resolved_at,resolution_hours,sla_hours,"
        "sla_breached,category,channel,customer_tier,status,agent_id",
    )
    rows = {r.ticket_id: r for r in day_files.read_days(spark, files, [D1]).collect()}
    first, second, third = rows["x1"], rows["x2"], rows["x3"]
    assert first.created_at == datetime(2023, 11, 1) and first.resolved_at == "  "
    assert first.sla_breached is False and first.agent_id == "7" and first.priority == "High"
    assert second.created_at == datetime(2023, 11, 1, 10, 0, 0, 123456)
    assert second.resolution_hours is None and second.sla_breached is True
    assert second.resolved_at is None and second.agent_id is None
    assert third.created_at is None and third.remark == 'say "hi", ok'
    assert first._unread is None and second._unread == {"resolution_hours": "oops"}
    assert third._unread == {"created_at": "not a time"}
    assert {r.source_date for r in rows.values()} == {D1}
    assert first._source_file.endswith("/2023/11/2023-11-01.csv")


def test_missing_contract_column_is_named(spark, files):
    write_day(files.base, D1, ["x"], "ticket_id")
    with pytest.raises(ValueError, match="agent_id"):
        day_files.read_days(spark, files, [D1])


def test_files_with_other_column_orders_are_read_by_name(spark, files):
    put(files, D1, on(D1, ticket_id="a", priority="High"))
    order = ["priority", *[c for c in HEADER if c != "priority"]]
    write_day(files.base, D2, ["x," + ",".join(["y"] * 11)], ",".join(order))
    # A header cell with a line break, columns beyond the contract, and cells too few.
    write_day(files.base, D3, ["z," + ",".join(["w"] * 12), "cut off"], '"re\n""gion""",' + ",".join(HEADER[::-1]))
    rows = day_files.read_month(spark, files, 2023, 11).collect()
    assert sorted((r.source_date, r.ticket_id, r.priority) for r in rows if r._malformed is None) == [
        (D1, "a", "High"), (D2, "y", "x"), (D3, "w", "w"),
    ]
    assert [(r.source_date, r._malformed) for r in rows if r._malformed is not None] == [(D3, "cut off")]
    assert {r.source_date: r['re\n"gion"'] for r in rows if r._malformed is None} == {D1: None, D2: None, D3: "z"}


def test_files_are_grouped_by_header(spark, files, tmp_path):
    for day, header in ((D1, "b,a"), (D2, "a,b"), (D3, "a,b")):
        write_day(files.base, day, ["1,2"], header)
    write_day(files.base, D4, ["1,2"], "a," + "b" * 10000 + "\r")
    month = f"{files.base}/2023/11"
    with gzip.open(f"{month}/2023-11-05.csv.gz", "wt") as file:
        file.write("\n\na,b\n1,2\n")
    open(f"{month}/2023-11-06.csv", "w").close()
    open(f"{month}/2023-11-07.csv", "w").write("a,b")
    found = [day_files.Delivery(f"{month}/{name}", 0, os.path.getsize(f"{month}/{name}"), D1) for name in sorted(os.listdir(month)) if name[0] != "."]
    groups = day_files.by_header(spark, found)
    assert sorted(sorted(f.path[-6:].split(".")[0][-1] for f in g) for g in groups[1:]) == [["1"], ["4"]]
    assert len(groups[0]) == 5  # the second, third and zipped one, the one of a header alone and the empty one
    assert day_files.by_header(spark, []) == [[]]


def test_missing_days(spark, files):
    put(files, D2, on(D2))
    with pytest.raises(FileNotFoundError, match="2023-11-01, 2023-11-03"):
        day_files.read_days(spark, files, [D1, D2, D3])
    with pytest.raises(FileNotFoundError):
        day_files.read_days(spark, files, [D1])
    assert day_files.read_days(spark, files, [D1, D2, D3], skip_missing=True).count() == 1
    assert day_files.read_days(spark, files, [D1, D3], skip_missing=True) is None


def test_a_file_not_named_after_a_day_is_refused(spark, files):
    put(files, D1, on(D1))
    for name in ("late.csv", "2023-10-01.csv"):
        write_day(files.base, D1, ["x"], "ticket_id")
        odd = f"{files.base}/2023/11/{name}"
        with open(odd, "w") as file:
            file.write("ticket_id\nx\n")
        with pytest.raises(ValueError, match=name):
            day_files.read_month(spark, files, 2023, 11)
        os.rename(odd, f"{files.base}/{name}")


def test_export_and_read_back(spark, tmp_path):
    tickets = random_tickets(7, 200)
    df = spark.createDataFrame(rows_of(tickets), TICKET_DDL)
    out = day_files.export_days(df, str(tmp_path / "out"), 2023, 11)
    exported = out.files
    back = day_files.read_all_days(spark, exported).drop("_source_file", "source_date", "_unread", "_malformed")
    expected = [t for t in rows_of(tickets) if t[1] is not None]
    assert in_order(back.collect()) == in_order(expected)
    assert (out.exported, out.out_of_range, out.unreadable) == (len(expected), 0, 200 - len(expected))
    named = [f for f in glob.glob(f"{exported.base}/*/*.csv") if "unreadable" not in f]
    assert len(named) == len({t[1].date() for t in expected})
    day_files.export_days(df.limit(0), exported.base, 2023, 12)
    day_files.export_days(df, exported.base, 2023, 11)
    assert day_files.read_all_days(spark, exported).count() == len(expected)


def test_export_keeps_every_row_and_cell(spark, tmp_path):
    rows = [csv_line(on(D1, ticket_id="a")), csv_line(on(date(2022, 5, 1), ticket_id="b"))]
    rows += ["c,soon,,7 h,24,,Low,Billing,Email,Gold,Open,a1", "d,2023-11-02T08:00:00,,7 h,24,,Low,Billing,Email,Gold,Open,a1"]
    extract = tmp_path / "extract.csv"
    extract.write_text("\n".join([",".join(HEADER), *rows]) + "\n")
    out = day_files.export_days(day_files.read_extract(spark, str(extract), typed=False), str(tmp_path / "out"), 2023)
    assert (out.exported, out.out_of_range, out.unreadable) == (2, 1, 1)
    kept = day_files.read_extract(spark, f"{out.files.base}/*", typed=False).collect()
    assert sorted((r.ticket_id, r.created_at, r.resolution_hours) for r in kept) == [
        ("a", "2023-11-01 09:00:00", None), ("c", "soon", "7 h"), ("d", "2023-11-02T08:00:00", "7 h"),
    ]
    every = day_files.export_days(day_files.read_extract(spark, str(extract), typed=False), str(tmp_path / "all"))
    assert (every.exported, every.out_of_range, every.unreadable) == (3, 0, 1)


def test_files_of_a_large_day_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(day_files, "ROWS_A_FILE", 100, raising=False)
    rows = [on(D1 if i % 10 else D2, ticket_id=str(i)) for i in range(950)]
    df = spark.createDataFrame(rows_of(rows), TICKET_DDL)
    exported = day_files.export_days(df, str(tmp_path / "out")).files
    read = day_files.read_days(spark, exported, [D1, D2])
    assert max(r[1] for r in read.groupBy("_source_file").count().collect()) == 100
    assert {r.source_date: r["count"] for r in read.groupBy("source_date").count().collect()} == {D1: 855, D2: 95}
    assert read.select("ticket_id").distinct().count() == 950


def test_large_files_are_not_read_by_one_task(spark, tmp_path):
    apply_job_conf(spark)
    numbers = spark.range(400_000, numPartitions=4).withColumn("text", F.sha2(F.col("id").cast("string"), 256))
    numbers.write.parquet(str(tmp_path / "table"))
    numbers.limit(60).repartition(60).write.mode("append").parquet(str(tmp_path / "table"))
    tasks = spark.read.parquet(str(tmp_path / "table")).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 400_060 and max(r["count"] for r in tasks) <= 200_000


def test_large_day_is_exported_as_several_files(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    try:
        rows = [on(D1 if i % 3 else D2, ticket_id=str(i * 7919)) for i in range(9000)]
        df = spark.createDataFrame(rows_of(rows), TICKET_DDL).repartition(8)
        exported = day_files.export_days(df, str(tmp_path / "out"), 2023, 11).files
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(glob.glob(f"{exported.base}/created_date=2023-11-01/*.csv")) > 1
    assert day_files.read_all_days(spark, exported).select("ticket_id").distinct().count() == 9000


# -- jobs ----------------------------------------------------------------------


def test_daily_runs_batches_and_rebuild_agree(spark, files, new_store):
    put_three_days(files)
    by_day = new_store("by_day")
    results = [jobs.run_day(by_day, files, start=D1, end=D3) for _ in range(4)]
    assert [(r.day, r.status, r.rows) for r in results] == [
        (D1, "loaded", 2), (D2, "loaded", 2), (D3, "loaded", 1), (D4, "past_end", 0),
    ]
    assert recorded(by_day) == [(D3, 1), (D2, 2), (D1, 2)]

    in_batches = new_store("in_batches")
    assert jobs.catch_up(in_batches, files, D1, D3, days_per_load=2) == [D1, D2, D3]
    assert recorded(in_batches) == recorded(by_day)

    bulk = new_store("bulk")
    result = jobs.backfill(bulk, files, 2023, 11, 11)
    assert (result.rows, result.failed_months) == (5, {})
    published = jobs.rebuild(bulk, publish_to=f"{bulk.root}/published")

    assert contents(by_day) == contents(in_batches) == contents(bulk)
    for name in published:
        copy = bulk.published(f"{bulk.root}/published", name)
        assert in_order(copy.collect()) == contents(bulk, [name])[name]

    load = {(r.ops_date, r.agent_id): r for r in by_day.table("daily_agent_load").collect()}
    late = load[(D4, "a1")]
    assert (late.tickets_assigned, late.tickets_resolved) == (0, 2)
    assert late.avg_resolution_hours == 61.1


def test_random_days_agree_with_bulk(spark, files, new_store):
    """With rows whose own time is unreadable or lies on another day than the file."""
    days = [D1 + timedelta(days=i) for i in range(6)]
    for i, day in enumerate(days):
        put(files, day, *random_tickets(20 + i, 60))
    bulk, daily = new_store("bulk"), new_store("daily")
    jobs.backfill(bulk, files, 2023, 11, 11)
    jobs.rebuild(bulk)
    jobs.catch_up(daily, files, days[3], days[-1])
    jobs.run_day(daily, files, days[4], end=days[-1])
    jobs.catch_up(daily, files, days[0], days[-1], days_per_load=2)
    assert contents(daily) == contents(bulk)
    partials = daily_agent_load(daily.rows("agent_partials"), null_safe=True)
    whole = daily_agent_load(bulk.rows("agent_partials"), null_safe=True)
    assert in_order(partials.collect()) == in_order(whole.collect())


def test_named_day_is_replaced(files, new_store):
    put_three_days(files)
    store, fresh = new_store(), new_store("fresh")
    jobs.catch_up(store, files, D1, D3)
    put(files, D2, on(D2, ticket_id="z"))
    assert jobs.run_day(store, files, D2).rows == 1
    jobs.catch_up(fresh, files, D1, D3)
    assert contents(store) == contents(fresh)
    assert recorded(store) == [(D3, 1), (D2, 1), (D1, 2)]
    # A delivery without rows empties the day.
    put(files, D2)
    jobs.load_days(store, files, [D1, D2])
    assert recorded(store) == [(D3, 1), (D2, 0), (D1, 2)]
    assert store.table("fact_tickets").count() == 3


def test_reset_then_run_again(files, new_store):
    put_three_days(files)
    store = new_store()
    jobs.catch_up(store, files, D1, D3)
    before = contents(store)
    jobs.reset_day(store, D2)
    there = jobs.date_exists(store, [D1, D2, D3]).orderBy("created_date").collect()
    assert [r.there for r in there] == [True, False, True]
    assert [day for day, _ in recorded(store)] == [D3, D1]
    assert D2 not in [r.ops_date for r in store.table("features_daily").collect()]
    assert jobs.catch_up(store, files, D1, D3) == [D2]
    assert contents(store) == before


@pytest.mark.parametrize("broken_step", ["derive", "_records"])
def test_broken_load_changes_nothing_and_is_repeated(files, new_store, monkeypatch, broken_step):
    put_three_days(files)
    store, whole = new_store(), new_store("whole")
    jobs.run_day(store, files, start=D1)
    before = contents(store)
    put(files, D1, on(D1, ticket_id="z"))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, broken_step, fail)
        for day in (None, D1):
            with pytest.raises(RuntimeError):
                jobs.run_day(store, files, day, start=D1)
    assert contents(store) == before and recorded(store) == [(D1, 2)]
    assert jobs.run_day(store, files, D1).rows == 1
    assert jobs.catch_up(store, files, D1, D3) == [D2, D3]
    jobs.catch_up(whole, files, D1, D3)
    assert contents(store) == contents(whole)


def test_backfill_keeps_days_without_a_file(files, new_store):
    put_three_days(files)
    store = new_store()
    jobs.catch_up(store, files, D1, D3)
    before = contents(store)
    os.rename(f"{files.base}/2023/11/2023-11-02.csv", f"{files.base}/2023-11-02.gone")
    assert jobs.backfill(store, files, 2023, 11, 11).rows == 3
    assert contents(store) == before
    jobs.rebuild(store)
    assert contents(store) == before and recorded(store) == [(D3, 1), (D2, 2), (D1, 2)]


def test_failed_month_keeps_what_was_landed(files, new_store):
    put_three_days(files)
    store = new_store()
    jobs.backfill(store, files, 2023, 11, 11)
    jobs.rebuild(store)
    before = contents(store)
    order = [c for c in HEADER if c != "priority"]
    write_day(files.base, D2, [",".join(["x"] * 11)], ",".join(order))
    assert list(jobs.backfill(store, files, 2023, 11, 11).failed_months) == ["2023-11"]
    jobs.rebuild(store)
    assert contents(store) == before


def test_failed_rebuild_keeps_every_table(files, new_store):
    put_three_days(files)
    store = new_store()
    jobs.backfill(store, files, 2023, 11, 11)
    jobs.rebuild(store)
    before = contents(store, TABLES[1:])
    (place,) = glob.glob(f"{store.path('tickets_raw')}/load=*/source_date=2023-11-02/*")
    with open(f"{place}/part-damaged.parquet", "w") as file:
        file.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        jobs.rebuild(store)
    assert contents(store, TABLES[1:]) == before and recorded(store) == [(D3, 1), (D2, 2), (D1, 2)]
    assert jobs.next_day(store) == D4


def test_backfilled_days_are_seen_when_they_are_complete(files, new_store):
    put_three_days(files)
    store = new_store()
    jobs.backfill(store, files, 2023, 11, 11)
    assert store.table("tickets_raw").count() == 0 and recorded(store) == []
    assert store.rows("tickets_raw", store.landed()).count() == 5
    jobs.rebuild(store)
    assert store.table("tickets_raw").count() == 5
    assert jobs.catch_up(store, files, D1, D3) == []


def test_unread_cells_are_counted(files, new_store):
    write_day(files.base, D1, ["t1,soon,,7 h,24,maybe,Low,Billing,Email,Gold,Open,a1", csv_line(on(D1))])
    store = new_store()
    counts = {"created_at": 1, "resolution_hours": 1, "sla_breached": 1}
    assert jobs.run_day(store, files, D1).unread == counts
    assert jobs.backfill(new_store("bulk"), files, 2023, 11, 11).unread == counts
    kept = store.table("tickets_raw").where("_unread is not null").first()._unread
    assert kept == {"created_at": "soon", "resolution_hours": "7 h", "sla_breached": "maybe"}


def test_old_loads_are_removed_and_days_compacted(files, new_store):
    put_three_days(files)
    store = new_store()
    for day in (D1, D2, D3, D2):
        jobs.run_day(store, files, day)
    before = contents(store)
    assert store.compact(D2) == 2
    assert contents(store) == before
    assert store.vacuum() == []
    removed = store.vacuum(older_than_hours=0)
    assert len(removed) == 5 + 2 * 5  # D2's first load; two loads in five tables, now compacted
    assert contents(store) == before and recorded(store) == [(D3, 1), (D2, 2), (D1, 2)]


def test_long_logs_are_shortened(files, new_store, monkeypatch):
    monkeypatch.setattr("ticketloom.plans.numbered_log.ENTRIES_PER_CHECKPOINT", 2)
    put_three_days(files)
    store = new_store()
    for day in (D1, D2, D3):
        jobs.run_day(store, files, day)
    jobs.reset_day(store, D1)
    jobs.backfill(store, files, 2023, 11, 11)
    assert len(glob.glob(f"{store.path('ingestion_state')}/*.parquet")) <= 3
    assert [day for day, _ in recorded(store)] == [D3, D2]
    jobs.rebuild(store)
    assert [day for day, _ in recorded(store)] == [D3, D2, D1]


def test_published_copies_follow_the_loads(files, new_store):
    put_three_days(files)
    put(files, date(2023, 12, 5), on(date(2023, 12, 5), resolved_at="1/2/24 9:00", resolution_hours=3.0))
    store, days = new_store(), [D1, D2, D3, date(2023, 12, 5)]
    out = f"{store.root}/published"
    for day in days:
        jobs.run_day(store, files, day)
        jobs.publish_days(store, out, [day])
    put(files, days[-1], on(days[-1]))  # nothing of January is left
    before = jobs.touched_days(store, days[-1:])
    jobs.run_day(store, files, days[-1])
    jobs.publish_days(store, out, days[-1:], before)
    for name in ("features_daily", "backlog_daily", "daily_agent_load"):
        assert in_order(store.published(out, name).collect()) == contents(store, [name])[name]
    months = lambda: set(store._newest_publication(store._publications(out))[1]["daily_agent_load"])
    assert months() == {"ops_month=2023-11-01", "ops_month=2023-12-01"}
    assert store.vacuum_published(out) == []
    assert store.vacuum_published(out, older_than_hours=0)
    for name in ("features_daily", "daily_agent_load"):
        assert in_order(store.published(out, name).collect()) == contents(store, [name])[name]
    assert len(os.listdir(f"{out}/daily_agent_load")) == 2


def test_gaps(files, new_store):
    put(files, D1, on(D1))
    put(files, D3, on(D3))
    store = new_store()
    jobs.run_day(store, files, start=D1)
    with pytest.raises(FileNotFoundError):
        jobs.run_day(store, files, start=D1)
    assert jobs.next_day(store) == D2
    assert jobs.run_day(store, files, start=D1, skip_missing=True).rows == 0
    assert jobs.run_day(store, files, start=D1).rows == 1
    assert recorded(store) == [(D3, 1), (D2, 0), (D1, 1)]
    assert jobs.unrecorded_days(store, D1, D4).first().simulation_date == D4


def test_the_first_day_must_be_named_and_none_is_the_last(files, new_store):
    store = new_store()
    for job in (jobs.run_day, jobs.catch_up):
        with pytest.raises(ValueError, match="first"):
            job(store, files)
    late = date(2031, 1, 1)
    put(files, late, on(late))
    assert jobs.run_day(store, files, start=late, end=D1).status == "past_end"
    assert jobs.run_day(store, files, start=late).rows == 1
    after = date(2031, 1, 9)
    put(files, after, on(after))
    assert jobs.catch_up(store, files) == [after]


def test_only_a_missing_table_counts_as_empty(new_store, tmp_path):
    store = new_store()
    folder = tmp_path / "store" / "ingestion_state"
    folder.mkdir(parents=True)
    (folder / "entry-00000000000000000001.json").write_text("not json")
    with pytest.raises(Exception, match="(?i)malformed"):
        jobs.next_day(store)


def test_backfill_reports_failed_months(files, new_store):
    put(files, D1, on(D1), on(D1))
    put(files, date(2023, 12, 1), on(date(2023, 12, 1)))
    write_day(files.base, date(2023, 12, 2), ["x"], "ticket_id")
    store = new_store()
    result = jobs.backfill(store, files, 2023, 10, 12)
    assert result.rows_by_month == {"2023-11": 2}
    assert sorted(result.failed_months) == ["2023-10", "2023-12"]
    assert list(jobs.backfill(store, files, 2023).rows_by_month) == ["2023-11"]
    landed = lambda: store.rows("tickets_raw", store.landed()).count()
    put(files, D1)
    assert jobs.backfill(store, files, 2023, 11, 11).rows_by_month == {"2023-11": 0}
    assert landed() == 0
    put(files, D2, on(D2), on(D2))
    assert jobs.backfill(store, files, 2023, 11, 11).rows == 2
    assert landed() == 2


def test_columns_beyond_the_contract_are_landed(spark, files, new_store):
    write_day(files.base, D1, [csv_line(on(D1)) + ",hello"], ",".join([*HEADER, "remark"]))
    put(files, D2, on(D2))
    store = new_store()
    jobs.catch_up(store, files, D1, D1)
    jobs.catch_up(store, files, D2, D2)
    raw = store.table("tickets_raw")
    assert raw.columns == [*HEADER, "remark", "_unread", "_ingestion_ts", "_source_file"]
    assert [r.remark for r in raw.orderBy("created_at").collect()] == ["hello", None]


def test_tables_by_name_in_sql(spark, files, new_store):
    put_three_days(files)
    store = new_store()
    jobs.catch_up(store, files, D1, D3)
    store.register_views()
    row = spark.sql(
        "SELECT sum(total_tickets) AS n, (SELECT count(*) FROM fact_tickets) AS m FROM features_daily"
    ).first()
    assert (row.n, row.m) == (5, 5)


def test_each_delivery_is_loaded_once(files, new_store):
    put(files, D3, on(D3, ticket_id="e", sla_breached=True))
    store, whole = new_store(), new_store("whole")
    assert load_arrivals(store, files) == [D3]
    put(files, D1, on(D1))
    put(files, D2, on(D2))
    assert load_arrivals(store, files, days_per_load=1) == [D1, D2]
    assert load_arrivals(store, files) == []
    # Corrected under the old path, once longer and once with the same length.
    put(files, D2, on(D2, ticket_id="x"), on(D2, ticket_id="y"))
    assert load_arrivals(store, files) == [D2]
    path = f"{files.base}/2023/11/2023-11-01.csv"
    with open(path) as file:
        text = file.read()
    with open(path, "w") as file:
        file.write(text.replace("t1,", "q1,"))
    os.utime(path, (0, 0))
    assert load_arrivals(store, files) == [D1]
    jobs.catch_up(whole, files, D1, D3)
    assert contents(store) == contents(whole)
    assert [r.ticket_id for r in store.table("fact_tickets").where("created_date = date'2023-11-01'").collect()] == ["q1"]


def test_backfilled_files_are_no_new_arrivals(files, new_store):
    put_three_days(files)
    store = new_store()
    jobs.backfill(store, files, 2023, 11, 11)
    jobs.rebuild(store)
    assert load_arrivals(store, files) == []


def test_command_line(spark, files, new_store, tmp_path, capsys):
    put_three_days(files)
    store = new_store()

    def run(*words):
        return run_command(spark, parser().parse_args(words))

    there = ["--files", files.base, "--store", store.root]
    copies = str(tmp_path / "copies")
    assert run("daily", *there, "--start", "2023-11-01").rows == 2
    assert run("daily", *there, "--date", "2023-11-03", "--publish", copies).day == D3
    assert store.published(copies, "features_daily").count() == 2  # the whole month
    assert run("catch-up", *there, "--end", "2023-11-04", "--skip-missing") == [D2, D4]
    run("log", "--store", store.root)
    assert capsys.readouterr().out.split()[:1] == ["2023-11-04"]
    assert run("compact", "--store", store.root, "--until", "2023-11-04") == 4
    assert run("vacuum", "--store", store.root) == []
    run("reset", "--store", store.root, "--date", "2023-11-01")
    assert run("backfill", *there, "--year", "2023", "--start-month", "11", "--end-month", "11").rows == 5
    run("rebuild", "--store", store.root, "--publish", str(tmp_path / "out"))
    assert store.published(str(tmp_path / "out"), "features_daily").count() == 3
    assert run("arrivals", *there) == []
    extract = f"{files.base}/2023/11/2023-11-01.csv"
    split = run("export", "--extract", extract, "--to", str(tmp_path / "days"), "--year", "2023")
    assert (split.exported, split.out_of_range, split.unreadable) == (2, 0, 0)
    assert day_files.read_all_days(spark, split.files).count() == 2


def test_agents_file(spark, tmp_path):
    (tmp_path / "agents.csv").write_text("agent_id,name\n007,Ada\n")
    assert day_files.read_agents(spark, str(tmp_path / "agents.csv")).first() == ("007", "Ada")


def test_a_reload_takes_as_many_jobs_for_many_days_as_for_one(spark, files, new_store):
    put_three_days(files)
    store = new_store()
    counts = []
    for days in ([D1], [D1, D2, D3], [D1, D2, D3]):
        group = f"reload-{len(counts)}"
        spark.sparkContext.setJobGroup(group, group)
        jobs.load_days(store, files, days)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setJobGroup("", "")
    assert max(counts) <= min(counts) + 1 and max(counts) <= 14
