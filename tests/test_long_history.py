"""Stores that have been kept up for years, and several writers and readers at once."""

import json
import os
from datetime import date, datetime, timedelta

import pytest
from helpers import HEADER, csv_line, in_order
from pyspark.sql import functions as F
from test_files_and_jobs import D1, D2, D3, contents, files, new_store, on, put, put_three_days, recorded  # noqa: F401

from ticketloom.plans import jobs
from ticketloom.plans.store import DAY_MARTS, TicketStore
from ticketloom.registry.queries import single_day_loads
from ticketloom.sources import day_files
from ticketloom.streaming.day_stream import DayStream

YEARS = 3000


def test_a_history_reads_its_source_once(spark, tmp_path):
    tickets = spark.range(200).selectExpr(
        "CAST(id AS STRING) AS ticket_id", "timestampadd(DAY, CAST(id % 9 AS INT), timestamp'2015-01-01 08:00:00') AS created_at",
        "if(id % 3 = 0, null, '1/5/15 8:00') AS resolved_at", "1.5D AS resolution_hours", "8D AS sla_hours", "false AS sla_breached",
        "'Low' AS priority", "'a' AS category", "'b' AS channel", "'c' AS customer_tier", "'d' AS status", "CAST(id % 7 AS STRING) AS agent_id",
    )
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    store = TicketStore(spark, str(tmp_path / "store"))
    single_day_loads(store, tickets.mapInArrow(counted, tickets.schema))
    assert read.value == 200
    assert [store.table(t).count() for t in ("tickets_raw", "fact_tickets", "ticket_sla_risk")] == [200] * 3
    features = store.table("features_daily").agg(F.sum("total_tickets"), F.count("*")).first()
    assert tuple(features) == (200, 9)


def test_three_thousand_daily_loads(spark, tmp_path):
    first = date(2015, 1, 1)
    tickets = spark.range(YEARS * 2).selectExpr(
        "CAST(id AS STRING) AS ticket_id", f"timestampadd(DAY, CAST(id % {YEARS} AS INT), timestamp'2015-01-01 08:00:00') AS created_at",
        "if(id % 3 = 0, null, '1/5/15 8:00') AS resolved_at", "1.5D AS resolution_hours", "8D AS sla_hours", "false AS sla_breached",
        "'Low' AS priority", "'a' AS category", "'b' AS channel", "'c' AS customer_tier", "'d' AS status", "CAST(id % 7 AS STRING) AS agent_id",
    )
    store = TicketStore(spark, str(tmp_path / "store"))
    single_day_loads(store, tickets)
    assert store.recorded().select("sums_load").distinct().count() == YEARS

    def depth(df):
        return len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())

    few = store.spark.createDataFrame(store.recorded().limit(2).collect(), store.recorded().schema)
    for name in ("features_daily", "fact_tickets", "daily_agent_load", "running_backlog"):
        assert depth(store.table(name)) == depth(store.table(name, few))
    features = store.table("features_daily")
    assert features.count() == YEARS and features.agg(F.sum("total_tickets")).first()[0] == 2 * YEARS
    assert store.table("fact_tickets").count() == 2 * YEARS
    days = [first, first + timedelta(days=YEARS - 1), first + timedelta(days=YEARS)]
    assert {r.created_date: r.there for r in jobs.date_exists(store, days).collect()} == dict(zip(days, [True, True, False]))
    assert jobs.next_day(store) == days[-1]
    # A day is loaded again, two months are compacted; everything else stays as it is.
    assert store.compact(date(2015, 2, 28)) == 59
    before = in_order(store.table("features_daily").collect())
    jobs.rebuild(store, publish_to=str(tmp_path / "out"))
    assert in_order(store.table("features_daily").collect()) == before
    assert in_order(store.published(str(tmp_path / "out"), "features_daily").collect()) == before


def load_all(store, files):  # noqa: F811
    for day in (D1, D2, D3):
        jobs.run_day(store, files, day)


def test_compaction_keeps_a_day_that_is_loaded_meanwhile(files, new_store, monkeypatch):  # noqa: F811
    put_three_days(files)
    store = new_store()
    load_all(store, files)
    write, late = TicketStore.write, []

    def write_and_be_overtaken(self, name, load, df):
        write(self, name, load, df)
        if name == "day_partials" and not late:
            late.append(1)
            put(files, D2, on(D2, ticket_id="again"))
            jobs.run_day(TicketStore(self.spark, self.root), files, D2)

    monkeypatch.setattr(TicketStore, "write", write_and_be_overtaken)
    assert store.compact(D3) == 2
    assert recorded(store) == [(D3, 1), (D2, 1), (D1, 2)]
    assert [r.ticket_id for r in store.table("fact_tickets").where("created_date = '2023-11-02'").collect()] == ["again"]
    one = store.recorded().where("simulation_date <> '2023-11-02'").select("raw_load", "fact_load", "sums_load").distinct().collect()
    assert len(one) == 1 and len(set(one[0])) == 1
    assert len(os.listdir(f"{store.path('fact_tickets')}/load={one[0].raw_load}/source_date=2023-11-01")) == 1
    monkeypatch.undo()
    assert store.compact(D3) == 3 and store.compact(D3) == 0
    fresh = new_store("fresh")
    load_all(fresh, files)
    assert contents(store) == contents(fresh)


def test_compaction_leaves_days_that_wait_for_a_rebuild(files, new_store):  # noqa: F811
    put_three_days(files)
    store = new_store()
    load_all(store, files)
    put(files, D2, on(D2, ticket_id="new"))
    jobs.backfill(store, files, 2023, 11, 11)
    assert store.compact(D3) == 0
    jobs.rebuild(store)
    assert recorded(store) == [(D3, 1), (D2, 1), (D1, 2)]


def test_the_later_commit_has_the_day_whatever_clocks_say(files, new_store, monkeypatch, caplog):  # noqa: F811
    put_three_days(files)
    store = new_store()
    load_all(store, files)
    other, clock = TicketStore(store.spark, store.root), __import__("time").time_ns
    monkeypatch.setattr("time.time_ns", lambda: clock() + 3600 * 10**9)  # this writer's clock is an hour ahead
    put(files, D1, on(D1, ticket_id="early"))
    jobs.run_day(other, files, D1)
    monkeypatch.undo()
    put(files, D1, on(D1, ticket_id="late"))
    derive = jobs.derive

    def derive_and_be_overtaken(store, load, raw):
        derive(store, load, raw)
        monkeypatch.undo()
        put(files, D1, on(D1, ticket_id="between"))
        jobs.run_day(other, files, D1)

    monkeypatch.setattr("ticketloom.plans.jobs.derive", derive_and_be_overtaken)
    result = jobs.load_days(store, files, [D1])
    assert result.overtaken == (D1,) and "2023-11-01" in caplog.text
    assert [r.ticket_id for r in store.table("fact_tickets").where("created_date = '2023-11-01'").collect()] == ["late"]


def test_an_entry_is_written_once(spark, tmp_path, new_store):  # noqa: F811
    log = new_store().log()
    one = json.dumps({"simulation_date": "2023-11-01", "raw_load": "x"})
    assert log.append([one], 0) == 1
    assert log.append([one], 0) is None
    assert log.append([one, one], 1) == 2
    assert [(str(r.simulation_date), r.seq) for r in log.records().orderBy("seq").collect()] == [("2023-11-01", n) for n in (1, 2, 2)]
    assert [name for name in os.listdir(log.path) if name.startswith(("_", "._"))] == []


def test_a_rebuild_keeps_a_day_that_is_loaded_meanwhile(files, new_store, monkeypatch):  # noqa: F811
    put_three_days(files)
    store = new_store()
    load_all(store, files)
    derive = jobs.derive

    def derive_and_be_overtaken(store, load, raw):
        derive(store, load, raw)
        monkeypatch.undo()
        put(files, D3, on(D3, ticket_id="new"), on(D3, ticket_id="newer"))
        jobs.run_day(TicketStore(store.spark, store.root), files, D3)

    monkeypatch.setattr("ticketloom.plans.jobs.derive", derive_and_be_overtaken)
    jobs.rebuild(store)
    assert recorded(store) == [(D3, 2), (D2, 2), (D1, 2)]


def test_frames_outlive_a_checkpoint(files, new_store, monkeypatch):  # noqa: F811
    monkeypatch.setattr("ticketloom.plans.numbered_log.ENTRIES_PER_CHECKPOINT", 2)
    put_three_days(files)
    store = new_store()
    jobs.run_day(store, files, D1)
    frames = store.log().records(), store.loaded_files(), jobs.ingestion_log(store)
    for day in (D2, D3, D1, D2):
        jobs.run_day(store, files, day)
    assert [frame.count() for frame in frames] == [1, 1, 1]
    before = contents(store)
    store.vacuum(older_than_hours=0)
    assert contents(store) == before
    left = os.listdir(store.path("ingestion_state"))
    assert len([name for name in left if name.startswith("entry-")]) <= 1 and recorded(store) == [(D3, 1), (D2, 2), (D1, 2)]


@pytest.mark.parametrize("broken", ["features_daily", "daily_agent_load", "entry"])
def test_a_broken_publication_changes_no_copy(files, new_store, monkeypatch, broken):  # noqa: F811
    put_three_days(files)
    store = new_store()
    load_all(store, files)
    out = f"{store.root}/published"
    store.publish(out)
    copies = lambda: {name: in_order(store.published(out, name).collect()) for name in DAY_MARTS}
    before = copies()
    put(files, D2, on(D2, ticket_id="other"), on(D2, ticket_id="more", agent_id="a9"))
    jobs.run_day(store, files, D2)
    reader = store.published(out, "features_daily")
    copy = TicketStore._copy

    def fail(self, out, version, name, *rest):
        if name == broken:
            raise OSError("disk")
        copy(self, out, version, name, *rest)

    if broken == "entry":
        monkeypatch.setattr("ticketloom.sources.folders.put_once", lambda *_: (_ for _ in ()).throw(OSError("disk")))
    else:
        monkeypatch.setattr(TicketStore, "_copy", fail)
    with pytest.raises(OSError, match="disk"):
        store.publish(out)
    monkeypatch.undo()
    assert copies() == before
    jobs.publish_days(store, out, [D2])
    assert copies() == {name: contents(store, [name])[name] for name in DAY_MARTS}
    assert in_order(reader.collect()) == before["features_daily"]  # a frame of the old publication still reads


# -- cells and records ----------------------------------------------------------------


def test_awkward_cells_survive_a_round_trip(spark, tmp_path):
    texts = ["a\nb", "a\r\nb", "\n", ' "q" ', 'x,"y",\n"z"', "é ", "'", '"', '""', "a\\", '\\"', " ", "#c"]
    rows = [(f"t{i}", "2023-11-01 08:00:00", None, "1.5", "8.0", "true", text, text, "c", "d", "e", text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in HEADER))
    out = day_files.export_days(df, str(tmp_path / "out"))
    back = day_files.read_extract(spark, f"{out.files.base}/*", typed=False).select(*HEADER)
    assert in_order(back.collect()) == in_order(rows)
    typed = day_files.read_days(spark, out.files, [D1])
    assert sorted((r.ticket_id, r.priority, r.category, r.agent_id) for r in typed.collect()) == sorted((r[0], r[6], r[7], r[11]) for r in rows)
    assert not [r for r in typed.collect() if r._malformed is not None]


def test_malformed_records_are_kept_aside(spark, files, new_store):  # noqa: F811
    put_three_days(files)
    good = csv_line(on(D1, ticket_id="g"))
    path = f"{files.base}/2023/11/2023-11-01.csv"
    short, long, unclosed = "s,2023-11-01", good + ",more", good.replace("Billing", '"Billing').replace("g,", "u,", 1)
    with open(path, "a") as file:
        file.write("\n".join([short, long, good, unclosed, good]) + "\n")
    store = new_store()
    result = jobs.load_days(store, files, [D1, D2])
    assert (result.rows, result.malformed) == (3 + 2, 3)
    kept = store.table("tickets_quarantine").collect()
    assert sorted(r.record for r in kept) == sorted([short, long, f"{unclosed}\n{good}\n"]) or sorted(r.record for r in kept) == sorted(
        [short, long, f"{unclosed}\n{good}"]
    )
    assert {r.source_date for r in kept} == {D1} and kept[0]._source_file.endswith("2023-11-01.csv")
    assert store.table("tickets_raw").count() == store.table("fact_tickets").count() == 5
    assert store.rows("tickets_raw").count() == 8
    assert recorded(store) == [(D2, 2), (D1, 3)]
    bulk = new_store("bulk")
    assert jobs.backfill(bulk, files, 2023, 11, 11).malformed == 3
    jobs.rebuild(bulk)
    assert in_order(bulk.table("fact_tickets").collect())[:3] and bulk.table("tickets_quarantine").count() == 3
    assert store.compact(D3) == 2 - 2 and bulk.compact(D3) == 3
    assert bulk.table("tickets_quarantine").count() == 3


def test_an_extract_refuses_malformed_records(spark, tmp_path):
    good = csv_line(on(D1, ticket_id="g"))
    for name, line in {"short": "s,2023-11-01", "break": good.replace("Billing", '"Bil\nling"')}.items():
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join([",".join(HEADER), good, line, good]) + "\n")
        if name == "break":
            assert day_files.read_extract(spark, str(path)).count() == 3
        for splits in (True,) if name == "break" else (True, False):
            with pytest.raises(Exception, match="(?i)malformed"):
                day_files.read_extract(spark, str(path), splits=splits).collect()


def test_a_stray_file_matters_to_no_named_day(spark, files):  # noqa: F811
    put_three_days(files)
    with open(f"{files.base}/2023/11/notes.csv", "w") as file:
        file.write("x\n")
    assert day_files.read_days(spark, files, [D1]).count() == 2
    assert day_files.read_days(spark, files, [D1, D2]).count() == 4
    with pytest.raises(ValueError, match="notes.csv"):
        day_files.read_month(spark, files, 2023, 11)


# -- stream ---------------------------------------------------------------------------


def test_a_stream_takes_every_file_once(spark, files, new_store, tmp_path):  # noqa: F811
    stream = DayStream(spark, str(tmp_path / "stream"))
    assert stream.advance(files) == {}
    put_three_days(files)
    os.rename(f"{files.base}/2023/11/{D3}.csv", str(tmp_path / "later.csv"))
    with open(f"{files.base}/2023/11/{D2}.csv", "a") as file:
        file.write("cut off\n")
    assert stream.advance(files, files_per_batch=1) == {"facts": 5, "ticket_days": 5, "quarantine": 5}
    assert sum(stream.advance(files).values()) == 0
    os.rename(str(tmp_path / "later.csv"), f"{files.base}/2023/11/{D3}.csv")
    again = DayStream(spark, stream.root)  # a restart goes on from the checkpoint
    assert again.advance(files)["facts"] == 1
    store = new_store()
    load_all(store, files)
    for name in ("fact_tickets", "features_daily", "backlog_daily", "running_backlog", "daily_agent_load"):
        assert in_order(again.table(name).collect()) == contents(store, [name])[name]
    assert [r.record for r in again.table("quarantine").collect()] == ["cut off"]
    with pytest.raises(FileNotFoundError):
        DayStream(spark, str(tmp_path / "none")).table("features_daily")
