from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from playlens import schemas
from playlens.operators import maintenance, medallion, merge, repair
from playlens.plans import sessions
from playlens.sources import files, landing, tables
from playlens.streaming import flows, session_state

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def contents(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def land(spark, path, *reports):
    tables.write_partitioned(fx.bronze(spark, *reports), path, ["eventDate"], mode="append")


@pytest.fixture()
def landing_path(spark, tmp_path):
    path = str(tmp_path / "landing")
    land(spark, path, fx.report(day=D1, levels=("360p", "720p")), fx.report(client="b", count=-1, day=D2))
    return path


def test_streams_equal_batch_and_restart_adds_nothing(spark, landing_path, tmp_path):
    silver, quarantine = str(tmp_path / "silver"), str(tmp_path / "quarantine")

    def run():
        bronze = landing.stream_reports(spark, landing_path)
        flows.finish(flows.silver_flow(bronze, silver, str(tmp_path / "c1")))
        flows.finish(flows.quarantine_flow(bronze, quarantine, str(tmp_path / "c2")))

    run()
    batch = landing.read_reports(spark, landing_path)
    assert contents(spark.read.parquet(silver).drop("ingest_batch")) == contents(medallion.silver_enriched(batch))
    assert spark.read.parquet(quarantine).count() == 1
    run()
    assert spark.read.parquet(silver).count() == 2
    # A full refresh is a run with a new checkpoint into an empty folder.
    again = str(tmp_path / "again")
    flows.finish(flows.silver_flow(landing.stream_reports(spark, landing_path), again, str(tmp_path / "c3")))
    assert contents(spark.read.parquet(again)) == contents(spark.read.parquet(silver))
    # Stored bronze can be streamed as well as landed files.
    stored = tables.stream_stored(spark, landing_path, schemas.BRONZE)
    flows.finish(flows.quarantine_flow(stored, str(tmp_path / "q2"), str(tmp_path / "c4")))
    assert contents(spark.read.parquet(str(tmp_path / "q2")).drop("quarantine_timestamp")) == contents(
        spark.read.parquet(quarantine).drop("quarantine_timestamp")
    )
    land(spark, landing_path, fx.report(client="late", day=D1))
    run()
    whole = contents(medallion.silver_enriched(landing.read_reports(spark, landing_path)))
    assert contents(spark.read.parquet(silver).drop("ingest_batch")) == whole


def test_every_job_works_on_streamed_tables(spark, tmp_path):
    """Rows after each job equal those of the same job on a table written in one batch."""
    landing_path, silver, quarantine = str(tmp_path / "landing"), str(tmp_path / "silver"), str(tmp_path / "quarantine")
    staging = str(tmp_path / "staging")
    for n in range(6):
        land(spark, landing_path, fx.report(client=f"c{n}", day=D1), fx.report(client=f"q{n}", count=-1, day=D2), fx.report(client="c0", day=D1))
        bronze = landing.stream_reports(spark, landing_path)
        flows.finish(flows.silver_flow(bronze, silver, str(tmp_path / "c1")))
        flows.finish(flows.quarantine_flow(bronze, quarantine, str(tmp_path / "c2")))
    rows = lambda path=silver: contents(spark.read.parquet(path).drop("ingest_batch"))
    assert rows() == contents(medallion.silver_enriched(landing.read_reports(spark, landing_path)))

    source = fx.silver(spark, fx.silver_row("c1", 1704880000000, content="new", day=D1), fx.silver_row("new", 1, day=D2))
    batch = str(tmp_path / "batch")
    tables.write_partitioned(spark.read.parquet(silver).drop("ingest_batch"), batch, ["eventDate"])
    for path in (silver, batch):
        merge.merge_table(spark, path, source, staging)
    assert rows() == rows(batch)

    before, files_before = rows(), files.data_files(spark, silver).count()
    assert maintenance.compact(spark, silver, staging) == [D1]
    assert rows() == before and files.data_files(spark, silver).count() == 2 < files_before
    assert maintenance.compact(spark, silver, staging) == []

    for path in (silver, batch):
        repair.dedupe_silver(spark, path, None, confirm=True)
    assert rows() == rows(batch)

    done = lambda ids: repair.merge_source(spark.read.parquet(quarantine).filter(f"clientId in ({ids})"))
    assert repair.clean_up(spark, quarantine, done("'q0', 'q1'"), "mark_processed", True, batch_id=F.lit("b"))
    assert repair.clean_up(spark, quarantine, done("'q0', 'q1'"), "mark_processed", True, batch_id=F.lit("c"))
    assert spark.read.parquet(quarantine).filter("processed_id = 'b'").count() == 2
    assert repair.clean_up(spark, quarantine, done("'q0', 'q1'"), "archive", True, archive_path=str(tmp_path / "archive"))
    assert repair.clean_up(spark, quarantine, done("'q2'"), "delete", True)
    assert (spark.read.parquet(str(tmp_path / "archive")).count(), spark.read.parquet(quarantine).count()) == (2, 3)
    maintenance.drop_expired(spark, silver, "2024-01-12", 10, confirm=True)
    assert {r.eventDate for r in spark.read.parquet(silver).collect()} == {D2}


def test_routed_flow_refreshes_gold_for_late_dates(spark, landing_path, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("silver", "quarantine", "gold", "staging", "log")}
    handle = flows.route_batch(
        spark, paths["silver"], paths["quarantine"], paths["gold"], paths["staging"], paths["log"], distinct="exact"
    )

    def run():
        flows.finish(flows.routed_flow(landing.stream_reports(spark, landing_path), handle, str(tmp_path / "c")))

    def check():
        bronze = landing.read_reports(spark, landing_path)
        silver = spark.read.parquet(paths["silver"])
        assert contents(silver.drop("ingest_batch")) == contents(medallion.silver_enriched(bronze))
        full = medallion.gold_viewer_qos(medallion.silver_enriched(bronze), "exact")
        assert contents(spark.read.parquet(paths["gold"])) == contents(full)
        assert spark.read.parquet(paths["quarantine"]).count() == medallion.quarantine(bronze).count()

    run()
    check()
    run()
    check()
    land(spark, landing_path, fx.report(client="late", day=D1), fx.report(client="new", day=D2))
    run()
    check()
    # A replayed batch overwrites its own folders.
    replay = spark.createDataFrame([fx.report(client="late", day=D1), fx.report(client="new", day=D2)], schemas.BRONZE)
    handle(replay, 1)
    check()
    assert maintenance.log_table(spark, paths["log"]).count() == 2  # a replay is not a new version

    # Merging into the streamed table keeps its folders consistent.
    source = fx.silver(spark, fx.silver_row("fixed", 7, day=D1))
    before = spark.read.parquet(paths["silver"]).count()
    merge.merge_table(spark, paths["silver"], source, paths["staging"])
    assert merge.merge_table(spark, paths["silver"], source, paths["staging"])["rows_updated"] == 1
    assert spark.read.parquet(paths["silver"]).count() == before + 1

    # So do compaction and clean-up of streamed tables.
    rows = lambda: contents(spark.read.parquet(paths["silver"]).drop("ingest_batch"))
    stored = rows()
    maintenance.compact(spark, paths["silver"], paths["staging"])
    assert rows() == stored
    faults = spark.read.parquet(paths["quarantine"])
    done = repair.merge_source(faults)
    assert done.count() == 1
    assert repair.clean_up(spark, paths["quarantine"], done, "mark_processed", True, batch_id=F.lit("b"))
    assert spark.read.parquet(paths["quarantine"]).filter("processed_id = 'b'").count() == 1


MARKS = [
    ("BUFFER_START", 10), ("PLAYBACK_START", 25), ("BUFFER_END", 30), ("BUFFER_START", 50), ("BUFFER_END", 65),
    ("SEEKING", 70), ("BUFFER_START", 71), ("SEEKED", 80), ("BUFFER_END", 81),
]
HOUR = 3_600_000


def totals_of(df):
    return {r.playbackSessionId: tuple(r)[1:6] for r in df.select("playbackSessionId", *session_state.TOTALS).collect()}


def run_sessions(spark, base, rows):
    """One portion of signals arrives and a triggered run takes it."""
    zone, store, totals = (str(base / n) for n in ("signals", "store", "totals"))
    rows.write.mode("append").parquet(zone)
    handle = session_state.session_handler(spark, store, totals, width=3)
    stream = tables.stream_stored(spark, zone, rows.schema)
    flows.finish(flows.routed_flow(stream, handle, str(base / "c")))
    return handle, session_state.current_totals(spark, totals)


def test_running_sessions_equal_batch(spark, tmp_path):
    df = fx.signals(spark, *MARKS)
    for part in (F.col("sequenceNumber") < 4, F.col("sequenceNumber") >= 4):
        _, now = run_sessions(spark, tmp_path, df.filter(part))
    last = sessions.buffer_timeline(df).orderBy(F.col("sequenceNumber").desc()).first()
    assert totals_of(now) == {"s": (8, last.totalRebufferMs, last.stallCount, last.startupStallCount, 9)}


def test_late_signals_and_long_pauses_count(spark, tmp_path):
    """A signal two runs late, one a day late, a session that goes on after seven hours, and its own order each time."""
    other = [("PLAYBACK_START", 5), ("BUFFER_START", 7 * HOUR + 10), ("BUFFER_END", 7 * HOUR + 30), ("BUFFER_START", 40 * HOUR)]
    whole = fx.signals(spark, *MARKS).unionByName(fx.signals(spark, *other, session="t"))
    s, t, at = F.col("playbackSessionId") == "s", F.col("playbackSessionId") == "t", F.col("sequenceNumber")
    portions = [
        (s & at.isin(0, 3, 4)) | (t & (at == 0)), (s & at.isin(5, 7, 8)) | (t & at.isin(2, 3)), (s & (at == 1)) | (t & (at == 1)),
        s & at.isin(2, 6),
    ]
    seen = None
    for portion in portions:
        seen = portion if seen is None else seen | portion
        handle, now = run_sessions(spark, tmp_path, whole.filter(portion))
        assert totals_of(now) == totals_of(session_state.session_totals(whole.filter(seen)))
    assert now.count() == 2
    handle(whole.filter(portions[-1]), 3)  # a replay of the last run changes nothing
    assert totals_of(session_state.current_totals(spark, str(tmp_path / "totals"))) == totals_of(session_state.session_totals(whole))
    handle(whole.limit(0), 4)
    assert session_state.current_totals(spark, str(tmp_path / "totals")).count() == 2


def test_sessions_open_the_days_they_touch(spark, tmp_path):
    day = 24 * HOUR
    old = fx.signals(spark, ("PLAYBACK_START", 5), session="old")
    new = fx.signals(spark, ("PLAYBACK_START", 90 * day), ("BUFFER_START", 90 * day + 5), session="new")
    run_sessions(spark, tmp_path, old)
    store = str(tmp_path / "store" / "signal_day=1970-01-01" / "ingest_batch=0")
    before = [r.modified for r in files.data_files(spark, store).collect()]
    files.delete(spark, store)  # nothing may need it
    _, now = run_sessions(spark, tmp_path, new)
    assert before and set(totals_of(now)) == {"old", "new"}


def test_odd_signals(spark, tmp_path):
    df = fx.signals(spark, *MARKS, session=None)
    df = df.unionByName(df.limit(1).withColumn("event_timestamp", F.lit(None).cast("bigint")).withColumn("playbackSessionId", F.lit("n")))
    _, now = run_sessions(spark, tmp_path, df)
    assert totals_of(now) == totals_of(session_state.session_totals(df)) and set(totals_of(now)) == {None, "n"}


@pytest.fixture()
def mixed_landing(spark, tmp_path):
    """Date folders of three schemas: as hinted, with an added column, with values of other types."""
    path = str(tmp_path / "landing")
    plain = fx.bronze(spark, fx.report()).drop("eventDate", "_rescued_data").coalesce(1)
    plain.write.parquet(f"{path}/eventDate=2024-01-10")
    plain.withColumn("cdn", F.lit("edge")).write.parquet(f"{path}/eventDate=2024-01-11")
    odd = plain.withColumn("player", F.struct(F.lit("two").alias("bufferings"), F.lit(7).alias("bufferingTime")))
    odd.withColumn("customerId", F.lit(5)).write.parquet(f"{path}/eventDate=2024-01-12")
    plain.write.mode("append").parquet(f"{path}/eventDate=2024-01-12")
    return path


def test_stream_rescues_like_a_batch(spark, mixed_landing, tmp_path):
    out = str(tmp_path / "bronze")

    def run():
        write = flows.table_writer(out, ["eventDate"])
        flows.finish(flows.ingest_flow(spark, mixed_landing, write, str(tmp_path / "c"), files_per_batch=2))
        return spark.read.option("mergeSchema", True).parquet(out).drop("ingest_batch")

    assert contents(run()) == contents(landing.read_reports(spark, mixed_landing))
    rows = {(str(r.eventDate), r.customerId): r for r in run().collect()}
    assert len(rows) == 4 and '"bufferings":"two"' in rows["2024-01-12", "5"]._rescued_data
    more = fx.bronze(spark, fx.report(client="late")).drop("eventDate", "_rescued_data").withColumn("asn", F.lit(7))
    more.write.mode("append").parquet(f"{mixed_landing}/eventDate=2024-01-10")
    assert contents(run()) == contents(landing.read_reports(spark, mixed_landing)) and "asn" in run().columns


def test_audited_ingest(spark, mixed_landing, tmp_path):
    out = str(tmp_path / "bronze")
    flows.finish(flows.ingest_flow(spark, mixed_landing, flows.table_writer(out, ["eventDate"]), str(tmp_path / "c"), audit=True))
    rows = spark.read.option("mergeSchema", True).parquet(out).collect()
    assert all(r._ingest_timestamp and f"eventDate={r.eventDate}" in r._source_file for r in rows) and len(rows) == 4


def test_ledger_looks_at_new_files_only(spark, mixed_landing, tmp_path, monkeypatch):
    ledger, looked = str(tmp_path / "ledger"), []
    groups = landing._groups
    monkeypatch.setattr(landing, "_groups", lambda s, p, parts: (looked.append(len(parts)), groups(s, p, parts))[1])
    first = contents(landing.read_reports(spark, mixed_landing, ledger))
    assert first == contents(landing.read_reports(spark, mixed_landing)) and looked[0] == 4
    looked.clear()
    assert contents(landing.read_reports(spark, mixed_landing, ledger)) == first and looked == []
    fx.bronze(spark, fx.report(client="late")).drop("eventDate", "_rescued_data").coalesce(1).write.mode("append").parquet(f"{mixed_landing}/eventDate=2024-01-10")
    assert len(landing.read_reports(spark, mixed_landing, ledger).collect()) == 5 and looked == [1]


def test_many_folders_cost_one_job(spark, tmp_path):
    path = str(tmp_path / "landing")
    rows = fx.bronze(spark, *[fx.report(day=date(2024, 1, 1 + n)) for n in range(25)])
    tables.write_partitioned(rows, path, ["eventDate"])
    spark.sparkContext.setJobGroup("footers", "")
    assert len(landing._by_schema(spark, path)) == 1
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 2


def test_runs_leave_their_log(spark, landing_path, tmp_path):
    log = str(tmp_path / "log")
    bronze = landing.stream_reports(spark, landing_path)
    flows.finish(flows.silver_flow(bronze, str(tmp_path / "s"), str(tmp_path / "c1")), spark, log)

    def fail(rows, batch_id):
        raise ValueError("no")

    with pytest.raises(Exception):
        flows.finish(flows.routed_flow(bronze, fail, str(tmp_path / "c2")), spark, log)
    found = maintenance.run_history(maintenance.log_table(spark, log), "2030-01-01 00:00:00").collect()
    assert [(r.state, r.status_icon) for r in found] == [("FAILED", "✗"), ("COMPLETED", "✓")]


def test_archive_takes_each_row_once(spark, tmp_path):
    """A crash between archive and delete, then new faulty rows, then a retry."""
    quarantine, box = str(tmp_path / "q"), str(tmp_path / "archive")
    put = lambda *reports: tables.write_partitioned(
        medallion.quarantine(fx.bronze(spark, *reports)), quarantine, tables.QUARANTINE_PARTITIONS, mode="append"
    )
    put(fx.report(client="a", count=-1), fx.report(client="b", ms=-5), fx.report(client="keep", count=-1, day=D1))
    rows = spark.read.parquet(quarantine)
    done = rows.filter("clientId <> 'keep'")
    repair._archive(spark, done, box)  # the crash comes before the table shrinks
    put(fx.report(client="c", count=-1))
    done = spark.read.parquet(quarantine).filter("clientId <> 'keep'")
    done = spark.createDataFrame(done.collect(), done.schema)  # the first attempt takes its files away
    for _ in range(2):
        assert repair.clean_up(spark, quarantine, done, "archive", True, archive_path=box)
    assert sorted(r.clientId for r in spark.read.parquet(box).collect()) == ["a", "b", "c"]
    assert [r.clientId for r in spark.read.parquet(quarantine).collect()] == ["keep"]
    assert files.subfolders(spark, f"{quarantine}/eventDate=2024-01-10") == []


def test_the_table_is_never_moved(spark, tmp_path, monkeypatch):
    quarantine = str(tmp_path / "q")
    rows = medallion.quarantine(fx.bronze(spark, fx.report(client="a", count=-1), fx.report(client="b", count=-1, day=D1)))
    tables.write_partitioned(rows, quarantine, tables.QUARANTINE_PARTITIONS)
    monkeypatch.setattr(files, "rename", lambda *a: pytest.fail("moved"))
    before = {r.path: r.modified for r in files.data_files(spark, f"{quarantine}/eventDate=2024-01-01").collect()}
    assert repair.clean_up(spark, quarantine, rows.filter("clientId = 'a'"), "delete", True)
    assert [r.clientId for r in spark.read.parquet(quarantine).collect()] == ["b"]
    assert {r.path: r.modified for r in files.data_files(spark, f"{quarantine}/eventDate=2024-01-01").collect()} == before
