from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from playlens import schemas
from playlens.operators import dedupe, maintenance, medallion, merge, repair
from playlens.plans import contracts
from playlens.sources import files, tables

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def contents(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture()
def silver_path(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [fx.silver_row(client=c, server=s, day=d) for c in ("a", "b") for s, d in ((1, D1), (2, D2))]
    tables.write_partitioned(fx.silver(spark, *rows), path, ["eventDate"])
    return path


def test_merge_updates_inserts_and_is_idempotent(spark, silver_path, tmp_path):
    staging = str(tmp_path / "staging")
    source = fx.silver(spark, fx.silver_row("a", 1, ms=7000, day=D1), fx.silver_row("new", 9, day=D1))
    counts = merge.merge_table(spark, silver_path, source, staging)
    assert counts == {"rows_updated": 1, "rows_inserted": 1, "rows_out": 3}
    once = contents(spark.read.parquet(silver_path))
    assert merge.merge_table(spark, silver_path, source, staging)["rows_inserted"] == 0
    assert contents(spark.read.parquet(silver_path)) == once
    assert spark.read.parquet(silver_path).count() == 5
    assert not files.exists(spark, staging)


def test_merge_refuses_duplicate_source_keys(spark, silver_path, tmp_path):
    source = fx.silver(spark, fx.silver_row("a", 1, ms=1, day=D1), fx.silver_row("a", 1, ms=2, day=D1))
    with pytest.raises(ValueError, match="several rows"):
        merge.merge_table(spark, silver_path, source, str(tmp_path / "staging"))


def test_upsert_updates_every_copy_and_never_matches_null(spark):
    target = fx.silver(spark, fx.silver_row("a", 1), fx.silver_row("a", 1), fx.silver_row("b", 1))
    source = fx.silver(spark, fx.silver_row("a", 1, count=5))
    assert merge.upsert(target, source).filter("buffering_count = 5").count() == 2
    nulls = source.withColumn("clientId", F.lit(None).cast("string"))
    assert merge.upsert(nulls, nulls).count() == 2


def test_refresh_of_affected_dates_equals_full_recompute(spark, silver_path, tmp_path):
    gold_path, staging = str(tmp_path / "gold"), str(tmp_path / "staging")
    silver = spark.read.parquet(silver_path)
    tables.write_partitioned(medallion.gold_viewer_qos(silver, "exact"), gold_path, ["eventDate"])
    late = fx.silver(spark, fx.silver_row("late", 5, day=D1))
    merge.merge_table(spark, silver_path, late, staging)
    merge.refresh_gold_table(spark, gold_path, silver_path, merge.dates_of(late), staging, "exact")
    full = medallion.gold_viewer_qos(spark.read.parquet(silver_path), "exact")
    assert contents(spark.read.parquet(gold_path)) == contents(full)


def test_refresh_drops_dates_without_silver(spark, silver_path, tmp_path):
    gold_path, staging = str(tmp_path / "gold"), str(tmp_path / "staging")
    tables.write_partitioned(medallion.gold_viewer_qos(spark.read.parquet(silver_path)), gold_path, ["eventDate"])
    dates = [D1]
    files.delete(spark, f"{silver_path}/eventDate=2024-01-01")
    assert merge.refresh_gold_table(spark, gold_path, silver_path, dates, staging) == 0
    assert {r.eventDate for r in spark.read.parquet(gold_path).collect()} == {D2}


def test_keep_one_takes_the_latest(spark):
    rows = [fx.silver_row(agent=a, content=c) for a, c in ((None, "x"), (5, "y"), (9, "z"), (9, "w"))]
    kept = dedupe.keep_one(fx.silver(spark, *rows), schemas.SILVER_KEY).collect()
    assert [(r.timestamp_agent, r.contentId) for r in kept] == [(9, "z")]
    plan = dedupe.keep_one(fx.silver(spark, *rows), schemas.SILVER_KEY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_distinct_rows_and_keys_differ(spark):
    silver = fx.silver(spark, fx.silver_row(), fx.silver_row(), fx.silver_row(ms=2))
    assert dedupe.distinct_rows(silver).count() == 2
    assert dedupe.keep_one(silver, schemas.SILVER_KEY).count() == 1
    bronze = fx.bronze(spark, fx.report(), fx.report())
    assert dedupe.distinct_rows(bronze).count() == 1


def test_dedupe_job(spark, silver_path):
    extra = fx.silver(spark, fx.silver_row("a", 1, ms=9, day=D1))
    tables.write_partitioned(extra, silver_path, ["eventDate"], mode="append")
    assert repair.dedupe_silver(spark, silver_path, None).first().duplicates_removed == 1
    assert spark.read.parquet(silver_path).count() == 5
    repair.dedupe_silver(spark, silver_path, None, confirm=True)
    assert spark.read.parquet(silver_path).count() == 4


def quarantined(spark):
    return medallion.quarantine(
        fx.bronze(
            spark, fx.report(count=-2, client="a", day=D2), fx.report(ms=4_000_000, client="b", day=D2),
            fx.report(source=-9, client="c", day=D1),
        ),
        F.lit("2024-01-02").cast("timestamp"),
    )


def test_repair_order(spark):
    rows = {r.clientId: r for r in repair.repair_quarantine(quarantined(spark)).collect()}
    assert (rows["a"].buffering_count, rows["b"].buffering_time_sec, rows["c"].total_source_data) == (2, 3600.0, 9)
    original = {r.clientId: r for r in repair.fix_basic(quarantined(spark)).collect()}
    assert original["b"].buffering_time_sec == 4000.0


def test_reprocess_and_clean_up(spark, tmp_path):
    silver_path, gold_path, q_path = (str(tmp_path / n) for n in ("silver", "gold", "quarantine"))
    silver = fx.silver(spark, fx.silver_row("x", 1, day=D1))
    tables.write_partitioned(silver, silver_path, ["eventDate"])
    tables.write_partitioned(medallion.gold_viewer_qos(silver, "exact"), gold_path, ["eventDate"])
    tables.write_partitioned(quarantined(spark), q_path, tables.QUARANTINE_PARTITIONS)
    bad = spark.read.parquet(q_path)
    job = (spark, silver_path, gold_path, bad, str(tmp_path / "staging"), "2024-01-02")
    plan = repair.reprocess(*job).first()
    assert (plan.original_records, plan.fixed_records, plan.success_rate_pct) == (3, 3, 100.0)
    assert spark.read.parquet(silver_path).count() == 1
    assert repair.reprocess(*job, confirm=True, distinct="exact")["rows_inserted"] == 3
    after = spark.read.parquet(silver_path)
    assert contents(spark.read.parquet(gold_path)) == contents(medallion.gold_viewer_qos(after, "exact"))

    done = repair.merge_source(bad.filter("quarantine_reason = 'negative_buffering_count'"))
    assert not repair.clean_up(spark, q_path, done, "delete")
    with pytest.raises(ValueError):
        repair.clean_up(spark, q_path, done, "burn", True)
    assert repair.clean_up(spark, q_path, done, "mark_processed", True, batch_id=F.lit("b1"))
    marked = spark.read.parquet(q_path)
    assert marked.filter("processed_id = 'b1'").count() == 1 and repair.unprocessed(marked).count() == 2
    archive = str(tmp_path / "archive")
    done = repair.merge_source(marked.filter("processed_id = 'b1'"))
    assert repair.clean_up(spark, q_path, done, "archive", True, archive_path=archive)
    assert (spark.read.parquet(archive).count(), spark.read.parquet(q_path).count()) == (1, 2)
    rest = repair.merge_source(spark.read.parquet(q_path))
    assert repair.clean_up(spark, q_path, rest, "delete", True)
    assert spark.read.schema(marked.schema).parquet(q_path).count() == 0


def test_retention_drops_whole_dates(spark, silver_path):
    assert maintenance.drop_expired(spark, silver_path, "2024-01-12", 10) == ["eventDate=2024-01-01"]
    assert spark.read.parquet(silver_path).count() == 4
    maintenance.drop_expired(spark, silver_path, "2024-01-12", 10, confirm=True)
    assert {r.eventDate for r in spark.read.parquet(silver_path).collect()} == {D2}


def test_compaction_keeps_the_rows(spark, silver_path, tmp_path):
    for n in range(6):
        tables.write_partitioned(fx.silver(spark, fx.silver_row("c", n, day=D1)), silver_path, ["eventDate"], "append")
    before = contents(spark.read.parquet(silver_path))
    n_before = files.data_files(spark, silver_path).count()
    maintenance.compact(spark, silver_path, str(tmp_path / "staging"))
    assert contents(spark.read.parquet(silver_path)) == before
    assert files.data_files(spark, silver_path).count() == 2 < n_before


def test_a_crash_leaves_a_readable_table(spark, silver_path, tmp_path):
    stored = contents(spark.read.parquet(silver_path))
    files.make_folder(spark, f"{silver_path}.old")
    files.rename(spark, f"{silver_path}/eventDate=2024-01-01", f"{silver_path}.old/eventDate=2024-01-01")
    assert tables.recover_folders(spark, silver_path) == ["eventDate=2024-01-01"]
    assert contents(spark.read.parquet(silver_path)) == stored
    files.rename(spark, silver_path, f"{silver_path}.old")
    assert tables.recover_table(spark, silver_path) and not tables.recover_table(spark, silver_path)
    assert contents(spark.read.parquet(silver_path)) == stored


def test_archiving_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "archive")
    for _ in range(2):  # as after a crash between the archive and the table
        repair._archive(spark, quarantined(spark), path)
    assert spark.read.parquet(path).count() == 3


def test_only_dates_with_too_many_files_are_compacted(spark, silver_path, tmp_path):
    for n in range(3):
        tables.write_partitioned(fx.silver(spark, fx.silver_row("c", n, day=D2)), silver_path, ["eventDate"], "append")
    kept = set(r.path for r in files.data_files(spark, f"{silver_path}/eventDate=2024-01-01").collect())
    before = contents(spark.read.parquet(silver_path))
    if len(kept) == 1:
        assert maintenance.compact(spark, silver_path, str(tmp_path / "staging")) == [D2]
        assert kept == set(r.path for r in files.data_files(spark, f"{silver_path}/eventDate=2024-01-01").collect())
    assert contents(spark.read.parquet(silver_path)) == before


def test_replayed_version_is_logged_once(spark, tmp_path):
    log = str(tmp_path / "log")
    maintenance.ensure_log(spark, log)
    for _ in range(2):
        maintenance.log_run(spark, log, layer="gold", version=3, operation="WRITE", rows_out=1)
    assert maintenance.log_table(spark, log).count() == 1


def test_no_shuffle_by_date_or_raw_customer(spark, silver_path):
    silver = spark.read.parquet(silver_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        source = fx.silver(spark, fx.silver_row("a", 1, day=D1))
        gold = medallion.gold_viewer_qos(silver, "exact")
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        dates = merge.dates_of(source)
        assert "Join" not in plan(merge.refresh_gold(gold, silver, dates, "exact"))
        assert "Exchange" not in plan(merge.on_dates(silver, dates)) and "2024-01-01" in plan(merge.on_dates(silver, dates))
        # folded to distinct customers on both sides before they meet
        assert plan(contracts.shared_customers(silver, silver)).count("HashAggregate") >= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_replacement_must_keep_the_schema(spark, silver_path):
    rows = spark.read.parquet(silver_path)
    with pytest.raises(ValueError, match="schema"):
        tables.replace_table(spark, rows.drop("quality_data_mb"), silver_path)
    tables.replace_table(spark, rows.filter("clientId = 'a'"), silver_path, ["eventDate"])
    assert spark.read.parquet(silver_path).count() == 2


def test_run_log_and_storage(spark, silver_path, tmp_path):
    log = str(tmp_path / "log")
    maintenance.ensure_log(spark, log)
    for v in range(8):
        maintenance.log_run(
            spark, log, layer="silver", version=v, ts=datetime(2024, 1, 1, v), operation="MERGE" if v else "DELETE",
            rows_updated=v, run_id=f"r{v}", state="FAILED" if v == 7 else "COMPLETED", started=datetime(2024, 1, 1, v),
            finished=None if v == 7 else datetime(2024, 1, 1, v, 30),
        )
    history = maintenance.change_history(maintenance.log_table(spark, log)).collect()
    assert [r.version for r in history] == [7, 6, 5, 4, 3] and history[0].rows_inserted == 0
    runs = maintenance.run_history(maintenance.log_table(spark, log), "2024-01-01 08:00:00", 2).collect()
    assert [(r.status_icon, r.duration_minutes) for r in runs] == [("✗", 60), ("✓", 30)]
    report = maintenance.storage_report(spark, {"silver": silver_path}).first()
    assert report.file_count > 0 and report.optimization_status.startswith("⚠ Small")
    size = 1024**3
    snaps = [("t", D1, size), ("t", D2, 201 * size)]
    growth = maintenance.storage_growth(spark.createDataFrame(snaps, "table_name string, snapshot_date date, size_bytes bigint"))
    assert [(r.growth_gb_per_day, r.status) for r in growth.orderBy("snapshot_date").collect()] == [(None, "OK"), (200.0, "WARNING")]


def test_contract_checks(spark, tmp_path):
    bronze, silver = fx.bronze(spark, fx.report()), fx.silver(spark, fx.silver_row(ms=3_600_001), fx.silver_row("b"))
    assert contracts.bronze_schema(bronze).first().status == "PASS"
    wider = bronze.withColumn("cdn", F.lit(1))
    assert contracts.bronze_schema(wider).first().status == "PASS"
    assert contracts.bronze_schema(wider, allow_extra=False).first().status == "FAIL"
    assert contracts.silver_schema(silver.drop("eventDate")).first().status == "FAIL"
    assert contracts.value_ranges(silver).first().status == "WARN"
    assert contracts.tables_exist(spark, {"x": str(tmp_path / "none")}).first().status == "FAIL"
    results = contracts.run_checks(
        spark,
        {
            "schema": lambda: contracts.silver_schema(silver),
            "ranges": lambda: contracts.value_ranges(silver),
            "broken": lambda: silver.select("nothing"),
        },
    )
    assert {r.check: r.status for r in results.collect()} == {
        "Silver Layer Schema Validation": "PASS", "Value Range Validation": "WARN", "broken": "FAIL",
    }
    assert {r.category: r.success_pct for r in contracts.summary_by_category(results).collect()}["Execution"] == 0.0
    assert contracts.summary_by_status(results).count() == 3
