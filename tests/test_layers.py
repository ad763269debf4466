"""How often wide rows are shuffled, sorted or kept on the way to the stored layers."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from playlens.catalog import sinks
from playlens.catalog.lake import Lake
from playlens.operators import merge
from playlens.plans import collected, sessions
from playlens.session import configure
from playlens.sources import adapter, tables
from playlens.streaming import flows, session_state

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
KINDS = ["signup", "click", "view", "purchase", "error"]


@pytest.fixture()
def few(spark, tmp_path):
    """A folder with an events table of 60 rows over two days and three users."""
    rows = [
        (90 + i, datetime(2024, 1, 28 + i // 30, i % 24, i), i % 3, KINDS[i % 5], i * 0.5, f'{{"k": {i * 7 % 100}}}') for i in range(60)
    ]
    spark.createDataFrame(rows, EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def _packed_frames(monkeypatch) -> list:
    """Frames that are shuffled by partition before a write, as they come."""
    seen, pack = [], tables.packed
    monkeypatch.setattr(tables, "packed", lambda df, partitions: seen.append(df) or pack(df, partitions))
    return seen


def test_bronze_and_signals_are_written_as_dealt(spark, few, monkeypatch):
    """Their slim events are dealt out by time; the wide rows are neither shuffled nor sorted again."""
    seen = _packed_frames(monkeypatch)
    lk = Lake(spark, few)
    assert lk.bronze.count() == lk.signals.count() == 60
    assert not seen
    configure(spark)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 30


def test_copies_of_layers_are_not_shuffled(spark, few, monkeypatch):
    lk = Lake(spark, few)
    layers = [lk.silver, lk.gold]
    seen = _packed_frames(monkeypatch)
    done = sinks.Sinks(lk).reprocessed
    assert not any(df is layer for df in seen for layer in layers)
    assert done.read("silver").count() >= lk.silver.count()


def test_a_micro_batch_is_not_kept(spark, tmp_path, monkeypatch):
    kept = []

    def refresh(*_, **__):
        kept.append(spark.sparkContext._jsc.sc().getPersistentRDDs().size())
        return 0

    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    monkeypatch.setattr(merge, "refresh_gold_table", refresh)
    handle = flows.route_batch(spark, *[str(tmp_path / n) for n in ("silver", "quarantine", "gold", "staging")])
    handle(fx.bronze(spark, fx.report(), fx.report(client="U2", count=-1)), 0)
    assert kept == [before]
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 1
    assert spark.read.parquet(str(tmp_path / "quarantine")).count() == 1


def test_session_history_is_found_once(spark, tmp_path, monkeypatch):
    plans, totals = [], session_state.session_totals

    def watch(signals, width):
        plans.append(signals._jdf.queryExecution().optimizedPlan().toString())
        return totals(signals, width)

    monkeypatch.setattr(session_state, "session_totals", watch)
    handle = session_state.session_handler(spark, str(tmp_path / "store"), str(tmp_path / "totals"))
    handle(fx.signals(spark, ("BUFFER_START", 1000), ("BUFFER_END", 1500)), 0)
    assert len(plans) == 1 and "Join" not in plans[0]
    found = session_state.current_totals(spark, str(tmp_path / "totals")).first()
    assert (found.totalRebufferMs, found.signal_count) == (500, 2)


def test_posted_state_is_worked_out_on_narrow_rows(spark, few, monkeypatch):
    passes = []
    for name in ("flushes", "buffer_timeline", "quality_switches"):
        step = getattr(sessions, name)
        monkeypatch.setattr(sessions, name, lambda df, *more, step=step: passes.append(df.columns) or step(df, *more))
    signals = adapter.player_signals(adapter.read_table(spark, few, "events"))
    posted = collected.posted_events(signals)
    assert len(passes) == 3 and not any(set(c) & {"userAgent", "tenantId", "rtt"} for c in passes)
    agents = posted.filter("_place = 0").select(
        F.get_json_object("event", "$.sequenceNumber").cast("bigint").alias("seq"), F.get_json_object("event", "$.environment.userAgent").alias("agent")
    )
    assert dict(agents.collect()) == {r.sequenceNumber: r.userAgent for r in signals.collect() if r.sequenceNumber in dict(agents.collect())}
    silent = F.col("eventType").isin(collected.SILENT) | ((F.col("eventType") == "ERROR") & ~F.col("fatal"))
    assert agents.count() == signals.filter(~silent).count()


def test_signals_that_come_twice_are_posted_as_before(spark):
    """Equal signals post one event each; a fatal error or switch that comes twice meets its details twice."""
    lines = [("PLAYBACK_START", False), ("BUFFER_START", False), ("BUFFER_START", False), ("ERROR", True), ("ERROR", True)]
    rows = [
        ("s", min(i, 3) if kind == "ERROR" else min(i, 1), 1000 * min(i, 3), kind, "T", "U", "UA", None, 1, 0, 1.0, "x", "y", fatal, None, None, None, None)
        for i, (kind, fatal) in enumerate(lines)
    ]
    rows[2] = rows[1]
    names = "playbackSessionId string, sequenceNumber bigint, event_timestamp bigint, eventType string, tenantId string, userId string,"
    names += " userAgent string, resolution string, bitrateBps bigint, droppedFrames bigint, currentTimeSec double, errorDetails string,"
    names += " errorType string, fatal boolean, bandwidthEstimate double, effectiveType string, downlink double, rtt double"
    posted = collected.posted_events(spark.createDataFrame(rows, names))
    kinds = posted.groupBy(F.get_json_object("event", "$.eventType")).count()
    assert dict(kinds.collect()) == {"PLAYBACK_START": 1, "BUFFER_START": 2, "ERROR": 4}
