from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import fixtures as fx
from playlens.operators.sequence import GroupMin, LastValue, RunningMax, RunningSum, chunk, with_running
from playlens.plans import sessions


@pytest.mark.parametrize("width", [1, 3, 7, 1000])
def test_running_state_equals_plain_windows(spark, width):
    """Chunks of any width give what one window over the whole key gives."""
    rng = random.Random(7)
    rows = [(rng.choice("abz"), i, rng.choice([None, 1, 2, 5]), rng.choice([None, "x", "y"])) for i in range(120)]
    df = spark.createDataFrame(rows, "key string, seq bigint, n bigint, mark string")
    n, mark = F.col("n"), F.col("mark")
    state = {
        "total": RunningSum(n),
        "total_before": RunningSum(n, inclusive=False),
        "top": RunningMax(n),
        "last_mark": LastValue(mark),
        "mark_before": LastValue(mark, inclusive=False),
        "low": GroupMin(n),
    }
    whole = Window.partitionBy("key").orderBy("seq")
    to_here = whole.rowsBetween(Window.unboundedPreceding, 0)
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    expected = df.select(
        "*",
        F.coalesce(F.sum(n).over(to_here), F.lit(0)).alias("total"),
        F.coalesce(F.sum(n).over(before), F.lit(0)).alias("total_before"),
        F.max(n).over(to_here).alias("top"),
        F.last(mark, ignorenulls=True).over(to_here).alias("last_mark"),
        F.last(mark, ignorenulls=True).over(before).alias("mark_before"),
        F.min(n).over(Window.partitionBy("key")).alias("low"),
    )
    actual = with_running(df, ["key"], "seq", state, width)
    assert sorted(map(repr, actual.collect())) == sorted(map(repr, expected.collect()))


def test_nulls_ties_and_sparse_values_lose_nothing(spark):
    rows = [("a", None, 1), ("a", 5, 2), ("a", 5, 3), (None, 1, 4), (None, 2**47, 5), ("a", -(2**40), 6), ("a", 5, 2)]
    df = spark.createDataFrame(rows, "key string, seq long, n long")
    state = {"total": RunningSum(F.col("n")), "last": LastValue(F.col("n"), inclusive=False), "low": GroupMin(F.col("n"))}
    expected = [
        ("a", None, 1, 1, None, 1), ("a", -(2**40), 6, 7, 1, 1), ("a", 5, 2, 9, 6, 1), ("a", 5, 2, 11, 2, 1),
        ("a", 5, 3, 14, 2, 1), (None, 1, 4, 4, None, 4), (None, 2**47, 5, 9, 4, 4),
    ]
    for width in (1, 7, 1 << 16):
        for frame in (df, df.repartition(5, "n")):
            found = with_running(frame, ["key"], "seq", state, width)
            assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_carry_of_a_sparse_session_is_cut_as_well(spark):
    """Ids far apart make a chunk per row; their carry is windowed in wider chunks."""
    df = spark.range(0, 3000).selectExpr("'s' AS key", "id * 100000 AS seq", "1 AS n")
    found = with_running(df, ["key"], "seq", {"total": RunningSum(F.col("n"))})
    assert found.filter("total != seq div 100000 + 1").count() == 0
    assert "_chunk_" in found._jdf.queryExecution().optimizedPlan().toString()


def intervals(df, width=1000):
    found = sessions.buffer_intervals(sessions.buffer_timeline(df, width)).orderBy("sequenceNumber")
    return [(r.type, r.start_ts, r.durationMs) for r in found.collect()]


@pytest.mark.parametrize("width", [1, 2, 1000])
def test_buffer_pairs(spark, width):
    df = fx.signals(
        spark, ("BUFFER_START", 10), ("BUFFER_START", 20), ("PLAYBACK_START", 25), ("BUFFER_END", 30),
        ("BUFFER_END", 40), ("BUFFER_START", 50), ("BUFFER_END", 65), ("SEEKING", 70), ("BUFFER_START", 71),
        ("SEEKED", 80), ("BUFFER_END", 81),
    )
    assert intervals(df, width) == [("STARTUP", 20, 10), ("STALL", 50, 15), ("SEEK", 71, 10)]
    last = sessions.buffer_timeline(df, width).orderBy(F.col("sequenceNumber").desc()).first()
    assert (last.totalRebufferMs, last.stallCount, last.startupStallCount) == (35, 1, 2)


def test_rebuffer_ratio_without_watch_time(spark):
    df = fx.signals(spark, ("BUFFER_START", 0), ("BUFFER_END", 500)).withColumn("currentTimeSec", F.lit(-3.0))
    row = sessions.playback_quality(sessions.buffer_timeline(df)).orderBy(F.col("sequenceNumber").desc()).first()
    assert (row.watchTimeSec, row.rebufferRatio) == (0.0, 0.0)


@pytest.mark.parametrize("width", [1, 2, 1000])
def test_quality_switches(spark, width):
    df = fx.signals(
        spark, ("PLAYBACK_START", 0, 500, 0), ("QUALITY_SWITCH_START", 10, 900, 1), ("QUALITY_SWITCH_START", 20, 900, 1),
        ("QUALITY_CHANGE", 35, 900, 4), ("QUALITY_CHANGE", 50, 700, 9),
    )
    found = sessions.quality_switches(df, width).orderBy("sequenceNumber").collect()
    assert [(r.fromBitrateBps, r.bitrateBps, r.switchDurationMs, r.droppedFramesDelta) for r in found] == [
        (500, 900, 25, 4),
        (900, 700, None, 5),
    ]


def test_first_frame_and_identity(spark):
    df = fx.signals(spark, ("BUFFER_START", 100), ("PLAYBACK_START", 340), ("PLAYBACK_START", 900))
    assert sessions.time_to_first_frame(df).first().timeToFirstFrameMs == 240
    last = sessions.event_identity(df).orderBy(F.col("sequenceNumber").desc()).first()
    assert (last.eventId, last.elapsedMs) == ("s-900-2", 800)


def test_error_classes_and_summary(spark):
    rows = [
        ("s", 0, 1000, "ERROR", "fragLoadError", "networkError", True),
        ("s", 1, 2000, "ERROR", "internalException", "otherError", False),
        ("s", 2, 3000, "ERROR", "internalException", "otherError", False),
        ("s", 3, 4000, "ERROR", "", None, None),
        ("s", 4, 15000, "ERROR", "internalException", "otherError", False),
    ]
    df = spark.createDataFrame(
        rows,
        "playbackSessionId string, sequenceNumber bigint, event_timestamp bigint, eventType string,"
        " errorDetails string, errorType string, fatal boolean",
    )
    kinds = [(r.code, r.category, r.severity, r.recoverable) for r in sessions.classify_errors(df).orderBy("sequenceNumber").collect()]
    assert kinds[0] == ("fragLoadError", "NETWORKERROR", "fatal", False)
    assert kinds[1] == ("internalException", "OTHERERROR", "warn", True)
    assert kinds[3] == ("unknown", "UNKNOWN", "error", True)
    summary = sessions.error_summary(df)
    counts = {(r.error_key, r.error_count) for r in summary.collect()}
    assert counts == {("internalException|otherError", 2), ("unknown|unknown", 1), ("internalException|otherError", 1)}
    totals = sorted((r.distinctCodes, r.totalCount) for r in sessions.error_totals(summary).collect())
    assert totals == [(1, 1), (2, 3)]


def test_large_session_is_spread_over_chunks(spark):
    """The shuffle that carries the rows is keyed by (session, chunk)."""
    df = spark.range(0, 5000).selectExpr("CAST(id - id AS STRING) AS key", "id AS seq", "1 AS n")
    plan = with_running(df, ["key"], "seq", {"total": RunningSum(F.col("n"))}, 100)
    assert plan.agg(F.max("total"), F.count("*")).first()[:] == (5000, 5000)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in text and "_chunk" in text


def test_fatal_errors_end_batches(spark):
    """Two summaries where a fatal error falls inside ten seconds; the timer goes on as before."""
    rows = [
        ("s", 0, 1000, "PLAYBACK_START", None, None, None), ("s", 1, 2000, "ERROR", "x", "net", False), ("s", 2, 3000, "ERROR", "x", "net", True),
        ("s", 3, 3000, "ERROR", "x", "net", False), ("s", 4, 9999, "ERROR", "y", "net", False), ("s", 5, 10_999, "ERROR", "x", "net", False),
        ("s", 6, 11_000, "ERROR", "x", "net", False), ("s", 7, 12_000, "ERROR", None, None, True), ("s", 8, 13_000, "ERROR", "", None, True),
        ("t", 0, 5000, "ERROR", "x", "net", None), ("t", 1, 15_000, "SEEKING", None, None, None),
    ]
    ddl = "playbackSessionId string, sequenceNumber bigint, event_timestamp bigint, eventType string, errorDetails string, errorType string, fatal boolean"
    flushed = sessions.flushes(spark.createDataFrame(rows, ddl).repartition(3), width=2)
    batches = sorted(tuple(r) for r in sessions.flush_batches(flushed).collect())
    assert batches == [
        ("s", 1000, 0, 3, True), ("s", 1000, 1, 3, False), ("s", 11_000, 0, 2, True), ("s", 11_000, 1, 1, True),
        ("t", 5000, 0, 1, False), ("t", 15_000, 0, 1, False),
    ]
    summaries = sessions.flush_summaries(flushed)
    assert sorted(tuple(r)[1:5] for r in summaries.collect() if r.playbackSessionId == "s") == [
        (1000, 0, "x|net", 1), (1000, 1, "x|net", 2), (1000, 1, "y|net", 1), (11_000, 0, "x|net", 1),
    ]
    totals = sorted(tuple(r)[1:] for r in sessions.flush_totals(summaries).collect() if r.playbackSessionId == "s")
    assert totals == [(1000, 0, 1, 1), (1000, 1, 2, 3), (11_000, 0, 1, 1)]


def test_passes_share_one_shuffle_of_the_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(0, 2000).selectExpr("CAST(id % 7 AS STRING) AS key", "id AS seq", "id % 5 AS n").filter("n >= 0")
        df = df.selectExpr("nullif(key, '3') AS key", "seq", "n")
        rows = chunk(df, "seq", 100, ["key"])
        once = with_running(rows, ["key"], "seq", {"a": RunningSum(F.col("n"))})
        twice = with_running(once, ["key"], "seq", {"b": RunningMax(F.col("n"))})
        whole = Window.partitionBy("key").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
        expected = df.select("*", F.sum("n").over(whole).alias("a"), F.max("n").over(whole).alias("b"))
        assert sorted(map(repr, twice.select(*expected.columns).collect())) == sorted(map(repr, expected.collect()))
        text = twice._jdf.queryExecution().executedPlan().toString()
        # row exchanges carry seq; those of the carry do not
        rows_moved = [x for x in text.split("Exchange hashpartitioning(")[1:] if "_key_key" in x.split("]")[0]]
        assert "isnull" not in "".join(x.split("\n")[0] for x in rows_moved)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
