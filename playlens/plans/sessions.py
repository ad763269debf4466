"""Session analytics over collector events.

A signal frame has one row per player signal: playbackSessionId, sequenceNumber,
event_timestamp (epoch ms), eventType and the signal's fields.  Per-session state is built
with ``with_running``, so a session of any length is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import ellipsis, first_match, or_default, upper_or
from ..operators.sequence import CHUNK_WIDTH, GroupMin, LastValue, RunningMax, RunningSum, chunk, with_running
from .alerts import row_total

SESSION = ["playbackSessionId"]
SEQ = "sequenceNumber"


def _is(kind: str) -> Column:
    return F.col("eventType") == kind


def _seq_of(kind: str) -> Column:
    return F.when(_is(kind), F.col(SEQ))


# --- counts and windows -----------------------------------------------------------------


def type_counts(signals: DataFrame) -> DataFrame:
    return signals.groupBy("tenantId", "playbackSessionId", "eventType").agg(row_total("event_count"))


def flush_windows(signals: DataFrame, every: str = "10 seconds") -> DataFrame:
    """Events per session and window of the clock, and whether a fatal error lies in it.  The
    collector's own batches, which such an error ends, are those of ``flushes``."""
    at = F.timestamp_millis("event_timestamp")
    fatal = _is("ERROR") & F.col("fatal")
    return (
        signals.groupBy("playbackSessionId", F.window(at, every).alias("w"))
        .agg(row_total("event_count"), F.bool_or(fatal).alias("flushed_at_once"))
        .select(
            "playbackSessionId",
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            "event_count",
            "flushed_at_once",
        )
    )


def flushes(signals: DataFrame, every_ms: int = 10_000, width: int = CHUNK_WIDTH) -> DataFrame:
    """Signals with the batch the collector sends them in: ``flush_start`` (epoch ms) and ``flush_part``.

    A session's timer starts with its first signal and sends what is queued every ``every_ms``.  A
    fatal error sends the queue at once, itself included; what follows until the timer's next
    tick is the next part.  Parts are counted inside one tick, so a window never spans more.
    Signals of one moment go by sequence number.
    """
    rows = with_running(signals, SESSION, SEQ, {"_began": GroupMin(F.col("event_timestamp"))}, width)
    tick = F.floor((F.col("event_timestamp") - F.col("_began")) / every_ms)
    rows = rows.withColumn("_tick", tick)
    earlier = Window.partitionBy(*SESSION, "_tick").orderBy("event_timestamp", SEQ).rowsBetween(Window.unboundedPreceding, -1)
    fatal = F.coalesce(_is("ERROR") & F.col("fatal"), F.lit(False)).cast("int")
    part = F.coalesce(F.sum(fatal).over(earlier), F.lit(0))
    start = F.col("_began") + F.col("_tick") * every_ms
    return rows.select(*signals.columns, start.alias("flush_start"), part.alias("flush_part"))


FLUSH = [*SESSION, "flush_start", "flush_part"]


def flush_batches(flushed: DataFrame) -> DataFrame:
    """Signals per batch, and whether a fatal error sent it."""
    fatal = F.coalesce(_is("ERROR") & F.col("fatal"), F.lit(False))
    return flushed.groupBy(*FLUSH).agg(row_total("event_count"), F.bool_or(fatal).alias("sent_at_once"))


def flush_summaries(flushed: DataFrame) -> DataFrame:
    """Non-fatal errors per batch and ``code|message``; a batch that is sent takes them all along."""
    errors = classify_errors(flushed, FLUSH[1:]).filter(~F.col("fatal"))
    return errors.groupBy(*FLUSH, F.concat_ws("|", "code", "message").alias("error_key")).agg(
        row_total("error_count"),
        F.min("event_timestamp").alias("firstSeenTs"),
        F.max("event_timestamp").alias("lastSeenTs"),
    )


def flush_totals(summaries: DataFrame) -> DataFrame:
    """Distinct codes and total count of each batch's summary."""
    return summaries.groupBy(*FLUSH).agg(row_total("distinctCodes"), F.sum("error_count").alias("totalCount"))


# --- traffic ----------------------------------------------------------------------------


def traffic_by_resolution(signals: DataFrame) -> DataFrame:
    """Bytes, fragments and byte share per session and resolution.

    The window for the share runs over the aggregate: one row per resolution of a session.
    """
    grouped = signals.groupBy("playbackSessionId", "resolution").agg(
        F.sum("bytes").alias("bytesDownloaded"), row_total("fragmentsLoaded")
    )
    whole = F.sum("bytesDownloaded").over(Window.partitionBy("playbackSessionId"))
    share = F.when(whole > 0, F.round(F.col("bytesDownloaded") / whole * 100, 2)).otherwise(F.lit(0.0))
    return grouped.withColumn("byteSharePercent", share)


def running_traffic(signals: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """Cumulative bytes and fragments of the event's resolution, at each event."""
    state = {"bytesDownloaded": RunningSum(F.col("bytes")), "fragmentsLoaded": RunningSum(F.lit(1))}
    rows = with_running(signals, [*SESSION, "resolution"], SEQ, state, width)
    return rows.select(*SESSION, SEQ, "resolution", *state)


# --- identity and start -----------------------------------------------------------------


def event_identity(signals: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """``session-timestamp-sequence`` and milliseconds since the session began."""
    rows = with_running(signals, SESSION, SEQ, {"_began": GroupMin(F.col("event_timestamp"))}, width)
    return rows.select(
        *SESSION,
        SEQ,
        F.concat_ws("-", *SESSION, "event_timestamp", SEQ).alias("eventId"),
        (F.col("event_timestamp") - F.col("_began")).alias("elapsedMs"),
    )


def time_to_first_frame(signals: DataFrame) -> DataFrame:
    """Per session: first PLAYBACK_START less the first event; NULL if playback never began."""
    start = F.min(F.when(_is("PLAYBACK_START"), F.col("event_timestamp")))
    return signals.groupBy(*SESSION).agg((start - F.min("event_timestamp")).alias("timeToFirstFrameMs"))


# --- buffering --------------------------------------------------------------------------


def buffer_timeline(signals: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """Signals with buffer type, paired buffer duration and cumulative rebuffer metrics.

    A BUFFER_END belongs to the latest BUFFER_START since the previous end; an end without
    one is no interval.  The type of an interval is that of its start.
    """
    seen = {
        f"_{name}": RunningMax(_seq_of(kind), inclusive=False)
        for name, kind in {
            "started": "PLAYBACK_START",
            "seeking": "SEEKING",
            "seeked": "SEEKED",
            "opened": "BUFFER_START",
            "closed": "BUFFER_END",
        }.items()
    }
    seen["_opened_at"] = LastValue(F.when(_is("BUFFER_START"), F.col("event_timestamp")), inclusive=False)
    rows = with_running(chunk(signals, SEQ, width, SESSION), SESSION, SEQ, seen)

    never = F.lit(-1)
    seeking = F.col("_seeking") > F.coalesce(F.col("_seeked"), never)
    kind = first_match([(F.col("_started").isNull(), "STARTUP"), (F.coalesce(seeking, F.lit(False)), "SEEK")], "STALL")
    is_open = F.coalesce(F.col("_opened") > F.coalesce(F.col("_closed"), never), F.lit(False))
    rows = rows.withColumns(
        {
            "_start_type": F.when(_is("BUFFER_START"), kind),
            "durationMs": F.when(_is("BUFFER_END") & is_open, F.col("event_timestamp") - F.col("_opened_at")),
        }
    )
    totals = {
        "_interval_type": LastValue(F.col("_start_type")),
        "totalRebufferMs": RunningSum(F.col("durationMs")),
        "stallCount": RunningSum((F.coalesce(F.col("_start_type"), F.lit("")) == "STALL").cast("int")),
        "startupStallCount": RunningSum((F.coalesce(F.col("_start_type"), F.lit("")) == "STARTUP").cast("int")),
    }
    rows = with_running(rows, SESSION, SEQ, totals)
    kind = F.when(_is("BUFFER_START") | F.col("durationMs").isNotNull(), F.col("_interval_type"))
    return rows.select(*signals.columns, kind.alias("bufferType"), "durationMs", *list(totals)[1:])


def buffer_starts(timeline: DataFrame) -> DataFrame:
    return timeline.filter(_is("BUFFER_START")).select(*SESSION, SEQ, "bufferType")


def buffer_intervals(timeline: DataFrame) -> DataFrame:
    closed = timeline.filter(F.col("durationMs").isNotNull())
    end = F.col("event_timestamp")
    return closed.select(
        *SESSION,
        SEQ,
        F.col("bufferType").alias("type"),
        (end - F.col("durationMs")).alias("start_ts"),
        end.alias("end_ts"),
        "durationMs",
    )


def watch_time(current_time: Column) -> Column:
    return F.greatest(F.coalesce(current_time, F.lit(0.0)), F.lit(0.0))


def rebuffer_ratio(total_ms: Column, watched_sec: Column) -> Column:
    watched_ms = watched_sec * 1000
    return F.when(watched_sec > 0, F.round(total_ms / watched_ms, 4)).otherwise(F.lit(0.0))


def playback_quality(timeline: DataFrame) -> DataFrame:
    """The metrics each event carries: totals so far, watch time and rebuffer ratio."""
    watched = watch_time(F.col("currentTimeSec"))
    return timeline.select(
        *SESSION,
        SEQ,
        "totalRebufferMs",
        "stallCount",
        "startupStallCount",
        watched.alias("watchTimeSec"),
        rebuffer_ratio(F.col("totalRebufferMs"), watched).alias("rebufferRatio"),
    )


def session_targets(timeline: DataFrame, max_ratio: float = 0.05, max_stalls: int = 2) -> DataFrame:
    """Per session: rebuffer ratio below 5 % and fewer than two stalls."""
    totals = timeline.groupBy(*SESSION).agg(
        F.max("totalRebufferMs").alias("totalRebufferMs"),
        F.max("stallCount").alias("stallCount"),
        F.max(watch_time(F.col("currentTimeSec"))).alias("watchTimeSec"),
    )
    rated = totals.withColumn("rebufferRatio", rebuffer_ratio(F.col("totalRebufferMs"), F.col("watchTimeSec")))
    return rated.withColumns(
        {"meets_ratio": F.col("rebufferRatio") < max_ratio, "meets_stalls": F.col("stallCount") < max_stalls}
    )


# --- quality switches -------------------------------------------------------------------


def quality_switches(signals: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """QUALITY_CHANGE events with the quality before, the switch time and dropped frames.

    The first QUALITY_SWITCH_START since the last change opens a switch; later ones are
    ignored.  The quality before is that of the last change, or of the first frame.
    """
    seen = {
        "_started": RunningMax(_seq_of("PLAYBACK_START"), inclusive=False),
        "_asked": RunningMax(_seq_of("QUALITY_SWITCH_START"), inclusive=False),
        "_changed": RunningMax(_seq_of("QUALITY_CHANGE"), inclusive=False),
    }
    rows = with_running(chunk(signals, SEQ, width, SESSION), SESSION, SEQ, seen)
    is_open = F.coalesce(F.col("_asked") > F.coalesce(F.col("_changed"), F.lit(-1)), F.lit(False))
    rows = rows.withColumns(
        {
            "_open": is_open,
            "_opens_at": F.when(_is("QUALITY_SWITCH_START") & ~is_open, F.col("event_timestamp")),
            "_baseline": _is("QUALITY_CHANGE") | (_is("PLAYBACK_START") & F.col("_started").isNull()),
        }
    )
    before = lambda name, when: LastValue(F.when(when, F.col(name)), inclusive=False)
    state = {
        "_opened_at": LastValue(F.col("_opens_at"), inclusive=False),
        "fromBitrateBps": before("bitrateBps", F.col("_baseline")),
        "fromResolution": before("resolution", F.col("_baseline")),
        "_dropped_before": before("droppedFrames", _is("QUALITY_CHANGE")),
    }
    rows = with_running(rows, SESSION, SEQ, state)
    took = F.when(F.col("_open"), F.col("event_timestamp") - F.col("_opened_at"))
    dropped = F.col("droppedFrames") - F.coalesce(F.col("_dropped_before"), F.lit(0))
    return rows.filter(_is("QUALITY_CHANGE")).select(
        *SESSION,
        SEQ,
        "fromBitrateBps",
        "bitrateBps",
        "fromResolution",
        "resolution",
        took.alias("switchDurationMs"),
        dropped.alias("droppedFramesDelta"),
    )


# --- errors -----------------------------------------------------------------------------


def classify_errors(signals: DataFrame, also: list[str] | None = None) -> DataFrame:
    """Normalised error fields of the ERROR signals, and the columns ``also`` as they are."""
    code = or_default("errorDetails", "unknown")
    fatal = F.coalesce(F.col("fatal"), F.lit(False))
    severity = first_match([(fatal, "fatal"), (code == "internalException", "warn")], "error")
    return signals.filter(_is("ERROR")).select(
        *SESSION,
        SEQ,
        "event_timestamp",
        code.alias("code"),
        or_default("errorType", "unknown").alias("message"),
        upper_or("errorType").alias("category"),
        fatal.alias("fatal"),
        severity.alias("severity"),
        (~fatal).alias("recoverable"),
        *(also or []),
    )


def error_summary(signals: DataFrame, every: str = "10 seconds") -> DataFrame:
    """Non-fatal errors per session, window of the clock and ``code|message``; per batch of the collector:
    ``flush_summaries``."""
    at = F.timestamp_millis("event_timestamp")
    errors = classify_errors(signals).filter(~F.col("fatal"))
    return (
        errors.groupBy("playbackSessionId", F.window(at, every).alias("w"), "code", "message")
        .agg(
            row_total("error_count"),
            F.min("event_timestamp").alias("firstSeenTs"),
            F.max("event_timestamp").alias("lastSeenTs"),
        )
        .select(
            "playbackSessionId",
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.concat_ws("|", "code", "message").alias("error_key"),
            "error_count",
            "firstSeenTs",
            "lastSeenTs",
        )
    )


def error_totals(summary: DataFrame) -> DataFrame:
    """Distinct codes and total count of each flushed summary."""
    grouped = summary.groupBy("playbackSessionId", "window_start")
    return grouped.agg(row_total("distinctCodes"), F.sum("error_count").alias("totalCount"))


# --- context ----------------------------------------------------------------------------


def network_context(signals: DataFrame) -> DataFrame:
    """Bandwidth estimate, connection type, downlink and round trip of each event."""
    estimate = F.nullif(F.round("bandwidthEstimate").cast("bigint"), F.lit(0).cast("bigint"))
    return signals.select(
        *SESSION,
        SEQ,
        estimate.alias("estimatedBandwidthBps"),
        or_default("effectiveType", "unknown").alias("connectionType"),
        F.col("downlink").alias("downlinkMbps"),
        F.col("rtt").alias("rttMs"),
    )


def trimmed_user_agent(signals: DataFrame, length: int = 180) -> DataFrame:
    return signals.select(*SESSION, SEQ, ellipsis(or_default("userAgent", "unknown"), length).alias("userAgent"))


def faults_with_signals(quarantine: DataFrame, signals: DataFrame) -> DataFrame:
    """Player signals at the moment of a quarantined report, for investigation."""
    faulty = quarantine.select(
        F.col("clientId").alias("userId"),
        F.col("timestamp_server").alias("event_timestamp"),
        "quality_level",
        "quarantine_reason",
    )
    wanted = signals.select("userId", "event_timestamp", *SESSION, SEQ, "eventType")
    return faulty.join(wanted, ["userId", "event_timestamp"])
