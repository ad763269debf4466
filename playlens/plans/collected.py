"""Session reports from the events that collectors post.

A posted event carries what the player worked out by itself: buffer type and duration, quality
before a switch, totals so far, classified errors.  These reports read those members and have the
columns of their counterparts in ``plans.sessions``, which work the values out from signals.
``posted_bodies`` is the way back: the request bodies a collector would post for given signals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ellipsis, or_default
from ..operators.combine import stack
from ..sources import tables
from . import sessions
from .alerts import row_total
from .sessions import FLUSH, SEQ, SESSION


def _of(events: DataFrame, kind: str, *columns: Column) -> DataFrame:
    return events.filter(F.col("eventType") == kind).select(*SESSION, SEQ, *columns)


def buffer_starts(events: DataFrame) -> DataFrame:
    return _of(events, "BUFFER_START", F.col("payload.buffer.type").alias("bufferType"))


def buffer_intervals(events: DataFrame) -> DataFrame:
    """Closed intervals; an end that had no start posts no duration."""
    took, end = F.col("payload.buffer.durationMs"), F.col("event_timestamp")
    found = events.filter(took.isNotNull())
    return _of(
        found, "BUFFER_END", F.col("payload.buffer.type").alias("type"), (end - took).alias("start_ts"),
        end.alias("end_ts"), took.alias("durationMs"),
    )


def playback_quality(events: DataFrame) -> DataFrame:
    """The metrics each event carries."""
    names = ["totalRebufferMs", "stallCount", "startupStallCount", "watchTimeSec", "rebufferRatio"]
    return events.select(*SESSION, SEQ, *[F.col(f"playbackQualityMetrics.{name}") for name in names])


def time_to_first_frame(events: DataFrame) -> DataFrame:
    """Per session: what its first PLAYBACK_START posted; NULL if playback never began."""
    shown = F.when(F.col("eventType") == "PLAYBACK_START", F.col("payload.startup.timeToFirstFrameMs"))
    return events.groupBy(*SESSION).agg(F.min(shown).alias("timeToFirstFrameMs"))


def quality_switches(events: DataFrame) -> DataFrame:
    names = ["fromBitrateBps", "bitrateBps", "fromResolution", "resolution", "switchDurationMs", "droppedFramesDelta"]
    return _of(events, "QUALITY_CHANGE", *[F.col(f"payload.quality.{name}") for name in names])


def fatal_errors(events: DataFrame) -> DataFrame:
    """Errors that stopped playback, which are posted one by one."""
    names = ["code", "message", "category", "fatal", "severity", "recoverable"]
    return _of(events, "ERROR", F.col("event_timestamp"), *[F.col(f"payload.error.{name}") for name in names])


def error_summaries(events: DataFrame) -> DataFrame:
    """Other errors, counted by ``code|message`` in the summary that leaves with a batch."""
    lines = events.filter(F.col("eventType") == "ERROR_SUMMARY").select(*SESSION, F.explode("payload.errors").alias("e"))
    return lines.select(
        *SESSION, F.concat_ws("|", "e.code", "e.message").alias("error_key"), F.col("e.count").alias("error_count"),
        "e.firstSeenTs", "e.lastSeenTs",
    )


def error_totals(events: DataFrame) -> DataFrame:
    return events.filter(F.col("eventType") == "ERROR_SUMMARY").select(
        *SESSION, F.col("payload.totals.distinctCodes").alias("distinctCodes"), F.col("payload.totals.totalCount").alias("totalCount")
    )


def network_context(events: DataFrame) -> DataFrame:
    return events.select(
        *SESSION, SEQ, F.nullif(F.col("network.estimatedBandwidthBps"), F.lit(0).cast("bigint")).alias("estimatedBandwidthBps"),
        or_default("network.connectionType", "unknown").alias("connectionType"),
        F.col("network.downlinkMbps").alias("downlinkMbps"), F.col("network.rttMs").alias("rttMs"),
    )


def user_agents(events: DataFrame) -> DataFrame:
    return events.select(*SESSION, SEQ, ellipsis(or_default("environment.userAgent", "unknown"), 180).alias("userAgent"))


def type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy(F.col("identities.tenantId").alias("tenantId"), *SESSION, "eventType").agg(row_total("event_count"))


# --- the way back ------------------------------------------------------------------------

#: Signals that listeners act on without posting an event.
SILENT = ["SEEKING", "SEEKED"]

#: Number of a staged signal, and a hash of its columns, which orders signals of one sequence number and moment.
ROW, TIE = "_row", "_tie"
_STATE = [*SESSION, SEQ, "event_timestamp", "eventType"]
_ERROR = ["errorDetails", "errorType", "fatal"]
_QUALITY = ["resolution", "bitrateBps", "droppedFrames"]
_CONTEXT = ["tenantId", "userId", "userAgent", "bandwidthEstimate", "effectiveType", "downlink", "rtt", "currentTimeSec"]


def posted_events(signals: DataFrame) -> DataFrame:
    """One JSON event per signal a collector posts, with its batch; errors that are not fatal come as the
    summary of their batch, which has no sequence number of its own.

    Signals are wide, and every pass over the order of a session sorts them.  So they are staged under
    row numbers, the passes run over the few columns they need, and the rest is joined once."""
    numbered = signals.select(
        *_STATE, *_CONTEXT[:2], *_QUALITY, *_ERROR, *_CONTEXT[2:], F.hash(*signals.columns).alias(TIE), F.monotonically_increasing_id().alias(ROW)
    )
    signals = tables.staged(numbered, "posted-signals")
    flushed = tables.staged(sessions.flushes(signals.select(*_STATE, *_ERROR, TIE, ROW)), "posted-flushes")
    timeline = sessions.buffer_timeline(flushed.drop(*_ERROR))
    began = sessions.time_to_first_frame(signals)
    switches = sessions.quality_switches(signals.select(*_STATE, *_QUALITY, TIE)).select(
        *SESSION, SEQ, F.struct("bitrateBps", "resolution", "fromBitrateBps", "fromResolution", "switchDurationMs", "droppedFramesDelta").alias("_quality")
    )
    errors = sessions.classify_errors(signals).select(
        *SESSION, SEQ, F.struct("code", "message", "category", "fatal", "severity", "recoverable").alias("_error")
    )
    rows = timeline.join(switches, [*SESSION, SEQ], "left").join(errors, [*SESSION, SEQ], "left").join(began, SESSION, "left")
    kind = F.col("eventType")
    lone = F.coalesce((kind == "ERROR") & ~F.col("_error.fatal"), F.lit(False)) | kind.isin(SILENT)
    rows = rows.filter(~lone).join(signals.select(ROW, *_CONTEXT), ROW)
    payload = F.struct(
        F.when(kind == "PLAYBACK_START", F.struct("timeToFirstFrameMs")).alias("startup"),
        F.when(
            kind.isin("BUFFER_START", "BUFFER_END"), F.struct(F.col("bufferType").alias("type"), "durationMs", "totalRebufferMs")
        ).alias("buffer"),
        F.when(kind == "QUALITY_CHANGE", F.col("_quality")).alias("quality"),
        F.when(kind == "ERROR", F.col("_error")).alias("error"),
    )
    watched = sessions.watch_time(F.col("currentTimeSec"))
    metrics = F.struct(
        "totalRebufferMs", "stallCount", "startupStallCount", watched.alias("watchTimeSec"),
        sessions.rebuffer_ratio(F.col("totalRebufferMs"), watched).alias("rebufferRatio"),
    )
    event = F.struct(
        *SESSION, SEQ, "event_timestamp", "eventType", F.struct("tenantId", "userId").alias("identities"),
        F.struct("userAgent").alias("environment"),
        F.struct(
            F.round("bandwidthEstimate").cast("bigint").alias("estimatedBandwidthBps"), F.col("effectiveType").alias("connectionType"),
            F.col("downlink").alias("downlinkMbps"), F.col("rtt").alias("rttMs"),
        ).alias("network"),
        F.struct(F.col("currentTimeSec").alias("currentTimeSec")).alias("playerState"), metrics.alias("playbackQualityMetrics"),
        payload.alias("payload"),
    )
    single = rows.select(*FLUSH, F.lit(0).alias("_place"), F.col(SEQ).alias("_order"), F.to_json(event).alias("event"))
    return stack(single, _summaries(flushed))


def _summaries(flushed: DataFrame) -> DataFrame:
    line = F.struct(
        F.split("error_key", r"\|")[0].alias("code"), F.split("error_key", r"\|")[1].alias("message"),
        F.col("error_count").alias("count"), "firstSeenTs", "lastSeenTs",
    )
    per_batch = sessions.flush_summaries(flushed).groupBy(*FLUSH).agg(
        F.sort_array(F.collect_list(line)).alias("errors"), row_total("distinctCodes"), F.sum("error_count").alias("totalCount")
    )  # one line per different error
    event = F.struct(
        *SESSION, F.lit("ERROR_SUMMARY").alias("eventType"),
        F.struct("errors", F.struct("distinctCodes", "totalCount").alias("totals")).alias("payload"),
    )
    return per_batch.select(*FLUSH, F.lit(1).alias("_place"), F.lit(0).cast("bigint").alias("_order"), F.to_json(event).alias("event"))


def posted_bodies(signals: DataFrame) -> DataFrame:
    """``body_id`` and ``body``: one request per batch of a session, its summary last."""
    events = posted_events(signals)
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("_place", "_order", "event"))), lambda e: e["event"])
    # a batch holds what one session queues in ten seconds
    batches = events.groupBy(*FLUSH).agg(in_order.alias("_events"))
    body = F.concat(F.lit('{"events":['), F.array_join("_events", ","), F.lit("]}"))
    return batches.select(F.concat_ws("/", *FLUSH).alias("body_id"), body.alias("body"))
