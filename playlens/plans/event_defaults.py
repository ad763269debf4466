"""Defaults of the collector event: missing or unusable members get their fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import finite_or, or_default

BIG, REAL = "bigint", "double"


def _number(path: str, default, kind: str) -> Column:
    return finite_or(path, default).cast(kind)


# Fallbacks of each member.


def envelope(now_ms: int) -> dict[str, Column]:
    return {
        "schemaVersion": or_default("schemaVersion", "unknown"),
        "eventId": or_default("eventId", "unknown-event-id"),
        "playbackSessionId": or_default("playbackSessionId", "unknown-session"),
        "sequenceNumber": _number("sequenceNumber", 0, BIG),
        "event_timestamp": _number("event_timestamp", now_ms, BIG),
        "elapsedMs": _number("elapsedMs", 0, BIG),
        "eventType": or_default("eventType", "UNKNOWN_EVENT"),
    }


def identities() -> dict[str, Column]:
    return {
        "tenantId": or_default("identities.tenantId", "unknown-tenant"),
        "userId": or_default("identities.userId", "anonymous_user"),
    }


def content() -> dict[str, Column]:
    return {
        "manifestUrl": or_default("content.manifestUrl", "unknown"),
        "durationSec": _number("content.durationSec", 0, REAL),
    }


def environment() -> dict[str, Column]:
    """The telemetry version falls back to the event's schema version first."""
    version = F.nullif(F.col("environment.telemetryVersion"), F.lit(""))
    return {
        "playerType": or_default("environment.playerType", "hls.js"),
        "playerVersion": or_default("environment.playerVersion", "unknown"),
        "telemetryVersion": or_default(F.coalesce(version, F.col("schemaVersion")), "unknown"),
        "userAgent": or_default("environment.userAgent", "unknown"),
    }


def network() -> dict[str, Column]:
    traffic = "map<string,struct<bytesDownloaded:bigint,fragmentsLoaded:bigint>>"
    return {
        "estimatedBandwidthBps": finite_or("network.estimatedBandwidthBps", None),
        "connectionType": or_default("network.connectionType", "unknown"),
        "downlinkMbps": F.col("network.downlinkMbps"),
        "rttMs": F.col("network.rttMs"),
        "trafficBreakdown": F.coalesce(F.col("network.trafficBreakdown"), F.create_map().cast(traffic)),
        "qualityDistribution": quality_distribution("network.qualityDistribution"),
    }


def quality_distribution(path: str) -> Column:
    """Entries with unusable figures set to 0; no map at all becomes an empty one."""
    kind = "map<string,struct<bytesDownloaded:bigint,fragmentsLoaded:bigint,byteSharePercent:double>>"
    clean = F.transform_values(
        F.col(path),
        lambda _, entry: F.struct(
            _entry(entry, "bytesDownloaded", BIG),
            _entry(entry, "fragmentsLoaded", BIG),
            _entry(entry, "byteSharePercent", REAL),
        ),
    )
    return F.coalesce(clean, F.create_map().cast(kind))


def _entry(entry: Column, name: str, kind: str) -> Column:
    return finite_or(entry[name], 0).cast(kind).alias(name)


def player_state() -> dict[str, Column]:
    return {
        "currentTimeSec": _number("playerState.currentTimeSec", 0, REAL),
        "isPaused": F.coalesce(F.col("playerState.isPaused"), F.lit(False)),
        "isMuted": F.coalesce(F.col("playerState.isMuted"), F.lit(False)),
        "volume": _number("playerState.volume", 1, REAL),
    }


def playback_metrics() -> dict[str, Column]:
    name = "playbackQualityMetrics."
    return {
        "totalRebufferMs": _number(name + "totalRebufferMs", 0, BIG),
        "stallCount": _number(name + "stallCount", 0, BIG),
        "startupStallCount": _number(name + "startupStallCount", 0, BIG),
        "watchTimeSec": _number(name + "watchTimeSec", 0, REAL),
        "rebufferRatio": _number(name + "rebufferRatio", 0, REAL),
    }


def part(events: DataFrame, columns: dict[str, Column], keys: list[str]) -> DataFrame:
    """Keys and one group of members, flat."""
    taken = [F.col(k) for k in keys if k not in columns]
    return events.select(*taken, *[column.alias(name) for name, column in columns.items()])


def with_defaults(events: DataFrame, now_ms: int) -> DataFrame:
    """The whole event in its nested shape with every fallback applied."""

    def nested(columns: dict[str, Column]) -> Column:
        return F.struct(*[column.alias(name) for name, column in columns.items()])

    groups = {
        "identities": identities(),
        "content": content(),
        "environment": environment(),
        "network": network(),
        "playerState": player_state(),
        "playbackQualityMetrics": playback_metrics(),
    }
    top = envelope(now_ms)
    rest = [c for c in events.columns if c not in top and c not in groups]
    return events.select(
        *rest,
        *[column.alias(name) for name, column in top.items()],
        *[nested(columns).alias(name) for name, columns in groups.items()],
    )
