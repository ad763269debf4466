"""Column contracts of the four tables and of the collector event."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, WHOLE, BIG, REAL, FLAG, DAY, MOMENT = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.DateType(),
    T.TimestampType(),
)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TRAFFIC = struct(requests=WHOLE, responses=REAL, requestedData=BIG, receivedData=BIG)
ROUTES = struct(sourceTraffic=TRAFFIC, p2pTraffic=TRAFFIC)

BRONZE = struct(
    customerId=TEXT,
    contentId=TEXT,
    clientId=TEXT,
    timestampInfo=struct(server=BIG, agent=BIG),
    player=struct(bufferings=WHOLE, bufferingTime=WHOLE),
    totalDistribution=ROUTES,
    qualityDistribution=T.MapType(TEXT, ROUTES),
    eventDate=DAY,
    _rescued_data=TEXT,
)


def _table(rows: list[tuple[str, T.DataType, bool, str]]) -> T.StructType:
    """(name, type, nullable, comment) rows as a schema with column comments."""
    return T.StructType([T.StructField(name, kind, null, {"comment": note}) for name, kind, null, note in rows])


SILVER = _table(
    [
        ("customerId", TEXT, False, "Customer that owns the stream"),
        ("contentId", TEXT, False, "Video being watched"),
        ("clientId", TEXT, False, "Device or app instance"),
        ("timestamp_server", BIG, False, "Server clock, epoch milliseconds"),
        ("timestamp_agent", BIG, True, "Client clock, epoch milliseconds, if known"),
        ("buffering_count", WHOLE, False, "Buffering interruptions in the session report"),
        ("buffering_time_ms", WHOLE, False, "Time spent buffering, milliseconds"),
        ("buffering_time_sec", REAL, False, "Time spent buffering, seconds"),
        ("quality_level", TEXT, False, "Rendition this row describes"),
        ("quality_source_requests", WHOLE, True, "Origin requests at this rendition"),
        ("quality_source_data", BIG, True, "Origin bytes at this rendition"),
        ("quality_p2p_requests", WHOLE, True, "Peer requests at this rendition"),
        ("quality_p2p_data", BIG, True, "Peer bytes at this rendition"),
        ("quality_data_mb", REAL, True, "Origin and peer megabytes at this rendition"),
        ("total_source_data", BIG, False, "Origin bytes over all renditions"),
        ("total_p2p_data", BIG, False, "Peer bytes over all renditions"),
        ("total_data_mb", REAL, False, "Megabytes over all renditions"),
        ("eventDate", DAY, False, "UTC date, partition key"),
    ]
)

GOLD = _table(
    [
        ("customerId", TEXT, False, "Customer that owns the stream"),
        ("clientId", TEXT, False, "Device or app instance"),
        ("eventDate", DAY, False, "UTC date, partition key"),
        ("total_buffering_events", BIG, True, "Buffering interruptions of the day"),
        ("total_buffering_time_sec", REAL, True, "Seconds of buffering of the day"),
        ("avg_buffering_per_session", REAL, True, "Mean interruptions per row"),
        ("avg_buffering_time_sec", REAL, True, "Mean seconds of buffering per row"),
        ("total_data_consumed_mb", REAL, True, "Megabytes of the day"),
        ("total_source_data_bytes", BIG, True, "Origin bytes of the day"),
        ("total_p2p_data_bytes", BIG, True, "Peer bytes of the day"),
        ("unique_content_count", BIG, True, "Distinct videos"),
        ("total_sessions", BIG, False, "Rows aggregated"),
        ("source_traffic_percentage", REAL, True, "Origin share of bytes, 0 to 100"),
        ("buffering_ratio_percentage", REAL, True, "Buffering seconds against data volume"),
        ("qos_score", REAL, True, "Viewing quality, 0 to 100"),
        ("qos_category", TEXT, True, "Tier of the score"),
    ]
)

SILVER_KEY = ["customerId", "clientId", "timestamp_server", "quality_level", "eventDate"]
#: One playback report before its renditions are exploded.
SESSION_KEY = ["customerId", "clientId", "contentId", "timestamp_server", "timestamp_agent", "eventDate"]
GOLD_KEY = ["customerId", "clientId", "eventDate"]

REQUIRED_SILVER = [field.name for field in SILVER if not field.nullable]

PLAYBACK_EVENT = struct(
    schemaVersion=TEXT,
    eventId=TEXT,
    playbackSessionId=TEXT,
    sequenceNumber=BIG,
    event_timestamp=BIG,
    elapsedMs=BIG,
    eventType=TEXT,
    identities=struct(tenantId=TEXT, userId=TEXT),
    content=struct(manifestUrl=TEXT, durationSec=REAL),
    environment=struct(playerType=TEXT, playerVersion=TEXT, telemetryVersion=TEXT, userAgent=TEXT),
    network=struct(
        estimatedBandwidthBps=BIG,
        connectionType=TEXT,
        downlinkMbps=REAL,
        rttMs=REAL,
        trafficBreakdown=T.MapType(TEXT, struct(bytesDownloaded=BIG, fragmentsLoaded=BIG)),
        qualityDistribution=T.MapType(
            TEXT, struct(bytesDownloaded=BIG, fragmentsLoaded=BIG, byteSharePercent=REAL)
        ),
    ),
    playerState=struct(currentTimeSec=REAL, isPaused=FLAG, isMuted=FLAG, volume=REAL),
    playbackQualityMetrics=struct(
        totalRebufferMs=BIG, stallCount=BIG, startupStallCount=BIG, watchTimeSec=REAL, rebufferRatio=REAL
    ),
    payload=struct(
        startup=struct(timeToFirstFrameMs=BIG),
        buffer=struct(type=TEXT, durationMs=BIG, totalRebufferMs=BIG),
        quality=struct(
            targetBitrateBps=BIG,
            bitrateBps=BIG,
            fromBitrateBps=BIG,
            switchDurationMs=BIG,
            droppedFramesDelta=BIG,
            targetResolution=TEXT,
            resolution=TEXT,
            fromResolution=TEXT,
        ),
        error=struct(code=TEXT, message=TEXT, category=TEXT, fatal=FLAG, severity=TEXT, recoverable=FLAG),
        errors=T.ArrayType(
            struct(
                code=TEXT,
                message=TEXT,
                category=TEXT,
                severity=TEXT,
                recoverable=FLAG,
                count=BIG,
                firstSeenTs=BIG,
                lastSeenTs=BIG,
            )
        ),
        totals=struct(distinctCodes=BIG, totalCount=BIG),
    ),
)

RUN_LOG = struct(
    layer=TEXT,
    version=BIG,
    ts=MOMENT,
    operation=TEXT,
    rows_updated=BIG,
    rows_inserted=BIG,
    rows_out=BIG,
    run_id=TEXT,
    state=TEXT,
    started=MOMENT,
    finished=MOMENT,
)
