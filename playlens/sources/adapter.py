"""Telemetry shapes over the plain ``events`` table.

``events`` has no playback columns, so both input shapes are projected from it, row by row
and for every row.  Faults are planted by arithmetic on ``event_id`` so that each rule of
the data contract has something to find.  No step here needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.frames import settle

LEVELS = ["360p", "720p", "1080p"]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, order: str) -> DataFrame:
    """Deal the slim event rows out by time before they are unfolded, into as many parts as the
    session has shuffle partitions: the same for any number of files, and each part holds few
    dates when it is written by date."""
    return df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), order)


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _numbered(events: DataFrame) -> DataFrame:
    """``k`` out of the JSON properties and the event time in epoch milliseconds."""
    dated = events.withColumn("eventDate", F.to_date("ts"))
    columns = {
        "k": F.get_json_object("props", "$.k").cast("int"),
        "ms": F.unix_millis(F.col("ts").cast("timestamp")),
    }
    return settle(dated, columns, keep=["event_id", "user_id", "event_type", "value", "eventDate"])


def _traffic(received: Column) -> Column:
    """Byte count as a traffic struct; the other fields follow from it."""
    requests = F.floor(F.abs(received) / 1000).cast("int")
    requests = F.when(received < 0, -requests).otherwise(requests)
    return F.struct(
        requests.alias("requests"),
        requests.cast("double").alias("responses"),
        received.alias("requestedData"),
        received.alias("receivedData"),
    )


def _routes(source: Column, p2p: Column) -> Column:
    return F.struct(_traffic(source).alias("sourceTraffic"), _traffic(p2p).alias("p2pTraffic"))


def _level_bytes(total: str) -> Column:
    """Bytes per level: i parts of n(n+1)/2 for level i, the last level takes the rest."""
    part = f"({total} * i) div (n_levels * (n_levels + 1) div 2)"
    below = f"({total} * (n_levels - 1)) div (n_levels * (n_levels + 1) div 2)"
    # With at most three levels the rest is the total less one or two lower parts.
    lowest = f"IF(n_levels = 3, {total} div 6, 0L)"
    rest = f"{total} - IF(n_levels > 1, {below}, 0L) - {lowest}"
    return F.expr(f"transform(sequence(1, n_levels), i -> IF(i = n_levels, {rest}, {part}))")


def session_report_columns(events: DataFrame) -> DataFrame:
    """Flat columns of one playback report per event."""
    k, ms = F.col("k"), F.col("ms")
    sign = lambda n: F.when(_every(n), F.lit(-1)).otherwise(F.lit(1))
    columns = {
        "customerId": F.when(_every(127), F.lit("")).otherwise(F.concat(F.lit("C"), F.col("user_id") % 20)),
        "clientId": F.when(~_every(131), F.concat(F.lit("U"), F.col("user_id"))),
        "contentId": F.concat(F.lit("V"), F.col("event_id") % 37),
        "timestamp_server": F.when(_every(137), F.lit(0).cast("bigint")).otherwise(ms),
        "timestamp_agent": F.when(~_every(11), ms - k),
        "bufferings": F.when(_every(101), F.lit(-1)).when(~_every(139), k % 4),
        "buffering_time": F.when(_every(103), F.lit(-500)).when(_every(97), k + 3600001).otherwise(k * 25),
        "src_bytes": sign(107) * F.round(F.col("value") * 10000).cast("bigint"),
        "p2p_bytes": sign(109) * k.cast("bigint") * 1000,
        "n_levels": F.when(_every(113), F.lit(0)).otherwise(F.col("event_id") % 3 + 1).cast("int"),
        "rescued": F.when(_every(149), F.concat(F.lit('{"extra":"'), k, F.lit('"}'))),
    }
    return settle(_numbered(events), columns, keep=["event_id", "eventDate"])


def bronze_reports(events: DataFrame) -> DataFrame:
    """The bronze shape: nested structs and the rendition map."""
    flat = session_report_columns(events)
    some = F.col("n_levels") > 0
    empty = F.array().cast("array<bigint>")
    parts = {
        "src_levels": F.when(some, _level_bytes("src_bytes")).otherwise(empty),
        "p2p_levels": F.when(some, _level_bytes("p2p_bytes")).otherwise(empty),
    }
    flat = flat.withColumns(parts)
    levels = F.map_from_arrays(
        F.slice(F.array(*[F.lit(name) for name in LEVELS]), 1, F.col("n_levels")),
        F.zip_with("src_levels", "p2p_levels", _routes),
    )
    return flat.select(
        "customerId",
        "contentId",
        "clientId",
        F.struct(F.col("timestamp_server").alias("server"), F.col("timestamp_agent").alias("agent")).alias(
            "timestampInfo"
        ),
        F.struct(F.col("bufferings").alias("bufferings"), F.col("buffering_time").alias("bufferingTime")).alias(
            "player"
        ),
        _routes(F.col("src_bytes"), F.col("p2p_bytes")).alias("totalDistribution"),
        levels.alias("qualityDistribution"),
        "eventDate",
        F.col("rescued").alias("_rescued_data"),
    )


# --- collector events -------------------------------------------------------------------

RESOLUTIONS = ["640x360", "1280x720", "1920x1080"]
ERROR_CODES = ["fragLoadError", "levelLoadError", "internalException", ""]
ERROR_TYPES = ["networkError", "mediaError", None]


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (index + 1).cast("int"))


def player_signals(events: DataFrame) -> DataFrame:
    """One player signal per event: a session is one user's day.

    ``sequenceNumber`` is the event id: unique and rising with time, though not gapless.
    SEEKING and SEEKED are listener signals; the collector sends no event for them.
    """
    k, eid = F.col("k"), F.col("event_id")
    kind = (
        F.when(F.col("event_type") == "signup", F.lit("PLAYBACK_START"))
        .when(F.col("event_type") == "click", F.lit("BUFFER_START"))
        .when(F.col("event_type") == "view", F.lit("BUFFER_END"))
        .when(
            F.col("event_type") == "purchase",
            F.when(_every(2), F.lit("QUALITY_SWITCH_START")).otherwise(F.lit("QUALITY_CHANGE")),
        )
        .when(k.between(20, 39), F.lit("SEEKING"))
        .when(k.between(40, 54), F.lit("SEEKED"))
        .otherwise(F.lit("ERROR"))
    )
    return _numbered(events).select(
        F.concat_ws("-", F.lit("S"), "user_id", "eventDate").alias("playbackSessionId"),
        eid.alias("sequenceNumber"),
        F.col("ms").alias("event_timestamp"),
        kind.alias("eventType"),
        F.concat(F.lit("T"), F.col("user_id") % 5).alias("tenantId"),
        F.concat(F.lit("U"), F.col("user_id")).alias("userId"),
        _pick(RESOLUTIONS, eid % 3).alias("resolution"),
        (F.lit(500000) * (eid % 3 + 1)).alias("bitrateBps"),
        (k.cast("bigint") * 1000).alias("bytes"),
        F.expr("(ms % 86400000) div 60000").alias("droppedFrames"),
        ((k - 5) * F.lit(2.5)).alias("currentTimeSec"),
        _pick(ERROR_CODES, k % 4).alias("errorDetails"),
        _pick(ERROR_TYPES, k % 3).alias("errorType"),
        (k < 20).alias("fatal"),
        F.expr("rpad('UA', 100 + k * 2, 'x')").alias("userAgent"),
        F.when(~_every(7), F.col("value") * 1000.5).alias("bandwidthEstimate"),
        F.when(~_every(5), _pick(["4g", "3g", ""], k % 3)).alias("effectiveType"),
        F.when(~_every(3), k / F.lit(8.0)).alias("downlink"),
        F.when(~_every(4), k.cast("double")).alias("rtt"),
        "eventDate",
    )


def _field(name: str, *cases: tuple[int, str], value: str) -> str:
    """SQL for one JSON member: a replacement text every n-th event, else the value."""
    branches = " ".join(f"WHEN eid % {n} = {i} THEN '{text}'" for i, (n, text) in enumerate(cases))
    return f"CASE {branches} ELSE concat('\"{name}\":', {value}, ',') END"


def event_bodies(events: DataFrame) -> DataFrame:
    """Request bodies ``{"events":[...]}``, one per row of ``events``.

    A body carries one to three collector events; some are cut short, lack the array or
    have it empty, and members are absent, null, empty or of the wrong type now and then.
    """
    quoted = lambda sql: f"concat('\"', {sql}, '\"')"
    base = _numbered(events)
    # Member texts; cases are (every n, text), the case's position is the remainder.
    text = [
        _field("schemaVersion", (13, ""), (13, '"schemaVersion":"",'), value="'\"4.0.0\"'"),
        _field("eventId", (17, '"eventId":null,'), value=quoted("concat('E', eid)")),
        _field("playbackSessionId", (19, '"playbackSessionId":"",'), value=quoted("concat('S', user_id)")),
        _field("sequenceNumber", (11, '"sequenceNumber":"abc",'), (11, ""), value="cast(eid AS string)"),
        _field("event_timestamp", (23, '"event_timestamp":null,'), value="cast(ms AS string)"),
        _field("elapsedMs", (7, '"elapsedMs":true,'), value="cast(k AS string)"),
        _field("eventType", (29, ""), value=quoted("event_type")),
        "CASE WHEN eid % 9 = 0 THEN '' WHEN eid % 9 = 1 THEN '\"identities\":{\"tenantId\":\"\"},' ELSE"
        " concat('\"identities\":{\"tenantId\":\"T', user_id % 5, '\",\"userId\":\"U', user_id, '\"},') END",
        "CASE WHEN eid % 8 = 0 THEN '\"content\":null,' WHEN eid % 8 = 1 THEN '\"content\":{\"durationSec\":\"long\"},' ELSE"
        " concat('\"content\":{\"manifestUrl\":\"m', eid % 37, '.m3u8\",\"durationSec\":', k, '.5},') END",
        "CASE WHEN eid % 6 = 0 THEN '' WHEN eid % 6 = 1 THEN '\"environment\":{\"telemetryVersion\":\"3.9\"},' ELSE"
        " concat('\"environment\":{\"playerType\":\"native\",\"playerVersion\":\"1.', k, '\",\"userAgent\":\"UA', k, '\"},') END",
        "CASE WHEN eid % 10 = 0 THEN '' WHEN eid % 10 = 1 THEN '\"network\":{\"connectionType\":\"\",\"rttMs\":\"slow\"},' ELSE"
        " concat('\"network\":{\"estimatedBandwidthBps\":', k * 1000, ',\"connectionType\":\"4g\",\"downlinkMbps\":', k, '.25,"
        "\"rttMs\":', k, ',\"trafficBreakdown\":{\"640x360\":{\"bytesDownloaded\":', k, ',\"fragmentsLoaded\":1}},"
        "\"qualityDistribution\":{\"640x360\":{\"bytesDownloaded\":', k, ',\"fragmentsLoaded\":\"one\"},"
        "\"1280x720\":{\"bytesDownloaded\":null,\"fragmentsLoaded\":2,\"byteSharePercent\":', k, '.5}}},') END",
        "CASE WHEN eid % 12 = 0 THEN '' WHEN eid % 12 = 1 THEN '\"playerState\":{\"isPaused\":\"yes\",\"isMuted\":true},' ELSE"
        " concat('\"playerState\":{\"currentTimeSec\":', k, '.5,\"isPaused\":true,\"isMuted\":false,\"volume\":0.5},') END",
        "CASE WHEN eid % 14 = 0 THEN '' WHEN eid % 14 = 1 THEN '\"playbackQualityMetrics\":{\"stallCount\":\"many\"},' ELSE"
        " concat('\"playbackQualityMetrics\":{\"totalRebufferMs\":', k, ',\"stallCount\":', k % 3, ',\"startupStallCount\":1,"
        "\"watchTimeSec\":', k, '.5,\"rebufferRatio\":0.25},') END",
        "'\"payload\":{}'",
    ]
    member = "concat('{', " + ", ".join(text) + ", '}')"
    one = f"transform(sequence(0, cast(event_id % 3 AS int)), i -> {member.replace('eid', '(event_id + i)')})"
    body = (
        "CASE WHEN event_id % 31 = 0 THEN '{\"events\":[{\"eventId\":'"
        " WHEN event_id % 37 = 0 THEN '{}'"
        " WHEN event_id % 41 = 0 THEN '{\"events\":[]}'"
        f" ELSE concat('{{\"events\":[', concat_ws(',', {one}), ']}}') END"
    )
    return base.select(F.col("event_id").alias("body_id"), F.expr(body).alias("body"))


def raw_report_json(events: DataFrame) -> DataFrame:
    """Reports as JSON text with now and then a value of the wrong type or an unknown member."""
    flat = session_report_columns(events)
    text = F.concat(
        F.lit('{"customerId":"'),
        F.col("customerId"),
        F.lit('","bufferings":'),
        F.when(_every(7), F.lit('"many"')).otherwise(F.coalesce(F.col("bufferings").cast("string"), F.lit("null"))),
        F.lit(',"bufferingTime":'),
        F.when(_every(5), F.lit('"12s"')).otherwise(F.col("buffering_time").cast("string")),
        F.lit(',"eventDate":"'),
        F.when(_every(13), F.lit("someday")).otherwise(F.col("eventDate").cast("string")),
        F.lit('"'),
        F.when(_every(11), F.lit(',"cdn":"edge"')).otherwise(F.lit("")),
        F.lit("}"),
    )
    return flat.select("event_id", F.when(_every(43), F.lit('{"customerId":"C')).otherwise(text).alias("raw"))
