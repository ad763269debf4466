"""The registered queries once more, as SQL for an independent engine (DuckDB).

Every statement starts from the raw ``events`` view and rebuilds the layers as CTEs, so
nothing the Spark side wrote is read here.
"""

from __future__ import annotations

from .. import schemas
from .lake import AS_OF, AS_OF_MS, AS_OF_TS

DAY = f"DATE '{AS_OF}'"
NOW = f"TIMESTAMP '{AS_OF_TS}'"

BASE = """
src AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) // 1000 AS ms, CAST(ts AS DATE) AS eventDate, event_id AS eid
  FROM events
),
report AS (
  SELECT eid,
    CASE WHEN eid % 127 = 0 THEN '' ELSE 'C' || (user_id % 20) END AS customerId,
    CASE WHEN eid % 131 <> 0 THEN 'U' || user_id END AS clientId,
    'V' || (eid % 37) AS contentId,
    CASE WHEN eid % 137 = 0 THEN 0 ELSE ms END AS timestamp_server,
    CASE WHEN eid % 11 <> 0 THEN ms - k END AS timestamp_agent,
    CASE WHEN eid % 101 = 0 THEN -1 WHEN eid % 139 <> 0 THEN k % 4 END AS buffering_count,
    CASE WHEN eid % 103 = 0 THEN -500 WHEN eid % 97 = 0 THEN 3600001 + k ELSE k * 25 END AS buffering_time_ms,
    CASE WHEN eid % 107 = 0 THEN -1 ELSE 1 END * CAST(round(value * 10000) AS BIGINT) AS total_source_data,
    CASE WHEN eid % 109 = 0 THEN -1 ELSE 1 END * CAST(k AS BIGINT) * 1000 AS total_p2p_data,
    CASE WHEN eid % 113 = 0 THEN 0 ELSE 1 + eid % 3 END AS n,
    CASE WHEN eid % 149 = 0 THEN '{"extra":"' || k || '"}' END AS rescued,
    eventDate
  FROM src
),
parts AS (
  SELECT r.*, l.i, l.name AS quality_level, n * (n + 1) // 2 AS tri
  FROM report r JOIN (VALUES (1, '360p'), (2, '720p'), (3, '1080p')) l(i, name) ON l.i <= r.n
),
shares AS (
  SELECT *,
    CASE WHEN i < n THEN (total_source_data * i) // tri
         ELSE total_source_data - CASE n WHEN 3 THEN total_source_data // 6 + (total_source_data * 2) // 6
                                         WHEN 2 THEN total_source_data // 3 ELSE 0 END END AS quality_source_data,
    CASE WHEN i < n THEN (total_p2p_data * i) // tri
         ELSE total_p2p_data - CASE n WHEN 3 THEN total_p2p_data // 6 + (total_p2p_data * 2) // 6
                                      WHEN 2 THEN total_p2p_data // 3 ELSE 0 END END AS quality_p2p_data
  FROM parts
),
exploded AS (
  SELECT *,
    quality_source_data // 1000 AS quality_source_requests, quality_p2p_data // 1000 AS quality_p2p_requests,
    total_source_data // 1000 AS total_source_requests, total_p2p_data // 1000 AS total_p2p_requests,
    buffering_time_ms / 1000e0 AS buffering_time_sec,
    CAST(quality_source_data + quality_p2p_data AS DOUBLE) / 1048576e0 AS quality_data_mb,
    CAST(total_source_data + total_p2p_data AS DOUBLE) / 1048576e0 AS total_data_mb
  FROM shares
),
silver AS (
  SELECT * FROM exploded
  WHERE buffering_count >= 0 AND buffering_time_ms >= 0 AND total_source_data >= 0 AND total_p2p_data >= 0
    AND customerId IS NOT NULL AND clientId IS NOT NULL
),
quarantine AS (
  SELECT *, CASE WHEN buffering_count < 0 THEN 'negative_buffering_count'
                 WHEN buffering_time_ms < 0 THEN 'negative_buffering_time'
                 WHEN total_source_data < 0 THEN 'negative_source_data'
                 WHEN total_p2p_data < 0 THEN 'negative_p2p_data'
                 ELSE 'excessive_buffering' END AS quarantine_reason
  FROM exploded
  WHERE buffering_count < 0 OR buffering_time_ms < 0 OR total_source_data < 0 OR total_p2p_data < 0
     OR buffering_time_sec > 3600
)"""


def gold_over(rows: str, name: str) -> str:
    """CTEs for the viewer scores over a relation shaped like silver."""
    return f"""
{name}_sums AS (
  SELECT customerId, clientId, eventDate,
    CAST(sum(buffering_count) AS BIGINT) AS total_buffering_events,
    CAST(sum(buffering_time_ms) AS DOUBLE) / 1000e0 AS total_buffering_time_sec,
    avg(buffering_count) AS avg_buffering_per_session,
    CAST(sum(buffering_time_ms) AS DOUBLE) / 1000e0 / count(buffering_time_ms) AS avg_buffering_time_sec,
    CAST(sum(total_source_data + total_p2p_data) AS DOUBLE) / 1048576e0 AS total_data_consumed_mb,
    CAST(sum(total_source_data) AS BIGINT) AS total_source_data_bytes,
    CAST(sum(total_p2p_data) AS BIGINT) AS total_p2p_data_bytes,
    count(DISTINCT contentId) AS unique_content_count,
    count(*) AS total_sessions
  FROM {rows} GROUP BY ALL
),
{name}_scores AS (
  SELECT *,
    CASE WHEN total_source_data_bytes + total_p2p_data_bytes > 0
         THEN CAST(total_source_data_bytes AS DOUBLE) / CAST(total_source_data_bytes + total_p2p_data_bytes AS DOUBLE) * 100e0
         ELSE 0e0 END AS source_traffic_percentage,
    CASE WHEN total_data_consumed_mb > 0
         THEN total_buffering_time_sec / (total_data_consumed_mb * 2e0) * 100e0 ELSE 0e0 END AS buffering_ratio_percentage,
    greatest(0e0, 100e0 - total_buffering_time_sec / 10e0 - total_buffering_events * 2) AS qos_score
  FROM {name}_sums
),
{name} AS (
  SELECT *, CASE WHEN qos_score >= 80 THEN 'Excellent' WHEN qos_score >= 60 THEN 'Good'
                 WHEN qos_score >= 40 THEN 'Fair' ELSE 'Poor' END AS qos_category
  FROM {name}_scores
)"""


SIGNALS = """
sig AS (
  SELECT 'S-' || user_id || '-' || eventDate AS playbackSessionId, eid AS sequenceNumber, ms AS event_timestamp,
    CASE event_type WHEN 'signup' THEN 'PLAYBACK_START' WHEN 'click' THEN 'BUFFER_START' WHEN 'view' THEN 'BUFFER_END'
      WHEN 'purchase' THEN CASE WHEN eid % 2 = 0 THEN 'QUALITY_SWITCH_START' ELSE 'QUALITY_CHANGE' END
      ELSE CASE WHEN k BETWEEN 20 AND 39 THEN 'SEEKING' WHEN k BETWEEN 40 AND 54 THEN 'SEEKED' ELSE 'ERROR' END
    END AS eventType,
    'T' || (user_id % 5) AS tenantId, 'U' || user_id AS userId,
    CASE eid % 3 WHEN 0 THEN '640x360' WHEN 1 THEN '1280x720' ELSE '1920x1080' END AS resolution,
    500000 * (1 + eid % 3) AS bitrateBps, CAST(k AS BIGINT) * 1000 AS bytes,
    (ms % 86400000) // 60000 AS droppedFrames, (k - 5) * 2.5e0 AS currentTimeSec,
    CASE k % 4 WHEN 0 THEN 'fragLoadError' WHEN 1 THEN 'levelLoadError' WHEN 2 THEN 'internalException' ELSE '' END AS errorDetails,
    CASE k % 3 WHEN 0 THEN 'networkError' WHEN 1 THEN 'mediaError' END AS errorType,
    k < 20 AS fatal, rpad('UA', CAST(100 + k * 2 AS INTEGER), 'x') AS userAgent,
    CASE WHEN eid % 7 <> 0 THEN value * 1000.5e0 END AS bandwidthEstimate,
    CASE WHEN eid % 5 <> 0 THEN CASE k % 3 WHEN 0 THEN '4g' WHEN 1 THEN '3g' ELSE '' END END AS effectiveType,
    CASE WHEN eid % 3 <> 0 THEN k / 8e0 END AS downlink,
    CASE WHEN eid % 4 <> 0 THEN CAST(k AS DOUBLE) END AS rtt,
    eventDate
  FROM src
)"""

# Buffer intervals by joins on order statistics, not by running state.
TIMELINE = """
marks AS (
  SELECT *,
    max(CASE WHEN eventType = 'PLAYBACK_START' THEN sequenceNumber END) OVER w AS started,
    coalesce(max(CASE WHEN eventType = 'SEEKING' THEN sequenceNumber END) OVER w, -1) AS seeking,
    coalesce(max(CASE WHEN eventType = 'SEEKED' THEN sequenceNumber END) OVER w, -1) AS seeked
  FROM sig WINDOW w AS (PARTITION BY playbackSessionId ORDER BY sequenceNumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
buffers AS (
  SELECT *, lag(eventType) OVER b AS prev_type, lag(event_timestamp) OVER b AS prev_ts,
    CASE WHEN eventType = 'BUFFER_START' THEN
      CASE WHEN started IS NULL THEN 'STARTUP' WHEN seeking > seeked THEN 'SEEK' ELSE 'STALL' END END AS start_type
  FROM marks WHERE eventType IN ('BUFFER_START', 'BUFFER_END')
  WINDOW b AS (PARTITION BY playbackSessionId ORDER BY sequenceNumber)
),
paired AS (
  SELECT *, CASE WHEN eventType = 'BUFFER_END' AND prev_type = 'BUFFER_START' THEN event_timestamp - prev_ts END AS durationMs,
    lag(start_type) OVER (PARTITION BY playbackSessionId ORDER BY sequenceNumber) AS prev_start_type
  FROM buffers
),
timeline AS (
  SELECT s.*, p.start_type, p.durationMs, p.prev_ts, p.prev_start_type,
    CAST(coalesce(sum(p.durationMs) OVER c, 0) AS BIGINT) AS totalRebufferMs,
    CAST(sum(CASE WHEN p.start_type = 'STALL' THEN 1 ELSE 0 END) OVER c AS BIGINT) AS stallCount,
    CAST(sum(CASE WHEN p.start_type = 'STARTUP' THEN 1 ELSE 0 END) OVER c AS BIGINT) AS startupStallCount,
    greatest(s.currentTimeSec, 0e0) AS watchTimeSec
  FROM sig s LEFT JOIN paired p ON p.playbackSessionId = s.playbackSessionId AND p.sequenceNumber = s.sequenceNumber
  WINDOW c AS (PARTITION BY s.playbackSessionId ORDER BY s.sequenceNumber)
)"""

SWITCHES = """
asks AS (
  SELECT *, lag(eventType) OVER q AS prev_type, lag(droppedFrames) OVER d AS prev_dropped,
    count(CASE WHEN eventType = 'QUALITY_CHANGE' THEN 1 END) OVER q
      - CASE WHEN eventType = 'QUALITY_CHANGE' THEN 1 ELSE 0 END AS cycle
  FROM sig WHERE eventType IN ('QUALITY_SWITCH_START', 'QUALITY_CHANGE')
  WINDOW q AS (PARTITION BY playbackSessionId ORDER BY sequenceNumber),
         d AS (PARTITION BY playbackSessionId, eventType ORDER BY sequenceNumber)
),
opened AS (
  SELECT playbackSessionId, cycle, min(event_timestamp) AS opened_at FROM asks
  WHERE eventType = 'QUALITY_SWITCH_START' GROUP BY ALL
),
first_frames AS (
  SELECT playbackSessionId, min(sequenceNumber) AS first_seq FROM sig WHERE eventType = 'PLAYBACK_START' GROUP BY ALL
),
baselines AS (
  SELECT s.playbackSessionId, s.sequenceNumber, s.eventType,
    lag(s.bitrateBps) OVER v AS fromBitrateBps, lag(s.resolution) OVER v AS fromResolution
  FROM sig s LEFT JOIN first_frames f ON f.playbackSessionId = s.playbackSessionId
  WHERE s.eventType = 'QUALITY_CHANGE' OR s.sequenceNumber = f.first_seq
  WINDOW v AS (PARTITION BY s.playbackSessionId ORDER BY s.sequenceNumber)
),
switches AS (
  SELECT a.playbackSessionId, a.sequenceNumber, b.fromBitrateBps, a.bitrateBps, b.fromResolution, a.resolution,
    a.event_timestamp - o.opened_at AS switchDurationMs,
    a.droppedFrames - coalesce(a.prev_dropped, 0) AS droppedFramesDelta
  FROM asks a JOIN baselines b USING (playbackSessionId, sequenceNumber)
  LEFT JOIN opened o ON o.playbackSessionId = a.playbackSessionId AND o.cycle = a.cycle
  WHERE a.eventType = 'QUALITY_CHANGE'
)"""

ERRORS = """
errs AS (
  SELECT playbackSessionId, sequenceNumber, event_timestamp,
    CASE WHEN errorDetails = '' THEN 'unknown' ELSE errorDetails END AS code,
    coalesce(errorType, 'unknown') AS message, upper(coalesce(errorType, 'unknown')) AS category, fatal,
    CASE WHEN fatal THEN 'fatal' WHEN errorDetails = 'internalException' THEN 'warn' ELSE 'error' END AS severity,
    NOT fatal AS recoverable
  FROM sig WHERE eventType = 'ERROR'
),
err_summary AS (
  SELECT playbackSessionId, time_bucket(INTERVAL 1 DAY, make_timestamp(event_timestamp * 1000)) AS window_start,
    code || '|' || message AS error_key, count(*) AS error_count,
    min(event_timestamp) AS firstSeenTs, max(event_timestamp) AS lastSeenTs
  FROM errs WHERE NOT fatal GROUP BY ALL
)"""

BODIES = """
body AS (
  SELECT *, event_id AS body_id, event_id % 31 = 0 AS is_rejected,
    CASE WHEN event_id % 31 = 0 OR event_id % 37 = 0 OR event_id % 41 = 0 THEN 0 ELSE 1 + event_id % 3 END AS batch_size
  FROM src
),
ev AS (
  SELECT b.body_id, p.position, b.batch_size, b.user_id, b.event_type, b.k, b.ms, b.body_id + p.position AS e,
    CASE WHEN (b.body_id + p.position) % 13 > 1 THEN '4.0.0' END AS version
  FROM body b JOIN (VALUES (0), (1), (2)) p(position) ON p.position < b.batch_size
)"""

# The fix functions and the merge, in SQL.
REPAIR = f"""
fixed AS (
  SELECT customerId, contentId, clientId, timestamp_server, timestamp_agent,
    coalesce(abs(buffering_count), 0) AS buffering_count, abs(buffering_time_ms) AS buffering_time_ms,
    least(abs(buffering_time_ms) / 1000e0, 3600e0) AS buffering_time_sec, quality_level,
    quality_source_requests, quality_source_data, quality_p2p_requests, quality_p2p_data, quality_data_mb,
    abs(total_source_data) AS total_source_data, abs(total_p2p_data) AS total_p2p_data,
    CAST(abs(total_source_data) + abs(total_p2p_data) AS DOUBLE) / 1048576e0 AS total_data_mb,
    eventDate, eid
  FROM quarantine
),
incoming AS (
  SELECT * EXCLUDE (eid, place) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY customerId, clientId, timestamp_server, quality_level, eventDate
      ORDER BY timestamp_agent DESC NULLS LAST, contentId DESC, buffering_count DESC, buffering_time_ms DESC,
        buffering_time_sec DESC, quality_source_requests DESC, quality_source_data DESC, quality_p2p_requests DESC,
        quality_p2p_data DESC, quality_data_mb DESC, total_source_data DESC, total_p2p_data DESC) AS place
    FROM fixed WHERE eventDate >= {DAY} - 7 AND clientId IS NOT NULL AND customerId IS NOT NULL)
  WHERE place = 1
),
matched AS (
  SELECT s.*, i.contentId AS i_content, i.buffering_count AS i_count, i.buffering_time_ms AS i_ms,
    i.buffering_time_sec AS i_sec, i.timestamp_agent AS i_agent, i.quality_source_requests AS i_qsr,
    i.quality_source_data AS i_qs, i.quality_p2p_requests AS i_qpr, i.quality_p2p_data AS i_qp,
    i.quality_data_mb AS i_qmb, i.total_source_data AS i_ts, i.total_p2p_data AS i_tp, i.total_data_mb AS i_tmb,
    i.eventDate IS NOT NULL AS hit
  FROM silver s LEFT JOIN incoming i
    ON s.customerId = i.customerId AND s.clientId = i.clientId AND s.timestamp_server = i.timestamp_server
   AND s.quality_level = i.quality_level AND s.eventDate = i.eventDate
),
merged AS (
  SELECT customerId, CASE WHEN hit THEN i_content ELSE contentId END AS contentId, clientId, timestamp_server,
    CASE WHEN hit THEN i_agent ELSE timestamp_agent END AS timestamp_agent,
    CASE WHEN hit THEN i_count ELSE buffering_count END AS buffering_count,
    CASE WHEN hit THEN i_ms ELSE buffering_time_ms END AS buffering_time_ms,
    CASE WHEN hit THEN i_sec ELSE buffering_time_sec END AS buffering_time_sec, quality_level,
    CASE WHEN hit THEN i_qsr ELSE quality_source_requests END AS quality_source_requests,
    CASE WHEN hit THEN i_qs ELSE quality_source_data END AS quality_source_data,
    CASE WHEN hit THEN i_qpr ELSE quality_p2p_requests END AS quality_p2p_requests,
    CASE WHEN hit THEN i_qp ELSE quality_p2p_data END AS quality_p2p_data,
    CASE WHEN hit THEN i_qmb ELSE quality_data_mb END AS quality_data_mb,
    CASE WHEN hit THEN i_ts ELSE total_source_data END AS total_source_data,
    CASE WHEN hit THEN i_tp ELSE total_p2p_data END AS total_p2p_data,
    CASE WHEN hit THEN i_tmb ELSE total_data_mb END AS total_data_mb, eventDate
  FROM matched
  UNION ALL
  SELECT i.* FROM incoming i WHERE NOT EXISTS (
    SELECT 1 FROM silver s WHERE s.customerId = i.customerId AND s.clientId = i.clientId
      AND s.timestamp_server = i.timestamp_server AND s.quality_level = i.quality_level AND s.eventDate = i.eventDate)
)"""

COPIES = """
copies AS (
  SELECT s.* FROM silver s JOIN (VALUES (1), (2)) c(n)
    ON c.n = 1 OR (s.timestamp_server // 1000) % 50 = 0
),
groups AS (
  SELECT customerId, clientId, timestamp_server, quality_level, eventDate, count(*) AS duplicate_count
  FROM copies GROUP BY ALL HAVING count(*) > 1
)"""

GOLD = gold_over("silver", "gold")
COLUMNS = {
    "silver": "customerId, contentId, clientId, timestamp_server, timestamp_agent, buffering_count, buffering_time_ms,"
    " buffering_time_sec, quality_level, quality_source_requests, quality_source_data, quality_p2p_requests,"
    " quality_p2p_data, quality_data_mb, total_source_data, total_p2p_data, total_data_mb, eventDate",
    "key": "customerId, clientId, timestamp_server, quality_level, eventDate",
    "server": "customerId, clientId, timestamp_server, quality_level",
    "viewer": "customerId, clientId, eventDate",
    "signal": "playbackSessionId, sequenceNumber",
}
SILVER, KEY, SERVER, VIEWER, SIGNAL = COLUMNS.values()
ORACLES: dict[str, str] = {}


def half_up(text: str) -> str:
    """Two-argument ``round`` by way of text and DECIMAL.

    Spark rounds the shortest decimal text of a DOUBLE half up, DuckDB its binary value; a
    value such as 9.325 would differ.
    """
    done, start = "", text.find("round(")
    while start >= 0:
        depth, comma, end = 0, None, start + 6
        while depth or text[end] != ")":
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            if text[end] == "," and depth == 0:
                comma = end
            end += 1
        inner = text[start + 6 : comma or end]
        if comma is None:
            done += text[:start] + "round(" + half_up(inner) + ")"
        else:
            digits = text[comma + 1 : end]
            done += text[:start] + f"CAST(round(CAST(CAST({half_up(inner)} AS VARCHAR) AS DECIMAL(38, 17)),{digits}) AS DOUBLE)"
        text = text[end + 1 :]
        start = text.find("round(")
    return done + text


def sql(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = "WITH " + ",".join([BASE, *ctes]) + "\n" + half_up(body)


def since(days: int, day: str = DAY) -> str:
    return f"eventDate >= {day} - {days}"


def pct(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) * 100e0 / nullif(CAST({whole} AS DOUBLE), 0))"


def xsum(value: str) -> str:
    return f"(CAST(sum(CAST(floor(({value}) * 1e6 + 0.5e0) AS HUGEINT)) AS DOUBLE) / 1e6)"


def xavg(value: str) -> str:
    return f"({xsum(value)} / count({value}))"


def tier(value: str, alert, warning=None, sign: str = ">") -> str:
    middle = f" WHEN {value} {sign} {warning} THEN 'WARNING'" if warning is not None else ""
    return f"CASE WHEN {value} {sign} {alert} THEN 'ALERT'{middle} ELSE 'OK' END"


def at(ms: str) -> str:
    return f"make_timestamp(({ms}) * 1000)"


LAYERS = {
    "bronze_telemetry_raw": "report",
    "silver_telemetry_enriched": "silver",
    "silver_telemetry_quarantine": "quarantine",
    "gold_viewer_qos_metrics": "gold",
}


def per_layer(select: str, label: str = "layer", layers: dict[str, str] = LAYERS, tail: str = "") -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS {label}, {select} FROM {t} {tail}" for n, t in layers.items())


# --- sources ----------------------------------------------------------------------------

_RAW = """
raw AS (
  SELECT *, eid % 43 = 0 AS broken, eid % 7 = 0 AS bad_count, eid % 5 = 0 AS bad_time, eid % 13 = 0 AS bad_date,
    eid % 11 = 0 AS has_cdn FROM report
)"""
sql(
    "s02_cast_report",
    """SELECT 'customerId' AS column_name, 'string' AS hinted_type, count(*) FILTER (NOT broken) AS present, 0 AS not_castable FROM raw
    UNION ALL SELECT 'bufferings', 'int', count(*) FILTER (NOT broken AND (bad_count OR buffering_count IS NOT NULL)),
      count(*) FILTER (NOT broken AND bad_count) FROM raw
    UNION ALL SELECT 'bufferingTime', 'int', count(*) FILTER (NOT broken), count(*) FILTER (NOT broken AND bad_time) FROM raw
    UNION ALL SELECT 'eventDate', 'date', count(*) FILTER (NOT broken), count(*) FILTER (NOT broken AND bad_date) FROM raw""",
    _RAW,
)
sql(
    "s04_rescued_data",
    """SELECT eid AS event_id, CASE WHEN NOT broken THEN customerId END AS customerId,
      CASE WHEN NOT broken AND NOT bad_count THEN buffering_count END AS bufferings,
      CASE WHEN NOT broken AND NOT bad_time THEN buffering_time_ms END AS bufferingTime,
      CASE WHEN NOT broken AND NOT bad_date THEN eventDate END AS eventDate,
      CASE WHEN broken THEN '{"customerId":"C' WHEN bad_count OR bad_time OR bad_date OR has_cdn THEN
        '{' || concat_ws(',', CASE WHEN bad_count THEN '"bufferings":"many"' END,
          CASE WHEN bad_time THEN '"bufferingTime":"12s"' END, CASE WHEN bad_date THEN '"eventDate":"someday"' END,
          CASE WHEN has_cdn THEN '"cdn":"edge"' END) || '}' END AS _rescued_data
    FROM raw""",
    _RAW,
)
sql(
    "s06_table_read",
    "SELECT eventDate, count(*) AS row_count, CAST(sum(total_source_data) AS BIGINT) AS bytes FROM report GROUP BY eventDate",
)
sql("s12_event_batches", "SELECT body_id, is_rejected, batch_size FROM body", BODIES)
sql("s12_rejects", """SELECT body_id, '{"events":[{"eventId":' AS body FROM body WHERE is_rejected""", BODIES)

# --- projections ------------------------------------------------------------------------

sql(
    "p01_flatten",
    """SELECT customerId, contentId, clientId, timestamp_server, timestamp_agent, buffering_count, buffering_time_ms,
      total_source_data // 1000 AS total_source_requests, total_source_data, total_p2p_data // 1000 AS total_p2p_requests,
      total_p2p_data, eventDate FROM report""",
)
sql(
    "p02_flatten_stamped",
    f"SELECT customerId, clientId, timestamp_server, buffering_count, eventDate, {NOW} AS quarantine_timestamp FROM report",
)
sql("p03_explode_levels", f"SELECT {SERVER} FROM exploded")
sql(
    "p03_explode_levels_keep_empty",
    f"SELECT {SERVER} FROM exploded UNION ALL SELECT customerId, clientId, timestamp_server, NULL FROM report WHERE n = 0",
)
sql(
    "p04_level_metrics",
    f"SELECT {SERVER}, quality_source_requests, quality_source_data, quality_p2p_requests, quality_p2p_data FROM exploded",
)
sql("p05_buffering_seconds", "SELECT timestamp_server, buffering_time_ms / 1000e0 AS buffering_time_sec FROM report")
sql("p06_megabytes", "SELECT timestamp_server, quality_level, quality_data_mb, total_data_mb FROM exploded")
sql(
    "p07_rebuild_records",
    f"SELECT {KEY}, contentId, timestamp_agent, buffering_count, buffering_time_ms FROM quarantine",
)
sql("p08_derived_columns", f"SELECT {SILVER} FROM exploded")
sql(
    "p09_layer_labels",
    " UNION ALL ".join(
        f"(SELECT '{n}' AS layer, eventDate, count(*) AS row_count FROM {t} GROUP BY eventDate)" for n, t in LAYERS.items()
    ),
    GOLD,
)

# --- filters ----------------------------------------------------------------------------


def rules(relation: str, *lines: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, '{p}' AS policy, count(*) FILTER ({c}) AS passed,"
        f" count(*) - count(*) FILTER ({c}) AS failed FROM {relation}"
        for n, p, c in lines
    )


_SILVER_RULES = [
    ("valid_buffering_count", "drop", "buffering_count >= 0"),
    ("valid_buffering_time", "drop", "buffering_time_ms >= 0"),
    ("valid_data_volumes", "drop", "total_source_data >= 0 AND total_p2p_data >= 0"),
    ("valid_quality_level", "drop", "quality_level IS NOT NULL"),
    ("reasonable_buffering", "warn", "buffering_time_ms <= 3600000"),
]
_KEPT = "buffering_count >= 0 AND buffering_time_ms >= 0 AND total_source_data >= 0 AND total_p2p_data >= 0"
sql("f01_expectation_warn", rules("silver", _SILVER_RULES[4], ("always_quarantine", "warn", "1 = 1")))
sql(
    "f02_expectation_drop",
    f"SELECT {KEY}, buffering_count, buffering_time_ms, total_source_data, total_p2p_data FROM exploded WHERE {_KEPT}",
)
sql(
    "f03_bronze_rules",
    rules(
        "report",
        ("valid_customer_id", "warn", "customerId <> ''"),
        ("valid_client_id", "warn", "clientId IS NOT NULL"),
        ("valid_timestamp", "warn", "timestamp_server > 0"),
        ("valid_event_date", "warn", "eventDate IS NOT NULL"),
        ("no_rescued_data", "warn", "rescued IS NULL"),
    ),
)
sql("f04_silver_rules", rules("exploded", *_SILVER_RULES))
sql(
    "f05_not_null_drop",
    f"SELECT {KEY}, buffering_count FROM exploded WHERE clientId IS NOT NULL AND buffering_count IS NOT NULL",
)
sql("f06_quarantine_filter", f"SELECT {KEY}, buffering_count, buffering_time_ms FROM quarantine")
sql(
    "f07_quarantine_reason",
    f"""SELECT {KEY}, contentId, timestamp_agent, buffering_count, buffering_time_ms, total_source_requests,
      total_source_data, total_p2p_requests, total_p2p_data, quality_source_requests, quality_source_data,
      quality_p2p_requests, quality_p2p_data, buffering_time_sec, quarantine_reason FROM quarantine""",
)
sql(
    "f07_quarantine_keep_empty",
    """SELECT quarantine_reason, count(*) AS row_count FROM (
      SELECT quarantine_reason FROM quarantine UNION ALL
      SELECT CASE WHEN buffering_count < 0 THEN 'negative_buffering_count' WHEN buffering_time_ms < 0 THEN 'negative_buffering_time'
        WHEN total_source_data < 0 THEN 'negative_source_data' WHEN total_p2p_data < 0 THEN 'negative_p2p_data'
        ELSE 'null_quality_level' END FROM report WHERE n = 0) GROUP BY 1""",
)
sql(
    "f08_recent_days",
    "SELECT "
    + ", ".join(f"count(*) FILTER ({since(n)}) AS last_{n}_days" for n in (1, 3, 7, 30))
    + f" FROM silver WHERE {since(30)}",
)
sql(
    "f09_quarantine_reasons",
    f"""SELECT {KEY}, concat_ws(',', CASE WHEN buffering_count < 0 THEN 'negative_buffering_count' END,
      CASE WHEN buffering_time_ms < 0 THEN 'negative_buffering_time' END,
      CASE WHEN total_source_data < 0 THEN 'negative_source_data' END,
      CASE WHEN total_p2p_data < 0 THEN 'negative_p2p_data' END,
      CASE WHEN buffering_time_sec > 3600 THEN 'excessive_buffering' END) AS quarantine_reasons FROM quarantine""",
)
sql(
    "f10_routing_audit",
    f"""SELECT CASE WHEN s AND q THEN 'both' WHEN s THEN 'silver_only' WHEN q THEN 'quarantine_only' ELSE 'neither' END AS route,
      count(*) AS row_count
    FROM (SELECT coalesce({_KEPT} AND clientId IS NOT NULL, false) AS s,
      coalesce(buffering_count < 0 OR buffering_time_ms < 0 OR total_source_data < 0 OR total_p2p_data < 0
        OR buffering_time_sec > 3600, false) AS q FROM exploded) GROUP BY 1""",
)
_FIX = """CASE WHEN quarantine_reason LIKE '%negative%' THEN 'Fixable: Apply ABS() or set to 0'
  ELSE 'Unknown: Needs manual review' END"""
sql("f11_like_patterns", f"SELECT quarantine_reason, {_FIX} AS fixability, count(*) AS row_count FROM quarantine GROUP BY ALL")
_DONE = """(SELECT 1 FROM incoming i WHERE q.customerId = i.customerId AND q.clientId = i.clientId
  AND q.timestamp_server = i.timestamp_server AND q.quality_level = i.quality_level AND q.eventDate = i.eventDate)"""
sql("f12_unprocessed", f"SELECT {KEY}, quarantine_reason FROM quarantine q WHERE NOT EXISTS {_DONE}", REPAIR)
sql(
    "f13_in_subquery",
    "SELECT eventDate, count(*) AS row_count FROM silver WHERE eventDate IN (SELECT eventDate FROM incoming) GROUP BY 1",
    REPAIR,
)
sql("f14_having", "SELECT customerId, count(*) AS issue_count FROM quarantine GROUP BY 1 HAVING count(*) > 40")
sql(
    "f15_timestamp_rules",
    rules("exploded", ("valid_timestamp", "warn", f"timestamp_server > 0 AND timestamp_server <= {AS_OF_MS}")),
)
sql(
    "f15_error_count_rule",
    rules("(SELECT playbackSessionId, count(*) AS n FROM errs GROUP BY 1)", ("non_negative_errors", "warn", "n >= 0")),
    SIGNALS,
    ERRORS,
)

# --- joins ------------------------------------------------------------------------------

_DAILY = "(SELECT eventDate, count(*) AS {name} FROM {table} GROUP BY 1)"
_TOTAL = _DAILY.format(name="total_records", table="report")
sql(
    "j01_daily_join",
    f"SELECT * FROM {_DAILY.format(name='quarantine_count', table='quarantine')} JOIN {_TOTAL} USING (eventDate)",
)
sql(
    "j02_daily_left_join",
    f"""SELECT * FROM {_TOTAL} LEFT JOIN (SELECT eventDate, count(*) AS excessive FROM quarantine
      WHERE quarantine_reason = 'excessive_buffering' GROUP BY 1) USING (eventDate)""",
)
_MATCH = """SELECT customerId, clientId, eventDate, s.total AS silver_total_buffering,
  g.total_buffering_events AS gold_total_buffering,
  CASE WHEN s.total = g.total_buffering_events THEN '✅ Match' ELSE '❌ Mismatch' END AS status
  FROM (SELECT customerId, clientId, eventDate, CAST(sum(buffering_count) AS BIGINT) AS total FROM silver GROUP BY ALL) s
  JOIN gold g USING (customerId, clientId, eventDate)"""
sql("j03_silver_gold_join", _MATCH, GOLD)
sql(
    "j04_single_row_combination",
    """SELECT * FROM (SELECT count(*) AS bronze_count FROM report), (SELECT count(*) AS silver_count FROM silver),
      (SELECT count(*) AS quarantine_count FROM quarantine), (SELECT count(*) AS gold_count FROM gold)""",
    GOLD,
)
_KNOWN = """EXISTS (SELECT 1 FROM silver s WHERE s.customerId = i.customerId AND s.clientId = i.clientId
  AND s.timestamp_server = i.timestamp_server AND s.quality_level = i.quality_level AND s.eventDate = i.eventDate)"""
sql(
    "j05_match_counts",
    f"SELECT count(*) FILTER (known) AS rows_updated, count(*) FILTER (NOT known) AS rows_inserted FROM (SELECT {_KNOWN} AS known FROM incoming i)",
    REPAIR,
)
sql("j06_semi_and_anti", f"SELECT CASE WHEN {_KNOWN} THEN 'matched' ELSE 'not_matched' END AS side, {KEY} FROM incoming i", REPAIR)
sql("j07_shared_customers", "SELECT customerId FROM report INTERSECT SELECT customerId FROM silver")
sql(
    "j08_faults_with_signals",
    """SELECT g.userId, g.event_timestamp, q.quality_level, q.quarantine_reason, g.playbackSessionId, g.sequenceNumber, g.eventType
    FROM quarantine q JOIN sig g ON q.clientId = g.userId AND q.timestamp_server = g.event_timestamp""",
    SIGNALS,
)

# --- aggregates -------------------------------------------------------------------------

sql("a01_gold_viewer_qos", "SELECT * FROM gold", GOLD)
for _name, _column in {
    "a02_source_share": "source_traffic_percentage",
    "a03_buffering_ratio": "buffering_ratio_percentage",
    "a04_qos_score": "qos_score",
}.items():
    sql(_name, f"SELECT {VIEWER}, {_column} FROM gold", GOLD)
sql("a05_qos_category", "SELECT qos_category, count(*) AS viewer_days FROM gold GROUP BY 1", GOLD)
sql(
    "a07_exact_distincts",
    "SELECT "
    + ", ".join(f"count(DISTINCT {c}) AS distinct_{c}" for c in ("customerId", "clientId", "contentId", "quality_level", "eventDate"))
    + " FROM silver",
)
sql(
    "a08_composite_distinct",
    "SELECT eventDate, count(DISTINCT customerId || clientId || timestamp_server) AS total_sessions FROM silver GROUP BY 1",
)
sql(
    "a09_conditional_aggregates",
    """SELECT quality_level, CAST(sum(CASE WHEN buffering_count > 0 THEN 1 ELSE 0 END) AS BIGINT) AS rows_with_buffering,
      avg(CASE WHEN buffering_count > 0 THEN buffering_count END) AS avg_when_buffering,
      max(CASE WHEN buffering_count <= 0 THEN buffering_time_ms END) AS max_ms_without_count FROM silver GROUP BY 1""",
)
sql("a10_two_level_average", "SELECT avg(n) AS avg_daily_count FROM (SELECT count(*) AS n FROM report GROUP BY eventDate)")
sql("a11_global_aggregate", "SELECT max(timestamp_server) AS last_server_ms, count(*) AS total_records FROM report")
sql(
    "a12_gold_session_grain",
    "SELECT * FROM fair",
    """one_each AS (SELECT DISTINCT customerId, clientId, contentId, timestamp_server, timestamp_agent, eventDate,
      buffering_count, buffering_time_ms, total_source_data, total_p2p_data FROM silver)""",
    gold_over("one_each", "fair"),
)
sql(
    "a13_sample_per_group",
    """SELECT quality_level, customerId AS sample_customerId, contentId AS sample_contentId FROM (
      SELECT *, row_number() OVER (PARTITION BY quality_level ORDER BY timestamp_server, customerId, clientId, contentId) AS p
      FROM silver) WHERE p = 1""",
)
sql(
    "a14_span",
    """SELECT customerId, min(eventDate) AS first_date, max(eventDate) AS last_date,
      date_diff('day', min(eventDate), max(eventDate)) AS span_days FROM silver GROUP BY 1""",
)
sql(
    "a15_nested_sums",
    """SELECT eventDate, CAST(sum(buffering_time_ms) AS BIGINT) AS buffering_ms, CAST(sum(total_source_data) AS BIGINT) AS source_bytes,
      CAST(sum(total_p2p_data // 1000) AS BIGINT) AS p2p_requests FROM report GROUP BY 1""",
)
sql(
    "a16_duplicate_summary",
    """SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(duplicate_count), 0) AS BIGINT) AS total_duplicate_records,
      CAST(coalesce(sum(duplicate_count - 1), 0) AS BIGINT) AS extra_copies FROM groups""",
    COPIES,
)
_PER = "buffering_time_sec / nullif(CAST(buffering_count AS DOUBLE), 0)"
sql("a17_guarded_ratio_average", f"SELECT eventDate, {xavg(_PER)} AS avg_buffer_duration FROM silver GROUP BY 1")

# --- windows, order, sets ---------------------------------------------------------------

sql(
    "w01_share_of_total",
    """SELECT quarantine_reason, count(*) AS issue_count,
      round(CAST(count(*) AS DOUBLE) * 100e0 / sum(count(*)) OVER (), 2) AS pct_of_total FROM quarantine GROUP BY 1""",
)
sql(
    "w02_share_of_customers",
    """SELECT qos_category, count(DISTINCT customerId) AS customer_count,
      round(CAST(count(DISTINCT customerId) AS DOUBLE) * 100e0 / sum(count(DISTINCT customerId)) OVER (), 2) AS pct_customers
    FROM gold GROUP BY 1""",
    GOLD,
)
_RUNNING = """SELECT playbackSessionId, sequenceNumber, resolution,
  CAST(sum(bytes) OVER r AS BIGINT) AS bytesDownloaded, count(*) OVER r AS fragmentsLoaded
  FROM sig WINDOW r AS (PARTITION BY playbackSessionId, resolution ORDER BY sequenceNumber)"""
sql("w03_running_state", _RUNNING, SIGNALS)
_LATEST = f"""SELECT {SILVER} FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY timestamp_agent DESC NULLS LAST,
  contentId DESC, buffering_count DESC, buffering_time_ms DESC, quality_source_requests DESC, quality_source_data DESC,
  quality_p2p_requests DESC, quality_p2p_data DESC, total_source_data DESC, total_p2p_data DESC) AS p FROM copies) WHERE p = 1"""
sql("w04_keep_latest", _LATEST, COPIES)
sql(
    "w05_rate_z_score",
    """SELECT eventDate, quarantine_reason, round(rate, 4) AS rate_pct, round(m, 4) AS baseline_pct,
      round((rate - m) / nullif(s, 0), 4) AS z_score
    FROM (SELECT *, avg(rate) OVER b AS m, stddev_samp(rate) OVER b AS s FROM (
      SELECT eventDate, quarantine_reason, CAST(n AS DOUBLE) * 100e0 / total AS rate
      FROM (SELECT eventDate, quarantine_reason, count(*) AS n FROM quarantine GROUP BY ALL)
      JOIN (SELECT eventDate, count(*) AS total FROM report GROUP BY 1) USING (eventDate))
      WINDOW b AS (PARTITION BY quarantine_reason ORDER BY eventDate ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
)
_FAILURES = "SELECT eventDate, quarantine_reason, count(*) AS failure_count FROM quarantine WHERE {} GROUP BY ALL"
sql("o01_sort_by_keys", _FAILURES.format(since(30)) + " ORDER BY eventDate DESC, failure_count DESC")
sql(
    "o02_custom_order",
    """SELECT qos_category, count(*) AS viewer_days,
      CASE qos_category WHEN 'Excellent' THEN 1 WHEN 'Good' THEN 2 WHEN 'Fair' THEN 3 ELSE 4 END AS place
    FROM gold GROUP BY 1 ORDER BY place""",
    GOLD,
)
sql(
    "o03_nulls_last_limit",
    """SELECT timestamp_agent, customerId, clientId, quality_level FROM silver
    ORDER BY timestamp_agent DESC NULLS LAST, customerId, clientId, quality_level LIMIT 10""",
)
_TOP = """SELECT customerId, quarantine_reason, count(*) AS issue_count FROM quarantine WHERE {} GROUP BY ALL
  ORDER BY issue_count DESC, customerId, quarantine_reason LIMIT 100"""
sql("o04_top_k", _TOP.format(since(30)))
sql("o05_sample_rows", f"SELECT {KEY}, quarantine_reason FROM quarantine ORDER BY eventDate, timestamp_server, customerId, clientId NULLS FIRST, quality_level LIMIT 5")
_DATES = f"""SELECT 'Silver Enriched' AS layer, min(eventDate) AS earliest_date, max(eventDate) AS latest_date,
    count(DISTINCT eventDate) AS distinct_dates, count(*) AS record_count FROM silver
  UNION ALL SELECT 'Gold Metrics', min(eventDate), max(eventDate), count(DISTINCT eventDate), count(*) FROM gold
  UNION ALL SELECT '⚠️ Date Gap', NULL, NULL, NULL, CASE WHEN g < s THEN date_diff('day', g, s) ELSE 0 END
  FROM (SELECT max(eventDate) AS s FROM silver), (SELECT max(eventDate) AS g FROM gold)"""
sql("u01_union_with_padding", _DATES, GOLD)
sql("u02_ordered_union", per_layer("count(*) AS record_count"), GOLD)
sql("u03_distinct_rows", f"SELECT DISTINCT {SILVER} FROM copies", COPIES)
sql("u04_distinct_values", "SELECT DISTINCT customerId, quality_level FROM silver")

# --- scalar functions -------------------------------------------------------------------

_AGE = f"round((epoch_us({NOW}) // 1000000 - {{}} / 1000e0) / 3600e0, 2)"
_MINUTES = f"({AS_OF_MS} - {{}}) // 60000"
_SCALARS = {
    "x01_epoch_to_timestamp": ("silver", SERVER, f"{at('timestamp_server')} AS event_time"),
    "x02_age_in_hours": ("silver", SERVER, f"{_AGE.format('timestamp_server')} AS age_hours"),
    "x03_minutes_between": ("silver", SERVER, f"{_MINUTES.format('timestamp_server')} AS lag_minutes"),
    "x04_date_difference": ("gold", VIEWER, f"date_diff('day', eventDate, {DAY}) AS days"),
    "x05_date_minus_days": ("gold", VIEWER, f"{since(7)} AS is_recent"),
    "x06_epoch_to_date": ("silver", SERVER, f"CAST({at('timestamp_server')} AS DATE) AS server_date"),
    "x07_round": ("gold", VIEWER, "round(avg_buffering_per_session, 2) AS two, round(total_buffering_time_sec, 0) AS none"),
    "x08_nullif_guard": ("silver", SERVER, f"{_PER} AS per_interruption"),
    "x09_coalesce": ("silver", SERVER, "coalesce(timestamp_agent, timestamp_server) AS agent"),
    "x10_abs": ("quarantine", SERVER, "abs(total_source_data) AS bytes, abs(buffering_time_ms) AS ms"),
    "x11_greatest": ("gold", VIEWER, "greatest(0e0, 50e0 - qos_score) AS floored"),
    "x12_concat": ("silver", "quality_level", "concat_ws('|', customerId, clientId, eventDate, timestamp_server) AS session"),
    "x13_falsy_default": ("sig", SIGNAL, "coalesce(nullif(effectiveType, ''), 'unknown') AS connection"),
    "x14_finite_or_default": ("sig", SIGNAL, "coalesce(rtt, -1e0) AS rtt"),
    "x16_cap": ("quarantine", SERVER, "least(buffering_time_sec, 3600e0) AS capped"),
    "x17_status_tiers": ("gold", VIEWER, tier("total_buffering_time_sec", 10, 5) + " AS status"),
    "x18_length": ("gold", VIEWER, "customerId <> '' AS has_customer"),
    "x19_ellipsis": ("sig", SIGNAL, "CASE WHEN length(userAgent) > 180 THEN left(userAgent, 180) || '...' ELSE userAgent END AS agent"),
    "x20_upper_default": ("sig", SIGNAL, "upper(coalesce(errorType, 'unknown')) AS category"),
    "x21_fixed_digits": ("sig", SIGNAL, "round(downlink / 3, 2) AS two, round(downlink / 3, 4) AS four"),
    "x23_key_composition": ("sig", SIGNAL, "playbackSessionId || '-' || event_timestamp || '-' || sequenceNumber AS key"),
}
for _name, (_table, _keys, _columns) in _SCALARS.items():
    sql(_name, f"SELECT {_keys}, {_columns} FROM {_table}", GOLD, SIGNALS)
sql(
    "x15_fill_nulls",
    """SELECT timestamp_server, contentId, coalesce(buffering_count, 0) AS buffering_count, buffering_time_ms, quality_level
    FROM exploded""",
)
sql(
    "x22_map_transform",
    """SELECT contentId, timestamp_server, n AS levels, CASE WHEN n = 0 THEN 0 ELSE total_source_data + total_p2p_data END AS all_bytes,
      (SELECT e.quality_source_data + e.quality_p2p_data FROM exploded e WHERE e.eid = r.eid AND e.quality_level = '720p') AS bytes_720p
    FROM report r""",
)

# --- repair and maintenance -------------------------------------------------------------

_ABS = "abs(buffering_count) AS buffering_count, abs(buffering_time_ms) AS buffering_time_ms, abs(total_source_data) AS total_source_data, abs(total_p2p_data) AS total_p2p_data"
sql("m01_upsert", f"SELECT {SILVER} FROM merged", REPAIR)
sql("m02_fix_negative_values", f"SELECT {KEY}, {_ABS} FROM quarantine")
sql(
    "m03_fix_null_values",
    f"""SELECT {KEY}, coalesce(buffering_count, 0) AS buffering_count, coalesce(buffering_time_ms, 0) AS buffering_time_ms,
      coalesce(total_source_data, 0) AS total_source_data, coalesce(total_p2p_data, 0) AS total_p2p_data FROM quarantine""",
)
sql(
    "m04_fixes_in_original_order",
    f"""SELECT {KEY}, contentId, timestamp_agent, coalesce(abs(buffering_count), 0) AS buffering_count,
      abs(buffering_time_ms) AS buffering_time_ms, abs(buffering_time_ms) / 1000e0 AS buffering_time_sec FROM quarantine""",
)
sql("m04_repair_quarantine", f"SELECT {SILVER} FROM fixed", REPAIR)
sql("m05_retention", f"SELECT eventDate, count(*) AS row_count FROM silver WHERE {since(20)} GROUP BY 1")
sql(
    "m06_delete_reprocessed",
    f"""SELECT {KEY}, quarantine_reason FROM quarantine WHERE NOT (quarantine_reason = 'excessive_buffering'
      AND eventDate IN (SELECT eventDate FROM incoming))""",
    REPAIR,
)
sql(
    "m10_mark_processed",
    f"""SELECT {KEY}, quarantine_reason, CASE WHEN done THEN 'batch-1' END AS processed_id,
      CASE WHEN done THEN {NOW} END AS processed_timestamp FROM (SELECT *, EXISTS {_DONE} AS done FROM quarantine q)""",
    REPAIR,
)
sql(
    "m11_archive_split",
    f"SELECT CASE WHEN EXISTS {_DONE} THEN 'archive' ELSE 'keep' END AS side, {KEY}, quarantine_reason FROM quarantine q",
    REPAIR,
)
sql(
    "m13_dry_run",
    f"""SELECT count(*) AS original_records, count(*) AS fixed_records, 0 AS still_bad_records, 100e0 AS success_rate_pct,
      0 AS negative_buffering_count, count(*) FILTER (customerId IS NULL) AS "null_customerId",
      count(*) FILTER (contentId IS NULL) AS "null_contentId", count(*) FILTER (clientId IS NULL) AS "null_clientId",
      count(*) FILTER (quality_level IS NULL) AS null_quality_level FROM quarantine WHERE {since(7)}""",
)
sql(
    "m15_dedupe_counts",
    """SELECT CAST(sum(c) AS BIGINT) AS original_records, count(*) AS deduplicated_records,
      CAST(sum(c - 1) AS BIGINT) AS duplicates_removed FROM (SELECT count(*) AS c FROM copies
      GROUP BY customerId, clientId, timestamp_server, quality_level, eventDate)""",
    COPIES,
)
sql(
    "m16_fix_timestamp",
    f"SELECT customerId, clientId, quality_level, abs(timestamp_server - {AS_OF_MS} + 86400000) AS timestamp_server FROM silver",
)
sql("t06_refresh_affected_dates", "SELECT * FROM after", REPAIR, gold_over("merged", "after"))
sql("t07_reconciliation", f"SELECT status, count(*) AS keys FROM ({_MATCH}) GROUP BY 1", GOLD)
_WINDOWS = """SELECT playbackSessionId, time_bucket(INTERVAL {}, make_timestamp(event_timestamp * 1000)) AS window_start,
  count(*) AS event_count{} FROM sig GROUP BY ALL"""
sql("t08_flush_windows", _WINDOWS.format("10 SECONDS", ""), SIGNALS)

# --- alerts -----------------------------------------------------------------------------

_R01 = f"""SELECT 'BRONZE_DATA_FRESHNESS' AS alert_name, {at('max(timestamp_server)')} AS last_event_timestamp,
  {_AGE.format('max(timestamp_server)')} AS hours_since_last_event, count(*) AS total_records,
  {tier('hours_since_last_event', 2)} AS status FROM report WHERE {since(7)}"""
_COUNTS = "(SELECT count(*) AS bronze_count FROM report WHERE {w}), (SELECT count(*) AS quarantine_count FROM quarantine WHERE {w})"
_R02 = f"""SELECT 'HIGH_QUARANTINE_RATE' AS alert_name, bronze_count, quarantine_count,
  round({pct('quarantine_count', 'bronze_count')}, 2) AS quarantine_rate_pct, {tier('quarantine_rate_pct', 5, 3)} AS status
  FROM {_COUNTS.format(w=since(1))}"""
_R03 = f"""SELECT 'DATA_VOLUME_ANOMALY' AS alert_name, round(baseline, 0) AS avg_daily_baseline, today_volume,
  round({pct('today_volume', 'baseline')}, 2) AS pct_of_baseline, {tier('pct_of_baseline', 50, 70, '<')} AS status
  FROM (SELECT avg(n) AS baseline FROM (SELECT count(*) AS n FROM report WHERE {since(7)} AND eventDate < {DAY} GROUP BY eventDate)),
       (SELECT count(*) AS today_volume FROM report WHERE eventDate = {DAY})"""
_R04 = f"""SELECT 'BUFFERING_DEGRADATION' AS alert_name, round(m, 2) AS avg_buffering_time_sec, total_sessions,
  sessions_with_buffering, buffering_sessions_pct,
  CASE WHEN m > 10 OR buffering_sessions_pct > 15 THEN 'ALERT' WHEN m > 7 OR buffering_sessions_pct > 10 THEN 'WARNING' ELSE 'OK' END AS status
  FROM (SELECT CAST(sum(buffering_time_ms) AS DOUBLE) / 1000e0 / count(*) AS m, count(*) FILTER (buffering_count > 0) AS sessions_with_buffering,
    count(DISTINCT customerId || clientId || timestamp_server) AS total_sessions,
    round({pct('sessions_with_buffering', 'total_sessions')}, 2) AS buffering_sessions_pct FROM silver WHERE eventDate = {DAY})"""
_R05 = f"""SELECT 'GOLD_LAYER_LAG' AS alert_name, {at('s')} AS silver_latest_event, gold_latest_date,
  date_diff('day', gold_latest_date, {DAY}) AS lag_days, {tier('lag_days', 1, 0)} AS status
  FROM (SELECT max(timestamp_server) AS s FROM silver), (SELECT max(eventDate) AS gold_latest_date FROM gold)"""
_R06 = f"""SELECT 'QUARANTINE_REASON_SPIKE' AS alert_name, quarantine_reason, count(*) AS issue_count,
  count(DISTINCT customerId) AS affected_customers, {tier('count(*)', 1000, 500)} AS status
  FROM quarantine WHERE eventDate = {DAY} GROUP BY quarantine_reason"""
sql("r01_bronze_freshness_alert", _R01)
sql("r02_quarantine_rate_alert", _R02)
sql("r03_volume_anomaly_alert", _R03)
sql("r04_buffering_alert", _R04)
sql("r05_gold_lag_alert", _R05, GOLD)
sql("r06_reason_spike_alert", _R06)
sql(
    "r07_stale_bronze",
    f"""SELECT {at('max(timestamp_server)')} AS last_record, date_diff('day', CAST(last_record AS DATE), DATE '2024-02-02') AS days_since_last_record
    FROM report HAVING days_since_last_record > 1""",
)
sql(
    "r08_quarantine_rate_today",
    f"""SELECT quarantine_count, bronze_count, {pct('quarantine_count', 'bronze_count')} AS quarantine_rate_pct
    FROM {_COUNTS.format(w=f'eventDate = {DAY}')} WHERE quarantine_rate_pct > 5""",
)
sql(
    "r09_volume_deviation",
    f"""SELECT avg(n) AS avg_7day, max(CASE WHEN eventDate = {DAY} THEN n END) AS today_count,
      abs(today_count - avg_7day) / avg_7day AS deviation
    FROM (SELECT eventDate, count(*) AS n FROM report WHERE {since(7)} GROUP BY 1) HAVING deviation > 0""",
)
_EARLIER = f"CASE WHEN eventDate < {DAY} THEN v END"
sql(
    "r10_buffering_trend",
    f"""SELECT {xavg(_EARLIER)} AS baseline, max(CASE WHEN eventDate = {DAY} THEN v END) AS today,
      (today - baseline) / baseline AS change
    FROM (SELECT eventDate, {xavg(_PER)} AS v FROM silver WHERE {since(7)} GROUP BY 1) HAVING change > -1""",
)
sql(
    "r11_layer_lag",
    """SELECT s AS silver_latest, g AS gold_latest, date_diff('day', g, s) AS lag_days
    FROM (SELECT max(eventDate) AS s FROM silver), (SELECT max(eventDate) AS g FROM gold) WHERE lag_days > -1""",
    GOLD,
)
sql(
    "r12_failing_reasons",
    f"SELECT quarantine_reason, count(*) AS failure_count FROM quarantine WHERE eventDate = {DAY} GROUP BY 1 HAVING count(*) > 2",
)
_SINGLE = {
    "hours_since_last_event": (_R01, "CRITICAL"),
    "quarantine_rate_pct": (_R02, "HIGH"),
    "pct_of_baseline": (_R03, "HIGH"),
    "buffering_sessions_pct": (_R04, "MEDIUM"),
    "lag_days": (_R05, "MEDIUM"),
}
sql(
    "r13_all_alerts",
    " UNION ALL ".join(
        f"SELECT alert_name, '{metric}' AS metric, CAST({metric} AS DOUBLE) AS value, status, '{level}' AS severity FROM ({body})"
        for metric, (body, level) in _SINGLE.items()
    )
    + f" UNION ALL SELECT alert_name, 'issue_count:' || quarantine_reason, CAST(issue_count AS DOUBLE), status, 'MEDIUM' FROM ({_R06})",
    GOLD,
)

# --- monitoring -------------------------------------------------------------------------

_LAG = "CASE WHEN lag_minutes < 60 THEN '✓ Fresh' WHEN lag_minutes < 120 THEN '⚠ Warning' ELSE '✗ Critical Lag' END AS status"
_FRESH = f"""SELECT '{{layer}}' AS layer, {at('max(timestamp_server)')} AS latest_server_time,
  {_MINUTES.format('max(timestamp_server)')} AS lag_minutes, count(*) AS total_records, {{extra}}, {_LAG} FROM {{table}} WHERE {since(7)}"""
sql(
    "r20_bronze_freshness",
    _FRESH.format(layer="bronze_telemetry_raw", extra="count(DISTINCT eventDate) AS date_partitions", table="report"),
)
sql(
    "r21_silver_freshness",
    _FRESH.format(layer="silver_telemetry_enriched", extra="count(DISTINCT customerId) AS unique_customers", table="silver"),
)
sql(
    "r22_gold_freshness",
    f"""SELECT 'gold_viewer_qos_metrics' AS layer, max(eventDate) AS latest_date, count(DISTINCT customerId) AS unique_customers,
      count(DISTINCT clientId) AS unique_clients, CAST(sum(total_sessions) AS BIGINT) AS total_sessions_aggregated,
      date_diff('day', max(eventDate), {DAY}) AS days_behind,
      CASE days_behind WHEN 0 THEN '✓ Current' WHEN 1 THEN '⚠ 1 Day Behind' ELSE '✗ Stale' END AS status
    FROM gold WHERE {since(7)}""",
    GOLD,
)
sql(
    "r23_daily_quarantine_rate",
    f"""SELECT eventDate, quarantine_count, total_records, round({pct('quarantine_count', 'total_records')}, 2) AS quarantine_rate_pct,
      affected_customers, CASE WHEN {pct('quarantine_count', 'total_records')} < 5 THEN '✓ Normal'
        WHEN {pct('quarantine_count', 'total_records')} < 10 THEN '⚠ Warning' ELSE '✗ Critical' END AS status
    FROM (SELECT eventDate, count(*) AS quarantine_count, count(DISTINCT customerId) AS affected_customers
      FROM quarantine WHERE {since(7)} GROUP BY 1)
    JOIN (SELECT eventDate, count(*) AS total_records FROM report WHERE {since(7)} GROUP BY 1) USING (eventDate)""",
)
sql(
    "r24_quarantine_breakdown",
    f"""SELECT quarantine_reason, count(*) AS failure_count, count(DISTINCT customerId) AS affected_customers,
      min(eventDate) AS first_seen, max(eventDate) AS last_seen,
      round(CAST(count(*) AS DOUBLE) * 100e0 / sum(count(*)) OVER (), 2) AS pct_of_total
    FROM quarantine WHERE {since(7)} GROUP BY 1""",
)
sql(
    "r25_category_distribution",
    f"""SELECT * EXCLUDE (share), round(share, 2) AS pct_customers,
      CASE WHEN qos_category = 'Poor' AND share > 10 THEN '✗ High Poor QoS'
        WHEN qos_category = 'Poor' AND share > 5 THEN '⚠ Elevated Poor QoS' ELSE '✓ OK' END AS alert_status
    FROM (SELECT qos_category, count(DISTINCT customerId) AS customer_count, round({xavg('qos_score')}, 2) AS avg_score,
      round({xavg('total_buffering_time_sec')}, 2) AS avg_buffering_sec, round({xavg('total_data_consumed_mb')}, 2) AS avg_data_mb,
      CAST(count(DISTINCT customerId) AS DOUBLE) * 100e0 / sum(count(DISTINCT customerId)) OVER () AS share
      FROM gold WHERE {since(7)} GROUP BY 1)""",
    GOLD,
)
_NEW, _OLD = f"CASE WHEN {since(3)} THEN score END", f"CASE WHEN NOT ({since(3)}) THEN score END"
_NEW_SECONDS = f"CASE WHEN {since(3)} THEN seconds END"
sql(
    "r26_customer_trend",
    f"""SELECT customerId, round(b, 2) AS baseline_qos_score, round(a, 2) AS recent_qos_score, round(a - b, 2) AS qos_change,
      round((a - b) / nullif(b, 0) * 100, 2) AS qos_change_pct, round(sec, 2) AS recent_buffering_sec,
      CASE WHEN a - b < -20 THEN '✗ Severe Degradation' WHEN a - b < -10 THEN '⚠ Moderate Degradation'
        WHEN a - b > 10 THEN '✓ Improvement' ELSE '→ Stable' END AS trend_status
    FROM (SELECT customerId, {xavg(_NEW)} AS a, {xavg(_OLD)} AS b, {xsum(_NEW_SECONDS)} AS sec
      FROM (SELECT customerId, eventDate, {xavg('qos_score')} AS score, {xsum('total_buffering_time_sec')} AS seconds
        FROM gold WHERE {since(7)} GROUP BY ALL) GROUP BY 1)
    WHERE a IS NOT NULL AND b IS NOT NULL AND abs(a - b) > 0.5 ORDER BY qos_change, customerId LIMIT 100""",
    GOLD,
)
sql(
    "r28_daily_ingest",
    f"""SELECT eventDate, count(*) AS records_ingested, count(DISTINCT customerId) AS unique_customers,
      count(DISTINCT contentId) AS unique_content, round(CAST(sum(buffering_time_ms) AS DOUBLE) / 1000e0, 2) AS total_buffering_sec,
      round(CAST(sum(total_source_data) + sum(total_p2p_data) AS DOUBLE) / 1073741824e0, 2) AS total_data_gb
    FROM report WHERE {since(7)} GROUP BY 1""",
)
sql(
    "r29_retention_status",
    per_layer(
        "min(eventDate) AS oldest_record, max(eventDate) AS newest_record,"
        " date_diff('day', min(eventDate), max(eventDate)) AS data_span_days, count(*) AS record_count",
        "table_name",
    ),
    GOLD,
)
sql("r30_layer_dates", _DATES, GOLD)
sql("r31_record_counts", per_layer("count(*) AS record_count"), GOLD)
sql(
    "r32_days_behind",
    per_layer(f"max(eventDate) AS latest_date, date_diff('day', max(eventDate), {DAY}) AS days_behind"),
    GOLD,
)
sql(
    "r34_explosion_ratio",
    """SELECT *, CAST(silver_count AS DOUBLE) / bronze_count AS explosion_ratio,
      CASE WHEN explosion_ratio BETWEEN 2 AND 3 THEN 'OK' ELSE 'OUT_OF_RANGE' END AS status
    FROM (SELECT count(*) AS bronze_count FROM report), (SELECT count(*) AS silver_count FROM silver)""",
)
sql(
    "r35_pass_rate",
    f"""SELECT *, {pct('silver_count', 'silver_count + quarantine_count')} AS pass_rate_pct
    FROM (SELECT count(*) AS silver_count FROM silver), (SELECT count(*) AS quarantine_count FROM quarantine)""",
)
sql(
    "r36_poor_viewers",
    f"""SELECT count(*) AS viewer_days, count(*) FILTER (qos_category = 'Poor') AS poor_viewer_days,
      {pct('poor_viewer_days', 'viewer_days')} AS poor_rate_pct, {tier('poor_rate_pct', 25)} AS status FROM gold""",
    GOLD,
)

# --- quarantine analysis ----------------------------------------------------------------

sql(
    "r40_reason_summary",
    f"""SELECT quarantine_reason, count(*) AS issue_count, count(DISTINCT customerId) AS affected_customers,
      count(DISTINCT eventDate) AS affected_dates, {NOW} AS first_seen, {NOW} AS last_seen,
      round(CAST(count(*) AS DOUBLE) * 100e0 / sum(count(*)) OVER (), 2) AS pct_of_total
    FROM quarantine WHERE {since(30)} GROUP BY 1""",
)
sql(
    "r41_fixability",
    f"""SELECT fixability, fix_priority, count(*) AS distinct_reasons, CAST(sum(n) AS BIGINT) AS total_records
    FROM (SELECT quarantine_reason, count(*) AS n, {_FIX} AS fixability,
      CASE WHEN quarantine_reason LIKE '%negative%' THEN 'HIGH' ELSE 'LOW' END AS fix_priority
      FROM quarantine WHERE {since(7)} GROUP BY 1) GROUP BY ALL""",
)
sql(
    "r42_reason_sample",
    f"""SELECT quarantine_reason, cnt AS count, customerId AS "sample_customerId", eventDate AS "sample_eventDate" FROM (
      SELECT *, count(*) OVER (PARTITION BY quarantine_reason) AS cnt, row_number() OVER (PARTITION BY quarantine_reason
        ORDER BY timestamp_server, customerId, clientId NULLS FIRST, quality_level) AS p
      FROM quarantine WHERE {since(7)}) WHERE p = 1""",
)
sql(
    "r44_duplicate_report",
    """SELECT check_type, duplicate_groups, total_duplicate_records, extra_copies FROM (
      SELECT 'Duplicate Detection Summary' AS check_type, count(*) AS duplicate_groups,
        CAST(sum(duplicate_count) AS BIGINT) AS total_duplicate_records, CAST(sum(duplicate_count - 1) AS BIGINT) AS extra_copies,
        NULL AS quality_level FROM groups
      UNION ALL SELECT 'Sample Duplicates (Top 5)', NULL, NULL, NULL, NULL
      UNION ALL SELECT '  ' || customerId || ' | ' || clientId || ' | ' || CAST(make_timestamp(timestamp_server * 1000) AS DATE),
        NULL, duplicate_count, NULL, quality_level FROM groups)
    ORDER BY total_duplicate_records DESC NULLS LAST, check_type, quality_level LIMIT 10""",
    COPIES,
)
sql("r45_duplicate_groups", "SELECT * FROM groups", COPIES)
sql(
    "r46_before_after",
    f"""SELECT 'Silver Enriched' AS layer, count(*) AS records, count(DISTINCT customerId) AS customers,
      min(eventDate) || ' to ' || max(eventDate) AS date_range FROM silver
    UNION ALL SELECT 'Quarantine (last 7d)', count(*), count(DISTINCT customerId), 'Recent records only' FROM quarantine WHERE {since(7)}""",
)
sql(
    "r47_daily_rate_by_reason",
    f"""SELECT eventDate, quarantine_reason, quarantine_count, bronze_count,
      round({pct('quarantine_count', 'bronze_count')}, 2) AS quarantine_rate_pct
    FROM (SELECT eventDate, quarantine_reason, count(*) AS quarantine_count FROM quarantine WHERE {since(30)} GROUP BY ALL)
    LEFT JOIN (SELECT eventDate, count(*) AS bronze_count FROM report WHERE {since(30)} GROUP BY 1) USING (eventDate)""",
)
sql("r48_daily_failures", _FAILURES.format(since(7)))
sql("r49_top_customers", _TOP.format(since(1)))
sql(
    "r50_reprocessing_health",
    f"""SELECT success_rate_pct, overdue_records, new_reasons, CASE WHEN success_rate_pct < 80 THEN 'ALERT' ELSE 'OK' END AS success_status,
      CASE WHEN overdue_records > 0 THEN 'ALERT' ELSE 'OK' END AS overdue_status,
      CASE WHEN new_reasons > 0 THEN 'ALERT' ELSE 'OK' END AS new_reason_status
    FROM (SELECT round({pct("count(*) FILTER (customerId IS NOT NULL AND quality_level IS NOT NULL)", "count(*)")}, 2) AS success_rate_pct,
        count(*) FILTER (NOT ({since(7)})) AS overdue_records FROM quarantine),
      (SELECT count(*) AS new_reasons FROM (SELECT quarantine_reason FROM quarantine WHERE eventDate = {DAY}
        EXCEPT SELECT quarantine_reason FROM quarantine WHERE eventDate <> {DAY}))""",
)

# --- dashboards -------------------------------------------------------------------------

sql(
    "r60_score_distribution",
    "SELECT qos_category, CAST(floor(qos_score / 10) AS BIGINT) AS score_bucket, count(*) AS viewer_days FROM gold GROUP BY ALL",
    GOLD,
)
sql("r61_buffering_trend", "SELECT eventDate, CAST(sum(total_buffering_events) AS BIGINT) AS buffering_events FROM gold GROUP BY 1", GOLD)
sql(
    "r62_worst_customers",
    f"""SELECT customerId, {xavg('qos_score')} AS avg_qos_score, count(*) AS viewer_days FROM gold GROUP BY 1
    ORDER BY avg_qos_score, customerId LIMIT 10""",
    GOLD,
)
sql(
    "r63_traffic_split",
    """SELECT s AS source_bytes, p AS p2p_bytes, CAST(s AS DOUBLE) / (s + p) * 100e0 AS source_pct, CAST(p AS DOUBLE) / (s + p) * 100e0 AS p2p_pct
    FROM (SELECT CAST(sum(total_source_data_bytes) AS BIGINT) AS s, CAST(sum(total_p2p_data_bytes) AS BIGINT) AS p FROM gold)""",
    GOLD,
)
sql("r64_data_volume", f"SELECT eventDate, {xsum('total_data_consumed_mb')} AS data_mb FROM gold GROUP BY 1", GOLD)
sql(
    "r65_rebuffering_over_time",
    f"""SELECT eventDate, {xsum('total_buffering_time_sec')} / ({xsum('total_data_consumed_mb')} * 2e0) * 100e0 AS rebuffering_ratio_pct
    FROM gold GROUP BY 1""",
    GOLD,
)
sql("r66_score_trend", f"SELECT eventDate, {xavg('qos_score')} AS avg_qos_score FROM gold GROUP BY 1", GOLD)
sql(
    "r67_score_by_source_share",
    f"""SELECT CAST(floor(source_traffic_percentage / 20) AS BIGINT) AS source_share_bucket, {xavg('qos_score')} AS avg_qos_score,
      count(*) AS viewer_days FROM gold GROUP BY 1""",
    GOLD,
)
sql("r68_session_impact", "SELECT eventDate, qos_category, CAST(sum(total_sessions) AS BIGINT) AS sessions FROM gold GROUP BY ALL", GOLD)
sql(
    "r69_viewers_and_buffering",
    """SELECT *, round((SELECT corr(viewers, buffering_events) FROM daily), 6) AS correlation FROM daily""",
    GOLD,
    """daily AS (SELECT eventDate, count(DISTINCT clientId) AS viewers, CAST(sum(total_buffering_events) AS BIGINT) AS buffering_events
      FROM gold GROUP BY 1)""",
)


def _compare(now: str, before: str) -> str:
    def figures(when: str, suffix: str) -> str:
        score = f"CASE WHEN {when} THEN qos_score END"
        return (
            f"{xavg(score)} AS score_{suffix}, count(DISTINCT CASE WHEN {when} THEN clientId END) AS viewers_{suffix},"
            f" CAST(sum(CASE WHEN {when} THEN total_buffering_events ELSE 0 END) AS BIGINT) AS events_{suffix},"
            f" CAST(sum(CASE WHEN {when} THEN total_sessions ELSE 0 END) AS BIGINT) AS sessions_{suffix}"
        )

    deltas = ", ".join(f"{n}_now - {n}_before AS {n}_delta" for n in ("score", "viewers", "events", "sessions"))
    return f"SELECT *, {deltas} FROM (SELECT {figures(now, 'now')}, {figures(before, 'before')} FROM gold)"


sql("r70_today_against_yesterday", _compare(f"eventDate = {DAY}", f"eventDate = {DAY} - 1"), GOLD)
sql(
    "r71_week_over_week",
    _compare(
        f"eventDate > {DAY} - 7 AND eventDate <= {DAY}", f"eventDate > {DAY} - 14 AND eventDate <= {DAY} - 7"
    ),
    GOLD,
)
sql(
    "r72_consistently_poor",
    f"""SELECT customerId, count(*) AS active_days, min(worst) AS lowest_score
    FROM (SELECT customerId, eventDate, bool_or(qos_category = 'Poor') AS poor, min(qos_score) AS worst
      FROM gold WHERE {since(7)} GROUP BY ALL) GROUP BY 1 HAVING bool_and(poor)""",
    GOLD,
)

# --- contract checks --------------------------------------------------------------------

_REQUIRED = [
    "customerId", "contentId", "clientId", "timestamp_server", "buffering_count", "buffering_time_ms",
    "buffering_time_sec", "quality_level", "total_source_data", "total_p2p_data", "total_data_mb", "eventDate",
]
sql(
    "c05_null_counts",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM exploded" for c in _REQUIRED),
)


def check(name: str, category: str, status: str, message: str, value: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{category}' AS category, {status} AS status, {message} AS message,"
        f" CAST({value} AS DOUBLE) AS value FROM {source}"
    )


_CHECKS = {
    "c05_not_null": check(
        "NOT NULL Constraints Validation", "Data Quality", "'PASS'", "'0 nulls in ' || count(*) || ' rows'", "0", "silver"
    ),
    "c06_value_ranges": check(
        "Value Range Validation", "Data Quality", "CASE WHEN n > 0 THEN 'WARN' ELSE 'PASS' END",
        "'0 violations, ' || n || ' rows over one hour'", "0",
        "(SELECT count(*) FILTER (buffering_time_ms > 3600000) AS n FROM silver)",
    ),
    "c07_bronze_to_silver": check(
        "Bronze to Silver Data Flow", "Data Flow", "CASE WHEN b > 0 AND (s < b OR c = 0) THEN 'FAIL' ELSE 'PASS' END",
        "b || ' -> ' || s || ' rows, ' || c || ' shared customers'", "CAST(s AS DOUBLE) / b",
        """(SELECT count(*) AS b FROM report), (SELECT count(*) AS s FROM silver),
        (SELECT count(*) AS c FROM (SELECT customerId FROM report INTERSECT SELECT customerId FROM silver))""",
    ),
    "c08_quarantine_logic": check(
        "Quarantine Logic Validation", "Data Quality", "'PASS'",
        "count(*) || ' records with ' || count(DISTINCT quarantine_reason) || ' reasons'", "count(*)", "quarantine",
    ),
    "c09_gold_is_smaller": check(
        "Gold Layer Aggregation Validation", "Data Flow", "CASE WHEN g = 0 OR g >= s THEN 'FAIL' ELSE 'PASS' END",
        "s || ' -> ' || g || ' rows'", "g", "(SELECT count(*) AS s FROM silver), (SELECT count(*) AS g FROM gold)",
    ),
    "c10_freshness": check(
        "Data Freshness Check", "Pipeline Health", "CASE WHEN age > 24 THEN 'WARN' ELSE 'PASS' END",
        "'Data is ' || round(age, 1) || ' hours old'", "age",
        f"(SELECT {_AGE.format('max(timestamp_server)')} AS age FROM report)",
    ),
    "c13_aggregation_accuracy": check(
        "Aggregation Accuracy", "Data Flow", "'PASS'", "'0 of ' || count(*) || ' keys differ'", "0", "gold"
    ),
}
for _name, _body in _CHECKS.items():
    sql(_name, _body, GOLD)
_EXTRA = "(SELECT CAST(coalesce(sum(duplicate_count - 1), 0) AS BIGINT) AS n FROM {})"
sql(
    "c14_duplicates",
    check("Deduplication Check", "Data Quality", "CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END", "n || ' extra copies'", "n", _EXTRA.format("groups")),
    COPIES,
)
sql(
    "c08_top_reasons",
    "SELECT quarantine_reason, count(*) AS record_count FROM quarantine GROUP BY 1 ORDER BY record_count DESC, quarantine_reason LIMIT 5",
)
_DUPLICATES = """(SELECT coalesce(sum(n - 1), 0) AS n FROM (SELECT count(*) AS n FROM silver
  GROUP BY customerId, clientId, timestamp_server, quality_level, eventDate))"""
_ALL = [
    "SELECT 'Schema Validation' AS category, 'PASS' AS status FROM (VALUES (1), (2))",
    *[f"SELECT category, status FROM ({body})" for body in _CHECKS.values()],
    f"SELECT 'Data Quality', CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END FROM {_DUPLICATES}",
]
sql(
    "c12_summary",
    """SELECT category, count(*) FILTER (status = 'PASS') AS PASS, count(*) FILTER (status = 'WARN') AS WARN,
      count(*) FILTER (status = 'FAIL') AS FAIL,
      round((count(*) - count(*) FILTER (status = 'FAIL')) * 100e0 / count(*), 1) AS success_pct FROM ("""
    + " UNION ALL ".join(_ALL)
    + ") GROUP BY 1",
    GOLD,
)

# --- collector events -------------------------------------------------------------------

_E = "body_id, position"
_EVENTS = {
    "e01_unpacked_events": "batch_size, CASE WHEN e % 17 <> 0 THEN 'E' || e END AS eventId",
    "e02_envelope_defaults": f"""coalesce(version, 'unknown') AS schemaVersion,
      CASE WHEN e % 17 = 0 THEN 'unknown-event-id' ELSE 'E' || e END AS eventId,
      CASE WHEN e % 19 = 0 THEN 'unknown-session' ELSE 'S' || user_id END AS playbackSessionId,
      CASE WHEN e % 11 <= 1 THEN 0 ELSE e END AS sequenceNumber, CASE WHEN e % 23 = 0 THEN {AS_OF_MS} ELSE ms END AS event_timestamp,
      CASE WHEN e % 7 = 0 THEN 0 ELSE k END AS elapsedMs, CASE WHEN e % 29 = 0 THEN 'UNKNOWN_EVENT' ELSE event_type END AS eventType""",
    "e03_identity_defaults": """CASE WHEN e % 9 <= 1 THEN 'unknown-tenant' ELSE 'T' || (user_id % 5) END AS tenantId,
      CASE WHEN e % 9 <= 1 THEN 'anonymous_user' ELSE 'U' || user_id END AS userId""",
    "e04_content_defaults": """CASE WHEN e % 8 <= 1 THEN 'unknown' ELSE 'm' || (e % 37) || '.m3u8' END AS manifestUrl,
      CASE WHEN e % 8 <= 1 THEN 0e0 ELSE k + 0.5e0 END AS durationSec""",
    "e05_environment_defaults": """CASE WHEN e % 6 <= 1 THEN 'hls.js' ELSE 'native' END AS playerType,
      CASE WHEN e % 6 <= 1 THEN 'unknown' ELSE '1.' || k END AS playerVersion,
      CASE WHEN e % 6 = 1 THEN '3.9' ELSE coalesce(version, 'unknown') END AS telemetryVersion,
      CASE WHEN e % 6 <= 1 THEN 'unknown' ELSE 'UA' || k END AS userAgent""",
    "e06_network_defaults": """CASE WHEN e % 10 > 1 THEN k * 1000 END AS estimatedBandwidthBps,
      CASE WHEN e % 10 > 1 THEN '4g' ELSE 'unknown' END AS connectionType,
      CASE WHEN e % 10 > 1 THEN k + 0.25e0 END AS downlinkMbps, CASE WHEN e % 10 > 1 THEN CAST(k AS DOUBLE) END AS rttMs,
      CASE WHEN e % 10 > 1 THEN 1 ELSE 0 END AS "trafficBreakdown_size",
      CASE WHEN e % 10 > 1 THEN 2 ELSE 0 END AS "qualityDistribution_size\"""",
    "e07_player_state_defaults": """CASE WHEN e % 12 > 1 THEN k + 0.5e0 ELSE 0e0 END AS currentTimeSec, e % 12 > 1 AS isPaused,
      e % 12 = 1 AS isMuted, CASE WHEN e % 12 > 1 THEN 0.5e0 ELSE 1e0 END AS volume""",
    "e08_playback_metric_defaults": """CASE WHEN e % 14 > 1 THEN k ELSE 0 END AS totalRebufferMs,
      CASE WHEN e % 14 > 1 THEN k % 3 ELSE 0 END AS stallCount, CASE WHEN e % 14 > 1 THEN 1 ELSE 0 END AS startupStallCount,
      CASE WHEN e % 14 > 1 THEN k + 0.5e0 ELSE 0e0 END AS watchTimeSec, CASE WHEN e % 14 > 1 THEN 0.25e0 ELSE 0e0 END AS rebufferRatio""",
}
for _name, _columns in _EVENTS.items():
    sql(_name, f"SELECT {_E}, {_columns} FROM ev", BODIES)
sql(
    "e09_quality_distribution",
    f"""SELECT {_E}, '640x360' AS resolution, k AS bytesDownloaded, 0 AS fragmentsLoaded, 0e0 AS byteSharePercent FROM ev WHERE e % 10 > 1
    UNION ALL SELECT {_E}, '1280x720', 0, 2, k + 0.5e0 FROM ev WHERE e % 10 > 1""",
    BODIES,
)
sql(
    "e10_flush_windows",
    _WINDOWS.format("1 HOUR", ", bool_or(eventType = 'ERROR' AND fatal) AS flushed_at_once"),
    SIGNALS,
)
_TRAFFIC = """(SELECT playbackSessionId, resolution, CAST(sum(bytes) AS BIGINT) AS bytesDownloaded, count(*) AS fragmentsLoaded
  FROM sig GROUP BY ALL)"""
sql("e11_traffic_by_resolution", f"SELECT * FROM {_TRAFFIC}", SIGNALS)
sql("e11_running_traffic", _RUNNING, SIGNALS)
sql(
    "e12_byte_share",
    f"""SELECT *, coalesce(round(CAST(bytesDownloaded AS DOUBLE)
      / nullif(CAST(sum(bytesDownloaded) OVER (PARTITION BY playbackSessionId) AS DOUBLE), 0) * 100e0, 2), 0e0) AS byteSharePercent
    FROM {_TRAFFIC}""",
    SIGNALS,
)
sql("e13_buffer_types", f"SELECT {SIGNAL}, start_type AS bufferType FROM paired WHERE eventType = 'BUFFER_START'", SIGNALS, TIMELINE)
sql(
    "e14_buffer_intervals",
    f"""SELECT {SIGNAL}, prev_start_type AS type, prev_ts AS start_ts, event_timestamp AS end_ts, durationMs
    FROM paired WHERE durationMs IS NOT NULL""",
    SIGNALS,
    TIMELINE,
)
sql("e15_cumulative_buffering", f"SELECT {SIGNAL}, totalRebufferMs, stallCount, startupStallCount FROM timeline", SIGNALS, TIMELINE)
_RATIO = "CASE WHEN watchTimeSec > 0 THEN round(CAST(totalRebufferMs AS DOUBLE) / (watchTimeSec * 1000e0), 4) ELSE 0e0 END AS rebufferRatio"
sql(
    "e16_playback_quality",
    f"SELECT {SIGNAL}, totalRebufferMs, stallCount, startupStallCount, watchTimeSec, {_RATIO} FROM timeline",
    SIGNALS,
    TIMELINE,
)
sql(
    "e17_time_to_first_frame",
    """SELECT playbackSessionId, min(event_timestamp) FILTER (eventType = 'PLAYBACK_START') - min(event_timestamp) AS timeToFirstFrameMs
    FROM sig GROUP BY 1""",
    SIGNALS,
)
sql("e18_quality_switches", "SELECT * EXCLUDE (droppedFramesDelta) FROM switches", SIGNALS, SWITCHES)
sql("e19_dropped_frames", f"SELECT {SIGNAL}, droppedFramesDelta FROM switches", SIGNALS, SWITCHES)
sql("e20_error_classes", "SELECT * FROM errs", SIGNALS, ERRORS)
sql("e21_error_summary", "SELECT * FROM err_summary", SIGNALS, ERRORS)
sql(
    "e21_error_totals",
    """SELECT playbackSessionId, window_start, count(*) AS distinctCodes, CAST(sum(error_count) AS BIGINT) AS totalCount
    FROM err_summary GROUP BY ALL""",
    SIGNALS,
    ERRORS,
)
sql(
    "e22_event_identity",
    f"""SELECT {SIGNAL}, playbackSessionId || '-' || event_timestamp || '-' || sequenceNumber AS eventId,
      event_timestamp - min(event_timestamp) OVER (PARTITION BY playbackSessionId) AS elapsedMs FROM sig""",
    SIGNALS,
)
sql(
    "e23_user_agent",
    f"SELECT {SIGNAL}, CASE WHEN length(userAgent) > 180 THEN left(userAgent, 180) || '...' ELSE userAgent END AS userAgent FROM sig",
    SIGNALS,
)
sql(
    "e24_session_targets",
    f"""SELECT *, rebufferRatio < 0.05 AS meets_ratio, stallCount < 2 AS meets_stalls FROM (SELECT *, {_RATIO} FROM (
      SELECT playbackSessionId, max(totalRebufferMs) AS totalRebufferMs, max(stallCount) AS stallCount,
        max(watchTimeSec) AS watchTimeSec FROM timeline GROUP BY 1))""",
    SIGNALS,
    TIMELINE,
)
sql("e25_type_counts", "SELECT tenantId, playbackSessionId, eventType, count(*) AS event_count FROM sig GROUP BY ALL", SIGNALS)
sql(
    "e26_network_context",
    f"""SELECT {SIGNAL}, nullif(CAST(round(bandwidthEstimate) AS BIGINT), 0) AS estimatedBandwidthBps,
      coalesce(nullif(effectiveType, ''), 'unknown') AS connectionType, downlink AS downlinkMbps, rtt AS rttMs FROM sig""",
    SIGNALS,
)

# --- triggered runs ---------------------------------------------------------------------

sql(
    "s01_landed_bronze",
    """SELECT customerId, contentId, clientId, timestamp_server, timestamp_agent, buffering_count, buffering_time_ms,
      total_source_data // 1000 AS total_source_requests, total_source_data, total_p2p_data // 1000 AS total_p2p_requests,
      total_p2p_data, eventDate FROM report""",
)
_BY_CDN = "SELECT eventDate, CASE WHEN eid % 3 = 1 THEN 'edge' END AS cdn, count(*) AS row_count FROM report GROUP BY ALL"
sql("s03_added_column", _BY_CDN)
sql("s03_ledger_read", _BY_CDN)
sql("s04_stream_rescued", "SELECT eventDate, rescued AS _rescued_data FROM report WHERE rescued IS NOT NULL")
_FAULTS = f"""SELECT {KEY}, contentId, timestamp_agent, buffering_count, buffering_time_ms, total_source_requests,
  total_source_data, total_p2p_requests, total_p2p_data, quality_source_requests, quality_source_data,
  quality_p2p_requests, quality_p2p_data, buffering_time_sec, quarantine_reason FROM quarantine"""
sql("s05_stream_from_table", _FAULTS)
sql("t01_stream_silver", f"SELECT {SILVER} FROM silver")
sql("t02_stream_quarantine", _FAULTS)
sql("t04_rows_by_batch", "SELECT eid % 3 AS ingest_batch, count(*) AS row_count FROM silver GROUP BY 1")
sql("t05_late_gold", "SELECT * FROM gold", GOLD)
sql(
    "t09_running_sessions",
    """SELECT playbackSessionId, max(sequenceNumber) AS lastSequence, max(totalRebufferMs) AS totalRebufferMs,
      max(stallCount) AS stallCount, max(startupStallCount) AS startupStallCount, count(*) AS signal_count
    FROM timeline GROUP BY 1""",
    SIGNALS,
    TIMELINE,
)
sql("m07_compacted", f"SELECT {SILVER} FROM silver")
_PER_BATCH = "SELECT '{0}' AS layer, eid % 3 AS version, count(*) AS rows_out FROM {0} GROUP BY 2"
sql(
    "m08_change_history",
    f"""SELECT layer, version, 'WRITE' AS operation, 0 AS rows_updated, 0 AS rows_inserted, rows_out FROM (
      {_PER_BATCH.format('silver')} UNION ALL {_PER_BATCH.format('quarantine')} UNION ALL
      SELECT 'gold', d.portion, count(DISTINCT customerId || '|' || clientId || '|' || s.eventDate)
      FROM (SELECT DISTINCT eid % 3 AS portion, eventDate FROM exploded) d JOIN silver s ON s.eventDate = d.eventDate AND s.eid % 3 <= d.portion
      GROUP BY 2)""",
)
sql("m11_archived", f"SELECT {KEY}, quarantine_reason FROM quarantine q WHERE EXISTS {_DONE}", REPAIR)
sql("m12_left_in_quarantine", f"SELECT {KEY}, quarantine_reason FROM quarantine q WHERE NOT EXISTS {_DONE}", REPAIR)
sql("r33_run_history", "SELECT 'COMPLETED' AS state, '✓' AS status_icon, 4 AS runs")
sql(
    "a06_merged_sketches",
    "SELECT customerId, count(DISTINCT contentId || '|' || timestamp_server) AS exact, true AS is_near FROM silver GROUP BY 1",
)


def flushes(ms: int) -> str:
    """CTE of the signals with the batch that each is sent in."""
    return f"""
fl AS (
  SELECT *, began + tick * {ms} AS flush_start, CAST(coalesce(sum(CASE WHEN eventType = 'ERROR' AND fatal THEN 1 ELSE 0 END)
      OVER (PARTITION BY playbackSessionId, tick ORDER BY event_timestamp, sequenceNumber
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS flush_part
  FROM (SELECT *, (event_timestamp - began) // {ms} AS tick FROM (
    SELECT *, min(event_timestamp) OVER (PARTITION BY playbackSessionId) AS began FROM sig))
),
fl_errors AS (
  SELECT playbackSessionId, flush_start, flush_part, e.code || '|' || e.message AS error_key, count(*) AS error_count,
    min(e.event_timestamp) AS firstSeenTs, max(e.event_timestamp) AS lastSeenTs
  FROM errs e JOIN fl USING (playbackSessionId, sequenceNumber) WHERE NOT e.fatal GROUP BY ALL
)"""


_TEN, _SIX = flushes(10_000), flushes(6 * 60 * 60 * 1000)
_FLUSH = "playbackSessionId, flush_start, flush_part"
_BATCHES = f"""SELECT {_FLUSH}, count(*) AS event_count, bool_or(eventType = 'ERROR' AND fatal) AS sent_at_once
  FROM fl GROUP BY ALL"""
_TOTALS = f"SELECT {_FLUSH}, count(*) AS distinctCodes, CAST(sum(error_count) AS BIGINT) AS totalCount FROM fl_errors GROUP BY ALL"
_POSTED = "eventType NOT IN ('SEEKING', 'SEEKED') AND NOT (eventType = 'ERROR' AND NOT fatal)"
sql("e10_flushes", _BATCHES, SIGNALS, ERRORS, _TEN)
sql("e10_flushes_six_hours", _BATCHES, SIGNALS, ERRORS, _SIX)
sql("e21_flush_summaries", "SELECT * FROM fl_errors", SIGNALS, ERRORS, _TEN)
sql("e21_flush_summaries_six_hours", "SELECT * FROM fl_errors", SIGNALS, ERRORS, _SIX)
sql("e21_flush_totals", _TOTALS, SIGNALS, ERRORS, _TEN)
sql("e13_posted_buffer_types", f"SELECT {SIGNAL}, start_type AS bufferType FROM paired WHERE eventType = 'BUFFER_START'", SIGNALS, TIMELINE)
sql(
    "e14_posted_buffer_intervals",
    f"""SELECT {SIGNAL}, prev_start_type AS type, prev_ts AS start_ts, event_timestamp AS end_ts, durationMs
    FROM paired WHERE durationMs IS NOT NULL""",
    SIGNALS,
    TIMELINE,
)
sql(
    "e16_posted_quality",
    f"SELECT {SIGNAL}, totalRebufferMs, stallCount, startupStallCount, watchTimeSec, {_RATIO} FROM timeline WHERE {_POSTED}",
    SIGNALS,
    TIMELINE,
)
sql(
    "e17_posted_first_frame",
    """SELECT playbackSessionId, min(event_timestamp) FILTER (eventType = 'PLAYBACK_START') - min(event_timestamp) AS timeToFirstFrameMs
    FROM sig GROUP BY 1 HAVING timeToFirstFrameMs IS NOT NULL""",
    SIGNALS,
)
sql("e18_posted_switches", "SELECT * FROM switches", SIGNALS, SWITCHES)
sql("e20_posted_errors", "SELECT * FROM errs WHERE fatal", SIGNALS, ERRORS)
sql("e21_posted_summaries", "SELECT playbackSessionId, error_key, error_count, firstSeenTs, lastSeenTs FROM fl_errors", SIGNALS, ERRORS, _TEN)
sql("e21_posted_totals", f"SELECT playbackSessionId, distinctCodes, totalCount FROM ({_TOTALS})", SIGNALS, ERRORS, _TEN)
sql(
    "e23_posted_user_agents",
    f"""SELECT {SIGNAL}, CASE WHEN length(userAgent) > 180 THEN left(userAgent, 180) || '...' ELSE userAgent END AS userAgent
    FROM sig WHERE {_POSTED}""",
    SIGNALS,
)
sql(
    "e25_posted_type_counts",
    f"SELECT tenantId, playbackSessionId, eventType, count(*) AS event_count FROM sig WHERE {_POSTED} GROUP BY ALL",
    SIGNALS,
)
sql(
    "e26_posted_network",
    f"""SELECT {SIGNAL}, nullif(CAST(round(bandwidthEstimate) AS BIGINT), 0) AS estimatedBandwidthBps,
      coalesce(nullif(effectiveType, ''), 'unknown') AS connectionType, downlink AS downlinkMbps, rtt AS rttMs FROM sig WHERE {_POSTED}""",
    SIGNALS,
)

# --- sinks, catalog tables and confirmed jobs -------------------------------------------

_DAYS = "SELECT eventDate, count(*) AS row_count, CAST(sum(total_source_data) AS BIGINT) AS bytes FROM silver GROUP BY 1"
sql("s07_partitioned_sink", "SELECT eventDate, quarantine_reason, count(*) AS row_count, true AS in_place FROM quarantine GROUP BY ALL")
sql("s08_clustered_sink", "SELECT eventDate, count(*) AS row_count, true AS is_clustered FROM silver GROUP BY 1")
for _name in ("s10_backup_copy", "s11_create_like", "s13_temporary_view"):
    sql(_name, _DAYS)
sql(
    "s15_listed_tables",
    """SELECT unnest(['silver_backup_20240131_000000', 'silver_like', 'silver_documented']) AS tableName, n AS row_count
    FROM (SELECT count(*) AS n FROM silver)""",
)
sql(
    "s15_described_columns",
    " UNION ALL ".join(
        f"""SELECT '{f.name}' AS col_name, '{f.dataType.simpleString()}' AS data_type, '{f.metadata['comment']}' AS comment,
      count(*) FILTER ({f.name} IS NULL) AS null_count FROM silver"""
        for f in schemas.SILVER
    ),
)
sql(
    "s16_table_properties",
    f"""SELECT 'quality' AS key, 'silver' AS value, count(*) AS row_count FROM silver
    UNION ALL SELECT 'as_of', '{AS_OF}', NULL""",
)
sql("m14_reprocessed_silver", f"SELECT {SILVER} FROM merged", REPAIR)
sql("m14_reprocessed_gold", "SELECT * FROM regold", REPAIR, gold_over("merged", "regold"))
sql("t03_full_refresh", f"SELECT {SILVER} FROM silver")


def _fixed_check(name: str, message: str) -> str:
    return f"""SELECT '{name}' AS "check", 'Schema Validation' AS category, 'PASS' AS status, '{message}' AS message, 0e0 AS value"""


sql("c02_tables_exist", _fixed_check("Table Existence Check", "All 4 tables exist"))
sql("c03_bronze_schema", _fixed_check("Bronze Layer Schema Validation", "Bronze schema valid with 9 columns"))
sql("c04_silver_schema", _fixed_check("Silver Layer Schema Validation", "Silver schema valid with 18 columns"))
sql(
    "r37_poor_customers",
    f"""SELECT count(*) AS customers, count(*) FILTER (score < 40) AS poor_customers,
      {pct('poor_customers', 'customers')} AS poor_pct, {tier('poor_pct', 10)} AS status
    FROM (SELECT customerId, {xavg('qos_score')} AS score FROM gold WHERE {since(7)} GROUP BY 1)""",
    GOLD,
)
