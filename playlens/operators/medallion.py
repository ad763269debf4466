"""The table transforms: raw reports to quality rows, faulty rows and viewer scores.

Silver and quarantine are narrow (project, generate, filter) and run without a shuffle, so
the same functions serve batch frames and streams.  Gold is one partial-and-final aggregate
on (customerId, clientId, eventDate): the map side folds a hot viewer before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import first_match, ms_to_seconds, to_megabytes
from .expectations import SILVER_RULES, enforce, enforce_not_null

_FLAT = {
    "customerId": "customerId",
    "contentId": "contentId",
    "clientId": "clientId",
    "timestamp_server": "timestampInfo.server",
    "timestamp_agent": "timestampInfo.agent",
    "buffering_count": "player.bufferings",
    "buffering_time_ms": "player.bufferingTime",
    "total_source_requests": "totalDistribution.sourceTraffic.requests",
    "total_source_data": "totalDistribution.sourceTraffic.receivedData",
    "total_p2p_requests": "totalDistribution.p2pTraffic.requests",
    "total_p2p_data": "totalDistribution.p2pTraffic.receivedData",
    "qualityDistribution": "qualityDistribution",
    "eventDate": "eventDate",
}
_LEVEL = {
    "quality_source_requests": "quality_metrics.sourceTraffic.requests",
    "quality_source_data": "quality_metrics.sourceTraffic.receivedData",
    "quality_p2p_requests": "quality_metrics.p2pTraffic.requests",
    "quality_p2p_data": "quality_metrics.p2pTraffic.receivedData",
}


def flatten(bronze: DataFrame) -> DataFrame:
    """Session report as 13 flat columns, the rendition map still whole."""
    return bronze.select(*[F.col(path).alias(name) for name, path in _FLAT.items()])


def explode_levels(flat: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per rendition.  Reports with an empty or NULL map vanish unless kept."""
    generate = F.explode_outer if keep_empty else F.explode
    return flat.select("*", generate("qualityDistribution").alias("quality_level", "quality_metrics"))


def level_columns(exploded: DataFrame) -> DataFrame:
    """Second-level flatten of the rendition metrics, and seconds of buffering."""
    return exploded.withColumns(
        {name: F.col(path) for name, path in _LEVEL.items()}
        | {"buffering_time_sec": ms_to_seconds("buffering_time_ms")}
    )


def quality_rows(bronze: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Everything silver and quarantine have in common; compute it once to feed both."""
    return level_columns(explode_levels(flatten(bronze), keep_empty))


def silver_candidates(rows: DataFrame) -> DataFrame:
    """The 18 silver columns, before any rule is applied."""
    return rows.withColumns(
        {
            "quality_data_mb": to_megabytes("quality_source_data", "quality_p2p_data"),
            "total_data_mb": to_megabytes("total_source_data", "total_p2p_data"),
        }
    ).select(*schemas.SILVER.names)


def silver_from_rows(rows: DataFrame, not_null: str | None = "fail") -> DataFrame:
    kept = enforce(silver_candidates(rows), SILVER_RULES)
    return enforce_not_null(kept, schemas.REQUIRED_SILVER, not_null) if not_null else kept


def silver_enriched(bronze: DataFrame, not_null: str | None = "fail", keep_empty: bool = False) -> DataFrame:
    """Clean quality-level rows.

    ``not_null`` decides about rows that pass the rules but miss a required column: ``fail``
    stops the job as a NOT NULL column would, ``drop`` leaves them out, None skips the check.
    """
    return silver_from_rows(quality_rows(bronze, keep_empty), not_null)


def fault_conditions() -> list[tuple[str, Column]]:
    """Reasons in priority order with the condition that raises each."""
    # Reason names and the one-hour limit.
    return [
        ("negative_buffering_count", F.col("buffering_count") < 0),
        ("negative_buffering_time", F.col("buffering_time_ms") < 0),
        ("negative_source_data", F.col("total_source_data") < 0),
        ("negative_p2p_data", F.col("total_p2p_data") < 0),
        ("null_quality_level", F.col("quality_level").isNull()),
        ("excessive_buffering", F.col("buffering_time_sec") > 3600),
    ]


def is_faulty() -> Column:
    return reduce(lambda a, b: a | b, [condition for _, condition in fault_conditions()])


def quarantine_reason() -> Column:
    return first_match([(condition, name) for name, condition in fault_conditions()], "other")


def quarantine_reasons() -> Column:
    """Every violated rule, not only the first."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in fault_conditions()]))


def quarantine_from_rows(rows: DataFrame, stamp: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if stamp is None else stamp
    return rows.filter(is_faulty()).select(
        *_FLAT,
        stamp.alias("quarantine_timestamp"),
        "quality_level",
        "quality_metrics",
        *_LEVEL,
        "buffering_time_sec",
        quarantine_reason().alias("quarantine_reason"),
    )


def quarantine(bronze: DataFrame, stamp: Column | None = None, keep_empty: bool = False) -> DataFrame:
    """Faulty quality-level rows with the first reason that applies."""
    return quarantine_from_rows(quality_rows(bronze, keep_empty), stamp)


def routing(bronze: DataFrame) -> DataFrame:
    """How many quality rows reach silver, quarantine, both or neither."""
    rows = silver_candidates(quality_rows(bronze))
    keep = F.lit(True)
    for rule in SILVER_RULES:
        keep = keep & rule.passes if rule.policy == "drop" else keep
    for name in schemas.REQUIRED_SILVER:
        keep = keep & F.col(name).isNotNull()
    flags = rows.select(keep.alias("to_silver"), F.coalesce(is_faulty(), F.lit(False)).alias("to_quarantine"))
    route = first_match(
        [
            (F.col("to_silver") & F.col("to_quarantine"), "both"),
            (F.col("to_silver"), "silver_only"),
            (F.col("to_quarantine"), "quarantine_only"),
        ],
        "neither",
    )
    return flags.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("row_count"))


# --- gold -------------------------------------------------------------------------------


def source_share(source: Column, p2p: Column) -> Column:
    total = source + p2p
    return F.when(total > 0, source / total * 100).otherwise(F.lit(0.0))


def buffering_ratio(seconds: Column, megabytes: Column) -> Column:
    """Seconds of buffering against twice the megabytes, in percent."""
    return F.when(megabytes > 0, seconds / (megabytes * 2) * 100).otherwise(F.lit(0.0))


def qos_score(seconds: Column, events: Column) -> Column:
    """100 less a point per ten seconds and two per interruption, never below 0."""
    return F.greatest(F.lit(0.0), F.lit(100.0) - seconds / 10 - events * 2)


def qos_category(score: Column) -> Column:
    # Tier names and bounds.
    return first_match([(score >= 80, "Excellent"), (score >= 60, "Good"), (score >= 40, "Fair")], "Poor")


def viewer_totals(silver: DataFrame, distinct: str = "approx") -> DataFrame:
    """The nine daily aggregates per viewer.

    Sums run over whole numbers (milliseconds, bytes) and are scaled once at the end, so
    the result does not depend on the order in which partial sums meet.
    """
    contents = F.approx_count_distinct("contentId") if distinct == "approx" else F.count_distinct("contentId")
    ms, n_ms = F.sum("buffering_time_ms"), F.count("buffering_time_ms")
    return silver.groupBy(*schemas.GOLD_KEY).agg(
        F.sum("buffering_count").alias("total_buffering_events"),
        (ms / F.lit(1000.0)).alias("total_buffering_time_sec"),
        F.avg("buffering_count").alias("avg_buffering_per_session"),
        (ms / F.lit(1000.0) / n_ms).alias("avg_buffering_time_sec"),
        to_megabytes(F.sum(F.col("total_source_data") + F.col("total_p2p_data"))).alias("total_data_consumed_mb"),
        F.sum("total_source_data").alias("total_source_data_bytes"),
        F.sum("total_p2p_data").alias("total_p2p_data_bytes"),
        contents.alias("unique_content_count"),
        F.count(F.lit(1)).alias("total_sessions"),
    )


def distinct_sketches(silver: DataFrame, values: dict[str, Column], log_k: int = 12) -> DataFrame:
    """A HyperLogLog sketch per viewer, day and value, to be kept beside gold.

    Sketches of days merge (``merged_distincts``), so a distinct count over any days, viewers or
    customers needs no second look at silver, and an incremental refresh replaces the days it
    recomputes.  The standard error is 1.04 / sqrt(2 ** log_k), 1.6 % by default."""
    return silver.groupBy(*schemas.GOLD_KEY).agg(*[F.hll_sketch_agg(v, log_k).alias(name) for name, v in values.items()])


def merged_distincts(sketches: DataFrame, names: list[str], *by: str) -> DataFrame:
    """Estimated distinct counts of the union of all sketches of each group."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names])


def score(totals: DataFrame) -> DataFrame:
    scored = totals.withColumns(
        {
            "source_traffic_percentage": source_share(
                F.col("total_source_data_bytes"), F.col("total_p2p_data_bytes")
            ),
            "buffering_ratio_percentage": buffering_ratio(
                F.col("total_buffering_time_sec"), F.col("total_data_consumed_mb")
            ),
            "qos_score": qos_score(F.col("total_buffering_time_sec"), F.col("total_buffering_events")),
        }
    )
    return scored.withColumn("qos_category", qos_category(F.col("qos_score")))


def gold_viewer_qos(silver: DataFrame, distinct: str = "approx") -> DataFrame:
    """Daily viewer quality.  ``distinct='exact'`` counts videos exactly, at one more shuffle."""
    return score(viewer_totals(silver, distinct))


def gold_viewer_qos_session_grain(silver: DataFrame, distinct: str = "exact") -> DataFrame:
    """As gold, but each playback report counts once whatever its number of renditions."""
    facts = ["buffering_count", "buffering_time_ms", "total_source_data", "total_p2p_data"]
    sessions = silver.select(*schemas.SESSION_KEY, *facts).distinct()
    return gold_viewer_qos(sessions, distinct)
