"""Monitoring reports: freshness, rates, distributions, retention and counts per layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import (
    GB,
    days_before,
    epoch_ms_to_timestamp,
    exact_avg,
    exact_sum,
    first_match,
    minutes_since,
    on_or_after,
    percent,
    rank_of,
    ratio,
    tier,
)
from ..operators.combine import labelled, share_of_total, side_by_side, stack
from .alerts import daily_counts, row_total

CATEGORIES = ["Excellent", "Good", "Fair", "Poor"]


@dataclass(frozen=True)
class Thresholds:
    """Limits of the monitoring reports.  Fixed values."""

    lag_warning_minutes: int = 60
    lag_critical_minutes: int = 120
    quarantine_warning_pct: float = 5.0
    quarantine_critical_pct: float = 10.0
    poor_score: float = 40.0
    poor_customers_pct: float = 10.0
    storage_growth_gb_per_day: float = 100.0


def _freshness(df: DataFrame, layer: str, server: str, extra: Column, as_of: str, as_of_ts: str, t: Thresholds):
    seen = df.filter(on_or_after(as_of, 7)).agg(
        F.max(server).alias("last_ms"), row_total("total_records"), extra
    )
    lag = minutes_since("last_ms", as_of_ts)
    status = first_match(
        [
            (F.col("lag_minutes") < t.lag_warning_minutes, "✓ Fresh"),
            (F.col("lag_minutes") < t.lag_critical_minutes, "⚠ Warning"),
        ],
        "✗ Critical Lag",
    )
    rest = [c for c in seen.columns if c != "last_ms"]
    shown = seen.select(epoch_ms_to_timestamp("last_ms").alias("latest_server_time"), lag.alias("lag_minutes"), *rest)
    return labelled(shown.withColumn("status", status), layer)


def bronze_freshness(bronze: DataFrame, as_of: str, as_of_ts: str, t: Thresholds = Thresholds()) -> DataFrame:
    dates = F.count_distinct("eventDate").alias("date_partitions")
    return _freshness(bronze, "bronze_telemetry_raw", "timestampInfo.server", dates, as_of, as_of_ts, t)


def silver_freshness(silver: DataFrame, as_of: str, as_of_ts: str, t: Thresholds = Thresholds()) -> DataFrame:
    customers = F.count_distinct("customerId").alias("unique_customers")
    return _freshness(silver, "silver_telemetry_enriched", "timestamp_server", customers, as_of, as_of_ts, t)


def gold_freshness(gold: DataFrame, as_of: str) -> DataFrame:
    seen = gold.filter(on_or_after(as_of, 7)).agg(
        F.max("eventDate").alias("latest_date"),
        F.count_distinct("customerId").alias("unique_customers"),
        F.count_distinct("clientId").alias("unique_clients"),
        F.sum("total_sessions").alias("total_sessions_aggregated"),
    )
    behind = F.datediff(F.lit(as_of).cast("date"), "latest_date")
    status = first_match([(behind == 0, "✓ Current"), (behind == 1, "⚠ 1 Day Behind")], "✗ Stale")
    return labelled(seen.withColumns({"days_behind": behind, "status": status}), "gold_viewer_qos_metrics")


def daily_quarantine_rate(
    bronze: DataFrame, quarantine: DataFrame, as_of: str, t: Thresholds = Thresholds()
) -> DataFrame:
    """Inner join of two daily aggregates, one row per date each."""
    faulty = (
        quarantine.filter(on_or_after(as_of, 7))
        .groupBy("eventDate")
        .agg(row_total("quarantine_count"), F.count_distinct("customerId").alias("affected_customers"))
    )
    total = daily_counts(bronze.filter(on_or_after(as_of, 7)), "total_records")
    rate = percent("quarantine_count", "total_records")
    status = first_match(
        [(rate < t.quarantine_warning_pct, "✓ Normal"), (rate < t.quarantine_critical_pct, "⚠ Warning")], "✗ Critical"
    )
    return (
        faulty.join(total, "eventDate")
        .select(
            "eventDate",
            "quarantine_count",
            "total_records",
            F.round(rate, 2).alias("quarantine_rate_pct"),
            "affected_customers",
            status.alias("status"),
        )
        .orderBy(F.col("eventDate").desc())
    )


def quarantine_breakdown(quarantine: DataFrame, as_of: str) -> DataFrame:
    grouped = (
        quarantine.filter(on_or_after(as_of, 7))
        .groupBy("quarantine_reason")
        .agg(
            row_total("failure_count"),
            F.count_distinct("customerId").alias("affected_customers"),
            F.min("eventDate").alias("first_seen"),
            F.max("eventDate").alias("last_seen"),
        )
    )
    share = F.round(share_of_total(grouped, "failure_count"), 2)
    return grouped.withColumn("pct_of_total", share).orderBy(F.col("failure_count").desc(), "quarantine_reason")


def category_distribution(gold: DataFrame, as_of: str, high: float = 10, elevated: float = 5) -> DataFrame:
    """Customers and averages per tier, with an alert on the share of Poor."""
    grouped = (
        gold.filter(on_or_after(as_of, 7))
        .groupBy("qos_category")
        .agg(
            F.count_distinct("customerId").alias("customer_count"),
            F.round(exact_avg("qos_score"), 2).alias("avg_score"),
            F.round(exact_avg("total_buffering_time_sec"), 2).alias("avg_buffering_sec"),
            F.round(exact_avg("total_data_consumed_mb"), 2).alias("avg_data_mb"),
        )
    )
    shared = grouped.withColumn("_share", share_of_total(grouped, "customer_count"))
    poor = F.col("qos_category") == "Poor"
    status = first_match(
        [
            (poor & (F.col("_share") > high), "✗ High Poor QoS"),
            (poor & (F.col("_share") > elevated), "⚠ Elevated Poor QoS"),
        ],
        "✓ OK",
    )
    return (
        shared.withColumns({"pct_customers": F.round("_share", 2), "alert_status": status})
        .drop("_share")
        .orderBy(rank_of("qos_category", CATEGORIES))
    )


def customer_trend(gold: DataFrame, as_of: str, min_change: float = 5, limit: int = 100) -> DataFrame:
    """Customers whose score of the last three days moved against the days before."""
    daily = (
        gold.filter(on_or_after(as_of, 7))
        .groupBy("customerId", "eventDate")
        .agg(exact_avg("qos_score").alias("score"), exact_sum("total_buffering_time_sec").alias("seconds"))
    )
    recent = F.col("eventDate") >= days_before(as_of, 3)
    trend = daily.groupBy("customerId").agg(
        exact_avg(F.when(recent, F.col("score"))).alias("now"),
        exact_avg(F.when(~recent, F.col("score"))).alias("before"),
        exact_sum(F.when(recent, F.col("seconds"))).alias("recent_seconds"),
    )
    trend = trend.filter(F.col("now").isNotNull() & F.col("before").isNotNull())
    change = F.col("now") - F.col("before")
    # Bounds and labels of the trend.
    status = first_match(
        [(change < -20, "✗ Severe Degradation"), (change < -10, "⚠ Moderate Degradation"), (change > 10, "✓ Improvement")],
        "→ Stable",
    )
    return (
        trend.filter(F.abs(change) > min_change)
        .select(
            "customerId",
            F.round("before", 2).alias("baseline_qos_score"),
            F.round("now", 2).alias("recent_qos_score"),
            F.round(change, 2).alias("qos_change"),
            F.round(ratio(change, "before") * 100, 2).alias("qos_change_pct"),
            F.round("recent_seconds", 2).alias("recent_buffering_sec"),
            status.alias("trend_status"),
        )
        .orderBy("qos_change", "customerId")
        .limit(limit)
    )


def daily_ingest(bronze: DataFrame, as_of: str) -> DataFrame:
    """Volume per day, summed over nested fields."""
    received = F.sum("totalDistribution.sourceTraffic.receivedData") + F.sum("totalDistribution.p2pTraffic.receivedData")
    return (
        bronze.filter(on_or_after(as_of, 7))
        .groupBy("eventDate")
        .agg(
            row_total("records_ingested"),
            F.count_distinct("customerId").alias("unique_customers"),
            F.count_distinct("contentId").alias("unique_content"),
            F.round(F.sum("player.bufferingTime") / F.lit(1000.0), 2).alias("total_buffering_sec"),
            F.round(received / F.lit(GB), 2).alias("total_data_gb"),
        )
        .orderBy(F.col("eventDate").desc())
    )


# --- per layer --------------------------------------------------------------------------


def _spans(layers: dict[str, DataFrame]) -> DataFrame:
    parts = [
        labelled(
            df.agg(
                F.min("eventDate").alias("oldest"),
                F.max("eventDate").alias("newest"),
                F.count_distinct("eventDate").alias("dates"),
                row_total("rows"),
            ),
            name,
        )
        for name, df in layers.items()
    ]
    return stack(*parts)


def retention_status(layers: dict[str, DataFrame]) -> DataFrame:
    """Oldest and newest date, span in days and rows per table."""
    return (
        _spans(layers)
        .select(
            F.col("layer").alias("table_name"),
            F.col("oldest").alias("oldest_record"),
            F.col("newest").alias("newest_record"),
            F.datediff("newest", "oldest").alias("data_span_days"),
            F.col("rows").alias("record_count"),
        )
        .orderBy("table_name")
    )


def layer_dates(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Date range of silver and gold, and a row with the days gold is behind."""
    spans = _spans({"Silver Enriched": silver, "Gold Metrics": gold})
    ranges = spans.select(
        "layer",
        F.col("oldest").alias("earliest_date"),
        F.col("newest").alias("latest_date"),
        F.col("dates").alias("distinct_dates"),
        F.col("rows").alias("record_count"),
    )
    last = lambda layer: F.max(F.when(F.col("layer") == layer, F.col("newest")))
    gap = spans.agg(last("Silver Enriched").alias("s"), last("Gold Metrics").alias("g")).select(
        F.lit("⚠️ Date Gap").alias("layer"),
        F.when(F.col("g") < F.col("s"), F.datediff("s", "g")).otherwise(F.lit(0)).cast("bigint").alias("record_count"),
    )
    return stack(ranges, gap)


def record_counts(layers: dict[str, DataFrame]) -> DataFrame:
    return stack(*[labelled(df.agg(row_total("record_count")), name) for name, df in layers.items()])


def days_behind(layers: dict[str, DataFrame], as_of: str) -> DataFrame:
    parts = [labelled(df.agg(F.max("eventDate").alias("latest_date")), name) for name, df in layers.items()]
    return stack(*parts).withColumn("days_behind", F.datediff(F.lit(as_of).cast("date"), "latest_date"))


def explosion_ratio(bronze: DataFrame, silver: DataFrame, low: float = 2.0, high: float = 3.0) -> DataFrame:
    counts = side_by_side(bronze.agg(row_total("bronze_count")), silver.agg(row_total("silver_count")))
    rated = counts.withColumn("explosion_ratio", ratio("silver_count", "bronze_count"))
    inside = F.col("explosion_ratio").between(low, high)
    return rated.withColumn("status", F.when(inside, "OK").otherwise("OUT_OF_RANGE"))


def pass_rate(silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Share of silver rows among silver and quarantined rows."""
    counts = side_by_side(silver.agg(row_total("silver_count")), quarantine.agg(row_total("quarantine_count")))
    whole = F.col("silver_count") + F.col("quarantine_count")
    return counts.withColumn("pass_rate_pct", percent("silver_count", whole))


def poor_viewers(gold: DataFrame, limit: float = 25) -> DataFrame:
    counts = gold.agg(row_total("viewer_days"), F.count_if(F.col("qos_category") == "Poor").alias("poor_viewer_days"))
    rated = counts.withColumn("poor_rate_pct", percent("poor_viewer_days", "viewer_days"))
    return rated.withColumn("status", tier(F.col("poor_rate_pct"), limit))


def poor_customers(gold: DataFrame, as_of: str, t: Thresholds = Thresholds()) -> DataFrame:
    """Share of the week's customers whose mean score is below the threshold.

    Customers without a score count as customers only.  Scores fold per customer first, over whole millionths."""
    per_customer = gold.filter(on_or_after(as_of, 7)).groupBy("customerId").agg(exact_avg("qos_score").alias("score"))
    counts = per_customer.agg(row_total("customers"), F.count_if(F.col("score") < t.poor_score).alias("poor_customers"))
    rated = counts.withColumn("poor_pct", percent("poor_customers", "customers"))
    return rated.withColumn("status", tier(F.col("poor_pct"), t.poor_customers_pct))
