"""Alert reports.  Every report takes frames, an explicit "now" and its thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import (
    epoch_ms_to_timestamp,
    exact_avg,
    first_match,
    hours_since,
    on_day,
    on_or_after,
    percent,
    rank_of,
    ratio,
    tier,
)
from ..operators.combine import labelled, side_by_side, stack

# Severity of each alert.
SEVERITY = {
    "BRONZE_DATA_FRESHNESS": "CRITICAL",
    "HIGH_QUARANTINE_RATE": "HIGH",
    "DATA_VOLUME_ANOMALY": "HIGH",
    "BUFFERING_DEGRADATION": "MEDIUM",
    "GOLD_LAYER_LAG": "MEDIUM",
    "QUARANTINE_REASON_SPIKE": "MEDIUM",
}


def row_total(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def bronze_freshness(bronze: DataFrame, as_of: str, as_of_ts: str, alert_hours: float = 2) -> DataFrame:
    """Hours since the last event of the last seven days."""
    seen = bronze.filter(on_or_after(as_of, 7)).agg(
        F.max("timestampInfo.server").alias("last_ms"), row_total("total_records")
    )
    age = seen.select(
        epoch_ms_to_timestamp("last_ms").alias("last_event_timestamp"),
        hours_since("last_ms", as_of_ts).alias("hours_since_last_event"),
        "total_records",
    )
    with_status = age.withColumn("status", tier(F.col("hours_since_last_event"), alert_hours))
    return labelled(with_status, "BRONZE_DATA_FRESHNESS", "alert_name")


def quarantine_rate(
    bronze: DataFrame, quarantine: DataFrame, as_of: str, days: int = 1, alert: float = 5, warning: float = 3
) -> DataFrame:
    """Quarantined rows in percent of reports, over the last day."""
    counts = side_by_side(
        bronze.filter(on_or_after(as_of, days)).agg(row_total("bronze_count")),
        quarantine.filter(on_or_after(as_of, days)).agg(row_total("quarantine_count")),
    )
    rated = counts.withColumn("quarantine_rate_pct", F.round(percent("quarantine_count", "bronze_count"), 2))
    with_status = rated.withColumn("status", tier(F.col("quarantine_rate_pct"), alert, warning))
    return labelled(with_status, "HIGH_QUARANTINE_RATE", "alert_name")


def daily_counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("eventDate").agg(row_total(name))


def volume_anomaly(bronze: DataFrame, as_of: str, alert: float = 50, warning: float = 70) -> DataFrame:
    """Today's volume in percent of the mean of the seven days before; one scan for both."""
    daily = daily_counts(bronze.filter(on_or_after(as_of, 7) & (F.col("eventDate") <= F.lit(as_of).cast("date"))), "n")
    earlier = F.when(~on_day(as_of), F.col("n"))
    both = daily.agg(
        F.avg(earlier).alias("baseline"),
        F.coalesce(F.sum(F.when(on_day(as_of), F.col("n"))), F.lit(0)).alias("today_volume"),
    )
    rated = both.select(
        F.round("baseline", 0).alias("avg_daily_baseline"),
        "today_volume",
        F.round(percent("today_volume", "baseline"), 2).alias("pct_of_baseline"),
    )
    with_status = rated.withColumn("status", tier(F.col("pct_of_baseline"), alert, warning, below=True))
    return labelled(with_status, "DATA_VOLUME_ANOMALY", "alert_name")


def buffering_degradation(
    silver: DataFrame,
    as_of: str,
    alert: tuple[float, float] = (10, 15),
    warning: tuple[float, float] = (7, 10),
) -> DataFrame:
    """Mean buffering and share of rows with buffering, today.

    As in the original the share puts quality rows over distinct sessions, so it can pass
    100, and ids are joined without a separator.
    """
    today = silver.filter(on_day(as_of)).agg(
        (F.sum("buffering_time_ms") / F.lit(1000.0) / F.count("buffering_time_ms")).alias("mean_sec"),
        F.coalesce(F.count_if(F.col("buffering_count") > 0), F.lit(0)).alias("sessions_with_buffering"),
        F.count_distinct(F.concat("customerId", "clientId", "timestamp_server")).alias("total_sessions"),
    )
    rated = today.withColumn(
        "buffering_sessions_pct", F.round(percent("sessions_with_buffering", "total_sessions"), 2)
    )
    share, mean = F.col("buffering_sessions_pct"), F.col("mean_sec")
    status = first_match(
        [
            ((mean > alert[0]) | (share > alert[1]), "ALERT"),
            ((mean > warning[0]) | (share > warning[1]), "WARNING"),
        ],
        "OK",
    )
    shown = rated.select(
        F.round("mean_sec", 2).alias("avg_buffering_time_sec"),
        "total_sessions",
        "sessions_with_buffering",
        "buffering_sessions_pct",
        status.alias("status"),
    )
    return labelled(shown, "BUFFERING_DEGRADATION", "alert_name")


def gold_lag(silver: DataFrame, gold: DataFrame, as_of: str, alert: float = 1, warning: float = 0) -> DataFrame:
    """Days between "today" and the latest gold date."""
    latest = side_by_side(
        silver.agg(F.max("timestamp_server").alias("last_ms")),
        gold.agg(F.max("eventDate").alias("gold_latest_date")),
    )
    lag = latest.select(
        epoch_ms_to_timestamp("last_ms").alias("silver_latest_event"),
        "gold_latest_date",
        F.datediff(F.lit(as_of).cast("date"), "gold_latest_date").alias("lag_days"),
    )
    with_status = lag.withColumn("status", tier(F.col("lag_days"), alert, warning))
    return labelled(with_status, "GOLD_LAYER_LAG", "alert_name")


def reason_spike(quarantine: DataFrame, as_of: str, alert: int = 1000, warning: int = 500) -> DataFrame:
    """Rows and customers per reason, today."""
    today = quarantine.filter(on_day(as_of)).groupBy("quarantine_reason")
    counted = today.agg(row_total("issue_count"), F.count_distinct("customerId").alias("affected_customers"))
    with_status = counted.withColumn("status", tier(F.col("issue_count"), alert, warning))
    report = labelled(with_status, "QUARANTINE_REASON_SPIKE", "alert_name")
    return report.orderBy(F.col("issue_count").desc(), "quarantine_reason")


# --- the second set of thresholds, each report returns a row only when it fires ----------


def stale_bronze(bronze: DataFrame, as_of: str, max_days: int = 1) -> DataFrame:
    last = bronze.agg(epoch_ms_to_timestamp(F.max("timestampInfo.server")).alias("last_record"))
    days = F.datediff(F.lit(as_of).cast("date"), F.to_date("last_record"))
    return last.withColumn("days_since_last_record", days).filter(F.col("days_since_last_record") > max_days)


def quarantine_rate_today(bronze: DataFrame, quarantine: DataFrame, as_of: str, limit: float = 10) -> DataFrame:
    counts = side_by_side(
        quarantine.filter(on_day(as_of)).agg(row_total("quarantine_count")),
        bronze.filter(on_day(as_of)).agg(row_total("bronze_count")),
    )
    rated = counts.withColumn("quarantine_rate_pct", percent("quarantine_count", "bronze_count"))
    return rated.filter(F.col("quarantine_rate_pct") > limit)


def volume_deviation(bronze: DataFrame, as_of: str, limit: float = 0.5) -> DataFrame:
    """Two-sided; today is part of the average, as in the original."""
    daily = daily_counts(bronze.filter(on_or_after(as_of, 7)), "n")
    both = daily.agg(F.avg("n").alias("avg_7day"), F.max(F.when(on_day(as_of), F.col("n"))).alias("today_count"))
    moved = F.abs(F.col("today_count") - F.col("avg_7day")) / F.nullif(F.col("avg_7day"), F.lit(0.0))
    return both.withColumn("deviation", moved).filter(F.col("deviation") > limit)


def seconds_per_interruption() -> Column:
    """Guarded ratio; NULL when there was no interruption."""
    return ratio("buffering_time_sec", "buffering_count")


def buffering_trend(silver: DataFrame, as_of: str, limit: float = 0.2) -> DataFrame:
    """Seconds per interruption today against the mean of the days before."""
    daily = (
        silver.filter(on_or_after(as_of, 7))
        .groupBy("eventDate")
        .agg(exact_avg(seconds_per_interruption()).alias("avg_buffer_duration"))
    )
    value = F.col("avg_buffer_duration")
    both = daily.agg(
        exact_avg(F.when(F.col("eventDate") < F.lit(as_of).cast("date"), value)).alias("baseline"),
        F.max(F.when(on_day(as_of), value)).alias("today"),
    )
    change = (F.col("today") - F.col("baseline")) / F.nullif(F.col("baseline"), F.lit(0.0))
    return both.withColumn("change", change).filter(F.col("change") > limit)


def layer_lag(silver: DataFrame, gold: DataFrame, limit: int = 0) -> DataFrame:
    latest = stack(
        labelled(silver.agg(F.max("eventDate").alias("latest_date")), "silver"),
        labelled(gold.agg(F.max("eventDate").alias("latest_date")), "gold"),
    )
    pick = lambda layer: F.max(F.when(F.col("layer") == layer, F.col("latest_date")))
    both = latest.agg(pick("silver").alias("silver_latest"), pick("gold").alias("gold_latest"))
    return both.withColumn("lag_days", F.datediff("silver_latest", "gold_latest")).filter(F.col("lag_days") > limit)


def failing_reasons(quarantine: DataFrame, as_of: str, limit: int = 100) -> DataFrame:
    counted = quarantine.filter(on_day(as_of)).groupBy("quarantine_reason").agg(row_total("failure_count"))
    return counted.filter(F.col("failure_count") > limit)


def all_alerts(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, gold: DataFrame, as_of: str, as_of_ts: str
) -> DataFrame:
    """The six alerts as (name, metric, value, status, severity), worst first."""

    def as_metric(report: DataFrame, metric: str) -> DataFrame:
        return report.select(
            "alert_name", F.lit(metric).alias("metric"), F.col(metric).cast("double").alias("value"), "status"
        )

    spikes = reason_spike(quarantine, as_of)
    spikes = spikes.select(
        "alert_name",
        F.concat(F.lit("issue_count:"), F.col("quarantine_reason")).alias("metric"),
        F.col("issue_count").cast("double").alias("value"),
        "status",
    )
    everything = stack(
        as_metric(bronze_freshness(bronze, as_of, as_of_ts), "hours_since_last_event"),
        as_metric(quarantine_rate(bronze, quarantine, as_of), "quarantine_rate_pct"),
        as_metric(volume_anomaly(bronze, as_of), "pct_of_baseline"),
        as_metric(buffering_degradation(silver, as_of), "buffering_sessions_pct"),
        as_metric(gold_lag(silver, gold, as_of), "lag_days"),
        spikes,
    )
    severity = first_match([(F.col("alert_name") == name, level) for name, level in SEVERITY.items()])
    return everything.withColumn("severity", severity).orderBy(
        rank_of("status", ["ALERT", "WARNING", "OK"]),
        rank_of("severity", ["CRITICAL", "HIGH", "MEDIUM"]),
        "alert_name",
        "metric",
    )
