"""Reports on the quarantine table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import first_match, on_day, on_or_after, percent, rank_of
from ..operators.combine import share_of_total, side_by_side
from ..operators.repair import is_valid
from .alerts import daily_counts, row_total

# Patterns with the fixability and the priority they stand for.
FIXABILITY = [
    ("%negative%", "Fixable: Apply ABS() or set to 0"),
    ("%null%", "Fixable: Fill with defaults"),
    ("%invalid format%", "Fixable: Parse and transform"),
    ("%out of range%", "Fixable: Cap to valid range"),
    ("%timeout%", "Transient: Retry"),
    ("%schema%", "Transient: Schema evolved, retry"),
    ("%corrupt%", "Permanent: Corrupt data"),
    ("%malformed%", "Permanent: Malformed JSON"),
]
PRIORITY = [
    ("%negative%", "HIGH"),
    ("%null%", "HIGH"),
    ("%timeout%", "HIGH"),
    ("%invalid format%", "MEDIUM"),
    ("%out of range%", "MEDIUM"),
]


def reason_summary(quarantine: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    grouped = (
        quarantine.filter(on_or_after(as_of, days))
        .groupBy("quarantine_reason")
        .agg(
            row_total("issue_count"),
            F.count_distinct("customerId").alias("affected_customers"),
            F.count_distinct("eventDate").alias("affected_dates"),
            F.min("quarantine_timestamp").cast("timestamp_ntz").alias("first_seen"),
            F.max("quarantine_timestamp").cast("timestamp_ntz").alias("last_seen"),
        )
    )
    share = F.round(share_of_total(grouped, "issue_count"), 2)
    return grouped.withColumn("pct_of_total", share).orderBy(F.col("issue_count").desc(), "quarantine_reason")


def fixability(quarantine: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Reasons rolled up by whether and how urgently they can be fixed."""
    counted = quarantine.filter(on_or_after(as_of, days)).groupBy("quarantine_reason").agg(row_total("issue_count"))
    reason = F.col("quarantine_reason")
    classed = counted.withColumns(
        {
            "fixability": first_match([(reason.like(p), label) for p, label in FIXABILITY], "Unknown: Needs manual review"),
            "fix_priority": first_match([(reason.like(p), label) for p, label in PRIORITY], "LOW"),
        }
    )
    return (
        classed.groupBy("fixability", "fix_priority")
        .agg(row_total("distinct_reasons"), F.sum("issue_count").alias("total_records"))
        .orderBy(rank_of("fix_priority", ["HIGH", "MEDIUM", "LOW"]), F.col("total_records").desc())
    )


def reason_sample(quarantine: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Count and one example per reason: the row first in server time, then by id."""
    place = F.struct("timestamp_server", "customerId", "clientId", "quality_level")
    return (
        quarantine.filter(on_or_after(as_of, days))
        .groupBy("quarantine_reason")
        .agg(
            row_total("count"),
            F.min_by("customerId", place).alias("sample_customerId"),
            F.min_by("eventDate", place).alias("sample_eventDate"),
        )
        .orderBy(F.col("count").desc(), "quarantine_reason")
    )


def detailed_sample(quarantine: DataFrame, as_of: str, days: int = 7, limit: int = 5) -> DataFrame:
    """A few whole records as JSON."""
    recent = quarantine.filter(on_or_after(as_of, days))
    return (
        recent.select(
            "quarantine_reason",
            "quarantine_timestamp",
            "customerId",
            "eventDate",
            "timestamp_server",
            F.to_json(F.struct("*")).alias("original_data"),
        )
        .orderBy("eventDate", "timestamp_server", "customerId", "original_data")
        .limit(limit)
        .drop("timestamp_server")
    )


def daily_rate_by_reason(bronze: DataFrame, quarantine: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    faulty = (
        quarantine.filter(on_or_after(as_of, days))
        .groupBy("eventDate", "quarantine_reason")
        .agg(row_total("quarantine_count"))
    )
    total = daily_counts(bronze.filter(on_or_after(as_of, days)), "bronze_count")
    rate = F.round(percent("quarantine_count", "bronze_count"), 2)
    return (
        faulty.join(total, "eventDate", "left")
        .withColumn("quarantine_rate_pct", rate)
        .orderBy(F.col("eventDate").desc(), F.col("quarantine_count").desc(), "quarantine_reason")
    )


def daily_failures(quarantine: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    grouped = quarantine.filter(on_or_after(as_of, days)).groupBy("eventDate", "quarantine_reason")
    return grouped.agg(row_total("failure_count")).orderBy(
        F.col("eventDate").desc(), F.col("failure_count").desc(), "quarantine_reason"
    )


def top_customers(quarantine: DataFrame, as_of: str, days: int = 1, limit: int = 100) -> DataFrame:
    grouped = quarantine.filter(on_or_after(as_of, days)).groupBy("customerId", "quarantine_reason")
    ranked = grouped.agg(row_total("issue_count"))
    return ranked.orderBy(F.col("issue_count").desc(), "customerId", "quarantine_reason").limit(limit)


def reprocessing_health(
    quarantine: DataFrame, fixed: DataFrame, as_of: str, min_success_pct: float = 80, max_age_days: int = 7
) -> DataFrame:
    """Success rate, rows waiting too long, and reasons first seen today."""
    success = fixed.agg(F.round(percent(F.count_if(is_valid()), F.count(F.lit(1))), 2).alias("success_rate_pct"))
    waiting = quarantine.agg(F.count_if(~on_or_after(as_of, max_age_days)).alias("overdue_records"))
    today = quarantine.filter(on_day(as_of)).select("quarantine_reason").distinct()
    earlier = quarantine.filter(~on_day(as_of)).select("quarantine_reason").distinct()
    new = today.join(earlier, "quarantine_reason", "left_anti").agg(row_total("new_reasons"))
    summary = side_by_side(success, waiting, new)
    return summary.withColumns(
        {
            "success_status": F.when(F.col("success_rate_pct") < min_success_pct, "ALERT").otherwise("OK"),
            "overdue_status": F.when(F.col("overdue_records") > 0, "ALERT").otherwise("OK"),
            "new_reason_status": F.when(F.col("new_reasons") > 0, "ALERT").otherwise("OK"),
        }
    )


def rate_z_score(bronze: DataFrame, quarantine: DataFrame, days: int = 7) -> DataFrame:
    """Daily rate per reason against its own preceding days, as a z-score.

    The window runs over daily aggregates: one row per date and reason.
    """
    faulty = quarantine.groupBy("eventDate", "quarantine_reason").agg(row_total("n"))
    rated = faulty.join(daily_counts(bronze, "total"), "eventDate").withColumn("rate_pct", percent("n", "total"))
    before = Window.partitionBy("quarantine_reason").orderBy("eventDate").rowsBetween(-days, -1)
    mean, spread = F.avg("rate_pct").over(before), F.stddev_samp("rate_pct").over(before)
    z = (F.col("rate_pct") - F.col("mean")) / F.nullif(F.col("spread"), F.lit(0.0))
    return rated.select("eventDate", "quarantine_reason", "rate_pct", mean.alias("mean"), spread.alias("spread")).select(
        "eventDate",
        "quarantine_reason",
        F.round("rate_pct", 4).alias("rate_pct"),
        F.round("mean", 4).alias("baseline_pct"),
        F.round(z, 4).alias("z_score"),
    )

