"""Dashboard reports on gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import days_before, exact_avg, exact_sum, on_day, on_or_after
from ..operators.medallion import buffering_ratio, source_share
from .alerts import row_total


def score_distribution(gold: DataFrame) -> DataFrame:
    """Viewer days per tier and ten-point bucket; a score of 100 has its own bucket."""
    bucket = F.floor(F.col("qos_score") / 10).alias("score_bucket")
    return gold.groupBy("qos_category", bucket).agg(row_total("viewer_days"))


def buffering_trend(gold: DataFrame) -> DataFrame:
    return gold.groupBy("eventDate").agg(F.sum("total_buffering_events").alias("buffering_events")).orderBy("eventDate")


def worst_customers(gold: DataFrame, limit: int = 10) -> DataFrame:
    scored = gold.groupBy("customerId").agg(
        exact_avg("qos_score").alias("avg_qos_score"), row_total("viewer_days")
    )
    return scored.orderBy("avg_qos_score", "customerId").limit(limit)


def traffic_split(gold: DataFrame) -> DataFrame:
    total = gold.agg(
        F.sum("total_source_data_bytes").alias("source_bytes"), F.sum("total_p2p_data_bytes").alias("p2p_bytes")
    )
    source, p2p = F.col("source_bytes"), F.col("p2p_bytes")
    return total.withColumns({"source_pct": source_share(source, p2p), "p2p_pct": source_share(p2p, source)})


def data_volume(gold: DataFrame) -> DataFrame:
    return gold.groupBy("eventDate").agg(exact_sum("total_data_consumed_mb").alias("data_mb")).orderBy("eventDate")


def rebuffering_over_time(gold: DataFrame) -> DataFrame:
    ratio = buffering_ratio(exact_sum("total_buffering_time_sec"), exact_sum("total_data_consumed_mb"))
    return gold.groupBy("eventDate").agg(ratio.alias("rebuffering_ratio_pct")).orderBy("eventDate")


def score_trend(gold: DataFrame) -> DataFrame:
    return gold.groupBy("eventDate").agg(exact_avg("qos_score").alias("avg_qos_score")).orderBy("eventDate")


def score_by_source_share(gold: DataFrame, width: int = 20) -> DataFrame:
    bucket = F.floor(F.col("source_traffic_percentage") / width).alias("source_share_bucket")
    return gold.groupBy(bucket).agg(exact_avg("qos_score").alias("avg_qos_score"), row_total("viewer_days"))


def session_impact(gold: DataFrame) -> DataFrame:
    grouped = gold.groupBy("eventDate", "qos_category")
    return grouped.agg(F.sum("total_sessions").alias("sessions")).orderBy("eventDate", "qos_category")


def viewers_and_buffering(gold: DataFrame) -> DataFrame:
    """Viewers and interruptions per day, with their correlation over the days."""
    daily = gold.groupBy("eventDate").agg(
        F.count_distinct("clientId").alias("viewers"), F.sum("total_buffering_events").alias("buffering_events")
    )
    link = F.round(daily.agg(F.corr("viewers", "buffering_events")).scalar(), 6)
    return daily.withColumn("correlation", link).orderBy("eventDate")


def _two_periods(gold: DataFrame, now: Column, before: Column) -> DataFrame:
    """The four headline figures of two periods and their differences, in one scan."""

    def figures(when: Column, suffix: str) -> list[Column]:
        pick = lambda name: F.when(when, F.col(name))
        return [
            exact_avg(pick("qos_score")).alias(f"score_{suffix}"),
            F.count_distinct(pick("clientId")).alias(f"viewers_{suffix}"),
            F.coalesce(F.sum(pick("total_buffering_events")), F.lit(0)).alias(f"events_{suffix}"),
            F.coalesce(F.sum(pick("total_sessions")), F.lit(0)).alias(f"sessions_{suffix}"),
        ]

    both = gold.filter(now | before).agg(*figures(now, "now"), *figures(before, "before"))
    names = ["score", "viewers", "events", "sessions"]
    return both.withColumns({f"{n}_delta": F.col(f"{n}_now") - F.col(f"{n}_before") for n in names})


def today_against_yesterday(gold: DataFrame, as_of: str) -> DataFrame:
    return _two_periods(gold, on_day(as_of), F.col("eventDate") == days_before(as_of, 1))


def week_over_week(gold: DataFrame, as_of: str) -> DataFrame:
    day = F.col("eventDate")
    this_week = (day > days_before(as_of, 7)) & (day <= days_before(as_of, 0))
    last_week = (day > days_before(as_of, 14)) & (day <= days_before(as_of, 7))
    return _two_periods(gold, this_week, last_week)


def consistently_poor(gold: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Customers with a Poor viewer on every day they were active."""
    poor = F.col("qos_category") == "Poor"
    daily = (
        gold.filter(on_or_after(as_of, days))
        .groupBy("customerId", "eventDate")
        .agg(F.bool_or(poor).alias("had_poor"), F.min("qos_score").alias("worst_score"))
    )
    return (
        daily.groupBy("customerId")
        .agg(
            row_total("active_days"),
            F.every("had_poor").alias("_always"),
            F.min("worst_score").alias("lowest_score"),
        )
        .filter("_always")
        .drop("_always")
    )
