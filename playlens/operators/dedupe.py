"""Duplicate detection and deterministic removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from .combine import labelled, stack
from ..functions.scalar import epoch_ms_to_date


def latest_first(df: DataFrame, lead: str = "timestamp_agent") -> list[Column]:
    """Latest agent time first, then every other column, so that no tie is left open."""
    rest = [c for c in df.columns if c != lead]
    return [F.col(lead).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rest]]


def keep_one(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key.

    The filter on row_number lets Spark place a group limit before the shuffle: every map
    task sends on at most one row per key, so a key with very many copies is no hot spot.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or latest_first(df)))
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct.  Maps are compared through their sorted entries."""
    maps = [f.name for f in df.schema if f.dataType.typeName() == "map"]
    if not maps:
        return df.distinct()
    keyed = df.withColumns({name: F.array_sort(F.map_entries(name)) for name in maps}).distinct()
    return keyed.withColumns({name: F.map_from_entries(name) for name in maps}).select(*df.columns)


def duplicate_groups(df: DataFrame, keys: list[str] = schemas.SILVER_KEY) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.filter(F.col("duplicate_count") > 1)


def has_duplicates(df: DataFrame, keys: list[str]) -> bool:
    return not duplicate_groups(df, keys).isEmpty()


def duplicate_summary(df: DataFrame, keys: list[str] = schemas.SILVER_KEY) -> DataFrame:
    n = F.col("duplicate_count")
    return duplicate_groups(df, keys).agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum(n), F.lit(0)).alias("total_duplicate_records"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("extra_copies"),
    )


def duplicate_report(silver: DataFrame, limit: int = 10) -> DataFrame:
    """Summary line and the largest groups under it, ``limit`` lines in all."""
    groups = duplicate_groups(silver)
    summary = groups.agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.sum("duplicate_count").alias("total_duplicate_records"),
        F.sum(F.col("duplicate_count") - 1).alias("extra_copies"),
    )
    heading = groups.agg(F.lit(None).cast("bigint").alias("duplicate_groups"))
    names = F.concat(
        F.lit("  "),
        F.concat_ws(" | ", "customerId", "clientId", epoch_ms_to_date("timestamp_server").cast("string")),
    )
    groups = groups.select(
        names.alias("check_type"), F.col("duplicate_count").alias("total_duplicate_records"), "quality_level"
    )
    lines = stack(
        labelled(summary, "Duplicate Detection Summary", "check_type"),
        labelled(heading, "Sample Duplicates (Top 5)", "check_type"),
        groups,
    )
    order = [F.col("total_duplicate_records").desc_nulls_last(), F.col("check_type"), F.col("quality_level")]
    return lines.orderBy(*order).limit(limit).drop("quality_level")


def dedupe_counts(silver: DataFrame, keys: list[str] = schemas.SILVER_KEY) -> DataFrame:
    """Rows before, after and removed, from one grouped count."""
    counted = silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.sum("n").alias("original_records"),
        F.count(F.lit(1)).alias("deduplicated_records"),
        F.sum(F.col("n") - 1).alias("duplicates_removed"),
    )
