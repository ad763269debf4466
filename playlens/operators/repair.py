"""Repair of quarantined rows and their way back into silver."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import cap, ms_to_seconds, on_or_after, to_megabytes
from ..sources import files, tables
from . import merge
from .combine import labelled, stack
from .dedupe import keep_one

# Columns made positive, defaults for NULL, ceiling in seconds, lookback.
SIGNED_COLUMNS = ["buffering_count", "buffering_time_ms", "total_source_data", "total_p2p_data"]
NULL_DEFAULTS = {
    "buffering_count": 0,
    "buffering_time_ms": 0,
    "total_source_data": 0,
    "total_p2p_data": 0,
    "quality_level": "unknown",
}
MAX_BUFFERING_SEC = 3600
LOOKBACK_DAYS = 7
REQUIRED = ["customerId", "contentId", "clientId", "quality_level"]
#: Folder level of the archive: one value per archiving run.
ARCHIVED = "archived"
CLEANUP_MODES = ("none", "mark_processed", "delete", "archive")


def _present(df: DataFrame, names) -> list[str]:
    return [name for name in names if name in df.columns]


def fix_negative_values(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.abs(F.col(name)) for name in _present(df, SIGNED_COLUMNS)})


def fix_null_values(df: DataFrame) -> DataFrame:
    return df.fillna({name: NULL_DEFAULTS[name] for name in _present(df, NULL_DEFAULTS)})


def fix_out_of_range(df: DataFrame) -> DataFrame:
    """Cap seconds of buffering; a no-op while that column is still missing."""
    name = "buffering_time_sec"
    capped = {name: cap(name, MAX_BUFFERING_SEC).cast("double")} if name in df.columns else {}
    return df.withColumns(capped) if capped else df


def apply_all_fixes(df: DataFrame) -> DataFrame:
    return df.transform(fix_negative_values).transform(fix_null_values).transform(fix_out_of_range)


def fix_negative_timestamp(df: DataFrame, name: str = "timestamp_server") -> DataFrame:
    value = F.col(name)
    return df.withColumn(name, F.when(value < 0, F.abs(value)).otherwise(value))


def rebuild_basic(quarantine: DataFrame) -> DataFrame:
    """The nine columns the dry run starts from."""
    names = [
        "customerId",
        "contentId",
        "clientId",
        "timestamp_server",
        "timestamp_agent",
        "buffering_count",
        "buffering_time_ms",
        "quality_level",
        "eventDate",
    ]
    return quarantine.select(*names)


def fix_basic(quarantine: DataFrame) -> DataFrame:
    """Fixes in the original order: seconds are added last and so are not capped."""
    fixed = apply_all_fixes(rebuild_basic(quarantine))
    return fixed.withColumn("buffering_time_sec", ms_to_seconds("buffering_time_ms"))


def repair_quarantine(quarantine: DataFrame) -> DataFrame:
    """All 18 silver columns, fixed in the order that lets every fix take effect."""
    fixed = quarantine.transform(fix_negative_values).transform(fix_null_values)
    fixed = fixed.withColumns(
        {
            "buffering_time_sec": ms_to_seconds("buffering_time_ms"),
            "quality_data_mb": to_megabytes("quality_source_data", "quality_p2p_data"),
            "total_data_mb": to_megabytes("total_source_data", "total_p2p_data"),
        }
    )
    return fix_out_of_range(fixed).select(*schemas.SILVER.names)


def is_valid() -> Column:
    return F.coalesce(
        F.col("customerId").isNotNull() & F.col("quality_level").isNotNull() & (F.col("buffering_count") >= 0),
        F.lit(False),
    )


def dry_run(quarantine: DataFrame) -> DataFrame:
    """One row: what a reprocessing run would fix, from one aggregate."""
    fixed = fix_basic(quarantine)
    return fixed.agg(
        F.count(F.lit(1)).alias("original_records"),
        F.count_if(is_valid()).alias("fixed_records"),
        F.count_if(~is_valid()).alias("still_bad_records"),
        F.round(F.count_if(is_valid()) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0)), 1).alias("success_rate_pct"),
        F.count_if(F.col("buffering_count") < 0).alias("negative_buffering_count"),
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in REQUIRED],
    )


def merge_source(quarantine: DataFrame, as_of: str | None = None, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Repaired rows ready for the upsert: valid under the silver contract, one per key."""
    recent = quarantine.filter(on_or_after(as_of, days)) if as_of else quarantine
    fixed = repair_quarantine(recent)
    for name in schemas.REQUIRED_SILVER:
        fixed = fixed.filter(F.col(name).isNotNull())
    return keep_one(fixed, schemas.SILVER_KEY)


def unprocessed(quarantine: DataFrame) -> DataFrame:
    return quarantine.filter(F.col("processed_id").isNull())


def mark_processed(
    quarantine: DataFrame, done: DataFrame, stamp: Column, batch_id: Column, keys: list[str] = schemas.SILVER_KEY
) -> DataFrame:
    """Stamp the rows whose key was reprocessed; earlier stamps stay."""
    old = {name: F.col(name) for name in ("processed_id", "processed_timestamp") if name in quarantine.columns}
    marks = done.select(*keys).distinct().withColumn("_done", F.lit(True))
    hit = F.col("_done") & old.get("processed_id", F.lit(None)).isNull()
    before_id = old.get("processed_id", F.lit(None).cast("string"))
    before_ts = old.get("processed_timestamp", F.lit(None).cast("timestamp"))
    rest = [c for c in quarantine.columns if c not in old]
    return quarantine.join(marks, keys, "left").select(
        *rest,
        F.when(hit, batch_id).otherwise(before_id).alias("processed_id"),
        F.when(hit, stamp).otherwise(before_ts).alias("processed_timestamp"),
    )


def split_archive(
    quarantine: DataFrame, done: DataFrame, keys: list[str] = schemas.SILVER_KEY
) -> tuple[DataFrame, DataFrame]:
    """(rows to archive, rows that stay)."""
    ids = done.select(*keys).distinct()
    return quarantine.join(ids, keys, "left_semi"), quarantine.join(ids, keys, "left_anti")


def before_after(silver: DataFrame, quarantine: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Silver totals against what is left in quarantine."""
    done = silver.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("customerId").alias("customers"),
        F.concat(
            F.min("eventDate").cast("string"), F.lit(" to "), F.max("eventDate").cast("string")
        ).alias("date_range"),
    )
    left = quarantine.filter(on_or_after(as_of, days)).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("customerId").alias("customers"),
        F.lit("Recent records only").alias("date_range"),
    )
    return stack(labelled(done, "Silver Enriched"), labelled(left, f"Quarantine (last {days}d)"))


# --- jobs -------------------------------------------------------------------------------


def reprocess(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    quarantine: DataFrame,
    staging: str,
    as_of: str,
    confirm: bool = False,
    days: int = LOOKBACK_DAYS,
    distinct: str = "approx",
) -> DataFrame | dict[str, int]:
    """Merge repaired rows into silver, then refresh gold for their dates.

    Without ``confirm`` nothing is written and the dry-run frame is returned.
    """
    if not confirm:
        return dry_run(quarantine.filter(on_or_after(as_of, days)))
    # Written down once: the merge reads the source for its checks, counts and both joins.
    source_path = f"{staging}/source"
    merge_source(quarantine, as_of, days).write.mode("overwrite").parquet(source_path)
    source = spark.read.schema(schemas.SILVER).parquet(source_path)
    counts = merge.merge_table(spark, silver_path, source, f"{staging}/silver")
    counts["gold_rows"] = merge.refresh_gold_table(
        spark, gold_path, silver_path, merge.dates_of(source), f"{staging}/gold", distinct
    )
    return counts


def clean_up(
    spark: SparkSession,
    quarantine_path: str,
    done: DataFrame,
    mode: str = "none",
    confirm: bool = False,
    archive_path: str | None = None,
    stamp: Column | None = None,
    batch_id: Column | None = None,
) -> bool:
    """Deal with reprocessed quarantine rows; True if anything was written.

    Archiving comes first and is checked; only then the table shrinks.  All modes rewrite the
    dates of the rows they deal with alone; only marking for the first time writes the whole
    table, as every file gets the new columns.
    """
    staging = f"{quarantine_path}.staging"
    if mode not in CLEANUP_MODES:
        raise ValueError(f"mode must be one of {CLEANUP_MODES}")
    if mode == "none" or not confirm:
        return False
    # The keys may come from the table that is about to change, so they are written first.
    keys_path = f"{quarantine_path}.done"
    done.select(*schemas.SILVER_KEY).distinct().write.mode("overwrite").parquet(keys_path)
    done = spark.read.parquet(keys_path)
    rows = spark.read.parquet(quarantine_path)
    layout = tables.layout(rows, tables.QUARANTINE_PARTITIONS)
    if mode == "mark_processed":
        names = ["processed_id", "processed_timestamp"]
        grown = not set(names) <= set(rows.columns)
        if grown:
            rows = rows.withColumns({names[0]: F.lit(None).cast("string"), names[1]: F.lit(None).cast("timestamp")})
        stamp = F.current_timestamp() if stamp is None else stamp
        batch_id = F.expr("uuid()") if batch_id is None else batch_id
        left = mark_processed(rows, done, stamp, batch_id).select(*rows.columns)
        if grown:  # every file gets the new columns
            tables.replace_table(spark, left, quarantine_path, layout, grown=True)
        else:
            merge.replace_partitions(spark, merge.on_dates(left, merge.dates_of(done)), quarantine_path, layout, staging)
    else:
        if mode == "archive" and archive_path is None:
            raise ValueError("archive mode needs archive_path")
        here = merge.on_dates(rows, merge.dates_of(done))  # a key holds its date
        gone, left = split_archive(here, done)
        if mode == "archive":
            _archive(spark, gone.select(*rows.columns), archive_path)
        merge.shrink_partitions(spark, left.select(*rows.columns), here, quarantine_path, layout, staging)
    files.delete(spark, keys_path)
    return True


def _archive(spark: SparkSession, rows: DataFrame, archive_path: str) -> None:
    """Add the rows whose keys the archive lacks.

    A key that is there was archived by an earlier attempt, with all of its rows, so a retry
    adds each row once, also if more faulty rows arrived in between.  Only the dates of the
    rows are opened.  Rows of one attempt share a folder level of its own.
    """
    dates = merge.dates_of(rows)
    known = None
    if files.exists(spark, archive_path):
        known = merge.on_dates(spark.read.parquet(archive_path), dates)
        new = rows.join(known.select(*schemas.SILVER_KEY).distinct(), schemas.SILVER_KEY, "left_anti").select(*rows.columns)
    else:
        new = rows
    layout = [*tables.QUARANTINE_PARTITIONS, ARCHIVED]
    stamped = new.withColumn(ARCHIVED, F.lit(f"m{uuid.uuid4().hex}"))
    tables.write_partitioned(tables.packed(stamped, layout), archive_path, layout, mode="append")
    if rows.isEmpty():
        return
    live = merge.on_dates(spark.read.parquet(archive_path), dates)
    live = live.join(rows.select(*schemas.SILVER_KEY).distinct(), schemas.SILVER_KEY, "left_semi")
    if tables.row_count(live) < tables.row_count(rows):
        raise RuntimeError("archive is incomplete; quarantine left as it was")


def dedupe_silver(spark: SparkSession, silver_path: str, backup: str | None, confirm: bool = False) -> DataFrame:
    """Counts of the duplicate clean-up; with ``confirm`` also back up and rewrite silver."""
    from .dedupe import dedupe_counts, duplicate_groups

    silver = spark.read.parquet(silver_path)
    report = dedupe_counts(silver)
    if not confirm:
        return report
    report = spark.createDataFrame(report.collect(), report.schema)
    if report.first()["duplicates_removed"]:
        if backup:
            tables.backup_table(silver, backup)
        # A key lies on one date, so dates without copies stay as they are.
        dates = merge.dates_of(duplicate_groups(silver))
        found = merge.on_dates(silver, dates)
        kept = keep_one(found, schemas.SILVER_KEY).select(*silver.columns)
        # a batch folder may lose all of its rows
        layout = tables.layout(kept, ["eventDate"])
        merge.shrink_partitions(spark, kept, found, silver_path, layout, f"{silver_path}.staging")
    return report
