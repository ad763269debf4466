"""Retention, compaction, storage reports and the run log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import GB, MB, days_before, first_match
from ..sources import files, tables
from ..sources.tables import BATCH, MERGED_BATCH

# Days kept per layer.
RETENTION_DAYS = {"bronze": 90, "silver": 90, "quarantine": 180, "gold": 365}


# --- retention --------------------------------------------------------------------------


def surviving(df: DataFrame, as_of: str, days: int) -> DataFrame:
    """Rows still inside the retention period.  A filter on the partition column."""
    return df.filter(F.col("eventDate") >= days_before(as_of, days))


def expired_partitions(spark: SparkSession, path: str, as_of: str, days: int) -> list[str]:
    """Expired ``eventDate=...`` folders, by name; no data is read."""
    limit = spark.sql(f"SELECT date_sub(DATE'{as_of}', {int(days)})").first()[0].isoformat()
    names = [name for name in files.subfolders(spark, path) if name.startswith("eventDate=")]
    return sorted(name for name in names if name.split("=", 1)[1] < limit)


def drop_expired(spark: SparkSession, path: str, as_of: str, days: int, confirm: bool = False) -> list[str]:
    """Remove whole expired partitions; without ``confirm`` only name them."""
    names = expired_partitions(spark, path, as_of, days)
    if confirm:
        for name in names:
            files.delete(spark, f"{path}/{name}")
    return names


# --- storage ----------------------------------------------------------------------------


def storage_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Size, file count and mean file size per table, with advice about compaction."""
    per_table = [
        files.data_files(spark, path).agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"),
            F.count(F.lit(1)).alias("file_count"),
            F.max("modified").alias("last_update"),
        )
        for name, path in paths.items()
    ]
    from .combine import stack

    mean_mb = F.round(F.col("size_bytes") / F.nullif(F.col("file_count"), F.lit(0)) / MB, 2)
    report = stack(*per_table).select(
        "table_name",
        "size_bytes",
        F.round(F.col("size_bytes") / GB, 2).alias("size_gb"),
        "file_count",
        mean_mb.alias("avg_file_size_mb"),
        "last_update",
    )
    # More than 10,000 files or less than 10 MB per file call for compaction.
    advice = first_match(
        [
            (F.col("file_count") > 10000, "⚠ High File Count - Run OPTIMIZE"),
            (F.col("avg_file_size_mb") < 10, "⚠ Small Files - Run OPTIMIZE"),
        ],
        "✓ OK",
    )
    return report.withColumn("optimization_status", advice).orderBy(F.col("size_gb").desc(), "table_name")


def storage_growth(snapshots: DataFrame, limit_gb_per_day: float = 100.0) -> DataFrame:
    """Growth per day between stored storage reports (``snapshot_date`` added to each)."""
    window = Window.partitionBy("table_name").orderBy("snapshot_date")
    days = F.datediff("snapshot_date", F.lag("snapshot_date").over(window))
    grown = (F.col("size_bytes") - F.lag("size_bytes").over(window)) / GB / F.nullif(days, F.lit(0))
    return snapshots.select(
        "table_name",
        "snapshot_date",
        "size_bytes",
        grown.alias("growth_gb_per_day"),
        F.when(grown > limit_gb_per_day, "WARNING").otherwise("OK").alias("status"),
    )


def needs_compaction(spark: SparkSession, path: str, target_bytes: int) -> dict[date, int]:
    """Dates with more files than their bytes ask for, and how many files they should have.
    From the file listing alone; one entry per date."""
    day = F.regexp_extract("path", "eventDate=([^/]+)", 1).cast("date")
    wanted = F.greatest(F.ceil(F.sum("length") / target_bytes), F.lit(1)).cast("int")
    listed = files.data_files(spark, path).groupBy(day.alias("day")).agg(wanted.alias("n"), F.count(F.lit(1)).alias("now"))
    return {r.day: r.n for r in listed.filter("now > n and day is not null").collect()}


def compact(
    spark: SparkSession, path: str, staging: str, target_bytes: int = 128 * 1024 * 1024, dates_at_once: int = 30
) -> list[date]:
    """Give each date of a partitioned table about ``target_bytes`` per file; returns the dates rewritten.

    Only dates with too many files are read, some dates at a time, so a run is a row of bounded
    jobs.  In a table that streams append to, the batch folders of a date are closed and become
    one folder.  Rows are dealt to files by file and row position, so equal rows do not pile up
    in one file and a retried task deals alike.  A crash leaves each date whole, in place or
    aside, and the next run begins by putting such dates back.
    """
    from .merge import on_dates, replace_partitions

    tables.recover_folders(spark, path)
    if files.exists(spark, staging):
        files.delete(spark, staging)
    wanted = needs_compaction(spark, path, target_bytes)
    days = sorted(wanted)
    for k in range(0, len(days), dates_at_once):
        some = days[k : k + dates_at_once]
        rows = spark.read.parquet(path)
        placed = on_dates(rows, some).select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
        )
        files_of = F.create_map(*[part for d in some for part in (F.lit(d), F.lit(wanted[d]))])
        slot = F.pmod(F.xxhash64("_file", "_row"), files_of[F.col("eventDate")])
        dealt = placed.withColumn("_slot", slot).repartition(sum(wanted[d] for d in some), "eventDate", "_slot")
        packed = dealt.select(*rows.columns)
        if BATCH not in rows.columns:
            replace_partitions(spark, packed, path, ["eventDate"], staging, pack=False)
            continue
        packed = packed.withColumn(BATCH, F.lit(MERGED_BATCH).cast(rows.schema[BATCH].dataType))
        tables.write_partitioned(packed, staging, ["eventDate", BATCH])
        if tables.row_count(spark.read.parquet(staging)) != tables.row_count(on_dates(rows, some)):
            raise RuntimeError(f"{staging} lacks rows; {path} is as it was")
        for d in some:
            tables.swap_folder(spark, f"{staging}/eventDate={d}", path, f"eventDate={d}")
        files.delete(spark, staging)
    return days


# --- run log ----------------------------------------------------------------------------


def log_run(spark: SparkSession, path: str, **entry) -> None:
    """Append one entry; fields that are not given are NULL.  A write of a layer's version that
    is in the log already, as after a replayed micro-batch, is not logged again."""
    if entry.get("version") is not None and files.exists(spark, path):
        same = (F.col("layer").eqNullSafe(entry.get("layer"))) & (F.col("version") == entry["version"])
        if not log_table(spark, path).filter(same & F.col("operation").eqNullSafe(entry.get("operation"))).isEmpty():
            return
    row = tuple(entry.get(name) for name in schemas.RUN_LOG.names)
    spark.createDataFrame([row], schemas.RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def change_history(log: DataFrame, per_layer: int = 5) -> DataFrame:
    """Latest changes of each layer.  The rank filter limits rows before the shuffle."""
    # Operations that change data.
    changes = log.filter(F.col("operation").isin("MERGE", "WRITE", "UPDATE"))
    window = Window.partitionBy("layer").orderBy(F.col("version").desc(), F.col("ts").desc())
    ranked = changes.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= per_layer)
    counts = {name: F.coalesce(F.col(name), F.lit(0)) for name in ("rows_updated", "rows_inserted", "rows_out")}
    shown = ranked.withColumns(counts).select("layer", "version", "ts", "operation", *counts)
    return shown.orderBy(F.col("ts").desc(), "layer")


def run_history(log: DataFrame, as_of_ts: str, limit: int = 10) -> DataFrame:
    """Latest runs with state and duration; a run without an end lasts until "now"."""
    runs = log.filter(F.col("run_id").isNotNull())
    end = F.coalesce(F.col("finished"), F.lit(as_of_ts).cast("timestamp"))
    icon = first_match(
        [(F.col("state") == "COMPLETED", "✓"), (F.col("state") == "FAILED", "✗"), (F.col("state") == "RUNNING", "⟳")],
        "⚠",
    )
    return (
        runs.select(
            "run_id",
            "state",
            "started",
            icon.alias("status_icon"),
            F.timestamp_diff("MINUTE", "started", end).alias("duration_minutes"),
        )
        .orderBy(F.col("started").desc(), "run_id")
        .limit(limit)
    )


def log_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN_LOG).parquet(path)


def ensure_log(spark: SparkSession, path: str) -> None:
    tables.create_empty(spark, path, schemas.RUN_LOG)
