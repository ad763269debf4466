"""Keyed upsert, keyed delete and refresh of affected dates on plain parquet tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sources import files, tables
from ..sources.tables import BATCH, MERGED_BATCH
from .dedupe import has_duplicates
from .medallion import gold_viewer_qos


def match_counts(target: DataFrame, source: DataFrame, keys: list[str] = schemas.SILVER_KEY) -> DataFrame:
    """Rows an upsert would update and insert."""
    from .combine import side_by_side

    known = target.select(*keys)
    return side_by_side(
        source.join(known, keys, "left_semi").agg(F.count(F.lit(1)).alias("rows_updated")),
        source.join(known, keys, "left_anti").agg(F.count(F.lit(1)).alias("rows_inserted")),
    )


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str] = schemas.SILVER_KEY, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Target after "update what matches, insert what does not".

    Keys compare with plain equality, so a NULL key never matches and is inserted.  Every
    target row with a matching key takes the source's values, duplicates included.  Both
    joins preserve the large side, which AQE can split when a key is hot.  ``source`` must
    have one row per key; ``merge_table`` checks that.  Columns in ``keep`` stay as they are
    in rows that match.
    """
    fixed = {*keys, *keep}
    values = [c for c in target.columns if c not in fixed]
    incoming = source.select(*keys, F.struct(*values).alias("_new"))
    matched = F.col("_new").isNotNull()
    updated = target.join(incoming, keys, "left").select(
        *[
            F.col(c) if c in fixed else F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            for c in target.columns
        ]
    )
    inserted = source.join(target.select(*keys), keys, "left_anti").select(*target.columns)
    return updated.unionByName(inserted)


def affected(source: DataFrame, column: str = "eventDate") -> DataFrame:
    """Dates a batch touches.  One row per date, however many rows the batch has."""
    return source.select(column).distinct()


def dates_of(source: DataFrame, column: str = "eventDate") -> list[date]:
    """The same dates on the driver: as many as a batch has days, whatever its rows."""
    return sorted(r[0] for r in affected(source, column).filter(F.col(column).isNotNull()).collect())


def on_dates(df: DataFrame, dates: list[date], column: str = "eventDate") -> DataFrame:
    """Rows on the given dates.  The dates are literals, so other partitions are not opened
    and nothing is shuffled to find them."""
    return df.filter(F.col(column).isin(dates) if dates else F.lit(False))


def off_dates(df: DataFrame, dates: list[date], column: str = "eventDate") -> DataFrame:
    """All other rows, those without a date included."""
    return df.filter(~F.coalesce(F.col(column).isin(dates), F.lit(False))) if dates else df


def upsert_by_date(target: DataFrame, source: DataFrame, keys: list[str] = schemas.SILVER_KEY) -> DataFrame:
    """``upsert`` of a table partitioned by a date that is one of the keys: only the source's
    dates are joined, all others are carried over as they are."""
    dates = dates_of(source)
    return upsert(on_dates(target, dates), source, keys).unionByName(off_dates(target, dates))


def refresh_gold(gold: DataFrame, silver: DataFrame, dates: list[date], distinct: str = "approx") -> DataFrame:
    """Gold with the affected dates recomputed from silver and all others as they were."""
    fresh = gold_viewer_qos(on_dates(silver, dates), distinct)
    return off_dates(gold, dates).unionByName(fresh)


def delete_matching(target: DataFrame, keys_to_drop: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(keys_to_drop.select(*keys).distinct(), keys, "left_anti")


def delete_reprocessed(quarantine: DataFrame, reason: str, fixed: DataFrame) -> DataFrame:
    """Quarantine without the rows of one reason on the dates that were fixed."""
    dates = dates_of(fixed)
    gone = (F.col("quarantine_reason") == reason) & F.col("eventDate").isin(dates) if dates else F.lit(False)
    return quarantine.filter(~F.coalesce(gone, F.lit(False)))


# --- jobs on stored tables --------------------------------------------------------------


def replace_partitions(
    spark: SparkSession, rows: DataFrame, path: str, partitions: list[str], staging: str, pack: bool = True
) -> int:
    """Replace the partitions present in ``rows``; ``rows`` may read the same table.

    Rows are written to the staging folder, counted there, and copied over the live
    partitions with dynamic overwrite.  Until that last commit the table is untouched, and
    the staged copy stays until the live count agrees.
    """
    if files.exists(spark, staging):
        files.delete(spark, staging)
    tables.write_partitioned(tables.packed(rows, partitions) if pack else rows, staging, partitions)
    staged = spark.read.schema(rows.schema).parquet(staging)
    expected = tables.row_count(staged)
    tables.write_partitioned(staged, path, partitions)
    touched = staged.select(*partitions).distinct()
    live = spark.read.schema(rows.schema).parquet(path).join(touched, partitions, "left_semi")
    if tables.row_count(live) != expected:
        raise RuntimeError(f"{path}: live rows differ from {staging}, which is kept")
    files.delete(spark, staging)
    return expected


def shrink_partitions(
    spark: SparkSession, left: DataFrame, before: DataFrame, path: str, partitions: list[str], staging: str
) -> int:
    """Replace the partitions of ``before`` by what is ``left`` of them; both may read the table.

    Partitions that keep rows are staged, counted and overwritten as by ``replace_partitions``; then the
    folders of those that keep none are removed.  The table itself is never moved, other partitions
    are not touched, and a second attempt after a crash ends in the same state.
    """
    gone = before.select(*partitions).distinct().exceptAll(left.select(*partitions).distinct())
    emptied = [tuple(r) for r in gone.select(*[F.col(c).cast("string") for c in partitions]).collect()]  # folders, not rows
    rows = replace_partitions(spark, left, path, partitions, staging)
    for values in emptied:
        files.delete(spark, f"{path}/{files.partition_folder(spark, dict(zip(partitions, values)))}")
    return rows


def merge_table(
    spark: SparkSession, path: str, source: DataFrame, staging: str, keys: list[str] = schemas.SILVER_KEY
) -> dict[str, int]:
    """Upsert into a table partitioned by eventDate, rewriting only the source's dates.

    In a table that streams append to, rows stay in their batch folder and new rows get one
    of their own.  An upsert removes no row, so every folder it reads is written again.
    """
    if has_duplicates(source, keys):
        raise ValueError("source has several rows for one key")
    target = spark.read.parquet(path)
    current = on_dates(target, dates_of(source))
    counts = match_counts(current, source, keys).first().asDict()
    keep = ()
    if BATCH in target.columns:
        keep = (BATCH,)
        source = source.withColumn(BATCH, F.lit(MERGED_BATCH).cast(target.schema[BATCH].dataType))
    merged = upsert(current, source, keys, keep).select(*target.columns)
    counts["rows_out"] = replace_partitions(
        spark, merged, path, tables.layout(merged, ["eventDate"]), staging
    )
    return counts


def refresh_gold_table(
    spark: SparkSession, gold_path: str, silver_path: str, dates: list[date], staging: str, distinct: str = "approx"
) -> int:
    """Recompute gold for the given dates only and overwrite those partitions.

    A date that has no silver rows any more loses its gold partition.
    """
    silver = spark.read.parquet(silver_path)
    fresh = gold_viewer_qos(on_dates(silver, dates), distinct)
    rows = replace_partitions(spark, fresh, gold_path, ["eventDate"], staging)
    for gone in set(dates) - set(dates_of(on_dates(silver, dates))):
        files.delete(spark, f"{gold_path}/eventDate={gone}")
    return rows
