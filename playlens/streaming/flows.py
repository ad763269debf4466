"""Structured Streaming flows: raw files to the stored layers.

The transforms are the batch functions.  Runs are triggered (``availableNow``): a run takes
what has arrived since the checkpoint and ends.  A full refresh is a run with a new
checkpoint into an empty folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import maintenance, medallion, merge
from ..sources import files, landing, tables
from ..sources.tables import BATCH


def batch_flow(df: DataFrame, path: str, checkpoint: str, partitions: list[str]) -> StreamingQuery:
    """Append a stream to a table: every micro-batch in folders of its own.

    A replayed micro-batch overwrites just its folders, so each row appears once, and the table
    is plain folders that the maintenance jobs may rewrite; no sink log decides what is read.
    """
    return routed_flow(df, lambda rows, batch_id: _write_batch(rows, path, batch_id, partitions), checkpoint)


def silver_flow(bronze: DataFrame, path: str, checkpoint: str, not_null: str | None = "fail") -> StreamingQuery:
    return batch_flow(medallion.silver_enriched(bronze, not_null), path, checkpoint, ["eventDate"])


def quarantine_flow(bronze: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return batch_flow(medallion.quarantine(bronze), path, checkpoint, ["eventDate"])


def _write_batch(rows: DataFrame, path: str, batch_id: int, partitions: list[str]) -> None:
    """Write one micro-batch into folders of its own; a replay overwrites just those."""
    stamped = rows.withColumn(BATCH, F.lit(batch_id).cast("int"))
    layout = [*partitions, BATCH]
    tables.write_partitioned(tables.packed(stamped, layout), path, layout)


def _written_rows(spark: SparkSession, schema: T.StructType, path: str, batch_id: int) -> int:
    """Rows in the folders of a micro-batch; a count that parquet answers from its footers."""
    rows = spark.read.schema(T.StructType([*schema, T.StructField(BATCH, T.IntegerType())])).parquet(path)
    return tables.row_count(rows.filter(F.col(BATCH) == batch_id))


def route_batch(
    spark: SparkSession,
    silver_path: str,
    quarantine_path: str,
    gold_path: str,
    staging: str,
    log_path: str | None = None,
    not_null: str | None = "fail",
    distinct: str = "approx",
    logged: tuple[str, ...] = ("gold",),
) -> Callable[[DataFrame, int], None]:
    """Both sides of one micro-batch, then gold for the dates it touched.

    The exploded rows carry whole maps, so they are not kept: each side reads the columns it
    needs from the micro-batch and explodes them again, in a narrow pass.

    Late rows need no watermark: whatever date they carry is refreshed.  The layers named in
    ``logged`` get an entry in the run log with the rows that were written.
    """

    def log(layer: str, batch_id: int, started: datetime, rows: int) -> None:
        if log_path and layer in logged:
            maintenance.log_run(
                spark, log_path, layer=layer, version=batch_id, ts=started, operation="WRITE", rows_out=rows
            )

    def handle(bronze: DataFrame, batch_id: int) -> None:
        rows = medallion.quality_rows(bronze)
        silver = medallion.silver_from_rows(rows, not_null)
        now = datetime.now(timezone.utc)
        faults = medallion.quarantine_from_rows(rows)
        for layer, part, path in (("silver", silver, silver_path), ("quarantine", faults, quarantine_path)):
            _write_batch(part, path, batch_id, ["eventDate"])
            if log_path and layer in logged:
                log(layer, batch_id, now, _written_rows(spark, part.schema, path, batch_id))
        dates = merge.dates_of(rows)
        # Nothing may have reached silver yet, e.g. a first batch with faulty rows only.
        if files.exists(spark, silver_path) and not silver.isEmpty():
            gold_rows = merge.refresh_gold_table(spark, gold_path, silver_path, dates, staging, distinct)
            log("gold", batch_id, datetime.now(timezone.utc), gold_rows)

    return handle


def routed_flow(
    bronze: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        bronze.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_flow(
    spark: SparkSession, landing_path: str, handle: Callable[[DataFrame, int], None], checkpoint: str,
    files_per_batch: int = 1000, audit: bool = False,
) -> StreamingQuery:
    """Files of the landing zone as they arrive, typed, widened and rescued like a batch read.

    The stream carries file names; each micro-batch reads its files by their own schemas, so
    a value of another type goes to ``_rescued_data`` and an added column comes along, where a
    stream of rows would stop.  The names of one micro-batch, ``files_per_batch`` at most, come to
    the driver."""

    def read(listing: DataFrame, batch_id: int) -> None:
        names = sorted(r.path for r in listing.collect())
        if names:
            handle(landing.read_files(spark, landing_path, names, audit), batch_id)

    return routed_flow(landing.stream_files(spark, landing_path, files_per_batch), read, checkpoint)


def table_writer(path: str, partitions: list[str]) -> Callable[[DataFrame, int], None]:
    """Appends each micro-batch to a table as it is, in folders of its own."""
    return lambda rows, batch_id: _write_batch(rows, path, batch_id, partitions)


def finish(query: StreamingQuery, spark: SparkSession | None = None, log_path: str | None = None) -> None:
    """Wait for a triggered run and pass its error on.  With a log, the run leaves an entry there
    with its state, its begin and its end, also if it failed."""
    started = datetime.now(timezone.utc)
    problem = None
    try:
        query.awaitTermination()
        problem = query.exception()
    except StreamingQueryException as error:
        problem = error
    if log_path:
        maintenance.log_run(
            spark, log_path, run_id=str(query.runId), state="FAILED" if problem else "COMPLETED", started=started,
            finished=datetime.now(timezone.utc), ts=started, operation="RUN",
        )
    if problem is not None:
        raise problem
