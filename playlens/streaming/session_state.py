"""Totals of running sessions, kept up to date by triggered runs.

Every signal is stored.  A micro-batch adds its signals to the store and computes the sessions it
touches anew from their stored signals with ``plans.sessions.buffer_timeline``, in order and
over as many tasks as a long session needs.  So a signal may come late by any time, before or
after its successors, and a session may go on after any pause: the totals are those of all
signals so far, as a batch job would find them.

The store is partitioned by the signals' day.  The totals of a session carry its first and last
day, so a micro-batch opens the days of the sessions it touches and no others.  Signals and
totals are written to folders per micro-batch, which a replay overwrites.

A NULL session is a session of its own.  Signals without a time stand on day 1970-01-01.  A
micro-batch without signals changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import CHUNK_WIDTH
from ..plans.sessions import SEQ, SESSION, buffer_timeline
from ..sources import files, tables
from ..sources.tables import BATCH

DAY = "signal_day"
#: What the totals of a session need.
NEEDED = [*SESSION, SEQ, "event_timestamp", "eventType"]
TOTALS = ["lastSequence", "totalRebufferMs", "stallCount", "startupStallCount", "signal_count"]


def _day():
    return F.coalesce(F.to_date(F.timestamp_millis("event_timestamp")), F.lit("1970-01-01").cast("date"))


def session_totals(signals: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """One row per session with its totals after its last signal."""
    timeline = buffer_timeline(signals, width)
    return timeline.groupBy(*SESSION).agg(
        F.max(SEQ).alias("lastSequence"),
        *[F.max(name).alias(name) for name in TOTALS[1:4]],
        F.count(F.lit(1)).alias("signal_count"),
    )


def _same_session(other: DataFrame) -> DataFrame:
    return other.select(F.col(SESSION[0]).alias("_session")).distinct()


def session_handler(spark: SparkSession, store: str, totals: str, width: int = CHUNK_WIDTH) -> Callable[[DataFrame, int], None]:
    """For ``flows.routed_flow`` over signals: stores a micro-batch and writes the totals it changes."""

    def handle(signals: DataFrame, batch_id: int) -> None:
        mark = F.lit(batch_id).cast("int")
        rows = signals.select(*NEEDED, _day().alias(DAY), mark.alias(BATCH))
        tables.write_partitioned(tables.packed(rows, [DAY, BATCH]), store, [DAY, BATCH])
        stored = spark.read.schema(rows.schema).parquet(store)
        new = stored.filter(F.col(BATCH) == batch_id)
        days = new.groupBy(*SESSION).agg(F.min(DAY).alias("first_day"), F.max(DAY).alias("last_day"))
        if files.exists(spark, totals):
            known = spark.read.parquet(totals).filter(F.col(BATCH) < batch_id)
            touched = _same_session(new)
            before = known.join(touched, F.col(SESSION[0]).eqNullSafe(F.col("_session")), "left_semi")
            days = days.unionByName(before.select(*days.columns))
        days = days.groupBy(*SESSION).agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
        first, last = days.agg(F.min("first_day"), F.max("last_day")).first()
        if first is None:
            return
        # the days are literals, so other folders of the store are not opened
        history = stored.filter(F.col(DAY).between(F.lit(first), F.lit(last)) & (F.col(BATCH) <= batch_id))
        history = history.join(_same_session(new), F.col(SESSION[0]).eqNullSafe(F.col("_session")), "left_semi")
        # every pass over the order reads its input twice
        found = session_totals(tables.staged(history.select(*NEEDED), "session-history"), width)
        dated = days.select(F.col(SESSION[0]).alias("_session"), "first_day", "last_day")
        found = found.join(dated, F.col(SESSION[0]).eqNullSafe(F.col("_session"))).drop("_session")
        tables.write_partitioned(found.withColumn(BATCH, mark), totals, [BATCH])

    return handle


def current_totals(spark: SparkSession, totals: str) -> DataFrame:
    """The latest totals of every session."""
    rows = spark.read.parquet(totals)
    latest = F.max_by(F.struct(*TOTALS, "first_day", "last_day"), BATCH)
    return rows.groupBy(*SESSION).agg(latest.alias("_now")).select(*SESSION, "_now.*")
