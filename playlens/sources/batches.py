"""Collector request bodies: ``{"events": [...]}`` to one row per event, rejects apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.frames import settle

_CORRUPT = "_corrupt_body"
_ENVELOPE = f"events ARRAY<{schemas.PLAYBACK_EVENT.simpleString()}>, {_CORRUPT} STRING"


def read_bodies(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """One body per file, or one per line where a collector appends many to a file."""
    return spark.read.text(path, wholetext=whole_files).withColumnRenamed("value", "body")


def stream_bodies(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    return spark.readStream.text(path, wholetext=whole_files).withColumnRenamed("value", "body")


def parse_bodies(bodies: DataFrame) -> DataFrame:
    """Typed events, a flag for bodies that cannot be read, and the batch size (0 if absent).

    A member of the wrong type becomes NULL without spoiling its neighbours; it also marks
    the record as corrupt, so a body counts as rejected only if its events are lost as well.
    The body is parsed once.
    """
    parsed = F.from_json("body", _ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    once = settle(bodies, {"_parsed": parsed}, keep=bodies.columns)
    events = F.col("_parsed.events")
    return once.select(
        *bodies.columns,
        events.alias("events"),
        (F.col("body").isNull() | (events.isNull() & F.col(f"_parsed.{_CORRUPT}").isNotNull())).alias("is_rejected"),
        F.coalesce(F.size(events), F.lit(0)).alias("batch_size"),
    )


def unpack_events(parsed: DataFrame) -> DataFrame:
    """One row per event of the bodies that could be read."""
    keys = [c for c in parsed.columns if c not in {"events", "is_rejected", "batch_size", "body"}]
    rows = parsed.filter(~F.col("is_rejected")).select(
        *keys, "batch_size", F.posexplode("events").alias("position", "event")
    )
    return rows.select(*keys, "batch_size", "position", "event.*")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_rejected").drop("events", "is_rejected", "batch_size")
