"""Stored layers for the registered queries.

Reports read tables, as they would in production.  The layers are derived from ``events``
by Spark, once per session and input folder, and written below the shared checkpoint
folder: partitioned by date, so that a report over the last days opens only those days.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import medallion
from ..session import checkpoint_root, configure
from ..sources import adapter, tables

#: "Now" of every registered query; the data ends on this day.
AS_OF = "2024-01-30"
AS_OF_TS = "2024-01-31 00:00:00"
AS_OF_MS = 1706659200000


class Lake:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder
        tag = hashlib.sha256(folder.encode()).hexdigest()[:12]
        self.root = f"{checkpoint_root(spark)}/playlens/{spark.sparkContext.applicationId}/{tag}"

    @property
    def events(self) -> DataFrame:
        return adapter.spread(adapter.read_table(self.spark, self.folder, "events"), "ts")

    def _store(self, name: str, write: Callable[[str], None]) -> DataFrame:
        path = f"{self.root}/{name}"
        write(path)
        return self.spark.read.parquet(path)

    @cached_property
    def bronze(self) -> DataFrame:
        # the slim events are dealt out by time, so the wide rows are written as they lie
        rows = adapter.bronze_reports(self.events)
        return self._store("bronze", lambda path: tables.write_partitioned(rows, path, ["eventDate"]))

    @cached_property
    def silver(self) -> DataFrame:
        rows = medallion.silver_enriched(self.bronze, "drop")
        spread = ["timestamp_server"]
        return self._store("silver", lambda path: tables.write_clustered(rows, path, tables.CLUSTER_KEYS["silver"], spread))

    @cached_property
    def quarantine(self) -> DataFrame:
        stamp = F.timestamp_millis(F.lit(AS_OF_MS))
        rows = medallion.quarantine(self.bronze, stamp)
        return self._store(
            "quarantine",
            lambda path: tables.write_partitioned(
                tables.packed(rows, tables.QUARANTINE_PARTITIONS), path, tables.QUARANTINE_PARTITIONS
            ),
        )

    @cached_property
    def gold(self) -> DataFrame:
        rows = medallion.gold_viewer_qos(self.silver, "exact")
        return self._store("gold", lambda path: tables.write_clustered(rows, path, tables.CLUSTER_KEYS["gold"]))

    @cached_property
    def signals(self) -> DataFrame:
        rows = adapter.player_signals(self.events)
        return self._store("signals", lambda path: tables.write_partitioned(rows, path, ["eventDate"]))

    @cached_property
    def bodies(self) -> DataFrame:
        rows = adapter.event_bodies(self.events)
        return self._store("bodies", lambda path: rows.write.mode("overwrite").parquet(path))

    def paths(self) -> dict[str, str]:
        for name in ("bronze", "silver", "quarantine", "gold"):
            getattr(self, name)
        return {name: f"{self.root}/{name}" for name in ("bronze", "silver", "quarantine", "gold")}


_LAKES: dict[tuple[str, str], Lake] = {}


def lake(spark: SparkSession, folder: str) -> Lake:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _LAKES:
        _LAKES[key] = Lake(spark, folder)
    configure(spark)
    return _LAKES[key]
