"""Triggered runs over files dealt out of ``events``, for the registered queries of flows and sinks.

The rows arrive in three portions, dealt by event id, so every portion has rows of every day and
those of the second and third are late for all of them.  The second portion's files have an
added column, the third one's hold the customer in another type.  After each portion a run takes
what is new; each is a query of its own on the same checkpoint, as after a restart.  The last run
finds nothing.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import maintenance, repair
from ..plans import collected
from ..sources import adapter, batches, landing, tables
from ..streaming import flows, session_state
from .lake import AS_OF, Lake

PORTIONS = 3
LAYERS = ("silver", "quarantine", "gold")


class Runs:
    def __init__(self, lk: Lake):
        self.lake, self.spark, self.root = lk, lk.spark, f"{lk.root}/runs"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", name == "bronze").parquet(self.path(name))

    @cached_property
    def flow(self) -> Runs:
        """Landing zone to bronze, silver, quarantine and gold."""
        zone, log = self.path("landing"), self.path("log")
        write = flows.table_writer(self.path("bronze"), ["eventDate"])
        route = flows.route_batch(
            self.spark, *[self.path(name) for name in LAYERS], self.path("staging"), log, "drop", "exact", LAYERS
        )

        def handle(bronze: DataFrame, batch_id: int) -> None:
            write(bronze, batch_id)
            route(bronze, batch_id)

        for n in range(PORTIONS + 1):
            if n < PORTIONS:
                tables.write_partitioned(self._portion(n), zone, ["eventDate"], mode="append")
            flows.finish(flows.ingest_flow(self.spark, zone, handle, self.path("checkpoint")), self.spark, log)
        return self

    def _portion(self, n: int) -> DataFrame:
        rows = adapter.bronze_reports(self.lake.events.filter(F.col("event_id") % PORTIONS == n))
        if n == 1:
            return rows.withColumn("cdn", F.lit("edge"))
        return rows.withColumn("customerId", F.col("customerId").cast("binary")) if n == 2 else rows

    @cached_property
    def ledger(self) -> DataFrame:
        """The landing zone of ``flow`` by a batch read with a ledger."""
        return landing.read_reports(self.spark, self.flow.path("landing"), self.path("ledger"))

    @cached_property
    def from_table(self) -> DataFrame:
        """Quarantine from a stream over the bronze table."""
        schema = self.flow.read("bronze").schema
        rows = tables.stream_stored(self.spark, self.path("bronze"), schema)
        flows.finish(flows.quarantine_flow(rows, self.path("quarantine-2"), self.path("checkpoint-2")))
        return self.read("quarantine-2")

    @cached_property
    def sessions(self) -> DataFrame:
        """Totals of running sessions."""
        zone = self.path("signals")
        handle = session_state.session_handler(self.spark, self.path("signal-store"), self.path("totals"))
        for n in range(PORTIONS + 1):
            if n < PORTIONS:
                part = self.lake.signals.filter(F.col("sequenceNumber") % PORTIONS == (2 * n + 1) % PORTIONS)
                part.select(*session_state.NEEDED).write.mode("append").parquet(zone)
            rows = tables.stream_stored(self.spark, zone, self.lake.signals.select(*session_state.NEEDED).schema)
            flows.finish(flows.routed_flow(rows, handle, self.path("checkpoint-3")))
        return session_state.current_totals(self.spark, self.path("totals"))

    @cached_property
    def posted(self) -> DataFrame:
        """Events unpacked from the bodies that collectors would post for the signals."""
        bodies = collected.posted_bodies(self.lake.signals)
        bodies.write.mode("overwrite").parquet(self.path("posted-bodies"))
        events = batches.unpack_events(batches.parse_bodies(self.read("posted-bodies")))
        events.write.mode("overwrite").parquet(self.path("posted-events"))
        return self.read("posted-events")

    @cached_property
    def archived(self) -> Runs:
        """A copy of quarantine whose reprocessed rows are archived: half of them, then all, then again."""
        copy, box = self.path("quarantine-copy"), self.path("archive")
        rows = self.lake.quarantine
        tables.write_partitioned(tables.packed(rows, tables.QUARANTINE_PARTITIONS), copy, tables.QUARANTINE_PARTITIONS)
        done = repair.merge_source(rows, AS_OF)
        for part in (done.filter("quality_level = '360p'"), done, done):
            repair.clean_up(self.spark, copy, part, "archive", True, archive_path=box)
        return self

    @cached_property
    def compacted(self) -> DataFrame:
        """A copy of the silver that the runs wrote, its batch folders packed."""
        rows, path = self.flow.read("silver"), self.path("silver-copy")
        tables.write_partitioned(rows, path, tables.layout(rows, ["eventDate"]))
        maintenance.compact(self.spark, path, self.path("compact-staging"))
        return self.spark.read.parquet(path)


_RUNS: dict[int, Runs] = {}


def runs(lk: Lake) -> Runs:
    return _RUNS.setdefault(id(lk), Runs(lk))
