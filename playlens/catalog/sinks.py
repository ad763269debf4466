"""Table sinks, catalog tables and confirmed jobs over copies of the layers, for the registered queries."""

from __future__ import annotations

import re
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..operators import repair
from ..plans import contracts
from ..plans.alerts import row_total
from ..sources import tables
from ..streaming import flows
from .lake import AS_OF, AS_OF_TS, Lake

FILE = "_metadata.file_path"


def rows_in_place(rows: DataFrame) -> DataFrame:
    """Rows of each quarantine partition, and whether all of them lie in a folder of its date and reason."""
    day = F.regexp_extract(FILE, r"/eventDate=([^/]+)/quarantine_reason=[^/]+/[^/]+$", 1)
    return (
        rows.withColumn("_here", day == F.col("eventDate").cast("string"))
        .groupBy(*tables.QUARANTINE_PARTITIONS)
        .agg(row_total("row_count"), F.bool_and("_here").alias("in_place"))
    )


def disjoint_files(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows of each date, and whether its files hold ranges of the layout keys that do not overlap.

    The rows fold to one line per file before the window, which runs within a date."""
    key = F.struct(*order)
    per_file = rows.groupBy("eventDate", F.col(FILE).alias("_file")).agg(
        row_total("_rows"), F.min(key).alias("_low"), F.max(key).alias("_high")
    )
    before = F.lag("_high").over(Window.partitionBy("eventDate").orderBy("_low", "_high"))
    placed = per_file.withColumn("_apart", F.coalesce(before < F.col("_low"), F.lit(True)))
    return placed.groupBy("eventDate").agg(F.sum("_rows").alias("row_count"), F.bool_and("_apart").alias("is_clustered"))


class Sinks:
    def __init__(self, lk: Lake):
        self.lake, self.spark, self.root = lk, lk.spark, f"{lk.root}/sinks"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def schema(self) -> str:
        """A schema of this application and input folder, its tables below the checkpoint folder."""
        name = "playlens_" + re.sub(r"\W", "_", "_".join(self.lake.root.split("/")[-2:]))
        tables.create_schema(self.spark, name, self.path("schema"))
        return name

    @cached_property
    def backup(self) -> str:
        """Name of a time-stamped copy of silver."""
        return tables.backup_table(self.lake.silver, f"{self.schema}.silver", datetime.fromisoformat(AS_OF_TS))

    @cached_property
    def alike(self) -> str:
        """Name of a table created like the copy and filled from it."""
        name = f"{self.schema}.silver_like"
        tables.create_like(self.spark, name, self.backup)
        if not self.spark.table(name).isEmpty():
            raise RuntimeError(f"{name} is not empty")
        self.spark.table(self.backup).write.insertInto(name)
        return name

    @cached_property
    def documented(self) -> str:
        """Name of a silver table with column comments and table properties."""
        name = f"{self.schema}.silver_documented"
        tables.create_table(self.spark, name, schemas.SILVER, ["eventDate"], {"quality": "silver", "as_of": AS_OF})
        self.lake.silver.select(*schemas.SILVER.names).write.insertInto(name, overwrite=True)
        return name

    def listed(self) -> DataFrame:
        """Tables of the schema with their rows.  A pass per table; a schema has few."""
        names = [n.split(".")[1] for n in (self.backup, self.alike, self.documented)]
        counted = [self.spark.table(f"{self.schema}.{n}").agg(row_total("row_count")).withColumn("tableName", F.lit(n)) for n in names]
        rows = counted[0].unionByName(counted[1]).unionByName(counted[2])
        return tables.list_tables(self.spark, self.schema).join(rows, "tableName", "left").select("tableName", "row_count")

    def described(self) -> DataFrame:
        """Columns of the documented table with type, comment and their NULLs."""
        rows = tables.describe(self.spark, self.documented).filter("data_type NOT IN ('data_type', '')").distinct()
        nulls = contracts.null_counts(self.spark.table(self.documented), schemas.SILVER.names)
        return rows.join(nulls, rows.col_name == nulls.column_name).select("col_name", "data_type", "comment", "null_count")

    def properties(self) -> DataFrame:
        """Properties of the documented table beside its rows."""
        kept = self.spark.sql(f"SHOW TBLPROPERTIES {self.documented}").filter("key IN ('quality', 'as_of')")
        rows = self.spark.table(self.documented).groupBy(F.lit("quality").alias("key")).agg(row_total("row_count"))
        return kept.join(rows, "key", "left").select("key", "value", "row_count")

    def viewed(self) -> DataFrame:
        """Silver by day through a temporary view, which is dropped again."""
        name = f"{self.schema}_view"
        tables.register_view(self.lake.silver, name)
        rows = self.spark.sql(f"SELECT eventDate, count(*) AS row_count, sum(total_source_data) AS bytes FROM {name} GROUP BY eventDate")
        tables.drop_view(self.spark, name)
        return rows

    @cached_property
    def reprocessed(self) -> Sinks:
        """Copies of silver and gold: the plan first, which writes nothing, then the confirmed job."""
        silver, gold = self.path("silver"), self.path("gold")
        for rows, path in ((self.lake.silver, silver), (self.lake.gold, gold)):
            tables.write_partitioned(rows, path, ["eventDate"])  # its files hold few dates
        before = tables.row_count(self.read("silver"))
        job = (self.spark, silver, gold, self.lake.quarantine, self.path("staging"), AS_OF)
        repair.reprocess(*job)
        if tables.row_count(self.read("silver")) != before:
            raise RuntimeError("a job that was not confirmed wrote rows")
        repair.reprocess(*job, confirm=True, distinct="exact")
        return self

    @cached_property
    def refreshed(self) -> DataFrame:
        """Silver of a full refresh: an empty folder and a new checkpoint, after incremental runs elsewhere."""
        bronze = self.lake.bronze
        for n, path in enumerate(("incremental", "incremental", "full")):
            rows = tables.stream_stored(self.spark, f"{self.lake.root}/bronze", bronze.schema)
            flows.finish(flows.silver_flow(rows, self.path(path), self.path(f"checkpoint-{path}"), "drop"))
            if n and tables.row_count(self.read(path)) != tables.row_count(self.read("incremental")):
                raise RuntimeError(f"{path} differs from the first run")
        return self.read("full")


_SINKS: dict[int, Sinks] = {}


def sinks(lk: Lake) -> Sinks:
    return _SINKS.setdefault(id(lk), Sinks(lk))
