"""Table sinks and catalog helpers on parquet."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_root
from . import files

# Layout keys of the tables.
CLUSTER_KEYS = {
    "bronze": ["eventDate", "customerId"],
    "silver": ["eventDate", "customerId", "clientId"],
    "gold": ["eventDate", "customerId", "clientId"],
}
QUARANTINE_PARTITIONS = ["eventDate", "quarantine_reason"]

#: Folder level of tables that streams append to, and the value merged rows carry.
BATCH = "ingest_batch"
MERGED_BATCH = -1


def layout(df: DataFrame, usual: list[str]) -> list[str]:
    """Partition columns of a stored table: streamed ones have a folder per batch."""
    return ["eventDate", BATCH] if BATCH in df.columns else usual


def write_partitioned(df: DataFrame, path: str, partitions: list[str], mode: str = "overwrite") -> None:
    """Hive-style partitions.  Overwrite is dynamic: only partitions present in ``df``."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def packed(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Gather the rows of a partition before writing, so that it gets few, full files.

    A rebalance is not a plain repartition: AQE merges small partitions and cuts one that
    holds a large share of the rows into several tasks.
    """
    return df.hint("rebalance", *[F.col(name) for name in partitions])


def clustered(df: DataFrame, keys: list[str], spread: list[str] | None = None) -> DataFrame:
    """Range-partition and sort by the layout keys, so that file statistics prune.

    ``spread`` columns follow the keys in the range order and split a key that holds a
    large share of the rows over several tasks.
    """
    order = [*keys, *(spread or [])]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_clustered(
    df: DataFrame, path: str, keys: list[str], spread: list[str] | None = None, mode: str = "overwrite"
) -> None:
    write_partitioned(clustered(df, keys, spread), path, ["eventDate"], mode)


def same_columns(left: T.StructType, right: T.StructType) -> bool:
    return {(f.name, f.dataType) for f in left} == {(f.name, f.dataType) for f in right}


def replace_table(
    spark: SparkSession, df: DataFrame, path: str, partitions: list[str] | None = None, grown: bool = False
) -> None:
    """Overwrite a table that may also be the input of ``df``, keeping its schema (``grown``:
    columns may be added).

    The new rows go to a sibling folder first; the old folder is moved aside, the new one
    moved in, and only then is the old one removed.  A crash leaves one complete copy, which
    ``recover_table`` moves back if it was between the two moves.
    """
    current = spark.read.parquet(path).schema
    if not (same_columns(current, df.schema) or grown and set(current.names) <= set(df.columns)):
        raise ValueError("replacement has a different schema")
    if partitions:
        df = packed(df, partitions)
    fresh, old = f"{path}.new", f"{path}.old"
    for leftover in (fresh, old):
        if files.exists(spark, leftover):
            files.delete(spark, leftover)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(fresh)
    files.rename(spark, path, old)
    files.rename(spark, fresh, path)
    files.delete(spark, old)


def swap_folder(spark: SparkSession, fresh: str, table: str, name: str) -> None:
    """Put the folder ``fresh`` in the place of ``table``/``name``, which is moved aside first."""
    aside = f"{table}.old"
    files.make_folder(spark, aside)
    files.rename(spark, f"{table}/{name}", f"{aside}/{name}")
    files.rename(spark, fresh, f"{table}/{name}")
    files.delete(spark, f"{aside}/{name}")


def recover_folders(spark: SparkSession, table: str) -> list[str]:
    """After a crash within ``swap_folder``: folders that are missing from the table go back to
    it, others that were left aside go; returns the names put back."""
    aside, back = f"{table}.old", []
    for name in files.subfolders(spark, aside) if files.exists(spark, aside) else []:
        if files.exists(spark, f"{table}/{name}"):
            files.delete(spark, f"{aside}/{name}")
        else:
            files.rename(spark, f"{aside}/{name}", f"{table}/{name}")
            back.append(name)
    return back


def recover_table(spark: SparkSession, path: str) -> bool:
    """After a crash within ``replace_table``: move the complete copy back; True if one was needed."""
    if files.exists(spark, path) or not files.exists(spark, f"{path}.old"):
        return False
    files.rename(spark, f"{path}.old", path)
    return True


def backup_table(df: DataFrame, table: str, moment: datetime | None = None) -> str:
    """Copy under a time-stamped name; returns the name."""
    name = f"{table}_backup_{(moment or datetime.now()).strftime('%Y%m%d_%H%M%S')}"
    df.write.mode("errorifexists").format("parquet").saveAsTable(name)
    return name


def create_like(spark: SparkSession, new: str, existing: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {new} LIKE {existing}")


def create_empty(spark: SparkSession, path: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, partitions: list[str], properties: dict[str, str]
) -> None:
    """Catalog table with column comments and table properties."""

    def column(field: T.StructField) -> str:
        note = field.metadata.get("comment", "")
        null = "" if field.nullable else " NOT NULL"
        comment = f" COMMENT '{note}'" if note else ""
        return f"{field.name} {field.dataType.simpleString()}{null}{comment}"

    columns = ", ".join(column(f) for f in schema)
    props = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        + (f" PARTITIONED BY ({', '.join(partitions)})" if partitions else "")
        + (f" TBLPROPERTIES ({props})" if props else "")
    )


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Schema of that name; ``location`` is the folder of its tables, else one in the warehouse."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}").select("namespace", "tableName")


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the checkpoint folder and read it back: what follows may
    read it several times and computes it once."""
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stream_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def row_count(df: DataFrame) -> int:
    """Counted on the cluster; one number comes back."""
    return df.agg(F.count(F.lit(1))).first()[0]
