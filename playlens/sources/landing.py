"""Landing zone: typed ingest of report files, schema growth and rescued values."""

from __future__ import annotations

import json
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from . import files
from ..functions.frames import settle


RESCUED = "_rescued_data"


LEDGER = "path string, length bigint, modified timestamp, schema string"
LEDGER_NAMES = ["path", "length", "modified", "schema"]


def read_reports(spark: SparkSession, path: str, ledger: str | None = None) -> DataFrame:
    """Batch read of ``eventDate=*`` folders that loses nothing.

    Hinted fields have their contract types.  Columns that some files add come after them,
    NULL elsewhere.  Where a file holds a hinted field in another type its values are cast;
    those that do not fit are kept in ``_rescued_data`` as a JSON object by column.

    Footers are read in tasks, one Spark job for all files that agree.  With a ``ledger``, a
    table of the files seen so far and their schemas, only new files are looked at.
    """
    if ledger:
        return _aligned(spark, path, list(_known_groups(spark, path, ledger)))
    return _aligned(spark, path, _by_schema(spark, path))


def read_files(spark: SparkSession, path: str, names: list[str], audit: bool = False) -> DataFrame:
    """The given files of the landing zone, as ``read_reports`` reads them all; ``audit`` adds when
    a row came in and from which file."""
    return _aligned(spark, path, _groups(spark, path, names), audit)


def _aligned(spark: SparkSession, path: str, groups: list[tuple[T.StructType, list[str]]], audit: bool = False) -> DataFrame:
    def rows(schema: T.StructType, parts: list[str]) -> DataFrame:
        found = spark.read.schema(schema).option("basePath", path).parquet(*parts)
        return with_audit(found) if audit else found

    frames = [align(rows(s, parts), schemas.BRONZE) for s, parts in groups]
    if not frames:
        return align(rows(schemas.BRONZE, [path]), schemas.BRONZE)
    return reduce(union_evolved, frames)


def _by_schema(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """The date folders by schema; a folder whose own files differ comes apart into files."""
    folders = [f"{path}/{name}" for name in files.subfolders(spark, path) if name.startswith("eventDate=")]
    return _groups(spark, path, folders)


def _groups(spark: SparkSession, path: str, parts: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Parts (files or folders) whose columns agree in type, with the schema of all their columns.

    One job reads the footers of all parts.  Only where types differ are the parts halved and
    read again, so k odd files among n cost about k log n jobs, and none if all agree.  There
    are as many groups as there are types in conflict, not as many as parts."""
    if not parts:
        return []
    try:
        schema = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*parts).schema
        return [(schema, parts)]
    except (Py4JJavaError, PySparkException) as problem:
        if "CANNOT_MERGE_SCHEMAS" not in str(problem):
            raise
    if len(parts) == 1:
        parts = [r.path for r in files.data_files(spark, parts[0]).select("path").collect()]
    half = len(parts) // 2
    groups: list[tuple[T.StructType, list[str]]] = []
    for schema, names in [*_groups(spark, path, parts[:half]), *_groups(spark, path, parts[half:])]:
        for i, (known, others) in enumerate(groups):
            both = _joined(known, schema)
            if both is not None:
                groups[i] = both, [*others, *names]
                break
        else:
            groups.append((schema, names))
    return groups


def _joined(one: T.StructType, other: T.StructType) -> T.StructType | None:
    """The columns of both, or None where a column has two types."""
    kinds = {f.name: f.dataType for f in one}
    if any(kinds.get(f.name, f.dataType) != f.dataType for f in other):
        return None
    return T.StructType([*one, *[f for f in other if f.name not in kinds]])


def _known_groups(spark: SparkSession, path: str, ledger: str) -> list[tuple[T.StructType, list[str]]]:
    """Extends the ledger by the files it lacks and returns all of its files by schema."""
    found = files.data_files(spark, path)
    known = spark.read.schema(LEDGER).parquet(ledger) if files.exists(spark, ledger) else spark.createDataFrame([], LEDGER)
    # a file that was written anew under its old name counts as new
    key = ["path", "length", "modified"]
    # in the order of their writing, in which files of one schema follow each other
    fresh = [r.path for r in found.join(known.select(*key), key, "left_anti").orderBy("modified", "path").select("path").collect()]
    if fresh:
        rows = [(name, schema.json()) for schema, names in _groups(spark, path, fresh) for name in names]
        added = spark.createDataFrame(rows, "path string, schema string").join(found, "path")
        added.select(*LEDGER_NAMES).coalesce(1).write.mode("append").parquet(ledger)
        known = spark.read.schema(LEDGER).parquet(ledger)
    groups: list[tuple[T.StructType, list[str]]] = []
    live = known.join(found.select(*key), key, "left_semi")
    for text, names in live.groupBy("schema").agg(F.sort_array(F.collect_set("path"))).orderBy("schema").collect():
        groups.append((T.StructType.fromJson(json.loads(text)), names))
    return groups


def align(df: DataFrame, hinted: T.StructType) -> DataFrame:
    """Hinted fields first with their types (NULL where absent), then any further columns;
    values that do not fit their type go to ``_rescued_data``."""
    kinds = {f.name: f.dataType for f in df.schema}
    fixed, lost = [], []
    for f in hinted:
        if f.name == RESCUED:
            continue
        if f.name not in kinds:
            fixed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f.name)
        if kinds[f.name] == f.dataType:
            fixed.append(value)
        elif isinstance(f.dataType, T.AtomicType) and isinstance(kinds[f.name], T.AtomicType):
            fixed.append(value.try_cast(f.dataType).alias(f.name))
            lost.append(F.when(value.try_cast(f.dataType).isNull(), value).alias(f.name))
        else:  # nested: by way of JSON, which drops what does not fit
            cast = F.from_json(F.to_json(F.struct(value)), T.StructType([f]))[f.name]
            fixed.append(cast.alias(f.name))
            same = F.to_json(F.struct(cast.alias(f.name))).eqNullSafe(F.to_json(F.struct(value)))
            lost.append(F.when(~same, value).alias(f.name))
    known = F.col(RESCUED) if RESCUED in kinds else F.lit(None).cast("string")
    rescued = F.nullif(F.to_json(F.struct(*lost)), F.lit("{}")) if lost else F.lit(None).cast("string")
    rest = [c for c in df.columns if c not in hinted.names and c != RESCUED]
    return df.select(*fixed, F.coalesce(rescued, known).alias(RESCUED), *rest)


def widened(spark: SparkSession, path: str, hinted: T.StructType = schemas.BRONZE) -> T.StructType:
    """The hinted schema and the columns that files in the landing zone have besides."""
    found = [f for schema, _ in _by_schema(spark, path) for f in schema if f.name not in hinted.names]
    return T.StructType([*hinted, *{f.name: f for f in found}.values()])


def added_columns(df: DataFrame, hinted: T.StructType = schemas.BRONZE) -> list[str]:
    return [c for c in df.columns if c not in hinted.names]


def union_evolved(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Append rows whose schema has grown; missing columns are NULL."""
    return older.unionByName(newer, allowMissingColumns=True)


def stream_reports(
    spark: SparkSession, path: str, files_per_batch: int = 1000, schema: T.StructType | None = None
) -> DataFrame:
    """Incremental read: the file source log and the checkpoint remember what was taken.

    The schema is the hinted one, widened by the columns the files have when the run starts; a
    triggered run thus takes columns along that were added since the last one.  A file that
    holds a hinted field in a type which cannot be read as the hinted one stops the run; a
    stream of ``stream_files`` reads such files too.
    """
    return (
        spark.readStream.schema(schema or widened(spark, path))
        .option("basePath", path)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def stream_files(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Names of the files as they arrive, ``files_per_batch`` at most in a micro-batch.  Contents are
    not read here, so a file of any schema passes; ``flows.ingest_flow`` reads them."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select("path")
    )


def with_audit(df: DataFrame) -> DataFrame:
    """When a row came in and from which file."""
    return df.select(
        "*", F.current_timestamp().alias("_ingest_timestamp"), F.col("_metadata.file_path").alias("_source_file")
    )


def cast_report(df: DataFrame, hinted: T.StructType) -> DataFrame:
    """Per hinted column: values present, values that do not fit the type.  One pass."""
    flat = [f for f in hinted if f.name in df.columns and isinstance(f.dataType, T.AtomicType)]
    lost = {f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in flat}
    totals = df.agg(
        *[F.count(F.col(f.name)).alias(f"{f.name}__n") for f in flat],
        *[F.count_if(lost[f.name]).alias(f"{f.name}__lost") for f in flat],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("hinted_type"),
                F.col(f"{f.name}__n").alias("present"),
                F.col(f"{f.name}__lost").alias("not_castable"),
            )
            for f in flat
        ]
    )
    return totals.select(F.inline(lines))


def rescue(df: DataFrame, json_column: str, hinted: T.StructType, rescued: str = "_rescued_data") -> DataFrame:
    """Type JSON records against the hinted fields and keep what does not fit.

    Values that fail their cast and members the schema does not name are written to the
    rescued column as a JSON object; a record that is no JSON object is kept there whole.
    """
    members = F.from_json(json_column, "MAP<STRING, STRING>")
    taken = settle(df, {"_members": members}, keep=df.columns)

    def typed(field: T.StructField):
        text = F.col("_members")[field.name]
        if isinstance(field.dataType, T.AtomicType):
            return text.try_cast(field.dataType)
        return F.from_json(text, field.dataType.simpleString())

    with_types = taken.select("*", *[typed(f).alias(f.name) for f in hinted])
    unfit = F.lit(False)
    names = F.array(*[F.lit(f.name) for f in hinted])

    def keep(key, text):
        lost = unfit
        for f in hinted:
            lost = lost | ((key == f.name) & F.col(f.name).isNull())
        return text.isNotNull() & (lost | ~F.array_contains(names, key))

    left = F.map_filter("_members", keep)
    broken = F.col("_members").isNull() & F.col(json_column).isNotNull()
    content = F.when(broken, F.col(json_column)).when(F.size(left) > 0, F.to_json(left))
    return with_types.withColumn(rescued, content).drop("_members")
