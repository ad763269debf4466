"""The few file-system calls the table jobs need, through Hadoop so any store works."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    old, fs = _path(spark, source)
    new, _ = _path(spark, target)
    if not fs.rename(old, new):
        raise OSError(f"could not rename {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.mkdirs(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    target, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def partition_folder(spark: SparkSession, values: dict[str, str | None]) -> str:
    """Relative folder of a partition, named as Spark's writers name it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    none = "__HIVE_DEFAULT_PARTITION__"
    return "/".join(f"{escape(name)}={escape(value) if value else none}" for name, value in values.items())


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and modification time of every parquet file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
