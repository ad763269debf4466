"""Small helpers the operators share: stored intermediates, unused column names, running totals."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playlens.session import checkpoint_root

#: Stands for a missing integer id where rows are ordered by id: before every other.
NO_ID = -(2**63)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application: their Python need not have it
    installed or on its path."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    _SHIPPED.add(spark.sparkContext.applicationId)
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="playlens-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared checkpoint folder and read it back.

    It cuts the lineage: a lost executor loses nothing that is written.  The folder stays
    until the cluster clears its checkpoint folder, since later jobs read it lazily.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names like ``names`` that clash with none of ``taken`` in any letter case."""
    used, out = {n.lower() for n in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_key(text: Column) -> Column:
    """128 bits of a text as two longs; equal texts have equal keys."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))


def running_totals(
    df: DataFrame, key: str, values: list[str], ties: list[str], by: list[str] | None = None,
    widths: tuple[int, ...] = (10, 18, 18),
) -> DataFrame:
    """Adds ``before_<value>``: the sum of the rows that come earlier in the order of ``key``.

    No task sees all rows.  The integer key is cut into digits of ``widths`` bits, the lowest
    first: a window sums the rows inside a bucket of keys, the buckets' totals are summed in
    the same way inside the next larger bucket, and so on up to the highest 18 bits; what
    comes before a bucket is joined back.  Rows of one key are ordered by ``ties``.  ``by``
    columns (nulls equal) keep separate totals.  A missing key comes first.  ``df`` is read
    twice, so it should be a stored table.
    """
    by = by or []
    (low,) = fresh(df.columns, "_low")
    keyed = df.withColumn(low, F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)))
    return _with_totals(keyed, low, values, ties, by, widths).select(*df.columns, *[f"before_{v}" for v in values])


def _with_totals(df: DataFrame, key: str, values: list[str], ties: list[str], by: list[str], widths) -> DataFrame:
    group = [*by]
    if widths:
        (cut,) = fresh(df.columns, "_cut")
        df = df.withColumn(cut, F.shiftright(key, widths[0]))
        group.append(cut)
    window = Window.partitionBy(*group).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    here = df.select(
        "*", *[F.coalesce(F.sum(v).over(window), F.lit(0)).cast("long").alias(f"before_{v}") for v in values]
    )
    if not widths:
        return here
    totals = df.groupBy(*group).agg(*[F.sum(v).alias(v) for v in values])
    above = _with_totals(totals, cut, values, [], by, widths[1:])
    above = above.select(*[F.col(c).alias(f"{c}__above") for c in [*group, *[f"before_{v}" for v in values]]])
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}__above"))
    sums = [(F.col(f"before_{v}") + F.col(f"before_{v}__above")).alias(f"before_{v}") for v in values]
    return here.join(above, same).select(*df.columns, *sums)


def freeing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; Arrow's unused memory goes back to the system between them, as Python workers
    live on from task to task and from job to job."""
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()


def slices(texts: pa.Array, limit: int, rows: int = 20_000, also: pa.Array | None = None) -> Iterator[tuple[int, int]]:
    """Cuts a batch into runs of at most ``rows`` rows and about ``limit`` bytes, those of ``also`` counted as
    well; one long row is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0)
    if also is not None:
        sizes = pc.add(sizes.cast(pa.int64()), pc.fill_null(pc.binary_length(also), 0).cast(pa.int64()))
    sizes = sizes.to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and (total + size > limit or i - start == rows):
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
