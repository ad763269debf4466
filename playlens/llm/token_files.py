"""Token-id output: ORC files in the order of the document ids.

``write_tokens`` range-partitions documents by id, encodes each text, appends an end id and
writes one row (``doc_id``, ``ids``) per document.  ORC stores the ids by integer run-length
encoding; its row index and the Bloom filter on ``doc_id`` let a reader skip stripes and row
groups, and stripes are read in parallel.  ``read_tokens`` returns the rows of the files,
``token_rows`` a row of facts per document, ``lookup`` a few documents by id.

Null text counts as empty: its row holds the end id alone.  An empty table writes files
without rows.  Rows with the same id follow each other; rows without an id come first.  Very
long texts are encoded piece by piece.  Other columns of the documents are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import running_totals, written
from .encoding import over_texts, shared_spec, tokenizers_encoder

ORC_OPTIONS = {
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "zstd",
}
FILE_SCHEMA = "doc_id long, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Write the ids of every text with the end id behind them, in ascending order of id."""
    spec = shared_spec(docs.sparkSession, tokenizer)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    end = np.array([end_id], "<u4").tobytes()

    def ids(texts: list[str]) -> dict:
        found = [x + end for x in tokenizers_encoder(spec.value).encode(texts)]
        sizes = np.fromiter((len(x) // 4 for x in found), np.int32, len(found))
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        values = np.frombuffer(b"".join(found), "<i4")
        return {"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from over_texts(batches, schema, ids)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    rows.mapInArrow(encode, FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; a filter on ``doc_id`` prunes files, stripes and row groups."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The stored rows of a few documents."""
    return read_tokens(spark, path).filter(F.col("doc_id").isin(ids))


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False)).astype("<i4", copy=False)
            bounds = lists.offsets.to_numpy().tolist()
            view = memoryview(values).cast("B")
            crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])]
            counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(crcs, pa.int64())], schema=schema
            )

    rows = read_tokens(spark, path).mapInArrow(facts, "doc_id long, n_tokens long, ids_crc32 long")
    rows = written(rows, "token-rows")
    found = running_totals(rows, "doc_id", ["n_tokens"], ["n_tokens", "ids_crc32"])
    return found.select("doc_id", F.col("before_n_tokens").alias("start"), "n_tokens", "ids_crc32")
