"""Token counts: an exact histogram of encoded lengths, and what its suffix sums answer.

``encoded_lengths`` counts the tokens of every whole text; ``length_histogram`` folds them to
one row per length (map-side first, so a hot source or length is no large group).  Suffix
sums over the histogram give, for each length L taken as a context limit: the documents of at
least L tokens and their tokens, and ``truncated_total``, the tokens left when every document
is cut to L.  ``share_up_to`` is the share of documents of at most L tokens, from which
``quantile`` reads the length at any rank.  All figures are whole numbers or their ratio.

Null or empty text has length 0.  An empty table gives an empty histogram.  Each repeated row
counts.  Other columns are ignored; a null group is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_totals, written
from .encoding import over_texts, shared_spec, tokenizers_encoder


def encoded_lengths(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``n_tokens`` of every document."""
    spec = shared_spec(docs.sparkSession, tokenizer)
    rows = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("text"))
    rows = rows.toDF(*[f"k{i}" for i in range(len(keep))], "text")

    def counts(texts: list[str]) -> dict:
        encoder = tokenizers_encoder(spec.value)
        sizes = np.fromiter((len(x) // 4 for x in encoder.encode(texts)), np.int64, len(texts))
        return {"n_tokens": pa.array(sizes)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != "text"]
            fields = [batch.schema.field(n) for n in names]
            yield from over_texts(iter([batch]), pa.schema([*fields, pa.field("n_tokens", pa.int64())]), counts)

    schema = ", ".join([f"k{i} {rows.schema[i].dataType.simpleString()}" for i in range(len(keep))] + ["n_tokens long"])
    return rows.mapInArrow(count, schema).toDF(*keep, "n_tokens")


def length_histogram(lengths: DataFrame, by: list[str]) -> DataFrame:
    """One row per group and length with counts, running and suffix sums."""
    bins = lengths.groupBy(*by, "n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    bins = written(bins.withColumn("tokens", F.col("n_docs") * F.col("n_tokens")), "lengths")
    sums = running_totals(bins, "n_tokens", ["n_docs", "tokens"], [], by)
    whole = bins.groupBy(*by).agg(F.sum("n_docs").alias("_docs"), F.sum("tokens").alias("_tokens"))
    whole = whole.select(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], "_docs", "_tokens")
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    at_least = F.col("_docs") - F.col("before_n_docs")
    return sums.join(whole, same).select(
        *by,
        "n_tokens",
        "n_docs",
        at_least.alias("docs_at_least"),
        (F.col("_tokens") - F.col("before_tokens")).alias("tokens_at_least"),
        (F.col("before_tokens") + F.col("n_tokens") * at_least).alias("truncated_total"),
        F.col("_docs").alias("docs_total"),
        F.col("_tokens").alias("tokens_total"),
        ((F.col("before_n_docs") + F.col("n_docs")) / F.col("_docs")).alias("share_up_to"),
    )


def quantile(histogram: DataFrame, by: list[str], share: float) -> DataFrame:
    """The smallest length that at least ``share`` of a group's documents do not exceed."""
    enough = histogram.filter(F.col("share_up_to") >= F.lit(share))
    return enough.groupBy(*by).agg(F.min("n_tokens").alias("n_tokens"))


def truncated_total(histogram: DataFrame, limit: int | Column) -> Column:
    """Tokens left at a context limit, as an aggregate over a histogram's rows."""
    return F.sum(F.col("n_docs") * F.least(F.col("n_tokens"), F.lit(limit) if isinstance(limit, int) else limit))
