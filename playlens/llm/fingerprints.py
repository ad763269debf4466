"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range.  Whether a hash
is kept depends on nothing else, so the sketch of joined texts is the union of sketches, and
the share of a small text's hashes found in a large one estimates containment however unequal
the two are.  A fingerprint is written as text: ``<shingles>.<sum of their hashes>.<kept
hashes>``, twelve hex digits per hash, ascending.  The first two parts tell texts apart that
are too short to have a kept hash.

Null text counts as empty and has the fingerprint ``0.0.``.  Repeated rows are fingerprinted
each.  Likeness is 1 for equal shingles; 0 if one of two different texts keeps no hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, ship, slices
from .shingles import HASH_BITS, distinct, shingles

FRACTION = 0.5
SLICE_BYTES = 2 << 20
_DIGITS = HASH_BITS // 4


def sketch(texts: pa.Array, fraction: float = FRACTION) -> tuple[list[str], list[np.ndarray]]:
    """Fingerprint and kept hashes of each text."""
    hashes, counts = shingles(texts)
    ends = np.cumsum(counts)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes, dtype=np.uint64)])
    totals = sums[ends] - sums[ends - counts]
    text = np.repeat(np.arange(len(counts)), counts)
    low = (hashes >> np.uint64(64 - HASH_BITS)) < np.uint64(int(fraction * (1 << HASH_BITS)))
    owner, kept, _ = distinct(hashes[low], np.bincount(text[low], minlength=len(counts)))
    bounds = np.searchsorted(owner, np.arange(len(counts) + 1)).tolist()
    spelled = kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BITS // 8 :].tobytes().hex()
    prints = [
        f"{n:x}.{t:x}.{spelled[_DIGITS * a : _DIGITS * b]}"
        for n, t, a, b in zip(counts.tolist(), totals.tolist(), bounds, bounds[1:])
    ]
    return prints, [kept[a:b] for a, b in zip(bounds, bounds[1:])]


def likeness(one: str, one_kept: np.ndarray, other: str, other_kept: np.ndarray) -> tuple[float, float, float]:
    """Estimated resemblance, and containment of the first in the second and of the second in the first."""
    if one == other:
        return 1.0, 1.0, 1.0
    both = len(np.intersect1d(one_kept, other_kept, assume_unique=True))
    a, b = len(one_kept), len(other_kept)
    return both / (a + b - both) if a + b else 0.0, both / a if a else 0.0, both / b if b else 0.0


def fingerprints(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of each document."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text"), SLICE_BYTES):
                found, _ = sketch(batch.column("text")[a:b], fraction)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], pa.array(found)], schema=schema)

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (``bucket``, ``lent``, ``doc_id``, ``text``) sorted so that a task can pair each document with the
    next one in descending order of id: consecutive rows of a bucket are consecutive documents.

    Ids are cut at their quantiles into four buckets per shuffle partition.  The first document
    of each bucket is also lent to the bucket before it (the first of all to the last one), so
    every text is shuffled once and no task sees more than its buckets.  Quantiles and first ids
    are as many as there are buckets, and are all that comes to the driver.  Documents of equal
    id are ordered by text; a missing id counts as the smallest.
    """
    spark = docs.sparkSession
    ship(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), key.alias("key"),
    )
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit((i + 1) / n) for i in range(n - 1)])
    cuts = np.unique(np.array(rows.agg(F.percentile_approx("key", shares, 10 * n)).first()[0] or [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy()).astype(np.int32))

    firsts = {b: k for b, k in rows.groupBy(bucket_of("key").alias("b")).agg(F.max("key")).collect()}
    filled = sorted(firsts)
    lend = {firsts[b]: filled[(i + 1) % len(filled)] for i, b in enumerate(filled)}

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series) -> pd.Series:
        """Twice the bucket, and twice another plus one where the row is lent to it."""
        own = (2 * np.searchsorted(cuts, keys.to_numpy())).tolist()
        return pd.Series([[b, 2 * lend[k] + 1] if k in lend else [b] for b, k in zip(own, keys.tolist())])

    placed = rows.withColumn("place", F.explode(places("key")))
    placed = placed.withColumn("bucket", F.shiftright("place", 1)).withColumn("lent", F.col("place") % 2)
    placed = placed.repartition("bucket").sortWithinPartitions("bucket", "lent", F.desc("key"), "text")
    return placed.select("bucket", "lent", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """``text`` whose second half is replaced by the first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def near_edits(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how near they and the next text are."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("contained_in_edited", pa.float64()), ("contained_in_next", pa.float64()),
    ])

    def compared(held: list[tuple[int, int, int | None, str]]) -> pa.RecordBatch:
        """Rows are (bucket, lent, id, text); all but the last are paired with the row behind them."""
        pairs = [(x, y) for x, y in zip(held, held[1:]) if x[0] == y[0] and not x[1]]
        own = [x for x, _ in pairs]
        changed = [edited(x[3], y[3]) for x, y in pairs]
        prints, kept = sketch(pa.array([x[3] for x in held], pa.string()), fraction)
        changed_prints, changed_kept = sketch(pa.array(changed, pa.string()), fraction)
        at = [i for i, (x, y) in enumerate(zip(held, held[1:])) if x[0] == y[0] and not x[1]]
        to_edit = [likeness(prints[i], kept[i], changed_prints[k], changed_kept[k]) for k, i in enumerate(at)]
        to_next = [likeness(prints[i], kept[i], prints[i + 1], kept[i + 1]) for i in at]
        return pa.RecordBatch.from_pydict({
            "doc_id": [x[2] for x in own], "n_chars": [len(x[3]) for x in own],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": [prints[i] for i in at], "edited_fingerprint": changed_prints,
            "near_edited": [x[0] for x in to_edit], "near_next": [x[0] for x in to_next],
            "contained_in_edited": [x[1] for x in to_edit], "contained_in_next": [x[1] for x in to_next],
        }, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0
        for batch in batches:
            for a, b in slices(batch.column("text"), SLICE_BYTES):
                for row in zip(*[batch.column(i)[a:b].to_pylist() for i in range(4)]):
                    held.append(row)
                    size += len(row[3])
                    if size > SLICE_BYTES or len(held) > 20_000:
                        yield compared(held)
                        held, size = held[-1:], len(row[3])
        if held:
            yield compared(held)

    made = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string"
    made += ", near_edited double, near_next double, contained_in_edited double, contained_in_next double"
    return with_next(docs).mapInArrow(run, made)
