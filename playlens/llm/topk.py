"""Exact top-k search by inner product over a bit-sliced index.

Vectors are quantised to whole numbers, floor(scale * x).  The index cuts them into blocks of
about ``BLOCK_ROWS`` rows; in a block each attribute, less its minimum there, is stored as
slices: one bitmap over the block's rows per binary digit.  A query multiplies by adding
slices: every binary digit of a weight adds the attribute's slices, shifted by that digit, by
carry-save addition of bitmaps; a negative weight adds complemented slices, a constant apart.
The sum is again a list of slices.  The top rows are taken from its most significant slice
downward; rows that tie at the boundary have one score, and the smallest ids among them fill
the rest.  All queries meet all blocks, a chunk of queries and a block at a time; the tops of
the blocks are merged per query.

Rows without id, and vectors that are null or hold a null or non-finite component take no
part.  A shorter vector counts as filled up with zeros.  Rows equal in id and vector are one
candidate that takes as many ranks.  A row never finds a row of its own id.  Fewer candidates
than k give fewer rows; an empty table gives none.  Rows with a quantised component of 2^31 or
more stand in blocks of their own, without slices; they, and such rows as queries, are scored row
by row in whole numbers of any size.  A score that is returned and does not fit a long raises an
error.  Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, written

BLOCK_ROWS = 16_384
CHUNK_QUERIES = 512
#: Quantised components this far from zero, or farther, are not sliced.
WIDE = 2**31
FULL = np.uint64(2**64 - 1)


def bitmap(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words, the first flag in the lowest bit."""
    packed = np.packbits(flags, axis=-1, bitorder="little")
    pad = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [*[(0, 0)] * (flags.ndim - 1), (0, pad)])).view(np.uint64)


def members(bits: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the rows in a bitmap."""
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little")[:n])


def size(bits: np.ndarray) -> int:
    return int(np.bitwise_count(bits).sum())


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices (attribute, digit, word) of whole numbers (row, attribute), and each attribute's minimum."""
    least = values.min(axis=0)
    above = (values - least).T
    digits = max(1, int(above.max(initial=0)).bit_length())
    return np.stack([bitmap((above >> j & 1).astype(np.uint8)) for j in range(digits)], axis=1), least


def added(columns: dict[int, np.ndarray]) -> list[np.ndarray]:
    """Adds bitmaps of weight 2^w (one row of ``columns[w]`` each); the slices of the sum, lowest first."""
    out, w = [], 0
    words = next(iter(columns.values())).shape[1] if columns else 0
    while columns:
        rows = columns.pop(w, None)
        carried = []
        while rows is not None and len(rows) > 1:
            if len(rows) == 2:
                carried.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
                break
            third = len(rows) // 3
            x, y, z = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
            half = x ^ y
            carried.append(x & y | z & half)
            rows = np.concatenate([half ^ z, rows[3 * third :]])
        out.append(rows[0] if rows is not None else np.zeros(words, np.uint64))
        if carried:
            columns[w + 1] = np.concatenate([*carried, columns[w + 1]] if w + 1 in columns else carried)
        w += 1
    return out


def score_slices(index: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Slices of each row's score less a constant of the query."""
    columns: dict[int, list[np.ndarray]] = {}
    size_of = np.abs(weights)
    for b in range(int(size_of.max(initial=0)).bit_length()):
        for sign in (1, -1):
            chosen = np.flatnonzero((size_of >> b & 1 == 1) & (np.sign(weights) == sign))
            if len(chosen):
                part = index[chosen] if sign > 0 else ~index[chosen]
                for j in range(part.shape[1]):
                    columns.setdefault(b + j, []).append(part[:, j])
    return added({w: np.concatenate(rows) for w, rows in columns.items()})


def top(score: list[np.ndarray], candidates: np.ndarray, n: int, k: int) -> np.ndarray:
    """Numbers of the k candidates of the highest scores, ties to lower numbers."""
    sure, tied, need = np.zeros_like(candidates), candidates, k
    for bits in reversed(score):
        high = tied & bits
        found = size(high)
        if found >= need:
            tied = high
        else:
            sure, tied, need = sure | high, tied & ~bits, need - found
    return np.concatenate([members(sure, n), members(tied, n)[:need]])


def search_block(index: np.ndarray, least: np.ndarray, values: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """(query id, row number, score) of the best rows of a block for each query.  ``ids`` ascend."""
    n = len(ids)
    everyone = bitmap(np.ones((1, n), np.uint8))[0]
    for weights, own in zip(queries, query_ids.tolist()):
        candidates = everyone
        a, b = np.searchsorted(ids, own), np.searchsorted(ids, own, "right")
        if a < b:
            flags = np.ones((1, n), np.uint8)
            flags[0, a:b] = 0
            candidates = bitmap(flags)[0]
        best = top(score_slices(index, weights), candidates, n, k)
        yield own, best, values[best] @ weights


def search_wide(values: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[list[int], list[int], list[bool]]:
    """Row numbers and scores of the best rows, ties to lower ids; whole numbers held as doubles.  ``ids`` ascend.
    A score that does not fit a long is the nearest one that does, and marked."""
    whole = [int(x) for x in query.tolist()]
    scored = [(-sum(int(x) * y for x, y in zip(row, whole)), i) for i, row in enumerate(values.tolist()) if ids[i] != own]
    best = heapq.nsmallest(k, scored)
    fit = [min(max(-s, -(2**63)), 2**63 - 1) for s, _ in best]
    return [i for _, i in best], fit, [-s != f for (s, _), f in zip(best, fit)]


def usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id``, ``vector`` (doubles) and ``copies`` of the rows that take part."""
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & sound)
    return rows.groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies"))


def top_k(
    df: DataFrame, k: int, every: int, scale: float = 64.0, id_column: str = "vec_id", vector_column: str = "embedding",
    block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best rows for each id divisible by ``every``."""
    ship(df.sparkSession)
    rows = written(usable(df, id_column, vector_column), "vectors")
    is_query = F.col("vec_id") % every == 0
    is_wide = F.exists("vector", lambda x: (x * scale >= WIDE) | (x * scale < -WIDE))
    n, n_wide, asked, dims = rows.agg(
        F.count(F.lit(1)), F.count_if(is_wide), F.count(F.when(is_query, 1)), F.coalesce(F.max(F.size("vector")), F.lit(0))
    ).first()
    narrow = max(1, -(-(n - n_wide) // block_rows))
    blocks, chunks = narrow + -(-n_wide // block_rows), max(1, -(-asked // chunk_queries))
    width = max(1, dims)

    def quantised(vectors: pd.Series) -> np.ndarray:
        out = np.zeros((len(vectors), width))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = np.floor(scale * np.asarray(v, float))
        return out

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        values, wide = quantised(rows.vector), bool(rows.block.iloc[0] >= narrow)
        index, least = (np.zeros((width, 0, 0), np.uint64), np.zeros(0, np.int64)) if wide else slices_of(values.astype(np.int64))
        return pd.DataFrame({
            "block": [rows.block.iloc[0]], "digits": [index.shape[1]], "ids": [rows.vec_id.to_numpy(np.int64).tobytes()],
            "copies": [rows.copies.to_numpy(np.int64).tobytes()], "vals": [(values if wide else values.astype(np.int32)).tobytes()],
            "slices": [index.tobytes()], "least": [least.tobytes()], "wide": [wide],
        })

    place = F.xxhash64("vec_id", "vector")
    block = F.when(is_wide, narrow + F.pmod(place, F.lit(max(1, blocks - narrow)))).otherwise(F.pmod(place, F.lit(narrow)))
    index = rows.withColumn("block", block.cast("int")).groupBy("block").applyInPandas(
        build, "block int, digits int, ids binary, copies binary, vals binary, slices binary, least binary, wide boolean"
    )
    index = written(index, "bit-slices")
    questions = rows.filter(is_query).select("vec_id", "vector").withColumn(
        "chunk", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(chunks)).cast("int")
    )
    questions = questions.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(key, index: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(index) and len(questions):
            one = index.iloc[0]
            ids, copies = np.frombuffer(one["ids"], np.int64), np.frombuffer(one["copies"], np.int64)
            wide = bool(one["wide"])
            values = np.frombuffer(one["vals"], np.float64 if wide else np.int32).reshape(len(ids), width)
            asked, own = quantised(questions.vector), questions.vec_id.to_numpy()
            far = np.abs(asked).max(axis=1) >= WIDE if not wide else np.ones(len(asked), bool)
            for query, q in zip(asked[far], own[far].tolist()):
                best, score, over = search_wide(values.astype(float), ids, query, q, k)
                found.append(pd.DataFrame({"query_id": q, "vec_id": ids[best], "score": np.array(score, np.int64), "copies": copies[best], "over": over}))
            if not far.all():
                bits = np.frombuffer(one["slices"], np.uint64).reshape(width, int(one["digits"]), -1)
                least, whole = np.frombuffer(one["least"], np.int64), asked[~far].astype(np.int64)
                for q, best, score in search_block(bits, least, values.astype(np.int64), ids, whole, own[~far], k):
                    found.append(pd.DataFrame({"query_id": q, "vec_id": ids[best], "score": score, "copies": copies[best], "over": False}))
        return pd.concat(found) if found else pd.DataFrame(columns=["query_id", "vec_id", "score", "copies", "over"])

    meeting = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).groupBy("block", "chunk")
    tops = meeting.cogroup(questions.groupBy("block", "chunk")).applyInPandas(
        search, "query_id long, vec_id long, score long, copies long, over boolean"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = tops.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    each = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "copy"))
    score = F.when(F.col("over"), F.raise_error(F.lit("a score does not fit a long")).cast("long")).otherwise(F.col("score"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
