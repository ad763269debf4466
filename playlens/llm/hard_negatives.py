"""Hard negatives by best-first descent of cover trees over norm-augmented candidates.

Vectors are quantised to whole numbers, floor(scale * x); a row's score is its inner product with
the anchor.  A candidate x gets one more coordinate, sqrt(M^2 - |x|^2), so that all have norm M
and the distance to an anchor tells the score: d^2 = |q|^2 + M^2 - 2 score.  A node of a cover
tree holds the candidates within its covering radius r of its centre, so its scores lie between
those of the distances d - r and d + r.  Radii halve from level to level as far as ``FAN`` centres
allow: the first centre of a node's children is its own, the others are the farthest candidates
in turn, so they stand apart as far as they cover.

The candidates are dealt to cells around a few pivots, which make up the top of the tree, and cells
to blocks of about ``BLOCK_ROWS`` rows, each with a tree of its own; a crowded cell is cut by a
hash.  First each anchor's positives are found: the best rows of its label.  Then its negatives:
for each positive the best rows of other labels whose scores lie in the positive's window.  Anchors
skip the cells, and inside a block the nodes, that lie outside all of their windows or below the
scores they have found; the rows of leaves are scored exactly.

Pivots are chosen from a bounded sample, ``SAMPLE_ROWS`` rows of the smallest hashes; they only
change how rows are grouped, never the result.

Rows without id or label, and vectors that are null or hold a null or non-finite component take no
part.  A shorter vector counts as filled up with zeros.  Rows equal in id, label and vector are one
row.  A row never meets a row of its own id; rows that share an id but differ are rows of their
own.  A score is exact however large; one that is returned and does not fit a long raises an error.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, written

BLOCK_ROWS = 8_192
CHUNK_ANCHORS = 2_048
SAMPLE_ROWS, CELLS = 2_048, 64
FAN, LEAF = 32, 128
#: Leaves that are scored at first, best ones first; later steps take four times as many each.
STRIDE = 2


def spread_centres(points: np.ndarray, most: int, near: float = 0.0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Farthest-first centres, beginning with row 0, until ``most`` are chosen or all rows are within ``near``
    of one.  Returns their row numbers, and each row's nearest one and the distance to it."""
    centres = [0]
    far = np.linalg.norm(points - points[0], axis=1)
    owner = np.zeros(len(points), np.int64)
    while len(centres) < most and far.max() > near:
        centres.append(int(far.argmax()))
        other = np.linalg.norm(points - points[centres[-1]], axis=1)
        closer = other < far
        owner[closer] = len(centres) - 1
        far = np.where(closer, other, far)
    return centres, owner, far


@dataclass
class CoverTree:
    """Nodes in order from the root; the rows of a node are ``rows[first[i]:last[i]]``."""

    centre: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray
    child: np.ndarray
    children: np.ndarray
    rows: np.ndarray
    norm2: float
    peak: float


def grow(values: np.ndarray, fan: int = FAN, leaf: int = LEAF) -> CoverTree:
    """The tree of the rows of ``values``."""
    lengths = (values**2).sum(axis=1)
    norm2 = float(lengths.max(initial=0.0))
    points = np.column_stack([values, np.sqrt(np.maximum(norm2 - lengths, 0))])
    rows = np.arange(len(values))
    nodes = [[0, 0, len(values), 0.0, 0, 0]]  # centre row, first, last, radius, first child, children
    at = 0
    while at < len(nodes):
        centre, first, last = nodes[at][:3]
        own = rows[first:last]
        own[[0, np.flatnonzero(own == centre)[0]]] = own[[np.flatnonzero(own == centre)[0], 0]]
        inside = points[own]
        far = np.linalg.norm(inside - inside[0], axis=1)
        nodes[at][3] = float(far.max())
        if last - first > leaf and far.max() > 0:
            chosen, owner, _ = spread_centres(inside, fan, far.max() / 2)
            order = np.argsort(owner, kind="stable")
            sizes = np.bincount(owner, minlength=len(chosen))
            heads = own[chosen]
            rows[first:last] = own[order]
            ends = first + np.cumsum(sizes)
            nodes[at][4:] = len(nodes), len(chosen)
            nodes += [[int(h), int(e - s), int(e), 0.0, 0, 0] for h, s, e in zip(heads, sizes, ends)]
        at += 1
    table = np.array([n[:3] + n[4:] for n in nodes], np.int64)
    radius = np.array([n[3] for n in nodes])
    return CoverTree(points[table[:, 0], :-1], radius, table[:, 1], table[:, 2], table[:, 3], table[:, 4], rows, norm2, float(np.abs(values).max(initial=0)))


def exact(values: np.ndarray, query: np.ndarray, peak: float) -> np.ndarray:
    """Inner products of whole numbers held as doubles, none of ``values`` above ``peak``: exact, as doubles,
    longs or Python integers."""
    most = float(np.abs(query).max(initial=0))
    bound = peak * most * max(1, len(query))
    if bound < 2**53:
        return values @ query
    if bound < 2**62 and max(peak, most) < 2**62:
        return values.astype(np.int64) @ query.astype(np.int64)
    whole = [int(x) for x in query.tolist()]
    return np.array([sum(int(x) * y for x, y in zip(row, whole)) for row in values.tolist()], object)


def best_in_windows(
    tree: CoverTree, values: np.ndarray, ids: np.ndarray, usable: np.ndarray, query: np.ndarray,
    windows: list[tuple[int | None, int | None]], k: int,
) -> list[list[tuple[int, int]]]:
    """For each window (lowest, highest score; None: open) the k best (score, id) among the usable rows, by
    score, then smaller id.  ``values``, ``ids`` and ``usable`` are in the tree's order of rows."""
    found: list[list[tuple[int, int]]] = [[] for _ in windows]
    least = np.array([-np.inf if low is None else low for low, _ in windows], float)
    most = np.array([np.inf if high is None else high for _, high in windows], float)
    whole = float(query @ query) + tree.norm2
    slack = 1e-6 * whole + 1
    away = np.sqrt(np.maximum(whole - 2 * (tree.centre @ query), 0))
    upper = (whole - np.maximum(away - tree.radius, 0) ** 2) / 2 + slack
    lower = (whole - (away + tree.radius) ** 2) / 2 - slack
    inside = lambda nodes: nodes[((upper[nodes, None] >= least) & (lower[nodes, None] <= most)).any(axis=1)]
    front, leaves = inside(np.zeros(1, np.int64)), []
    while len(front):  # a level at a time
        inner = front[tree.children[front] > 0]
        leaves.append(front[tree.children[front] == 0])
        size = tree.children[inner]
        front = np.repeat(tree.child[inner] - np.cumsum(size) + size, size) + np.arange(size.sum())
        front = inside(front)
    waiting = np.concatenate(leaves) if leaves else front
    waiting = waiting[np.argsort(-upper[waiting], kind="stable")]
    stride, every = STRIDE, None
    while len(waiting := inside(waiting)):
        taken, waiting = waiting[:stride], waiting[stride:]
        stride *= 4
        size = tree.last[taken] - tree.first[taken]
        rows = np.repeat(tree.first[taken] - np.cumsum(size) + size, size) + np.arange(size.sum())
        rows = rows[usable[rows]]
        if every is None and 4 * len(rows) > len(values):  # gathering rows costs more than multiplying them
            every = exact(values, query, tree.peak)
        scores = exact(values[rows], query, tree.peak) if every is None else every[rows]
        for i in range(len(windows)):
            good = np.flatnonzero((scores >= least[i]) & (scores <= most[i]))
            if not len(good):
                continue
            if len(good) > k and scores.dtype != object:  # no more than the ties of the k-th
                good = good[scores[good] >= np.partition(scores[good], len(good) - k)[len(good) - k]]
            met = found[i] + [(int(x), y) for x, y in zip(scores[good].tolist(), ids[rows[good]].tolist())]
            found[i] = heapq.nsmallest(k, met, key=lambda x: (-x[0], x[1]))
            if len(found[i]) == k:
                least[i] = max(least[i], float(found[i][-1][0]))
    return found


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def participants(df: DataFrame, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    """``vec_id``, ``label``, ``vector`` (doubles) and a hash ``h`` of the rows that take part."""
    rows = df.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    return rows.distinct().withColumn("h", F.xxhash64("vec_id", "label", "vector"))


def mine(
    df: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0,
    id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding",
    block_rows: int = BLOCK_ROWS, chunk_anchors: int = CHUNK_ANCHORS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score`` for the anchors,
    the rows whose id is divisible by ``every``.  ``low`` and ``high`` bound a negative's score in hundredths of the positive's."""
    spark = df.sparkSession
    ship(spark)
    rows = written(participants(df, id_column, label_column, vector_column), "vectors")
    is_anchor = F.col("vec_id") % every == 0
    n, asked, dims = rows.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, 1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    width = max(1, dims)

    def quantised(vectors) -> np.ndarray:
        if len(vectors) and all(len(v) == width for v in vectors):
            return np.floor(scale * np.stack(list(vectors)).astype(float))
        out = np.zeros((len(vectors), width))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = np.floor(scale * np.asarray(v, float))
        return out

    # the top of the tree: pivots of a bounded sample, each row goes to its nearest
    parts = 1 << 20
    range_ = parts if n <= SAMPLE_ROWS else -(-parts * SAMPLE_ROWS * 5 // (4 * n))
    place = F.pmod("h", F.lit(parts))
    drawn = rows.filter(place < range_).orderBy(place, "h", "vec_id").limit(SAMPLE_ROWS).collect()
    sample = quantised([r.vector for r in drawn])
    pivots = sample[spread_centres(sample, min(CELLS, -(-n // block_rows)))[0]] if n else sample
    shared = spark.sparkContext.broadcast(pivots)  # at most CELLS vectors

    @F.pandas_udf("cell int, away double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        points = quantised(vectors)
        away = np.stack([np.linalg.norm(points - p, axis=1) for p in shared.value], axis=1)
        best = away.argmin(axis=1)
        return pd.DataFrame({"cell": best.astype(np.int32), "away": away[np.arange(len(best)), best]})

    placed = written(rows.withColumn("at", nearest("vector")).select("vec_id", "label", "vector", "h", "at.cell", "at.away"), "cells")
    cells = {r.cell: r for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()}
    parts_of, blocks = {}, 0
    for cell in sorted(cells):
        parts_of[cell] = (blocks, -(-cells[cell].n // block_rows))
        blocks += parts_of[cell][1]
    if not blocks:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    begins = F.element_at(F.create_map(*[F.lit(x) for c, (b, _) in parts_of.items() for x in (c, b)]), F.col("cell"))
    counts = F.element_at(F.create_map(*[F.lit(x) for c, (_, m) in parts_of.items() for x in (c, m)]), F.col("cell"))
    block = (begins + F.pmod("h", counts)).cast("int")

    def plant(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(["vec_id", "h"])
        values = quantised(found.vector)
        tree = grow(values)
        raw = lambda x: [np.ascontiguousarray(x).tobytes()]
        return pd.DataFrame({
            "block": found.block.iloc[:1].to_numpy(), "values": raw(values[tree.rows]), "ids": raw(found.vec_id.to_numpy(np.int64)[tree.rows]),
            "labels": raw(found.label.to_numpy(np.int64)[tree.rows]), "centre": raw(tree.centre), "radius": raw(tree.radius),
            "nodes": raw(np.stack([tree.first, tree.last, tree.child, tree.children])), "norm2": [tree.norm2], "peak": [tree.peak],
        })

    made = "block int, values binary, ids binary, labels binary, centre binary, radius binary, nodes binary, norm2 double, peak double"
    index = written(placed.withColumn("block", block).select("block", "vec_id", "label", "vector", "h").groupBy("block").applyInPandas(plant, made), "cover-trees")
    chunks = max(1, -(-asked // chunk_anchors))
    anchors = placed.filter(is_anchor).select("vec_id", "label", "vector", "h")

    def meet(questions: DataFrame, wanted, k: int, same_label: bool, columns: str) -> DataFrame:
        """``wanted(anchor)`` gives [(key, window)]; rows are (vec_id, h, key..., score, other) per block."""

        def search(found: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(found) and len(questions):
                one = found.iloc[0]
                load = lambda name, kind: np.frombuffer(one[name], kind)
                ids, labels = load("ids", np.int64), load("labels", np.int64)
                values = load("values", np.float64).reshape(len(ids), width)
                first, last, child, children = load("nodes", np.int64).reshape(4, -1)
                tree = CoverTree(load("centre", np.float64).reshape(-1, width), load("radius", np.float64), first, last, child, children, np.arange(len(ids)), one["norm2"], one["peak"])
                for query, anchor in zip(quantised(questions.vector), questions.itertuples()):
                    usable = (ids != anchor.vec_id) & ((labels == anchor.label) == same_label)
                    windows = wanted(anchor)
                    best = best_in_windows(tree, values, ids, usable, query, [w for _, w in windows], k)
                    for (key, _), rows in zip(windows, best):
                        fit = [min(max(s, -(2**63)), 2**63 - 1) for s, _ in rows]
                        out += [(anchor.vec_id, anchor.h, *key, f, i, f != s) for f, (s, i) in zip(fit, rows)]
            return pd.DataFrame(out, columns=[c.split()[0] for c in columns.split(", ")])

        meeting = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).groupBy("block", "chunk")
        dealt = questions.withColumn("chunk", F.pmod("h", F.lit(chunks)).cast("int")).groupBy("block", "chunk")
        return meeting.cogroup(dealt).applyInPandas(search, columns)

    # every anchor meets every block until it knows its positives
    everywhere = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    near = meet(everywhere, lambda _: [((), (None, None))], positives, True, "vec_id long, h long, score long, other long, over boolean")
    order = Window.partitionBy("vec_id", "h").orderBy(F.desc("score"), "other")
    score = F.when(F.col("over"), F.raise_error(F.lit("a score does not fit a long")).cast("long")).otherwise(F.col("score"))
    near = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives).withColumn("score", score)
    known = near.groupBy("vec_id", "h").agg(F.sort_array(F.collect_list(F.struct("place", "other", "score"))).alias("found"))  # at most ``positives``
    known = written(anchors.join(known, ["vec_id", "h"]), "positives")

    radii = np.array([cells[c].radius if c in cells else -1.0 for c in range(len(pivots))])

    @F.pandas_udf("array<int>")
    def reached(vectors: pd.Series, found: pd.Series) -> pd.Series:
        """Blocks of the cells whose scores may lie in a window of the anchor."""
        points = quantised(vectors)
        middle = points @ shared.value.T
        reach = np.linalg.norm(points, axis=1)[:, None] * radii[None, :]
        slack = 1e-6 * (np.abs(middle) + reach) + 1
        out = []
        for lower, upper, rows in zip(middle - reach - slack, middle + reach + slack, found):
            windows = [window_of(int(r["score"]), low, high) for r in rows]
            hit = [c for c in parts_of if any(a <= b and upper[c] >= a and lower[c] <= b for a, b in windows)]
            out.append([b for c in hit for b in range(parts_of[c][0], sum(parts_of[c]))])
        return pd.Series(out)

    def wanted(anchor) -> list:
        windows = [((int(r["place"]), int(r["other"]), int(r["score"])), window_of(int(r["score"]), low, high)) for r in anchor.found]
        return [(key, (a, b)) for key, (a, b) in windows if a <= b]

    asking = known.withColumn("block", F.explode(reached("vector", "found")))
    columns = "vec_id long, h long, place int, positive_id long, positive_score long, score long, other long, over boolean"
    hard = meet(asking, wanted, negatives, False, columns)
    order = Window.partitionBy("vec_id", "h", "place").orderBy(F.desc("score"), "other")
    hard = hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return hard.select(
        F.col("vec_id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", score.alias("negative_score"),
    )
