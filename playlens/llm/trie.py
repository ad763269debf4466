"""Prefix trie of conversations, rolled up by centroid decomposition.

Every distinct sequence of first turns (role, text) is a node; an edge leads from each node to
its parent, one turn shorter, up to the textless root.  A prefix is named by 128 bits, hashed
from the running sums of four 32-bit pieces of each turn's hash at its depth; sums run in chunks
of turns, so a conversation of any length is cut over many tasks.

Totals over subtrees come from the centroid decomposition of the parent edges: in each component
the centroid is the deepest node with more than half of the component below it (itself
included).  What hangs below it is added up once, that total goes to every node on the path from
the centroid to the component's top, and the component falls apart into the subtrees of the
centroid's children and the rest above it.  A pair of a node and an ancestor is counted when
the centroid between them is taken out, once.  Components of more than ``LOCAL_NODES`` nodes are
split by Spark jobs: the centroid's depth is found by bisection, since the ancestor of a node at
any depth is the row of that depth of any conversation through it.  Each split halves the
component, and all large components are split at a time.  Smaller ones are decomposed in tasks,
each task taking whole components of about ``LOCAL_NODES`` nodes.

Turns go by ``turn`` (null first), then role, then text; a null role or text is empty.  Turns
without conversation id take no part.  Repeated rows are turns of their own.  An empty table
gives no rows, not even a root.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NO_ID, running_totals, ship, written

LOCAL_NODES = 50_000
#: Most components that are large at once; their descriptions are broadcast.
LARGE_COMPONENTS = 500_000
CHUNK_BITS = 10
ENDS_BITS = 12
PIECES = ("s0", "s1", "s2", "s3")
NODE = ("ka", "kb")


def running_sums(rows: DataFrame, key: str, values: list[str], ties: list[str]) -> DataFrame:
    """Replaces ``values`` by their sums over the rows of ``conv_id`` up to this one, in the order of
    the integer ``key``.  A window never spans more than 2**CHUNK_BITS keys; ``rows`` is read twice."""
    rows = rows.withColumn("_chunk", F.shiftright(key, CHUNK_BITS))
    group = ["conv_id", "_chunk"]
    window = Window.partitionBy(*group).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.select(*[c for c in rows.columns if c not in values], *[F.sum(v).over(window).alias(f"_in_{v}") for v in values])
    totals = rows.groupBy(*group).agg(*[F.sum(v).alias(v) for v in values])
    before = running_totals(totals, "_chunk", values, [], ["conv_id"], (12,))
    before = before.select(*group, *[f"before_{v}" for v in values])
    sums = [(F.col(f"_in_{v}") + F.col(f"before_{v}")).alias(v) for v in values]
    return inside.join(before, group).select(*[c for c in rows.columns if c not in (*values, "_chunk")], *sums)


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), and of each turn two hashes ``a`` and ``b`` and the code points ``chars``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(NO_ID)).alias("turn"),
        role.alias("role"), text.alias("text"), F.lit(1).cast("long").alias("pos"),
    ).filter(F.col("conv_id").isNotNull())
    rows = running_sums(rows, "turn", ["pos"], ["role", "text"])
    return rows.select(
        "conv_id", "pos", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit("second"), "role", "text").alias("b"),
        F.length("text").cast("long").alias("chars"),
    )


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like another one: the first h turns of conversation c - c % every, then
    the conversation's own turns behind its first h, with h = crc32(c) % most.

    Returns the turns (``conv_id``, ``depth`` from 1, ``a``, ``b``, ``chars``) and every conversation
    with its ``length``, which may be 0.  ``most`` also bounds how many turns are copied, and ``every`` how
    often."""
    own = written(numbered(turns), "turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = F.col("conv_id") - F.col("conv_id") % every
    own = own.withColumn("h", h).withColumn("base", base)
    firsts = own.filter((F.col("pos") < most) & (F.col("conv_id") == F.col("base")))
    firsts = firsts.select("base", F.col("pos").alias("depth"), "a", "b", "chars")
    held = firsts.groupBy("base").agg(F.max("depth").alias("held"))
    taken = F.least("h", F.coalesce("held", F.lit(0)))
    convs = own.groupBy("conv_id", "h", "base").agg(F.max("pos").alias("n"))
    begun = convs.join(firsts, "base").filter("depth <= h").select("conv_id", "depth", "a", "b", "chars")
    rest = own.filter("pos > h").join(held, "base", "left")
    rest = rest.select("conv_id", (taken + F.col("pos") - F.col("h")).alias("depth"), "a", "b", "chars")
    length = (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
    return begun.unionByName(rest), convs.join(held, "base", "left").select("conv_id", length)


def _named(sums: list[Column], depth: Column, prefix: str) -> list[Column]:
    """The two halves of a prefix's name."""
    return [F.xxhash64(depth.cast("long"), *sums).alias(f"{prefix}a"), F.xxhash64(F.lit("second"), depth.cast("long"), *sums).alias(f"{prefix}b")]


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and depth from 0: its node ``ka``, ``kb``, the parent ``pa``, ``pb`` (root: null)
    and the ``chars`` of its last turn.  ``turns`` are (conv_id, depth, a, b, chars), read twice."""
    halves = [F.xxhash64("a", "b", "depth"), F.xxhash64(F.lit("second"), "a", "b", "depth")]
    pieces = [p for h in halves for p in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    rows = turns.select("conv_id", "depth", "chars", *[p.alias(f"own_{s}") for p, s in zip(pieces, PIECES)], *[p.alias(s) for p, s in zip(pieces, PIECES)])
    rows = running_sums(rows, "depth", list(PIECES), [])
    up_sums = [F.col(s) - F.col(f"own_{s}") for s in PIECES]
    rows = rows.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "chars", *_named([F.col(s) for s in PIECES], F.col("depth"), "k"),
        *_named(up_sums, F.col("depth") - 1, "p"),
    )
    none = F.lit(0).cast("long")
    roots = convs.select(
        "conv_id", none.alias("depth"), none.alias("chars"), *_named([none] * 4, none, "k"),
        F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"),
    )
    return rows.unionByName(roots)


def end_digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` of the conversations that end at each node, ascending.

    Ids are joined in pieces of at most 2**ENDS_BITS, and a task hashes one piece after the other, so
    its memory does not grow with a node; the hash itself is one chain by its definition."""
    pieces = ends.groupBy(*NODE, F.shiftright("conv_id", ENDS_BITS).alias("part")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select(*NODE, "part", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    schema = pa.schema([("ka", pa.int64()), ("kb", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = digest = None
        made: list = []
        out = lambda: pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*made)))), schema=schema)
        for batch in batches:
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if (a, b) != node:
                    if node is not None:
                        made.append((*node, digest.hexdigest()))
                    node, digest = (a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if len(made) > 10_000:
                yield out()
                made = []
        if node is not None:
            made.append((*node, digest.hexdigest()))
            yield out()

    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "part").select(*NODE, "ids")
    return dealt.mapInArrow(run, "ka long, kb long, ends_sha256 string")


def decomposed(parent: list[int], weights: np.ndarray) -> np.ndarray:
    """Sums of ``weights`` (node, value) over subtrees, by centroid decomposition of a forest.
    ``parent`` holds row numbers, -1 for a top; parents stand before their children."""
    out = np.zeros_like(weights)
    parent, alive = list(parent), list(range(len(parent)))
    top = [0] * len(parent)
    while alive:
        size = dict.fromkeys(alive, 1)
        below = weights.copy() if len(alive) == len(parent) else {v: weights[v].copy() for v in alive}
        for v in reversed(alive):
            if parent[v] >= 0:
                size[parent[v]] += size[v]
                below[parent[v]] += below[v]
        centroid: dict[int, int] = {}
        for v in alive:  # parents come first, so the deepest heavy node is the last one met
            top[v] = v if parent[v] < 0 else top[parent[v]]
            if 2 * size[v] > size[top[v]]:
                centroid[top[v]] = v
        gone = set(centroid.values())
        for c in gone:
            at = c
            while at >= 0:
                out[at] += below[c]
                at = parent[at]
        alive = [v for v in alive if v not in gone]
        for v in alive:
            if parent[v] in gone:
                parent[v] = -1
    return out


def _local_totals(rows: DataFrame, values: list[str], buckets: int) -> DataFrame:
    """Subtree totals inside components (``ca``, ``cb``) that fit a task."""

    def run(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("depth", kind="stable")
        number = {key: i for i, key in enumerate(zip(found.ka.tolist(), found.kb.tolist()))}
        root = -(2**63)
        parent = [number.get(key, -1) for key in zip(found.pa.fillna(root).astype("int64").tolist(), found.pb.fillna(root).astype("int64").tolist())]
        sums = decomposed(parent, found[values].to_numpy(np.int64))
        return pd.DataFrame({"ka": found.ka.to_numpy(), "kb": found.kb.to_numpy(), **{v: sums[:, i] for i, v in enumerate(values)}})

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("ca", "cb"), F.lit(buckets)))
    # a null parent would turn its whole column into doubles
    dealt = dealt.select("bucket", *NODE, F.coalesce("pa", F.lit(NO_ID)).alias("pa"), F.coalesce("pb", F.lit(NO_ID)).alias("pb"), "depth", *values)
    return dealt.groupBy("bucket").applyInPandas(run, f"ka long, kb long, {', '.join(f'{v} long' for v in values)}")


def subtree_totals(nodes: DataFrame, steps: DataFrame, values: list[str], local_nodes: int = LOCAL_NODES) -> DataFrame:
    """``ka``, ``kb`` and the sums of ``values`` over each node's subtree.

    ``nodes`` are (ka, kb, pa, pb, conv_id, depth, values), ``conv_id`` being any conversation through the
    node; ``steps`` are the rows of ``paths``.  Both are stored tables."""
    spark = nodes.sparkSession
    total = nodes.count()
    limit = max(local_nodes, total // LARGE_COMPONENTS)
    root = nodes.filter("pa IS NULL").select(F.col("ka").alias("ca"), F.col("kb").alias("cb"))
    tops = root.first()
    if tops is None:
        return nodes.select(*NODE, *values)
    active = nodes.withColumn("ca", F.lit(tops.ca)).withColumn("cb", F.lit(tops.cb))
    comp = ["ca", "cb"]
    settled, added = [], []
    left = total
    while left > limit:
        sizes = active.groupBy(*comp).agg(F.count(F.lit(1)).alias("n"), F.min("depth").alias("top"), F.max("depth").alias("low"))
        large = written(sizes.filter(F.col("n") > limit), "large")
        n_large, spread = large.agg(F.count(F.lit(1)), F.max(F.col("low") - F.col("top"))).first()
        if not n_large:
            break
        # at most total / limit <= LARGE_COMPONENTS rows
        search = large.select(*comp, "n", "top", F.col("top").alias("lo"), F.col("low").alias("hi"), F.col("ca").alias("xa"), F.col("cb").alias("xb"))
        settled.append(active.join(F.broadcast(large.select(*comp)), comp, "left_anti"))
        inner = written(active.join(F.broadcast(large.select(*comp)), comp, "left_semi"), "components")
        for _ in range(int(spread).bit_length()):
            middle = F.expr("(lo + hi + 1) div 2")
            asked = search.withColumn("m", middle).filter("lo < hi")
            there = steps.join(F.broadcast(asked.select(F.col("m").alias("depth")).distinct()), "depth", "left_semi")
            there = there.select("conv_id", F.col("depth").alias("m"), F.col("ka").alias("ya"), F.col("kb").alias("yb"))
            below = inner.select("conv_id", "depth", *comp).join(F.broadcast(asked.select(*comp, "m", "n")), comp).filter("depth >= m")
            heavy = below.join(there, ["conv_id", "m"]).groupBy(*comp, "n", "ya", "yb").count().filter("2 * count > n")
            found = search.join(F.broadcast(heavy.select(*comp, "ya", "yb")), comp, "left").withColumn("m", middle)
            hit, open_ = F.col("ya").isNotNull(), F.col("lo") < F.col("hi")
            search = written(found.select(
                *comp, "n", "top", F.when(hit, F.col("m")).otherwise(F.col("lo")).alias("lo"),
                F.when(open_ & ~hit, F.col("m") - 1).otherwise(F.col("hi")).alias("hi"),
                F.coalesce("ya", "xa").alias("xa"), F.coalesce("yb", "xb").alias("xb"),
            ), "centroids")
        centroid = F.broadcast(search.select(*comp, "lo", "xa", "xb"))
        child = steps.join(F.broadcast(search.select((F.col("lo") + 1).alias("depth")).distinct()), "depth", "left_semi")
        child = child.select("conv_id", F.col("depth").alias("m"), F.col("ka").alias("ya"), F.col("kb").alias("yb"), F.col("pa").alias("za"), F.col("pb").alias("zb"))
        placed = inner.join(centroid, comp).withColumn("m", F.col("lo") + 1).join(child, ["conv_id", "m"], "left")
        own = (F.col("ka") == F.col("xa")) & (F.col("kb") == F.col("xb"))
        under = F.coalesce((F.col("depth") > F.col("lo")) & (F.col("za") == F.col("xa")) & (F.col("zb") == F.col("xb")), F.lit(False))
        placed = placed.withColumn("own", own).withColumn("under", under)
        placed = written(placed.select(*nodes.columns, *comp, "own", "under", "ya", "yb"), "split")
        totals = placed.filter("own OR under").groupBy(*comp).agg(
            *[F.sum(v).alias(v) for v in values], F.max(F.when(F.col("own"), F.col("conv_id"))).alias("conv_id")
        )
        climb = totals.join(F.broadcast(search.select(*comp, "top", "lo")), comp).drop(*comp)
        path = steps.select("conv_id", "depth", *NODE).join(F.broadcast(climb), "conv_id").filter("depth BETWEEN top AND lo")
        added.append(written(path.select(*NODE, *values), "climbed"))
        where = [F.when(F.col("under"), F.col(y)).otherwise(F.col(c)).alias(c) for y, c in (("ya", "ca"), ("yb", "cb"))]
        active = placed.filter("NOT own").select(*nodes.columns, *where)
        left = active.count()
    for rows in settled:
        active = active.unionByName(rows)
    sums = _local_totals(active, values, max(1, -(-total // limit)))
    for rows in added:
        sums = sums.unionByName(rows)
    return sums.groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in values])


def trie(turns: DataFrame, convs: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """One row per node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``turns`` are (conv_id, depth, a, b, chars), ``convs`` all conversations (conv_id, length)."""
    ship(turns.sparkSession)
    convs = written(convs, "conversations")
    steps = written(paths(written(turns, "rebuilt"), convs), "paths")
    nodes = steps.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        *[F.max(c).alias(c) for c in ("chars", "pa", "pb")],
    )
    nodes = written(nodes, "nodes")
    children = nodes.filter("pa IS NOT NULL").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    zero = F.lit(0).cast("long")
    nodes = nodes.join(above, ["pa", "pb"], "left").join(children, [*NODE], "left").withColumn("n_children", F.coalesce("n_children", zero))
    weights = [
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    ]
    nodes = written(nodes.select(*NODE, "pa", "pb", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *weights), "tree")
    sums = subtree_totals(nodes.select(*NODE, "pa", "pb", "conv_id", "depth", "n_leaves", "saved_tokens"), steps, ["n_leaves", "saved_tokens"], local_nodes)
    ends = steps.select("conv_id", "depth", *NODE).join(convs.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"])
    none = F.lit(hashlib.sha256(b"").hexdigest())
    full = nodes.drop("n_leaves", "saved_tokens").join(sums, [*NODE]).join(end_digests(ends), [*NODE], "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
