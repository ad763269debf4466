"""MinHash near-dedup: ProbMinHash signatures, banding, verification and classes.

1. Texts are told apart by a 128-bit digest; all copies of a text are one node.
2. A node's five-word shingles, weighted by how often they occur, send arrivals of a Poisson
   process each, at the rate of their weight, to the signature's places.  A place keeps the
   shingle that arrives first; a shingle stops once its next arrival is later than every
   place's.  Two signatures agree in a place with the probability Jaccard similarity.  A text
   that repeats shingles has a second signature with all weights 1: in that one, texts agree
   with the Jaccard similarity of their shingle sets, however often each repeats its shingles.
3. Nodes that agree in all places of a band, of either signature, meet in a bucket.  A bucket is not unfolded into
   pairs: its pivot, the member that meets most nodes in all, is compared with the others; buckets
   of one pivot are one group, and a group goes into that of a heavier pivot which met its own,
   as far up as that leads.  Members linked to the pivot are of one class.  A link
   between members of which one is not linked to the pivot is searched for exactly:
   - If both share a shingle that the pivot lacks, they share one among the first few that each
     has (rarest first; how few follows from the similarity).  Members that do form a
     smaller group with pivots of its own, eight times as many, and so on until none is left.
   - If they share none, one is smaller than the pivot and has lost hardly any of the pivot's
     shingles that the other one has not lost.  A join on the first shingles lost, each at a
     place that a link allows, finds them.
   Classes are worked out after each step, and members of one class are not searched for links.
   So every two texts that meet are compared, are in one class, or cannot be a link.
4. A pair is a link if the Jaccard similarity of its shingle sets is at least 0.8.
5. Classes are the connected components of links, by repeated minimum labels.

Null text: the document is a class of its own.  Empty texts, and texts without words that are
equal, are copies.  A text of fewer than five words is one shingle.  Repeated rows are copies.
A class is named by its smallest id, missing only if all its ids are.  An empty table gives
no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import freeing, fresh, ship, slices, written
from .shingles import HASH_BITS, distinct, mix, shingles

BANDS, ROWS = 25, 5
SIMILARITY = 0.8
SLICE_BYTES = 1 << 20
_SET_BYTES = HASH_BITS // 8
_STEP, _PLACE = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, places: int) -> np.ndarray:
    """ProbMinHash signature of each text (a row of ``places`` elements; zeros if it has none)."""
    first = np.full((texts, places), np.inf)
    kept = np.zeros(texts * places, np.uint64)
    flat, last = first.reshape(-1), np.full(texts, np.inf)
    time, rate, step = np.zeros(len(element)), weight.astype(float), 0
    while len(element):
        step = (step + _STEP) % 2**64
        drawn = mix(element + np.uint64(step))
        time = time - np.log(((drawn >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate
        early = time < last[text]
        text, element, rate, time, drawn = text[early], element[early], rate[early], time[early], drawn[early]
        place = ((mix(drawn ^ _PLACE) >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64)
        slot = text * places + place
        np.minimum.at(flat, slot, time)
        won = time == flat[slot]
        kept[slot[won]] = element[won]
        alive = np.flatnonzero(np.bincount(text, minlength=texts))
        last[alive] = first[alive].max(axis=1)
    return kept.reshape(texts, places)


def band_hashes(kept: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per text and band."""
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _PLACE, (len(kept), 1))
    for r in range(rows):
        out = mix(out + kept[:, r::rows][:, :bands] + np.uint64((r + 1) * _STEP % 2**64))
    return out


def _digest(text):
    return F.unhex(F.md5(F.col(text)))


def buckets(texts: pa.Array, bands: int, rows: int) -> tuple[np.ndarray, pa.Array]:
    """The number of distinct shingles of each text and the buckets it goes to.

    They are the bands of its weighted signature and of one with all weights 1.  Only a text
    that repeats some shingles more than others has further buckets from the second.
    """
    text, element, often = distinct(*shingles(texts))
    sizes = np.bincount(text, minlength=len(texts)).astype(np.int32)
    weight = 1 + np.log2(often)
    weighted = band_hashes(signatures(text, element, weight, len(texts), bands * rows), bands, rows)
    again = np.unique(text[often > 1])
    some = np.isin(text, again)
    place = np.searchsorted(again, text[some])
    plain = band_hashes(signatures(place, element[some], np.ones(len(place)), len(again), bands * rows), bands, rows)
    differs = plain != weighted[again]
    owner = np.concatenate([np.repeat(np.flatnonzero(sizes), bands), np.repeat(again, differs.sum(axis=1))])
    values = np.concatenate([weighted[sizes > 0].reshape(-1), plain[differs]])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[np.argsort(owner, kind="stable")].view(np.int64)))
    return sizes, lists


def _signed(rows: DataFrame, bands: int, rows_per_band: int) -> DataFrame:
    """``doc_id``, ``node``, ``n`` (distinct shingles) and ``bands`` of every document with a text."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("n", pa.int32()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            for a, b in slices(batch.column("text"), SLICE_BYTES):
                sizes, lists = buckets(batch.column("text")[a:b], bands, rows_per_band)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], batch.column("node")[a:b], pa.array(sizes), lists], schema=schema
                )

    return rows.mapInArrow(run, "doc_id long, node binary, n int, bands array<long>")


def packed(hashes: np.ndarray) -> bytes:
    """Hashes of ``HASH_BITS`` bits, six bytes each; sets are most of what is stored and shuffled."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_SET_BYTES].tobytes()


def unpacked(data: pa.Buffer) -> np.ndarray:
    some = np.frombuffer(data, np.uint8).reshape(-1, _SET_BYTES)
    out = np.zeros((len(some), 8), np.uint8)
    out[:, :_SET_BYTES] = some
    return out.view("<u8").reshape(-1)


def _shingle_sets(rows: DataFrame) -> DataFrame:
    """``node`` and ``set``: its distinct shingle hashes, ascending, six bytes each."""
    schema = pa.schema([("node", pa.binary()), ("set", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            for a, b in slices(batch.column("text"), SLICE_BYTES):
                text, element, _ = distinct(*shingles(batch.column("text")[a:b]))
                bounds = np.searchsorted(text, np.arange(b - a + 1)).tolist()
                sets = [packed(element[x:y]) for x, y in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("node")[a:b], pa.array(sets, pa.binary())], schema=schema)

    return rows.mapInArrow(run, "node binary, set binary")


COMPARED = "pivot binary, node binary, pivot_n int, n int, both int, linked boolean, keep int, gained array<long>, lost_some array<long>, lost_all array<long>"


def _compared(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Each pair (``pivot``, ``node``) with the sizes of the shingle sets and of what they share,
    whether it is a link, and, where it is ``wide``, the shingles by which the node may meet others:

    ``gained``: those the pivot lacks.  A text as similar as asked for shares at least
    similarity * n of the node's shingles, of which the pivot has ``both`` at most, so it shares
    one of the first ``keep`` of these in any order.
    ``lost_some``: the first of those the node lacks, if it is smaller than the pivot; a partner
    not linked to the pivot has kept fewer than similarity / (1 + similarity) * (pivot_n - n).
    ``lost_all``: the first of those the node lacks, if it is not linked but has little of its own.
    Of either, a link whose texts share only what the pivot has needs no more than a share of
    the node's own size (see ``links``).
    """

    def facts(one: np.ndarray, other: np.ndarray, wide: bool) -> tuple:
        both = len(np.intersect1d(one, other, assume_unique=True))
        n, pivot_n = len(other), len(one)
        linked = both >= similarity * (n + pivot_n - both)
        if not wide:
            return pivot_n, n, both, linked, 0, other[:0], other[:0], other[:0]
        gained = np.setdiff1d(other, one, assume_unique=True)
        keep = max(0, len(gained) - max(1, math.ceil(similarity * n - both)) + 1)
        lost = np.setdiff1d(one, other, assume_unique=True)
        first = lost[: math.floor((1 - similarity) / similarity * n + 1e-6) + 1]
        some = first[: math.floor(similarity / (1 + similarity) * (pivot_n - n)) + 1] if n < pivot_n else lost[:0]
        whole = first if not linked and both >= similarity * n else lost[:0]
        return pivot_n, n, both, linked, keep, gained if keep else gained[:0], some, whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            for a, b in slices(batch.column("other"), SLICE_BYTES, 2_000, batch.column("one")):
                part = batch.slice(a, b - a)
                view = lambda name: [unpacked(x.as_buffer()) for x in part.column(name)]  # noqa: B023, E731
                found = [facts(*x) for x in zip(view("one"), view("other"), part.column("wide").to_pylist())]
                columns = list(zip(*found)) or [()] * 8
                lists = [[x.astype(np.int64) for x in c] for c in columns[5:]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("pivot"), part.column("node"), *[pa.array(c, pa.int32()) for c in columns[:3]],
                     pa.array(columns[3], pa.bool_()), pa.array(columns[4], pa.int32()), *[pa.array(c, pa.list_(pa.int64())) for c in lists]],
                    names=["pivot", "node", "pivot_n", "n", "both", "linked", "keep", "gained", "lost_some", "lost_all"],
                )

    # plain merge joins: sets are wide, and broadcasts that come and go with size would hide how it grows
    one = sets.select(F.col("node").alias("pivot"), F.col("set").alias("one")).hint("merge")
    other = sets.select("node", F.col("set").alias("other")).hint("merge")
    return pairs.join(other, "node").join(one, "pivot").select("pivot", "node", "wide", "one", "other").mapInArrow(run, COMPARED)


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds the ``label`` of each node: its class as far as links are known, or itself."""
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _led(members: DataFrame, weights: DataFrame, by: str, leaders: int, may=None) -> DataFrame:
    """``by``, ``pivot``, ``node``, ``lead`` (whether it is the first pivot) and ``rest`` (whether the
    node is no pivot): pairs of the ``leaders`` members of the most weight in each group with
    the members behind them.  The first pivot is compared with all, the others with those where
    ``may`` holds; ``pivot_*`` are the pivot's columns in it."""
    order = Window.partitionBy(by).orderBy(F.desc("weight"), F.xxhash64("node"), "node")
    ranked = members.join(weights, "node").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= leaders)
    own = [F.col(c).alias(f"pivot_{c}") for c in members.columns if c not in (by, "node")]
    pivots = written(ranked.select(by, F.col("node").alias("pivot"), *own, "rank"), "pivots")
    placed = members
    if leaders > 1:
        placed = members.join(pivots.select(by, F.col("pivot").alias("node"), F.col("rank").alias("own")), [by, "node"], "left")
    else:
        placed = members.withColumn("own", F.lit(None).cast("int"))
    pairs = placed.join(pivots, by).filter(F.col("own").isNull() | (F.col("own") > F.col("rank")))
    pairs = pairs.filter(F.col("node") != F.col("pivot"))
    if may is not None:
        pairs = pairs.filter((F.col("rank") == 1) | may)
    return pairs.select(by, "pivot", "node", (F.col("rank") == 1).alias("lead"), F.col("own").isNull().alias("rest"))


def _merged(members: DataFrame, weights: DataFrame) -> DataFrame:
    """Groups whose pivot is a member of a heavier pivot's group become part of that one, and so on
    up to a pivot that no other holds.  Pairs that meet stay in a group together, and fewer
    pivots are compared.

    A pivot comes before its members in the order of weight, so this ends; each step doubles how
    far a pivot has been followed.  Pairs move once, when all pivots have arrived.
    """
    heavier = members.join(weights.withColumnRenamed("node", "pivot"), "pivot").groupBy(F.col("node").alias("pivot")).agg(
        F.max(F.struct("weight", F.xxhash64("pivot"), "pivot")).alias("top")
    )
    roots = members.select("pivot").distinct().join(heavier, "pivot", "left")
    roots = written(roots.select("pivot", F.coalesce("top.pivot", "pivot").alias("root")), "roots")
    while True:
        above = roots.select(F.col("pivot").alias("root"), F.col("root").alias("far"))
        new = roots.join(above, "root").select("pivot", F.col("far").alias("root"), (F.col("far") != F.col("root")).alias("moved"))
        new = written(new, "roots")
        roots = new.select("pivot", "root")
        if new.filter("moved").isEmpty():
            break
    moved = members.join(roots, "pivot").select(F.col("root").alias("pivot"), "node")
    return moved.filter(F.col("node") != F.col("pivot")).distinct()


def _may_link(similarity: float):
    """Whether a pivot and a node of one group are of two classes so far and, by what each shares
    with the pivot before and has beside it, differ in few enough shingles for a link."""
    apart = lambda x, y: F.abs(x - y)
    both, n, pivot_both, pivot_n = (F.col(c) for c in ("both", "n", "pivot_both", "pivot_n"))
    least = apart(both, pivot_both) + apart(n - both, pivot_n - pivot_both)
    most = (1 - similarity) / (1 + similarity) * (n + pivot_n) + 1e-6
    return (F.col("label") != F.col("pivot_label")) & (least <= most)


def links(meetings: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (``pivot``, ``node``) that connect all texts of a class, from ``meetings`` (``bucket``, ``node``, ``size``)."""
    weights = written(meetings.groupBy("node").agg(F.sum("size").alias("weight")), "weights")
    first = _led(meetings.select("bucket", "node"), weights, "bucket", 1)
    members = written(first.select("pivot", "node").distinct(), "members")
    members = written(_merged(members, weights), "members")
    members = members.select(F.xxhash64("pivot").alias("group"), "pivot", "node", F.lit(True).alias("lead"), F.lit(True).alias("rest"))
    found, seen, leaders = [], members.select("group").limit(0), 1
    while True:
        pairs = members.groupBy("pivot", "node").agg(F.max(F.col("lead") & F.col("rest")).alias("wide"))
        compared = written(_compared(pairs, sets, similarity), "compared")
        found.append(compared.filter("linked").select("pivot", "node"))
        labels = components(reduce(DataFrame.union, found))
        groups = _labelled(members.filter("lead and rest").join(compared, ["pivot", "node"]), labels)
        open_ = groups.groupBy("group").agg(F.count(F.lit(1)).alias("left"), (F.min("label") != F.max("label")).alias("several"))
        rows = written(groups.join(open_.filter("several").select("group", "left"), "group"), "open-groups")

        # linked texts that share only what the pivot has share at least ``least`` of it, so before the first
        # shingle that both lost, each has lost at most what the other one shares with the pivot beyond that
        small = rows.select(
            "group", F.col("node").alias("pivot"), F.col("label").alias("small_label"), F.col("n").alias("small_n"),
            F.col("both").alias("small_both"), F.posexplode("lost_some").alias("small_place", "e"),
        )
        other = rows.filter("not linked").select("group", "node", "label", "n", "both", F.posexplode("lost_all").alias("place", "e"))
        least = F.lit(similarity / (1 + similarity)) * (F.col("n") + F.col("small_n")) - 1e-6
        fits = (F.col("both") - F.col("small_place") >= least) & (F.col("small_both") - F.col("place") >= least)
        fits = fits & (F.col("label") != F.col("small_label"))
        lost = small.join(other, (small["group"] == other["group"]) & (small["e"] == other["e"]) & fits)
        lost = written(lost.select("pivot", "node", F.lit(False).alias("wide")).distinct(), "lost-pairs")
        found.append(written(_compared(lost, sets, similarity).filter("linked").select("pivot", "node"), "links"))

        smaller = _smaller_groups(rows, seen)
        if smaller.isEmpty():
            return reduce(DataFrame.union, found)
        seen = written(seen.union(smaller.select("group").distinct()), "seen-groups")
        leaders *= 8
        members = written(_led(smaller, weights, "group", leaders, _may_link(similarity)), "members")


def _smaller_groups(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """``group``, ``node``, ``label``, ``n``, ``both`` of the groups to search next, from the members
    that are left in each.

    Members that share a gained shingle, not all of one class so far, are a group.  A member
    counts for the first ``keep`` of its shingles only: first those that lead to no other class,
    then the rarest, so that the groups are small.  Where these
    groups would together be at least half the work that the members left are (their sizes
    squared), those stay one group, so the work shrinks with every step.  A group is known by its members: an edit makes several shingles that
    the same texts share, and these are one group; none is searched twice.
    """
    member = F.xxhash64("node", F.lit("member"))
    known = [
        F.count(F.lit(1)).alias("c"), (F.min("label") != F.max("label")).alias("several"),
        F.bit_xor(member).alias("x"), F.bit_xor(F.xxhash64(member, member)).alias("y"),
    ]
    identity = F.xxhash64("c", "x", "y").alias("id")
    own = ["node", "label", "n", "both"]
    shared = rows.select(F.col("group").alias("parent"), "left", *own, "keep", F.explode("gained").alias("e"))
    useful = shared.groupBy("parent", "e").agg(F.count(F.lit(1)).alias("often"), (F.min("label") != F.max("label")).alias("several"))
    place = F.row_number().over(Window.partitionBy("parent", "node").orderBy("several", "often", "e"))
    shared = shared.join(useful, ["parent", "e"]).withColumn("place", place).filter("place <= keep and several")
    shared = written(shared.select("parent", "left", *own, F.xxhash64("parent", "e").alias("group")), "shared-shingles")
    several = shared.groupBy("parent", "left", "group").agg(*known).filter("several")
    several = written(several.groupBy("parent", "left", identity).agg(F.min("group").alias("group"), F.min("c").alias("c")), "shared")
    sizes = several.groupBy("parent", "left").agg(F.sum(F.col("c") * F.col("c")).alias("work"))
    fewer = F.col("work") * 2 <= F.col("left") * F.col("left")
    whole = sizes.filter(~fewer).select(F.col("parent").alias("group"))
    cut = several.join(sizes.filter(fewer).select("parent"), "parent").select("group", "id")
    uncut = rows.join(whole, "group").select("group", *own)
    uncut_id = uncut.groupBy("group").agg(*known).select("group", identity)
    one_each = cut.union(uncut_id).groupBy("id").agg(F.min("group").alias("group"))
    new = written(one_each.join(seen.select(F.col("group").alias("id")), "id", "left_anti").select("group", "id"), "groups")
    rows = shared.select("group", *own).union(uncut)
    return written(rows.join(new, "group").select(F.col("id").alias("group"), *own), "group-members")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) for every linked node.

    Each step takes the smallest label among a node and its neighbours and then the label of
    that label, so that chains shorten by half; it ends when nothing changes.
    """
    edges = written(
        links.select("pivot", "node").union(links.select(F.col("node").alias("pivot"), F.col("pivot").alias("node"))).distinct(),
        "edges",
    )
    labels = written(
        edges.groupBy("node").agg(F.min("pivot").alias("label")).select("node", F.least("node", "label").alias("label")), "labels"
    )
    while True:
        near = edges.join(labels.select(F.col("node").alias("pivot"), "label"), "pivot").select("node", "label", F.lit(None).alias("was"))
        near = labels.select("node", "label", F.col("label").alias("was")).union(near)
        near = near.groupBy("node").agg(F.min("label").alias("near"), F.max("was").alias("was"))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        new = near.join(jump, "near", "left").select("node", F.least("near", F.coalesce("far", "near")).alias("label"), "was")
        new = written(new, "labels")
        labels = new.select("node", "label")
        if new.filter("label != was").isEmpty():
            return labels


def _meetings(nodes: DataFrame) -> DataFrame:
    """``bucket``, ``node``, ``size`` of all buckets with more than one node."""
    places = nodes.select(F.explode("bands").alias("bucket"), "node")  # a hash tells its band
    shared = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return written(places.join(written(shared, "buckets"), "bucket"), "meetings")


def classes(
    docs: DataFrame, bands: int = BANDS, rows_per_band: int = ROWS, similarity: float = SIMILARITY
) -> DataFrame:
    """One row per document: ``doc_id``, ``node`` (digest of its text), ``class_id``, ``class_size``,
    ``n_texts`` (different texts in its class) and ``class_node``, the smallest node of the class."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("node", _digest("text"))
    signed = written(_signed(rows.filter("text is not null"), bands, rows_per_band), "signatures")
    nodes = written(
        signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")),
        "nodes",
    )
    meetings = _meetings(nodes)
    met = meetings.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    texts = rows.withColumnRenamed("doc_id", "own").join(met, "node").filter(F.col("own").eqNullSafe(F.col("doc_id")))
    sets = _shingle_sets(texts.select("node", "text"))
    sets = written(sets.groupBy("node").agg(F.first("set").alias("set")), "sets")

    labels = components(links(meetings, sets, similarity))
    named = nodes.select("node", "doc_id", "copies").join(labels, "node", "left")
    named = written(named.withColumn("label", F.coalesce("label", "node")), "named")
    sizes = written(
        named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"), F.count(F.lit(1)).alias("n_texts")),
        "classes",
    )
    of_node = written(named.select("node", "label").join(sizes, "label").withColumnRenamed("label", "class_node"), "node-classes")
    known = signed.select("doc_id", "node").join(of_node, "node")
    known = known.select("doc_id", "node", "class_id", "class_size", "n_texts", "class_node")
    alone = rows.filter("text is null").select(
        "doc_id", "node", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(1).cast("long").alias("n_texts"),
        F.lit(None).cast("binary").alias("class_node"),
    )
    return known.unionByName(alone)


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The documents of ``docs``, all columns, that stay: of each class the row of its smallest id.

    Rows that equal it in id and text are one document: the first of them stays.  Documents
    without a text are all kept.
    """
    found = written(classes(docs, **settings), "document-classes")
    digest, node, own = fresh(docs.columns, "_digest", "_node", "_id")
    # a class may hold different texts under its smallest id: the smallest digest stays
    stay = found.filter("class_id <=> doc_id and node is not null").groupBy("class_node").agg(
        F.min("node").alias(node), F.first("doc_id").alias(own)
    )
    rows = docs.withColumn(digest, _digest("text"))
    stay = written(stay.select(node, own), "stay")
    copies = found.join(stay, (F.col("node") == F.col(node)) & F.col("doc_id").eqNullSafe(F.col(own)))
    copies = written(copies.groupBy(node, own).count().filter("count > 1").select(node, own), "repeated")
    same = (F.col(digest) == F.col(node)) & F.col("doc_id").eqNullSafe(F.col(own))
    single = stay.join(copies, stay[node] == copies[node], "left_anti")
    kept = rows.join(single, same).select(*docs.columns)
    repeated = rows.join(copies, same).dropDuplicates([node]).select(*docs.columns)
    return kept.unionByName(repeated).unionByName(docs.filter("text is null"))
