"""Mixing sources to target weights by fitting subsets to a budget.

A source's target is its share by weight of a total budget, but at most ``most`` times its
size; what a capped source cannot take is shared by weight among the others until none is
above its cap.  A document's size is its number of words.  The budget of a source is met by
taking every document of it as often as it fits, and for the rest of the budget some once
more: a histogram counts the documents of each size, a share of every size is taken, fractions
of a document are dealt out by a seeded order, and bounded-knapsack dynamic programming over the
sizes fits what remains to the word if any subset does: all of it up to ``FITTED_WORDS``, and the
last words of a larger budget.  Where no subset does, as in a source of a few documents, some
copies are given back and the budget is fitted anew with up to ``most`` copies of each document,
to the nearest sum above or below.  That gives how many copies of each size are taken; the
documents of a size share them evenly, and which ones get one more is decided by a seeded hash
of id and text.

The histogram of one source is all that a task gathers: a row per different size.  Documents
of one source and size, which may be very many, are cut by their hash into cells of about
4,096 and ranked inside a cell.

Null text has size 0 and is taken as often as its source is whole.  A null source is a source
of its own, the last in order.  Rows that equal each other in id and text are ranked together
in any order, which tells them apart in no way.  A missing id counts like any value.  An empty
table, or one without words, takes nothing beyond zero.  Other columns are carried along under
any name.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh, ship, written

#: Weights by the order of the sources, repeating; times of its size a source gives at most.
WEIGHTS, MOST = (5, 2, 1), 3
#: Documents of one source and size that are ranked together, about.
CELL_ROWS = 4_096
#: Words of the budget that dynamic programming fits: all of it, or of a larger budget as many
#: as ``FITTING_WORK`` bit steps allow between these two, and four of the largest documents at least.
FITTED_WORDS, MOST_FITTED_WORDS, FITTING_WORK = 1 << 20, 1 << 23, 1 << 32


def words(text: Column) -> Column:
    """Number of runs of characters that are no ASCII white space; 0 for null."""
    runs = F.regexp_replace(text.cast("string"), r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(runs, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``weight`` and ``target`` to ``source`` and ``source_size``; the budget is all sizes.

    Sources are sorted by how early they reach their cap as all shares rise together.  A
    source is capped if the budget left by those before it would take it to its cap.  The
    frame has a row per source; windows over all of them run in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rows = rows.withColumn("level", left / F.sum("weight").over(onward))
    capped = F.col("level") * F.col("weight") >= F.col("cap")
    level = F.max(F.when(~capped, F.col("level"))).over(Window.partitionBy())
    free = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return rows.select("source", "source_size", "weight", free.alias("target"))


def fitted(sizes: list[int], counts: list[int], budget: int, seed: int = 0) -> dict[int, int]:
    """How many of each size to take (``counts`` at most) so that their sum comes up to ``budget``.

    Sizes are positive and differ.  A share of every size keeps the lengths of the source;
    what is then left is fitted exactly where possible, and never exceeded.
    """
    whole = sum(s * c for s, c in zip(sizes, counts))
    if whole <= budget:
        return dict(zip(sizes, counts))
    parts = sorted(zip(sizes, counts))
    draw = random.Random(seed)
    taken = {s: c * budget // whole for s, c in parts}
    spare = {s: c - taken[s] for s, c in parts}
    left = budget - sum(s * c for s, c in taken.items())
    documents = sum(spare.values())
    room = max(FITTED_WORDS, 4 * parts[-1][0], min(MOST_FITTED_WORDS, FITTING_WORK // documents))
    if left > room:
        # of every run of neighbouring sizes its share, from a seeded start: misses by two of the largest at most
        goal, total = left - room, sum(s * c for s, c in spare.items())
        sum_, dealt, start = 0, 0, draw.randrange(total)
        for size, _ in parts:
            sum_ += goal * spare[size]
            more = (sum_ + start) // total - dealt
            dealt += more
            taken[size], spare[size], left = taken[size] + more, spare[size] - more, left - more * size
    # the nearer a size's share was to one more document, the earlier that comes
    waits = {s: draw.expovariate(1.0) / (c * budget % whole or 0.5) for s, c in parts}
    for size, count in knapsack(spare, left, sorted(spare, key=waits.get)).items():
        taken[size] += count
    return taken


def refitted(counts: dict[int, int], copies: dict[int, int], left: int, most: int = MOST, seed: int = 0) -> dict[int, int]:
    """``copies`` by size changed so that their sum comes nearer to one that is ``left`` more, if any can.

    Documents give back one copy each, in a seeded order of their sizes until sixteen of the largest are free;
    the sum of all that is then missing is fitted with up to ``most`` copies of each document.  Where that
    does not meet the sum, they give back two, and so on."""
    draw = random.Random(seed)
    order = sorted(counts, key=lambda s: (draw.random(), s))
    goal, best = left + sum(s * k for s, k in copies.items()), copies
    for depth in range(1, most + 1):
        kept, freed = dict(copies), 0
        for size in order:
            if freed < 16 * depth * max(counts):
                back = min(kept[size], depth * counts[size], -(-16 * depth * max(counts) // size))
                kept[size], freed = kept[size] - back, freed + back * size
        added = knapsack({s: most * counts[s] - kept[s] for s in order}, left + freed, order, over=left)
        found = {s: kept[s] + added.get(s, 0) for s in counts}
        miss = lambda c: abs(goal - sum(s * k for s, k in c.items()))
        if miss(found) < miss(best):
            best = found
        if not miss(best):
            break
    return best


def knapsack(spare: dict[int, int], budget: int, order: list[int] | None = None, over: int = 0) -> dict[int, int]:
    """Counts up to ``spare`` whose sum is as near to ``budget`` as possible without exceeding it by more than ``over``.

    Bit s of a whole number says that the sum s can be reached.  One document of every size in
    ``order`` (largest first by default) is a part, then what else there is of each in parts
    of 1, 2, 4 ... documents, so that each part is one shift; the part that first reached a sum is kept to
    walk back.  It ends as soon as the budget itself is reached, so early sizes are preferred.
    """
    order = order or sorted(spare, reverse=True)
    last = budget + over
    most = {s: min(spare[s], last // s) for s in order}
    parts = [(s, 1) for s in order if most[s]]
    for size in order:
        count, step = most[size] - 1, 1
        while count > 0:
            parts.append((size, min(step, count)))
            count, step = count - step, step * 2
    mask, reach = (1 << last + 1) - 1, 1
    first = np.zeros(last + 1, np.int32)
    for number, (size, used) in enumerate(parts):
        if reach >> budget & 1:
            break
        added = reach << used * size & mask & ~reach
        if added:
            _mark(first, added, number)
            reach |= added
    at, out = (reach & (1 << budget + 1) - 1).bit_length() - 1, {}
    above = reach >> budget
    if above and (more := (above & -above).bit_length() - 1) < budget - at:
        at = budget + more
    while at:
        size, used = parts[first[at]]
        out[size] = out.get(size, 0) + used
        at -= used * size
    return out


def _mark(first: np.ndarray, bits: int, number: int) -> None:
    """``first[i] = number`` wherever bit i of ``bits`` is set."""
    low = (bits & -bits).bit_length() - 1 >> 3
    data = np.frombuffer((bits >> 8 * low).to_bytes((bits.bit_length() + 7 >> 3) - low, "little"), np.uint8)
    some = np.flatnonzero(data)
    where, bit = np.nonzero(np.unpackbits(data[some, None], axis=1, bitorder="little"))
    first[8 * (some[where] + low) + bit] = number


def plan(histogram: DataFrame, sources: DataFrame, most: int = MOST, seed: int = 0) -> DataFrame:
    """``p_source``, ``p_size``, ``n``, ``whole`` (times every document of the size is taken) and ``extra``
    (how many are taken once more)."""

    def per_source(rows: pd.DataFrame) -> pd.DataFrame:
        some = rows[rows["p_size"] > 0]
        counts = dict(zip(some["p_size"].tolist(), some["n"].tolist()))
        whole, budget = int(rows["whole"].iloc[0]), int(rows["budget"].iloc[0])
        copies = {s: whole * counts[s] + k for s, k in fitted(list(counts), list(counts.values()), budget, seed).items()}
        left = budget + sum(s * (whole * c - copies[s]) for s, c in counts.items())
        if left and counts:
            copies = refitted(counts, copies, left, most, seed)
        each = [divmod(copies[s], n) if s in copies else (whole, 0) for s, n in zip(rows["p_size"].tolist(), rows["n"].tolist())]
        rows = rows.assign(whole=[x for x, _ in each], extra=[x for _, x in each])
        return rows[["p_source", "p_size", "n", "whole", "extra"]]

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    budget = F.round(F.col("target") - whole * F.col("source_size")).cast("long")
    budgets = sources.select(F.col("source").alias("b_source"), whole.alias("whole"), budget.alias("budget"))
    rows = histogram.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "n")
    rows = rows.join(budgets, F.col("p_source").eqNullSafe(F.col("b_source"))).drop("b_source")
    return rows.groupBy("p_source").applyInPandas(per_source, "p_source string, p_size long, n long, whole long, extra long")


def choices(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``key`` (of the text), ``source``, ``size``,
    ``source_size``, ``target`` (its source's) and ``times``, how often the mix takes it."""
    ship(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.col("source").cast("string").alias("source"),
        words(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", text).alias("h"),
    )
    rows = written(rows, "sizes")
    histogram = written(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    sources = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = written(targets(sources, weights, most), "targets")
    planned = written(plan(histogram, sources, most, seed), "plan")

    rows = rows.join(planned, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")))
    cells = F.ceil(F.col("n") / CELL_ROWS)
    place = (F.col("h").cast("double") / F.lit(2.0**64) + 0.5) * cells
    rows = rows.withColumn("cell", F.least(F.floor(place), cells - 1)).drop("p_source", "p_size")
    open_ = rows.filter("extra > 0 and extra < n")
    full = open_.groupBy(F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.col("cell").alias("c_cell")).count()
    ahead = Window.partitionBy("c_source", "c_size").orderBy("c_cell").rowsBetween(Window.unboundedPreceding, -1)
    full = full.select("c_source", "c_size", "c_cell", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "cell").orderBy("h", "doc_id", "key"))
    ranked = open_.withColumn("rank", rank).join(
        full,
        F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size")) & (F.col("cell") == F.col("c_cell")),
    )
    once_more = (F.col("ahead") + F.col("rank") <= F.col("extra")).cast("long")
    keep = ["doc_id", "key", "source", "size"]
    some = ranked.select(*keep, (F.col("whole") + once_more).alias("times"))
    settled = rows.filter("not (extra > 0 and extra < n)")
    all_or_none = settled.select(*keep, (F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)).cast("long").alias("times"))
    known = sources.select(F.col("source").alias("s_source"), "source_size", "target")
    out = some.unionByName(all_or_none).join(known, F.col("source").eqNullSafe(F.col("s_source")))
    return out.select(*keep, "source_size", "target", "times")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """The mix itself: all columns of ``docs``, each row as often as the mix takes it."""
    own, key, copies, rows, number, text_key = fresh(docs.columns, "_id", "_key", "_copies", "_rows", "_number", "_text_key")
    chosen = choices(docs, weights, most, seed).filter("times > 0")
    chosen = chosen.groupBy(F.col("doc_id").alias(own), F.col("key").alias(key)).agg(
        F.sum("times").alias(copies), F.count(F.lit(1)).alias(rows)
    )
    chosen = written(chosen, "chosen")
    # rows that equal each other in id and text share their copies: one of them stands for all
    text = docs.withColumn(text_key, F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own)) & (F.col(text_key) == F.col(key))
    single = text.join(chosen.filter(F.col(rows) == 1), same)
    several = text.join(chosen.filter(F.col(rows) > 1), same).dropDuplicates([own, key])
    every = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(number)
    return single.unionByName(several).select(*docs.columns, every).select(*docs.columns)
