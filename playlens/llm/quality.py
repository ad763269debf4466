"""Quality score by a generalised additive model with pairwise interactions.

A text is described by ``FEATURES``, counted over its whole bytes.  Each feature is cut into
bins at quantiles of the sample.  The model is a sum of lookup tables over bins: one per
feature, learned by cyclic boosting (the features take turns, each adds a shallow tree of its
own over the gradients left by all others), then one per pair of the ``PAIRS`` pairs with the
most left to gain, learned in the same way by trees that cut both features once.  A score adds
the cells a text falls into and squashes the sum to (0, 1): the chance of label 1.

Bound of the sample: ``SAMPLE_ROWS`` labelled rows, those of the smallest hashes of their id.
Rows with crc32(id) mod 5 = 0 are held out of it.  Statistics of a text, and scores, cover
all rows and whole texts.  Only text is an input of a score.

A label other than 0 and 1, a label without id and a label whose document is missing are left
out; each label of a repeated document, and each document of a label, counts.  Without two
classes to learn from every score is the share of label 1, or one half if there is no label.
A null text counts as empty; empty texts are scored like others.  A row without id is not held
out.  Repeated rows are scored each.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, ship, slices, written
from .shingles import distinct, steps, word_hashes

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 48, 12, 8
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 120, 60, 0.15, 2.0
SLICE_BYTES, SLICE_ROWS = 1 << 20, 5_000
PREDICTED = ("score", "predicted")
THRESHOLD = 0.3

FEATURES = (
    "bytes", "words", "lines", "word bytes", "longest word", "upper share", "digit share", "mark share", "symbol share",
    "blank share", "wide share", "words with symbols", "short words", "different words", "different word pairs",
    "commonest word", "marks a word",
)

UPPER, LOWER, DIGIT, MARK, SYMBOL, BLANK, LINE, WIDE = range(8)


def _kind(byte: int) -> int:
    char = chr(byte)
    if byte >= 128:
        return WIDE
    if char.isalpha():
        return UPPER if char.isupper() else LOWER
    if char.isdigit():
        return DIGIT
    if char == "\n":
        return LINE
    return BLANK if byte <= 32 else MARK if char in ".,;:?'\"()-" else SYMBOL


_KINDS = np.array([_kind(b) for b in range(256)], np.uint8)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return np.zeros((0, len(FEATURES)))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    bounds = offsets - offsets[0]
    kinds, symbols, short, longest = np.zeros((n, 8)), np.zeros(n), np.zeros(n), np.zeros(n)
    hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for a, b in steps(data, bounds[:-1]):  # a text longer than a step is counted in several
        part = _KINDS[data[a:b]]
        low, high = np.searchsorted(bounds, a, "right") - 1, np.searchsorted(bounds, b, "left")
        own = np.diff(np.clip(bounds[low : high + 1], a, b))
        text = np.repeat(np.arange(low, low + len(own)), own)
        kinds += np.bincount(text * 8 + part, minlength=8 * n).reshape(n, 8)
        inside = bounds[:-1]
        found, first = word_hashes(data[a:b], inside[(inside >= a) & (inside < b)] - a)
        if not len(found):
            continue
        owner = text[first]
        size = np.add.reduceat(((part != BLANK) & (part != LINE)).astype(np.int64), first)
        odd = np.add.reduceat((part == SYMBOL).astype(np.int64), first) > 0
        symbols += np.bincount(owner[odd], minlength=n)
        short += np.bincount(owner[size <= 1], minlength=n)
        np.maximum.at(longest, owner, size)
        hashes.append(found)
        owners.append(owner)
    word, owner = np.concatenate(hashes), np.concatenate(owners)
    words = np.bincount(owner, minlength=n)
    pair_of = owner[1:][owner[1:] == owner[:-1]]
    pair = (word[1:] * _MIX + word[:-1])[owner[1:] == owner[:-1]] * _MIX
    pairs = np.bincount(pair_of, minlength=n)
    text, _, often = distinct(word, words)
    commonest = np.zeros(n)
    np.maximum.at(commonest, text, often)
    different = np.bincount(text, minlength=n)
    different_pairs = np.bincount(distinct(pair, pairs)[0], minlength=n)
    size = kinds.sum(axis=1)
    share = lambda some, whole: some / np.maximum(whole, 1)
    letters = kinds[:, UPPER] + kinds[:, LOWER]
    solid = size - kinds[:, BLANK] - kinds[:, LINE]
    return np.stack([
        np.log1p(size), np.log1p(words), np.log1p(kinds[:, LINE]), share(solid, words), np.log1p(longest),
        share(kinds[:, UPPER], letters), share(kinds[:, DIGIT], size), share(kinds[:, MARK], size),
        share(kinds[:, SYMBOL], size), share(kinds[:, BLANK] + kinds[:, LINE], size), share(kinds[:, WIDE], size),
        share(symbols, words), share(short, words), share(different, words), share(different_pairs, pairs),
        share(commonest, words), share(kinds[:, MARK], words),
    ], axis=1)


@dataclass
class Additive:
    """Lookup tables over bins; ``edges`` and ``coarse`` are the cuts of single and of paired features."""

    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    single: list[np.ndarray] = field(default_factory=list)
    paired: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        for i, table in enumerate(self.single):
            total += table[np.searchsorted(self.edges[i], rows[:, i], "right")]
        for i, j, table in self.paired:
            total += table[np.searchsorted(self.coarse[i], rows[:, i], "right"), np.searchsorted(self.coarse[j], rows[:, j], "right")]
        return chance(total)


def chance(total: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Borders between at most ``bins`` bins of about as many values each."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _step(g, h):
    return g / (h + RIDGE)


def _worth(g, h):
    return g * g / (h + RIDGE)


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values, per bin, of a tree over the ordered bins; ``g`` and ``h``: gradients and curvatures by bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for at, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            whole_g, whole_h = g[a:b].sum(), h[a:b].sum()
            gain = _worth(left_g, left_h) + _worth(whole_g - left_g, whole_h - left_h) - _worth(whole_g, whole_h)
            if gain.max() > best[0]:
                best = (gain.max(), at, a + 1 + int(gain.argmax()))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _step(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(table: np.ndarray) -> list[np.ndarray]:
    """Sums of the four quadrants that each pair of cuts leaves."""
    sums = table.cumsum(axis=0).cumsum(axis=1)
    a, rows, columns, whole = sums[:-1, :-1], sums[:-1, -1:], sums[-1:, :-1], sums[-1, -1]
    return [a, rows - a, columns - a, whole - rows - columns + a]


def cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best tree with one cut in each of two features."""
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    gs, hs = _quadrants(g), _quadrants(h)
    gain = sum(_worth(x, y) for x, y in zip(gs, hs)) - _worth(g.sum(), h.sum())
    r, c = np.unravel_index(int(gain.argmax()), gain.shape)
    values = [_step(x[r, c], y[r, c]) for x, y in zip(gs, hs)]
    out = np.empty(g.shape)
    out[: r + 1, : c + 1], out[: r + 1, c + 1 :], out[r + 1 :, : c + 1], out[r + 1 :, c + 1 :] = values
    return float(gain[r, c]), out


def fit(rows: np.ndarray, labels: np.ndarray) -> Additive:
    """Boosts the tables of a sample of features and labels (0 or 1)."""
    if not len(labels):
        return Additive(0.0)
    base = float(np.clip(labels.mean(), 1e-4, 1 - 1e-4))
    model = Additive(float(np.log(base / (1 - base))))
    if labels.min() == labels.max():
        return model
    model.edges = [cuts(x, BINS) for x in rows.T]
    model.coarse = [cuts(x, PAIR_BINS) for x in rows.T]
    fine = [np.searchsorted(e, x, "right") for e, x in zip(model.edges, rows.T)]
    wide = [np.searchsorted(e, x, "right") for e, x in zip(model.coarse, rows.T)]
    model.single = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(rows), model.start)
    for _ in range(ROUNDS):
        for i, place in enumerate(fine):
            p = chance(total)
            n = len(model.single[i])
            added = RATE * shallow_tree(np.bincount(place, labels - p, n), np.bincount(place, p * (1 - p), n))
            model.single[i] += added
            total += added[place]
    p = chance(total)
    found = []
    for i, j in combinations(range(rows.shape[1]), 2):
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        cell = wide[i] * shape[1] + wide[j]
        sums = [np.bincount(cell, x, shape[0] * shape[1]).reshape(shape) for x in (labels - p, p * (1 - p))]
        found.append((-cross_tree(*sums)[0], i, j, cell, shape))
    chosen = sorted(found, key=lambda x: x[:3])[:PAIRS]
    tables = [np.zeros(shape) for *_, shape in chosen]
    for _ in range(PAIR_ROUNDS):
        for table, (_, _, _, cell, shape) in zip(tables, chosen):
            p = chance(total)
            sums = [np.bincount(cell, x, shape[0] * shape[1]).reshape(shape) for x in (labels - p, p * (1 - p))]
            added = RATE * cross_tree(*sums)[1]
            table += added
            total += added.ravel()[cell]
    model.paired = [(i, j, table) for table, (_, i, j, _, _) in zip(tables, chosen)]
    return model


def held_out(column: str = "doc_id") -> Column:
    """Whether the label of a document may not be learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Additive:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    ship(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("string").alias("_id"), F.col("quality").cast("int").alias("y"))
    known = known.filter(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("_id")).withColumn("h", F.xxhash64("_id"))
    total = known.count()
    # a range of hashes that holds a little more than the sample, so no task sorts more than that
    parts = 1 << 20
    low = parts if total <= sample_rows else -(-parts * sample_rows * 5 // (4 * total))
    some = known.filter(F.pmod("h", F.lit(parts)) < low).orderBy(F.pmod("h", F.lit(parts)), "h", "_id", "y").limit(sample_rows)
    sample = written(some, "labels")
    rows = docs.select(F.col("doc_id").cast("string").alias("_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(sample), "_id").select("h", "y", "text")  # at most ``sample_rows`` labels

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text"), SLICE_BYTES, SLICE_ROWS):
                found = features(batch.column("text")[a:b])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("h")[a:b], batch.column("y")[a:b], lists], names=["h", "y", "x"])

    made = rows.mapInArrow(described, "h long, y int, x array<double>")
    got = written(made, "label-features").orderBy("h", "y", "x").limit(sample_rows).collect()  # repeated ids could exceed the bound
    x = np.array([r.x for r in got], float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r.y for r in got], float))


def score(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs`` and ``score``, ``predicted``, which replace columns of the same names."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size
    kept = [F.col(c) for c in docs.columns if c.lower() not in PREDICTED]
    (found,) = fresh(docs.columns, "_score")

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [shared.value.score(features(texts[a:b])) for a, b in slices(texts, SLICE_BYTES, SLICE_ROWS)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0))

    rows = docs.withColumn(found, scored(F.col("text").cast("string")))
    return rows.select(*kept, F.col(found).alias("score"), (F.col(found) >= threshold).cast("int").alias("predicted"))
