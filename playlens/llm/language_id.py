"""Language identification by nearest centroid.

A text is a vector of hashed byte n-grams (one to four bytes, lower case, everything that is
no letter one blank), damped, weighted by inverse document frequency and normalised.  Each
language has a few centroids, found by spherical k-means over a bounded sample of labelled
rows; the language of the centroid with the highest cosine is predicted and that cosine is
the score.  A text is rejected if it is farther from its centroid than nearly all of the
sample: its cosine is below ``SLACK`` times what the lowest ``TAIL`` of that language reaches.
It is also rejected if it is made of other n-grams than any language: a table of 2**SEEN_LOG_SIZE
places holds the four-byte n-grams of the sample, and the share of the text's that are found there
must come up to ``SEEN_SLACK`` times that of nearly all of the sample, where each text is looked
up among the others.

Bound of the sample: ``SAMPLE_ROWS`` rows in all, shared evenly by the languages and chosen by
a hash of the id.  Rows with crc32(id) mod 3 = 1 are held out of it.  Every other step covers
all rows and whole texts.

A text that is null or has no letter is ``und`` with score 0 and rejected; so is every text if
there is no labelled row to learn from.  A row without id is not held out.  Repeated rows are
predicted each.  Ties go to the first language in order.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import freeing, fresh, ship, slices, written

SAMPLE_ROWS = 4_000
CENTROIDS = 3
LOG_SIZE = 11
TAIL, SLACK = 0.002, 0.25
SEEN_LOG_SIZE, SEEN_SLACK, SEEN_TASKS = 20, 0.8, 16
SLICE_BYTES, SLICE_ROWS = 1 << 19, 250
UNKNOWN = "und"
PREDICTED = ("lang_pred", "score", "rejected")

_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 32


def _cleaned(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, lower case and with blanks, and the number of the text of each."""
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = np.frombuffer(lowered.buffers()[1], np.int64)[lowered.offset : lowered.offset + len(lowered) + 1]
    raw = lowered.buffers()[2]
    if not len(lowered) or raw is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = _LETTERS[np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]]
    text = np.repeat(np.arange(len(lowered)), np.diff(offsets))
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32) | (text[1:] != text[:-1])
    return data[keep].astype(np.uint64), text[keep]


def counts(texts: pa.Array, log_size: int = LOG_SIZE) -> np.ndarray:
    """How often each hashed n-gram occurs in each text."""
    n, size = len(texts), 1 << log_size
    data, text = _cleaned(texts)
    out = np.zeros(n * size, np.float32)
    gram = data
    for k in range(min(4, len(data))):
        if k:
            gram = gram[:-1] | (data[k:] << np.uint64(8 * k))
        first = text[: len(gram)]
        inside = first == text[k:]
        place = (gram + np.uint64(k + 1 << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - log_size)
        out += np.bincount((first * size + place.astype(np.int64))[inside], minlength=n * size)
    return out.reshape(n, size)


def fours(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of the text and the place in the table of every four-byte n-gram."""
    data, text = _cleaned(texts)
    if len(data) < 4:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gram = data[:-3] | data[1:-2] << np.uint64(8) | data[2:-1] << np.uint64(16) | data[3:] << np.uint64(24)
    place = gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SEEN_LOG_SIZE)
    inside = text[:-3] == text[3:]
    return text[:-3][inside], place[inside].astype(np.int64)


def tally(texts: pa.Array) -> np.ndarray:
    """In how many of the texts each place of the table occurs: 0, 1, or 2 for more."""
    text, place = fours(texts)
    different = np.unique(text << SEEN_LOG_SIZE | place) & (1 << SEEN_LOG_SIZE) - 1
    return np.minimum(np.bincount(different, minlength=1 << SEEN_LOG_SIZE), 2).astype(np.uint8)


def seen_share(texts: pa.Array, table: np.ndarray, least: int = 1) -> np.ndarray:
    """Share of each text's four-byte n-grams that ``least`` texts of the sample have; 1 if it has none."""
    text, place = fours(texts)
    every = np.bincount(text, minlength=len(texts))
    found = np.bincount(text[table[place] >= least], minlength=len(texts))
    return np.where(every > 0, found / np.maximum(every, 1), 1.0)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    least: np.ndarray
    seen: np.ndarray | None = None
    least_seen: np.ndarray | None = None

    def unlike(self, texts: pa.Array, language: np.ndarray) -> np.ndarray:
        """Whether each text has too few n-grams of the sample for its language."""
        return seen_share(texts, self.seen) < self.least_seen[language]

    def predict(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language, score and whether it is rejected, for rows of n-gram counts."""
        near = unit(np.log1p(found) * self.idf) @ self.centroids.T
        best = near.argmax(axis=1)
        score = np.clip(near[np.arange(len(near)), best].astype(float), 0, 1)
        return self.owner[best], score, score < self.least[best]


def fit(labels: list[str], found: np.ndarray, centroids: int = CENTROIDS) -> Model:
    """The model of a sample of labelled n-gram counts."""
    idf = (np.log((1 + len(found)) / (1 + (found > 0).sum(axis=0))) + 1).astype(np.float32)
    vectors = unit(np.log1p(found) * idf)
    languages = sorted(set(labels))
    tags = np.array(labels, object)
    made, owner, least = [], [], []
    for number, language in enumerate(languages):
        own = vectors[tags == language]
        k = min(centroids, len(own))
        draw = np.random.default_rng(number)
        means = own[draw.choice(len(own), k, replace=False)]
        for _ in range(12):
            best = (own @ means.T).argmax(axis=1)
            means = unit(np.stack([own[best == i].sum(axis=0) if (best == i).any() else means[i] for i in range(k)]))
        near = (own @ means.T).max(axis=1)
        made.append(means)
        owner += [number] * k
        least += [SLACK * float(np.quantile(near, TAIL))] * k
    return Model(languages, idf, np.concatenate(made).astype(np.float32), np.array(owner), np.array(least))


def held_out(column: str = "doc_id"):
    """Whether a document may not be learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on a bounded sample of the rows with a language that are not held out."""
    ship(docs.sparkSession)
    rows = docs.filter(F.col("lang").isNotNull() & ~held_out())
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("h"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.countDistinct("lang")).first()[0]
    if not total:
        return None
    share = max(1, sample_rows // total)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    ranked = rows.select("lang", "h").withColumn("rank", rank).filter(F.col("rank") <= share)
    last = ranked.groupBy("lang").agg(F.max("h").alias("last"))
    sample = rows.join(F.broadcast(last), "lang").filter("h <= last").select("lang", "h", "text")
    sample = written(sample.repartition(SEEN_TASKS, "h"), "language-sample")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            for a, b in slices(batch.column("text"), SLICE_BYTES, SLICE_ROWS):
                found = np.minimum(counts(batch.column("text")[a:b]), 60_000).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang")[a:b], batch.column("h")[a:b], pa.array([x.tobytes() for x in found], pa.binary())],
                    names=["lang", "h", "vector"],
                )

    made = sample.mapInArrow(vectors, "lang string, h long, vector binary").orderBy("h", "lang", "vector")
    got = made.limit(share * total).collect()  # repeated ids could exceed the bound
    found = np.stack([np.frombuffer(r.vector, np.float16) for r in got]).astype(np.float32)
    some = found.any(axis=1)
    if not some.any():
        return None
    model = fit([r.lang for r, s in zip(got, some) if s], found[some])
    model.seen, lowest = _seen(sample)
    model.least_seen = np.array([SEEN_SLACK * lowest.get(x, 0.0) for x in model.languages])
    return model


def _seen(sample: DataFrame) -> tuple[np.ndarray, dict[str, float]]:
    """The table of the sample's n-grams, and the lowest ``TAIL`` of each language's shares."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(1 << SEEN_LOG_SIZE, np.uint8)
        for batch in freeing(batches):
            for a, b in slices(batch.column("text"), SLICE_BYTES, SLICE_ROWS):
                whole = np.minimum(whole + tally(batch.column("text")[a:b]), 2)
        yield pa.RecordBatch.from_arrays([pa.array([whole.tobytes()], pa.binary())], names=["seen"])

    made = sample.select("text").coalesce(SEEN_TASKS).mapInArrow(tables, "seen binary")
    table = np.zeros(1 << SEEN_LOG_SIZE, np.uint8)
    for row in made.collect():  # SEEN_TASKS rows
        table = np.minimum(table + np.frombuffer(row.seen, np.uint8), 2)
    shared = sample.sparkSession.sparkContext.broadcast(table)

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freeing(batches):
            for a, b in slices(batch.column("text"), SLICE_BYTES, SLICE_ROWS):
                found = seen_share(batch.column("text")[a:b], shared.value, 2)  # itself and another one
                yield pa.RecordBatch.from_arrays([batch.column("lang")[a:b], pa.array(found)], names=["lang", "share"])

    found = sample.select("lang", "text").mapInArrow(shares, "lang string, share double")
    return table, {r.lang: r.low for r in found.groupBy("lang").agg(F.percentile("share", F.lit(TAIL)).alias("low")).collect()}


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of ``docs`` and ``lang_pred``, ``score``, ``rejected``, which replace columns
    of the same names; predicted from the text alone."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text, lettered, guessed = fresh(docs.columns, "_text", "_lettered", "_guessed")
    kept = [F.col(c) for c in docs.columns if c.lower() not in PREDICTED]
    rows = docs.withColumn(text, F.col("text").cast("string"))
    rows = rows.withColumn(lettered, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def guess(texts: pa.Array, with_letter: pa.Array) -> pa.Array:
        model = shared.value
        lettered = with_letter.to_numpy(zero_copy_only=False)
        names = np.full(len(texts), UNKNOWN, object)
        scores, odd = np.zeros(len(texts)), np.ones(len(texts), bool)
        if model is not None:
            for a, b in slices(texts, SLICE_BYTES, SLICE_ROWS):
                language, scores[a:b], far = model.predict(counts(texts[a:b]))
                odd[a:b] = far | model.unlike(texts[a:b], language)
                names[a:b] = np.array(model.languages, object)[language]
        made = [
            pa.array(np.where(lettered, names, UNKNOWN), pa.string()), pa.array(np.where(lettered, scores, 0.0)),
            pa.array(odd | ~lettered),
        ]
        return pa.StructArray.from_arrays(made, names=["lang_pred", "score", "rejected"])

    return rows.withColumn(guessed, guess(text, lettered)).select(*kept, f"{guessed}.*")
