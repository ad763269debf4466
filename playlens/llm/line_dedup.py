"""Line dedup over overlapping windows of three lines, with Spark expressions only.

Lines are compared without white space at their ends, and blank lines stand outside: a window
is three consecutive lines that are not blank, and is known by a 128-bit hash of the hashes of
its lines.  A window seen before, at a smaller document id or earlier in the same document, is
a repeat; all positions that repeats cover are merged and those lines are removed.  Blank
lines and all lines outside of repeats stay.  A repeat may overlap the window it repeats.

Only hashes and positions are shuffled to find repeats; a text is moved once, to meet the
positions of its document.  Counts and first places are folded before the shuffle, so a very
common window is no large group.

Null text stays null.  A text of fewer than three lines that are not blank has no window and
stays.  Documents without id come after all others, in order of their text.  Rows that equal
each other in id and text are one place: they lose and keep the same lines.  Two texts under
one id are ordered by a digest.  An empty table gives no rows.  Other columns are carried
along under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, text_key, written

WINDOW = 3


def _bare(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def _windows(text: Column) -> Column:
    """Structs (a, b: hash; first: number of the first line among those that are not blank)."""
    lines = F.filter(F.transform(F.split(text, "\n"), _bare), lambda x: x != "")

    def windows(h: Column) -> Column:
        numbers = F.filter(F.sequence(F.lit(0), F.size(h)), lambda i: i < F.size(h) - (WINDOW - 1))
        part = lambda i, name: [F.get(h, i + k)[name] for k in range(WINDOW)]
        return F.transform(
            numbers,
            lambda i: F.struct(F.xxhash64(*part(i, "a")).alias("a"), F.xxhash64(*part(i, "b")).alias("b"), i.alias("first")),
        )

    return let(F.transform(lines, text_key), windows)


def repeats(docs: DataFrame) -> DataFrame:
    """``id``, ``key`` (of the text) and ``covered``: the numbers, among a document's lines that
    are not blank, of all lines in windows that were seen before; ascending."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = rows.filter("text is not null").select("id", F.xxhash64("text").alias("key"), F.explode(_windows(F.col("text"))).alias("w"))
    seen = written(rows.select("id", "key", "w.a", "w.b", "w.first"), "windows")
    several = seen.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b")
    met = written(seen.join(written(several, "shared-windows"), ["a", "b"]), "repeated-windows")
    place = F.struct(F.col("id").isNull().alias("late"), "id", "key", "first")
    origins = written(met.groupBy("a", "b").agg(F.min(place).alias("origin")), "first-windows")
    later = met.join(origins, ["a", "b"]).filter(~place.eqNullSafe(F.col("origin")))
    found = later.groupBy("id", "key").agg(F.collect_set("first").alias("firsts"))
    every = F.flatten(F.transform("firsts", lambda i: F.array(*[i + k for k in range(WINDOW)])))
    return found.select("id", "key", F.array_sort(F.array_distinct(every)).alias("covered"))


def without_lines(text: Column, covered: Column) -> Column:
    """The text without the covered ones of its lines that are not blank: what stands before,
    between and behind the covered lines is put together."""

    def kept(lines: Column) -> Column:
        full = F.filter(F.transform(lines, lambda x, i: F.when(_bare(x) != "", i)), lambda i: i.isNotNull())

        def between(lost: Column) -> Column:
            begin = lambda k: F.when(k == 0, 0).otherwise(F.get(lost, k - 1) + 1)
            end = lambda k: F.when(k == F.size(lost), F.size(lines)).otherwise(F.get(lost, k))
            parts = F.transform(
                F.sequence(F.lit(0), F.size(lost)), lambda k: F.slice(lines, begin(k) + 1, end(k) - begin(k))
            )
            return F.flatten(parts)

        return let(let(full, lambda f: F.transform(covered, lambda c: F.get(f, c))), between)

    return F.array_join(let(F.split(text, "\n"), kept), "\n")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with the repeated lines taken out of ``text``, and ``n_removed``,
    which replaces a column of that name."""
    own_id, own_key, covered = fresh([*docs.columns, "n_removed"], "_id", "_key", "_covered")
    found = repeats(docs).toDF(own_id, own_key, covered)
    (key,) = fresh([*docs.columns, own_id, own_key, covered], "_text_key")
    rows = docs.withColumn(key, F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key))
    rows = rows.join(found, same, "left")
    text = F.when(F.col(covered).isNull(), F.col("text")).otherwise(without_lines(F.col("text"), F.col(covered)))
    return rows.select(
        *[text.alias(c) if c == "text" else F.col(c) for c in docs.columns if c.lower() != "n_removed"],
        F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_removed"),
    )
