"""Ordered state within a key, for keys of any size.

A plain ``Window.partitionBy(session).orderBy(seq)`` puts a whole session into one task.
Here each session is cut into chunks of the order column.  Windows run inside a chunk; a
small aggregate per chunk is carried across the session's chunks, by the same method over
wider chunks where there may be many, and joined back on (session, chunk).  A task thus sees
at most ``CHUNK_WIDTH`` values of the order column, or chunks, of one session, however sparse
the values are.

A NULL in a key is a key of its own; keys are made free of NULLs once, so that the join back
uses the partitioning of the windows and each pass shuffles the rows once, or not at all if
the rows come from a pass over the same keys and chunks.  Rows whose order value is NULL come first.  Rows of one
order value are ordered by their other columns, so running values do not depend on placement;
rows that equal each other get different values in any order.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "_chunk"
#: Width of a chunk in units of the order column.
CHUNK_WIDTH = 1 << 16


@dataclass(frozen=True)
class Running(ABC):
    """A value that accumulates along the order; ``inclusive`` counts the current row."""

    value: Column
    inclusive: bool = True

    def frame(self, window: WindowSpec) -> WindowSpec:
        return window.rowsBetween(Window.unboundedPreceding, 0 if self.inclusive else -1)

    @abstractmethod
    def within(self, window: WindowSpec) -> Column:
        """The value so far inside the chunk."""

    @abstractmethod
    def per_chunk(self, place: Column) -> Column:
        """The chunk's contribution to later chunks; ``place`` orders its rows."""

    def over_chunks(self, name: str) -> Running:
        """The same state over the chunks before the current one."""
        return type(self)(F.col(name), False)

    def alone(self, keys: list[str], window: WindowSpec) -> Column:
        """The value where nothing is handed over: ``window`` holds all rows of a key."""
        return self.joined(self.within(window), F.lit(None))

    @abstractmethod
    def joined(self, within: Column, carried: Column) -> Column:
        """Both parts as one value."""


class RunningSum(Running):
    def within(self, window):
        return F.sum(self.value).over(self.frame(window))

    def per_chunk(self, place):
        return F.sum(self.value)

    def joined(self, within, carried):
        return F.coalesce(within, F.lit(0)) + F.coalesce(carried, F.lit(0))


class RunningMax(Running):
    """Highest value so far; of the order column itself, the latest row that has a mark."""

    def within(self, window):
        return F.max(self.value).over(self.frame(window))

    def per_chunk(self, place):
        return F.max(self.value)

    def joined(self, within, carried):
        return F.greatest(within, carried)


class LastValue(Running):
    """Latest value that is not NULL."""

    def within(self, window):
        return F.last(self.value, ignorenulls=True).over(self.frame(window))

    def per_chunk(self, place):
        return F.max_by(self.value, F.when(self.value.isNotNull(), place))

    def joined(self, within, carried):
        return F.coalesce(within, carried)


class GroupMin(Running):
    """Lowest value of the whole key, the same on every row."""

    def alone(self, keys, window):
        return F.min(self.value).over(Window.partitionBy(*keys))

    def within(self, window):
        return F.lit(None)

    def per_chunk(self, place):
        return F.min(self.value)

    def joined(self, within, carried):
        return carried


#: Chunk of the rows without an order value, before all others.
NO_ORDER = -(2**62)


def chunk(df: DataFrame, order: str, width: int = CHUNK_WIDTH, keys: list[str] | None = None) -> DataFrame:
    """Adds the chunk and the NULL-free form of the keys, unless the frame has them."""
    added = {} if CHUNK in df.columns else {CHUNK: F.coalesce(F.floor(F.col(order) / width), F.lit(NO_ORDER))}
    for key in keys or []:
        if df.schema[key].nullable and f"_key_{key}" not in df.columns:
            added[f"_key_{key}"] = F.coalesce(F.col(key).cast("string"), F.lit(""))
            added[f"_null_{key}"] = F.col(key).isNull()
    return df.withColumns(added) if added else df


def _null_free(df: DataFrame, keys: list[str]) -> list[str]:
    return [name for key in keys for name in ([f"_key_{key}", f"_null_{key}"] if f"_key_{key}" in df.columns else [key])]


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def with_running(
    df: DataFrame, keys: list[str], order: str, state: dict[str, Running], width: int = CHUNK_WIDTH, levels: int = 2
) -> DataFrame:
    """Add one column per entry of ``state``; ``order`` is a whole number.

    A frame that already has the chunk column (see ``chunk``) keeps it.  ``levels`` is how
    often rows are cut into chunks: two levels of 2^16 leave 2^16 chunks of a session to one task
    for order values of up to 48 bits; give a third for wider ones.
    """
    chunked = chunk(df, order, width, keys)
    return _running(chunked, CHUNK, _null_free(chunked, keys), order, state, width, levels).select(*df.columns, *state)


def _running(df: DataFrame, part: str | None, keys, order, state, width, levels) -> DataFrame:
    made = ("_key_", "_null_")
    ties = [f.name for f in df.schema if f.name not in {*keys, part, order} and not f.name.startswith(made) and _comparable(f.dataType)]
    group = [*keys, *([part] if part else [])]
    window = Window.partitionBy(*group).orderBy(order, *ties)
    if part is None:
        return df.select("*", *[running.alone(keys, window).alias(name) for name, running in state.items()])
    local = df.select("*", *[running.within(window).alias(f"_local_{name}") for name, running in state.items()])
    place = F.struct(order, *ties)
    per_chunk = df.groupBy(*group).agg(*[running.per_chunk(place).alias(name) for name, running in state.items()])
    above = None
    if levels > 1:
        above = f"{part}_"
        per_chunk = per_chunk.withColumn(above, F.floor(F.col(part) / width))
    later = {f"_carry_{name}": running.over_chunks(name) for name, running in state.items()}
    carry = _running(per_chunk, above, keys, part, later, width, levels - 1).select(*group, *later)
    return _with_carry(local, carry, group, df.columns, state)


def _with_carry(local: DataFrame, carry: DataFrame, group: list[str], columns: list[str], state) -> DataFrame:
    other = carry.select(*[F.col(c).alias(f"{c}_over") for c in group], *[f"_carry_{name}" for name in state])
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"{c}_over") for c in group])
    joined = [r.joined(F.col(f"_local_{n}"), F.col(f"_carry_{n}")).alias(n) for n, r in state.items()]
    return local.join(other, same).select(*columns, *joined)
