"""Putting small summaries together without cross joins or one-task windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """Columns of several one-row summaries in one row.

    The frames are stacked with NULLs and folded by ``max``: a map-side aggregate over as
    many rows as there are frames.
    """
    columns = [name for frame in one_row_frames for name in frame.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames)
    return stacked.agg(*[F.max(name).alias(name) for name in columns])


def share_of_total(grouped: DataFrame, count: str) -> Column:
    """A group's count in percent of the sum over all groups, as a scalar subquery.

    The subquery reuses the exchange of ``grouped``; no window pulls all groups together.
    """
    whole = grouped.agg(F.sum(F.col(count)).alias("whole")).scalar()
    return F.col(count) * F.lit(100.0) / whole


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column one branch lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def labelled(frame: DataFrame, label: str, column: str = "layer") -> DataFrame:
    return frame.select(F.lit(label).alias(column), "*")
