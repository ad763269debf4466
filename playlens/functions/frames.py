"""Helpers on whole frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, columns: dict[str, Column], keep: list[str]) -> DataFrame:
    """Evaluate derived columns once per row.

    A one-element ``inline`` is a generator, and predicates on generated columns stay above
    it.  Without it the optimizer copies a costly derivation, such as parsing JSON, into
    every expression and pushed-down predicate that uses it, and the generated code can
    outgrow its size limit.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
