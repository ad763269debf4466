"""Column expressions shared by the operators and reports.  All stay JVM-side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MB = 1024.0 * 1024.0
GB = MB * 1024.0


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- time -------------------------------------------------------------------------------


def epoch_ms_to_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds as a UTC wall-clock timestamp, milliseconds kept."""
    return F.timestamp_millis(as_col(ms)).cast("timestamp_ntz")


def epoch_ms_to_date(ms: Column | str) -> Column:
    return F.to_date(F.timestamp_millis(as_col(ms)))


def moment(as_of_ts: str) -> Column:
    """The report's "now" as a literal, so that no report reads the clock."""
    return F.lit(as_of_ts).cast("timestamp")


def hours_since(ms: Column | str, as_of_ts: str) -> Column:
    return F.round((F.unix_timestamp(moment(as_of_ts)) - as_col(ms) / F.lit(1000.0)) / F.lit(3600.0), 2)


def minutes_since(ms: Column | str, as_of_ts: str) -> Column:
    """Whole minutes between an event and "now", as TIMESTAMPDIFF(MINUTE, ...) counts them."""
    return F.timestamp_diff("MINUTE", F.timestamp_millis(as_col(ms)), moment(as_of_ts))


def days_before(as_of: str, days: int) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), days)


def on_or_after(as_of: str, days: int, column: str = "eventDate") -> Column:
    """Rows of the last ``days`` days.  The column stays bare, so partitions are pruned."""
    return F.col(column) >= days_before(as_of, days)


def on_day(as_of: str, column: str = "eventDate") -> Column:
    return F.col(column) == F.lit(as_of).cast("date")


# --- units and ratios -------------------------------------------------------------------


def ms_to_seconds(ms: Column | str) -> Column:
    return as_col(ms) / F.lit(1000.0)


def to_megabytes(*byte_columns: Column | str) -> Column:
    """Sum of byte columns in MB; NULL if one of them is NULL."""
    return reduce(lambda a, b: a + b, map(as_col, byte_columns)) / F.lit(MB)


def percent(part: Column | str, whole: Column | str) -> Column:
    """``part`` in percent of ``whole`` as DOUBLE, NULL when ``whole`` is zero."""
    return as_col(part) * F.lit(100.0) / F.nullif(as_col(whole).cast("double"), F.lit(0.0))


def ratio(part: Column | str, whole: Column | str) -> Column:
    return as_col(part).cast("double") / F.nullif(as_col(whole).cast("double"), F.lit(0.0))


def exact_sum(column: Column | str) -> Column:
    """Sum of a DOUBLE column that does not depend on row order.

    Values are taken to six decimals as whole numbers and added as DECIMAL, so a retried or
    differently partitioned run gives the same bits.
    """
    units = F.floor(as_col(column) * F.lit(1e6) + F.lit(0.5))
    return F.sum(units.cast("decimal(20,0)")).cast("double") / F.lit(1e6)


def exact_avg(column: Column | str) -> Column:
    return exact_sum(column) / F.count(as_col(column))


# --- defaults and cleaning --------------------------------------------------------------


def or_default(value: Column | str, default) -> Column:
    """The collector's falsy default for text: NULL and the empty string give way."""
    value = as_col(value)
    return F.when(value.isNull() | (value == ""), F.lit(default)).otherwise(value)


def finite_or(value: Column | str, default) -> Column:
    """Default for NULL, NaN and infinities; anything else passes."""
    value = as_col(value)
    number = value.cast("double")
    bad = value.isNull() | F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    return F.when(bad, F.lit(default)).otherwise(value)


def cap(value: Column | str, ceiling) -> Column:
    """Values above the ceiling become the ceiling; NULL stays NULL."""
    value = as_col(value)
    return F.when(value > ceiling, F.lit(ceiling)).otherwise(value)


def ellipsis(text: Column | str, length: int = 180) -> Column:
    text = as_col(text)
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)


def upper_or(text: Column | str, default: str = "unknown") -> Column:
    return F.upper(or_default(text, default))


def holds(predicate: Column) -> Column:
    """A predicate whose NULL counts as a violation."""
    return F.coalesce(predicate, F.lit(False))


# --- labels -----------------------------------------------------------------------------


def first_match(cases: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """Label of the first condition that is true."""
    chain = reduce(lambda acc, case: acc.when(case[0], case[1]), cases, F)
    return chain.otherwise(F.lit(otherwise))


def tier(value: Column, alert: float, warning: float | None = None, below: bool = False) -> Column:
    """ALERT, WARNING or OK against one or two limits."""
    beyond = (lambda limit: value < limit) if below else (lambda limit: value > limit)
    cases = [(beyond(alert), "ALERT")]
    if warning is not None:
        cases.append((beyond(warning), "WARNING"))
    return first_match(cases, "OK")


def rank_of(value: Column | str, order: list[str]) -> Column:
    """Position of a label in a given order, for custom sorts."""
    value = as_col(value)
    return first_match([(value == label, place) for place, label in enumerate(order, 1)])
