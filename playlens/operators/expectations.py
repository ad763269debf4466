"""Row rules: warn, drop or fail, with counts taken in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalar import holds


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    policy: str = "warn"  # warn | drop | fail

    @property
    def passes(self) -> Column:
        return holds(F.expr(self.predicate))


# Names, predicates and policies of the data contract.
BRONZE_RULES = [
    Rule("valid_customer_id", "customerId IS NOT NULL AND length(customerId) > 0"),
    Rule("valid_client_id", "clientId IS NOT NULL"),
    Rule("valid_timestamp", "timestampInfo.server > 0"),
    Rule("valid_event_date", "eventDate IS NOT NULL"),
    Rule("no_rescued_data", "_rescued_data IS NULL"),
]
SILVER_RULES = [
    Rule("valid_buffering_count", "buffering_count >= 0", "drop"),
    Rule("valid_buffering_time", "buffering_time_ms >= 0", "drop"),
    Rule("valid_data_volumes", "total_source_data >= 0 AND total_p2p_data >= 0", "drop"),
    Rule("valid_quality_level", "quality_level IS NOT NULL", "drop"),
    Rule("reasonable_buffering", "buffering_time_sec <= 3600"),
]
QUARANTINE_RULES = [Rule("always_quarantine", "1 = 1")]


def timestamp_rules(as_of_ms: int) -> list[Rule]:
    """Server time is positive and not after "now"."""
    return [Rule("valid_timestamp", f"timestamp_server > 0 AND timestamp_server <= {as_of_ms}")]


ERROR_COUNT_RULES = [Rule("non_negative_errors", "error_count >= 0")]


def enforce(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Keep rows that meet every ``drop`` rule; raise on a row that breaks a ``fail`` rule."""
    for rule in rules:
        if rule.policy == "drop":
            df = df.filter(rule.passes)
        elif rule.policy == "fail":
            broken = F.raise_error(F.lit(f"expectation {rule.name} violated")).cast("boolean")
            df = df.filter(F.when(rule.passes, F.lit(True)).otherwise(broken))
    return df


def violation_columns(rules: list[Rule]) -> list[Column]:
    return [F.count_if(~rule.passes).alias(rule.name) for rule in rules]


def count_violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule with passed and failed counts, from a single aggregate."""
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *violation_columns(rules))
    entries = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.policy).alias("policy"),
                (F.col("_rows") - F.col(rule.name)).alias("passed"),
                F.col(rule.name).alias("failed"),
            )
            for rule in rules
        ]
    )
    return totals.select(F.inline(entries))


def observe(df: DataFrame, rules: list[Rule], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Attach the same counters to a job that is run anyway; read them from the observation."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *violation_columns(rules)), watch


def enforce_not_null(df: DataFrame, columns: list[str], mode: str = "fail") -> DataFrame:
    """NOT NULL on write: fail raises on the first NULL, drop removes the row."""
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    if mode == "drop":
        return df.filter(present)
    if mode != "fail":
        raise ValueError(f"unknown mode {mode!r}")
    message = F.lit("NULL in a NOT NULL column of " + ", ".join(columns))
    return df.filter(F.when(present, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
