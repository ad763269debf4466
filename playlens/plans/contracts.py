"""Data contract checks.  Each is a one-row frame: check, category, status, message, value."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.scalar import first_match, hours_since
from ..operators.combine import side_by_side, stack
from ..operators.dedupe import duplicate_summary
from ..operators.medallion import is_faulty
from ..sources import files
from .alerts import row_total

RESULT = schemas.struct(
    check=schemas.TEXT, category=schemas.TEXT, status=schemas.TEXT, message=schemas.TEXT, value=schemas.REAL
)


def _line(check: str, category: str, status: Column, message: Column, value: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        F.lit(category).alias("category"),
        status.alias("status"),
        message.alias("message"),
        value.cast("double").alias("value"),
    ]


def _fixed(spark: SparkSession, check: str, category: str, status: str, message: str, value: float | None = None):
    line = _line(check, category, F.lit(status), F.lit(message), F.lit(value).cast("double"))
    return spark.range(1).select(*line)


def verdict(fails: Column, warns: Column | None = None) -> Column:
    cases = [(fails, "FAIL")] + ([(warns, "WARN")] if warns is not None else [])
    return first_match(cases, "PASS")


# --- schema checks ----------------------------------------------------------------------


def tables_exist(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    missing = [name for name, path in paths.items() if not files.exists(spark, path)]
    message = f"Missing tables: {', '.join(missing)}" if missing else f"All {len(paths)} tables exist"
    status = "FAIL" if missing else "PASS"
    return _fixed(spark, "Table Existence Check", "Schema Validation", status, message, float(len(missing)))


def bronze_schema(bronze: DataFrame, allow_extra: bool = True) -> DataFrame:
    expected = [n for n in schemas.BRONZE.names if n != "_rescued_data"]
    missing = [n for n in expected if n not in bronze.columns]
    extra = [n for n in bronze.columns if n not in schemas.BRONZE.names]
    nested = bronze.schema["timestampInfo"].dataType if "timestampInfo" in bronze.columns else None
    problems = []
    if missing:
        problems.append(f"missing {missing}")
    if extra and not allow_extra:
        problems.append(f"unexpected {extra}")
    if not isinstance(nested, T.StructType) or "server" not in nested.names:
        problems.append("timestampInfo has no server field")
    message = "; ".join(problems) or f"Bronze schema valid with {len(bronze.columns)} columns"
    status = "FAIL" if problems else "PASS"
    name = "Bronze Layer Schema Validation"
    return _fixed(bronze.sparkSession, name, "Schema Validation", status, message, float(len(problems)))


def silver_schema(silver: DataFrame) -> DataFrame:
    missing = [n for n in schemas.SILVER.names if n not in silver.columns]
    nested = [f.name for f in silver.schema if f.dataType.typeName() in ("struct", "map", "array")]
    problems = ([f"missing {missing}"] if missing else []) + ([f"still nested {nested}"] if nested else [])
    message = "; ".join(problems) or f"Silver schema valid with {len(silver.columns)} columns"
    status = "FAIL" if problems else "PASS"
    name = "Silver Layer Schema Validation"
    return _fixed(silver.sparkSession, name, "Schema Validation", status, message, float(len(problems)))


# --- data checks ------------------------------------------------------------------------


def null_counts(silver: DataFrame, columns: list[str] = schemas.REQUIRED_SILVER) -> DataFrame:
    """NULLs per required column, long form, from one aggregate."""
    totals = silver.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return totals.select(F.inline(lines))


# Each check is a set of facts (aggregates over one table) and a line (columns over the
# facts), so that checks of one table can share a scan; see ``all_checks``.


def _null_facts(columns: list[str] = schemas.REQUIRED_SILVER) -> list[Column]:
    nulls = sum((F.col(c).isNull().cast("bigint") for c in columns), F.lit(0))
    return [row_total("silver_rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("nulls")]


def _null_line() -> list[Column]:
    nulls, rows = F.col("nulls"), F.col("silver_rows")
    message = F.concat(nulls.cast("string"), F.lit(" nulls in "), rows.cast("string"), F.lit(" rows"))
    return _line("NOT NULL Constraints Validation", "Data Quality", verdict(nulls > 0, rows == 0), message, nulls)


def not_null(silver: DataFrame, columns: list[str] = schemas.REQUIRED_SILVER) -> DataFrame:
    return silver.agg(*_null_facts(columns)).select(*_null_line())


def _range_facts() -> list[Column]:
    broken = {
        "bad_count": F.col("buffering_count") < 0,
        "bad_time": F.col("buffering_time_ms") < 0,
        "bad_data": (F.col("total_source_data") < 0) | (F.col("total_p2p_data") < 0),
        "bad_level": F.col("quality_level").isNull(),
        "over_an_hour": F.col("buffering_time_sec") > 3600,
    }
    return [row_total("silver_rows"), *[F.count_if(test).alias(name) for name, test in broken.items()]]


def _range_line() -> list[Column]:
    broken = F.col("bad_count") + F.col("bad_time") + F.col("bad_data") + F.col("bad_level")
    status = verdict(broken > 0, (F.col("over_an_hour") > 0) | (F.col("silver_rows") == 0))
    message = F.concat(
        broken.cast("string"), F.lit(" violations, "), F.col("over_an_hour").cast("string"), F.lit(" rows over one hour")
    )
    return _line("Value Range Validation", "Data Quality", status, message, broken)


def value_ranges(silver: DataFrame) -> DataFrame:
    return silver.agg(*_range_facts()).select(*_range_line())


def shared_customers(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Customers present in both layers.  Each layer is folded to its customers first, on the
    map side, so that a customer with very many rows is one row by the time they meet."""
    return bronze.select("customerId").distinct().intersect(silver.select("customerId").distinct())


def _flow_line() -> list[Column]:
    b, s, shared = F.col("bronze_rows"), F.col("silver_rows"), F.col("shared")
    status = verdict((b > 0) & ((s < b) | (shared == 0)), b == 0)
    message = F.concat(
        b.cast("string"), F.lit(" -> "), s.cast("string"), F.lit(" rows, "), shared.cast("string"), F.lit(" shared customers")
    )
    ratio = s.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))
    return _line("Bronze to Silver Data Flow", "Data Flow", status, message, ratio)


def bronze_to_silver(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    counts = side_by_side(
        bronze.agg(row_total("bronze_rows")),
        silver.agg(row_total("silver_rows")),
        shared_customers(bronze, silver).agg(row_total("shared")),
    )
    return counts.select(*_flow_line())


def quarantine_reasons(quarantine: DataFrame, limit: int = 5) -> DataFrame:
    counted = quarantine.groupBy("quarantine_reason").agg(row_total("record_count"))
    return counted.orderBy(F.col("record_count").desc(), "quarantine_reason").limit(limit)


def quarantine_logic(quarantine: DataFrame) -> DataFrame:
    """Every quarantined row is faulty and has a reason."""
    needed = ["quarantine_reason", "quarantine_timestamp", "customerId"]
    missing = [c for c in needed if c not in quarantine.columns]
    name, category = "Quarantine Logic Validation", "Data Quality"
    if missing:
        return _fixed(quarantine.sparkSession, name, category, "FAIL", f"missing {missing}")
    return quarantine.agg(*_fault_facts()).select(*_fault_line())


def _fault_facts() -> list[Column]:
    unfounded = ~F.coalesce(is_faulty(), F.lit(False)) | F.col("quarantine_reason").isNull()
    return [
        row_total("faults"),
        F.count_distinct("quarantine_reason").alias("reasons"),
        F.count_if(unfounded).alias("unfounded"),
    ]


def _fault_line() -> list[Column]:
    faults = F.col("faults")
    message = F.concat(faults.cast("string"), F.lit(" records with "), F.col("reasons").cast("string"), F.lit(" reasons"))
    return _line("Quarantine Logic Validation", "Data Quality", verdict(F.col("unfounded") > 0), message, faults)


def _gold_line() -> list[Column]:
    s, g = F.col("silver_rows"), F.col("gold_rows")
    status = verdict((s > 0) & ((g == 0) | (g >= s)), s == 0)
    message = F.concat(s.cast("string"), F.lit(" -> "), g.cast("string"), F.lit(" rows"))
    return _line("Gold Layer Aggregation Validation", "Data Flow", status, message, g)


def gold_is_smaller(silver: DataFrame, gold: DataFrame) -> DataFrame:
    counts = side_by_side(silver.agg(row_total("silver_rows")), gold.agg(row_total("gold_rows")))
    return counts.select(*_gold_line())


def _age_line(as_of_ts: str, max_hours: float = 24) -> list[Column]:
    age = hours_since("last_ms", as_of_ts)
    status = verdict(F.col("last_ms").isNull(), age > max_hours)
    message = F.concat(F.lit("Data is "), F.round(age, 1).cast("string"), F.lit(" hours old"))
    return _line("Data Freshness Check", "Pipeline Health", status, message, age)


def freshness(bronze: DataFrame, as_of_ts: str, max_hours: float = 24) -> DataFrame:
    last = bronze.agg(F.max("timestampInfo.server").alias("last_ms"))
    return last.select(*_age_line(as_of_ts, max_hours))


def count_time(silver: DataFrame, warn: float = 10, fail: float = 30) -> DataFrame:
    """Wall-clock of a count over silver; the value is the row count."""
    start = time.monotonic()
    rows = silver.count()
    took = time.monotonic() - start
    status = "FAIL" if took > fail else "WARN" if took > warn else "PASS"
    spark = silver.sparkSession
    return _fixed(spark, "Query Performance Check", "Performance", status, f"count within {warn:g} s / {fail:g} s", float(rows))


def gold_matches_silver(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Per viewer and day: the silver sum, the gold sum, and whether they agree."""
    fresh = silver.groupBy(*schemas.GOLD_KEY).agg(F.sum("buffering_count").alias("silver_total_buffering"))
    joined = fresh.join(gold.select(*schemas.GOLD_KEY, "total_buffering_events"), schemas.GOLD_KEY)
    agree = F.col("silver_total_buffering") == F.col("total_buffering_events")
    return joined.select(
        *schemas.GOLD_KEY,
        "silver_total_buffering",
        F.col("total_buffering_events").alias("gold_total_buffering"),
        F.when(agree, "✅ Match").otherwise("❌ Mismatch").alias("status"),
    )


def aggregation_accuracy(silver: DataFrame, gold: DataFrame) -> DataFrame:
    compared = gold_matches_silver(silver, gold)
    found = compared.agg(row_total("n"), F.count_if(F.col("status") != "✅ Match").alias("off"))
    message = F.concat(F.col("off").cast("string"), F.lit(" of "), F.col("n").cast("string"), F.lit(" keys differ"))
    return found.select(*_line("Aggregation Accuracy", "Data Flow", verdict(F.col("off") > 0), message, F.col("off")))


def no_duplicates(silver: DataFrame) -> DataFrame:
    found = duplicate_summary(silver)
    extra = F.col("extra_copies")
    message = F.concat(extra.cast("string"), F.lit(" extra copies"))
    return found.select(*_line("Deduplication Check", "Data Quality", verdict(extra > 0), message, extra))


# --- runner -----------------------------------------------------------------------------


def run_checks(spark: SparkSession, checks: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """All results in one frame.  A check that raises is a FAIL with the error as message.

    Each check is evaluated here, as its errors are part of the result; it is one row.
    """
    results = []
    for name, check in checks.items():
        try:
            results += check().select(*RESULT.names).collect()
        except Exception as problem:  # noqa: BLE001 - any error is a failed check
            results.append((name, "Execution", "FAIL", str(problem), None))
    return spark.createDataFrame(results, RESULT)


def summary_by_status(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(row_total("n"))


def summary_by_category(results: DataFrame) -> DataFrame:
    """Checks per category and status, and the share that did not fail."""
    table = results.groupBy("category").pivot("status", ["PASS", "WARN", "FAIL"]).count().fillna(0)
    total = F.col("PASS") + F.col("WARN") + F.col("FAIL")
    return table.withColumn("success_pct", F.round((total - F.col("FAIL")) * 100.0 / total, 1))


def all_checks(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, gold: DataFrame, as_of_ts: str
) -> DataFrame:
    """The checks that are plain aggregates, as one lazy frame with one scan per table and purpose."""
    facts = side_by_side(
        silver.agg(*_null_facts(), *_range_facts()[1:]),
        bronze.agg(row_total("bronze_rows"), F.max("timestampInfo.server").alias("last_ms")),
        quarantine.agg(*_fault_facts()),
        gold.agg(row_total("gold_rows")),
        shared_customers(bronze, silver).agg(row_total("shared")),
    )
    lines = [_null_line(), _range_line(), _flow_line(), _fault_line(), _gold_line(), _age_line(as_of_ts)]
    return stack(
        bronze_schema(bronze),
        silver_schema(silver),
        facts.select(F.inline(F.array(*[F.struct(*line) for line in lines]))),
        aggregation_accuracy(silver, gold),
        no_duplicates(silver),
    )
