"""Registered queries: one per operator of the inventory, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalar as S
from ..operators import combine, dedupe, expectations, maintenance, medallion, merge, repair
from ..plans import alerts, collected, contracts, dashboards, event_defaults, faults, monitoring, sessions
from ..plans.alerts import row_total
from ..sources import adapter, batches, landing
from .lake import AS_OF, AS_OF_MS, AS_OF_TS, Lake, lake
from .runs import runs
from .sinks import disjoint_files, rows_in_place, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LAYER_NAMES = {
    "bronze_telemetry_raw": "bronze",
    "silver_telemetry_enriched": "silver",
    "silver_telemetry_quarantine": "quarantine",
    "gold_viewer_qos_metrics": "gold",
}
RAW_FIELDS = schemas.struct(
    customerId=schemas.TEXT, bufferings=schemas.WHOLE, bufferingTime=schemas.WHOLE, eventDate=schemas.DAY
)
KEY = schemas.SILVER_KEY


def query(name: str):
    def register(build: Callable[[Lake], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(lake(spark, folder))
        return build

    return register


def layers(lk: Lake) -> dict[str, DataFrame]:
    return {name: getattr(lk, layer) for name, layer in LAYER_NAMES.items()}


def flat_bronze(lk: Lake) -> DataFrame:
    return medallion.flatten(lk.bronze)


def rows_of(lk: Lake) -> DataFrame:
    return medallion.quality_rows(lk.bronze)


def fixes(lk: Lake) -> DataFrame:
    return repair.merge_source(lk.quarantine, AS_OF)


def silver_with_copies(lk: Lake) -> DataFrame:
    """Silver in which rows of every 50th server second are there twice."""
    twice = F.when(F.floor(F.col("timestamp_server") / 1000) % 50 == 0, 2).otherwise(1)
    return lk.silver.withColumn("_copy", F.explode(F.sequence(F.lit(1), twice))).drop("_copy")


def timeline(lk: Lake) -> DataFrame:
    return sessions.buffer_timeline(lk.signals)


def collector_events(lk: Lake) -> DataFrame:
    return batches.unpack_events(batches.parse_bodies(lk.bodies))


BODY_KEYS = ["body_id", "position"]


# --- sources ----------------------------------------------------------------------------


@query("s02_cast_report")
def _(lk):
    members = F.from_json("raw", "MAP<STRING, STRING>")
    texts = adapter.raw_report_json(lk.events).select(*[members[n].alias(n) for n in RAW_FIELDS.names])
    return landing.cast_report(texts, RAW_FIELDS)


@query("s04_rescued_data")
def _(lk):
    return landing.rescue(adapter.raw_report_json(lk.events), "raw", RAW_FIELDS).drop("raw")


@query("s06_table_read")
def _(lk):
    return flat_bronze(lk).groupBy("eventDate").agg(row_total("row_count"), F.sum("total_source_data").alias("bytes"))


@query("s12_event_batches")
def _(lk):
    return batches.parse_bodies(lk.bodies).select("body_id", "is_rejected", "batch_size")


@query("s12_rejects")
def _(lk):
    return batches.rejects(batches.parse_bodies(lk.bodies))


@query("s14_audit_columns")
def _(lk):
    return landing.with_audit(lk.bronze).select("customerId", "clientId", "eventDate", "_ingest_timestamp", "_source_file")


# --- projections ------------------------------------------------------------------------


@query("p01_flatten")
def _(lk):
    return flat_bronze(lk).drop("qualityDistribution")


@query("p02_flatten_stamped")
def _(lk):
    stamp = S.moment(AS_OF_TS).cast("timestamp_ntz").alias("quarantine_timestamp")
    return flat_bronze(lk).select("customerId", "clientId", "timestamp_server", "buffering_count", "eventDate", stamp)


@query("p03_explode_levels")
def _(lk):
    return medallion.explode_levels(flat_bronze(lk)).select("customerId", "clientId", "timestamp_server", "quality_level")


@query("p03_explode_levels_keep_empty")
def _(lk):
    rows = medallion.explode_levels(flat_bronze(lk), keep_empty=True)
    return rows.select("customerId", "clientId", "timestamp_server", "quality_level")


@query("p04_level_metrics")
def _(lk):
    names = ["quality_source_requests", "quality_source_data", "quality_p2p_requests", "quality_p2p_data"]
    return rows_of(lk).select("customerId", "clientId", "timestamp_server", "quality_level", *names)


@query("p05_buffering_seconds")
def _(lk):
    return flat_bronze(lk).select("timestamp_server", S.ms_to_seconds("buffering_time_ms").alias("buffering_time_sec"))


@query("p06_megabytes")
def _(lk):
    rows = medallion.silver_candidates(rows_of(lk))
    return rows.select("timestamp_server", "quality_level", "quality_data_mb", "total_data_mb")


@query("p07_rebuild_records")
def _(lk):
    return repair.rebuild_basic(lk.quarantine)


@query("p08_derived_columns")
def _(lk):
    return medallion.silver_candidates(rows_of(lk))


@query("p09_layer_labels")
def _(lk):
    counted = {n: df.groupBy("eventDate").agg(row_total("row_count")) for n, df in layers(lk).items()}
    return combine.stack(*[combine.labelled(df, name) for name, df in counted.items()])


# --- filters and rules ------------------------------------------------------------------


@query("f01_expectation_warn")
def _(lk):
    warn = [rule for rule in expectations.SILVER_RULES if rule.policy == "warn"] + expectations.QUARANTINE_RULES
    return expectations.count_violations(lk.silver, warn)


@query("f02_expectation_drop")
def _(lk):
    kept = expectations.enforce(medallion.silver_candidates(rows_of(lk)), expectations.SILVER_RULES)
    return kept.select(*KEY, "buffering_count", "buffering_time_ms", "total_source_data", "total_p2p_data")


@query("f03_bronze_rules")
def _(lk):
    return expectations.count_violations(lk.bronze, expectations.BRONZE_RULES)


@query("f04_silver_rules")
def _(lk):
    return expectations.count_violations(medallion.silver_candidates(rows_of(lk)), expectations.SILVER_RULES)


@query("f05_not_null_drop")
def _(lk):
    rows = medallion.silver_candidates(rows_of(lk))
    return expectations.enforce_not_null(rows, schemas.REQUIRED_SILVER, "drop").select(*KEY, "buffering_count")


@query("f06_quarantine_filter")
def _(lk):
    return rows_of(lk).filter(medallion.is_faulty()).select(*KEY, "buffering_count", "buffering_time_ms")


@query("f07_quarantine_reason")
def _(lk):
    return medallion.quarantine(lk.bronze).drop("qualityDistribution", "quality_metrics", "quarantine_timestamp")


@query("f07_quarantine_keep_empty")
def _(lk):
    rows = medallion.quarantine(lk.bronze, keep_empty=True)
    return rows.groupBy("quarantine_reason").agg(row_total("row_count"))


@query("f08_recent_days")
def _(lk):
    days = F.lit(AS_OF).cast("date")
    spans = [F.count_if(F.col("eventDate") >= F.date_sub(days, n)).alias(f"last_{n}_days") for n in (1, 3, 7, 30)]
    return lk.silver.filter(S.on_or_after(AS_OF, 30)).agg(*spans)


@query("f09_quarantine_reasons")
def _(lk):
    rows = rows_of(lk).filter(medallion.is_faulty())
    return rows.select(*KEY, F.concat_ws(",", medallion.quarantine_reasons()).alias("quarantine_reasons"))


@query("f10_routing_audit")
def _(lk):
    return medallion.routing(lk.bronze)


@query("f11_like_patterns")
def _(lk):
    reason = F.col("quarantine_reason")
    fix = S.first_match([(reason.like(p), label) for p, label in faults.FIXABILITY], "Unknown: Needs manual review")
    return lk.quarantine.groupBy(reason, fix.alias("fixability")).agg(row_total("row_count"))


def _marked(lk):
    batch = F.lit("batch-1")
    return repair.mark_processed(lk.quarantine, fixes(lk), S.moment(AS_OF_TS), batch)


@query("f12_unprocessed")
def _(lk):
    return repair.unprocessed(_marked(lk)).select(*KEY, "quarantine_reason")


@query("f13_in_subquery")
def _(lk):
    return merge.on_dates(lk.silver, merge.dates_of(fixes(lk))).groupBy("eventDate").agg(row_total("row_count"))


@query("f14_having")
def _(lk):
    counted = lk.quarantine.groupBy("customerId").agg(row_total("issue_count"))
    return counted.filter(F.col("issue_count") > 40)


@query("f15_timestamp_rules")
def _(lk):
    rows = medallion.silver_candidates(rows_of(lk))
    return expectations.count_violations(rows, expectations.timestamp_rules(AS_OF_MS))


@query("f15_error_count_rule")
def _(lk):
    errors = sessions.classify_errors(lk.signals).groupBy("playbackSessionId").agg(row_total("error_count"))
    return expectations.count_violations(errors, expectations.ERROR_COUNT_RULES)


# --- joins ------------------------------------------------------------------------------


@query("j01_daily_join")
def _(lk):
    faulty = alerts.daily_counts(lk.quarantine, "quarantine_count")
    return faulty.join(alerts.daily_counts(lk.bronze, "total_records"), "eventDate")


@query("j02_daily_left_join")
def _(lk):
    total = alerts.daily_counts(lk.bronze, "total_records")
    late = alerts.daily_counts(lk.quarantine.filter(F.col("quarantine_reason") == "excessive_buffering"), "excessive")
    return total.join(late, "eventDate", "left")


@query("j03_silver_gold_join")
def _(lk):
    return contracts.gold_matches_silver(lk.silver, lk.gold)


@query("j04_single_row_combination")
def _(lk):
    parts = [df.agg(row_total(f"{layer}_count")) for layer, df in zip(LAYER_NAMES.values(), layers(lk).values())]
    return combine.side_by_side(*parts)


@query("j05_match_counts")
def _(lk):
    return merge.match_counts(lk.silver, fixes(lk))


@query("j06_semi_and_anti")
def _(lk):
    source = fixes(lk)
    known = source.join(lk.silver.select(*KEY), KEY, "left_semi").select(F.lit("matched").alias("side"), *KEY)
    new = source.join(lk.silver.select(*KEY), KEY, "left_anti").select(F.lit("not_matched").alias("side"), *KEY)
    return known.unionByName(new)


@query("j07_shared_customers")
def _(lk):
    return contracts.shared_customers(lk.bronze, lk.silver)


@query("j08_faults_with_signals")
def _(lk):
    return sessions.faults_with_signals(lk.quarantine, lk.signals)


# --- aggregates -------------------------------------------------------------------------


@query("a01_gold_viewer_qos")
def _(lk):
    return medallion.gold_viewer_qos(medallion.silver_enriched(lk.bronze, "drop"), "exact")


@query("a02_source_share")
def _(lk):
    return lk.gold.select(*schemas.GOLD_KEY, "source_traffic_percentage")


@query("a03_buffering_ratio")
def _(lk):
    return lk.gold.select(*schemas.GOLD_KEY, "buffering_ratio_percentage")


@query("a04_qos_score")
def _(lk):
    return lk.gold.select(*schemas.GOLD_KEY, "qos_score")


@query("a05_qos_category")
def _(lk):
    return lk.gold.groupBy("qos_category").agg(row_total("viewer_days"))


@query("a06_gold_approx_distinct")
def _(lk):
    return medallion.gold_viewer_qos(lk.silver, "approx")


@query("a07_exact_distincts")
def _(lk):
    names = ["customerId", "clientId", "contentId", "quality_level", "eventDate"]
    return lk.silver.agg(*[F.count_distinct(n).alias(f"distinct_{n}") for n in names])


@query("a08_composite_distinct")
def _(lk):
    ids = F.concat("customerId", "clientId", "timestamp_server")
    return lk.silver.groupBy("eventDate").agg(F.count_distinct(ids).alias("total_sessions"))


@query("a09_conditional_aggregates")
def _(lk):
    busy = F.col("buffering_count") > 0
    return lk.silver.groupBy("quality_level").agg(
        F.sum(F.when(busy, 1).otherwise(0)).alias("rows_with_buffering"),
        F.avg(F.when(busy, F.col("buffering_count"))).alias("avg_when_buffering"),
        F.max(F.when(~busy, F.col("buffering_time_ms"))).alias("max_ms_without_count"),
    )


@query("a10_two_level_average")
def _(lk):
    return alerts.daily_counts(lk.bronze, "n").agg(F.avg("n").alias("avg_daily_count"))


@query("a11_global_aggregate")
def _(lk):
    return lk.bronze.agg(F.max("timestampInfo.server").alias("last_server_ms"), row_total("total_records"))


@query("a12_gold_session_grain")
def _(lk):
    return medallion.gold_viewer_qos_session_grain(lk.silver)


@query("a13_sample_per_group")
def _(lk):
    place = F.struct("timestamp_server", "customerId", "clientId", "contentId")
    return lk.silver.groupBy("quality_level").agg(
        F.min_by("customerId", place).alias("sample_customerId"), F.min_by("contentId", place).alias("sample_contentId")
    )


@query("a14_span")
def _(lk):
    first, last = F.min("eventDate"), F.max("eventDate")
    return lk.silver.groupBy("customerId").agg(
        first.alias("first_date"), last.alias("last_date"), F.datediff(last, first).alias("span_days")
    )


@query("a15_nested_sums")
def _(lk):
    return lk.bronze.groupBy("eventDate").agg(
        F.sum("player.bufferingTime").alias("buffering_ms"),
        F.sum("totalDistribution.sourceTraffic.receivedData").alias("source_bytes"),
        F.sum("totalDistribution.p2pTraffic.requests").alias("p2p_requests"),
    )


@query("a16_duplicate_summary")
def _(lk):
    return dedupe.duplicate_summary(silver_with_copies(lk))


@query("a17_guarded_ratio_average")
def _(lk):
    return lk.silver.groupBy("eventDate").agg(
        S.exact_avg(alerts.seconds_per_interruption()).alias("avg_buffer_duration")
    )


# --- windows, order, sets ---------------------------------------------------------------


@query("w01_share_of_total")
def _(lk):
    grouped = lk.quarantine.groupBy("quarantine_reason").agg(row_total("issue_count"))
    return grouped.withColumn("pct_of_total", F.round(combine.share_of_total(grouped, "issue_count"), 2))


@query("w02_share_of_customers")
def _(lk):
    grouped = lk.gold.groupBy("qos_category").agg(F.count_distinct("customerId").alias("customer_count"))
    return grouped.withColumn("pct_customers", F.round(combine.share_of_total(grouped, "customer_count"), 2))


@query("w03_running_state")
def _(lk):
    return sessions.running_traffic(lk.signals)


@query("w04_keep_latest")
def _(lk):
    return dedupe.keep_one(silver_with_copies(lk), KEY)


@query("w05_rate_z_score")
def _(lk):
    return faults.rate_z_score(lk.bronze, lk.quarantine)


@query("o01_sort_by_keys")
def _(lk):
    return faults.daily_failures(lk.quarantine, AS_OF, 30)


@query("o02_custom_order")
def _(lk):
    grouped = lk.gold.groupBy("qos_category").agg(row_total("viewer_days"))
    place = S.rank_of("qos_category", monitoring.CATEGORIES)
    return grouped.withColumn("place", place).orderBy("place")


@query("o03_nulls_last_limit")
def _(lk):
    order = [F.col("timestamp_agent").desc_nulls_last(), "customerId", "clientId", "quality_level"]
    return lk.silver.select("timestamp_agent", "customerId", "clientId", "quality_level").orderBy(*order).limit(10)


@query("o04_top_k")
def _(lk):
    return faults.top_customers(lk.quarantine, AS_OF, 30)


@query("o05_sample_rows")
def _(lk):
    order = ["eventDate", "timestamp_server", "customerId", "clientId", "quality_level"]
    return lk.quarantine.select(*KEY, "quarantine_reason").orderBy(*order).limit(5)


@query("u01_union_with_padding")
def _(lk):
    return monitoring.layer_dates(lk.silver, lk.gold)


@query("u02_ordered_union")
def _(lk):
    return monitoring.record_counts(layers(lk)).orderBy(F.col("record_count").desc(), "layer")


@query("u03_distinct_rows")
def _(lk):
    return dedupe.distinct_rows(silver_with_copies(lk))


@query("u04_distinct_values")
def _(lk):
    return lk.silver.select("customerId", "quality_level").distinct()


# --- scalar functions -------------------------------------------------------------------


def _scalar(name: str, layer: str, keys: list[str], **columns):
    """A row-wise query over every row of a stored layer."""
    QUERIES[name] = lambda spark, folder: getattr(lake(spark, folder), layer).select(
        *keys, *[make().alias(alias) for alias, make in columns.items()]
    )


_SERVER = ["customerId", "clientId", "timestamp_server", "quality_level"]
_SIGNAL = ["playbackSessionId", "sequenceNumber"]

_scalar("x01_epoch_to_timestamp", "silver", _SERVER, event_time=lambda: S.epoch_ms_to_timestamp("timestamp_server"))
_scalar("x02_age_in_hours", "silver", _SERVER, age_hours=lambda: S.hours_since("timestamp_server", AS_OF_TS))
_scalar("x03_minutes_between", "silver", _SERVER, lag_minutes=lambda: S.minutes_since("timestamp_server", AS_OF_TS))
_scalar("x04_date_difference", "gold", schemas.GOLD_KEY, days=lambda: F.datediff(F.lit(AS_OF).cast("date"), "eventDate"))
_scalar("x05_date_minus_days", "gold", schemas.GOLD_KEY, is_recent=lambda: F.col("eventDate") >= S.days_before(AS_OF, 7))
_scalar("x06_epoch_to_date", "silver", _SERVER, server_date=lambda: S.epoch_ms_to_date("timestamp_server"))
_scalar(
    "x07_round", "gold", schemas.GOLD_KEY,
    two=lambda: F.round("avg_buffering_per_session", 2), none=lambda: F.round("total_buffering_time_sec", 0),
)
_scalar("x08_nullif_guard", "silver", _SERVER, per_interruption=lambda: alerts.seconds_per_interruption())
_scalar("x09_coalesce", "silver", _SERVER, agent=lambda: F.coalesce("timestamp_agent", "timestamp_server"))
_scalar("x10_abs", "quarantine", _SERVER, bytes=lambda: F.abs("total_source_data"), ms=lambda: F.abs("buffering_time_ms"))
_scalar("x11_greatest", "gold", schemas.GOLD_KEY, floored=lambda: F.greatest(F.lit(0.0), F.lit(50.0) - F.col("qos_score")))
_scalar(
    "x12_concat", "silver", ["quality_level"],
    session=lambda: F.concat("customerId", F.lit("|"), "clientId", F.lit("|"), "eventDate", F.lit("|"), "timestamp_server"),
)
_scalar("x13_falsy_default", "signals", _SIGNAL, connection=lambda: S.or_default("effectiveType", "unknown"))
_scalar(
    "x14_finite_or_default", "signals", _SIGNAL,
    rtt=lambda: S.finite_or("rtt", -1.0),
)
_scalar("x16_cap", "quarantine", _SERVER, capped=lambda: S.cap("buffering_time_sec", 3600.0))
_scalar("x17_status_tiers", "gold", schemas.GOLD_KEY, status=lambda: S.tier(F.col("total_buffering_time_sec"), 10, 5))
_scalar("x18_length", "gold", schemas.GOLD_KEY, has_customer=lambda: F.length("customerId") > 0)
_scalar("x19_ellipsis", "signals", _SIGNAL, agent=lambda: S.ellipsis("userAgent"))
_scalar("x20_upper_default", "signals", _SIGNAL, category=lambda: S.upper_or("errorType"))
_scalar("x21_fixed_digits", "signals", _SIGNAL, two=lambda: F.round(F.col("downlink") / 3, 2), four=lambda: F.round(F.col("downlink") / 3, 4))
_scalar("x23_key_composition", "signals", _SIGNAL, key=lambda: F.concat_ws("-", "playbackSessionId", "event_timestamp", "sequenceNumber"))
_scalar(
    "x24_processing_stamps", "quarantine", [*_SERVER, "quarantine_reason"],
    processed_id=lambda: F.expr("uuid()"), processed_timestamp=F.current_timestamp,
)
_scalar("x25_to_json", "quarantine", _SERVER, original_data=lambda: F.to_json(F.struct("*")))


@query("x15_fill_nulls")
def _(lk):
    rows = rows_of(lk).select("timestamp_server", "contentId", "buffering_count", "buffering_time_ms", "quality_level")
    return rows.transform(repair.fix_null_values)


@query("x22_map_transform")
def _(lk):
    received = lambda _, v: v["sourceTraffic"]["receivedData"] + v["p2pTraffic"]["receivedData"]
    totals = F.transform_values("qualityDistribution", received)
    add = lambda a, b: a + b
    total = F.aggregate(F.map_values("_bytes"), F.lit(0).cast("bigint"), add)
    return lk.bronze.withColumn("_bytes", totals).select(
        "contentId",
        F.col("timestampInfo.server").alias("timestamp_server"),
        F.size("_bytes").alias("levels"),
        total.alias("all_bytes"),
        F.col("_bytes")["720p"].alias("bytes_720p"),
    )


# --- repair and maintenance -------------------------------------------------------------


@query("m01_upsert")
def _(lk):
    return merge.upsert_by_date(lk.silver, fixes(lk)).select(*schemas.SILVER.names)


@query("m02_fix_negative_values")
def _(lk):
    return repair.fix_negative_values(lk.quarantine).select(*KEY, *repair.SIGNED_COLUMNS)


@query("m03_fix_null_values")
def _(lk):
    return repair.fix_null_values(lk.quarantine).select(*KEY, *repair.SIGNED_COLUMNS)


@query("m04_fixes_in_original_order")
def _(lk):
    return repair.fix_basic(lk.quarantine)


@query("m04_repair_quarantine")
def _(lk):
    return repair.repair_quarantine(lk.quarantine)


@query("m05_retention")
def _(lk):
    return maintenance.surviving(lk.silver, AS_OF, 20).groupBy("eventDate").agg(row_total("row_count"))


@query("m06_delete_reprocessed")
def _(lk):
    left = merge.delete_reprocessed(lk.quarantine, "excessive_buffering", fixes(lk))
    return left.select(*KEY, "quarantine_reason")


@query("m10_mark_processed")
def _(lk):
    marked = _marked(lk)
    stamp = F.col("processed_timestamp").cast("timestamp_ntz").alias("processed_timestamp")
    return marked.select(*KEY, "quarantine_reason", "processed_id", stamp)


@query("m11_archive_split")
def _(lk):
    gone, left = repair.split_archive(lk.quarantine, fixes(lk))
    parts = [df.select(F.lit(name).alias("side"), *KEY, "quarantine_reason") for name, df in (("archive", gone), ("keep", left))]
    return combine.stack(*parts)


@query("m13_dry_run")
def _(lk):
    return repair.dry_run(lk.quarantine.filter(S.on_or_after(AS_OF, repair.LOOKBACK_DAYS)))


@query("m15_dedupe_counts")
def _(lk):
    return dedupe.dedupe_counts(silver_with_copies(lk))


@query("m16_fix_timestamp")
def _(lk):
    shifted = lk.silver.withColumn("timestamp_server", F.col("timestamp_server") - AS_OF_MS + 86400000)
    return repair.fix_negative_timestamp(shifted).select("customerId", "clientId", "quality_level", "timestamp_server")


@query("t06_refresh_affected_dates")
def _(lk):
    source = fixes(lk)
    dates = merge.dates_of(source)
    after = merge.upsert(merge.on_dates(lk.silver, dates), source)  # gold needs the other dates no more
    return merge.refresh_gold(lk.gold, after, dates, "exact").select(*schemas.GOLD.names)


@query("t07_reconciliation")
def _(lk):
    found = contracts.gold_matches_silver(lk.silver, lk.gold)
    return found.groupBy("status").agg(row_total("keys"))


@query("t08_flush_windows")
def _(lk):
    return sessions.flush_windows(lk.signals).drop("flushed_at_once")


# --- reports ----------------------------------------------------------------------------


def _report(name: str, build):
    QUERIES[name] = lambda spark, folder: build(lake(spark, folder))


_report("r01_bronze_freshness_alert", lambda k: alerts.bronze_freshness(k.bronze, AS_OF, AS_OF_TS))
_report("r02_quarantine_rate_alert", lambda k: alerts.quarantine_rate(k.bronze, k.quarantine, AS_OF))
_report("r03_volume_anomaly_alert", lambda k: alerts.volume_anomaly(k.bronze, AS_OF))
_report("r04_buffering_alert", lambda k: alerts.buffering_degradation(k.silver, AS_OF))
_report("r05_gold_lag_alert", lambda k: alerts.gold_lag(k.silver, k.gold, AS_OF))
_report("r06_reason_spike_alert", lambda k: alerts.reason_spike(k.quarantine, AS_OF))
_report("r07_stale_bronze", lambda k: alerts.stale_bronze(k.bronze, "2024-02-02"))
_report("r08_quarantine_rate_today", lambda k: alerts.quarantine_rate_today(k.bronze, k.quarantine, AS_OF, 5))
_report("r09_volume_deviation", lambda k: alerts.volume_deviation(k.bronze, AS_OF, 0.0))
_report("r10_buffering_trend", lambda k: alerts.buffering_trend(k.silver, AS_OF, -1.0))
_report("r11_layer_lag", lambda k: alerts.layer_lag(k.silver, k.gold, -1))
_report("r12_failing_reasons", lambda k: alerts.failing_reasons(k.quarantine, AS_OF, 2))
_report("r13_all_alerts", lambda k: alerts.all_alerts(k.bronze, k.silver, k.quarantine, k.gold, AS_OF, AS_OF_TS))
_report("r20_bronze_freshness", lambda k: monitoring.bronze_freshness(k.bronze, AS_OF, AS_OF_TS))
_report("r21_silver_freshness", lambda k: monitoring.silver_freshness(k.silver, AS_OF, AS_OF_TS))
_report("r22_gold_freshness", lambda k: monitoring.gold_freshness(k.gold, AS_OF))
_report("r23_daily_quarantine_rate", lambda k: monitoring.daily_quarantine_rate(k.bronze, k.quarantine, AS_OF))
_report("r24_quarantine_breakdown", lambda k: monitoring.quarantine_breakdown(k.quarantine, AS_OF))
_report("r25_category_distribution", lambda k: monitoring.category_distribution(k.gold, AS_OF))
_report("r26_customer_trend", lambda k: monitoring.customer_trend(k.gold, AS_OF, 0.5))
_report("r27_storage_report", lambda k: maintenance.storage_report(k.spark, k.paths()))
_report("r28_daily_ingest", lambda k: monitoring.daily_ingest(k.bronze, AS_OF))
_report("r29_retention_status", lambda k: monitoring.retention_status(layers(k)))
_report("r30_layer_dates", lambda k: monitoring.layer_dates(k.silver, k.gold))
_report("r31_record_counts", lambda k: monitoring.record_counts(layers(k)))
_report("r32_days_behind", lambda k: monitoring.days_behind(layers(k), AS_OF))
_report("r34_explosion_ratio", lambda k: monitoring.explosion_ratio(k.bronze, k.silver))
_report("r35_pass_rate", lambda k: monitoring.pass_rate(k.silver, k.quarantine))
_report("r36_poor_viewers", lambda k: monitoring.poor_viewers(k.gold))
_report("r37_poor_customers", lambda k: monitoring.poor_customers(k.gold, AS_OF))
_report("r40_reason_summary", lambda k: faults.reason_summary(k.quarantine, AS_OF))
_report("r41_fixability", lambda k: faults.fixability(k.quarantine, AS_OF))
_report("r42_reason_sample", lambda k: faults.reason_sample(k.quarantine, AS_OF))
_report("r43_detailed_sample", lambda k: faults.detailed_sample(k.quarantine, AS_OF))
_report("r44_duplicate_report", lambda k: dedupe.duplicate_report(silver_with_copies(k)))
_report("r45_duplicate_groups", lambda k: dedupe.duplicate_groups(silver_with_copies(k)))
_report("r46_before_after", lambda k: repair.before_after(k.silver, k.quarantine, AS_OF))
_report("r47_daily_rate_by_reason", lambda k: faults.daily_rate_by_reason(k.bronze, k.quarantine, AS_OF))
_report("r48_daily_failures", lambda k: faults.daily_failures(k.quarantine, AS_OF))
_report("r49_top_customers", lambda k: faults.top_customers(k.quarantine, AS_OF))
_report(
    "r50_reprocessing_health",
    lambda k: faults.reprocessing_health(k.quarantine, repair.fix_basic(k.quarantine), AS_OF),
)
_report("r60_score_distribution", lambda k: dashboards.score_distribution(k.gold))
_report("r61_buffering_trend", lambda k: dashboards.buffering_trend(k.gold))
_report("r62_worst_customers", lambda k: dashboards.worst_customers(k.gold))
_report("r63_traffic_split", lambda k: dashboards.traffic_split(k.gold))
_report("r64_data_volume", lambda k: dashboards.data_volume(k.gold))
_report("r65_rebuffering_over_time", lambda k: dashboards.rebuffering_over_time(k.gold))
_report("r66_score_trend", lambda k: dashboards.score_trend(k.gold))
_report("r67_score_by_source_share", lambda k: dashboards.score_by_source_share(k.gold))
_report("r68_session_impact", lambda k: dashboards.session_impact(k.gold))
_report("r69_viewers_and_buffering", lambda k: dashboards.viewers_and_buffering(k.gold))
_report("r70_today_against_yesterday", lambda k: dashboards.today_against_yesterday(k.gold, AS_OF))
_report("r71_week_over_week", lambda k: dashboards.week_over_week(k.gold, AS_OF))
_report("r72_consistently_poor", lambda k: dashboards.consistently_poor(k.gold, AS_OF))


# --- contract checks --------------------------------------------------------------------

_report("c02_tables_exist", lambda k: contracts.tables_exist(k.spark, k.paths()))
_report("c03_bronze_schema", lambda k: contracts.bronze_schema(k.bronze))
_report("c04_silver_schema", lambda k: contracts.silver_schema(k.silver))
_report("c05_null_counts", lambda k: contracts.null_counts(medallion.silver_candidates(rows_of(k))))
_report("c05_not_null", lambda k: contracts.not_null(k.silver))
_report("c06_value_ranges", lambda k: contracts.value_ranges(k.silver))
_report("c07_bronze_to_silver", lambda k: contracts.bronze_to_silver(k.bronze, k.silver))
_report("c08_quarantine_logic", lambda k: contracts.quarantine_logic(k.quarantine))
_report("c08_top_reasons", lambda k: contracts.quarantine_reasons(k.quarantine))
_report("c09_gold_is_smaller", lambda k: contracts.gold_is_smaller(k.silver, k.gold))
_report("c10_freshness", lambda k: contracts.freshness(k.bronze, AS_OF_TS))
_report("c11_count_time", lambda k: contracts.count_time(k.silver))
_report(
    "c12_summary",
    lambda k: contracts.summary_by_category(contracts.all_checks(k.bronze, k.silver, k.quarantine, k.gold, AS_OF_TS)),
)
_report("c13_aggregation_accuracy", lambda k: contracts.aggregation_accuracy(k.silver, k.gold))
_report("c14_duplicates", lambda k: contracts.no_duplicates(silver_with_copies(k)))


# --- triggered runs ---------------------------------------------------------------------


def _by_day_and_cdn(rows: DataFrame) -> DataFrame:
    return rows.groupBy("eventDate", "cdn").agg(row_total("row_count"))


def _plain_quarantine(rows: DataFrame) -> DataFrame:
    return rows.drop("qualityDistribution", "quality_metrics", "quarantine_timestamp", "ingest_batch")


_report("s01_landed_bronze", lambda k: medallion.flatten(runs(k).flow.read("bronze")).drop("qualityDistribution"))
_report("s03_added_column", lambda k: _by_day_and_cdn(runs(k).flow.read("bronze")))
_report("s03_ledger_read", lambda k: _by_day_and_cdn(runs(k).ledger))
_report(
    "s04_stream_rescued",
    lambda k: runs(k).flow.read("bronze").filter("_rescued_data IS NOT NULL").select("eventDate", "_rescued_data"),
)
_report("s05_stream_from_table", lambda k: _plain_quarantine(runs(k).from_table))
_report("t01_stream_silver", lambda k: runs(k).flow.read("silver").select(*schemas.SILVER.names))
_report("t02_stream_quarantine", lambda k: _plain_quarantine(runs(k).flow.read("quarantine")))
_report("t04_rows_by_batch", lambda k: runs(k).flow.read("silver").groupBy("ingest_batch").agg(row_total("row_count")))
_report("t05_late_gold", lambda k: runs(k).flow.read("gold"))
_report("t09_running_sessions", lambda k: runs(k).sessions.drop("first_day", "last_day"))
_report("m07_compacted", lambda k: runs(k).compacted.select(*schemas.SILVER.names))
_report(
    "m08_change_history",
    lambda k: maintenance.change_history(maintenance.log_table(k.spark, runs(k).flow.path("log"))).drop("ts"),
)
_report("m11_archived", lambda k: runs(k).archived.read("archive").select(*KEY, "quarantine_reason"))
_report("m12_left_in_quarantine", lambda k: runs(k).archived.read("quarantine-copy").select(*KEY, "quarantine_reason"))
_report(
    "r33_run_history",
    lambda k: maintenance.run_history(maintenance.log_table(k.spark, runs(k).flow.path("log")), AS_OF_TS)
    .groupBy("state", "status_icon").agg(row_total("runs")),
)


# --- sinks, catalog tables and confirmed jobs -------------------------------------------


def _by_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("eventDate").agg(row_total("row_count"), F.sum("total_source_data").alias("bytes"))


_report("s07_partitioned_sink", lambda k: rows_in_place(k.quarantine))
_report("s08_clustered_sink", lambda k: disjoint_files(k.silver, ["customerId", "clientId", "timestamp_server"]))
_report("s10_backup_copy", lambda k: _by_day(k.spark.table(sinks(k).backup)))
_report("s11_create_like", lambda k: _by_day(k.spark.table(sinks(k).alike)))
_report("s13_temporary_view", lambda k: sinks(k).viewed())
_report("s15_listed_tables", lambda k: sinks(k).listed())
_report("s15_described_columns", lambda k: sinks(k).described())
_report("s16_table_properties", lambda k: sinks(k).properties())
_report("m14_reprocessed_silver", lambda k: sinks(k).reprocessed.read("silver").select(*schemas.SILVER.names))
_report("m14_reprocessed_gold", lambda k: sinks(k).reprocessed.read("gold"))
_report("t03_full_refresh", lambda k: sinks(k).refreshed.select(*schemas.SILVER.names))


@query("a06_merged_sketches")
def _(lk):
    """Per customer: the union of the daily sketches against the exact count, within four standard errors."""
    value = F.concat_ws("|", "contentId", "timestamp_server")
    exact = lk.silver.groupBy("customerId").agg(F.count_distinct(value).alias("exact"))
    merged = medallion.merged_distincts(medallion.distinct_sketches(lk.silver, {"reports": value}), ["reports"], "customerId")
    near = F.abs(F.col("reports") - F.col("exact")) <= F.col("exact") * 4 * 1.04 / 64
    return merged.join(exact, "customerId").select("customerId", "exact", near.alias("is_near"))


# --- collector events -------------------------------------------------------------------


def _defaults(name: str, columns):
    QUERIES[name] = lambda spark, folder: event_defaults.part(
        collector_events(lake(spark, folder)), columns(), BODY_KEYS
    )


_report("e01_unpacked_events", lambda k: collector_events(k).select(*BODY_KEYS, "batch_size", "eventId"))
_defaults("e02_envelope_defaults", lambda: event_defaults.envelope(AS_OF_MS))
_defaults("e03_identity_defaults", event_defaults.identities)
_defaults("e04_content_defaults", event_defaults.content)
_defaults("e05_environment_defaults", event_defaults.environment)


@query("e06_network_defaults")
def _(lk):
    flat = event_defaults.part(collector_events(lk), event_defaults.network(), BODY_KEYS)
    maps = ["trafficBreakdown", "qualityDistribution"]
    return flat.select(*[c for c in flat.columns if c not in maps], *[F.size(m).alias(f"{m}_size") for m in maps])


_defaults("e07_player_state_defaults", event_defaults.player_state)
_defaults("e08_playback_metric_defaults", event_defaults.playback_metrics)


@query("e09_quality_distribution")
def _(lk):
    clean = event_defaults.quality_distribution("network.qualityDistribution")
    entries = collector_events(lk).select(*BODY_KEYS, F.explode(clean).alias("resolution", "entry"))
    return entries.select(*BODY_KEYS, "resolution", "entry.*")


_report("e10_flush_windows", lambda k: sessions.flush_windows(k.signals, "1 hour"))
_report("e11_traffic_by_resolution", lambda k: sessions.traffic_by_resolution(k.signals).drop("byteSharePercent"))
_report("e11_running_traffic", lambda k: sessions.running_traffic(k.signals))
_report("e12_byte_share", lambda k: sessions.traffic_by_resolution(k.signals))
_report("e13_buffer_types", lambda k: sessions.buffer_starts(timeline(k)))
_report("e14_buffer_intervals", lambda k: sessions.buffer_intervals(timeline(k)))
_report(
    "e15_cumulative_buffering",
    lambda k: timeline(k).select(*_SIGNAL, "totalRebufferMs", "stallCount", "startupStallCount"),
)
_report("e16_playback_quality", lambda k: sessions.playback_quality(timeline(k)))
_report("e17_time_to_first_frame", lambda k: sessions.time_to_first_frame(k.signals))
_report("e18_quality_switches", lambda k: sessions.quality_switches(k.signals).drop("droppedFramesDelta"))
_report(
    "e19_dropped_frames",
    lambda k: sessions.quality_switches(k.signals).select(*_SIGNAL, "droppedFramesDelta"),
)
_report("e20_error_classes", lambda k: sessions.classify_errors(k.signals))
_report("e21_error_summary", lambda k: sessions.error_summary(k.signals, "1 day"))
_report("e21_error_totals", lambda k: sessions.error_totals(sessions.error_summary(k.signals, "1 day")))
_report("e22_event_identity", lambda k: sessions.event_identity(k.signals))
_report("e23_user_agent", lambda k: sessions.trimmed_user_agent(k.signals))
_report("e24_session_targets", lambda k: sessions.session_targets(timeline(k)))
_report("e25_type_counts", lambda k: sessions.type_counts(k.signals))
_report("e26_network_context", lambda k: sessions.network_context(k.signals))
_HOURS = 6 * 60 * 60 * 1000
_report("e10_flushes", lambda k: sessions.flush_batches(sessions.flushes(k.signals)))
_report("e10_flushes_six_hours", lambda k: sessions.flush_batches(sessions.flushes(k.signals, _HOURS)))
_report("e21_flush_summaries", lambda k: sessions.flush_summaries(sessions.flushes(k.signals)))
_report("e21_flush_summaries_six_hours", lambda k: sessions.flush_summaries(sessions.flushes(k.signals, _HOURS)))
_report("e21_flush_totals", lambda k: sessions.flush_totals(sessions.flush_summaries(sessions.flushes(k.signals))))
_report("e13_posted_buffer_types", lambda k: collected.buffer_starts(runs(k).posted))
_report("e14_posted_buffer_intervals", lambda k: collected.buffer_intervals(runs(k).posted))
_report("e16_posted_quality", lambda k: collected.playback_quality(runs(k).posted.filter("sequenceNumber IS NOT NULL")))
_report("e17_posted_first_frame", lambda k: collected.time_to_first_frame(runs(k).posted).filter("timeToFirstFrameMs IS NOT NULL"))
_report("e18_posted_switches", lambda k: collected.quality_switches(runs(k).posted))
_report("e20_posted_errors", lambda k: collected.fatal_errors(runs(k).posted))
_report("e21_posted_summaries", lambda k: collected.error_summaries(runs(k).posted))
_report("e21_posted_totals", lambda k: collected.error_totals(runs(k).posted))
_report("e23_posted_user_agents", lambda k: collected.user_agents(runs(k).posted.filter("sequenceNumber IS NOT NULL")))
_report("e25_posted_type_counts", lambda k: collected.type_counts(runs(k).posted.filter("sequenceNumber IS NOT NULL")))
_report("e26_posted_network", lambda k: collected.network_context(runs(k).posted.filter("sequenceNumber IS NOT NULL")))
