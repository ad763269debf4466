from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from playlens import schemas
from playlens.operators import expectations, medallion


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_clean_report_gives_a_row_per_level(spark):
    bronze = fx.bronze(spark, fx.report(levels=("360p", "720p", "1080p"), source=1048576, p2p=1048576, ms=2500))
    rows = medallion.silver_enriched(bronze).collect()
    assert sorted(r.quality_level for r in rows) == ["1080p", "360p", "720p"]
    assert {(r.quality_data_mb, r.total_data_mb, r.buffering_time_sec) for r in rows} == {(2.0, 2.0, 2.5)}
    assert medallion.silver_enriched(bronze).columns == schemas.SILVER.names


def test_empty_and_null_maps(spark):
    bronze = fx.bronze(spark, fx.report(levels=()), fx.report(levels=None))
    assert medallion.quarantine(bronze).count() == 0
    kept = medallion.quarantine(bronze, keep_empty=True)
    assert [r.quarantine_reason for r in kept.collect()] == ["null_quality_level"] * 2


@pytest.mark.parametrize(
    ("fault", "reason"),
    [
        ({"count": -1}, "negative_buffering_count"),
        ({"ms": -1}, "negative_buffering_time"),
        ({"source": -1}, "negative_source_data"),
        ({"p2p": -1}, "negative_p2p_data"),
        ({"ms": 3_600_001}, "excessive_buffering"),
        ({"count": -1, "source": -5}, "negative_buffering_count"),
    ],
)
def test_reason_of_each_fault(spark, fault, reason):
    assert only(medallion.quarantine(fx.bronze(spark, fx.report(**fault)))).quarantine_reason == reason


def test_all_reasons_of_a_row(spark):
    rows = medallion.quality_rows(fx.bronze(spark, fx.report(count=-1, source=-5)))
    found = only(rows.select(medallion.quarantine_reasons().alias("r"))).r
    assert found == ["negative_buffering_count", "negative_source_data"]


def test_one_hour_exactly_is_fine_and_beyond_is_in_both(spark):
    bronze = fx.bronze(spark, fx.report(ms=3_600_000, client="a"), fx.report(ms=3_600_001, client="b"))
    assert [r.clientId for r in medallion.quarantine(bronze).collect()] == ["b"]
    assert sorted(r.clientId for r in medallion.silver_enriched(bronze).collect()) == ["a", "b"]
    routes = {r.route: r.row_count for r in medallion.routing(bronze).collect()}
    assert routes == {"silver_only": 1, "both": 1}


def test_null_metrics_go_nowhere(spark):
    bronze = fx.bronze(spark, fx.report(count=None), fx.report(ms=None), fx.report(source=None))
    assert {r.route: r.row_count for r in medallion.routing(bronze).collect()} == {"neither": 3}
    assert medallion.silver_enriched(bronze).count() == 0


def test_not_null_fails_or_drops(spark):
    bronze = fx.bronze(spark, fx.report(client=None), fx.report())
    assert medallion.silver_enriched(bronze, "drop").count() == 1
    assert medallion.silver_enriched(bronze, None).count() == 2
    with pytest.raises(Exception, match="NOT NULL"):
        medallion.silver_enriched(bronze, "fail").collect()


def test_bronze_rules(spark):
    bronze = fx.bronze(
        spark, fx.report(), fx.report(customer=""), fx.report(customer=None), fx.report(client=None),
        fx.report(server=0), fx.report(rescued="{}"), fx.report(day=None),
    )
    failed = {r.rule: r.failed for r in expectations.count_violations(bronze, expectations.BRONZE_RULES).collect()}
    assert failed == {
        "valid_customer_id": 2, "valid_client_id": 1, "valid_timestamp": 1, "valid_event_date": 1, "no_rescued_data": 1,
    }


def test_fail_rule_and_observed_counts(spark):
    rows = medallion.silver_candidates(medallion.quality_rows(fx.bronze(spark, fx.report(count=-1), fx.report())))
    strict = [expectations.Rule("no_negatives", "buffering_count >= 0", "fail")]
    with pytest.raises(Exception, match="no_negatives"):
        expectations.enforce(rows, strict).collect()
    watched, seen = expectations.observe(rows, expectations.SILVER_RULES, "seen")
    watched.collect()
    assert seen.get["rows"] == 2 and seen.get["valid_buffering_count"] == 1


@pytest.mark.parametrize(
    ("ms", "count", "score", "category"),
    [(0, 10, 80.0, "Excellent"), (0, 20, 60.0, "Good"), (0, 30, 40.0, "Fair"), (10, 30, 39.999, "Poor"), (0, 90, 0.0, "Poor")],
)
def test_score_edges(spark, ms, count, score, category):
    row = only(medallion.gold_viewer_qos(fx.silver(spark, fx.silver_row(ms=ms, count=count)), "exact"))
    assert (row.qos_score, row.qos_category) == (pytest.approx(score), category)


def test_no_bytes_means_zero_ratios(spark):
    row = only(medallion.gold_viewer_qos(fx.silver(spark, fx.silver_row(source=0)), "exact"))
    assert (row.source_traffic_percentage, row.buffering_ratio_percentage) == (0.0, 0.0)


def test_null_sum_scores_zero(spark):
    score = medallion.qos_score(F.lit(None).cast("double"), F.lit(None).cast("bigint"))
    assert only(spark.range(1).select(score.alias("s"))).s == 0.0


def test_session_grain_counts_a_report_once(spark):
    rows = [fx.silver_row(level=level) for level in ("360p", "720p", "1080p")]
    silver = fx.silver(spark, *rows)
    assert only(medallion.gold_viewer_qos(silver)).total_sessions == 3
    fair = only(medallion.gold_viewer_qos_session_grain(silver))
    assert (fair.total_sessions, fair.total_buffering_events) == (1, 1)
