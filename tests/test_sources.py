from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from playlens import schemas
from playlens.functions import scalar as S
from playlens.plans import event_defaults
from playlens.sources import batches, landing, tables


def test_bodies_and_rejects(spark):
    bodies = spark.createDataFrame(
        [
            (1, '{"events":[{"eventId":"a","sequenceNumber":1},{"eventId":"b","sequenceNumber":"x"}]}'),
            (2, '{"events":[{"eventId":"a"},{"ev'),
            (3, "{}"),
            (4, '{"events": []}'),
            (5, "not json"),
            (6, '{"other": 1}'),
            (7, None),
        ],
        "body_id int, body string",
    )
    parsed = batches.parse_bodies(bodies)
    assert {r.body_id: (r.is_rejected, r.batch_size) for r in parsed.collect()} == {
        1: (False, 2), 2: (True, 0), 3: (False, 0), 4: (False, 0), 5: (True, 0), 6: (False, 0), 7: (True, 0),
    }
    events = batches.unpack_events(parsed).orderBy("position").collect()
    assert [(e.eventId, e.sequenceNumber) for e in events] == [("a", 1), ("b", None)]
    assert sorted(r.body_id for r in batches.rejects(parsed).collect()) == [2, 5, 7]


def test_bodies_are_read_whole(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"events":[\n{"eventId":"a"}\n]}')
    parsed = batches.parse_bodies(batches.read_bodies(spark, str(tmp_path)))
    assert [r.eventId for r in batches.unpack_events(parsed).collect()] == ["a"]


def test_event_defaults(spark):
    body = '{"events":[{"schemaVersion":"4.0.0","elapsedMs":null,"environment":{"telemetryVersion":""}}]}'
    events = batches.unpack_events(batches.parse_bodies(spark.createDataFrame([(1, body)], "body_id int, body string")))
    row = event_defaults.with_defaults(events, 99).first()
    assert (row.eventId, row.playbackSessionId, row.sequenceNumber) == ("unknown-event-id", "unknown-session", 0)
    assert (row.event_timestamp, row.elapsedMs, row.eventType) == (99, 0, "UNKNOWN_EVENT")
    assert row.identities == ("unknown-tenant", "anonymous_user")
    assert row.environment == ("hls.js", "unknown", "4.0.0", "unknown")
    assert row.network.trafficBreakdown == {} and row.network.connectionType == "unknown"
    assert row.playerState == (0.0, False, False, 1.0)


def test_rescued_values(spark):
    hinted = schemas.struct(a=schemas.WHOLE, b=schemas.struct(c=schemas.BIG), d=schemas.TEXT)
    rows = [('{"a":1,"b":{"c":2},"d":"x"}',), ('{"a":"one","d":"x","e":5}',), ("oops",), ('{"a":null}',), (None,)]
    found = landing.rescue(spark.createDataFrame(rows, "raw string"), "raw", hinted).collect()
    assert [(r.a, r.b.c if r.b else None, r.d, r._rescued_data) for r in found] == [
        (1, 2, "x", None), (None, None, "x", '{"a":"one","e":"5"}'), (None, None, None, "oops"),
        (None, None, None, None), (None, None, None, None),
    ]


def test_finite_falsy_and_text_helpers(spark):
    df = spark.createDataFrame(
        [(1.5, "a"), (float("nan"), ""), (float("inf"), None), (None, "x" * 181)], "n double, s string"
    )
    rows = df.select(S.finite_or("n", -1.0).alias("n"), S.or_default("s", "d").alias("s"), S.ellipsis("s").alias("e")).collect()
    assert [r.n for r in rows] == [1.5, -1.0, -1.0, -1.0]
    assert [r.s for r in rows][:3] == ["a", "d", "d"]
    assert rows[3].e == "x" * 180 + "..." and rows[1].e == ""


@pytest.mark.parametrize(("value", "status"), [(11.0, "ALERT"), (10.0, "WARNING"), (5.0, "OK"), (None, "OK")])
def test_tiers(spark, value, status):
    assert spark.range(1).select(S.tier(F.lit(value).cast("double"), 10, 5)).first()[0] == status


def test_batch_read_with_added_column(spark, tmp_path):
    path = str(tmp_path / "landing")
    day = "eventDate=2024-01-10"
    older = fx.bronze(spark, fx.report()).drop("eventDate", "_rescued_data")
    older.write.parquet(f"{path}/{day}/a")
    older.withColumn("cdn", F.lit("edge")).write.parquet(f"{path}/{day}/b")
    fixed = landing.read_reports(spark, f"{path}/{day}/a")
    assert fixed.columns == schemas.BRONZE.names
    wide = landing.align(spark.read.option("mergeSchema", True).parquet(f"{path}/{day}/a", f"{path}/{day}/b"), schemas.BRONZE)
    assert landing.added_columns(wide) == ["cdn"]
    assert sorted(str(r.cdn) for r in wide.collect()) == ["None", "edge"]
    both = landing.union_evolved(older, older.withColumn("cdn", F.lit("x")))
    assert both.filter("cdn IS NULL").count() == 1


def test_ingest_loses_no_column_and_no_value(spark, tmp_path):
    path = str(tmp_path / "landing")
    older = fx.bronze(spark, fx.report()).drop("eventDate", "_rescued_data")
    older.write.parquet(f"{path}/eventDate=2024-01-10")
    older.withColumn("cdn", F.lit("edge")).write.parquet(f"{path}/eventDate=2024-01-11")
    odd = older.withColumn("clientId", F.struct(F.lit(1).alias("id")))
    odd = odd.withColumn("player", F.struct(F.lit("two").alias("bufferings"), F.lit("7").alias("bufferingTime")))
    odd.write.parquet(f"{path}/eventDate=2024-01-12")
    older.withColumn("customerId", F.lit(5)).write.mode("append").parquet(f"{path}/eventDate=2024-01-12")
    rows = {(str(r.eventDate), r.customerId): r for r in landing.read_reports(spark, path).collect()}
    assert len(rows) == 4 and {r.cdn for r in rows.values()} == {None, "edge"}
    lost = rows["2024-01-12", "C1"]
    assert lost.clientId is None or "1" in lost.clientId
    assert '"bufferings":"two"' in lost._rescued_data and lost.player.bufferings is None
    assert rows["2024-01-12", "5"]._rescued_data is None and rows["2024-01-10", "C1"]._rescued_data is None
    assert landing.widened(spark, f"{path}").names[-1] == "cdn"
    assert "cdn" in landing.stream_reports(spark, path).columns


def test_partition_filter_prunes(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_clustered(fx.silver(spark, fx.silver_row(), fx.silver_row(client="U2")), path, tables.CLUSTER_KEYS["silver"])
    plan = spark.read.parquet(path).filter("eventDate >= DATE'2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eventDate" in plan


def test_catalog_helpers(spark):
    tables.create_schema(spark, "lab")
    tables.create_table(spark, "lab.gold", schemas.GOLD, ["eventDate"], {"quality": "gold"})
    described = {r.col_name: r.comment for r in tables.describe(spark, "lab.gold").collect()}
    assert described["qos_score"] == "Viewing quality, 0 to 100"
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES lab.gold").collect()}
    assert props["quality"] == "gold"
    tables.create_like(spark, "lab.gold_archive", "lab.gold")
    assert {r.tableName for r in tables.list_tables(spark, "lab").collect()} >= {"gold", "gold_archive"}
    name = tables.backup_table(fx.silver(spark, fx.silver_row()), "lab.silver")
    assert name.startswith("lab.silver_backup_") and spark.table(name).count() == 1
    tables.register_view(spark.range(3), "three")
    assert spark.table("three").count() == 3 and tables.drop_view(spark, "three")
