"""Facts about sinks that must come out false when the layout is broken, and the poor-customer threshold."""

from __future__ import annotations

from datetime import date

from playlens.catalog.sinks import disjoint_files, rows_in_place
from playlens.plans import monitoring
from playlens.sources import tables

DAY = date(2024, 1, 30)


def test_overlapping_files_are_found(spark, tmp_path):
    rows = spark.createDataFrame([(DAY, f"C{n:02}", n) for n in range(20)], "eventDate date, customerId string, n int")
    tables.write_clustered(rows, str(tmp_path / "good"), ["eventDate", "customerId"])
    for odd in (0, 1):  # files of even and of odd numbers overlap
        rows.filter(f"n % 2 = {odd}").coalesce(1).write.mode("append").partitionBy("eventDate").parquet(str(tmp_path / "bad"))
    for name, expected in (("good", True), ("bad", False)):
        found = disjoint_files(spark.read.parquet(str(tmp_path / name)), ["customerId"]).collect()
        assert [(r.eventDate, r.row_count, r.is_clustered) for r in found] == [(DAY, 20, expected)]


def test_rows_in_their_partition_folder(spark, tmp_path):
    rows = spark.createDataFrame([(DAY, "a b", 1), (DAY, "c/d", 2)], "eventDate date, quarantine_reason string, n int")
    path = str(tmp_path / "q")
    tables.write_partitioned(rows, path, tables.QUARANTINE_PARTITIONS)
    found = {r.quarantine_reason: (r.row_count, r.in_place) for r in rows_in_place(spark.read.parquet(path)).collect()}
    assert found == {"a b": (1, True), "c/d": (1, True)}
    rows.withColumn("other", rows.eventDate).write.parquet(str(tmp_path / "flat"))
    flat = rows_in_place(spark.read.parquet(str(tmp_path / "flat"))).collect()
    assert [r.in_place for r in flat] == [False, False]


def test_schema_with_a_folder(spark, tmp_path):
    tables.create_schema(spark, "sink_place", str(tmp_path / "place"))
    spark.createDataFrame([(1,)], "n int").write.saveAsTable("sink_place.t")
    assert (tmp_path / "place" / "t").is_dir()
    spark.sql("DROP SCHEMA sink_place CASCADE")


def test_poor_customers(spark):
    schema = "customerId string, eventDate date, qos_score double"
    rows = [("A", DAY, 30.0), ("A", DAY, 45.0), ("B", DAY, 80.0), ("C", DAY, None), ("D", date(2023, 1, 1), 1.0)]
    line = monitoring.poor_customers(spark.createDataFrame(rows, schema), "2024-01-30").first()
    assert (line.customers, line.poor_customers, line.status) == (3, 1, "ALERT")
    empty = monitoring.poor_customers(spark.createDataFrame([], schema), "2024-01-30").first()
    assert (empty.customers, empty.poor_customers, empty.poor_pct, empty.status) == (0, 0, None, "OK")
