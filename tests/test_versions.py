"""Versioned tables: a reader sees whole versions only; rejects outlive runs."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from odometer import hadoop
from odometer.sinks import versions
from odometer.sinks.merge import merge_profitability, merge_utilization, outstanding_rejects, replay_rejects, serve_utilization
from odometer.sinks.versions import VersionedTable, report_table, served_latest_window, snapshot_row, utilization_table

T0 = dt.datetime(2024, 1, 1, 0, 0)
DAY = dt.timedelta(days=1)


def metric(spark, rows):
    """(window_start, zone, events, processed_at, batch)"""
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, zone string, telemetry_event_count long, processed_at timestamp_ntz, spark_batch_id long")
    df = df.withColumn("window_start", F.col("window_start").cast("timestamp")).withColumn("processed_at", F.col("processed_at").cast("timestamp"))
    df = df.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES"))
    counts = {c: F.lit(0).cast("long") for c in ("idle_event_count", "on_trip_event_count", "active_event_count")}
    return df.withColumns(counts | {c: F.lit(1.0) for c in ("observed_earnings", "average_speed", "idle_ratio")})


def stored(spark, table, **more):
    return {(r["window_start"].day, r["zone"]): r["telemetry_event_count"] for r in table.read(spark, **more).collect()}


def test_guarded_merge_by_versions(spark, scratch):
    table = utilization_table(f"{scratch}/t")
    assert table.read(spark) is None and table.snapshot(spark).number == 0
    merge_utilization(spark, table, metric(spark, [(T0, "a", 1, T0, 0), (T0 + DAY, "a", 1, T0 + DAY, 0)]))
    merge_utilization(spark, table, metric(spark, [(T0, "a", 5, T0 - dt.timedelta(seconds=1), 1), (T0, "b", 2, T0, 1)]))
    assert stored(spark, table) == {(1, "a"): 1, (1, "b"): 2, (2, "a"): 1}
    at = table.snapshot(spark)
    assert (at.number, at.rows) == (2, 3)
    assert at.parts["2024-01-01"]["folder"] != at.parts["2024-01-02"]["folder"], "an untouched day stays where it is"
    # one day is read: no file of another folder
    day = table.read(spark, ["2024-01-02"])
    assert day.count() == 1 and all("window_date=2024-01-02" in f for f in day.inputFiles())
    assert table.newest_days(spark) == ["2024-01-02"] and table.newest_days(spark, 2, "2024-01-01") == ["2024-01-01"]
    # an older version is still readable
    assert stored(spark, table, snapshot=table.snapshot(spark, 1)) == {(1, "a"): 1, (2, "a"): 1}
    merge_utilization(spark, table, metric(spark, []))
    assert table.snapshot(spark).number == 2


def test_a_write_that_fails_in_the_middle_changes_nothing(spark, scratch):
    table = utilization_table(f"{scratch}/t")
    merge_utilization(spark, table, metric(spark, [(T0, "a", 1, T0, 0), (T0, "b", 1, T0, 0)]))
    reader = table.read(spark)
    broken = metric(spark, [(T0, "a", 9, T0 + DAY, 1), (T0, "b", 9, T0 + DAY, 1)]).withColumn(
        "average_speed", F.when(F.col("zone") == "b", F.raise_error(F.lit("lost"))).otherwise(F.lit(1.0)).cast("double"))
    with pytest.raises(Exception, match="lost"):
        merge_utilization(spark, table, broken)
    assert stored(spark, table) == {(1, "a"): 1, (1, "b"): 1} and reader.count() == 2
    assert [n for n in hadoop.names(spark, table.path) if n.startswith("version=2")] == []


def test_a_writer_lost_before_its_manifest_changes_nothing(spark, scratch, monkeypatch):
    table = utilization_table(f"{scratch}/t")
    merge_utilization(spark, table, metric(spark, [(T0, "a", 1, T0, 0)]))

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_publish", lost)
        with pytest.raises(KeyboardInterrupt):
            merge_utilization(spark, table, metric(spark, [(T0, "a", 2, T0 + DAY, 1)]))
    assert stored(spark, table) == {(1, "a"): 1}
    merge_utilization(spark, table, metric(spark, [(T0, "a", 2, T0 + DAY, 1)]))
    assert stored(spark, table) == {(1, "a"): 2} and table.snapshot(spark).number == 2


def test_of_two_writers_both_are_kept(spark, scratch, monkeypatch):
    """The second writer reads before the first publishes, finds its number
    taken and merges again."""
    table = utilization_table(f"{scratch}/t")
    merge_utilization(spark, table, metric(spark, [(T0, "a", 1, T0, 0)]))
    publish, first = VersionedTable._publish, threading.Event()

    def overtaken(self, session, number, *rest):
        if not first.is_set():
            first.set()
            merge_utilization(spark, table, metric(spark, [(T0, "b", 7, T0, 1)]))
        return publish(self, session, number, *rest)

    monkeypatch.setattr(VersionedTable, "_publish", overtaken)
    merge_utilization(spark, table, metric(spark, [(T0, "c", 8, T0, 2)]))
    assert stored(spark, table) == {(1, "a"): 1, (1, "b"): 7, (1, "c"): 8} and table.snapshot(spark).number == 3


def test_a_writer_always_overtaken_gives_up(spark, scratch, monkeypatch):
    table = utilization_table(f"{scratch}/t")
    monkeypatch.setattr(versions, "ATTEMPTS", 2)
    monkeypatch.setattr(VersionedTable, "_publish", lambda *_: False)
    with pytest.raises(versions.VersionConflict):
        merge_utilization(spark, table, metric(spark, [(T0, "a", 1, T0, 0)]))
    assert table.read(spark) is None


def test_old_versions_go_and_named_folders_stay(spark, scratch):
    table = utilization_table(f"{scratch}/t", keep=3)
    for n in range(7):
        day = T0 if n else T0 + DAY  # version 1 alone holds the second day
        merge_utilization(spark, table, metric(spark, [(day, "a", n, T0 + n * DAY, n)]))
    assert table.numbers(spark) == [4, 5, 6, 7]
    folders = sorted(int(f[8:].split("-")[0]) for f in hadoop.names(spark, table.path) if f.startswith("version="))
    assert folders == [1, 4, 5, 6, 7]
    assert stored(spark, table) == {(1, "a"): 6, (2, "a"): 0}


def test_unguarded_merge_and_snapshot_without_reading(spark, scratch):
    metrics, reports = utilization_table(f"{scratch}/m"), report_table(f"{scratch}/r")
    row = snapshot_row(spark, metrics, reports).first()
    assert (row["last_processed_at"], row["metric_rows"], row["profitability_rows"]) == (None, 0, 0)
    merge_utilization(spark, metrics, metric(spark, [(T0, "a", 1, T0, 0), (T0 + DAY, "a", 1, T0 + DAY, 0)]))
    cols = ("report_date date, vehicle_id string, completed_trip_count long, trip_revenue double, fuel_cost double, "
            "maintenance_cost double, total_expense double, distance_covered double, service_flag string, "
            "profit double, profit_margin_pct double, profitability_status string")
    line = ("V1", 1, 1.0, 1.0, 1.0, 2.0, 1.0, "x", -1.0, None, "unprofitable")
    rows = [(T0.date(), *line), (T0.date(), "V2", *line[1:]), ((T0 + DAY).date(), *line)]
    merge_profitability(spark, reports, spark.createDataFrame(rows, cols), dt.datetime(2024, 2, 1))
    rerun = spark.createDataFrame([(T0.date(), "V1", 2, 9.0, 1.0, 1.0, 2.0, 1.0, "x", 7.0, 77.78, "profitable")], cols)
    merge_profitability(spark, reports, rerun, dt.datetime(2024, 2, 2))
    got = {(r["report_date"].day, r["vehicle_id"]): (r["profit"], r["updated_at"].month, r["updated_at"].day) for r in reports.read(spark).collect()}
    assert got == {(1, "V1"): (7.0, 2, 2), (1, "V2"): (-1.0, 2, 1), (2, "V1"): (-1.0, 2, 1)}
    snapshot = snapshot_row(spark, metrics, reports)
    row = snapshot.first()
    assert (row["last_processed_at"], row["metric_rows"], row["profitability_rows"]) == (T0 + DAY, 2, 3)
    assert snapshot.inputFiles() == []


def test_rows_without_a_day_are_refused(spark, scratch):
    table = utilization_table(f"{scratch}/t")
    with pytest.raises(ValueError, match="window_date"):
        merge_utilization(spark, table, metric(spark, [(T0, "a", 1, T0, 0), (None, "a", 1, T0, 0)]))
    assert table.read(spark) is None


def bad_rows(spark, zone, batch, run):
    rows = metric(spark, [(T0, zone, 1, T0, batch), (T0, f"{zone}-huge", 1, T0, batch)])
    return rows.withColumn("observed_earnings", F.when(F.col("zone").endswith("huge"), 1e30).otherwise(2.0)).withColumn("stream_run", F.lit(run))


def test_rejects_of_runs_and_steps_do_not_meet(spark, scratch):
    table, rejects = utilization_table(f"{scratch}/t"), f"{scratch}/rejects"
    serve_utilization(spark, table, bad_rows(spark, "a", 0, "run1"), rejects, "live")
    serve_utilization(spark, table, bad_rows(spark, "b", 0, "run2"), rejects, "live")  # a reset checkpoint: batch 0 again
    serve_utilization(spark, table, bad_rows(spark, "c", 0, "run1"), rejects, "fold")
    serve_utilization(spark, table, bad_rows(spark, "a", 0, "run1"), rejects, "live")  # a retry
    kept = sorted((r["zone"], r["reject_step"], r["stream_run"], r["reject_reason"]) for r in spark.read.parquet(rejects).collect())
    assert kept == [
        ("a-huge", "live", "run1", "observed_earnings out of range"),
        ("b-huge", "live", "run2", "observed_earnings out of range"),
        ("c-huge", "fold", "run1", "observed_earnings out of range"),
    ]


def test_replay_round_trip(spark, scratch):
    table, rejects = utilization_table(f"{scratch}/t"), f"{scratch}/rejects"
    for zone, run in (("a", "run1"), ("b", "run2")):
        serve_utilization(spark, table, bad_rows(spark, zone, 0, run), rejects, "live")
    assert len(outstanding_rejects(spark, rejects)) == 2

    def halfway(rows):
        fixed = F.when(F.col("zone") == "a-huge", 5.0).otherwise(F.col("observed_earnings"))
        return rows.withColumn("observed_earnings", fixed)

    assert replay_rejects(spark, rejects, table, halfway) == (1, 1)
    assert {z for _, z in stored(spark, table)} == {"a", "b", "a-huge"}
    assert outstanding_rejects(spark, rejects) == ["reject_step=replay-1/stream_run=run2/spark_batch_id=0"]
    assert replay_rejects(spark, rejects, table, lambda rows: rows.withColumn("observed_earnings", F.lit(6.0))) == (1, 0)
    before = table.snapshot(spark).number
    assert replay_rejects(spark, rejects, table, lambda rows: rows) == (0, 0)
    assert table.snapshot(spark).number == before and outstanding_rejects(spark, rejects) == []
    assert {z: str(r) for z, r in table.read(spark).select("zone", "observed_earnings").collect()} == {
        "a": "2.00", "b": "2.00", "a-huge": "5.00", "b-huge": "6.00"}


def test_newest_window_reads_its_day_only(spark, scratch):
    table = utilization_table(f"{scratch}/t")
    assert served_latest_window(spark, table) is None
    hour = dt.timedelta(hours=1)
    rows = [(T0, "colombo_a", 1, T0, 0), (T0 + 23 * hour, "colombo_a", 2, T0, 0), (T0 + 23 * hour, "outside_service_area", 3, T0, 0),
            (T0 + 2 * DAY, "colombo_b", 4, T0, 0)]
    merge_utilization(spark, table, metric(spark, rows))
    newest = served_latest_window(spark, table)
    assert [(r["zone"], r["metric_window_count"]) for r in newest.collect()] == [("colombo_b", 1)]
    assert all("window_date=2024-01-03" in f for f in newest.inputFiles())
    for before in ("2024-01-02 12:00:00", "2024-01-03 00:01:00"):
        closed = served_latest_window(spark, table, closed_before=before)
        assert [(r["zone"], r["telemetry_event_count"]) for r in closed.collect()] == [("colombo_a", 2), ("outside_service_area", 3)]
        assert not any("window_date=2024-01-02" in f for f in closed.inputFiles())
    assert [r["zone"] for r in served_latest_window(spark, table, "colombo_a", "2024-01-02 12:00:00").collect()] == ["colombo_a"]
    with pytest.raises(ValueError):
        served_latest_window(spark, table, "elsewhere")
