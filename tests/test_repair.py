"""Late-data repair, totals of whole runs, and alerts out of silence."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from odometer.operators.utilization import utilization_metrics
from odometer.plans.repair import REPAIR_BATCH, repair_late_windows
from odometer.session import stored_or_none
from odometer.sinks.versions import utilization_table
from odometer.sources.lake import read_clean_lake
from odometer.streaming.alerting import freshness_changes, start_alerting
from odometer.streaming.queries import progress_summary, start_live_queries
from odometer.streaming.totals import RunTotals, Totals, saved_totals


def line(minute, fare, vehicle="V1", lat=6.9):
    return json.dumps({"trip_id": "T1", "driver_id": "D1", "vehicle_id": vehicle, "lat": lat, "lon": 79.9, "speed": 20,
                       "status": "on_trip", "fare": float(fare), "timestamp": f"2026-09-27T12:{minute:02d}:00+00:00"})


def drop(folder, k, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{k}", "w") as fh:
        fh.write("\n".join(line(*r) for r in rows) + "\n")
    os.utime(f"{folder}/.{k}", (1_700_000_000 + k, 1_700_000_000 + k))
    os.rename(f"{folder}/.{k}", f"{folder}/batch-{k:04d}.json")


def live(spark, scratch, serving, one_by_one=False):
    reader = spark.readStream.format("text")
    source = (reader.option("maxFilesPerTrigger", 1) if one_by_one else reader).load(f"{scratch}/source")
    queries = start_live_queries(spark, source, f"{scratch}/lake", f"{scratch}/metrics", f"{scratch}/ckpt", available_now=True, serving_path=serving)
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None
    return queries


def windows(rows):
    return {(r["window_start"].minute, r["zone"][-4:]): (r["telemetry_event_count"], float(r["observed_earnings"])) for r in rows}


@pytest.mark.parametrize("versioned", [True, False])
def test_dropped_rows_come_back_once(spark, scratch, versioned):
    path = f"{scratch}/serving"
    serving = utilization_table(path) if versioned else path

    def table():
        return serving.read(spark) if versioned else spark.read.parquet(path)

    marks = f"{scratch}/marks"
    drop(f"{scratch}/source", 0, [(1, 1), (6, 1), (31, 1)])
    live(spark, scratch, serving)
    # late: one into a served window, one into a window never served, and another zone
    drop(f"{scratch}/source", 1, [(2, 10), (16, 100), (6, 1000, "V2", 6.99), (32, 1)])
    live(spark, scratch, serving)
    assert windows(table().collect()) == {(0, "east"): (1, 1.0), (5, "east"): (1, 1.0), (30, "east"): (2, 2.0)}
    lake = read_clean_lake(spark, f"{scratch}/lake")
    changed = repair_late_windows(spark, lake, serving, marks)
    assert sorted((r["window_start"].minute, r["recovered_rows"], r["spark_batch_id"]) for r in changed.collect()) == [
        (0, 1, 0), (5, 1, REPAIR_BATCH), (15, 1, REPAIR_BATCH)]
    key = ["window_start", "zone"]
    whole = utilization_metrics(read_clean_lake(spark, f"{scratch}/lake"), watermark=None)
    both = table().alias("a").join(whole.alias("b"), key, "full")
    assert both.where("a.telemetry_event_count IS DISTINCT FROM b.telemetry_event_count").count() == 0
    # nothing new: nothing read again, nothing changed
    assert repair_late_windows(spark, read_clean_lake(spark, f"{scratch}/lake"), serving, marks).count() == 0
    # only rows after the mark are looked at
    drop(f"{scratch}/source", 2, [(3, 5)])
    live(spark, scratch, serving)
    changed = repair_late_windows(spark, read_clean_lake(spark, f"{scratch}/lake"), serving, marks)
    assert [(r["window_start"].minute, r["recovered_rows"], float(r["observed_earnings"])) for r in changed.collect()] == [(0, 1, 16.0)]


def test_an_empty_lake_needs_no_repair(spark, scratch):
    empty = spark.createDataFrame([], "event_time timestamp, ingested_at timestamp, event_date date, zone string, status string, fare double, speed int")
    assert repair_late_windows(spark, empty, utilization_table(f"{scratch}/t"), f"{scratch}/marks").collect() == []


def test_totals_of_more_batches_than_spark_keeps(spark, scratch):
    batches = 13
    for k in range(batches):
        drop(f"{scratch}/source", k, [(2 * k, 1), (2 * k + 1, 1)] if k < 10 else [(0, 1), (25, 1)])
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    listener = RunTotals()
    spark.streams.addListener(listener)
    try:
        lake, metrics = live(spark, scratch, None, one_by_one=True)
        totals = listener.totals(metrics)
        assert (totals.batches, totals.input_rows) == (batches, 2 * batches)
        assert totals.dropped_by_watermark == 3 and totals.rows_per_sec > 0 and totals.state_rows >= 1
        assert progress_summary(metrics)["input_rows"] < 2 * batches, "Spark itself has forgotten the first batches"
        assert listener.totals(lake).input_rows == 2 * batches
        listener.save(spark, metrics, f"{scratch}/totals")
        listener.save(spark, metrics, f"{scratch}/totals")
        assert saved_totals(spark, metrics.id, f"{scratch}/totals") == totals
        # a restart goes on with the same query: its totals add up
        drop(f"{scratch}/source", batches, [(26, 1), (1, 1)])
        _, again = live(spark, scratch, None, one_by_one=True)
        assert again.id == metrics.id
        whole = listener.totals(again)
        assert (whole.input_rows, whole.dropped_by_watermark) == (2 * batches + 2, 4)
        listener.save(spark, again, f"{scratch}/totals")
        assert saved_totals(spark, again.id, f"{scratch}/totals").input_rows == 2 * batches + 2
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert saved_totals(spark, "none", f"{scratch}/totals") == Totals()


def test_silence_alone_alerts_once_and_arrival_recovers(spark, scratch):
    folder, log = f"{scratch}/source", f"{scratch}/alerts"
    os.makedirs(folder)
    rows = spark.readStream.format("text").load(folder)
    query = start_alerting(rows, log, f"{scratch}/ckpt", threshold_seconds=2, trigger_seconds=1)

    def alerts():
        found = stored_or_none(spark, log)
        rows = [] if found is None else found.orderBy("created_at").collect()
        return [(r["status"], r["severity"], r["feed"]) for r in rows]

    def until(n, seconds=90):
        end = time.monotonic() + seconds
        while len(alerts()) < n and time.monotonic() < end:
            assert query.isActive, query.exception()
            time.sleep(0.5)
        return alerts()

    try:
        drop(folder, 0, [(1, 1), (2, 1)])
        up, down = ("healthy", "info", "telemetry"), ("unhealthy", "critical", "telemetry")
        assert until(2) == [up, down], "silence itself sets off the alert"
        time.sleep(5)
        assert alerts() == [up, down], "and only once"
        drop(folder, 1, [(3, 1)])
        assert until(3)[:3] == [up, down, up]
    finally:
        query.stop()
    stale = spark.read.parquet(log).where("status = 'unhealthy'").first()
    assert stale["age_seconds"] > 2 and stale["message"] == f"No telemetry processed for {stale['age_seconds']} seconds."
    assert json.loads(stale["context"])["no_data_alert_seconds"] == 2
    assert stale["created_at"] - stale["last_processed_at"] > dt.timedelta(seconds=2)


def test_a_threshold_must_be_positive(spark):
    with pytest.raises(ValueError):
        freshness_changes(spark.readStream.format("rate").load(), 0)


def test_feeds_are_watched_each_for_itself(spark, scratch):
    folder, log = f"{scratch}/source", f"{scratch}/alerts"
    os.makedirs(folder)
    drop(folder, 0, [(1, 1), (1, 1, "V2")])
    rows = spark.readStream.format("text").load(folder).select(F.get_json_object("value", "$.vehicle_id").alias("vehicle"))
    query = start_alerting(rows, log, f"{scratch}/ckpt", threshold_seconds=600, trigger_seconds=1, feed="vehicle")
    try:
        end = time.monotonic() + 60
        while time.monotonic() < end and ((found := stored_or_none(spark, log)) is None or found.count() < 2):
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted((r["feed"], r["status"]) for r in spark.read.parquet(log).collect()) == [("V1", "healthy"), ("V2", "healthy")]
