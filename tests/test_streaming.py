import json
import os

import pytest
from pyspark.sql import functions as F

from odometer.operators.telemetry import decode_and_clean
from odometer.operators.utilization import utilization_metrics
from odometer.streaming.queries import start_live_queries, start_sliding, trigger_options, persist_metrics_batch

# (minute, fare) per one-file batch: the exact late-data sequence.
BATCHES = [
    [(1, 1), (6, 1)],
    [(12, 1), (2, 10)],
    [(3, 100), (11, 1)],
    [(4, 1000), (13, 1)],
    [(4, 5000), (14, 1)],
]


def _line(minute, fare):
    return json.dumps(
        {
            "trip_id": "T1",
            "driver_id": "D1",
            "vehicle_id": "V1",
            "lat": 6.9,
            "lon": 79.9,
            "speed": 20,
            "status": "on_trip",
            "fare": float(fare),
            "timestamp": f"2026-09-27T12:{minute:02d}:00+00:00",
        }
    )


def _drop(folder, k, rows):
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, f".batch-{k}.json.tmp")
    with open(tmp, "w") as fh:
        fh.write("\n".join(_line(m, v) for m, v in rows) + "\n")
    os.rename(tmp, os.path.join(folder, f"batch-{k}.json"))


def _dropped(query):
    return sum(
        sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
        for p in query.recentProgress
    )


def _drop_all(folder):
    """All five files up front, with strictly increasing modification times
    (the file source orders new files by modification time)."""
    for k, rows in enumerate(BATCHES):
        _drop(folder, k, rows)
        path = os.path.join(folder, f"batch-{k}.json")
        os.utime(path, (1_700_000_000 + k * 10, 1_700_000_000 + k * 10))


def _one_file_per_batch(spark, folder):
    return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)


def test_late_data_update_mode_exact(spark, scratch):
    source_dir = f"{scratch}/source"
    lake, metrics, ckpt = f"{scratch}/lake", f"{scratch}/metrics", f"{scratch}/ckpt"
    _drop_all(source_dir)
    lake_q, metric_q = start_live_queries(spark, _one_file_per_batch(spark, source_dir), lake, metrics, ckpt,
                                     available_now=True)
    lake_q.awaitTermination()
    metric_q.awaitTermination()
    drops = [
        sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
        for p in metric_q.recentProgress
        if p.get("numInputRows", 0) > 0
    ]
    from odometer.streaming.queries import progress_summary

    summary = progress_summary(metric_q)
    assert summary["batches"] == 5 and summary["input_rows"] == 10 and summary["dropped_by_watermark"] == 2
    hist = spark.read.parquet(metrics)
    per_batch = {}
    for r in hist.select("spark_batch_id", F.minute("window_start").alias("m"), "observed_earnings").collect():
        per_batch.setdefault(r["spark_batch_id"], []).append((r["m"], r["observed_earnings"]))
    assert [sorted(per_batch.get(b, [])) for b in range(5)] == [
        [(0, 1.0), (5, 1.0)],
        [(0, 11.0), (10, 1.0)],
        [(0, 111.0), (10, 2.0)],
        [(10, 3.0)],
        [(10, 4.0)],
    ]
    assert drops == [0, 0, 0, 1, 1]
    # the lake branch has no watermark: every row is kept
    assert spark.read.parquet(lake).count() == 10


def test_restarts_run_no_data_batches(spark, scratch):
    """One availableNow run per file: each run ends with a no-data batch that
    advances the watermark, so state is evicted one file earlier and the late
    row at minute 3 is already dropped in the third run."""
    source_dir = f"{scratch}/source"
    metrics, ckpt = f"{scratch}/metrics", f"{scratch}/ckpt"
    drops, lake_rows = [], 0
    for k, rows in enumerate(BATCHES):
        _drop(source_dir, k, rows)
        _, metric_q = start_live_queries(spark, spark.readStream.format("text").load(source_dir), f"{scratch}/lake",
                                    metrics, ckpt, available_now=True)
        metric_q.awaitTermination()
        drops.append(_dropped(metric_q))
    assert drops == [0, 0, 1, 1, 1]
    assert spark.read.parquet(f"{scratch}/lake").count() == 10


def test_late_data_append_mode(spark, scratch):
    source_dir = f"{scratch}/source"
    _drop_all(source_dir)
    emitted = {}

    def collect(df, batch_id):
        rows = df.select(F.minute("window_start").alias("m"), F.col("observed_earnings").alias("s")).collect()
        if rows:
            emitted[batch_id] = sorted((r["m"], r["s"]) for r in rows)

    metrics = utilization_metrics(decode_and_clean(_one_file_per_batch(spark, source_dir)))
    q = (
        metrics.writeStream.outputMode("append")
        .option("checkpointLocation", f"{scratch}/ckpt")
        .trigger(availableNow=True)
        .foreachBatch(collect)
        .start()
    )
    q.awaitTermination()
    assert emitted == {2: [(0, 111.0), (5, 1.0)]}


def test_retried_batch_does_not_duplicate(spark, scratch):
    path = f"{scratch}/metrics"
    batch = spark.createDataFrame([("z", 1)], "zone string, telemetry_event_count long").withColumn(
        "window_start", F.lit("2024-01-01").cast("timestamp"))
    persist_metrics_batch(batch, 7, path)
    persist_metrics_batch(batch, 7, path)
    persist_metrics_batch(batch, 8, path)
    counts = {r["spark_batch_id"]: r["count"] for r in spark.read.parquet(path).groupBy("spark_batch_id").count().collect()}
    assert counts == {7: 1, 8: 1}
    stamps = spark.read.parquet(path).select("processed_at").distinct().count()
    assert stamps == 2  # one stamp per batch


def test_older_sliding_stream(spark, scratch):
    source_dir = f"{scratch}/source"
    _drop(source_dir, 0, [(1, 1), (2, 2), (3, 3)])
    q = start_sliding(spark.readStream.format("text").load(source_dir), f"{scratch}/log", f"{scratch}/ckpt",
                      available_now=True)
    q.awaitTermination()
    log = spark.read.parquet(f"{scratch}/log")
    assert "idle_ratio" not in log.columns and "created_at" in log.columns
    rows = log.where(F.minute("window_start") == 0).collect()
    assert len(rows) == 1 and rows[0]["total_events"] == 3 and rows[0]["active_vehicles"] == 1


def test_trigger_must_be_positive():
    assert trigger_options(10) == {"processingTime": "10 seconds"}
    assert trigger_options(available_now=True) == {"availableNow": True}
    with pytest.raises(ValueError):
        trigger_options(0)


def test_supervisor_stops_the_other_query(spark, scratch):
    from odometer.streaming.queries import run_until_any_stops

    source_dir = f"{scratch}/source"
    _drop(source_dir, 0, [(1, 1)])
    spark.streams.resetTerminated()
    lake_q, metric_q = start_live_queries(spark, spark.readStream.format("text").load(source_dir), f"{scratch}/lake",
                                     f"{scratch}/metrics", f"{scratch}/ckpt", trigger_seconds=1)
    lake_q.processAllAvailable()
    lake_q.stop()
    run_until_any_stops(spark, (lake_q, metric_q))
    assert not lake_q.isActive and not metric_q.isActive
    spark.streams.resetTerminated()


def test_quality_stream_counts_what_validation_drops(spark, scratch):
    from odometer.streaming.queries import start_quality

    source_dir = f"{scratch}/source"
    _drop(source_dir, 0, [(1, 1), (2, -5)])  # negative fare is rejected
    with open(f"{source_dir}/junk.json", "w") as fh:
        fh.write("not json\n")
    for k in range(2):
        q = start_quality(spark.readStream.format("text").load(source_dir), f"{scratch}/checks", f"{scratch}/ckpt",
                          available_now=True)
        q.awaitTermination()
        if k == 0:
            _drop(source_dir, 1, [(3, 2)])
    hist = spark.read.parquet(f"{scratch}/checks")
    latest = {r["event_date"]: r for r in hist.groupBy("event_date").agg(
        F.max_by(F.struct(*[c for c in hist.columns if c not in ("event_date", "spark_batch_id")]), "spark_batch_id").alias("r")
    ).select("event_date", "r.*").collect()}
    day = [k for k in latest if k is not None][0]
    assert (latest[day]["rows"], latest[day]["accepted_rows"], latest[day]["bad_fare_rows"]) == (3, 2, 1)
    assert latest[None]["rows"] == 1 and latest[None]["bad_time_rows"] == 1


def test_older_sliding_stream_with_panes(spark, scratch):
    source_dir = f"{scratch}/source"
    _drop(source_dir, 0, [(1, 1), (2, 2), (3, 3), (20, 1)])  # minute 20 closes the early windows
    q = start_sliding(spark.readStream.format("text").load(source_dir), f"{scratch}/log", f"{scratch}/ckpt",
                      available_now=True, panes=True)
    q.awaitTermination()
    log = spark.read.parquet(f"{scratch}/log")
    rows = {r["window_start"].minute: r["total_events"] for r in log.collect()}
    assert rows[0] == 3 and rows[1] == 3 and rows[2] == 2


def test_metrics_batch_logs_its_totals(spark, scratch, caplog):
    import logging

    from odometer.streaming.queries import persist_metrics_batch

    batch = spark.createDataFrame([("z", 3)], "zone string, telemetry_event_count long").withColumn(
        "window_start", F.lit("2024-01-01").cast("timestamp"))
    with caplog.at_level(logging.INFO, logger="odometer.streaming"):
        persist_metrics_batch(batch, 5, f"{scratch}/m")
    event = json.loads(caplog.records[-1].getMessage())
    assert event["event"] == "metrics-batch-stored"
    assert (event["spark_batch_id"], event["metric_rows"], event["telemetry_events"]) == (5, 1, 3)


def test_a_new_checkpoint_keeps_the_history_of_the_old_one(spark, scratch):
    source_dir = f"{scratch}/source"
    metrics, serving = f"{scratch}/metrics", f"{scratch}/serving"
    for run, minutes in enumerate([[(1, 1)], [(21, 1)]]):
        _drop(source_dir, run, minutes)
        # the second run starts from an empty checkpoint: its batch is number 0 again
        for q in start_live_queries(spark, spark.readStream.format("text").load(source_dir), f"{scratch}/lake{run}", metrics,
                                    f"{scratch}/ckpt{run}", available_now=True, serving_path=serving):
            q.awaitTermination()
            assert q.exception() is None
    hist = spark.read.parquet(metrics)
    assert hist.select("stream_run").distinct().count() == 2
    assert {r[0] for r in hist.select("spark_batch_id").distinct().collect()} == {0}
    assert sorted(r[0].minute for r in hist.select("window_start").collect()) == [0, 0, 20]
    # the live path also keeps the typed serving table
    table = spark.read.parquet(serving)
    assert sorted(r[0].minute for r in table.select("window_start").collect()) == [0, 20]
    assert dict(table.dtypes)["observed_earnings"] == "decimal(14,2)" and dict(table.dtypes)["idle_event_count"] == "int"
