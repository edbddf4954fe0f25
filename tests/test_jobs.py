import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from odometer.operators.serving import latest_per_key
from odometer.plans.jobs import reconcile, run_live
from odometer.sinks.files import write_expense_feed
from odometer.sinks.merge import merge_profitability, merge_utilization
from odometer.streaming.queries import persist_metrics_batch


def _line(vehicle, trip, day, minute, fare, status="on_trip"):
    return json.dumps(
        {"trip_id": trip, "driver_id": "D" + vehicle[1:], "vehicle_id": vehicle, "lat": 6.9, "lon": 79.82,
         "speed": 30, "status": status, "fare": fare, "timestamp": f"2026-09-{day:02d}T10:{minute:02d}:00+00:00"}
    )


def test_live_then_reconcile_end_to_end(spark, scratch):
    src = f"{scratch}/source"
    os.makedirs(src)
    with open(f"{src}/part-0.json", "w") as fh:
        fh.write("\n".join([
            _line("V1", "T1", 26, 1, 100.0),
            _line("V1", "T1", 26, 2, 120.0),
            _line("V1", "T2", 26, 3, 50.0),
            _line("V2", "T9", 26, 4, 10.0, status="idle"),
            _line("V1", "T3", 27, 1, 70.0),
            "not json",
        ]) + "\n")
    lake, metrics = f"{scratch}/lake", f"{scratch}/metrics"
    run_live(spark, spark.readStream.format("text").load(src), lake, metrics, f"{scratch}/ckpt", available_now=True)
    assert spark.read.parquet(lake).count() == 5
    assert {r[0] for r in spark.read.parquet(lake).select("event_date").distinct().collect()} == {
        dt.date(2026, 9, 26), dt.date(2026, 9, 27)}
    assert latest_per_key(spark.read.parquet(metrics)).count() == 2

    feed = spark.createDataFrame(
        [(dt.date(2026, 9, 26), "V1", 10.0, 5.0, 20.0, "required"),
         (dt.date(2026, 9, 26), "V2", 1.0, 0.0, 20.0, "not_required"),
         (dt.date(2026, 9, 27), "V1", 10.0, 5.0, 20.0, "not_required")],
        "report_date date, vehicle_id string, fuel_cost double, maintenance_cost double, "
        "distance_covered double, service_flag string",
    )
    feeds = f"{scratch}/feeds"
    write_expense_feed(feed, feeds)
    out, csv, serving = f"{scratch}/reports", f"{scratch}/csv", f"{scratch}/serving"
    rows = reconcile(spark, feeds, lake, out, csv, serving).collect()
    by = {(r["report_date"], r["vehicle_id"]): r for r in rows}
    v1 = by[(dt.date(2026, 9, 26), "V1")]
    assert (v1["completed_trip_count"], v1["trip_revenue"], v1["profit"]) == (2, 170.0, 155.0)
    assert by[(dt.date(2026, 9, 26), "V2")]["completed_trip_count"] == 0
    assert by[(dt.date(2026, 9, 27), "V1")]["trip_revenue"] == 70.0
    assert spark.read.parquet(out).count() == 3
    assert len(glob.glob(f"{csv}/csv_date=*/*.csv")) == 2
    assert spark.read.parquet(serving).count() == 3

    # single-date re-run: only that date is replaced in the Parquet report
    reconcile(spark, feeds + "/feed_file=vehicle_expenses_2026-09-27.csv", lake, out, csv, serving,
              report_date="2026-09-27")
    assert spark.read.parquet(out).count() == 3


def test_lake_merges_touch_only_their_partitions(spark, scratch):
    path = f"{scratch}/serving_util"
    t0 = dt.datetime(2024, 1, 1, 0, 0)

    def batch(rows):
        df = spark.createDataFrame(
            rows, "window_start timestamp_ntz, zone string, telemetry_event_count long, processed_at timestamp_ntz")
        return (df.withColumn("window_start", F.col("window_start").cast("timestamp"))
                .withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES"))
                .withColumn("processed_at", F.col("processed_at").cast("timestamp"))
                .withColumn("spark_batch_id", F.lit(0).cast("long")))

    day2 = t0 + dt.timedelta(days=1)
    merge_utilization(spark, path, batch([(t0, "a", 1, t0), (day2, "a", 1, day2)]))
    merge_utilization(spark, path, batch([(t0, "a", 5, t0 - dt.timedelta(seconds=1)), (t0, "b", 2, t0)]))
    got = {(r["window_start"].date(), r["zone"]): r["telemetry_event_count"] for r in spark.read.parquet(path).collect()}
    assert got == {(t0.date(), "a"): 1, (t0.date(), "b"): 2, (day2.date(), "a"): 1}

    rpath = f"{scratch}/serving_report"
    cols = ("report_date date, vehicle_id string, completed_trip_count long, trip_revenue double, fuel_cost double, "
            "maintenance_cost double, total_expense double, distance_covered double, service_flag string, "
            "profit double, profit_margin_pct double, profitability_status string")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    first = spark.createDataFrame([(d1, "V1", 1, 1.0, 1.0, 1.0, 2.0, 1.0, "x", -1.0, None, "unprofitable"),
                                   (d1, "V2", 1, 1.0, 1.0, 1.0, 2.0, 1.0, "x", -1.0, None, "unprofitable"),
                                   (d2, "V1", 1, 1.0, 1.0, 1.0, 2.0, 1.0, "x", -1.0, None, "unprofitable")], cols)
    merge_profitability(spark, rpath, first, dt.datetime(2024, 2, 1))
    rerun = spark.createDataFrame([(d1, "V1", 2, 9.0, 1.0, 1.0, 2.0, 1.0, "x", 7.0, 77.78, "profitable")], cols)
    merge_profitability(spark, rpath, rerun, dt.datetime(2024, 2, 2))
    got = {(r["report_date"], r["vehicle_id"]): (r["profit"], r["updated_at"]) for r in spark.read.parquet(rpath).collect()}
    assert got == {(d1, "V1"): (7.0, dt.datetime(2024, 2, 2)), (d1, "V2"): (-1.0, dt.datetime(2024, 2, 1)),
                   (d2, "V1"): (-1.0, dt.datetime(2024, 2, 1))}


def test_batch_totals_are_observed(spark, scratch):
    batch = spark.createDataFrame([("z", 3), ("y", 4)], "zone string, telemetry_event_count long").withColumn(
        "window_start", F.lit("2024-01-01").cast("timestamp"))
    totals = persist_metrics_batch(batch, 3, f"{scratch}/m")
    assert totals == {"metric_rows": 2, "telemetry_events": 7, "spark_batch_id": 3}


METRIC_ROW = "window_start timestamp_ntz, zone string, telemetry_event_count long"


def _metrics(spark, rows):
    df = spark.createDataFrame(rows, METRIC_ROW)
    df = df.withColumn("window_start", F.col("window_start").cast("timestamp"))
    df = df.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES"))
    counts = {c: F.lit(0).cast("long") for c in ("idle_event_count", "on_trip_event_count", "active_event_count")}
    amounts = {c: F.lit(1.0) for c in ("observed_earnings", "average_speed", "idle_ratio")}
    return df.withColumns(counts | amounts)


def _check_times(spark, t0, minutes):
    df = spark.createDataFrame([(t0 + dt.timedelta(minutes=m),) for m in minutes], "check_time timestamp_ntz")
    return df.withColumn("check_time", F.col("check_time").cast("timestamp"))


def test_compaction_folds_each_batch_once(spark, scratch):
    from odometer.plans.jobs import compact_metrics

    metrics, serving = f"{scratch}/metrics", f"{scratch}/serving"
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    persist_metrics_batch(_metrics(spark, [(t0, "a", 1)]), 0, metrics, processed_at=t0 + dt.timedelta(minutes=5))
    persist_metrics_batch(_metrics(spark, [(t0, "a", 2)]), 1, metrics, processed_at=t0 + dt.timedelta(minutes=6))
    assert compact_metrics(spark, metrics, serving) == 2
    rows = spark.read.parquet(serving).collect()
    assert len(rows) == 1 and rows[0]["telemetry_event_count"] == 2 and str(rows[0]["observed_earnings"]) == "1.00"
    assert compact_metrics(spark, metrics, serving) == 0
    persist_metrics_batch(_metrics(spark, [(t0, "a", 9)]), 2, metrics, processed_at=t0)  # older than what is stored
    assert compact_metrics(spark, metrics, serving) == 1
    assert spark.read.parquet(serving).first()["telemetry_event_count"] == 2


def test_serving_writes_keep_the_constraints(spark, scratch):
    import pytest

    from odometer.sinks.merge import serve_utilization

    t0 = dt.datetime(2024, 1, 1, 0, 0)
    rows = _metrics(spark, [(t0, "ok", 1), (t0, "huge", 1), (t0, "nan", 1), (t0, None, 1), (t0, "null", None)])
    rows = rows.withColumn("observed_earnings", F.when(F.col("zone") == "huge", 1e30).otherwise(F.lit(2.345)))
    rows = rows.withColumn("average_speed", F.when(F.col("zone") == "nan", F.lit(float("nan"))).otherwise(F.lit(None)))
    rows = rows.withColumn("spark_batch_id", F.lit(0).cast("long")).withColumn("processed_at", F.col("window_end"))
    with pytest.raises(ValueError):
        serve_utilization(spark, f"{scratch}/s", rows)
    assert not os.path.exists(f"{scratch}/s")
    serve_utilization(spark, f"{scratch}/s", rows, f"{scratch}/rejects")
    kept = {r["zone"]: r for r in spark.read.parquet(f"{scratch}/s").collect()}
    assert set(kept) == {"ok", "null"} and kept["null"]["telemetry_event_count"] == 0
    assert str(kept["ok"]["observed_earnings"]) == "2.35" and str(kept["ok"]["average_speed"]) == "0.00"
    assert {r["zone"] for r in spark.read.parquet(f"{scratch}/rejects").collect()} == {"huge", "nan", None}


def test_alert_log_across_runs(spark, scratch):
    from odometer.plans.jobs import record_health_alerts

    metrics, alerts = f"{scratch}/metrics", f"{scratch}/alerts"
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    persist_metrics_batch(_metrics(spark, [(t0, "a", 1)]), 0, metrics, processed_at=t0 + dt.timedelta(minutes=5))
    persist_metrics_batch(_metrics(spark, [(t0, "a", 2)]), 1, metrics, processed_at=t0 + dt.timedelta(minutes=6))

    def run(minutes):
        return record_health_alerts(spark, metrics, alerts, _check_times(spark, t0, minutes))

    assert run([]).count() == 0  # a run without checks doesn't end the log
    first = run([0, 2, 6, 7, 20])
    assert [r["status"] for r in first.orderBy("created_at").collect()] == ["degraded", "healthy", "unhealthy"]
    contexts = [json.loads(r["context"]) for r in first.orderBy("created_at").collect()]
    assert [c["metric_rows"] for c in contexts] == [0, 1, 1] and contexts[1]["no_data_alert_seconds"] == 120
    assert contexts[1]["last_processed_at"] == "2024-01-01T00:06:00.000000+00:00" and contexts[0]["profitability_rows"] is None
    assert run([30, 40]).count() == 0  # still unhealthy: nothing new to record
    assert run([0, 2, 6, 7, 20]).count() == 0  # covered already
    # the window is written again: no check of the past is judged anew
    persist_metrics_batch(_metrics(spark, [(t0, "a", 3)]), 2, metrics, processed_at=t0 + dt.timedelta(minutes=41))
    assert run([0, 2, 6, 7, 20, 30, 40]).count() == 0
    assert [r["status"] for r in run([42]).collect()] == ["healthy"]
    assert spark.read.parquet(alerts).count() == 4


def test_a_window_written_again_adds_no_alert(spark, scratch):
    from odometer.plans.jobs import record_health_alerts

    metrics, alerts = f"{scratch}/metrics", f"{scratch}/alerts"
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    persist_metrics_batch(_metrics(spark, [(t0, "a", 1)]), 0, metrics, processed_at=t0 + dt.timedelta(seconds=30))
    checks = _check_times(spark, t0, [1, 2])
    assert [r["status"] for r in record_health_alerts(spark, metrics, alerts, checks).collect()] == ["healthy"]
    persist_metrics_batch(_metrics(spark, [(t0, "a", 2)]), 1, metrics, processed_at=t0 + dt.timedelta(minutes=30))
    assert record_health_alerts(spark, metrics, alerts, checks).count() == 0
    assert spark.read.parquet(alerts).count() == 1


def _files_read(df, folder):
    """Files of ``folder`` that the scans of a finished plan opened."""
    df.collect()

    def walk(node):
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        own = 0
        if node.nodeName().startswith("Scan parquet") and folder in str(node.metadata().apply("Location")):
            own = node.metrics().apply("numFiles").value()
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_only_the_batchs_dates_are_read(spark, scratch):
    from odometer.sinks.merge import only_dates_of

    days = spark.range(10).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"), "id")
    days.repartition(1).write.partitionBy("day").parquet(f"{scratch}/lake")
    days.where("id = 4").write.parquet(f"{scratch}/batch")  # a batch that comes from files
    days.where("id in (4, 6)").write.parquet(f"{scratch}/two")
    lake = spark.read.parquet(f"{scratch}/lake")
    one = only_dates_of(lake, spark.read.parquet(f"{scratch}/batch"), "day")
    assert _files_read(one, f"{scratch}/lake") == 1 and [r["id"] for r in one.collect()] == [4]
    two = only_dates_of(lake, spark.read.parquet(f"{scratch}/two"), "day")
    assert _files_read(two, f"{scratch}/lake") <= 3 and sorted(r["id"] for r in two.collect()) == [4, 6]


def test_a_day_in_two_files_over_two_batches_is_whole(spark, scratch):
    from odometer.plans.jobs import start_reconciliation_stream

    src = f"{scratch}/source"
    os.makedirs(src)
    with open(f"{src}/p.json", "w") as fh:
        fh.write("\n".join(_line(f"V{i}", f"T{i}", 26, i, 10.0 * i) for i in range(1, 5)) + "\n")
    run_live(spark, spark.readStream.format("text").load(src), f"{scratch}/lake", f"{scratch}/m", f"{scratch}/ckpt",
             available_now=True)
    day = f"{scratch}/feeds/feed_file=vehicle_expenses_2026-09-26.csv"
    os.makedirs(day)
    for part, vehicles in enumerate([("V1", "V2"), ("V3", "V4")]):
        with open(f"{day}/part-{part}.csv", "w") as fh:
            fh.write("report_date,vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\n")
            fh.writelines(f"2026-09-26,{v},1.0,0.0,5.0,required\n" for v in vehicles)
    q = start_reconciliation_stream(spark, f"{scratch}/feeds", f"{scratch}/lake", f"{scratch}/out", f"{scratch}/csv",
                                    f"{scratch}/rckpt", serving_path=f"{scratch}/serving", available_now=True,
                                    max_files_per_trigger=1, exact_money=True)
    q.awaitTermination()
    assert q.exception() is None
    for path in ("out", "serving"):
        got = {r["vehicle_id"]: float(r["trip_revenue"]) for r in spark.read.parquet(f"{scratch}/{path}").collect()}
        assert got == {"V1": 10.0, "V2": 20.0, "V3": 30.0, "V4": 40.0}
    header = open(glob.glob(f"{scratch}/csv/csv_date=2026-09-26/*.csv")[0]).readline().strip().split(",")
    assert len(header) == 12 and header[0] == "report_date"


def test_reconcile_checks_serving_constraints_before_writing(spark, scratch):
    import pytest

    src = f"{scratch}/source"
    os.makedirs(src)
    with open(f"{src}/p.json", "w") as fh:
        fh.write(_line("V1", "T1", 26, 1, 100.0) + "\n")
    lake = f"{scratch}/lake"
    run_live(spark, spark.readStream.format("text").load(src), lake, f"{scratch}/m", f"{scratch}/ckpt",
             available_now=True)
    feed = spark.createDataFrame(
        [(dt.date(2026, 9, 26), "V1", 10.0, 5.0, 20.0, "required"),
         (dt.date(2026, 9, 26), "V2", None, 5.0, 20.0, "required")],
        "report_date date, vehicle_id string, fuel_cost double, maintenance_cost double, "
        "distance_covered double, service_flag string",
    )
    feeds = f"{scratch}/feeds"
    write_expense_feed(feed, feeds)
    with pytest.raises(ValueError):
        reconcile(spark, feeds, lake, f"{scratch}/out", f"{scratch}/csv", f"{scratch}/serving")
    assert not os.path.exists(f"{scratch}/out")
    reconcile(spark, feeds, lake, f"{scratch}/out", f"{scratch}/csv", f"{scratch}/serving",
              reject_path=f"{scratch}/rejects")
    assert spark.read.parquet(f"{scratch}/out").count() == 2
    assert [r["vehicle_id"] for r in spark.read.parquet(f"{scratch}/serving").collect()] == ["V1"]
    assert [r["vehicle_id"] for r in spark.read.parquet(f"{scratch}/rejects").collect()] == ["V2"]


def test_checkpoint_dir_set_on_a_running_session_is_used(spark, scratch):
    from odometer.session import shared_dir

    assert shared_dir(spark)  # configured by spark-defaults or the test fixture
    sc = spark.sparkContext
    assert sc.getCheckpointDir()


def test_reconciliation_stream_consumes_each_feed_once(spark, scratch):
    from odometer.plans.jobs import start_reconciliation_stream

    src = f"{scratch}/source"
    os.makedirs(src)
    with open(f"{src}/p.json", "w") as fh:
        fh.write("\n".join([_line("V1", "T1", 26, 1, 100.0), _line("V1", "T2", 27, 1, 40.0)]) + "\n")
    lake = f"{scratch}/lake"
    run_live(spark, spark.readStream.format("text").load(src), lake, f"{scratch}/m", f"{scratch}/ckpt",
             available_now=True)
    schema = ("report_date date, vehicle_id string, fuel_cost double, maintenance_cost double, "
              "distance_covered double, service_flag string")
    feeds, out, csv, serving = f"{scratch}/feeds", f"{scratch}/out", f"{scratch}/csv", f"{scratch}/serving"
    os.makedirs(feeds)

    def run():
        q = start_reconciliation_stream(spark, feeds, lake, out, csv, f"{scratch}/rckpt", serving_path=serving,
                                        available_now=True)
        q.awaitTermination()
        assert q.exception() is None

    write_expense_feed(spark.createDataFrame([(dt.date(2026, 9, 26), "V1", 10.0, 0.0, 1.0, "required")], schema), feeds)
    run()
    got = {(r["report_date"], r["vehicle_id"]): r["trip_revenue"] for r in spark.read.parquet(out).collect()}
    assert got == {(dt.date(2026, 9, 26), "V1"): 100.0}
    write_expense_feed(spark.createDataFrame([(dt.date(2026, 9, 27), "V1", 10.0, 0.0, 1.0, "required")], schema), feeds)
    run()
    run()  # nothing new: no change
    got = {(r["report_date"], r["vehicle_id"]): r["trip_revenue"] for r in spark.read.parquet(out).collect()}
    assert got == {(dt.date(2026, 9, 26), "V1"): 100.0, (dt.date(2026, 9, 27), "V1"): 40.0}
    assert spark.read.parquet(serving).count() == 2


def test_generic_stream_reader_gauge_text_and_day_read(spark, scratch):
    from odometer.operators.health import exposition_text, gauges, health_snapshot
    from odometer.operators.profitability import report_for_day
    from odometer.sinks.files import write_gauges_text
    from odometer.sources.telemetry import read_telemetry_stream

    src = f"{scratch}/src"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as fh:
        fh.write(_line("V1", "T1", 26, 1, 100.0) + "\n")
    stream = read_telemetry_stream(spark, "text", path=src, options={"maxFilesPerTrigger": "1"})
    assert stream.isStreaming and stream.columns == ["value"]

    serving = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "processed_at timestamp_ntz")
    snap = health_snapshot(serving, spark.range(3))
    write_gauges_text(exposition_text(gauges(snap, dt.datetime(2024, 1, 1, 0, 0, 30), 60)), f"{scratch}/gauges")
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{scratch}/gauges/part-*")))
    assert "fleet_last_telemetry_age_seconds 30\n" in text and "fleet_serving_metric_rows 1\n" in text

    report = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "V2", 5.0), (dt.date(2024, 1, 1), "V1", -5.0), (dt.date(2024, 1, 2), "V3", 0.0)],
        "report_date date, vehicle_id string, profit double",
    )
    assert [r["vehicle_id"] for r in report_for_day(report, "2024-01-01").collect()] == ["V1", "V2"]


def test_serving_sql_runs_on_views(spark, scratch):
    from odometer.operators.serving import latest_window
    from odometer.plans.catalog import register_serving_views

    t0 = dt.datetime(2024, 1, 1, 0, 0)
    rows = [(t0 + dt.timedelta(minutes=5 * w), z, w + 1, t0 + dt.timedelta(minutes=5 * w + 5))
            for w in range(3) for z in ("colombo_north_east", "outside_service_area")]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, zone string, telemetry_event_count long, "
                                     "processed_at timestamp_ntz")
    for c in ("window_start", "processed_at"):
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    df = (df.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES"))
          .withColumn("idle_event_count", F.lit(0).cast("long")).withColumn("on_trip_event_count", F.lit(0).cast("long"))
          .withColumn("active_event_count", F.col("telemetry_event_count"))
          .withColumn("observed_earnings", F.lit(12.345)).withColumn("average_speed", F.lit(None).cast("double"))
          .withColumn("idle_ratio", F.lit(0.0)).withColumn("spark_batch_id", F.lit(1).cast("long")))
    path = f"{scratch}/serving"
    df.withColumn("window_date", F.to_date("window_start")).write.partitionBy("window_date").parquet(path)
    assert register_serving_views(spark, utilization_path=path) == ["fleet_utilization_metrics"]
    got = spark.sql("""
        WITH newest AS (SELECT MAX(window_end) AS window_end FROM fleet_utilization_metrics)
        SELECT zone, telemetry_event_count, observed_earnings
        FROM fleet_utilization_metrics
        WHERE window_end = (SELECT window_end FROM newest)
        ORDER BY zone
    """).collect()
    assert [(r["zone"], r["telemetry_event_count"]) for r in got] == [
        ("colombo_north_east", 3), ("outside_service_area", 3)]
    assert str(got[0]["observed_earnings"]) == "12.35"  # NUMERIC(14,2), HALF_UP
    want = latest_window(spark.read.parquet(path)).collect()
    assert [r["zone"] for r in want] == [r["zone"] for r in got]
