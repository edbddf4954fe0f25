"""Folding the metrics history reads what is new, retires it, and survives
failures between its steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from odometer import hadoop
from odometer.operators.serving import latest_per_key
from odometer.plans import jobs
from odometer.plans.jobs import compact_metrics, read_history
from odometer.sinks.versions import utilization_table
from odometer.streaming import queries
from odometer.streaming.queries import persist_metrics_batch

T0 = dt.datetime(2024, 1, 1, 0, 0)


def add(spark, metrics, batch, rows, huge=False):
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, zone string, telemetry_event_count long")
    df = df.withColumn("window_start", F.col("window_start").cast("timestamp"))
    df = df.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES"))
    counts = {c: F.lit(0).cast("long") for c in ("idle_event_count", "on_trip_event_count", "active_event_count")}
    df = df.withColumns(counts | {c: F.lit(1.0) for c in ("observed_earnings", "average_speed", "idle_ratio")})
    if huge:
        df = df.withColumn("observed_earnings", F.lit(1e30))
    persist_metrics_batch(df, batch, metrics, processed_at=T0 + dt.timedelta(minutes=5 + batch))


def served(spark, table):
    return {(r["window_start"].day, r["zone"]): r["telemetry_event_count"] for r in table.read(spark).collect()}


def read_files(monkeypatch):
    """Records the files of every frame that is served."""
    seen = []
    serve = jobs.serve_utilization
    monkeypatch.setattr(jobs, "serve_utilization", lambda spark, path, rows, *more: (seen.append(rows.inputFiles()), serve(spark, path, rows, *more)))
    return seen


def test_a_fold_reads_one_batch_of_ten(spark, scratch, monkeypatch):
    metrics, table = f"{scratch}/metrics", utilization_table(f"{scratch}/serving")
    for batch in range(9):
        add(spark, metrics, batch, [(T0 + dt.timedelta(days=batch % 2), "a", batch)])
    assert compact_metrics(spark, metrics, table) == 9
    add(spark, metrics, 9, [(T0, "b", 9)])
    files = read_files(monkeypatch)
    assert compact_metrics(spark, metrics, table) == 1
    ((only,),) = files
    assert "spark_batch_id=9" in only
    assert served(spark, table) == {(1, "a"): 8, (2, "a"): 7, (1, "b"): 9}
    assert compact_metrics(spark, metrics, table) == 0 and len(files) == 1


def test_folded_batches_retire(spark, scratch):
    metrics, archive, table = f"{scratch}/metrics", f"{scratch}/archive", utilization_table(f"{scratch}/serving")
    for batch in range(3):
        add(spark, metrics, batch, [(T0, "a", batch), (T0 + dt.timedelta(days=1), "b", batch)])
    whole = sorted(map(str, spark.read.parquet(metrics).select("zone", "spark_batch_id", "window_date", "stream_run").collect()))
    assert compact_metrics(spark, metrics, table, archive_path=archive) == 3
    assert hadoop.matches(spark, f"{metrics}/*/*/spark_batch_id=*") == []
    add(spark, metrics, 3, [(T0, "a", 3)])
    history = read_history(spark, metrics, archive)
    assert history.count() == 7 and latest_per_key(history).count() == 2
    assert sorted(map(str, history.where("spark_batch_id < 3").select("zone", "spark_batch_id", "window_date", "stream_run").collect())) == whole
    assert compact_metrics(spark, metrics, table, archive_path=archive) == 1
    assert read_history(spark, metrics, archive).count() == 7
    assert served(spark, table) == {(1, "a"): 3, (2, "b"): 2}


@pytest.mark.parametrize("step", ["serve_utilization", "claim", "_retire"])
def test_a_fold_that_fails_is_finished_once(spark, scratch, monkeypatch, step):
    metrics, archive, table = f"{scratch}/metrics", f"{scratch}/archive", utilization_table(f"{scratch}/serving")
    for batch in range(2):
        add(spark, metrics, batch, [(T0, "a", batch)])

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(hadoop if step == "claim" else jobs, step, lost)
        with pytest.raises(KeyboardInterrupt):
            compact_metrics(spark, metrics, table, archive_path=archive)
    add(spark, metrics, 2, [(T0, "a", 2)])  # comes while the fold lies broken
    while compact_metrics(spark, metrics, table, archive_path=archive):
        pass
    history = read_history(spark, metrics, archive)
    assert sorted(r[0] for r in history.select("spark_batch_id").collect()) == [0, 1, 2]
    assert served(spark, table) == {(1, "a"): 2}
    assert hadoop.matches(spark, f"{metrics}/*/*/spark_batch_id=*") == []


def test_rejects_of_the_live_run_outlive_a_fold(spark, scratch, monkeypatch):
    metrics, rejects, table = f"{scratch}/metrics", f"{scratch}/rejects", utilization_table(f"{scratch}/serving")
    monkeypatch.setattr(queries, "run_of", lambda batch: "run1")
    add(spark, metrics, 0, [(T0, "a", 1)])
    add(spark, metrics, 1, [(T0, "b", 1)], huge=True)
    from odometer.sinks.merge import serve_utilization

    live = spark.read.parquet(metrics).where("spark_batch_id = 1").drop("window_date")
    serve_utilization(spark, table, live, rejects, "live")
    assert compact_metrics(spark, metrics, table, reject_path=rejects) == 2
    kept = sorted((r["reject_step"], r["stream_run"], r["spark_batch_id"], r["zone"]) for r in spark.read.parquet(rejects).collect())
    assert kept == [("fold", "run1", 1, "b"), ("live", "run1", 1, "b")]


def checks(spark, minutes):
    df = spark.createDataFrame([(T0 + dt.timedelta(minutes=m),) for m in minutes], "check_time timestamp_ntz")
    return df.withColumn("check_time", F.col("check_time").cast("timestamp"))


@pytest.mark.parametrize("retire", [False, True])
def test_alerts_in_steps_equal_one_run_over_all(spark, scratch, retire):
    """Batches at uneven times, some stamped after the checks that are due;
    state comes from the mark, not from reading the past again."""
    from odometer.operators.health import health_transitions
    from odometer.plans.jobs import record_health_alerts

    metrics, alerts, whole = f"{scratch}/metrics", f"{scratch}/alerts", f"{scratch}/whole"
    archive = f"{scratch}/archive" if retire else None
    table = utilization_table(f"{scratch}/serving")
    steps = [([0], [1, 6]), ([3, 4], [7]), ([], [20, 21]), ([18, 40], [24, 30]), ([41], [46, 47, 60]), ([], [70])]
    batch = 0
    for stamps, due in steps:
        for minute in stamps:
            for path in (metrics, whole):
                # a known window again, a new one, and on another day
                day = dt.timedelta(days=batch % 2)
                rows = [(T0 + day, "a", batch), (T0 + day, f"z{batch}", 1)]
                df = spark.createDataFrame(rows, "window_start timestamp_ntz, zone string, telemetry_event_count long")
                df = df.withColumn("window_start", F.col("window_start").cast("timestamp"))
                df = df.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES"))
                counts = {c: F.lit(0).cast("long") for c in ("idle_event_count", "on_trip_event_count", "active_event_count")}
                df = df.withColumns(counts | {c: F.lit(1.0) for c in ("observed_earnings", "average_speed", "idle_ratio")})
                persist_metrics_batch(df, batch, path, processed_at=T0 + dt.timedelta(minutes=5 + minute))
            batch += 1
        record_health_alerts(spark, metrics, alerts, checks(spark, due), archive_path=archive)
        if retire:
            compact_metrics(spark, metrics, table, archive_path=archive)
    every = checks(spark, [m for _, due in steps for m in due])
    columns = ["created_at", "status", "severity", "message", "context"]
    want = health_transitions(every, spark.read.parquet(whole), 120).select(*columns).orderBy("created_at").collect()
    got = spark.read.parquet(alerts).select(*columns).orderBy("created_at").collect()
    assert len(want) > 4 and got == want


def test_alerts_read_the_days_with_news(spark, scratch, monkeypatch):
    from odometer.plans.jobs import record_health_alerts

    metrics, alerts = f"{scratch}/metrics", f"{scratch}/alerts"
    for batch in range(10):
        add(spark, metrics, batch, [(T0 + dt.timedelta(days=batch), "a", batch)])
    record_health_alerts(spark, metrics, alerts, checks(spark, [20]))
    add(spark, metrics, 20, [(T0 + dt.timedelta(days=3), "b", 1)])
    files = []
    unseen = jobs._unseen_stamps
    monkeypatch.setattr(jobs, "_unseen_stamps", lambda *a: (files.append(unseen(*a)), files[-1])[1])
    monkeypatch.setattr(jobs, "materialize", lambda df: (files.append(df.inputFiles()), df)[1])
    found = record_health_alerts(spark, metrics, alerts, checks(spark, [26])).collect()
    read = {f for x in files if isinstance(x, list) for f in x if f.startswith("file") and "/metrics/" in f}
    assert len(read) == 2 and all("window_date=2024-01-04" in f for f in read)
    assert [r["status"] for r in found] == ["healthy"]
