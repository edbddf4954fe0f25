import datetime as dt
import random

from pyspark.sql import functions as F

from odometer.operators.utilization import sliding_metrics


def _events(spark, n=400, seed=3):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1, 10, 0)
    rows = []
    for _ in range(n):
        t = base + dt.timedelta(seconds=rng.randrange(0, 3600))
        rows.append(
            (
                f"V{rng.randrange(6)}" if rng.random() > 0.05 else None,
                f"T{rng.randrange(4)}",
                rng.choice(["idle", "enroute", "on_trip", "offline"]),
                float(rng.randrange(0, 5000)) / 100,
                rng.randrange(0, 90) if rng.random() > 0.05 else None,
                t if rng.random() > 0.02 else None,
            )
        )
    df = spark.createDataFrame(rows, "vehicle_id string, trip_id string, status string, fare double, speed int, t timestamp_ntz")
    return df.withColumn("event_time", F.col("t").cast("timestamp")).drop("t")


def _direct(df, approximate):
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return (
        df.groupBy(F.window("event_time", "5 minutes", "1 minute").alias("w"))
        .agg(
            distinct("vehicle_id").alias("active_vehicles"),
            F.count(F.when(F.col("status") == "idle", True)).alias("idle_events"),
            F.count(F.lit(1)).alias("total_events"),
            distinct("trip_id").alias("trips"),
            F.sum(F.col("fare").cast("decimal(18,2)")).cast("double").alias("total_earnings"),
            F.avg("speed").alias("average_speed"),
        )
        .select(F.col("w.start").alias("window_start"), "*")
        .drop("w")
    )


def test_pane_plan_equals_spark_sliding_window(spark):
    df = _events(spark)
    for approximate in (False, True):
        got = {r["window_start"]: r for r in sliding_metrics(df, approximate=approximate, exact_money=True).collect()}
        want = {r["window_start"]: r for r in _direct(df, approximate).collect()}
        assert got.keys() == want.keys()
        for k, w in want.items():
            g = got[k]
            for c in ("active_vehicles", "idle_events", "total_events", "trips", "total_earnings", "average_speed"):
                assert g[c] == w[c], (k, c, g[c], w[c])
            assert g["window_end"] - g["window_start"] == dt.timedelta(minutes=5)
            assert g["idle_ratio"] == g["idle_events"] / g["total_events"]


def test_every_event_lands_in_five_windows(spark):
    df = _events(spark, n=50, seed=9)
    total = sliding_metrics(df).agg(F.sum("total_events")).first()[0]
    assert total == 5 * df.where(F.col("event_time").isNotNull()).count()


def test_sketched_panes_match_exact_counts(spark):
    from odometer.operators.utilization import sliding_metrics_sketched

    df = _events(spark, n=300, seed=21)
    exact = {r["window_start"]: r for r in sliding_metrics(df, exact_money=True).collect()}
    sketched = {r["window_start"]: r for r in sliding_metrics_sketched(df, exact_money=True).collect()}
    assert exact.keys() == sketched.keys()
    for k, e in exact.items():
        s = sketched[k]
        for c in ("idle_events", "total_events", "total_earnings", "average_speed", "idle_ratio", "window_end"):
            assert s[c] == e[c], (k, c)
        # small cardinalities: the sketch is exact (coupon mode)
        assert s["active_vehicles"] == e["active_vehicles"] and s["trips"] == e["trips"]


def test_sketched_panes_run_as_a_chained_stream(spark, scratch):
    import json
    import os

    from odometer.operators.utilization import sliding_metrics_sketched
    from odometer.sources.telemetry import decode_telemetry

    src = f"{scratch}/src"
    os.makedirs(src)
    lines = [
        json.dumps({"trip_id": f"T{m % 2}", "driver_id": "D1", "vehicle_id": f"V{m % 3}", "lat": 6.9, "lon": 79.9,
                    "speed": 10 + m, "status": "idle" if m % 4 == 0 else "on_trip", "fare": float(m),
                    "timestamp": f"2026-09-27T12:{m:02d}:30+00:00"})
        for m in range(0, 20)
    ]
    with open(f"{src}/a.json", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    parsed = decode_telemetry(spark.readStream.format("text").load(src)).withColumn(
        "event_time", F.col("timestamp").try_cast("timestamp"))
    out = []
    q = (
        sliding_metrics_sketched(parsed, watermark="2 minutes")
        .writeStream.outputMode("append")
        .option("checkpointLocation", f"{scratch}/ckpt")
        .trigger(availableNow=True)
        .foreachBatch(lambda d, i: out.extend(d.collect()))
        .start()
    )
    q.awaitTermination()
    assert q.exception() is None
    batch = decode_telemetry(spark.read.text(src)).withColumn("event_time", F.col("timestamp").try_cast("timestamp"))
    want = {r["window_start"]: r for r in sliding_metrics(batch).collect()}
    assert out  # windows closed by the watermark were emitted once each
    assert len({r["window_start"] for r in out}) == len(out)
    for r in out:
        w = want[r["window_start"]]
        assert (r["total_events"], r["idle_events"], r["active_vehicles"], r["trips"]) == (
            w["total_events"], w["idle_events"], w["active_vehicles"], w["trips"])


def test_approximate_distincts_stay_within_hll_error(spark):
    from odometer.plans.contract import QUERIES

    rows = QUERIES["sliding_metrics_approx"](spark, "/root/testdata/sf0.01").select("vehicles_near", "trips_near").collect()
    assert rows and all(r["vehicles_near"] and r["trips_near"] for r in rows)


def test_runs_merge_exactly_at_the_window_length(spark):
    # one vehicle active at panes separated by gaps of 1..7 minutes (window = 5 panes)
    base = dt.datetime(2024, 1, 1, 8, 0)
    minutes, m = [], 0
    for gap in (1, 2, 3, 4, 5, 6, 7, 5, 4, 6):
        m += gap
        minutes.append(m)
    rows = [("V1", "T1", "on_trip", 1.0, 10, base + dt.timedelta(minutes=x, seconds=30)) for x in minutes]
    rows += [("V2", "T2", "idle", 0.0, 0, base + dt.timedelta(minutes=x, seconds=10)) for x in minutes[::3]]
    df = spark.createDataFrame(rows, "vehicle_id string, trip_id string, status string, fare double, speed int, t timestamp_ntz")
    df = df.withColumn("event_time", F.col("t").cast("timestamp")).drop("t")
    got = {r["window_start"]: (r["active_vehicles"], r["trips"]) for r in sliding_metrics(df).collect()}
    want = {r["window_start"]: (r["active_vehicles"], r["trips"]) for r in _direct(df, False).collect()}
    assert got == want


def test_both_distinct_plans_agree(spark):
    df = _events(spark, n=500, seed=31)
    runs = {r["window_start"]: tuple(r) for r in sliding_metrics(df, exact_money=True).collect()}
    fan = {r["window_start"]: tuple(r) for r in sliding_metrics(df, exact_money=True, distinct_plan="fanout").collect()}
    assert runs == fan
