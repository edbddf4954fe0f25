import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from odometer.operators.serving import (
    conform_report,
    conform_utilization,
    latest_per_key,
    latest_window,
    report_violations,
    upsert_profitability,
    upsert_utilization,
    utilization_violations,
)
from odometer.schemas import REPORT_COLUMNS

W0 = dt.datetime(2024, 1, 1, 0, 0)
W1 = dt.datetime(2024, 1, 1, 0, 5)
T = dt.datetime(2024, 1, 1, 0, 10)

UTIL_SCHEMA = (
    "window_start timestamp_ntz, window_end timestamp_ntz, zone string, telemetry_event_count long, "
    "idle_event_count long, on_trip_event_count long, active_event_count long, observed_earnings double, "
    "average_speed double, idle_ratio double, spark_batch_id long, processed_at timestamp_ntz"
)


def _util(spark, rows):
    df = spark.createDataFrame(rows, UTIL_SCHEMA)
    for c in ("window_start", "window_end", "processed_at"):
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def row(zone, n, batch, processed_at, earnings=1.0, speed=10.0, start=W0, end=W1):
    return (start, end, zone, n, 0, n, n, earnings, speed, 0.0, batch, processed_at)


def test_guarded_upsert(spark):
    target = _util(spark, [row("a", 1, 0, T), row("b", 1, 0, T), row("c", 1, 0, T), row("d", 1, 0, T)])
    incoming = _util(
        spark,
        [
            row("a", 2, 1, T - dt.timedelta(seconds=1)),  # older -> keep stored
            row("b", 3, 1, T),  # equal -> replace
            row("c", 4, 1, T + dt.timedelta(seconds=1)),  # newer -> replace
            row("e", 5, 1, T),  # new key -> insert
        ],
    )
    got = {r["zone"]: r["telemetry_event_count"] for r in upsert_utilization(target, incoming).collect()}
    assert got == {"a": 1, "b": 3, "c": 4, "d": 1, "e": 5}


def test_guarded_upsert_is_idempotent(spark):
    target = _util(spark, [row("a", 1, 0, T)])
    incoming = _util(spark, [row("a", 2, 1, T + dt.timedelta(seconds=1)), row("b", 1, 1, T)])
    once = upsert_utilization(target, incoming)
    twice = upsert_utilization(once, incoming)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_latest_per_key(spark):
    hist = _util(
        spark,
        [row("a", 1, 0, T), row("a", 2, 1, T + dt.timedelta(seconds=5)), row("a", 3, 2, T + dt.timedelta(seconds=5))],
    )
    (r,) = latest_per_key(hist).collect()
    assert (r["telemetry_event_count"], r["spark_batch_id"]) == (3, 2)


def _report(spark, rows, updated_at):
    df = spark.createDataFrame(
        rows,
        "report_date date, vehicle_id string, completed_trip_count long, trip_revenue double, fuel_cost double, "
        "maintenance_cost double, total_expense double, distance_covered double, service_flag string, "
        "profit double, profit_margin_pct double, profitability_status string",
    )
    return df.withColumn("updated_at", F.lit(updated_at).cast("timestamp"))


def rrow(v, profit, d=dt.date(2024, 1, 15)):
    return (d, v, 1, 10.0, 1.0, 1.0, 2.0, 5.0, "not_required", profit, None, "profitable")


def test_unguarded_upsert_keeps_absent_vehicles(spark):
    target = _report(spark, [rrow("V1", 1.0), rrow("V2", 2.0)], dt.datetime(2024, 2, 1))
    incoming = _report(spark, [rrow("V2", 20.0), rrow("V3", 30.0)], dt.datetime(2024, 2, 2)).drop("updated_at")
    merged = {r["vehicle_id"]: r for r in upsert_profitability(target, incoming, dt.datetime(2024, 2, 2)).collect()}
    assert set(merged) == {"V1", "V2", "V3"}
    assert merged["V1"]["profit"] == 1.0 and merged["V1"]["updated_at"] == dt.datetime(2024, 2, 1)
    assert merged["V2"]["profit"] == 20.0 and merged["V2"]["updated_at"] == dt.datetime(2024, 2, 2)


def test_conform_and_violations(spark):
    df = _util(spark, [row("a", 1, 0, T, earnings=1.005, speed=None), row("a", 2, 0, T, earnings=None)])
    c = conform_utilization(df)
    types = dict(c.dtypes)
    assert types["observed_earnings"] == "decimal(14,2)" and types["idle_ratio"] == "decimal(7,4)"
    assert types["telemetry_event_count"] == "int"
    vals = sorted((r["telemetry_event_count"], r["observed_earnings"], r["average_speed"]) for r in c.collect())
    assert vals == [(1, decimal.Decimal("1.01"), decimal.Decimal("0.00")), (2, decimal.Decimal("0.00"), decimal.Decimal("10.00"))]
    v = utilization_violations(df).first()
    assert v["rows"] == 2 and v["duplicate_key_rows"] == 2 and v["null_observed_earnings"] == 1
    rep = _report(spark, [rrow("V1", None), rrow("V2", 2.0)], dt.datetime(2024, 2, 1))
    rv = report_violations(rep).first()
    assert rv["null_profit"] == 1 and rv["duplicate_key_rows"] == 0
    assert dict(conform_report(rep).dtypes)["profit_margin_pct"] == "decimal(8,2)"
    assert conform_report(rep).columns == list(REPORT_COLUMNS) + ["updated_at"]


def test_latest_window_and_zone_argument(spark):
    hist = _util(
        spark,
        [row("colombo_a", 1, 0, T), row("colombo_b", 2, 0, T, start=W1, end=W1 + dt.timedelta(minutes=5)),
         row("outside_service_area", 3, 0, T, start=W1, end=W1 + dt.timedelta(minutes=5))],
    )
    rows = latest_window(hist).collect()
    assert [r["zone"] for r in rows] == ["colombo_b", "outside_service_area"]
    assert {r["metric_window_count"] for r in rows} == {2}
    assert "spark_batch_id" not in latest_window(hist).columns
    only = latest_window(hist, zone="outside_service_area").collect()
    assert [r["telemetry_event_count"] for r in only] == [3]
    # the zone filter does not change which window is newest
    assert latest_window(hist, zone="colombo_a").collect() == []
    closed = latest_window(hist, closed_before=W1).collect()
    assert [r["zone"] for r in closed] == ["colombo_a"]
    with pytest.raises(ValueError):
        latest_window(hist, zone="x' OR 1=1 --")


def test_latest_window_on_a_date_partitioned_table_reads_one_day(spark, scratch):
    import contextlib
    import io

    day2 = dt.datetime(2024, 1, 2, 0, 0)
    hist = _util(
        spark,
        [row("colombo_a", 1, 0, T), row("colombo_b", 2, 0, T, start=day2, end=day2 + dt.timedelta(minutes=5)),
         row("outside_service_area", 3, 0, T, start=day2, end=day2 + dt.timedelta(minutes=5))],
    )
    path = f"{scratch}/serving"
    hist.withColumn("window_date", F.to_date("window_start")).write.partitionBy("window_date").parquet(path)
    stored = spark.read.parquet(path)
    got = latest_window(stored)
    assert [r["zone"] for r in got.collect()] == [r["zone"] for r in latest_window(hist).collect()]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain("formatted")
    assert any(ln.startswith("PartitionFilters") and "Subquery" in ln for ln in buf.getvalue().splitlines())
