import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from odometer.sinks.files import write_expense_feed, write_report_csv, write_report_parquet
from odometer.sources.expenses import read_expense_feed
from odometer.sources.lake import read_clean_lake


def _feed(spark, day, n=3, maint=1.0):
    rows = [(day, f"V{i}", 10.0 + i, maint, 20.0, "required" if i == 0 else "not_required") for i in range(n)]
    return spark.createDataFrame(
        rows,
        "report_date date, vehicle_id string, fuel_cost double, maintenance_cost double, "
        "distance_covered double, service_flag string",
    )


def test_feed_publication_guard_and_scan(spark, scratch):
    d1, d2 = dt.date(2026, 9, 26), dt.date(2026, 9, 27)
    path = f"{scratch}/feed"
    write_expense_feed(_feed(spark, d1), path)
    write_expense_feed(_feed(spark, d2), path)  # a new date is fine
    with pytest.raises(FileExistsError):
        write_expense_feed(_feed(spark, d1), path)
    write_expense_feed(_feed(spark, d1, maint=7.0), path, overwrite=True)
    names = sorted(os.path.basename(p) for p in glob.glob(f"{path}/feed_file=*"))
    assert names == ["feed_file=vehicle_expenses_2026-09-26.csv", "feed_file=vehicle_expenses_2026-09-27.csv"]
    part = glob.glob(f"{path}/feed_file=vehicle_expenses_2026-09-26.csv/*.csv")[0]
    with open(part) as fh:
        assert fh.readline().strip() == "report_date,vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag"
    rows = read_expense_feed(spark, path).collect()
    assert len(rows) == 6
    assert {r["maintenance_cost"] for r in rows if r["report_date"] == d1} == {7.0}
    assert {r["report_date"] for r in rows} == {d1, d2}
    single = read_expense_feed(spark, path, report_date="2030-01-01").collect()
    assert {r["report_date"] for r in single} == {dt.date(2030, 1, 1)}


def test_bad_amount_text_becomes_null(spark, scratch):
    path = f"{scratch}/vehicle_expenses_2026-09-26.csv"
    with open(path, "w") as fh:
        fh.write("report_date,vehicle_id,fuel_cost,maintenance_cost,distance_covered,service_flag\n")
        fh.write("2026-09-26,V1,abc,,12.5,required\n")
        fh.write("2026-09-26,,1,1,1,required\n")
    rows = read_expense_feed(spark, path).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["fuel_cost"] is None and r["maintenance_cost"] is None and r["distance_covered"] == 12.5
    assert r["report_date"] == dt.date(2026, 9, 26)


def _report(spark, day, vehicles, profit_base=0.0):
    rows = [(day, v, float(i) + profit_base) for i, v in enumerate(vehicles)]
    return spark.createDataFrame(rows, "report_date date, vehicle_id string, profit double")


def test_report_partition_overwrite_keeps_other_dates(spark, scratch):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    path = f"{scratch}/reports"
    write_report_parquet(_report(spark, d1, ["V1", "V2"]).unionByName(_report(spark, d2, ["V1"])), path)
    write_report_parquet(_report(spark, d1, ["V3"]), path)
    rows = spark.read.parquet(path).collect()
    assert sorted((r["report_date"], r["vehicle_id"]) for r in rows) == [(d1, "V3"), (d2, "V1")]


def test_report_csv_sorted_per_date(spark, scratch):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    path = f"{scratch}/csv"
    report = _report(spark, d1, ["V5", "V4", "V3"], -5.0).unionByName(_report(spark, d2, ["V1", "V2"]))
    write_report_csv(report.repartition(3), path)
    for day, expected in ((d1, ["V5", "V4", "V3"]), (d2, ["V1", "V2"])):
        files = sorted(glob.glob(f"{path}/csv_date={day}/*.csv"))
        assert files
        ids = []
        for name in files:  # name order is report order
            with open(name) as fh:
                lines = fh.read().strip().splitlines()
            assert lines[0] == "report_date,vehicle_id,profit"
            ids += [ln.split(",")[1] for ln in lines[1:]]
        assert ids == expected


def test_report_csv_splits_a_hot_date_in_order(spark, scratch):
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep tiny ranges apart
    try:
        d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
        hot = [(d1, f"V{i:04d}", float(-i % 97)) for i in range(3000)]
        cold = [(d2, "V1", 1.0)]
        report = spark.createDataFrame(hot + cold, "report_date date, vehicle_id string, profit double")
        path = f"{scratch}/csv"
        write_report_csv(report, path)
        files = sorted(glob.glob(f"{path}/csv_date={d1}/*.csv"))
        assert len(files) > 1  # the hot date is written by several tasks
        got = []
        for name in files:
            with open(name) as fh:
                got += [tuple(ln.split(",")) for ln in fh.read().strip().splitlines()[1:]]
        expected = sorted(((v, p) for _, v, p in hot), key=lambda r: (r[1], r[0]))
        assert [(v, float(p)) for _, v, p in got] == expected
        assert len(glob.glob(f"{path}/csv_date={d2}/*.csv")) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_lake_read_modes(spark, scratch):
    path = f"{scratch}/lake"
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 1), "V1"), (dt.datetime(2024, 1, 2, 1), "V2")], "t timestamp_ntz, vehicle_id string"
    ).select(F.col("t").cast("timestamp").alias("event_time"), "vehicle_id")
    df.withColumn("event_date", F.to_date("event_time")).write.partitionBy("event_date").parquet(path)
    assert read_clean_lake(spark, path).where(F.col("event_date") == "2024-01-02").count() == 1
    assert read_clean_lake(spark, path, bypass_commit_log=True).count() == 2


def test_lake_read_honours_the_commit_log(spark, scratch):
    import json
    import shutil

    from odometer.plans.jobs import run_live

    src = f"{scratch}/src"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as fh:
        fh.write(json.dumps({"trip_id": "T1", "driver_id": "D1", "vehicle_id": "V1", "lat": 6.9, "lon": 79.9,
                             "speed": 10, "status": "idle", "fare": 0.0,
                             "timestamp": "2026-09-27T12:00:00+00:00"}) + "\n")
    lake = f"{scratch}/lake"
    run_live(spark, spark.readStream.format("text").load(src), lake, f"{scratch}/m", f"{scratch}/ckpt",
             available_now=True)
    day_dir = glob.glob(f"{lake}/event_date=*")[0]
    committed = glob.glob(f"{day_dir}/part-*.parquet")[0]
    # a file left behind by a micro-batch that never committed
    shutil.copy(committed, f"{day_dir}/part-99999-uncommitted.c000.snappy.parquet")
    assert read_clean_lake(spark, lake).count() == 1
    assert read_clean_lake(spark, lake, bypass_commit_log=True).count() == 2


def test_of_two_publications_of_a_date_one_fails(spark, scratch, monkeypatch):
    from odometer.sinks import files

    d1, d2, d3 = (dt.date(2026, 9, d) for d in (26, 27, 28))
    path = f"{scratch}/feed"
    write, raced = files._write_feeds, []

    def overtaken(*args):
        if not raced:
            raced.append(1)
            with pytest.raises(FileExistsError):
                write_expense_feed(_feed(spark, d2, maint=9.0).unionByName(_feed(spark, d3)), path)
        return write(*args)

    monkeypatch.setattr(files, "_write_feeds", overtaken)
    write_expense_feed(_feed(spark, d1).unionByName(_feed(spark, d2)), path)
    rows = read_expense_feed(spark, path).collect()
    assert {(r["report_date"], r["maintenance_cost"]) for r in rows} == {(d1, 1.0), (d2, 1.0)} and len(rows) == 6
    # the loser gave its claims back: its other date is free
    assert files.abandoned_claims(spark, path) == []
    write_expense_feed(_feed(spark, d3), path)


def test_a_publication_that_fails_leaves_nothing(spark, scratch):
    from odometer.sinks.files import abandoned_claims, release_claims

    d1, path = dt.date(2026, 9, 26), f"{scratch}/feed"
    broken = _feed(spark, d1).withColumn("fuel_cost", F.when(F.col("vehicle_id") == "V1", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("fuel_cost")))
    with pytest.raises(Exception, match="lost"):
        write_expense_feed(broken, path)
    assert glob.glob(f"{path}/feed_file=*") == [] and glob.glob(f"{path}/_publishing*") == []
    write_expense_feed(_feed(spark, d1), path)
    # a killed publication leaves its claim, which refuses the date until it is given back
    os.makedirs(f"{path}/_claims", exist_ok=True)
    killed = "vehicle_expenses_2026-09-27.csv"
    open(f"{path}/_claims/{killed}", "w").close()
    with pytest.raises(FileExistsError):
        write_expense_feed(_feed(spark, dt.date(2026, 9, 27)), path)
    assert abandoned_claims(spark, path) == [killed]
    release_claims(spark, path, [killed])
    write_expense_feed(_feed(spark, dt.date(2026, 9, 27)), path)
    assert read_expense_feed(spark, path).count() == 6
