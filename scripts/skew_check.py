"""Measure what a hot key costs: a third of all events on one vehicle and trip.

Usage: python scripts/skew_check.py [sf_dir]

The sf tables are mapped as usual, except that every event whose id is a
multiple of three is attributed to vehicle V-hot / trip T-hot.  Trip revenue,
5-minute utilization and keep-latest run over the whole table; Spark's event
log (written to a new scratch folder) gives, per shuffle-reading stage, the
largest number of records any one task read.  With map-side partial
aggregation that number stays near the number of groups, not a third of the
events.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="odometer-skew-")
    from pyspark.sql import functions as F

    from odometer.operators.profitability import trip_revenue
    from odometer.operators.serving import latest_per_key
    from odometer.operators.telemetry import clean_telemetry
    from odometer.operators.utilization import utilization_metrics
    from odometer.session import build_session
    from odometer.sources import fixtures

    spark = build_session(
        "local[8]",
        shuffle_partitions=8,
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log_dir}",
            "spark.eventLog.compress": "false",
            "spark.ui.showConsoleProgress": "false",
            # keep the 8 reduce partitions, so per-task reads show the key spread
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    events = fixtures.table(spark, sf_dir, "events")
    hot = F.col("event_id") % 3 == 0
    rows = fixtures.telemetry_rows(events, keep_event_id=True)
    rows = rows.withColumn("vehicle_id", F.when(hot, F.lit("V-hot")).otherwise(F.col("vehicle_id")))
    rows = rows.withColumn("trip_id", F.when(hot, F.lit("T-hot")).otherwise(F.col("trip_id"))).drop("event_id")
    clean = clean_telemetry(rows, with_ingest_time=False)
    total = clean.count()
    hot_rows = clean.where(F.col("vehicle_id") == "V-hot").count()
    jobs = {
        "trip_revenue": lambda: trip_revenue(clean),
        "utilization_5m": lambda: utilization_metrics(clean, watermark=None),
        "keep_latest": lambda: latest_per_key(fixtures.utilization_history(clean)),
    }
    for name, build in jobs.items():
        spark.sparkContext.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    per_stage: dict[int, list[int]] = {}
    names: dict[int, str] = {}
    for path in glob.glob(f"{log_dir}/*"):
        files = glob.glob(f"{path}/events_*") if os.path.isdir(path) else [path]
        for f in files:
            with open(f) as fh:
                for line in fh:
                    e = json.loads(line)
                    if e["Event"] == "SparkListenerTaskEnd":
                        read = e.get("Task Metrics", {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                        if read:
                            per_stage.setdefault(e["Stage ID"], []).append(read)
                    elif e["Event"] == "SparkListenerStageSubmitted":
                        props = e.get("Properties", {}) or {}
                        names[e["Stage Info"]["Stage ID"]] = props.get("spark.job.description", "")
    report = {"clean_rows": total, "hot_vehicle_rows": hot_rows, "stages": []}
    for sid in sorted(per_stage):
        reads = per_stage[sid]
        report["stages"].append(
            {"stage": sid, "job": names.get(sid, ""), "tasks": len(reads), "max_task_records": max(reads),
             "total_records": sum(reads)}
        )
    print(json.dumps(report))


if __name__ == "__main__":
    main()
