"""Structured Streaming queries of the live path.

Two independent queries read the same telemetry source (a fan-out): the
clean lake (stateless, append, no watermark, so late rows are kept) and the
utilization metrics (event-time aggregate with a watermark, update mode,
written per micro-batch through ``foreachBatch``).  Each has its own
checkpoint, so one failing sink does not stall the other, and both resume
exactly where they stopped after a driver or executor loss.
"""

from __future__ import annotations

import datetime as dt
import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from odometer.functions.timeutil import ts_literal
from odometer.operators.telemetry import decode_and_clean
from odometer.operators.utilization import sliding_metrics_direct, utilization_metrics, with_lineage
from odometer.sinks.versions import VersionedTable

DEFAULT_TRIGGER_SECONDS = 10
LOG = logging.getLogger("odometer.streaming")


HISTORY_PARTITIONS = ("window_date", "stream_run", "spark_batch_id")


def trigger_options(trigger_seconds: int | None = DEFAULT_TRIGGER_SECONDS, available_now: bool = False) -> dict:
    """``DataStreamWriter.trigger`` keyword arguments; the interval must be positive."""
    if available_now:
        return {"availableNow": True}
    if trigger_seconds is None or trigger_seconds <= 0:
        raise ValueError("trigger interval must be positive")
    return {"processingTime": f"{int(trigger_seconds)} seconds"}


def run_of(batch: DataFrame) -> str:
    """The id of the streaming query that a micro-batch belongs to.  It is kept
    in the query's checkpoint: a restart has the same id and a new or reset
    checkpoint another, so batch numbers never meet those of an earlier run."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return found or "no-query"


def persist_metrics_batch(
    batch: DataFrame,
    batch_id: int,
    metrics_path: str,
    processed_at=None,
    serving_path: str | VersionedTable | None = None,
    reject_path: str | None = None,
) -> dict:
    """Persist one update-mode micro-batch with lineage columns, and merge it
    into the serving table at ``serving_path`` if given.

    The batch is written to its own partitions (``window_date``, so reads prune
    by time; ``stream_run``; ``spark_batch_id``) with dynamic overwrite, so a
    retried batch replaces its earlier attempt instead of duplicating it, and a
    run with a new checkpoint never touches the history of an earlier one.  ``processed_at`` is one driver-side literal,
    identical however often the batch is evaluated.  The batch totals (rows,
    summed telemetry events) are observed during the write itself - no rows
    travel to the driver and the batch is evaluated once.
    """
    from pyspark.sql import Observation

    run = run_of(batch)
    stamped = with_lineage(batch, batch_id, processed_at).select(
        "*", F.to_date("window_start").alias("window_date"), F.lit(run).alias("stream_run")
    )
    totals = Observation(f"metrics_batch_{batch_id}")
    if serving_path is not None:
        stamped = stamped.persist()  # two sinks, one evaluation of the batch
    try:
        observed = stamped.observe(
            totals,
            F.count(F.lit(1)).alias("metric_rows"),
            F.coalesce(F.sum("telemetry_event_count"), F.lit(0)).cast("long").alias("telemetry_events"),
        )
        (
            observed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*HISTORY_PARTITIONS)
            .parquet(metrics_path)
        )
        if serving_path is not None:
            from odometer.sinks.merge import serve_utilization

            serve_utilization(batch.sparkSession, serving_path, stamped.drop("window_date"), reject_path, "live")
    finally:
        if serving_path is not None:
            stamped.unpersist()
    result = dict(totals.get)
    result["spark_batch_id"] = int(batch_id)
    LOG.info(json.dumps({"event": "metrics-batch-stored", "path": metrics_path, **result}))
    return result


def write_sliding_batch(batch: DataFrame, batch_id: int, log_path: str) -> None:
    """Older sink: append every emitted window row with ``created_at``; the
    window struct is flattened and the idle ratio is not stored.  Appends to
    the batch's own partition with overwrite, so a retry does not duplicate."""
    created = dt.datetime.now(dt.timezone.utc)
    out = batch.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "active_vehicles",
        "idle_events",
        "total_events",
        "trips",
        "total_earnings",
        "average_speed",
        ts_literal(created).alias("created_at"),
        F.lit(run_of(batch)).alias("stream_run"),
        F.lit(int(batch_id)).cast("long").alias("spark_batch_id"),
    )
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("stream_run", "spark_batch_id")
        .parquet(log_path)
    )


def start_clean_lake(
    clean: DataFrame,
    lake_path: str,
    checkpoint: str,
    trigger: dict,
    query_name: str = "odometer-clean-lake",
) -> StreamingQuery:
    """Clean rows -> Parquet lake, append mode, partitioned by event date."""
    return (
        clean.withColumn("event_date", F.to_date("event_time"))
        .writeStream.format("parquet")
        .queryName(query_name)
        .outputMode("append")
        .partitionBy("event_date")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(lake_path)
    )


def start_metrics(
    metrics: DataFrame,
    metrics_path: str,
    checkpoint: str,
    trigger: dict,
    query_name: str = "odometer-metrics",
    serving_path: str | VersionedTable | None = None,
    reject_path: str | None = None,
) -> StreamingQuery:
    """Windowed metrics -> per-batch Parquet partitions, update mode, and the
    serving table where one is named."""
    return (
        metrics.writeStream.queryName(query_name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(lambda df, batch_id: persist_metrics_batch(df, batch_id, metrics_path, None, serving_path, reject_path))
        .start()
    )


def start_live_queries(
    spark: SparkSession,
    source: DataFrame,
    lake_path: str,
    metrics_path: str,
    checkpoint_root: str,
    trigger_seconds: int | None = DEFAULT_TRIGGER_SECONDS,
    available_now: bool = False,
    exact_money: bool = False,
    serving_path: str | VersionedTable | None = None,
    reject_path: str | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the lake and metrics branches from one streaming source."""
    trigger = trigger_options(trigger_seconds, available_now)
    clean = decode_and_clean(source)
    lake = start_clean_lake(clean, lake_path, f"{checkpoint_root}/clean-lake", trigger)
    metrics = utilization_metrics(clean, exact_money=exact_money)
    metric_query = start_metrics(metrics, metrics_path, f"{checkpoint_root}/metrics", trigger, "odometer-metrics", serving_path, reject_path)
    return lake, metric_query


def start_sliding(
    source: DataFrame,
    log_path: str,
    checkpoint: str,
    trigger_seconds: int | None = DEFAULT_TRIGGER_SECONDS,
    available_now: bool = False,
    panes: bool = False,
) -> StreamingQuery:
    """Older path: unvalidated events, 5-minute windows sliding by 1 minute,
    HLL distinct counts, into an append-only log.

    Default: Spark's sliding ``window()`` in update mode, as that path ran.
    ``panes=True``: one-minute panes with mergeable sketches chained into the
    sliding windows (append mode, each window written once when closed);
    state per event is one pane instead of five windows.
    """
    from odometer.operators.utilization import sliding_metrics_sketched
    from odometer.sources.telemetry import decode_telemetry

    parsed = decode_telemetry(source).withColumn("event_time", F.col("timestamp").try_cast("timestamp"))
    if panes:
        metrics = sliding_metrics_sketched(parsed, watermark="2 minutes").select(
            F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window"),
            "*",
        )
        mode = "append"
    else:
        metrics = sliding_metrics_direct(parsed)
        mode = "update"
    return (
        metrics.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(trigger_seconds, available_now))
        .foreachBatch(lambda df, batch_id: write_sliding_batch(df, batch_id, log_path))
        .start()
    )


def write_checks_batch(batch: DataFrame, batch_id: int, checks_path: str) -> None:
    """Per-batch partition of updated telemetry-contract counts (retry-safe)."""
    (
        batch.withColumn("stream_run", F.lit(run_of(batch)))
        .withColumn("spark_batch_id", F.lit(int(batch_id)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("stream_run", "spark_batch_id")
        .parquet(checks_path)
    )


def start_quality(
    source: DataFrame,
    checks_path: str,
    checkpoint: str,
    trigger_seconds: int | None = DEFAULT_TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Telemetry-contract violation counts per event date over the parsed,
    *unfiltered* stream, so users see what validation discards.  Update
    mode; the newest row per date (greatest batch id) is the running total.
    State is one row per event date."""
    from odometer.operators.telemetry import telemetry_checks
    from odometer.sources.telemetry import decode_telemetry

    checks = telemetry_checks(decode_telemetry(source))
    return (
        checks.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(trigger_seconds, available_now))
        .foreachBatch(lambda df, batch_id: write_checks_batch(df, batch_id, checks_path))
        .start()
    )


def run_until_any_stops(spark: SparkSession, queries: tuple[StreamingQuery, ...]) -> None:
    """Block until one query terminates, then stop the rest (and re-raise)."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def progress_summary(query: StreamingQuery) -> dict:
    """Totals over the micro-batches that Spark still keeps progress of (the last
    ``spark.sql.streaming.numRecentProgressUpdates``, 100 by default):
    batches, input rows, wall time, rows/s, rows dropped by the watermark and
    the state rows kept at the end."""
    batches = [p for p in query.recentProgress if p.get("numInputRows", 0) > 0]
    rows = sum(p.get("numInputRows", 0) for p in batches)
    millis = sum(p.get("durationMs", {}).get("triggerExecution", 0) for p in batches)
    dropped = sum(
        sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
        for p in query.recentProgress
    )
    last = query.recentProgress[-1] if query.recentProgress else {}
    state_rows = sum(op.get("numRowsTotal", 0) for op in last.get("stateOperators", []))
    return {
        "batches": len(batches),
        "input_rows": rows,
        "millis": millis,
        "rows_per_sec": round(rows / (millis / 1000.0), 1) if millis else None,
        "dropped_by_watermark": dropped,
        "state_rows": state_rows,
    }
