"""Contract queries: one named DataFrame builder per operator group.

Each builder takes ``(spark, sf_dir)``, reads the driver's tables, maps
them onto the fleet model (``odometer.sources.fixtures``) and runs the
library operator over the whole tables.  ``odometer.plans.oracle_sql``
holds the equivalent DuckDB SQL under the same names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometer.functions.timeutil import as_wall_clock, naive_to_utc, ts_literal
from odometer.functions.zones import box_zone, grid_zone
from odometer.operators.health import check_grid, gauges, health_snapshot, health_status, health_transitions
from odometer.operators.profitability import (
    build_report,
    build_report_for_day,
    daily_events,
    finish_report,
    report_summary,
    trip_revenue,
    unprofitable_ranking,
)
from odometer.operators.quality import expense_feed_checks
from odometer.operators.serving import (
    conform_utilization,
    latest_per_key,
    latest_window,
    upsert_profitability,
    upsert_utilization,
)
from odometer.operators.telemetry import clean_telemetry, decode_and_clean, telemetry_checks
from odometer.operators.utilization import (
    batch_totals,
    sliding_metrics,
    sliding_metrics_sketched,
    utilization_metrics,
)
from odometer.plans import params
from odometer.plans.repair import repair_late_windows
from odometer.schemas import TELEMETRY_FIELDS, UTILIZATION_COLUMNS, UTILIZATION_KEY
from odometer.session import discard_at_exit, ensure_utc, materialize, scratch_path
from odometer.sinks.files import write_expense_feed
from odometer.sinks.merge import merge_profitability, merge_utilization
from odometer.sinks.versions import VersionedTable, report_table, served_latest_window, snapshot_row, utilization_table
from odometer.sources import fixtures
from odometer.sources.expenses import read_expense_feed
from odometer.sources.lake import read_clean_lake
from odometer.sources.telemetry import decode_telemetry, encode_telemetry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return fixtures.table(spark, sf_dir, "events")


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean telemetry as the lake holds it (typed path, no ingest stamp)."""
    return clean_telemetry(fixtures.telemetry_rows(_events(spark, sf_dir)), with_ingest_time=False)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps as wall-clock UTC (TIMESTAMP_NTZ), in one projection."""
    return df.select(*[as_wall_clock(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("clean_telemetry")
def q_clean_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON value -> decode -> validate -> zone (the live path's cleaning)."""
    raw = fixtures.telemetry_json(_events(spark, sf_dir))
    clean = decode_and_clean(raw, with_ingest_time=False)
    return _ntz(clean, "event_time")


@query("utilization_5m")
def q_utilization_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = utilization_metrics(clean_rows(spark, sf_dir), watermark=None, exact_money=True)
    return _ntz(metrics, "window_start", "window_end")



def expense_rows(spark: SparkSession, sf_dir: str, clean: DataFrame | None = None) -> DataFrame:
    """The expense feed: every supplier-vehicle for every telemetry date."""
    clean = clean if clean is not None else clean_rows(spark, sf_dir)
    dates = clean.select(F.to_date("event_time").alias("report_date"))
    return fixtures.expense_feed(fixtures.table(spark, sf_dir, "supplier"), dates)


def report_rows(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    clean = clean_rows(spark, sf_dir)
    report = build_report(expense_rows(spark, sf_dir, clean), trip_revenue(clean, exact_money=True))
    return materialize(report) if stored else report


@query("trip_revenue")
def q_trip_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_revenue(clean_rows(spark, sf_dir), exact_money=True)


@query("profitability_report")
def q_profitability_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-day reconciliation: one Spark job over the whole history."""
    return report_rows(spark, sf_dir)


@query("profitability_report_day")
def q_profitability_report_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-date reconciliation: the date's feed against the date's events."""
    clean = clean_rows(spark, sf_dir)
    # the day's feed comes from the day's events, so both scans read one day
    feed = expense_rows(spark, sf_dir, daily_events(clean, params.REPORT_DAY))
    return build_report_for_day(feed, clean, params.REPORT_DAY, exact_money=True)


@query("profitability_summary")
def q_profitability_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_summary(report_rows(spark, sf_dir))


@query("unprofitable_vehicles")
def q_unprofitable_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary's ordered list of unprofitable vehicles, as ranked rows."""
    return unprofitable_ranking(report_rows(spark, sf_dir))


def history_rows(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """Append-only metrics history (three versions per window at most).

    ``stored=True`` materializes it, as the metrics table is a stored table:
    queries that read it several times then scan the telemetry only once.
    """
    history = fixtures.utilization_history(clean_rows(spark, sf_dir))
    return materialize(history) if stored else history


def serving_rows(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """The keep-latest serving view over the history (optionally stored)."""
    serving = latest_per_key(history_rows(spark, sf_dir))
    return materialize(serving) if stored else serving


@query("latest_metrics_per_key")
def q_latest_metrics_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(serving_rows(spark, sf_dir), "window_start", "window_end", "processed_at")


@query("batch_totals")
def q_batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_totals(history_rows(spark, sf_dir))


@query("utilization_upsert")
def q_utilization_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored state after batches 0-1, merged with batch 2 plus replays of
    batch 0 (stale or equal time) and batch 1 (equal time)."""
    history = history_rows(spark, sf_dir, stored=True)
    target = latest_per_key(history.where(F.col("spark_batch_id") <= 1))
    incoming = (
        history.where(F.col("spark_batch_id") == 2)
        .unionByName(history.where(F.col("spark_batch_id") == 0).withColumn("spark_batch_id", F.lit(3).cast("long")))
        .unionByName(history.where(F.col("spark_batch_id") == 1).withColumn("spark_batch_id", F.lit(4).cast("long")))
    )
    merged = upsert_utilization(target, incoming)
    return _ntz(merged, "window_start", "window_end", "processed_at")


@query("latest_window")
def q_latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_window(serving_rows(spark, sf_dir, stored=True))
    return _ntz(rows, "window_start", "window_end", "processed_at")


@query("latest_window_zone")
def q_latest_window_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_window(serving_rows(spark, sf_dir, stored=True), zone=params.LATEST_ZONE)
    return _ntz(rows, "window_start", "window_end", "processed_at")


@query("latest_window_closed")
def q_latest_window_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest window as of a time at which it covers several zones."""
    rows = latest_window(serving_rows(spark, sf_dir, stored=True), closed_before=params.CLOSED_BEFORE)
    return _ntz(rows, "window_start", "window_end", "processed_at")


@query("latest_window_closed_zone")
def q_latest_window_closed_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone of that window; the zone never changes which window it is."""
    serving = serving_rows(spark, sf_dir, stored=True)
    rows = latest_window(serving, zone=params.CLOSED_ZONE, closed_before=params.CLOSED_BEFORE)
    return _ntz(rows, "window_start", "window_end", "processed_at")


@query("serving_conform")
def q_serving_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(conform_utilization(serving_rows(spark, sf_dir)), "window_start", "window_end", "processed_at")


@query("profitability_upsert")
def q_profitability_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored report, then a re-run for the later dates that posts a late fee
    for vehicles with trips; every other stored row must survive."""
    report = report_rows(spark, sf_dir, stored=True)
    target = report.withColumn("updated_at", F.lit(params.UPDATED_AT_TARGET).cast("timestamp"))
    rerun = finish_report(
        report.where(
            (F.col("report_date") >= F.lit(params.RERUN_FROM).cast("date")) & (F.col("completed_trip_count") > 0)
        ).withColumn("maintenance_cost", F.col("maintenance_cost") + F.lit(float(params.LATE_FEE)))
    )
    merged = upsert_profitability(target, rerun, params.UPDATED_AT_BATCH)
    return _ntz(merged, "updated_at")


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health_snapshot(serving_rows(spark, sf_dir), report_rows(spark, sf_dir))


@query("health_snapshot")
def q_health_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(snapshot_rows(spark, sf_dir), "last_processed_at")


@query("health_status")
def q_health_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = health_status(snapshot_rows(spark, sf_dir), params.HEALTH_NOW, params.THRESHOLD)
    return _ntz(status, "last_processed_at", "checked_at")


@query("gauge_export")
def q_gauge_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gauges(snapshot_rows(spark, sf_dir), params.HEALTH_NOW, params.THRESHOLD)


@query("health_transitions")
def q_health_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness checked every two minutes over the metrics' calendar span."""
    history = history_rows(spark, sf_dir, stored=True)
    alerts = health_transitions(check_grid(history, params.CHECK_MINUTES), history, params.THRESHOLD)
    return _ntz(alerts, "created_at", "last_processed_at")


@query("zone_assignment")
def q_zone_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.telemetry_rows(_events(spark, sf_dir), keep_event_id=True)
    return rows.select("event_id", "lat", "lon", grid_zone("lat", "lon").alias("zone"))


@query("zone_boxes")
def q_zone_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.telemetry_rows(_events(spark, sf_dir), keep_event_id=True)
    return rows.select("event_id", "lat", "lon", box_zone("lat", "lon").alias("zone"))


@query("telemetry_json_roundtrip")
def q_telemetry_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode each event as the producer does, decode it as the consumer does."""
    rows = fixtures.telemetry_rows(_events(spark, sf_dir)).select(*TELEMETRY_FIELDS)
    return decode_telemetry(encode_telemetry(rows))


@query("telemetry_checks")
def q_telemetry_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_checks(fixtures.telemetry_rows(_events(spark, sf_dir)))


@query("telemetry_checks_dirty")
def q_telemetry_checks_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry contract over rows that break each of its rules."""
    return telemetry_checks(fixtures.dirty_telemetry_rows(_events(spark, sf_dir)))


@query("expense_feed_checks_dirty")
def q_expense_feed_checks_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed contract over rows that break each of its rules."""
    vehicle_days = materialize(
        clean_rows(spark, sf_dir).groupBy(F.to_date("event_time").alias("report_date"), "vehicle_id").count()
    )
    feed = fixtures.expense_feed(fixtures.table(spark, sf_dir, "supplier"), vehicle_days.select("report_date"))
    return expense_feed_checks(fixtures.dirty_expense_feed(feed), vehicle_days.select("vehicle_id"))


@query("expense_feed_checks")
def q_expense_feed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier-based feed checked against the vehicles seen on the road.

    Dates and the vehicle dimension both come from one stored vehicle-day
    table (bounded by fleet size x days), so the telemetry is scanned once.
    """
    vehicle_days = materialize(
        clean_rows(spark, sf_dir).groupBy(F.to_date("event_time").alias("report_date"), "vehicle_id").count()
    )
    feed = fixtures.expense_feed(fixtures.table(spark, sf_dir, "supplier"), vehicle_days.select("report_date"))
    return expense_feed_checks(feed, vehicle_days.select("vehicle_id"))


@query("expense_feed_scan")
def q_expense_feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the daily feeds as CSV in the shared folder, then scan them back
    (date from the file name, typed amounts)."""
    path = scratch_path(spark, "expense_feed")
    write_expense_feed(expense_rows(spark, sf_dir), path)
    discard_at_exit(spark, path)
    return read_expense_feed(spark, path)


@query("utc_normalize")
def q_utc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times recorded as naive Asia/Colombo wall-clock, expressed in UTC."""
    ev = _events(spark, sf_dir)
    return ev.select(
        "event_id",
        F.col("ts").alias("local_time"),
        as_wall_clock(naive_to_utc(F.col("ts").cast("timestamp"), params.LOCAL_ZONE)).alias("utc_time"),
    )


@query("sliding_metrics")
def q_sliding_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older path: 5-minute windows sliding by 1 minute over unvalidated rows."""
    out = sliding_metrics(fixtures.telemetry_rows(_events(spark, sf_dir)), exact_money=True)
    return _ntz(out, "window_start", "window_end")


@query("sliding_metrics_approx")
def q_sliding_metrics_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same windows with HLL sketches of one-minute panes.  Estimates can't be
    expressed in SQL, so they stand as "within the sketch's error of the exact
    count" beside it."""
    rows = fixtures.telemetry_rows(_events(spark, sf_dir))
    estimated = sliding_metrics_sketched(rows, exact_money=True)
    exact = sliding_metrics(rows, exact_money=True).select(
        "window_start", F.col("active_vehicles").alias("exact_vehicles"), F.col("trips").alias("exact_trips")
    )

    def near(estimate: str, count: str) -> F.Column:
        # Four standard errors of a 4096-register sketch, one at least.
        return F.abs(F.col(estimate) - F.col(count)) <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col(count))

    out = estimated.join(exact, "window_start", "left").select(
        "window_start",
        "window_end",
        "exact_vehicles",
        "exact_trips",
        near("active_vehicles", "exact_vehicles").alias("vehicles_near"),
        near("trips", "exact_trips").alias("trips_near"),
        "idle_events",
        "total_events",
        "total_earnings",
        "average_speed",
        "idle_ratio",
    )
    return _ntz(out, "window_start", "window_end")


def _stream_in_drops(spark: SparkSession, drops: tuple, base: str, serving: str | VersionedTable | None) -> None:
    """Run the live path over drops of binary JSON values; each is consumed by
    an ``availableNow`` run of the same checkpointed queries (watermark 2 min,
    update mode)."""
    from odometer.streaming.queries import start_live_queries

    for drop in drops:
        # the producer's binary JSON values, landed as compressed Parquet files
        encode_telemetry(drop).write.mode("append").parquet(f"{base}/source")
        source = spark.readStream.schema("value binary").parquet(f"{base}/source")
        queries = start_live_queries(
            spark,
            source,
            f"{base}/lake",
            f"{base}/metrics",
            f"{base}/checkpoints",
            available_now=True,
            exact_money=True,
            serving_path=serving,
        )
        for q in queries:
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
    discard_at_exit(spark, base)


def _two_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The telemetry, split at the midpoint of its event time span."""
    events = _events(spark, sf_dir)
    span = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    split = span["lo"] + (span["hi"] - span["lo"]) / 2
    rows = fixtures.telemetry_rows(events).select(*TELEMETRY_FIELDS, F.col("event_time"))
    return rows.where(F.col("event_time") < ts_literal(split)), rows.where(F.col("event_time") >= ts_literal(split))


@query("stream_utilization")
def q_stream_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live path end to end on a file stream.  The window that straddles
    the two drops is emitted twice; the keep-latest view over the appended
    batches equals the batch aggregate."""
    base = scratch_path(spark, "stream_utilization")
    _stream_in_drops(spark, _two_halves(spark, sf_dir), base, None)
    latest = latest_per_key(spark.read.parquet(f"{base}/metrics")).select(*UTILIZATION_COLUMNS)
    return _ntz(latest, "window_start", "window_end")


@query("stream_serving")
def q_stream_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run with its micro-batches merged, checked and typed, into the
    serving table as they come."""
    base = scratch_path(spark, "stream_serving")
    serving = utilization_table(f"{base}/serving")
    _stream_in_drops(spark, _two_halves(spark, sf_dir), base, serving)
    return _ntz(serving.read(spark).select(*UTILIZATION_COLUMNS), "window_start", "window_end")


@query("late_repair")
def q_late_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A live run in which every tenth event comes after all others, mostly too
    late for its window; then the repair from the lake.  The serving table equals
    the batch aggregate, and says how many dropped rows each window got back."""
    base = scratch_path(spark, "late_repair")
    rows = fixtures.telemetry_rows(_events(spark, sf_dir), keep_event_id=True)
    tenth = F.col("event_id") % params.LATE_EVERY == 0
    serving = utilization_table(f"{base}/serving")
    _stream_in_drops(spark, tuple(rows.where(c).select(*TELEMETRY_FIELDS, "event_time") for c in (~tenth, tenth)), base, serving)
    changed = repair_late_windows(spark, read_clean_lake(spark, f"{base}/lake"), serving, f"{base}/marks", exact_money=True)
    table = serving.read(spark).select(*UTILIZATION_COLUMNS)
    recovered = changed.select(*UTILIZATION_KEY, "recovered_rows")
    out = table.join(recovered, list(UTILIZATION_KEY), "left").withColumn("recovered_rows", F.coalesce("recovered_rows", F.lit(0)).cast("long"))
    return _ntz(out, "window_start", "window_end")


def served_tables(spark: SparkSession, sf_dir: str, reports: bool = False) -> tuple[VersionedTable, VersionedTable]:
    """The keep-latest view (and the report) as stored serving tables."""
    base = scratch_path(spark, "served")
    discard_at_exit(spark, base)
    metrics, report = utilization_table(f"{base}/metrics"), report_table(f"{base}/report")
    merge_utilization(spark, metrics, serving_rows(spark, sf_dir, stored=True))
    if reports:
        merge_profitability(spark, report, report_rows(spark, sf_dir, stored=True), params.UPDATED_AT_TARGET)
    return metrics, report


@query("latest_window_served")
def q_latest_window_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest closed window off the stored table: the manifest names the
    day, and one day's folder is read."""
    metrics, _ = served_tables(spark, sf_dir)
    rows = served_latest_window(spark, metrics, closed_before=params.CLOSED_BEFORE)
    return _ntz(rows, "window_start", "window_end", "processed_at")


@query("health_snapshot_served")
def q_health_snapshot_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health snapshot off the manifests, without reading a row."""
    return _ntz(snapshot_row(spark, *served_tables(spark, sf_dir, reports=True)), "last_processed_at")
