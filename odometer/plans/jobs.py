"""End-to-end jobs: the daily (or many-day) reconciliation and the live path."""

from __future__ import annotations

import datetime as dt
import functools
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odometer import hadoop
from odometer.operators.profitability import build_report, build_report_for_day, order_report, trip_revenue
from odometer.operators.health import health_transitions
from odometer.operators.serving import latest_per_key
from odometer.schemas import UTILIZATION_KEY
from odometer.session import ensure_utc, materialize, stored_or_none
from odometer.sinks.files import append_alerts, write_report_csv, write_report_parquet
from odometer.sinks.merge import keep_rejects, merge_profitability, only_dates_of, serve_utilization, split_report
from odometer.sources.expenses import read_expense_feed
from odometer.sinks.versions import VersionedTable
from odometer.sources.lake import read_clean_lake
from odometer.streaming.queries import HISTORY_PARTITIONS


def reconcile(
    spark: SparkSession,
    expenses_path: str,
    lake_path: str,
    output_root: str,
    csv_root: str,
    serving_path: str | VersionedTable | None = None,
    report_date: str | None = None,
    bypass_commit_log: bool = False,
    reject_path: str | None = None,
    exact_money: bool = False,
) -> DataFrame:
    """Read the feed(s) and the clean lake, build the report, then write it
    as Parquet (per-date overwrite), as sorted CSV per date (a very large date is
    several files), and merge it into the serving table.

    ``report_date`` runs the single-date form (every feed row is labelled
    with that date); without it every date found in the feeds is reconciled
    in one job.
    """
    ensure_utc(spark)
    lake = read_clean_lake(spark, lake_path, bypass_commit_log)
    feed = read_expense_feed(spark, expenses_path, report_date)
    return reconcile_frames(spark, feed, lake, output_root, csv_root, serving_path, report_date, reject_path, exact_money)


def reconcile_frames(
    spark: SparkSession,
    feed: DataFrame,
    lake: DataFrame,
    output_root: str,
    csv_root: str,
    serving_path: str | VersionedTable | None = None,
    report_date: str | None = None,
    reject_path: str | None = None,
    exact_money: bool = False,
) -> DataFrame:
    """The reconciliation on already-read frames (batch or one micro-batch).

    Only the feed's dates are read from the lake: its ``event_date`` folders
    between the first and last of them (scalar subqueries, so other folders
    aren't read), less the gaps (a semi join).  The report is materialized
    once, so the three writes do not recompute it.

    Serving types and constraints are checked before anything is written: rows
    that break one (a missing cost, an amount too large) go to ``reject_path``
    when given and are kept out of the serving merge; without ``reject_path``
    the job fails before writing.
    """
    if report_date is not None:
        report = build_report_for_day(feed.drop("csv_report_date"), lake, report_date, exact_money)
    else:
        # One row per date: bounded by the calendar.
        days = materialize(feed.select(F.col("report_date").alias("event_date")).distinct())
        if "event_date" not in lake.columns:
            lake = lake.withColumn("event_date", F.to_date("event_time"))
        lake = only_dates_of(lake, days, "event_date")
        report = build_report(feed.drop("csv_report_date"), trip_revenue(lake, exact_money))
    report = materialize(report)
    servable = report
    if serving_path is not None:
        servable, rejects = split_report(report)
        # Per-date overwrite: re-running a date replaces its rejects.
        keep_rejects(rejects, reject_path, ["report_date"], "report")
    write_report_parquet(report, output_root)
    write_report_csv(report, csv_root)
    if serving_path is not None:
        merge_profitability(spark, serving_path, servable, dt.datetime.now(dt.timezone.utc))
    return order_report(report)


def start_reconciliation_stream(
    spark: SparkSession,
    feeds_path: str,
    lake_path: str,
    output_root: str,
    csv_root: str,
    checkpoint: str,
    serving_path: str | VersionedTable | None = None,
    reject_path: str | None = None,
    trigger_seconds: int = 300,
    available_now: bool = False,
    max_files_per_trigger: int | None = None,
    exact_money: bool = False,
):
    """Reconcile every newly published feed file as it arrives.

    This replaces a scheduler that polls for the day's file: the file
    source's checkpoint records which feed files were consumed, so each
    file sets off its day once and a failed run resumes where it stopped.  A
    micro-batch only says which dates have news: a day may be several files
    that arrive in different batches, so the complete feed of these dates is
    read again and reconciled.  (Spark's file source doesn't notice a file that
    is replaced under its old name; such a day is rerun with ``reconcile``.)
    """
    from odometer.sources.expenses import read_expense_feed_stream
    from odometer.streaming.queries import trigger_options

    ensure_utc(spark)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # One row per date: bounded by the calendar.
        dates = [r[0] for r in batch.select("report_date").distinct().collect() if r[0] is not None]
        if dates:
            feed = read_expense_feed(spark, feeds_path, dates=dates)
            lake = read_clean_lake(spark, lake_path)
            reconcile_frames(
                spark, feed, lake, output_root, csv_root, serving_path, None, reject_path, exact_money
            )

    return (
        read_expense_feed_stream(spark, feeds_path, max_files_per_trigger)
        .writeStream.queryName("odometer-reconciliation")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(trigger_seconds, available_now))
        .foreachBatch(per_batch)
        .start()
    )


def run_live(
    spark: SparkSession,
    source: DataFrame,
    lake_path: str,
    metrics_path: str,
    checkpoint_root: str,
    trigger_seconds: int = 10,
    available_now: bool = False,
    serving_path: str | VersionedTable | None = None,
    reject_path: str | None = None,
    exact_money: bool = False,
) -> None:
    """Start the lake and metrics queries on one source and supervise them:
    wait for either to end, then stop both (errors propagate).  With
    ``serving_path`` each micro-batch is also merged into the serving table."""
    from odometer.streaming.queries import run_until_any_stops, start_live_queries

    ensure_utc(spark)
    queries = start_live_queries(
        spark,
        source,
        lake_path,
        metrics_path,
        checkpoint_root,
        trigger_seconds=trigger_seconds,
        available_now=available_now,
        exact_money=exact_money,
        serving_path=serving_path,
        reject_path=reject_path,
    )
    if available_now:
        try:
            for q in queries:
                q.awaitTermination()
        finally:
            for q in queries:
                if q.isActive:
                    q.stop()
        return
    run_until_any_stops(spark, queries)


def compact_metrics(
    spark: SparkSession,
    metrics_path: str,
    serving_path: str | VersionedTable,
    progress_path: str | None = None,
    reject_path: str | None = None,
    archive_path: str | None = None,
) -> int:
    """Fold the micro-batches of the append-only metrics history that were not
    folded yet into the serving table: newest version per key, then the checked
    and guarded merge (an older version never overwrites a newer stored one).

    Which batches are new is taken from the folder listing, and only their
    folders are read, so a fold costs what is new, however long the history.

    ``progress_path`` (default: beside the serving table) records each folded
    (run, batch) after the merge; a fold that is repeated changes nothing.
    With ``archive_path`` folded batches retire: their rows go to the archive
    (``window_date``, ``fold``; few files a day) and their folders are removed,
    so that the listing stays as short as what is new; ``read_history`` reads
    both.  A fold's list of batches is published before its first step, and a
    fold that failed is finished from that list, so no row is doubled or lost.
    Returns the number of batches folded.
    """
    ensure_utc(spark)
    if progress_path is None:
        root = serving_path.path if isinstance(serving_path, VersionedTable) else serving_path
        progress_path = root.rstrip("/") + "_folded"
    plans = progress_path.rstrip("/") + "_plans"
    names = hadoop.names(spark, plans)
    started = [n[:-5] for n in names if n.endswith(".json")]
    number = started[-1] if started else None
    if number is not None and f"{number}.done" in names:
        # Its rows are safe; what a failure left of its folders goes now.
        _retire(spark, metrics_path, json.loads(hadoop.read_text(spark, f"{plans}/{number}.json")), archive_path)
        number = None
    if number is None:
        folders = _unfolded(spark, metrics_path, progress_path)
        if not folders:
            return 0
        number = f"{len(started):012d}"
        if not hadoop.put_new(spark, f"{plans}/{number}.json", json.dumps(folders)):
            raise RuntimeError("another fold of this history is running")
    folders = json.loads(hadoop.read_text(spark, f"{plans}/{number}.json"))
    root = metrics_path.rstrip("/")
    fresh = spark.read.option("basePath", root).parquet(*[f"{root}/{f}" for f in folders])
    latest = latest_per_key(fresh.drop("window_date"))
    serve_utilization(spark, serving_path, latest, reject_path, "fold")
    if archive_path is not None:
        (
            fresh.withColumn("fold", F.lit(f"f{number}"))  # no number: it is compared as text
            .repartitionByRange("window_date", "window_start", "zone")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("window_date", "fold")
            .parquet(archive_path)
        )
    batches = fresh.select("stream_run", F.col("spark_batch_id").cast("long").alias("spark_batch_id")).distinct()
    batches.withColumn("fold", F.lit(number)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("fold").parquet(progress_path)
    hadoop.claim(spark, f"{plans}/{number}.done")
    _retire(spark, metrics_path, folders, archive_path)
    return len({f.split("/", 1)[1] for f in folders})


def _unfolded(spark: SparkSession, metrics_path: str, progress_path: str) -> list[str]:
    """Batch folders of the history, relative to it, that no fold has taken."""
    root = metrics_path.rstrip("/")
    found = hadoop.matches(spark, "/".join([root, *(f"{c}=*" for c in HISTORY_PARTITIONS)]))
    folders = ["/".join(p.split("/")[-len(HISTORY_PARTITIONS) :]) for p in found]
    folded = stored_or_none(spark, progress_path)
    if not folders or folded is None:
        return folders
    # The ledger stays in Spark; what returns is what is new.
    listed = spark.createDataFrame([(f, *(v.split("=", 1)[1] for v in f.split("/")[1:])) for f in folders], "folder string, run string, batch string")
    old = folded.select(F.col("stream_run").cast("string").alias("run"), F.col("spark_batch_id").cast("string").alias("batch"))
    return sorted(r["folder"] for r in listed.join(old, ["run", "batch"], "left_anti").collect())


def _retire(spark: SparkSession, metrics_path: str, folders: list[str], archive_path: str | None) -> None:
    if archive_path is not None:
        for folder in folders:
            hadoop.remove(spark, f"{metrics_path.rstrip('/')}/{folder}")


def read_history(spark: SparkSession, metrics_path: str, archive_path: str | None = None) -> DataFrame:
    """The metrics history: batches not retired yet, and the archive's."""
    parts = [stored_or_none(spark, p) for p in (metrics_path, archive_path) if p is not None]
    frames = [p.drop("fold") for p in parts if p is not None]
    if not frames:
        raise FileNotFoundError(f"no metrics history under {metrics_path}")
    return functools.reduce(lambda a, b: a.unionByName(b), frames)


def record_health_alerts(
    spark: SparkSession,
    history_path: str,
    alerts_path: str,
    checks: DataFrame,
    threshold_seconds: int = 120,
    marks_path: str | None = None,
    archive_path: str | None = None,
) -> DataFrame:
    """Evaluate freshness at the given check times against the metrics history
    and append the status transitions to the alert log.

    ``marks_path`` (default: beside the alert log) keeps up to which check the
    past is evaluated, and the status, newest stamp and serving rows there.  Only
    later checks are evaluated, from that state, whether or not they alerted: a
    re-run over the same checks appends nothing, and a window that is written
    again later changes no check of the past.  Alerts are stored under the mark
    they start from, and the mark moves last, so a run that failed in between is
    repeated without doubling its alerts.

    The mark also says which batches are accounted for.  A run reads those that
    came since (in the history, or retired to ``archive_path`` meanwhile) and, to
    know which of their windows are new, the days these fall into; not the rest.
    """
    ensure_utc(spark)
    marks_path = marks_path or alerts_path.rstrip("/") + "_marks"
    marks = stored_or_none(spark, marks_path)
    mark = marks.orderBy(F.desc("evaluated_to")).first().asDict() if marks is not None else {}
    since = "start"
    if mark:
        checks = checks.where(F.col("check_time") > F.lit(mark["evaluated_to"]))
        since = mark["evaluated_to"].strftime("%Y%m%dT%H%M%S.%f")
    checks = materialize(checks.select("check_time"))
    stamps = materialize(_unseen_stamps(spark, history_path, archive_path, mark))
    known = _with_base(spark, stamps, mark)
    alerts = materialize(health_transitions(checks, None, threshold_seconds, initial_status=mark.get("status"), stamps=known))
    append_alerts(alerts, alerts_path, since)
    reach = checks.agg(F.max("check_time").alias("t")).first()["t"]
    if reach is not None:
        _move_mark(spark, marks_path, mark, reach, stamps, known, alerts)
    return alerts


MARK = "evaluated_to timestamp, status string, last_processed_at timestamp, metric_rows long, seen map<string,long>, fold string"


def _history_folders(spark: SparkSession, path: str, partitions: tuple) -> list[dict[str, str]]:
    """The partition values of each folder of a table, from the listing."""
    found = hadoop.matches(spark, "/".join([path.rstrip("/"), *(f"{c}=*" for c in partitions)]))
    return [dict(v.split("=", 1) for v in p.split("/")[-len(partitions) :]) for p in found]


def _unseen_stamps(spark: SparkSession, history_path: str, archive_path: str | None, mark: dict) -> DataFrame:
    """(t, new_rows, stream_run, spark_batch_id, fold) of the batches that the
    mark doesn't account for: their stamps, and how many windows came with each
    that no earlier batch had."""
    seen, fold = mark.get("seen") or {}, mark.get("fold") or ""
    live = _history_folders(spark, history_path, HISTORY_PARTITIONS)
    kept = _history_folders(spark, archive_path, ("window_date", "fold")) if archive_path else []
    news = {f["window_date"] for f in live if int(f["spark_batch_id"]) > seen.get(f["stream_run"], -1)}
    news |= {f["window_date"] for f in kept if f["fold"] > fold}
    columns = [*UTILIZATION_KEY, "processed_at", "stream_run", F.col("spark_batch_id").cast("long").alias("spark_batch_id")]
    frames = []
    for path, folders, own in ((history_path, live, F.lit("")), (archive_path, kept, F.col("fold").cast("string"))):
        if any(f["window_date"] in news for f in folders):
            days = [f"{path.rstrip('/')}/window_date={d}" for d in sorted(news) if any(f["window_date"] == d for f in folders)]
            frames.append(spark.read.option("basePath", path.rstrip("/")).parquet(*days).select(*columns, own.alias("fold")))
    if not frames:
        return spark.createDataFrame([], "t timestamp, new_rows long, stream_run string, spark_batch_id long, fold string")
    rows = functools.reduce(lambda a, b: a.unionByName(b), frames)
    # One entry per streaming run.
    old = F.create_map(*[F.lit(x) for pair in seen.items() for x in pair]) if seen else F.create_map().cast("map<string,long>")
    rows = rows.withColumn("new", F.col("spark_batch_id") > F.coalesce(F.try_element_at(old, F.col("stream_run")), F.lit(-1)))
    first = rows.groupBy(*UTILIZATION_KEY).agg(F.bool_and("new").alias("new"), F.min("processed_at").alias("t"))
    first = first.where("new").groupBy("t").agg(F.count(F.lit(1)).alias("new_rows"))
    batches = rows.where("new").groupBy("stream_run", "spark_batch_id").agg(F.max("processed_at").alias("t"), F.max("fold").alias("fold"))
    # Batches may share a stamp; its windows count once.
    batches = batches.withColumn("nth", F.row_number().over(Window.partitionBy("t").orderBy("stream_run", "spark_batch_id")))
    counted = F.when(F.col("nth") == 1, F.col("new_rows"))
    return batches.join(first, "t", "left").select("t", F.coalesce(counted, F.lit(0)).cast("long").alias("new_rows"), "stream_run", "spark_batch_id", "fold")


def _with_base(spark: SparkSession, stamps: DataFrame, mark: dict) -> DataFrame:
    """Stamps after the mark, and what the mark stands for as one more."""
    new = stamps.select("t", "new_rows")
    if mark.get("last_processed_at") is None:
        return new
    base = spark.range(1, numPartitions=1).select(
        F.lit(mark["last_processed_at"]).cast("timestamp").alias("t"), F.lit(mark["metric_rows"]).cast("long").alias("new_rows")
    )
    return new.unionByName(base).groupBy("t").agg(F.sum("new_rows").alias("new_rows"))


def _move_mark(spark: SparkSession, marks_path: str, mark: dict, reach, stamps: DataFrame, known: DataFrame, alerts: DataFrame) -> None:
    """Batches stamped by the last check are accounted for; later ones are left
    to the run that checks after them."""
    past = F.col("t") <= F.lit(reach)
    at = known.where(past).agg(F.max("t").alias("t"), F.coalesce(F.sum("new_rows"), F.lit(0)).alias("n")).first()
    # One row per streaming run, and per fold since the last mark.
    seen = dict(mark.get("seen") or {})
    seen |= {r[0]: r[1] for r in stamps.where(past).groupBy("stream_run").agg(F.max("spark_batch_id")).collect()}
    fold = mark.get("fold") or ""
    for r in stamps.where("fold != ''").groupBy("fold").agg(F.bool_and(past).alias("done")).orderBy("fold").collect():
        if not r["done"]:
            break
        fold = max(fold, r["fold"])
    last = alerts.orderBy(F.desc("created_at")).select("status").first()
    row = (reach, last["status"] if last else mark.get("status"), at["t"], at["n"], seen, fold)
    spark.createDataFrame([row], MARK).write.mode("append").parquet(marks_path)
