"""Batch sinks: report tables, per-date CSV files, the expense feed, alerts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odometer import hadoop
from odometer.sources.expenses import expense_feed_text


def write_report_parquet(report: DataFrame, path: str) -> None:
    """Replace exactly the ``report_date`` partitions present in ``report``."""
    (
        report.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_date")
        .parquet(path)
    )


def write_report_csv(report: DataFrame, path: str) -> None:
    """Headered CSV per date (folder ``csv_date=<date>``, all report columns
    inside), in report order, replacing only those dates.

    Rows are range-partitioned on (date, profit, vehicle) and sorted within
    each task with the partition column leading (so the writer does not
    re-sort).  A normal date lands in one task and becomes one file; a date
    too big for one task is split over several, and because part files are
    numbered in range order, reading a date's files in name order gives the
    report order.  No task has to hold a whole hot date.
    """
    order = [F.col("csv_date"), F.col("profit").asc_nulls_first(), F.col("vehicle_id")]
    (
        report.withColumn("csv_date", F.col("report_date"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("csv_date")
        .csv(path)
    )


def feed_file_name(report_date: F.Column) -> F.Column:
    return F.concat(F.lit("vehicle_expenses_"), report_date.cast("string"), F.lit(".csv"))


CLAIMS = "_claims"


def write_expense_feed(feed: DataFrame, path: str, overwrite: bool = False) -> None:
    """Publish daily feeds under ``<path>/feed_file=vehicle_expenses_<date>.csv/``.

    A date is claimed before anything is written, by a file that only one
    publication can create; a date that is published or claimed is refused unless
    ``overwrite=True``.  The feeds are written aside, and each date's folder
    appears by one rename, so no reader and no failure ever meets half a feed.  A
    publication that fails gives its claims back.  One that was killed leaves
    them: see ``abandoned_claims``.

    With overwrite only the dates being written are replaced.
    """
    spark, root = feed.sparkSession, path.rstrip("/")
    text = expense_feed_text(feed).withColumn("feed_file", feed_file_name(F.col("report_date")))
    if overwrite:
        _write_feeds(text, root, "overwrite")
        return
    # One name per date: bounded by the calendar.
    dates = sorted(r[0] for r in text.select("feed_file").distinct().collect())
    claimed: list[str] = []
    aside = f"{root}/_publishing-{uuid.uuid4().hex}"
    try:
        for date in dates:
            if hadoop.matches(spark, f"{root}/feed_file={date}") or not hadoop.claim(spark, f"{root}/{CLAIMS}/{date}"):
                raise FileExistsError(f"an expense feed {date} already exists or is being published under {path}")
            claimed.append(date)
        _write_feeds(text, aside, "errorifexists")
        for date in dates:
            if not hadoop.move_new(spark, f"{aside}/feed_file={date}", f"{root}/feed_file={date}"):
                raise FileExistsError(f"an expense feed {date} already exists under {path}")
            claimed.remove(date)
    finally:
        for date in claimed:
            hadoop.remove(spark, f"{root}/{CLAIMS}/{date}")
        hadoop.remove(spark, aside)


def _write_feeds(text: DataFrame, path: str, mode: str) -> None:
    (
        text.repartitionByRange("feed_file", "vehicle_id")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("feed_file")
        .csv(path)
    )


def abandoned_claims(spark, path: str) -> list[str]:
    """Feeds that are claimed but not published: of a publication that runs, or
    of one that was killed."""
    root = path.rstrip("/")
    return [d for d in hadoop.names(spark, f"{root}/{CLAIMS}") if not hadoop.matches(spark, f"{root}/feed_file={d}")]


def release_claims(spark, path: str, dates: list[str]) -> None:
    """Give back claims of publications that are known to be dead."""
    for date in dates:
        hadoop.remove(spark, f"{path.rstrip('/')}/{CLAIMS}/{date}")


def append_alerts(alerts: DataFrame, path: str, since: str) -> None:
    """Add alert rows (with their JSON context) to the alert log, in the
    partition of the check ``since`` which they were sought: a run that is
    repeated from there replaces its rows."""
    (
        alerts.withColumn("since", F.lit(since))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("since")
        .parquet(path)
    )


def write_gauges_text(exposition: DataFrame, path: str) -> None:
    """Write exposition lines as a text file (a handful of rows)."""
    exposition.orderBy("name", "line_no").select("value").coalesce(1).write.mode("overwrite").text(path)
