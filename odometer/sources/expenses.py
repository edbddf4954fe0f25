"""Daily expense feed scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometer.schemas import EXPENSE_CSV_SCHEMA, EXPENSE_FIELDS

# Fixed value: the feed file name pattern, ``vehicle_expenses_<date>.csv``.
FEED_NAME_PATTERN = r"vehicle_expenses_(\d{4}-\d{2}-\d{2})\.csv"


def feed_date_from_path(path_col: F.Column) -> F.Column:
    """Logical date taken from the file (or folder) name of the feed."""
    return F.try_to_date(F.regexp_extract(path_col, FEED_NAME_PATTERN, 1), "yyyy-MM-dd")


#: Columns read as amounts; text that is no number becomes null.
AMOUNTS = ("fuel_cost", "maintenance_cost", "distance_covered")


def type_expenses(df: DataFrame) -> DataFrame:
    """The feed's columns typed in one projection, for rows that name a vehicle."""
    typed = [F.col(c).try_cast("double").alias(c) if c in AMOUNTS else F.col(c) for c in df.columns]
    return df.select(*typed).where("vehicle_id is not null")


def expense_feed_text(feed: DataFrame) -> DataFrame:
    """The feed as its CSV holds it: every column as text."""
    return feed.select(*[F.col(c).cast("string").alias(c) for c in EXPENSE_FIELDS])


def _shape_feed(raw: DataFrame, report_date: str | None) -> DataFrame:
    raw = raw.withColumn("feed_date", feed_date_from_path(F.col("_metadata.file_path")))
    typed = type_expenses(raw).withColumnRenamed("report_date", "csv_report_date")
    label = F.lit(report_date).cast("date") if report_date is not None else F.col("feed_date")
    return typed.select(
        label.alias("report_date"),
        "vehicle_id",
        "fuel_cost",
        "maintenance_cost",
        "distance_covered",
        "service_flag",
        "csv_report_date",
    )


def read_expense_feed(
    spark: SparkSession, path: str, report_date: str | None = None, dates: list | None = None
) -> DataFrame:
    """Scan one or many daily feeds (file, folder or glob).

    The header is honoured and no schema inference job is run.  With
    ``report_date`` (single-date mode) every row is labelled with that date,
    whatever the file says.  Otherwise ``report_date`` is the date in the
    file name; the CSV's own column is kept as ``csv_report_date``.
    ``dates`` keeps the files of these dates only.
    """
    raw = (
        spark.read.schema(EXPENSE_CSV_SCHEMA)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    if dates is not None:
        raw = raw.where(feed_date_from_path(F.col("_metadata.file_path")).isin(dates))
    return _shape_feed(raw, report_date)


def read_expense_feed_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same feed as a stream of newly published files; the file source's
    checkpoint records which files were consumed, so each is read once."""
    reader = spark.readStream.schema(EXPENSE_CSV_SCHEMA).option("header", True).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _shape_feed(reader.csv(path), None)
