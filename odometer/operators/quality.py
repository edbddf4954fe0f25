"""Data-quality checks of the daily expense feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odometer.schemas import SERVICE_FLAGS


def expense_feed_checks(feed: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Per feed date: rows, duplicated vehicle rows, rows of unknown vehicles,
    known vehicles with no row (missing), and rule violations (fuel > 0,
    maintenance >= 0, flag in domain, feed date equal to the CSV's date when
    that column is present).

    No cross product of vehicles x dates is built: "missing" is the fleet
    size (a scalar subquery) minus the known vehicles seen that day.
    """
    dim = vehicles.select("vehicle_id").distinct().withColumn("_known", F.lit(True))
    fleet_size = dim.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    if "csv_report_date" in feed.columns:
        mismatch = F.coalesce(F.col("csv_report_date").try_cast("date") != F.col("report_date"), F.lit(True))
    else:
        mismatch = F.lit(False)
    per_vehicle = (
        feed.join(dim, "vehicle_id", "left")
        .groupBy("report_date", "vehicle_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("_known").alias("known"),
            F.count_if(F.coalesce(F.col("fuel_cost") <= F.lit(0), F.lit(True))).alias("bad_fuel"),
            F.count_if(F.coalesce(F.col("maintenance_cost") < F.lit(0), F.lit(True))).alias("bad_maintenance"),
            F.count_if(~F.coalesce(F.col("service_flag").isin(*SERVICE_FLAGS), F.lit(False))).alias("bad_flag"),
            F.count_if(mismatch).alias("date_mismatch"),
        )
    )
    return per_vehicle.groupBy("report_date").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0).cast("long")).alias("duplicate_vehicle_rows"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0).cast("long")).alias(
            "unknown_vehicle_rows"
        ),
        (fleet_size - F.count_if(F.col("known"))).alias("missing_vehicles"),
        F.sum("bad_fuel").alias("bad_fuel_rows"),
        F.sum("bad_maintenance").alias("bad_maintenance_rows"),
        F.sum("bad_flag").alias("bad_flag_rows"),
        F.sum("date_mismatch").alias("date_mismatch_rows"),
    )
