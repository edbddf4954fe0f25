"""Serving tables as SQL views, under the names and column types of the
serving store, so existing serving SQL runs on Spark SQL unchanged."""

from __future__ import annotations

from pyspark.sql import SparkSession

from odometer.operators.serving import conform_report, conform_utilization

# The serving store's table names.
UTILIZATION_VIEW = "fleet_utilization_metrics"
REPORT_VIEW = "daily_vehicle_profitability"
ALERTS_VIEW = "pipeline_alerts"


def register_serving_views(
    spark: SparkSession,
    utilization_path: str | None = None,
    report_path: str | None = None,
    alerts_path: str | None = None,
) -> list[str]:
    """Register temp views over the lake's serving tables (NUMERIC columns as
    DECIMAL, counts as INT).  Reads stay lazy: a query on a view prunes
    partitions and columns of the Parquet behind it."""
    names = []
    if utilization_path:
        conform_utilization(spark.read.parquet(utilization_path)).createOrReplaceTempView(UTILIZATION_VIEW)
        names.append(UTILIZATION_VIEW)
    if report_path:
        conform_report(spark.read.parquet(report_path)).createOrReplaceTempView(REPORT_VIEW)
        names.append(REPORT_VIEW)
    if alerts_path:
        spark.read.parquet(alerts_path).createOrReplaceTempView(ALERTS_VIEW)
        names.append(ALERTS_VIEW)
    return names
