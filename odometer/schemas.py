"""Schemas of every relation the library reads or writes."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The telemetry status domain and the service-flag domain.
STATUS_DOMAIN = ("idle", "enroute", "on_trip")
SERVICE_FLAGS = ("required", "not_required")

# The fields of a telemetry event, in payload order.
TELEMETRY_FIELDS = (
    "trip_id",
    "driver_id",
    "vehicle_id",
    "lat",
    "lon",
    "speed",
    "status",
    "fare",
    "timestamp",
)

# JSON payload of one telemetry event.  ``from_json`` makes every field
# nullable whatever is declared, so the schema says so honestly.
TELEMETRY_JSON_SCHEMA = StructType(
    [
        StructField("trip_id", StringType(), True),
        StructField("driver_id", StringType(), True),
        StructField("vehicle_id", StringType(), True),
        StructField("lat", DoubleType(), True),
        StructField("lon", DoubleType(), True),
        StructField("speed", IntegerType(), True),
        StructField("status", StringType(), True),
        StructField("fare", DoubleType(), True),
        StructField("timestamp", StringType(), True),
    ]
)

# The columns of the daily expense CSV.  Every column is read as text and typed afterwards.
EXPENSE_FIELDS = (
    "report_date",
    "vehicle_id",
    "fuel_cost",
    "maintenance_cost",
    "distance_covered",
    "service_flag",
)
EXPENSE_CSV_SCHEMA = StructType([StructField(c, StringType(), True) for c in EXPENSE_FIELDS])

# Keys and columns of the metrics and of the report.
UTILIZATION_KEY = ("window_start", "window_end", "zone")
UTILIZATION_COLUMNS = (
    "zone",
    "telemetry_event_count",
    "idle_event_count",
    "on_trip_event_count",
    "active_event_count",
    "observed_earnings",
    "average_speed",
    "window_start",
    "window_end",
    "idle_ratio",
)

REPORT_KEY = ("report_date", "vehicle_id")
REPORT_COLUMNS = (
    "report_date",
    "vehicle_id",
    "completed_trip_count",
    "trip_revenue",
    "fuel_cost",
    "maintenance_cost",
    "total_expense",
    "distance_covered",
    "service_flag",
    "profit",
    "profit_margin_pct",
    "profitability_status",
)

# Serving-store column types (NUMERIC(p,s) -> DecimalType(p,s)).
SERVING_UTILIZATION_TYPES = {
    "window_start": TimestampType(),
    "window_end": TimestampType(),
    "zone": StringType(),
    "telemetry_event_count": IntegerType(),
    "idle_event_count": IntegerType(),
    "on_trip_event_count": IntegerType(),
    "active_event_count": IntegerType(),
    "observed_earnings": DecimalType(14, 2),
    "average_speed": DecimalType(8, 2),
    "idle_ratio": DecimalType(7, 4),
    "spark_batch_id": LongType(),
    "processed_at": TimestampType(),
}
SERVING_UTILIZATION_NOT_NULL = tuple(c for c in SERVING_UTILIZATION_TYPES if c != "average_speed")

SERVING_REPORT_TYPES = {
    "report_date": DateType(),
    "vehicle_id": StringType(),
    "completed_trip_count": IntegerType(),
    "trip_revenue": DecimalType(14, 2),
    "fuel_cost": DecimalType(14, 2),
    "maintenance_cost": DecimalType(14, 2),
    "total_expense": DecimalType(14, 2),
    "distance_covered": DecimalType(12, 2),
    "service_flag": StringType(),
    "profit": DecimalType(14, 2),
    "profit_margin_pct": DecimalType(8, 2),
    "profitability_status": StringType(),
    "updated_at": TimestampType(),
}
SERVING_REPORT_NOT_NULL = tuple(c for c in SERVING_REPORT_TYPES if c != "profit_margin_pct")
