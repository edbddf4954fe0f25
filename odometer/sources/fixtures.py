"""Deterministic mapping of the driver's tables onto the fleet data model.

No fleet data ships with the test tables, so telemetry is derived from
``events`` and the daily expense feed from ``supplier``.  The same mapping
is written in SQL for the oracle (``odometer.plans.oracle_sql``); every literal
is cast to DOUBLE so both dialects compute in binary floating point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometer.functions.money import MONEY_DECIMAL
from odometer.functions.timeutil import as_instant, iso_text
from odometer.schemas import TELEMETRY_FIELDS

# Event type -> telemetry status (``error`` maps to a status
# outside the valid domain on purpose, so validation has work to do).
STATUS_BY_EVENT_TYPE = (
    ("view", "idle"),
    ("click", "enroute"),
    ("purchase", "on_trip"),
    ("signup", "on_trip"),
    ("error", "offline"),
)
FARE_EVENT_TYPES = ("purchase", "signup")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _status() -> F.Column:
    expr = None
    for event_type, status in STATUS_BY_EVENT_TYPE:
        cond = F.col("event_type") == F.lit(event_type)
        expr = F.when(cond, F.lit(status)) if expr is None else expr.when(cond, F.lit(status))
    return expr


def telemetry_rows(events: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """Typed telemetry (the parsed payload) plus ``event_time``.

    ``event_time`` comes straight from ``ts`` (a lossless NTZ -> instant
    cast under UTC); the ``timestamp`` text is what a producer would send.
    """
    k = _k()
    cols = [
        F.concat(F.lit("T"), (k % 2).cast("string")).alias("trip_id"),
        F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("driver_id"),
        F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"),
        ((F.lit(6800) + F.lit(3) * k).cast("double") / F.lit(1000).cast("double")).alias("lat"),
        (
            (F.lit(79780) + F.lit(2) * ((F.col("event_id") * F.lit(7)) % F.lit(100))).cast("double")
            / F.lit(1000).cast("double")
        ).alias("lon"),
        F.floor("value").cast("int").alias("speed"),
        _status().alias("status"),
        F.when(F.col("event_type").isin(*FARE_EVENT_TYPES), F.col("value"))
        .otherwise(F.lit(0).cast("double"))
        .alias("fare"),
        iso_text(as_instant("ts")).alias("timestamp"),
        as_instant("ts").alias("event_time"),
    ]
    if keep_event_id:
        cols = [F.col("event_id")] + cols
    return events.select(*cols)


def telemetry_json(events: DataFrame) -> DataFrame:
    """The producer's view: one JSON object per event in a binary ``value``."""
    rows = telemetry_rows(events).select(*TELEMETRY_FIELDS)
    from odometer.sources.telemetry import encode_telemetry

    return encode_telemetry(rows)


def expense_feed(supplier: DataFrame, report_dates: DataFrame) -> DataFrame:
    """One expense row per supplier-vehicle for every report date.

    ``report_dates`` holds the dates (column ``report_date``).  Their sorted
    distinct list is one scalar subquery - bounded by the calendar span, not
    by data volume - that every supplier row expands over, so no cross join
    is planned and the date source is read once.  Output is one row per
    vehicle-day, which is the feed itself.
    """
    dates = report_dates.agg(F.sort_array(F.collect_set("report_date")).alias("d")).select("d").scalar()
    return supplier.select(
        F.explode(dates).alias("report_date"),
        F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("vehicle_id"),
        F.round(F.abs("s_acctbal") / F.lit(100).cast("double"), 2).alias("fuel_cost"),
        (F.col("s_nationkey").cast("double") * F.lit(3.5).cast("double")).alias("maintenance_cost"),
        (F.lit(15) + (F.col("s_suppkey") * F.lit(37)) % F.lit(205)).cast("double").alias("distance_covered"),
        F.when(F.col("s_suppkey") % 8 == 0, F.lit("required")).otherwise(F.lit("not_required")).alias(
            "service_flag"
        ),
    )


VERSION_STEP_SECONDS = 100
VERSIONS = 3


def utilization_history(clean: DataFrame, exact_money: bool = True) -> DataFrame:
    """What an update-mode stream would have appended for each window/zone.

    A 5-minute window is observed in three processing steps of 100 s: version
    ``b`` (``spark_batch_id = b``) holds the aggregate over the window's rows
    with an in-window offset below ``(b+1)*100 s`` and is emitted only when
    step ``b`` brought new rows, stamped ``processed_at = window_start +
    (b+1)*100 s``.  One pass: rows are summed per window, zone and step, and
    only these partial sums are fanned out to the versions they belong to.
    """
    from odometer.operators.utilization import finish_utilization, status_counts

    window = F.window("event_time", "5 minutes").alias("window")
    offset = F.unix_micros("event_time") - F.unix_micros(F.window("event_time", "5 minutes").start)
    step = F.floor(offset / F.lit(VERSION_STEP_SECONDS * 1_000_000)).cast("int").alias("row_step")
    parts = clean.groupBy(window, "zone", step).agg(
        *status_counts(),
        F.sum(F.col("fare").cast(MONEY_DECIMAL) if exact_money else F.col("fare")).alias("fares"),
        F.sum("speed").alias("speeds"),
        F.count("speed").alias("speed_rows"),
    )
    counts = [c for c in parts.columns if c.endswith("_event_count")]
    fanned = parts.withColumn("spark_batch_id", F.explode(F.sequence(F.col("row_step"), F.lit(VERSIONS - 1))))
    versions = fanned.groupBy("window", "zone", "spark_batch_id").agg(
        *[F.sum(c).alias(c) for c in counts],
        F.sum("fares").cast("double").alias("observed_earnings"),
        (F.sum("speeds") / F.sum("speed_rows")).alias("average_speed"),
        F.max("row_step").alias("newest_step"),
    )
    # A version is written only when its own step brought rows.
    metrics = finish_utilization(versions.where(F.col("newest_step") == F.col("spark_batch_id")).drop("newest_step"))
    keep = [F.col(c) for c in metrics.columns if c != "spark_batch_id"]
    batch = F.col("spark_batch_id").cast("long")
    return metrics.select(
        *keep,
        batch.alias("spark_batch_id"),
        (
            F.col("window_start") + F.make_dt_interval(secs=(batch + 1) * F.lit(VERSION_STEP_SECONDS))
        ).alias("processed_at"),
    )


def dirty_telemetry_rows(events: DataFrame) -> DataFrame:
    """Telemetry in which every rule of the contract is broken somewhere, by
    event id; the rules are independent of each other."""
    rows = telemetry_rows(events, keep_event_id=True)

    def every(n: int) -> F.Column:
        return F.col("event_id") % n == 0

    late = F.when(~every(23), F.col("event_time"))
    return rows.select(
        F.when(~every(31), F.col("trip_id")).alias("trip_id"),
        "driver_id",
        F.when(every(13), F.concat(F.lit("X"), F.col("vehicle_id")))
        .when(~every(11), F.col("vehicle_id"))
        .alias("vehicle_id"),
        "lat",
        F.when(~every(37), F.col("lon")).alias("lon"),
        F.when(every(7), F.col("speed") + 200).when(every(29), F.lit(-1)).otherwise(F.col("speed")).alias("speed"),
        F.when(every(5), F.lit("parked")).otherwise(F.col("status")).alias("status"),
        F.when(every(17), F.lit(-1.0)).when(~every(19), F.col("fare")).alias("fare"),
        F.when(late.isNotNull(), F.col("timestamp")).otherwise(F.lit("not a time")).alias("timestamp"),
        late.alias("event_time"),
    )


def dirty_expense_feed(feed: DataFrame) -> DataFrame:
    """A feed in which every rule is broken somewhere, by vehicle number, with
    the CSV's own date beside the file's."""
    number = F.substring("vehicle_id", 2, 20).cast("long")

    def every(n: int) -> F.Column:
        return number % n == 0

    copies = F.when(every(5), F.array_repeat(F.lit(1), 2)).otherwise(F.array(F.lit(1)))
    return feed.select(
        "report_date",
        F.when(every(7), F.concat(F.lit("U"), number.cast("string"))).otherwise(F.col("vehicle_id")).alias("vehicle_id"),
        F.when(every(3), F.lit(0.0)).when(every(8), F.lit(None)).otherwise(F.col("fuel_cost")).alias("fuel_cost"),
        F.when(every(9), F.lit(-1.0)).otherwise(F.col("maintenance_cost")).alias("maintenance_cost"),
        "distance_covered",
        F.when(every(4), F.lit("maybe")).otherwise(F.col("service_flag")).alias("service_flag"),
        F.when(every(6), F.lit("2000-01-01")).otherwise(F.col("report_date").cast("string")).alias("csv_report_date"),
        F.explode(copies).alias("copy"),
    ).drop("copy")
