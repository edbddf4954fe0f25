"""Freshness status, alert transitions and gauges, as DataFrame operations."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odometer.functions.timeutil import ts_literal
from odometer.schemas import UTILIZATION_KEY
from odometer.session import materialize

LOG = logging.getLogger("odometer.health")

# The freshness rule's texts, severities and defaults.
DEFAULT_THRESHOLD_SECONDS = 120
RULE_NAME = "no_telemetry_processed"
REASON_NEVER = "No telemetry metrics have been processed yet."
REASON_STALE_PREFIX = "No telemetry processed for "
REASON_STALE_SUFFIX = " seconds."
REASON_CURRENT = "Telemetry is current."
REASON_UNAVAILABLE = "Serving database is unavailable."
SEVERITY_BY_STATUS = (("healthy", "info"), ("degraded", "warning"), ("unhealthy", "critical"))
GAUGE_METRIC_ROWS = "fleet_serving_metric_rows"
GAUGE_AGE = "fleet_last_telemetry_age_seconds"
GAUGE_HELP = (
    (GAUGE_METRIC_ROWS, "Number of upserted utilization rows."),
    (GAUGE_AGE, "Age of newest processed metric; -1 means absent."),
)


def health_snapshot(serving: DataFrame, report: DataFrame) -> DataFrame:
    """One row: newest ``processed_at`` and row count of the metrics table,
    and the row count of the report table (a scalar subquery, no join)."""
    report_rows = report.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return serving.agg(
        F.max("processed_at").alias("last_processed_at"),
        F.count(F.lit(1)).alias("metric_rows"),
    ).withColumn("profitability_rows", report_rows)


def age_seconds(now: F.Column, last: F.Column) -> F.Column:
    """Whole seconds from ``last`` to ``now``; never negative; NULL if never."""
    diff = F.floor((F.unix_micros(now.cast("timestamp")) - F.unix_micros(last.cast("timestamp"))) / F.lit(1000000))
    return F.when(last.isNull(), F.lit(None).cast("long")).otherwise(F.greatest(F.lit(0).cast("long"), diff))


def health_columns(df: DataFrame, now: F.Column, threshold_seconds: int = DEFAULT_THRESHOLD_SECONDS) -> DataFrame:
    """Add ``status``, ``reason`` and ``age_seconds`` from ``last_processed_at``.

    Degraded when nothing was ever processed; unhealthy when the age is
    strictly above the threshold; healthy otherwise (a future timestamp has
    age 0).
    """
    age = age_seconds(now, F.col("last_processed_at"))
    df = df.withColumn("age_seconds", age)
    status = (
        F.when(F.col("last_processed_at").isNull(), F.lit("degraded"))
        .when(F.col("age_seconds") > F.lit(threshold_seconds), F.lit("unhealthy"))
        .otherwise(F.lit("healthy"))
    )
    reason = (
        F.when(F.col("status") == "degraded", F.lit(REASON_NEVER))
        .when(
            F.col("status") == "unhealthy",
            F.concat(F.lit(REASON_STALE_PREFIX), F.col("age_seconds").cast("string"), F.lit(REASON_STALE_SUFFIX)),
        )
        .otherwise(F.lit(REASON_CURRENT))
    )
    return df.withColumn("status", status).withColumn("reason", reason)


def severity(status: F.Column | str = "status") -> F.Column:
    status = F.col(status) if isinstance(status, str) else status
    expr = None
    for name, level in SEVERITY_BY_STATUS:
        expr = F.when(status == name, F.lit(level)) if expr is None else expr.when(status == name, F.lit(level))
    return expr


def health_status(snapshot: DataFrame, now=None, threshold_seconds: int = DEFAULT_THRESHOLD_SECONDS) -> DataFrame:
    """The health answer for one check time ``now`` (default: the query's
    current time, one value for the whole query)."""
    now_col = F.current_timestamp() if now is None else ts_literal(now)
    out = health_columns(snapshot, now_col, threshold_seconds)
    return out.withColumn("no_data_alert_seconds", F.lit(threshold_seconds)).withColumn("checked_at", now_col)


def check_grid(serving: DataFrame, every_minutes: int = 2) -> DataFrame:
    """Check times every ``every_minutes`` over the calendar days the metrics
    span.  Days are generated first and spread over partitions; each day then
    expands to its own checks, so no task holds the whole grid."""
    if (24 * 60) % every_minutes:
        raise ValueError("check interval must divide a day")
    bounds = serving.agg(
        F.to_date(F.min("processed_at")).alias("lo"), F.to_date(F.max("processed_at")).alias("hi")
    )
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    per_day = (24 * 60) // every_minutes
    return (
        days.repartition("day")
        .select(
            F.explode(F.sequence(F.lit(0), F.lit(per_day - 1))).alias("k"),
            "day",
        )
        .select(
            (F.col("day").cast("timestamp") + F.make_dt_interval(mins=F.col("k") * F.lit(every_minutes))).alias(
                "check_time"
            )
        )
    )


def _range_parts(spark, partitions: int | None) -> int:
    return partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))


def _stamps(history: DataFrame) -> DataFrame:
    """Distinct ``processed_at`` (t) of a metrics history, and how many serving
    rows (distinct keys) appeared with each."""
    if all(c in history.columns for c in UTILIZATION_KEY):
        first = history.groupBy(*UTILIZATION_KEY).agg(F.min("processed_at").alias("t"))
        seen = history.select(F.col("processed_at").alias("t"), F.lit(0).alias("new_rows"))
        seen = seen.unionByName(first.select("t", F.lit(1).alias("new_rows")))
    else:
        seen = history.select(F.col("processed_at").alias("t"), F.lit(None).cast("int").alias("new_rows"))
    return seen.where("t is not null").groupBy("t").agg(F.sum("new_rows").alias("new_rows"))


def as_of_last_processed(
    checks: DataFrame, history: DataFrame | None, partitions: int | None = None, stamps: DataFrame | None = None
) -> DataFrame:
    """For every check time t: the newest ``processed_at <= t`` of the metrics
    history (all versions that were ever written; in a keep-latest table a
    window that is written again has lost its earlier stamps), and
    ``metric_rows``, the serving rows that there were at t (null where the
    history has no window keys).  ``stamps`` (t, new_rows: serving rows that
    appeared with it) stands for the history where these are known.

    A distributed prefix maximum that no time distribution can skew.
    Checks and de-duplicated stamps are unioned and range-partitioned on
    (time, kind) - stamps sort before checks at equal times - so every task
    holds a contiguous, sampled-to-balance slice of the timeline.  Each
    task takes a running maximum over its slice; the maximum of all earlier
    slices is carried in from a table with one row per range partition.
    """
    n = _range_parts(checks.sparkSession, partitions)
    timeline = checks.select(
        F.col("check_time").alias("t"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("new_rows")
    ).unionByName((_stamps(history) if stamps is None else stamps).select("t", F.lit(0).alias("kind"), "new_rows"))
    # Pin each row's slice once: range bounds are sampled from row order,
    # which an upstream shuffle does not fix, so every reader of the slices
    # must read the same materialized assignment.
    ranged = materialize(timeline.repartitionByRange(n, "t", "kind").withColumn("_part", F.spark_partition_id()))
    stamp = F.when(F.col("kind") == 0, F.col("t"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ranged.groupBy("_part")
        .agg(F.max(stamp).alias("_part_max"), F.sum("new_rows").alias("_part_rows"))
        .select(
            "_part",
            F.max("_part_max").over(earlier).alias("carry_in"),
            F.coalesce(F.sum("_part_rows").over(earlier), F.lit(0)).alias("carry_rows"),
        )
    )
    in_part = Window.partitionBy("_part").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    counted = stamps is not None or all(c in history.columns for c in UTILIZATION_KEY)
    return (
        ranged.withColumn("run_max", F.max(stamp).over(in_part))
        .withColumn("run_rows", F.sum("new_rows").over(in_part))
        .where(F.col("kind") == 1)
        .join(carry, "_part", "left")
        .select(
            "_part",
            F.col("t").alias("check_time"),
            F.greatest("run_max", "carry_in").alias("last_processed_at"),
            F.when(F.lit(counted), F.col("run_rows") + F.col("carry_rows")).alias("metric_rows"),
        )
    )


def health_transitions(
    checks: DataFrame,
    history: DataFrame | None,
    threshold_seconds: int = DEFAULT_THRESHOLD_SECONDS,
    with_context: bool = True,
    initial_status: F.Column | str | None = None,
    partitions: int | None = None,
    profitability_rows: F.Column | None = None,
    stamps: DataFrame | None = None,
) -> DataFrame:
    """Alert rows: one per check whose status differs from the previous
    check's.  The first check alerts unless ``initial_status`` (the status
    last recorded, e.g. by a previous run) equals it.  ``history`` is the
    metrics history, every version; ``profitability_rows`` (a scalar, e.g. a
    subquery) goes into the context; ``stamps`` as in ``as_of_last_processed``.

    The previous status is a ``lag`` within each range partition of the
    timeline; the first check of a partition takes the last status of the
    nearest earlier partition that has checks, from a one-row-per-partition
    table.
    """
    asof = as_of_last_processed(checks, history, partitions, stamps)
    st = health_columns(asof, F.col("check_time"), threshold_seconds)
    part_last = st.groupBy("_part").agg(F.max_by("status", "check_time").alias("last_status"))
    prev_part = part_last.select(
        "_part",
        F.last("last_status", ignorenulls=True)
        .over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
        .alias("prev_part_status"),
    )
    w = Window.partitionBy("_part").orderBy("check_time")
    initial = (
        F.lit(initial_status)
        if isinstance(initial_status, str)
        else (initial_status if initial_status is not None else F.lit(None).cast("string"))
    )
    flagged = (
        st.withColumn("prev_status", F.lag("status").over(w))
        .join(prev_part, "_part", "left")
        .withColumn("prev_status", F.coalesce("prev_status", "prev_part_status", initial))
        .where(F.col("prev_status").isNull() | (F.col("status") != F.col("prev_status")))
    )
    out = flagged.select(
        F.col("check_time").alias("created_at"),
        severity("status").alias("severity"),
        F.lit(RULE_NAME).alias("rule_name"),
        F.col("reason").alias("message"),
        "status",
        "age_seconds",
        "last_processed_at",
        "metric_rows",
    )
    if with_context:
        out = out.withColumn("context", alert_context(threshold_seconds, profitability_rows))
    return out.drop("metric_rows")


def alert_context(threshold_seconds: int, profitability_rows: F.Column | None = None) -> F.Column:
    """JSON of the whole health answer behind an alert; times in full precision
    with their UTC offset, nulls written as ``null``."""
    reports = F.lit(None) if profitability_rows is None else profitability_rows
    return F.to_json(
        F.struct(
            "status",
            F.col("message").alias("reason"),
            "age_seconds",
            F.date_format("last_processed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("last_processed_at"),
            "metric_rows",
            reports.cast("long").alias("profitability_rows"),
            F.lit(threshold_seconds).alias("no_data_alert_seconds"),
        ),
        {"ignoreNullFields": "false"},
    )


def gauges(snapshot: DataFrame, now=None, threshold_seconds: int = DEFAULT_THRESHOLD_SECONDS) -> DataFrame:
    """(name, value) gauge rows: metric rows, and telemetry age (-1 if absent)."""
    status = health_status(snapshot, now, threshold_seconds)
    return status.select(
        F.stack(
            F.lit(2),
            F.lit(GAUGE_METRIC_ROWS),
            F.col("metric_rows").cast("long"),
            F.lit(GAUGE_AGE),
            F.coalesce(F.col("age_seconds"), F.lit(-1)).cast("long"),
        ).alias("name", "value")
    )


def _or_when_unreadable(spark, build, schema: str, otherwise: list) -> DataFrame:
    """``build()``'s rows, read now: a missing table fails at analysis, but a
    corrupt or vanished file only when it is read, and both must be answered.
    The answer is a handful of rows."""
    from py4j.protocol import Py4JError
    from pyspark.errors import PySparkException

    try:
        df = build()
        rows, shape = df.collect(), df.schema
    except (PySparkException, Py4JError, OSError) as err:
        LOG.warning("serving tables can't be read: %s", str(err)[:500])
        return spark.createDataFrame(otherwise, schema)
    return spark.createDataFrame(rows, shape)


def gauges_or_absent(spark, build) -> DataFrame:
    """Gauges from ``build()``, or 0 rows / age -1 when the source can't be read."""
    return _or_when_unreadable(spark, build, "name string, value long", [(GAUGE_METRIC_ROWS, 0), (GAUGE_AGE, -1)])


def health_or_unavailable(spark, build) -> DataFrame:
    """The health answer from ``build()``, or ``unhealthy`` with a fixed reason
    when the serving tables can't be read."""
    return _or_when_unreadable(spark, build, "status string, reason string", [("unhealthy", REASON_UNAVAILABLE)])


def exposition_text(gauge_rows: DataFrame) -> DataFrame:
    """Gauge rows as text exposition lines (HELP, TYPE, sample per gauge)."""
    help_rows = gauge_rows.sparkSession.createDataFrame(list(GAUGE_HELP), "name string, help string")
    joined = gauge_rows.join(help_rows, "name", "left")
    lines = joined.select(
        "name",
        F.array(
            F.concat(F.lit("# HELP "), F.col("name"), F.lit(" "), F.col("help")),
            F.concat(F.lit("# TYPE "), F.col("name"), F.lit(" gauge")),
            F.concat(F.col("name"), F.lit(" "), F.col("value").cast("string")),
        ).alias("lines"),
    )
    return lines.select("name", F.posexplode("lines").alias("line_no", "value"))
