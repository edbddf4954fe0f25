"""Serving tables: keep-latest views, keyed merges, conformance, point reads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odometer.functions.money import to_decimal
from odometer.functions.timeutil import ts_literal
from odometer.schemas import (
    REPORT_COLUMNS,
    REPORT_KEY,
    SERVING_REPORT_NOT_NULL,
    SERVING_REPORT_TYPES,
    SERVING_UTILIZATION_NOT_NULL,
    SERVING_UTILIZATION_TYPES,
    UTILIZATION_COLUMNS,
    UTILIZATION_KEY,
)

# Fixed value: permitted pattern of the zone argument of the newest-window read.
ZONE_ARGUMENT_PATTERN = r"^colombo_|^outside_service_area$"


def _pick_latest(df: DataFrame, key, order_cols, payload_cols) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols`` tuple.

    ``max_by`` over a struct is an aggregate with map-side partial
    aggregation: a key holding a third of the rows is reduced to one row per
    task before the shuffle.  (Its variable-width buffer makes Spark run it
    sort-based rather than hash-based; a ``row_number()`` window instead would
    shuffle every row and sort a hot key inside one task.)
    """
    payload = F.struct(*[F.col(c) for c in payload_cols])
    order = F.struct(*[F.col(c) for c in order_cols])
    picked = df.groupBy(*key).agg(F.max_by(payload, order).alias("_row"))
    return picked.select(*[F.col(c) for c in key], *[F.col("_row")[c].alias(c) for c in payload_cols if c not in key])


def latest_per_key(history: DataFrame, key=UTILIZATION_KEY) -> DataFrame:
    """Newest version per (window_start, window_end, zone) of an append-only
    metrics history: greatest ``processed_at``, then greatest batch id."""
    payload = [c for c in history.columns if c not in key]
    return _pick_latest(history, list(key), ["processed_at", "spark_batch_id"], payload)


def upsert_utilization(target: DataFrame, incoming: DataFrame, key=UTILIZATION_KEY) -> DataFrame:
    """Guarded keyed merge: an incoming row replaces the stored one only if its
    ``processed_at`` is not older; on equal time the incoming row wins.

    Several incoming rows for one key apply as if in batch-id order.  Keys
    absent from the batch keep their stored row.
    """
    cols = [c for c in target.columns]
    both = target.select(*cols).withColumn("_incoming", F.lit(0)).unionByName(
        incoming.select(*cols).withColumn("_incoming", F.lit(1))
    )
    payload = [c for c in cols if c not in key]
    return _pick_latest(both, list(key), ["processed_at", "_incoming", "spark_batch_id"], payload)


def upsert_profitability(target: DataFrame, incoming: DataFrame, updated_at, key=REPORT_KEY) -> DataFrame:
    """Unguarded keyed merge (last writer wins) with ``updated_at`` stamped on
    replaced rows.  Vehicles missing from the batch survive - unlike a
    partition overwrite, which would lose them.

    Spark rows have no arrival order, so duplicate incoming keys are settled
    deterministically by the greatest row value.
    """
    cols = list(REPORT_COLUMNS)
    stamped = incoming.select(*cols).withColumn("updated_at", ts_literal(updated_at))
    if "updated_at" not in target.columns:
        raise ValueError("target must carry updated_at")
    both = target.select(*cols, "updated_at").withColumn("_incoming", F.lit(0)).unionByName(
        stamped.withColumn("_incoming", F.lit(1))
    )
    payload = [c for c in cols + ["updated_at"] if c not in key]
    tie = [c for c in payload]
    return _pick_latest(both, list(key), ["_incoming", *tie], payload)


def normalize_utilization_payload(df: DataFrame) -> DataFrame:
    """Payload normalisation before a serving write: null earnings, speed and
    ratio become 0.0, counts become int (so speed becomes 0, not NULL)."""
    out = df
    for c in ("telemetry_event_count", "idle_event_count", "on_trip_event_count", "active_event_count"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("int"))
    for c in ("observed_earnings", "average_speed", "idle_ratio"):
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    return out


def conform_column(name: str, dtype) -> F.Column:
    """A column in its serving type; doubles go to DECIMAL with HALF_UP, and a
    value that the type can't hold becomes NULL."""
    if dtype.typeName() == "decimal":
        return to_decimal(name, dtype.precision, dtype.scale)
    return F.col(name).try_cast(dtype)


def conform(df: DataFrame, types: dict) -> DataFrame:
    """The serving columns in their types.  Writers check that no value was
    lost (``odometer.sinks.merge.split_by_constraints``)."""
    return df.select(*[conform_column(c, t).alias(c) for c, t in types.items() if c in df.columns])


def conform_utilization(df: DataFrame) -> DataFrame:
    return conform(normalize_utilization_payload(df), SERVING_UTILIZATION_TYPES)


def conform_report(df: DataFrame) -> DataFrame:
    return conform(df, SERVING_REPORT_TYPES)


def violations(df: DataFrame, key, not_null) -> DataFrame:
    """Constraint check as one aggregate row: rows, rows sharing a key with
    another row, and per NOT NULL column the number of nulls."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null if c in df.columns
    ])
    return per_key.agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_key_rows"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in not_null if c in df.columns],
    )


def utilization_violations(df: DataFrame) -> DataFrame:
    return violations(df, UTILIZATION_KEY, SERVING_UTILIZATION_NOT_NULL)


def report_violations(df: DataFrame) -> DataFrame:
    return violations(df, REPORT_KEY, SERVING_REPORT_NOT_NULL)


def check_zone_argument(zone: str | None) -> None:
    if zone is not None and not re.search(ZONE_ARGUMENT_PATTERN, zone):
        raise ValueError(f"zone {zone!r} does not match {ZONE_ARGUMENT_PATTERN}")


def latest_window(serving: DataFrame, zone: str | None = None, closed_before=None) -> DataFrame:
    """All zones of the newest window (largest ``window_end``), by zone.

    The newest window is found by an uncorrelated scalar subquery (run
    once); the zone argument filters rows but never changes which window is
    newest.  ``closed_before`` restricts the choice to windows ending at or
    before that time.  ``metric_window_count`` is the number of rows.
    """
    check_zone_argument(zone)
    candidates = serving
    if closed_before is not None:
        candidates = candidates.where(F.col("window_end") <= ts_literal(closed_before))
    if "window_date" in serving.columns:
        # On the date-partitioned serving table the newest window lies in the
        # newest date partition: find it from the partition column, then
        # read only that day (the subquery becomes a partition filter).
        newest_day = candidates.agg(F.max("window_date").alias("d")).select("d").scalar()
        candidates = candidates.where(F.col("window_date") == newest_day)
        serving = serving.where(F.col("window_date") == newest_day)
    newest = candidates.agg(F.max("window_end").alias("w")).select("w").scalar()
    rows = serving.where(F.col("window_end") == newest)
    if zone is not None:
        rows = rows.where(F.col("zone") == F.lit(zone))
    cols = [c for c in UTILIZATION_COLUMNS if c in rows.columns] + ["processed_at"]
    count = rows.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return rows.select(*cols, count.alias("metric_window_count")).orderBy("zone")
