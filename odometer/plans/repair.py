"""Late-data repair: what the live path dropped, put right from the lake.

The metrics stream drops rows that come after their window closed; the clean lake
keeps them.  ``repair_late_windows`` finds the windows that rows ingested since
the last repair fall into, computes these windows again from the lake, compares
them with the serving table, and merges those that differ.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometer import hadoop
from odometer.functions.timeutil import ts_literal
from odometer.operators.serving import conform_utilization
from odometer.operators.utilization import WATERMARK, WINDOW, utilization_metrics
from odometer.schemas import UTILIZATION_COLUMNS, UTILIZATION_KEY
from odometer.session import ensure_utc, materialize, stored_or_none
from odometer.sinks.merge import serve_utilization
from odometer.sinks.versions import VersionedTable, partition_values

#: Batch id of a window that only a repair has written.
REPAIR_BATCH = -1


def _last_mark(spark: SparkSession, marks_path: str) -> tuple[int, int | None]:
    """(number of repairs, ingest time in epoch microseconds they reach to)."""
    done = hadoop.names(spark, marks_path)
    return len(done), json.loads(hadoop.read_text(spark, f"{marks_path}/{done[-1]}"))["ingested_to"] if done else None


def changed_windows(lake: DataFrame, touched: DataFrame, served: DataFrame | None, exact_money: bool = False) -> DataFrame:
    """The windows of ``touched`` (window_start) whose metrics by ``lake`` differ
    from those in ``served``, in serving types, with ``recovered_rows``: how many
    telemetry rows more they count.

    Windows are few (one per five minutes, not per row), so rows meet them by an
    equi-join on the window; zones stay apart.
    """
    rows = lake.withColumn("window_start", F.window("event_time", WINDOW).start).join(touched, "window_start", "left_semi")
    again = utilization_metrics(rows.drop("window_start"), watermark=None, exact_money=exact_money)
    again = conform_utilization(again).withColumn("found", F.lit(True))
    if served is None:
        return again.withColumn("recovered_rows", F.col("telemetry_event_count").cast("long")).withColumn("spark_batch_id", F.lit(REPAIR_BATCH).cast("long")).drop("found")
    payload = [c for c in UTILIZATION_COLUMNS if c not in UTILIZATION_KEY]
    old = served.select(*UTILIZATION_KEY, "spark_batch_id", *[F.col(c).alias(f"old_{c}") for c in payload])
    same = F.lit(True)
    for c in payload:
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    before = F.coalesce("old_telemetry_event_count", F.lit(0))
    return (
        again.join(old, list(UTILIZATION_KEY), "left")
        .where(~same)
        .select(
            *UTILIZATION_COLUMNS,
            F.coalesce("spark_batch_id", F.lit(REPAIR_BATCH)).cast("long").alias("spark_batch_id"),
            (F.col("telemetry_event_count") - before).cast("long").alias("recovered_rows"),
        )
    )


def repair_late_windows(
    spark: SparkSession,
    lake: DataFrame,
    serving: str | VersionedTable,
    marks_path: str,
    repaired_at: dt.datetime | None = None,
    reject_path: str | None = None,
    exact_money: bool = False,
) -> DataFrame:
    """Merge the windows that late rows have changed into the serving table, and
    return them (serving columns, ``recovered_rows``).

    ``lake`` is the clean lake (``event_time``, ``ingested_at``, ``event_date``).
    Only windows that the stream has closed are repaired: those that end two
    minutes (the watermark) before the newest event at least; an open window still
    gets its rows live.  A mark keeps up to which ingest time rows are repaired,
    so the next repair looks at later rows only; of the lake it reads the days
    that these fall into, and of the serving table the same days.  The mark moves
    last: a repair that failed is repeated, to the same result.
    """
    ensure_utc(spark)
    stamp = repaired_at or dt.datetime.now(dt.timezone.utc)
    number, mark = _last_mark(spark, marks_path)
    reach = lake.agg(F.unix_micros(F.max("event_time")).alias("t"), F.unix_micros(F.max("ingested_at")).alias("i")).first()
    fresh = lake if mark is None else lake.where(F.col("ingested_at") > F.timestamp_micros(F.lit(mark)))
    closed = F.col("window_end") <= F.timestamp_micros(F.lit(reach["t"])) - F.expr(f"INTERVAL {WATERMARK}")
    window = F.window("event_time", WINDOW)
    touched = fresh.select(window.start.alias("window_start"), window.end.alias("window_end")).where(closed)
    touched = materialize(touched.select("window_start", F.to_date("window_start").alias("window_date")).distinct())
    days = partition_values(touched, "window_date")
    if not days:
        changed = _none(spark, lake, exact_money)
    else:
        if "event_date" in lake.columns:
            lake = lake.where(F.col("event_date").isin(*[dt.date.fromisoformat(d) for d in days]))
        served = _served(spark, serving, days)
        changed = materialize(changed_windows(lake, touched.select("window_start"), served, exact_money))
        rows = changed.drop("recovered_rows").withColumn("processed_at", ts_literal(stamp))
        serve_utilization(spark, serving, rows, reject_path, "repair")
    if reach["i"] is not None and not hadoop.put_new(spark, f"{marks_path}/{number:012d}.json", json.dumps({"ingested_to": reach["i"]})):
        raise RuntimeError("another repair ended first; its mark stands")
    return changed


def _none(spark: SparkSession, lake: DataFrame, exact_money: bool) -> DataFrame:
    nothing = lake.limit(0).select(F.window("event_time", WINDOW).start.alias("window_start"))
    return changed_windows(lake.limit(0), nothing, None, exact_money)


def _served(spark: SparkSession, serving: str | VersionedTable, days: list[str]) -> DataFrame | None:
    if isinstance(serving, VersionedTable):
        return serving.read(spark, days)
    stored = stored_or_none(spark, serving)
    return stored if stored is None else stored.where(F.col("window_date").isin(*[dt.date.fromisoformat(d) for d in days]))
