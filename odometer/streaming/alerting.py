"""Live alerting: the freshness rule on a stream, with processing-time timers.

"No telemetry processed" is about rows that do not come, so no row can set it
off.  A keyed state holds when telemetry was last seen and the status; every
arrival moves a timer to one threshold later, and the timer going off is the
alert.  Silence thus alerts by itself, once, and the next arrival recovers.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from odometer.operators.health import DEFAULT_THRESHOLD_SECONDS, RULE_NAME, alert_context, health_columns, severity
from odometer.streaming.queries import run_of, trigger_options

CHANGE = "feed string, checked_ms long, last_ms long"


class FreshnessWatch(StatefulProcessor):
    """Emits (feed, time, last seen) whenever a feed's status changes."""

    def __init__(self, threshold_seconds: int):
        self.threshold = threshold_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last_ms long, healthy boolean")

    @staticmethod
    def _change(key, now: int, last: int) -> pd.DataFrame:
        return pd.DataFrame({"feed": [key[0]], "checked_ms": [now], "last_ms": [last]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        now = timerValues.getCurrentProcessingTimeInMs()
        healthy = self.seen.exists() and self.seen.get()[1]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        # Unhealthy is an age of more whole seconds than the threshold.
        self.handle.registerTimer(now + self.threshold + 1000)
        self.seen.update((now, True))
        if not healthy:
            yield self._change(key, now, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, healthy = self.seen.get()
        now = timerValues.getCurrentProcessingTimeInMs()
        if healthy and now - last > self.threshold:
            self.seen.update((last, False))
            yield self._change(key, now, last)

    def close(self) -> None:
        pass


def _pulses(rows: DataFrame, feed: str | None) -> DataFrame:
    """One row for each batch of rows and feed, so that the single key of a busy
    feed gets a handful of rows, not the telemetry."""

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"feed": batch["feed"].drop_duplicates()})

    named = rows.select((F.lit("telemetry") if feed is None else F.col(feed).cast("string")).alias("feed"))
    return named.mapInPandas(reduced, "feed string")


def freshness_changes(rows: DataFrame, threshold_seconds: int = DEFAULT_THRESHOLD_SECONDS, feed: str | None = None) -> DataFrame:
    """Status changes of a stream of processed rows, in the alert columns.
    ``feed`` names a column whose values are watched each for itself (a zone,
    say); by default the whole stream is one feed.  A feed that never sent
    anything has no state and no alert: the scheduled check reports it."""
    if threshold_seconds <= 0:
        raise ValueError("threshold must be positive")
    changes = _pulses(rows, feed).groupBy("feed").transformWithStateInPandas(
        FreshnessWatch(threshold_seconds), CHANGE, "Append", "ProcessingTime"
    )
    at = changes.select(
        "feed",
        F.timestamp_millis("checked_ms").alias("created_at"),
        F.timestamp_millis("last_ms").alias("last_processed_at"),
        F.lit(None).cast("long").alias("metric_rows"),
    )
    judged = health_columns(at, F.col("created_at"), threshold_seconds).withColumn("message", F.col("reason"))
    return judged.select(
        "feed",
        "created_at",
        severity("status").alias("severity"),
        F.lit(RULE_NAME).alias("rule_name"),
        "message",
        "status",
        "age_seconds",
        "last_processed_at",
        alert_context(threshold_seconds).alias("context"),
    )


def start_alerting(
    rows: DataFrame,
    alerts_path: str,
    checkpoint: str,
    threshold_seconds: int = DEFAULT_THRESHOLD_SECONDS,
    trigger_seconds: int = 10,
    feed: str | None = None,
) -> StreamingQuery:
    """Watch a stream and append its status changes to an alert log, each batch
    to a partition of its own (a retried batch replaces itself)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.withColumn("stream_run", F.lit(run_of(batch))).withColumn("spark_batch_id", F.lit(int(batch_id)).cast("long"))
        held.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream_run", "spark_batch_id").parquet(alerts_path)

    return (
        freshness_changes(rows, threshold_seconds, feed)
        .writeStream.queryName("odometer-alerting")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(trigger_seconds))
        .foreachBatch(write)
        .start()
    )
