"""Totals of a whole live run.

A query's own ``recentProgress`` holds the last micro-batches only (100 by
default).  ``RunTotals`` listens to every progress event, so rows, time and
watermark drops are those of the whole run, however many batches it has.
"""

from __future__ import annotations

import json
import threading
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from odometer import hadoop


@dataclass
class Totals:
    batches: int = 0
    input_rows: int = 0
    millis: int = 0
    dropped_by_watermark: int = 0
    state_rows: int = 0

    @property
    def rows_per_sec(self) -> float | None:
        return round(self.input_rows / (self.millis / 1000.0), 1) if self.millis else None

    def __add__(self, later: Totals) -> Totals:
        sums = (getattr(self, f) + getattr(later, f) for f in ("batches", "input_rows", "millis", "dropped_by_watermark"))
        return Totals(*sums, later.state_rows)


class RunTotals(StreamingQueryListener):
    """``spark.streams.addListener(RunTotals())`` before queries start."""

    def __init__(self):
        self._lock = threading.Lock()
        self._runs: dict[str, dict[str, Totals]] = {}
        self._ended: dict[str, threading.Event] = {}

    def _ending(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._runs.setdefault(str(event.id), {})[str(event.runId)] = Totals()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            at = self._runs.setdefault(str(p.id), {}).setdefault(str(p.runId), Totals())
            if p.numInputRows:
                at.batches += 1
                at.input_rows += p.numInputRows
                at.millis += dict(p.durationMs).get("triggerExecution", 0)
            at.dropped_by_watermark += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
            at.state_rows = sum(op.numRowsTotal for op in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ending(str(event.runId)).set()

    def totals(self, query: StreamingQuery, seconds: float = 60) -> Totals:
        """Totals of all runs of ``query`` (the same checkpoint) that this
        listener saw.  Events come in order but late: of a query that has ended
        this waits for the last one."""
        if not query.isActive and not self._ending(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of query {query.id} within {seconds} seconds")
        with self._lock:
            out = Totals()
            for run in self._runs.get(str(query.id), {}).values():
                out = out + run
            return out

    def save(self, spark: SparkSession, query: StreamingQuery, path: str) -> None:
        """Keep the run's totals under ``path``, so that a later application
        can add up a query's whole life; saving a run again changes nothing."""
        self.totals(query)
        with self._lock:
            run = self._runs.get(str(query.id), {}).get(str(query.runId), Totals())
            text = json.dumps(asdict(run))
        hadoop.put_new(spark, f"{path.rstrip('/')}/{query.id}/{query.runId}.json", text)


def saved_totals(spark: SparkSession, query_id: str, path: str) -> Totals:
    """Totals of all saved runs of a query."""
    folder, out = f"{path.rstrip('/')}/{query_id}", Totals()
    for name in hadoop.names(spark, folder):
        out = out + Totals(**json.loads(hadoop.read_text(spark, f"{folder}/{name}")))
    return out
