"""Tables whose partitions are replaced behind one pointer.

A writer puts the new rows of the partitions that it touches into a folder of
their own (``version=<number>-<id>/``) and then publishes the next manifest: for
every partition the folder that holds it, with its row count and newest stamp.
Publishing is one rename to a name that must be free, so a reader sees the table
before or after a write and never in between, and a write that fails anywhere
leaves no trace but unused files.  Of two writers that start from the same
manifest one finds the name taken and starts again from the newer one.

A manifest has one entry per partition value (a date), so it is small however
large the table is; it also answers "how many rows, how new" and "which is the
newest day" without reading any data.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odometer import hadoop

#: Manifests (and what only they name) that a writer leaves for running readers.
KEEP = 20
ATTEMPTS = 8


class VersionConflict(RuntimeError):
    """Other writers were faster at every attempt."""


@dataclass(frozen=True)
class Snapshot:
    """One version: its number, the schema without the partition column, and
    by partition value the folder, rows and newest stamp (epoch microseconds)."""

    number: int = 0
    schema: str | None = None
    parts: dict[str, dict] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(p["rows"] for p in self.parts.values())

    @property
    def newest(self) -> int | None:
        return max((p["newest"] for p in self.parts.values() if p["newest"] is not None), default=None)


class VersionedTable:
    """A table under ``path``, partitioned by the date column ``partition``.
    ``stamp`` names the timestamp column whose maximum the manifests keep."""

    def __init__(self, path: str, partition: str, stamp: str | None = None, keep: int = KEEP):
        self.path, self.partition, self.stamp, self.keep = path.rstrip("/"), partition, stamp, keep

    def _manifest(self, number: int) -> str:
        return f"{self.path}/_manifests/{number:012d}.json"

    def numbers(self, spark: SparkSession) -> list[int]:
        return [int(n[:-5]) for n in hadoop.names(spark, f"{self.path}/_manifests") if n.endswith(".json")]

    def snapshot(self, spark: SparkSession, number: int | None = None) -> Snapshot:
        """The newest version, or an older one that is still kept."""
        if number is None:
            number = max(self.numbers(spark), default=0)
        if not number:
            return Snapshot()
        return Snapshot(number, **json.loads(hadoop.read_text(spark, self._manifest(number))))

    def read(self, spark: SparkSession, values: list[str] | None = None, snapshot: Snapshot | None = None) -> DataFrame | None:
        """The table, or its partitions ``values`` only (no other folder is even
        listed); None where the table holds none of them."""
        at = snapshot or self.snapshot(spark)
        if at.schema is None:
            return None
        held = sorted(at.parts if values is None else set(values) & set(at.parts))
        schema = StructType.fromJson(json.loads(at.schema))
        if not held:
            return None
        paths = [f"{self.path}/{at.parts[v]['folder']}/{self.partition}={v}" for v in held]
        return spark.read.schema(StructType(schema.fields).add(self.partition, "date")).option("basePath", self.path).parquet(*paths)

    def newest_days(self, spark: SparkSession, days: int = 1, until: str | None = None) -> list[str]:
        """The newest partition values, up to ``until``, from the manifest."""
        return sorted(v for v in self.snapshot(spark).parts if until is None or v <= until)[-days:]

    def replace(self, spark: SparkSession, values: list[str], build: Callable[[DataFrame | None], DataFrame], order: list[str]) -> int:
        """Replace the partitions ``values`` by what ``build`` makes of their
        stored rows, and return the version's number.  ``build`` runs again
        where another writer came first; it may give rows of ``values`` only.
        Within a partition files follow ``order``."""
        for attempt in range(ATTEMPTS):
            if attempt:
                time.sleep(0.05 * 2**attempt)
            base = self.snapshot(spark)
            rows = build(self.read(spark, values, base))
            folder = f"version={base.number + 1}-{uuid.uuid4().hex[:12]}"
            written = f"{self.path}/{folder}"
            try:
                # Range parts by partition and order: few files a partition, a large one in several tasks.
                rows.repartitionByRange(self.partition, *order).write.partitionBy(self.partition).parquet(written)
            except Exception:
                hadoop.remove(spark, written)
                raise
            schema = StructType([f for f in rows.schema.fields if f.name != self.partition])
            parts = dict(base.parts)
            for value in values:
                parts.pop(value, None)
            parts |= self._measured(spark, written, folder, schema)
            if self._publish(spark, base.number + 1, schema, parts):
                self._retire(spark, base.number + 1)
                return base.number + 1
            hadoop.remove(spark, written)
        raise VersionConflict(f"{self.path}: {ATTEMPTS} attempts, each overtaken by another writer")

    def _measured(self, spark: SparkSession, written: str, folder: str, schema: StructType) -> dict[str, dict]:
        # One row per date; reads the stamp column of what was just written.
        newest = F.unix_micros(F.max(self.stamp)) if self.stamp else F.lit(None)
        fields = StructType(schema.fields).add(self.partition, "date")
        rows = spark.read.schema(fields).parquet(written).groupBy(self.partition).agg(F.count(F.lit(1)).alias("rows"), newest.alias("newest"))
        found = {r[0]: {"folder": folder, "rows": r["rows"], "newest": r["newest"]} for r in rows.collect()}
        if None in found:
            hadoop.remove(spark, written)
            raise ValueError(f"{found[None]['rows']} rows have no {self.partition}")
        return {str(day): part for day, part in found.items()}

    def _publish(self, spark: SparkSession, number: int, schema: StructType, parts: dict[str, dict]) -> bool:
        return hadoop.put_new(spark, self._manifest(number), json.dumps({"schema": schema.json(), "parts": parts}))

    def _retire(self, spark: SparkSession, number: int) -> None:
        """Every ``keep`` versions: drop older manifests, and the folders that
        no kept one names.  A folder of a number not yet published is left."""
        if self.keep and number % self.keep == 0:
            oldest = number - self.keep + 1
            kept = [n for n in self.numbers(spark) if n >= oldest]
            named = {p["folder"] for n in kept for p in self.snapshot(spark, n).parts.values()}
            for name in hadoop.names(spark, self.path):
                if name.startswith("version=") and name not in named and int(name[8:].split("-")[0]) < oldest:
                    hadoop.remove(spark, f"{self.path}/{name}")
            for n in self.numbers(spark):
                if n < oldest:
                    hadoop.remove(spark, self._manifest(n))


def utilization_table(path: str, keep: int = KEEP) -> VersionedTable:
    return VersionedTable(path, "window_date", "processed_at", keep)


def report_table(path: str, keep: int = KEEP) -> VersionedTable:
    return VersionedTable(path, "report_date", "updated_at", keep)


def partition_values(rows: DataFrame, partition: str) -> list[str]:
    """The dates in ``rows``: bounded by the calendar."""
    return sorted(str(r[0]) for r in rows.select(partition).distinct().collect() if r[0] is not None)


def snapshot_row(spark: SparkSession, utilization: VersionedTable, report: VersionedTable) -> DataFrame:
    """The health snapshot (newest ``processed_at``, metric rows, report rows)
    from the manifests alone: no data is read, however large the tables are."""
    metrics, reports = utilization.snapshot(spark), report.snapshot(spark)
    newest = F.lit(None).cast("timestamp") if metrics.newest is None else F.timestamp_micros(F.lit(metrics.newest))
    return spark.range(1, numPartitions=1).select(
        newest.alias("last_processed_at"),
        F.lit(metrics.rows).cast("long").alias("metric_rows"),
        F.lit(reports.rows).cast("long").alias("profitability_rows"),
    )


def served_latest_window(spark: SparkSession, table: VersionedTable, zone: str | None = None, closed_before=None) -> DataFrame | None:
    """``latest_window`` off a stored utilization table; None where it is empty.

    The newest window lies in the newest day.  The newest one closed by a time
    lies in that time's day or, if none of it was closed yet, in the stored day
    before; no other folder is read.
    """
    from odometer.operators.serving import check_zone_argument, latest_window

    check_zone_argument(zone)
    at = table.snapshot(spark)
    days = sorted(v for v in at.parts if closed_before is None or v <= str(closed_before)[:10])
    rows = table.read(spark, days[-1 if closed_before is None else -2 :], at)
    return None if rows is None else latest_window(rows.drop(table.partition), zone, closed_before)
