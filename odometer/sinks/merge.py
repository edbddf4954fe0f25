"""Keyed merges into partitioned lake tables (the serving store).

A merge touches only the partitions the incoming batch carries: the target is
read between the smallest and largest partition value of the batch (scalar
subqueries on the partition column, so other folders aren't read) and of those
only what the batch names.  The merged rows are materialized in the shared
checkpoint folder (so the write never reads the path it overwrites) and
written back with dynamic partition overwrite.  Every other partition is left
as it is.  Such a write replaces files in place.  A ``VersionedTable``
(``odometer.sinks.versions``) in place of a path is written beside what is
stored and appears in one step instead; a reader never meets half a merge.

``serve_utilization`` and ``serve_report`` are the guarded writes: payloads are
normalised and cast to the serving types, and rows that break a constraint (a
NULL where none may be, or a value that its type can't hold) never reach the
table; they go to ``reject_path``, or fail the write where there is none.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odometer import hadoop
from odometer.functions.timeutil import ts_literal
from odometer.operators.serving import (
    conform_column,
    normalize_utilization_payload,
    upsert_profitability,
    upsert_utilization,
)
from odometer.schemas import (
    SERVING_REPORT_NOT_NULL,
    SERVING_REPORT_TYPES,
    SERVING_UTILIZATION_NOT_NULL,
    SERVING_UTILIZATION_TYPES,
)
from odometer.session import materialize, stored_or_none
from odometer.sinks.versions import VersionedTable, partition_values


def only_dates_of(target: DataFrame, incoming: DataFrame, partition_col: str) -> DataFrame:
    """Rows of ``target`` whose partition value occurs in ``incoming``.  The
    bounds prune folders; the semi join drops the gaps between them."""
    keys = incoming.select(partition_col).distinct()
    low = keys.agg(F.min(partition_col).alias("v")).select("v").scalar()
    high = keys.agg(F.max(partition_col).alias("v")).select("v").scalar()
    return target.where(F.col(partition_col).between(low, high)).join(keys, partition_col, "left_semi")


def _write(df: DataFrame, path: str, partition_col: str, key: list[str]) -> None:
    """Range-partition on (partition column, key): few files per partition,
    yet a partition holding a third of the rows is split across tasks."""
    (
        df.repartitionByRange(partition_col, *key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def merge_utilization(spark, path: str | VersionedTable, incoming: DataFrame) -> None:
    """Guarded upsert of metric rows into ``path`` (partitioned by ``window_date``)."""
    batch = incoming.withColumn("window_date", F.to_date("window_start"))
    if isinstance(path, VersionedTable):

        def merged(stored: DataFrame | None) -> DataFrame:
            target = batch.limit(0) if stored is None else stored.select(*batch.columns)
            return upsert_utilization(target, batch).select(*batch.columns)

        if values := partition_values(batch, "window_date"):
            path.replace(spark, values, merged, ["window_start", "zone"])
        return
    target = stored_or_none(spark, path)
    stored = batch.limit(0) if target is None else only_dates_of(target, batch, "window_date").select(*batch.columns)
    merged = upsert_utilization(stored, batch)
    _write(materialize(merged.select(*batch.columns)), path, "window_date", ["window_start", "zone"])


def merge_profitability(spark, path: str | VersionedTable, incoming: DataFrame, updated_at) -> None:
    """Unguarded upsert of report rows into ``path`` (partitioned by ``report_date``)."""
    if isinstance(path, VersionedTable):

        def merged(stored: DataFrame | None) -> DataFrame:
            target = incoming.limit(0).withColumn("updated_at", ts_literal(updated_at)) if stored is None else stored
            return upsert_profitability(target, incoming, updated_at)

        if values := partition_values(incoming, "report_date"):
            path.replace(spark, values, merged, ["vehicle_id"])
        return
    target = stored_or_none(spark, path)
    if target is None:
        stored = incoming.limit(0).withColumn("updated_at", ts_literal(updated_at))
    else:
        stored = only_dates_of(target, incoming, "report_date")
    _write(materialize(upsert_profitability(stored, incoming, updated_at)), path, "report_date", ["vehicle_id"])


def split_by_constraints(rows: DataFrame, types: dict, not_null: tuple) -> tuple[DataFrame, DataFrame]:
    """(rows in the serving types that keep every constraint, the other rows as
    they came, with ``reject_reason``: the constraints that each breaks)."""
    fit = [c for c in types if c in rows.columns]
    checked = rows.select(F.struct(*rows.columns).alias("raw"), *[conform_column(c, types[c]).alias(c) for c in fit])
    lost = [F.when(F.col(c).isNull() & F.col(f"raw.{c}").isNotNull(), F.lit(f"{c} out of range")) for c in fit]
    missing = [F.when(F.col(f"raw.{c}").isNull(), F.lit(f"{c} missing")) for c in not_null if c in fit]
    checked = materialize(checked.withColumn("reasons", F.array_compact(F.array(*lost, *missing))))
    good, bad = F.size("reasons") == 0, F.size("reasons") > 0
    return checked.where(good).select(*fit), checked.where(bad).select("raw.*", F.array_join("reasons", "; ").alias("reject_reason"))


def keep_rejects(rejects: DataFrame, reject_path: str | None, partition: list[str], what: str) -> None:
    if not rejects.limit(1).count():
        return
    if reject_path is None:
        raise ValueError(f"{what} rows violate serving constraints; pass reject_path")
    # Overwriting its own partitions: a retry replaces its rejects.
    (
        rejects.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(reject_path)
    )


#: Rejected metric rows lie under the step that rejected them, their streaming
#: run and their batch, so no run, step or retry overwrites another's.
REJECT_PARTITIONS = ("reject_step", "stream_run", "spark_batch_id")


def serve_utilization(spark, path: str | VersionedTable, rows: DataFrame, reject_path: str | None = None, step: str = "direct") -> None:
    """Metric rows with lineage into the serving table: normalised, typed,
    checked, then the guarded merge.  ``rows`` may name their ``stream_run``;
    ``step`` says which job serves them."""
    if "stream_run" not in rows.columns:
        rows = rows.withColumn("stream_run", F.lit("none"))
    good, bad = split_by_constraints(
        normalize_utilization_payload(rows), SERVING_UTILIZATION_TYPES, SERVING_UTILIZATION_NOT_NULL
    )
    keep_rejects(bad.withColumn("reject_step", F.lit(step)), reject_path, list(REJECT_PARTITIONS), "metric")
    merge_utilization(spark, path, good)


def _replayed_path(reject_path: str) -> str:
    return reject_path.rstrip("/") + "_replayed"


def outstanding_rejects(spark, reject_path: str) -> list[str]:
    """Folders of rejected metric rows that no replay has taken yet, relative
    to ``reject_path``; from the folder listing and the replays' ledgers."""
    root = reject_path.rstrip("/")
    ledger = _replayed_path(reject_path)
    done = {f for n in hadoop.names(spark, ledger) for f in json.loads(hadoop.read_text(spark, f"{ledger}/{n}"))}
    depth = len(REJECT_PARTITIONS)
    found = ["/".join(p.split("/")[-depth:]) for p in hadoop.matches(spark, "/".join([root, *(f"{c}=*" for c in REJECT_PARTITIONS)]))]
    return [f for f in found if f not in done]


def replay_rejects(
    spark, reject_path: str, path: str | VersionedTable, repair: Callable[[DataFrame], DataFrame]
) -> tuple[int, int]:
    """Give the rejected metric rows that are outstanding to ``repair`` and serve
    what it returns; returns (rows served, rows rejected again).

    Served rows keep their stamps, so the guarded merge lets no repaired row
    replace a newer one.  Rows that break a constraint again are rejects of this
    replay (``reject_step=replay-<n>``), outstanding for the next.  A ledger
    entry closes the replay: repeating a finished one serves nothing, and one that
    failed before it is repeated whole, to the same result.
    """
    root = reject_path.rstrip("/")
    folders = outstanding_rejects(spark, reject_path)
    if not folders:
        return 0, 0
    number = len(hadoop.names(spark, _replayed_path(reject_path))) + 1
    rejected = spark.read.option("basePath", root).parquet(*[f"{root}/{f}" for f in folders])
    repaired = repair(rejected.drop("reject_reason", "reject_step"))
    good, bad = split_by_constraints(
        normalize_utilization_payload(repaired), SERVING_UTILIZATION_TYPES, SERVING_UTILIZATION_NOT_NULL
    )
    counts = good.count(), bad.count()
    keep_rejects(bad.withColumn("reject_step", F.lit(f"replay-{number}")), reject_path, list(REJECT_PARTITIONS), "metric")
    if counts[0]:
        merge_utilization(spark, path, good)
    if not hadoop.put_new(spark, f"{_replayed_path(reject_path)}/{number:012d}.json", json.dumps(folders)):
        raise RuntimeError("another replay of these rejects ended first; its result stands")
    return counts


def split_report(report: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_by_constraints(report, SERVING_REPORT_TYPES, SERVING_REPORT_NOT_NULL)
