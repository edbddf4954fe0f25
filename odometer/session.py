"""Session construction and shared-folder helpers.

Everything time-related in this library assumes the session time zone is UTC
(every date cut, window boundary and freshness age depends on it), so
``ensure_utc`` is called by every public query builder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "odometer",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session configured for this library.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the
    cluster manager supplies the master, and AQE coalesces the initial
    shuffle partitions to ``advisoryPartitionSizeInBytes``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Window x zone state grows with the key count; RocksDB keeps it off
        # the JVM heap, and changelog checkpointing uploads only deltas.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # Stored tables materialized by checkpoint() are deleted once their
        # DataFrame is garbage-collected, so long-lived drivers do not pile up.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    else:
        # Cluster scale: start wide and let AQE coalesce every shuffle to
        # ~advisoryPartitionSizeInBytes, so no reducer has to spill a
        # multi-GB partition and small shuffles still end up in few tasks.
        conf["spark.sql.shuffle.partitions"] = "4096"
        # 100 TB / 256 MB ~ 400k scan tasks: ~50 waves on 8,000 cores, each
        # task's partial aggregates well inside executor memory.
        conf["spark.sql.files.maxPartitionBytes"] = "256m"
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (the reference's runbook requirement)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared work folder, taken from ``spark.checkpoint.dir``.

    Only where the setting is absent from a local session is a fresh folder made
    and registered (a cluster session without it is an error), so that lineage-cutting writes and streaming
    checkpoints always land on storage every executor can reach.  A setting
    made on a running session is passed on to the SparkContext, which is
    where ``DataFrame.checkpoint`` looks.
    """
    try:
        context = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        context = None
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and context is not None:
        configured = context.getCheckpointDir()
    if not configured:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="odometer-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if context is not None and not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique sub-folder of the shared work folder for one run."""
    return "/".join([shared_dir(spark), "odometer", purpose, uuid.uuid4().hex])


def path_missing(err) -> bool:
    """Whether an analysis error says that nothing is stored at a path yet."""
    return err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def stored_or_none(spark: SparkSession, path: str):
    """The Parquet table at ``path``, or None if there is none; any other
    error is raised."""
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.parquet(path)
        df.schema  # noqa: B018 - a missing path fails here
        return df
    except AnalysisException as err:
        if path_missing(err):
            return None
        raise


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Have Hadoop's file system delete ``path`` when the application ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


def stage(df, purpose: str):
    """Write ``df`` as Parquet into the shared folder and read it back: computed
    once, lineage cut, and each reader takes only its columns.  The folder goes
    when the application ends."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    discard_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side checks can see local folders."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def materialize(df):
    """Compute ``df`` once and cut its lineage: an eager, reliable
    ``checkpoint()`` into the shared folder of ``spark.checkpoint.dir``
    (files every executor can read, so a lost executor does not force a
    recomputation from the sources).  Use it for derived tables that are
    read more than once - the serving and report tables - never for raw
    telemetry."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
