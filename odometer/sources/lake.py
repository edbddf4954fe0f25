"""Clean telemetry lake scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_clean_lake(
    spark: SparkSession, path: str, bypass_commit_log: bool = False, partitioned: bool = True
) -> DataFrame:
    """Read the clean telemetry lake.

    By default the folder is read as a table, which honours the streaming
    sink's ``_spark_metadata`` log (only committed files) and prunes
    ``event_date`` partitions.  ``bypass_commit_log=True`` reads the part
    files through a glob - Spark consults the commit log only for a plain
    folder path - which is the reference's batch read: it may include files
    of a micro-batch that never committed.  ``basePath`` keeps the
    ``event_date`` partition column.
    """
    root = path.rstrip("/")
    if bypass_commit_log:
        pattern = f"{root}/event_date=*/part-*.parquet" if partitioned else f"{root}/part-*.parquet"
        return spark.read.option("basePath", root).parquet(pattern)
    return spark.read.parquet(root)
