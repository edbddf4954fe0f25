"""Helpers shared by the operators: tables kept in the shared folder, global
ordinals, and bounded Arrow batches."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odometer.session import discard_at_exit, scratch_path, stage

#: ASCII white space, as the result contracts define it (Java regex).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stash(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder of the shared work folder and
    read it back: computed once, lineage cut, columns prunable, and safe when
    an executor is lost.  The folder goes when the application ends."""
    return stage(df, f"llm-{purpose}")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, through the
    shared folder: they need not find it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    path = f"{scratch_path(spark, 'code')}/{top.name}.zip"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(where)
    out.write(packed.getvalue())
    out.close()
    discard_at_exit(spark, path)
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def ordinals(df: DataFrame, keys: list[str], out: str, purpose: str) -> DataFrame:
    """Number all rows 0, 1, ... in the order of ``keys`` as column ``out``.

    One range shuffle deals the sort over all tasks; the sorted slices are
    stored, so that their numbering is fixed, and each row adds the rows of the
    earlier slices (a table of one row per slice) to its place in its own.
    Rows that tie on all keys get neighbouring numbers in any order.
    ``df`` is read twice (once to sample the range bounds).
    """
    place = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    dealt = dealt.withColumn("_slice", F.spark_partition_id()).withColumn("_place", place.bitwiseAND((1 << 33) - 1))
    dealt = stash(dealt, purpose)
    counts = dealt.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice: bounded by the number of shuffle partitions.
    starts = counts.select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        dealt.join(F.broadcast(starts), "_slice")
        .withColumn(out, F.col("_start") + F.col("_place"))
        .drop("_slice", "_place", "_start")
    )


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def keep_by_key(docs: DataFrame, keepers: DataFrame) -> DataFrame:
    """One row of ``docs``, with all columns, for each row of ``keepers``
    (doc_id, text_key: hash of the raw text, rows: how many rows share both)."""
    (key,) = fresh(docs, "text_key")
    marked = docs.withColumn(key, F.xxhash64("text"))
    k = keepers.select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_key"), "rows")
    match = same(marked["doc_id"], k["k_id"]) & (marked[key] == k["k_key"])
    out = marked.join(k, match, "left_semi")
    if keepers.filter("rows > 1").limit(1).count():
        out = out.dropDuplicates(["doc_id", key])
    return out.drop(key)


def arrow_map(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, weigh: str, limit: int = 4 << 20
) -> DataFrame:
    """``mapInArrow`` in pieces: each call of ``fn`` gets rows whose column
    ``weigh`` (text) holds about ``limit`` bytes at most, or one longer row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, weigh, limit):
                yield fn(piece)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, weigh: str, limit: int) -> Iterator[pa.RecordBatch]:
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(weigh))), 0).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)
