"""Small files through Hadoop's file system, so that they may lie wherever Spark
can write: claims, pointers and ledgers of a few kilobytes."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder.  Files
    that ``put_new`` hasn't published aren't named."""
    where, files = _place(spark, path)
    if not files.exists(where):
        return []
    found = (status.getPath().getName() for status in files.listStatus(where))
    return sorted(name for name in found if not name.startswith("_new-"))


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a glob pattern, sorted."""
    where, files = _place(spark, pattern)
    found = files.globStatus(where)
    return sorted(status.getPath().toString() for status in found or [])


def read_text(spark: SparkSession, path: str) -> str:
    where, files = _place(spark, path)
    stream = files.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False where it exists already."""
    where, files = _place(spark, path)
    files.mkdirs(where.getParent())
    try:
        files.create(where, False).close()
        return True
    except Exception as err:  # noqa: BLE001 - the JVM's exception is looked at
        if files.exists(where):
            return False
        raise err


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Publish a whole file under a name that must be free: written aside, then
    renamed, which fails where the name is taken.  Nobody ever sees a part."""
    where, files = _place(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_new-{uuid.uuid4().hex}")
    files.mkdirs(where.getParent())
    out = files.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    if move_new(spark, aside.toString(), path):
        return True
    files.delete(aside, False)
    return False


def move_new(spark: SparkSession, source: str, path: str) -> bool:
    """Rename a file or folder to a name that must be free; False where it is
    taken."""
    aside, _ = _place(spark, source)
    where, files = _place(spark, path)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    never_over = gateway.new_array(kind, 1)
    never_over[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(context.makeQualified(aside), context.makeQualified(where), never_over)
        return True
    except Exception as err:  # noqa: BLE001 - the JVM's exception is looked at
        if files.exists(where):
            return False
        raise err


def remove(spark: SparkSession, path: str) -> None:
    where, files = _place(spark, path)
    files.delete(where, True)
