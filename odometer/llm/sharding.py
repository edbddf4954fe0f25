"""Sharding by a hierarchical weighted hash tree.

A topology has regions, racks in them and shards in those, each shard with a
weight; an inner node weighs what its shards weigh.  A key descends from the
root: at each level every child draws ``-ln(u) / weight`` with ``u`` a uniform
hash of the key and the child's name, and the smallest draw wins.  Draws depend
on nothing but key, name and weight, so when weights change a key moves only
into a subtree whose weight grew, or out of one whose weight shrank; everything
under other nodes stays.  A new shard in a region of its own takes rows only
into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odometer.llm.common import ordinals, stash

#: {region: {rack: {shard number: weight}}}
Topology = dict[str, dict[str, dict[int, float]]]


def topology(shards: int, per_rack: int = 2, racks: int = 2, base: int = 8) -> Topology:
    """The first ``base`` shards (or fewer) in racks of ``per_rack`` and regions
    of ``racks``; every further shard in a region and rack of its own, so that
    from ``base`` on one more shard takes rows only into itself.  (Below it, the
    region of a new shard grows, and rows also move inside that region.)"""
    tree: Topology = {}
    for s in range(shards):
        rack = s // per_rack
        region = f"region{rack // racks}" if s < base else f"region-of-{s}"
        tree.setdefault(region, {}).setdefault(f"rack{rack}" if s < base else f"rack-of-{s}", {})[s] = 1.0
    return tree


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: Column, path: str, weight: float) -> Column:
    # 53 bits of the hash, in (0, 1).
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11).cast("double")
    return -F.log((bits + 0.5) / float(1 << 53)) / F.lit(weight)


def _least(draws: list[tuple[Column, Column]]) -> Column:
    """The value beside the smallest draw; ties go to the earlier one."""
    best = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, (d, _) in enumerate(draws)]))
    if len(draws) == 1:
        return draws[0][1]
    out = F.when(best["i"] == 0, draws[0][1])
    for i, (_, value) in enumerate(draws[1:], 1):
        out = out.when(best["i"] == i, value)
    return out


def place(key: Column, tree, path: str = "") -> Column:
    """The shard number that ``key`` (string) descends to; null for no shards.
    Nodes of weight 0 take nothing."""
    draws = []
    for name, child in sorted(tree.items(), key=lambda kv: str(kv[0])):
        if _weight(child) > 0:
            at = f"{path}/{name}"
            value = place(key, child, at) if isinstance(child, dict) else F.lit(int(name))
            draws.append((_draw(key, at, _weight(child)), value))
    return _least(draws) if draws else F.lit(None).cast("int")


def shard_documents(docs: DataFrame, tree: Topology, grown: Topology | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size (UTF-8 bytes of
    the text and 1), text_crc32, shard, slot (from 0 in each shard, without
    gaps, in the order text_crc32, size, doc_id, so that equal texts of a shard
    are neighbours) and grown_shard (the shard in ``grown``).

    Null text is empty.  A null doc_id is a key like any other; rows with the
    same doc_id share a shard.  An empty table gives no rows.
    """
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("\0null"))
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        (F.length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        place(key, tree).alias("shard"),
        (place(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    rows = stash(rows, "placed")
    numbered = ordinals(rows, ["shard", "text_crc32", "size", "doc_id"], "slot", "slots")
    # One row per shard: bounded by the topology.
    starts = numbered.groupBy(F.col("shard").alias("s")).agg(F.min("slot").alias("first"))
    return numbered.join(F.broadcast(starts), F.col("shard") == F.col("s")).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot") - F.col("first")).alias("slot"), "grown_shard"
    )


def write_shards(docs: DataFrame, tree: Topology, path: str) -> None:
    """Write the whole rows of ``docs`` to one folder per shard
    (``shard=<n>/``); a large shard is several files."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("\0null"))
    docs.withColumn("shard", place(key, tree)).write.partitionBy("shard").parquet(path)


def restore_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("shard")
