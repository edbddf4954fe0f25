"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes.  All distinct blocks
are sorted and get integer names; then adjacent names are paired, all distinct
pairs are sorted and named, and so on, until each document is one (level,
name).  Two documents have the same one exactly when their texts are equal:
a hash only decides where a block is sorted, never whether two blocks are
equal, so no collision can merge two texts.

Skew: blocks and pairs are made distinct with map-side aggregation before they
are named, so a text that a third of all rows share is named once; the joins
back are plain equi-joins that adaptive execution splits.  Texts are shuffled
once, as distinct blocks; all later shuffles carry numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odometer.llm.common import SPACE, keep_by_key, ordinals, same, stash

BLOCK_BYTES = 16_384
#: So many ambiguous block keys are handed to the tasks as literals; with more,
#: every block's content is carried instead.
AMBIGUOUS_KEYS = 1_000


def normalised(text: Column) -> Column:
    """Null is empty; each run of ASCII white space is one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def _blocks(raw: Column, size: int) -> Column:
    """Fixed-size blocks of a binary value, in order; one empty block if empty."""
    last = F.greatest(F.floor((F.length(raw) - 1) / size), F.lit(0)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * F.lit(size) + F.lit(1), F.lit(size))
    )


def exact_duplicates(
    docs: DataFrame,
    block_bytes: int = BLOCK_BYTES,
    block_key: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size,
    kept, text_sha256, level, name and text_key (a hash of the raw text).

    Null text counts as empty; empty texts are equal to each other.  Of equal
    texts the smallest non-null doc_id stays; of rows with the same id the one
    with the smaller text_key, then any one.  An empty table gives no rows;
    further columns are ignored.  ``block_key`` is where blocks are sorted
    (64-bit); the result does not depend on it.
    """
    base = docs.select(
        F.col("doc_id").alias("doc_id"), F.col("text").alias("raw"), normalised(F.col("text")).alias("norm")
    )
    cut = base.withColumn("blocks", _blocks(F.encode("norm", "UTF-8"), block_bytes))

    # Distinct blocks: one row per key, whatever number of rows hold it.
    found = (
        cut.select(F.explode("blocks").alias("block"))
        .select(block_key(F.col("block")).alias("key"), "block")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("block")).alias("contents"))
    )
    alone = F.size("contents") == 1
    found = stash(
        found.select("key", alone.alias("alone"), F.posexplode("contents").alias("nth", "content")).withColumn(
            "content", F.when(~F.col("alone"), F.col("content"))
        ),
        "blocks",
    )
    names = ordinals(found, ["key", "nth"], "name", "block-names")
    unclear = [r[0] for r in found.filter(~F.col("alone")).select("key").distinct().limit(AMBIGUOUS_KEYS + 1).collect()]
    if len(unclear) > AMBIGUOUS_KEYS:
        shown = lambda b: b
    elif unclear:
        shown = lambda b: F.when(block_key(b).isin(unclear), b)
    else:
        shown = lambda b: F.lit(None).cast("binary")

    # The documents as sequences of keys; row numbers are fixed by storing them.
    rows = stash(
        cut.select(
            F.monotonically_increasing_id().alias("row"),
            F.struct(
                "doc_id", F.sha2("norm", 256).alias("text_sha256"), F.xxhash64("raw").alias("text_key")
            ).alias("doc"),
            F.transform("blocks", lambda b: F.struct(block_key(b).alias("key"), shown(b).alias("content"))).alias("seq"),
        ),
        "sequences",
    )
    items = rows.select("row", "doc", F.size("seq").alias("n"), F.posexplode("seq").alias("i", "item"))
    items = items.select("row", "doc", "n", "i", F.col("item.key").alias("key"), F.col("item.content").alias("content"))
    clear = names.filter("alone").select("key", "name")
    if unclear:
        seen, known = items.alias("seen"), names.alias("known")
        if len(unclear) <= AMBIGUOUS_KEYS:
            match = same(F.col("seen.content"), F.col("known.content"))
        else:
            match = F.col("known.alone") | same(F.col("seen.content"), F.col("known.content"))
        items = seen.join(known, (F.col("seen.key") == F.col("known.key")) & match).select(
            "row", "doc", "n", "i", F.col("known.name").alias("name")
        )
    else:
        items = items.join(clear, "key").select("row", "doc", "n", "i", "name")
    items = stash(items, "named")

    done = items.filter("n = 1").select("row", "doc", F.lit(0).alias("level"), "name")
    longest = items.agg(F.max("n")).first()[0] or 1
    level = 0
    items = items.filter("n > 1")
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        paired = items.groupBy("row", F.expr("cast((n + 1) div 2 as int)").alias("n"), F.expr("i div 2").alias("i")).agg(
            F.max("doc").alias("doc"),
            F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
            # No second name: the sequence ends here.
            F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        paired = stash(paired, "pairs")
        named = ordinals(paired.select("a", "b").distinct(), ["a", "b"], "name", "pair-names")
        items = stash(paired.join(named, ["a", "b"]).select("row", "doc", "n", "i", "name"), "named")
        done = done.unionByName(items.filter("n = 1").select("row", "doc", F.lit(level).alias("level"), "name"))
        items = items.filter("n > 1")

    order = F.struct(
        F.col("doc.doc_id").isNull().alias("a"),
        F.col("doc.doc_id").alias("doc_id"),
        F.col("doc.text_key").alias("text_key"),
        F.col("row").alias("row"),
    )
    groups = done.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("keep"))
    return done.join(groups, ["level", "name"]).select(
        "doc.doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "doc.text_sha256",
        "level",
        "name",
        "doc.text_key",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = stash(exact_duplicates(docs).select("doc_id", "text_key", "kept"), "exact")
    keep = found.groupBy("doc_id", "text_key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    return keep_by_key(docs, stash(keep.filter("kept").drop("kept"), "exact-kept"))
