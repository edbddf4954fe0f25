"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints have 64 bits.  For radius r, each bit gets a non-zero vector of
r+1 bits, and each non-zero vector v of r+1 bits gives a mask: the bits whose
vector has odd inner product with v.  Any r differing bits leave some v
orthogonal to all of them, so two fingerprints within the radius agree under
that mask: 15 masks of at least 32 bits for r = 3, and every pair within the
radius meets in some table.  Nothing is left to chance.

Buckets: distinct fingerprints only (a group of equal texts is one), and only
buckets of two or more go on.  A bucket of up to ``cap`` fingerprints gives the
edges of a spanning forest of its links, never all pairs.  The fingerprints of
a larger bucket are covered again on the bits that their mask left free, which
halves the free bits; with 2^8 <= cap, three levels end it for any input, as a
bucket then has at most 2^8 distinct members.  Nothing is capped or dropped.

Edges become components by alternating large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odometer.llm.common import arrow_map, keep_by_key, ship, stash

SHINGLE_WORDS = 3
RADIUS = 3
BITS = 64
CAP = 4096
HASH_SEED = 42
_LANES = np.uint64(0x0101010101010101)
_CHUNK = 255 * 256


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of ``hashes`` (uint64) have each of the 64 bits set."""
    rows = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    rows[: len(hashes)] = hashes
    rows = rows.reshape(-1, 255)
    counts = np.zeros(BITS, np.int64)
    for bit in range(8):
        # Eight byte-wide counters in one integer; 255 rows can't overflow them.
        lanes = ((rows >> np.uint64(bit)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text: 0 for a text without words."""
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    if len(words) >= width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK].tolist(), (ends[at : at + _CHUNK] - 1).tolist())
        counts += _bit_counts(np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], np.uint64))
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > len(starts)).tolist()))


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_key (hash of the raw text) and fp (64 bits as a long) of
    each row of ``docs`` (doc_id, text); null text has no words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, width) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(prints, pa.int64())], ["doc_id", "text_key", "fp"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").alias("text"))
    return arrow_map(rows, run, f"doc_id {kind}, text_key long, fp long", "text")


def covering_masks(free: int, radius: int = RADIUS) -> list[int]:
    """Masks over the bits of ``free``, such that any ``radius`` bits of it are
    all outside some mask."""
    bits = [i for i in range(BITS) if free >> i & 1]
    vectors = (1 << (radius + 1)) - 1
    of = {b: k % vectors + 1 for k, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (of[b] & v).bit_count() & 1) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(members: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """(first, other) for each member linked to an earlier one, however far."""
    left = members
    while len(left) > 1:
        first, left = left[0], left[1:]
        front = [first]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= radius
            found, left = left[near], left[~near]
            for f in found:
                yield first, f
            front.extend(found)


def _bucket_links(radius: int):
    def links(members: list[np.ndarray]) -> list[tuple[int, int]]:
        return list(_forest(np.concatenate(members), radius))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by bucket; a bucket may go on in the next batch.
        held: list[np.ndarray] = []
        at = None
        for batch in batches:
            child, key, fp = (batch.column(i).to_numpy() for i in range(3))
            if not len(fp):
                continue
            new = np.flatnonzero((child[1:] != child[:-1]) | (key[1:] != key[:-1])) + 1
            edges = []
            for a, b in zip(np.concatenate([[0], new]), np.concatenate([new, [len(fp)]])):
                bucket = (child[a], key[a])
                if bucket != at:
                    edges += links(held) if held else []
                    held, at = [], bucket
                held.append(fp[a:b].view(np.uint64))
            yield _edges(edges)
        yield _edges(links(held) if held else [])

    return run


def _edges(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def near_links(prints: DataFrame, radius: int = RADIUS, cap: int = CAP) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp) whose components are
    those of all pairs within the radius."""
    if cap < 1 << 8:
        raise ValueError("cap must be 256 or more, so that three levels suffice")
    spark = prints.sparkSession
    ship(spark)
    fixed = {0: 0}
    rows, found = prints, None
    while True:
        # At most 15^level masks, a fixed number.
        masks = [
            (path, path * 15 + t, mask | done)
            for path, done in fixed.items()
            for t, mask in enumerate(covering_masks(~done & ((1 << BITS) - 1), radius))
        ]
        fixed = {child: mask for _, child, mask in masks}
        if found is None:
            tables = F.array(*[F.struct(F.lit(c).alias("child"), F.lit(_signed(m)).alias("mask")) for _, c, m in masks])
            keyed = rows.select("fp", F.inline(tables))
        else:
            tables = spark.createDataFrame([(p, c, _signed(m)) for p, c, m in masks], "path int, child int, mask long")
            keyed = rows.join(F.broadcast(tables), "path")
        keyed = keyed.select("child", F.expr("fp & mask").alias("key"), "fp")
        sizes = keyed.groupBy("child", "key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
        shared = stash(keyed.join(sizes, ["child", "key"]), "buckets")
        small = shared.filter(F.col("m") <= cap).select("child", "key", "fp")
        dealt = small.repartition("child", "key").sortWithinPartitions("child", "key", "fp")
        edges = dealt.mapInArrow(_bucket_links(radius), "a long, b long")
        found = edges if found is None else found.unionByName(edges)
        crowd = shared.filter(F.col("m") > cap)
        if crowd.limit(1).count() == 0:
            return found
        rows = crowd.select("fp", F.col("child").alias("path"))


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node of ``edges`` but the smallest of its component, with
    that smallest; large-star and small-star steps until nothing changes."""
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stash(edges.distinct(), "edges")
    mark = None
    while True:
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            return edges
        mark = new
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        large = stash(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # The smallest neighbour takes the node itself and its other neighbours.
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = stash(small.filter("a != b").distinct(), "small-star")


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS, cap: int = CAP) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_key, fp,
    root, fingerprint (16 hex digits) and component_id, the smallest non-null doc_id
    that links of at most ``radius`` differing bits reach.

    Texts without words (null, empty, white space) have fingerprint 0 and link
    like any other; shorter texts than ``width`` words are one shingle.  An
    empty table gives no rows; further columns are ignored.
    """
    prints = stash(fingerprints(docs, width), "prints")
    classes = stash(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    stars = components(near_links(classes.select("fp"), radius, cap))
    rooted = classes.join(stars.withColumnsRenamed({"a": "fp", "b": "root"}), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", "text_key", "fp", "root", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each component the
    row with its smallest doc_id (of rows that share it, the smallest text_key,
    and one of those that share both)."""
    found = near_duplicates(docs, **options).groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "rows")
    keep = found.groupBy("root").agg(F.min(first).alias("first")).select("first.doc_id", "first.text_key", "first.rows")
    return keep_by_key(docs, stash(keep, "near-kept"))
