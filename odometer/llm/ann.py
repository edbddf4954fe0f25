"""Nearest neighbours by a forest of hash prefixes.

Each tree hashes a vector to a long string of bits, the signs of random
projections; a tree is the sorted array of these strings, dealt over all tasks
and numbered.  A query descends in every tree to its longest matching prefix
and then ascends in all trees at the same time, one bit a step, until the
ranges that share its prefix hold enough candidates together.  A range is a
stretch of the sorted array, so it is read as blocks of fixed size: blocks meet
groups of queries in an equi-join, and the inner products of each pair are one
matrix product.

Inner products are turned into angles by one more dimension: members get the
rest of their length up to the longest vector's, queries get zero and descend by
a hash of their own, so that of two members the one with the larger inner product
has the smaller angle.  Angles get wide where lengths differ much; each tree is
therefore cut into bands of members whose lengths differ by ``WIDTH`` at most, and
the rest is taken up to the band's longest.  Every query climbs in every band.

How many candidates are enough, over all trees, is in each band the share
``quota`` of its vectors, and its part of ``least``, which holds for all bands
together: vectors without near neighbours (64 random dimensions) need a large
share for a recall of 0.9, see the README.  Equal vectors are one class with
its smallest ids, as further copies cannot be among the nearest; so a vector
that a third of all rows share costs no more than any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odometer.llm.common import ordinals, ship, stash

TREES = 20
BITS = 32
QUOTA = 0.8
LEAST = 4096
WIDTH = 1.1
NEAREST = 20
BLOCK = 4096
QUERIES = 512
SEED = 7


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of rows that can take part: an id, and components
    that are all finite and not all zero."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(e, lambda x: x != 0)
    return vectors.filter(F.col("vec_id").isNotNull() & e.isNotNull()).filter(fine).select("vec_id", e.alias("vec"))


def _classes(rows: DataFrame, is_query, most: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (cls, vec, ids: the ``most`` smallest, each with its row's
    number n, asked: whether a query has it) and the queries (vec_id, n, cls).  Classes are numbered by their
    smallest vec_id: where scores tie, a class with a larger number than ``most``
    others has no row among the ``most`` first."""
    numbered = ordinals(rows, ["vec", "vec_id"], "n", "vectors")
    numbered = stash(numbered, "numbered")
    first = numbered.groupBy("vec").agg(F.min("n").alias("start"), F.min("vec_id").alias("lead"), F.max(is_query).alias("asked"))
    first = stash(ordinals(first, ["lead", "start"], "cls", "class-order").drop("lead"), "classes")
    members = numbered.join(first.select("vec", "cls", "start"), "vec")
    members = members.select("cls", "start", "vec_id", "n", is_query.alias("query"))
    members = stash(members, "members")
    ids = members.filter(F.col("n") < F.col("start") + most).groupBy("cls")
    ids = ids.agg(F.sort_array(F.collect_list(F.struct("vec_id", "n"))).alias("ids"))
    return first.drop("start").join(ids, "cls"), members.filter("query").select("vec_id", "n", "cls")


def _length(vec: str) -> Column:
    """Euclidean length; squares of large components don't overflow."""
    return F.aggregate(vec, F.lit(0.0), lambda a, x: F.hypot(a, x.cast("double")))


def _hash_rows(tops: dict[int, float], trees: int, bits: int, seed: int, kind: str):
    """Per vector (cls, asked, vec) its band, its bytes, its hash in each tree
    (an integer of ``bits`` bits, the first projection its highest) and, where a
    query has it, the query's hash in each tree.  ``tops``: the longest length by
    component count.  A band's number has the component count in its high bits."""
    planes: dict[int, np.ndarray] = {}
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)

    def hashes(vec: np.ndarray, dims: int) -> np.ndarray:
        if dims not in planes:
            planes.clear()  # of one component count at a time
            planes[dims] = np.random.default_rng(seed).normal(size=(dims + 1, trees * bits))
        return (vec @ planes[dims][: vec.shape[1]] > 0).reshape(len(vec), trees, bits) @ weights

    def by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
        sizes = batch.column(2).value_lengths().to_numpy()
        for dims in np.unique(sizes):
            yield int(dims), batch if (sizes == dims).all() else batch.take(pa.array(np.flatnonzero(sizes == dims)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, whole in ((d, part) for batch in batches for d, part in by_size(batch)):
            top = tops[dims]
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                n = batch.num_rows
                vec = batch.column(2).flatten().to_numpy().astype(np.float64).reshape(n, -1)
                most = np.abs(vec).max(axis=1, keepdims=True)
                unit = vec / most
                length = np.linalg.norm(unit, axis=1, keepdims=True)
                unit = unit / length
                # How often the longest is ``WIDTH`` times as long, from logarithms.
                steps = np.maximum(math.log(top) - np.log(most) - np.log(length), 0.0) / math.log(WIDTH)
                band = np.floor(steps + 1e-6)
                # The share of the band's longest length that the vector has.
                share = np.minimum(WIDTH ** (band - steps), 1.0)
                own = hashes(np.column_stack([unit * share, np.sqrt(1.0 - share * share)]), dims)
                asked = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                ends = np.concatenate([[0], np.cumsum(asked) * trees]).astype(np.int32)
                raw = pa.array([v.tobytes() for v in vec.astype(kind)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(band[:, 0].astype(np.int64) + (dims << 32)),
                        raw,
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * trees), pa.array(own.ravel())),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes(unit[asked], dims).ravel())),
                    ],
                    ["cls", "asked", "band", "vec", "hashes", "q_hashes"],
                )

    return run


def _score(nearest: int, kind: str):
    """The best ``nearest`` members of a block for each query of a group that
    the member's hash prefix admits; ties to the smaller class."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                members = np.frombuffer(b"".join(row.vecs), kind).astype(np.float64).reshape(len(row.members), -1)
                asked = np.frombuffer(b"".join(row.q_vecs), kind).astype(np.float64).reshape(len(row.queries), -1)
                order = np.asarray(row.orders)
                scores = asked @ members.T
                scores[(order[None, :] < np.asarray(row.lows)[:, None]) | (order[None, :] >= np.asarray(row.highs)[:, None])] = -np.inf
                k = min(nearest, scores.shape[1])
                last = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k, None]
                q, m = np.nonzero((scores >= last) & np.isfinite(scores))
                value, near = scores[q, m], np.asarray(row.members)[m]
                # What ties with the last comes too: of each query the first ``k``.
                order = np.lexsort((near, -value, q))
                q, value, near = q[order], value[order], near[order]
                kept = np.arange(len(q)) - np.searchsorted(q, q) < k
                yield pd.DataFrame({"cls": np.asarray(row.queries)[q[kept]], "near": near[kept], "score": value[kept]})

    return run


def nearest_neighbours(
    vectors: DataFrame,
    query_step: int = 20,
    nearest: int = NEAREST,
    trees: int = TREES,
    bits: int = BITS,
    quota: float = QUOTA,
    least: int = LEAST,
    seed: int = SEED,
) -> DataFrame:
    """query_id, rank, vec_id and score (inner product, double) of the nearest
    rows found for each row of ``vectors`` (vec_id, embedding) whose vec_id is
    divisible by ``query_step``; ties to the smaller vec_id; all other rows if
    fewer than ``nearest``.

    Rows without an id or a usable vector take no part.  Rows may share an id;
    each query leaves out one row, its own.  Vectors meet those with as many
    components; each component count has an index of its own.  An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    # Vectors are kept as they are: 32-bit components stay 32-bit.
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    out = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors)
    # One row per component count.
    tops = {r["dims"]: r["top"] for r in rows.groupBy(F.size("vec").alias("dims")).agg(F.max(_length("vec")).alias("top")).collect()}
    if not tops:
        return spark.createDataFrame([], out)
    is_query = F.col("vec_id") % query_step == 0
    classes, queries = _classes(rows, is_query, nearest + 1)
    classes = stash(classes, "index-classes")
    queries = stash(queries, "queries")

    hash_rows = _hash_rows(tops, trees, bits, seed, kind)
    hashed = classes.select("cls", "asked", "vec").mapInArrow(
        hash_rows, "cls long, asked boolean, band long, vec binary, hashes array<long>, q_hashes array<long>"
    )
    hashed = stash(hashed, "hashed")
    entries = hashed.select("cls", "band", F.posexplode("hashes").alias("tree", "hash"))
    forest = stash(ordinals(entries, ["tree", "band", "hash", "cls"], "place", "forest"), "trees")

    # Prefix ranges: counts of leaves, summed up towards the roots.  A leaf this
    # deep holds a few vectors; the climb never starts below it.
    depth = F.greatest(F.lit(1), F.least(F.lit(bits), F.ceil(F.log2("size")).cast("int")))
    sizes = hashed.groupBy("band").agg(F.count(F.lit(1)).alias("size"))
    # One row per band: bounded by the range of lengths.
    share = F.greatest(F.lit(float(quota)), F.lit(least) / F.sum("size").over(Window.partitionBy(F.expr("shiftright(band, 32)"))))
    enough = F.least(F.ceil(share * F.col("size")), F.col("size") * trees)
    sizes = stash(sizes.select("band", depth.alias("depth"), enough.alias("enough")), "bands")
    dims = F.expr("shiftright(band, 32)").alias("dims")
    leaf = F.expr(f"shiftright(hash, {bits} - depth)")
    steps = F.explode(F.sequence(F.lit(0), F.col("depth")))
    leaves = forest.join(F.broadcast(sizes), "band").groupBy("tree", "band", "depth", leaf.alias("leaf"))
    leaves = leaves.agg(F.min("place").alias("low"), F.count(F.lit(1)).alias("n"))
    nodes = (
        stash(leaves, "leaves")
        .withColumn("up", steps)
        .groupBy("tree", "band", "up", F.expr("shiftright(leaf, up)").alias("prefix"))
        .agg(F.min("low").alias("low"), F.sum("n").alias("n"))
    )
    own = hashed.filter("asked").select("cls", dims, F.posexplode("q_hashes").alias("tree", "hash"))
    own = own.join(F.broadcast(sizes.select("*", dims)), "dims")
    climb = own.withColumn("leaf", leaf).withColumn("up", steps).withColumn("prefix", F.expr("shiftright(leaf, up)"))
    climb = climb.select("cls", "tree", "band", "enough", "up", "prefix").join(nodes, ["tree", "band", "up", "prefix"])
    climb = stash(climb.select("cls", "band", "enough", "up", "low", "n"), "climb")
    stop = climb.groupBy("cls", "band", "enough", "up").agg(F.sum("n").alias("n")).filter(F.col("n") >= F.col("enough"))
    stop = stop.groupBy("cls", "band").agg(F.min("up").alias("up"))
    ranges = climb.join(stop, ["cls", "band", "up"]).select("cls", dims, "low", (F.col("low") + F.col("n")).alias("high"))

    # Blocks of the sorted arrays (of one component count), and groups of the queries that read each.
    vec_of = hashed.select("cls", "vec")
    blocks = forest.select("cls", dims, "place").join(vec_of, "cls").groupBy("dims", F.expr(f"place div {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "cls", "vec"))).alias("rows")
    )
    blocks = blocks.select(
        "dims",
        "block",
        F.col("rows.place").alias("orders"),
        F.col("rows.cls").alias("members"),
        F.col("rows.vec").alias("vecs"),
    )
    reads = ranges.withColumn("block", F.explode(F.expr(f"sequence(low div {BLOCK}, (high - 1) div {BLOCK})")))
    crowd = reads.groupBy("dims", "block").agg(F.count(F.lit(1)).alias("crowd"))
    reads = reads.join(vec_of.withColumnRenamed("vec", "q_vec"), "cls").join(crowd, ["dims", "block"])
    part = F.pmod(F.xxhash64("cls"), F.ceil(F.col("crowd") / QUERIES))
    groups = reads.groupBy("dims", "block", part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("cls", "low", "high", "q_vec"))).alias("rows")
    )
    groups = groups.select(
        "dims",
        "block",
        F.col("rows.cls").alias("queries"),
        F.col("rows.low").alias("lows"),
        F.col("rows.high").alias("highs"),
        F.col("rows.q_vec").alias("q_vecs"),
    )
    scored = groups.join(blocks, ["dims", "block"]).drop("dims", "block").mapInPandas(_score(nearest + 1, kind), "cls long, near long, score double")

    # A class met in several trees counts once; its copies are its ids.
    best = scored.groupBy("cls", "near").agg(F.max("score").alias("score"))
    first = Window.partitionBy("cls").orderBy(F.desc("score"), "near")
    best = stash(best.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= nearest + 1).drop("n"), "best")
    ids = classes.select(F.col("cls").alias("near"), "ids")
    found = best.join(ids, "near").select("cls", "score", F.explode("ids").alias("row"))
    first = Window.partitionBy("cls").orderBy(F.desc("score"), "row")
    found = found.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= nearest + 1)
    found = found.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("at", "row.vec_id", "row.n", "score"))).alias("found"))
    # Each query leaves out its own row, known by its number, and takes the rest.
    joined = queries.select(F.col("vec_id").alias("query_id"), F.col("n").alias("own"), "cls").join(found, "cls")
    others = F.filter("found", lambda s: s["n"] != F.col("own"))
    joined = joined.select("query_id", F.posexplode(F.slice(others, 1, nearest)).alias("at", "s"))
    return joined.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "s.vec_id", "s.score")
