"""Merkle manifest of a dataset from SHA-256 midstates.

Rows are leaves, three siblings a run, one tree per source and one over the
sources' roots.  A parent keeps a copy of its hash state before each child
slot.  To fold a replaced child, the state of its slot is resumed with the
replacement and the siblings to its right; what lies left is hashed already.

Six levels are one block (729 nodes), worked on in one piece: the leaves' blocks
give the nodes of the next round, and so on until one node is left.  Then each
round tells its nodes what lies beside their way to the root, from the top down,
and the leaves' blocks are built once more to fold every row.  No block, and
nothing that meets in a task, grows with a source.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odometer.llm.common import ship, stash

FAN = 3
LEVELS = 6

#: A node's way to the root: what lies left and right of it in each level's run
#: (digests joined), and the roots it leads to.
PATH = "left array<binary>, right array<binary>, subroot binary, root binary"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(docs: DataFrame, text: Column) -> Column:
    """The digest of a row of documents whose text is ``text``."""
    values = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


class Block:
    """The tree over one block's nodes: ``levels`` of it, or until one is left."""

    def __init__(self, digests: list[bytes], levels: int | None):
        self.before: list[list] = []
        self.lefts: list[list[bytes]] = []
        self.rights: list[list[bytes]] = []
        row = digests
        while len(self.before) < levels if levels is not None else len(row) > 1:
            before, lefts, rights, parents = [], [], [], []
            for at in range(0, len(row), FAN):
                run = row[at : at + FAN]
                state = hashlib.sha256()
                for i, child in enumerate(run):
                    before.append(state.copy())
                    lefts.append(b"".join(run[:i]))
                    rights.append(b"".join(run[i + 1 :]))
                    state.update(child.hex().encode())
                parents.append(state.digest())
            self.before.append(before)
            self.lefts.append(lefts)
            self.rights.append(rights)
            row = parents
        self.tops = row

    def beside(self, node: int) -> tuple[list[bytes], list[bytes]]:
        """What lies left and right of the way up from a node, by level."""
        ways = []
        for lefts, rights in zip(self.lefts, self.rights):
            ways.append((lefts[node], rights[node]))
            node //= FAN
        return [w[0] for w in ways], [w[1] for w in ways]

    def fold(self, node: int, digest: bytes) -> bytes:
        """The block's root with ``digest`` in place of a node."""
        for before, rights in zip(self.before, self.rights):
            digest = resume(before[node], digest, rights[node])
            node //= FAN
        return digest


def resume(state, digest: bytes, rights: bytes) -> bytes:
    """The parent of ``digest`` from the state before its slot."""
    state = state.copy()
    state.update(digest.hex().encode())
    if rights:
        state.update(rights.hex().encode())
    return state.digest()


def _block(table: pa.Table, levels: int) -> tuple[pa.Table, Block]:
    """A block's nodes in order.  In a tree of one block the levels end where
    one node is left; in a larger one each block has all ``levels``."""
    table = table.sort_by("idx")
    alone = table["nodes"][0].as_py() <= FAN**levels
    return table, Block(table["digest"].to_pylist(), None if alone else levels)


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("idx") / FAN**levels))


def _round(nodes: DataFrame, levels: int) -> DataFrame:
    """The block roots of ``nodes`` (tree, nodes: how many the tree has, idx:
    from 0, digest), as nodes again."""

    def run(table: pa.Table) -> pa.Table:
        table, block = _block(table, levels)
        size = FAN**levels
        row = [[table["tree"][0].as_py()], [-(-table["nodes"][0].as_py() // size)], [table["idx"][0].as_py() // size], block.tops]
        return pa.table([pa.array(v, t) for v, t in zip(row, (pa.string(), pa.int64(), pa.int64(), pa.binary()))], ["tree", "nodes", "idx", "digest"])

    ship(nodes.sparkSession)
    blocks = _in_blocks(nodes.select("tree", "nodes", "idx", "digest"), levels)
    return blocks.groupBy("tree", "block").applyInArrow(run, "tree string, nodes long, idx long, digest binary")


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` and the rounds above it, up to one node a tree."""
    out = [nodes]
    while True:
        (most,) = out[-1].agg(F.max("nodes")).first()
        if (most or 0) <= 1:
            return out
        out.append(stash(_round(out[-1], levels), "manifest-round"))


def _ways(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """The path of each node from the paths of the round above."""

    def run(below: pa.Table, top: pa.Table) -> pa.Table:
        below, block = _block(below, levels)
        (top,) = top.to_pylist()
        sides = [block.beside(i) for i in range(below.num_rows)]
        return pa.table(
            [
                below["tree"].combine_chunks(),
                below["idx"].combine_chunks(),
                pa.array([left + top["left"] for left, _ in sides], pa.list_(pa.binary())),
                pa.array([right + top["right"] for _, right in sides], pa.list_(pa.binary())),
                pa.array([top["subroot"]] * below.num_rows, pa.binary()),
                pa.array([top["root"]] * below.num_rows, pa.binary()),
            ],
            ["tree", "idx", "left", "right", "subroot", "root"],
        )

    blocks = _in_blocks(nodes.select("tree", "nodes", "idx", "digest"), levels)
    tops = above.withColumnRenamed("idx", "block")
    return blocks.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInArrow(run, f"tree string, idx long, {PATH}")


def _source_paths(subroots: DataFrame, levels: int) -> DataFrame:
    """The path of each source's root (tree, idx 0) to the root over all."""
    ordered = _indexed(subroots.select("tree", F.lit("all").alias("top"), "digest"), "top", ["tree"])
    rounds = _rounds(ordered.select(F.col("top").alias("tree"), "nodes", "idx", "digest", F.col("tree").alias("source")), levels)
    none = F.array().cast("array<binary>")
    paths = rounds[-1].select("tree", "idx", none.alias("left"), none.alias("right"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(rounds[:-1]):
        paths = _ways(nodes, paths, levels)
    named = rounds[0].select("idx", "source", F.col("digest").alias("own"))
    return stash(
        named.join(paths, "idx").select(
            F.col("source").alias("tree"), F.lit(0).cast("long").alias("idx"), "left", "right", F.col("own").alias("subroot"), "root"
        ),
        "manifest-sources",
    )


def _indexed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with idx (from 0 within the tree, in ``order``) and nodes (rows
    of the tree).  One range shuffle deals the sort over all tasks, so that a
    tree may span many; each slice's part of a tree counts for itself."""
    dealt = rows.repartitionByRange(*map(F.col, [tree, *order])).sortWithinPartitions(tree, *order)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    dealt = stash(dealt.withColumn("slice", F.spark_partition_id()).withColumn("place", place), "manifest-order")
    parts = dealt.groupBy(tree, "slice").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("part"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        tree,
        "slice",
        (F.coalesce(F.sum("part").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("part").over(whole).alias("nodes"),
    )
    return dealt.join(parts, [tree, "slice"]).withColumn("idx", F.col("place") + F.col("shift")).drop("slice", "place", "shift")


def _fold(leaves: DataFrame, paths: DataFrame, kind: str, levels: int) -> DataFrame:
    """Each leaf with its proof, and the root that its replacement folds to."""

    def run(below: pa.Table, top: pa.Table) -> pa.Table:
        below, block = _block(below, levels)
        (top,) = top.to_pylist()
        above = []
        for left, right in zip(top["left"], top["right"]):
            above.append((hashlib.sha256(left.hex().encode()), right))
        rest = b"".join(part for pair in zip(top["left"], top["right"]) for part in pair)
        proofs, folded = [], []
        for i, digest in enumerate(below["found"].to_pylist()):
            proofs.append(b"".join(part for pair in zip(*block.beside(i)) for part in pair) + rest)
            digest = block.fold(i, digest)
            for state, right in above:
                digest = resume(state, digest, right)
            folded.append(digest)
        n = below.num_rows
        return pa.table(
            [
                below["doc_id"].combine_chunks(),
                below["tree"].combine_chunks(),
                below["idx"].combine_chunks(),
                below["digest"].combine_chunks(),
                pa.array([top["subroot"]] * n, pa.binary()),
                pa.array([top["root"]] * n, pa.binary()),
                pa.array(proofs, pa.binary()),
                pa.array(folded, pa.binary()),
            ],
            ["doc_id", "tree", "place", "leaf", "subroot", "root", "proof", "folded_root"],
        )

    schema = f"doc_id {kind}, tree string, place long, leaf binary, subroot binary, root binary, proof binary, folded_root binary"
    blocks = _in_blocks(leaves, levels)
    tops = paths.withColumnRenamed("idx", "block")
    return blocks.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInArrow(run, schema)


def manifest(docs: DataFrame, found: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text):
    doc_id, source, place (from 0 in its source, by doc_id), leaf, subroot,
    root, proof (the siblings of its way to the root, level by level, left to
    right, 32 bytes each), folded_root (the root recomputed from the leaf of a
    row whose text is ``found``, and the siblings) and verified (whether that is
    the root); digests as binary.

    ``found`` is an expression over the columns of ``docs``; without it every
    row is as it was.  ``levels`` are worked on in one piece; the result doesn't
    depend on it.  Nulls count as ``-``; null doc_ids and the null source
    come first.  Rows with one doc_id are ordered by their digests, so repeated
    rows are leaves side by side.  A source with one row has its leaf as root.
    An empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    digest = leaf_digest(docs, F.col("text"))
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        tree.alias("tree"),
        digest.alias("digest"),
        (digest if found is None else F.when(found.eqNullSafe(F.col("text")), digest).otherwise(leaf_digest(docs, found))).alias("found"),
    )
    leaves = _indexed(rows, "tree", ["doc_id", "digest", "found"])
    rounds = _rounds(leaves, levels)
    paths = _source_paths(rounds[-1], levels)
    for nodes in reversed(rounds[1:-1]):
        paths = stash(_ways(nodes, paths, levels), "manifest-ways")
    out = _fold(leaves, paths, kind, levels)
    source = F.when(F.col("tree") != "n", F.expr("substring(tree, 2)"))
    return out.select(
        "doc_id", source.alias("source"), "place", "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def manifest_digests(rows: DataFrame) -> DataFrame:
    """Digests as lowercase hexadecimal text, and the proof's own."""
    shown = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return rows.select(
        "doc_id",
        *shown,
        F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
        F.lower(F.hex("folded_root")).alias("folded_root"),
        "verified",
    )
