"""Merkle manifest of a dataset: a digest for each document, for each source and for the whole, and for each document the path that proves it.

Documents are leaves, in the order of doc_id, of one tree for each source; the sources' roots are leaves of a last tree. A tree is cut
into aligned blocks of BLOCK nodes. Within a block the paths come from a fractal traversal: subtrees of HEIGHT levels stand stacked over
the leaf at hand, and beside each the next one of its level is built, a leaf a step, so that it is ready when the traversal enters
it; no block's whole tree is ever held. Blocks' roots are the nodes of the next round, which is dealt out just so; a round has BLOCK times fewer
nodes than the one before, and its paths are appended to those below.

Nulls and ties: a null column counts as null in its leaf (and unlike an empty text); rows without doc_id come first in their source, rows without
source are a source of their own, the first. Rows that share a doc_id are told apart by their leaf, and rows alike in all stand in any
order, which changes nothing. An empty table has no leaves, no root and no rows here. Texts count whole, whatever their length; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

#: Nodes of a run; levels of a stacked subtree; subtrees stacked in a block.
ARITY, HEIGHT, STACKED = 3, 2, 3
LEVELS = HEIGHT * STACKED
BLOCK = ARITY**LEVELS
_PROOF = "array<struct<left:string,right:string>>"


# -- leaves and proofs as columns ------------------------------------------------------------------------------------------------


def leaf(text: Column) -> Column:
    """Digest of a document with this text: of each column its length and value, so that no two documents give one input."""
    told = []
    for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text):
        s = c.cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*told), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(proof, digest, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of a path's siblings, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


# -- one block -------------------------------------------------------------------------------------------------------------------


def node(run: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(run)).hexdigest().encode()


class Subtree:
    """The nodes of the levels low to high - 1 over leaves from `start` on, built a leaf at a time: below low only what no run has closed yet is held."""

    def __init__(self, leaves: list[bytes], start: int, low: int, high: int):
        self.leaves, self.start, self.low, self.high = leaves, start, low, high
        self.next, self.end = start, min(len(leaves), start + ARITY**high)
        self.rows: list[list[bytes]] = [[] for _ in range(low, high)]
        self.open: list[list[bytes]] = [[] for _ in range(high + 1)]

    def step(self) -> None:
        """Take in one leaf, if any is left; the last one closes the runs that stay short."""
        if self.next >= self.end:
            return
        self._push(self.leaves[self.next], 0)
        self.next += 1
        if self.next == self.end:
            for level in range(self.high):
                if self.open[level]:
                    self._close(level)

    def whole(self) -> Subtree:
        while self.next < self.end:
            self.step()
        return self

    def _push(self, digest: bytes, level: int) -> None:
        if self.low <= level < self.high:
            self.rows[level - self.low].append(digest)
        self.open[level].append(digest)
        if len(self.open[level]) == ARITY and level < self.high:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        self._push(node(run), level + 1)

    @property
    def root(self) -> bytes:
        return self.open[self.high][0]

    def siblings(self, at: int) -> Iterator[tuple[bytes, bytes]]:
        """For each level what stands left and right of the leaf's node in its run."""
        for level, row in enumerate(self.rows, self.low):
            i = (at - self.start) // ARITY**level
            first = i - i % ARITY
            yield b"".join(row[first:i]), b"".join(row[i + 1 : first + ARITY])


def traverse(leaves: list[bytes], levels: int) -> tuple[bytes, Iterator[list[tuple[bytes, bytes]]]]:
    """The root of a block of this many levels, and in turn each leaf's path."""
    cuts = [(low, min(low + HEIGHT, levels)) for low in range(0, levels, HEIGHT)]
    existing = [Subtree(leaves, 0, *c).whole() for c in cuts]

    def walk() -> Iterator[list[tuple[bytes, bytes]]]:
        desired = [Subtree(leaves, ARITY**high, low, high) for low, high in cuts[:-1]]  # the topmost covers the block
        for at in range(len(leaves)):
            yield [pair for tree in existing for pair in tree.siblings(at)]
            for k, (low, high) in enumerate(cuts[:-1]):
                desired[k].step()
                if (at + 1) % ARITY**high == 0:
                    existing[k], desired[k] = desired[k], Subtree(leaves, at + 1 + ARITY**high, low, high)

    return existing[-1].root if existing else leaves[0], walk()


def _levels(n: int) -> int:
    """Levels of a block of a tree of n nodes: all of the tree, if it is one block."""
    levels = 0
    while ARITY**levels < n and levels < LEVELS:
        levels += 1
    return levels


def _block(rows: pa.Table) -> pa.Table:
    """A block's rows with their paths and the block's root."""
    rows = rows.sort_by("pos")
    root, paths = traverse([d.encode() for d in rows.column("digest").to_pylist()], _levels(rows.column("n")[0].as_py()))
    left, right, size = [], [], [0]
    for path in paths:
        for a, b in path:
            left.append(a)
            right.append(b)
        size.append(len(left))
    text = lambda x: pa.array(x, pa.binary()).cast(pa.string())
    proof = pa.ListArray.from_arrays(pa.array(np.array(size, np.int32)), pa.StructArray.from_arrays([text(left), text(right)], ["left", "right"]))
    return rows.append_column("proof", proof).append_column("block_root", pa.array([root.decode()] * rows.num_rows, pa.string()))


# -- rounds ----------------------------------------------------------------------------------------------------------------------


def place(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """df with pos, a row's place in its tree in this order, and n, the rows of the tree.

    One range sort over all trees, numbered as it lies; how many rows of a tree lie in earlier ranges is summed from a row for each range and tree.
    """
    held = durable(df.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn("id", F.monotonically_increasing_id()))
    span = F.shiftright("id", 33)
    spans = held.groupBy(F.col(tree).alias("t"), span.alias("span")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("m"))
    all_, before = Window.partitionBy("t"), Window.partitionBy("t").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    told = spans.select("t", "span", "first", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"), F.sum("m").over(all_).alias("n"))
    met = held.join(told, F.col(tree).eqNullSafe(F.col("t")) & (span == F.col("span")))
    return met.select(*[F.col(c) for c in df.columns], (F.col("before") + F.col("id") - F.col("first")).alias("pos"), "n")


def climb(nodes: DataFrame, top: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """nodes (tree, pos, n, digest and more) with proof, the path to what `top` makes of the trees' roots, and what else it tells of them.

    top: from (tree, digest), a row for each tree, to tree, proof and further columns.
    """
    if (nodes.agg(F.max("n")).first()[0] or 1) == 1:  # one number tells how many rounds there are
        told, key = nodes.withColumn("own", F.lit(None).cast(_PROOF)), F.lit(0)
        above = top(nodes.select("tree", "digest")).withColumn("pos", F.lit(0))
    else:
        blocks = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
        kinds = ", ".join(f"`{n}` {t}" for n, t in blocks.dtypes)
        told = durable(blocks.groupBy("tree", "block").applyInArrow(_block, f"{kinds}, proof {_PROOF}, block_root string")).withColumnRenamed("proof", "own")
        roots = told.where(F.col("pos") % BLOCK == 0).select("tree", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("block_root").alias("digest"))
        above, key = climb(roots, top), F.col("block")
    more = [c for c in above.columns if c not in ("tree", "pos", "n", "digest", "proof")]
    above = above.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("proof").alias("_above"), *more)
    met = told.join(above, F.col("tree").eqNullSafe(F.col("_tree")) & (key == F.col("_pos")))
    return met.select(*nodes.columns, F.concat(F.coalesce("own", F.array().cast(_PROOF)), "_above").alias("proof"), *more)


def _sources(roots: DataFrame) -> DataFrame:
    """(tree, digest) of the sources to tree, proof, subroot, root: the tree of their roots, in the order of their names."""
    placed = place(roots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), "tree", ["source"])
    whole = climb(placed, lambda one: one.select("tree", F.array().cast(_PROOF).alias("proof"), F.col("digest").alias("root")))
    return whole.select(F.col("source").alias("tree"), "proof", F.col("digest").alias("subroot"), "root")


def manifest(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, found_leaf, proof, subroot, root of every document. found: the text as it is found when it is checked; found_leaf is the leaf with it."""
    own = leaf(F.col("text"))
    # repeated rows, any number of them, are dealt out by where they stood
    leaves = durable(docs.select("doc_id", F.col("source").alias("tree"), own.alias("digest"), (own if found is None else leaf(found)).alias("found_leaf"), F.monotonically_increasing_id().alias("copy")))
    told = climb(place(leaves, "tree", ["doc_id", "digest", "copy"]), _sources)
    return told.select("doc_id", F.col("tree").alias("source"), F.col("digest").alias("leaf"), "found_leaf", "proof", "subroot", "root")


def verify(told: DataFrame) -> DataFrame:
    """manifest() with its paths as a digest, and whether the text as found leads to the root."""
    folded = told.withColumn("folded_root", fold(F.col("found_leaf"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "source")


def without_line_breaks(docs: DataFrame) -> Column:
    """The texts of documents whose doc_id has an even checksum lose their line breaks; others, and those without doc_id, stay."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
