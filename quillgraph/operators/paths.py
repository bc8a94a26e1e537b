"""Paths of any length over edges (edge_id, src, dst): a path may come to a node again, but takes no edge twice.

Each round joins the frontier with the edges once, on the node where paths end. Frontiers carry their edges, so rounds end by themselves. A
walk without a bound, or with a high one, writes each hop to the folder that driver and executors share, once, and its result is the union of these files.

Where only numbers are asked, no path is made: counts go from node to node (path_counts), and a neighbourhood is searched by breadth.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stored import Rounds

#: Hops that a walk does without writing any.
UNWRITTEN = 4


def walk(starts: DataFrame, edges: DataFrame, most: int | None = None, backward: bool = False) -> DataFrame:
    """starts (node) to paths: start, node (where it ends), hops, nodes, edge_ids. most: hops at most; None: until no path goes on."""
    if most is not None and (int(most) != most or most < 1):
        raise ValueError("most is a positive whole number")
    end, at = ("src", "dst") if backward else ("dst", "src")
    steps = edges.select("edge_id", F.col(at).alias("_at"), F.col(end).alias("_to"))
    front = starts.select(F.col("node").alias("start"), "node", F.lit(0).alias("hops"), F.array("node").alias("nodes"), F.array().cast("array<string>").alias("edge_ids"))
    found: list[DataFrame] = []
    hop, rounds = 0, Rounds(edges.sparkSession)
    written = most is None or most > UNWRITTEN
    while most is None or hop < most:
        hop += 1
        on = front.join(steps, (F.col("node") == F.col("_at")) & ~F.array_contains("edge_ids", F.col("edge_id")))
        front = on.select("start", F.col("_to").alias("node"), F.lit(hop).alias("hops"), F.concat("nodes", F.array("_to")).alias("nodes"), F.concat("edge_ids", F.array("edge_id")).alias("edge_ids"))
        front = rounds.put(front) if written else front
        if written and front.isEmpty():
            break
        found.append(front)
    return reduce(DataFrame.unionByName, found) if found else front.limit(0)


def cycles(edges: DataFrame, most: int) -> DataFrame:
    """Nodes that a path of at most `most` hops leads back to, with the least hops; components.strong_components tells circles of any length."""
    nodes = edges.select(F.col("src").alias("node")).distinct()
    back = walk(nodes, edges, most).where(F.col("start") == F.col("node"))
    return back.groupBy("node").agg(F.min("hops").alias("hops"))


def path_counts(starts: DataFrame, edges: DataFrame, backward: bool = False) -> DataFrame:
    """start, node, hops, n: how many paths of so many hops lead from each start (node) to a node. Edges in a circle are refused: they have paths without end.

    A row of a start and a node is a number, summed in every hop before it is shuffled, however many paths it stands for.
    """
    end, at = ("src", "dst") if backward else ("dst", "src")
    steps = edges.select(F.col(at).alias("node"), F.col(end).alias("_to"))
    rounds, found = Rounds(edges.sparkSession), []
    front = starts.select(F.col("node").alias("start"), "node", F.lit(1).cast("long").alias("n"))
    longest = None
    while True:
        hop = len(found) + 1
        front = rounds.put(front.join(steps, "node").groupBy("start", F.col("_to").alias("node")).agg(F.sum("n").alias("n")))
        if front.isEmpty():
            break
        if hop % 16 == 0:  # a path with more hops than there are nodes with edges has come to one again
            longest = longest or steps.select("node").distinct().count()
            if hop > longest:
                raise ValueError("edges lead in a circle")
        found.append(front.select("start", "node", F.lit(hop).alias("hops"), "n"))
    return reduce(DataFrame.unionByName, found) if found else front.select("start", "node", F.lit(0).alias("hops"), "n")


def neighbourhood(starts: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """start, node, hops: every node within `most` hops of a start (node), with the least hops; the start itself has 0.

    Edges (src, dst) lead both ways. Nodes that are known already are taken off each round's frontier, so a node is reached once from each start,
    whatever the number of ways to it.
    """
    if int(most) != most or most < 0:
        raise ValueError("most is a whole number, 0 or more")
    ways = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return reach(starts, ways, most)


def reach(starts: DataFrame, ways: DataFrame, most: int) -> DataFrame:
    """As neighbourhood(), along ways from src to dst only."""
    rounds = Rounds(ways.sparkSession)
    front = rounds.put(starts.select(F.col("node").alias("start"), "node", F.lit(0).alias("hops")).distinct())
    found = [front]
    for hop in range(1, most + 1):
        seen = reduce(DataFrame.unionByName, found).select("start", "node")
        next_ = front.join(ways, F.col("node") == F.col("src")).select("start", F.col("dst").alias("node")).distinct()
        front = rounds.put(next_.join(seen, ["start", "node"], "left_anti").select("start", "node", F.lit(hop).alias("hops")))
        if front.isEmpty():
            break
        found.append(front)
    return reduce(DataFrame.unionByName, found)
